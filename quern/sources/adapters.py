"""Sources behind one protocol: an adapter turns its stored raw bodies into validated records."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import stable_key
from quern.functions.text import trimmed
from quern.sources import catalog


class Adapter(Protocol):
    """A source. Its records have record_key, title, page, pos; anything of one name and this method is an adapter."""

    name: str

    def records(self, bodies: DataFrame) -> DataFrame:
        """Records of the source's bodies (page, body)."""


@dataclass(frozen=True)
class Listing:
    """An adapter made of a parser whose rows have page and pos, and of its key's and title's columns."""

    name: str
    parse: Callable[[DataFrame], DataFrame]
    key: Column
    title: str

    def records(self, bodies: DataFrame) -> DataFrame:
        return self.parse(bodies).select(self.key.alias("record_key"), F.col(self.title).alias("title"), "page", "pos")


def known_adapters() -> list[Adapter]:
    """The library's catalogs."""
    return [
        Listing("directory", lambda b: catalog.startups(b.withColumnRenamed("body", "html")), stable_key(F.lit("directory"), F.col("slug")), "entity_name"),
        Listing("spaces", catalog.products, F.col("record_key"), "product_name"),
        Listing("papers", catalog.papers, F.col("record_key"), "title"),
    ]


def collect(bodies: DataFrame, adapters: Iterable[Adapter], limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """source, record_key, title of bodies (source, page, body), and what is put aside: source, page, reason.

    Each adapter sees its own source's bodies alone, and of its valid records at most ``limit`` are taken, first
    by page and place. Aside go bodies without an adapter or source, and records without a key or title. Two adapters
    of one name are an error; none give no records.
    """
    adapters = list(adapters)
    names = [a.name for a in adapters]
    if len(set(names)) < len(names):
        raise ValueError(f"adapters of one name: {sorted(names)}")
    page_type = bodies.schema["page"].dataType.simpleString()
    taken = [bodies.sparkSession.createDataFrame([], f"source string, record_key string, title string, page {page_type}, pos int")]
    aside = [bodies.where(~F.coalesce(F.col("source").isin(names), F.lit(False))).select("source", "page", F.lit("no adapter").alias("reason"))]
    for a in adapters:
        rows = a.records(bodies.where(F.col("source") == a.name).select("page", "body")).select(F.lit(a.name).alias("source"), "record_key", "title", "page", "pos")
        valid = F.col("record_key").isNotNull() & (F.coalesce(trimmed(F.col("title")), F.lit("")) != "")
        good = rows.where(valid)
        taken.append(good if limit is None else good.orderBy("page", "pos").limit(limit))
        aside.append(rows.where(~valid).select("source", "page", F.lit("invalid").alias("reason")))
    return reduce(DataFrame.unionByName, taken).select("source", "record_key", "title"), reduce(DataFrame.unionByName, aside)
