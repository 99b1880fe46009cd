"""Gap filling: candidates, budget, providers in turn, and the gate on what they answer."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import holds_any, populated, trimmed

# Words that hint at a product's price.
PRICING_TERMS = ["free", "freemium", "paid", "pricing", "subscription", "enterprise", "plan"]


def document_of(labels: dict[str, Column]) -> Column:
    """Labelled lines with a blank line between; empty values leave their line out."""
    lines = [F.when(F.coalesce(trimmed(v), F.lit("")) != "", F.concat(F.lit(f"{k}: "), v)) for k, v in labels.items()]
    return F.concat_ws("\n\n", *lines)


def needs_pricing(record_type: Column, pricing: Column, document: Column) -> Column:
    return (record_type == "PRODUCT") & ~F.coalesce(populated(pricing), F.lit(False)) & holds_any(F.lower(document), PRICING_TERMS)


def within_budget(candidates: DataFrame, calls: int, *order: str) -> DataFrame:
    """``called``: the first ``calls`` candidates in order; the others still count as candidates."""
    first = candidates.orderBy(*order).limit(calls).select(*order).withColumn("called", F.lit(True))
    return candidates.join(first, list(order), "left").withColumn("called", F.coalesce("called", F.lit(False)))


def accepted_answer(document: Column, value: Column, quote: Column, allowed: list[str]) -> Column:
    """The value is one of those allowed and its quote stands in the document word for word."""
    q = trimmed(quote)
    return F.coalesce(value.isin(allowed) & (q != "") & F.contains(document, q), F.lit(False))


def with_evidence(values: Column, evidence: Column) -> Column:
    """Of a map of answers those that come with evidence."""
    return F.map_filter(values, lambda k, _: F.coalesce(evidence[k], F.lit("")) != "")


def fallback(outcomes: Column, retries: int) -> Column:
    """struct(provider, attempts) over one list of scripted outcomes per provider: each may be tried
    retries + 1 times, ``ok`` ends all, ``permanent`` moves on, others use up a try. Provider 0: all failed.

    A fold over the providers: each one's outcomes are cut at its first ok or permanent.
    """
    start = F.struct(F.lit(0).alias("provider"), F.lit(0).alias("attempts"), F.lit(0).alias("seen"))

    def one(state: Column, row: Column) -> Column:
        tries = F.slice(row, 1, retries + 1)
        final = F.least(F.coalesce(F.nullif(F.array_position(tries, "ok"), F.lit(0)), F.lit(1 << 30)), F.coalesce(F.nullif(F.array_position(tries, "permanent"), F.lit(0)), F.lit(1 << 30)))
        used = F.least(final, F.size(tries)).cast("int")
        ok = F.coalesce(F.get(tries, used - 1) == "ok", F.lit(False))
        over = state["provider"] > 0
        return F.struct(
            F.when(over, state["provider"]).when(ok, state["seen"] + 1).otherwise(0).alias("provider"),
            F.when(over, state["attempts"]).otherwise(state["attempts"] + used).alias("attempts"),
            (state["seen"] + 1).alias("seen"),
        )

    return F.aggregate(outcomes, start, one, lambda s: F.struct(s["provider"].alias("provider"), s["attempts"].alias("attempts")))


class Provider(Protocol):
    """What answers a document: value and quote."""

    def extract(self, document: str) -> tuple[str | None, str | None]: ...


def answered(candidates: DataFrame, provider: Provider, key: str) -> DataFrame:
    """key, document, value, quote: the provider is asked in batches on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            answers = [provider.extract(d) for d in pdf["document"]]
            yield pd.DataFrame({key: pdf[key], "document": pdf["document"], "value": [a for a, _ in answers], "quote": [q for _, q in answers]})

    kind = candidates.schema[key].dataType.simpleString()
    return candidates.select(key, "document").mapInPandas(run, f"{key} {kind}, document string, value string, quote string")


def batched(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """``batch`` numbers within each hash range of the key, so no task sees all rows."""
    part = F.pmod(F.xxhash64(*order), F.lit(64))
    return rows.withColumn("_p", part).withColumn("batch", F.floor((F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1) / size)).withColumnRenamed("_p", "range")
