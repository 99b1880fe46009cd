"""First wins, latest wins, per-source caps, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key. Tasks pass on one row per key: the limit goes below the shuffle."""
    return top_rows(rows, keys, 1, *order)


def latest_wins(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key in the given order: an upsert's outcome."""
    return top_rows(rows, keys, 1, *[F.col(c).desc() for c in order])


def top_rows(rows: DataFrame, keys: list[str], n: int, *order: Column | str) -> DataFrame:
    """The first n rows of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def per_source_top(rows: DataFrame, source: str, n_sources: int, limit: int, *order: Column | str) -> DataFrame:
    """At most ceil(limit / n_sources) rows of each source, in order."""
    return top_rows(rows, [source], -(-max(1, limit) // n_sources), *order)


def not_yet(rows: DataFrame, stored: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Rows whose key isn't stored, first of each: what an insert-or-ignore adds."""
    return first_wins(rows.join(stored.select(*keys), keys, "left_anti"), keys, *order)


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], *order: str, fixed: tuple[str, ...] = ()) -> DataFrame:
    """Stored rows overwritten by incoming ones of equal key; ``fixed`` columns keep the stored value."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    out = latest_wins(both, keys, "_new", *order)
    if fixed:
        first = stored.select(*keys, *[F.col(c).alias(f"_{c}") for c in fixed])
        out = out.join(first, keys, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in fixed else F.col(c) for c in out.columns])
    return out.drop("_new")


def batch_ids(rows: DataFrame, size: int, order: str) -> DataFrame:
    """batch: the number of each row's batch of ``size`` rows in order.

    Ranges of the order are numbered in parallel; only their counts meet in one place.
    """
    parts = rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    counts = parts.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return parts.withColumn("_place", place).join(F.broadcast(counts), "_part").withColumn("batch", F.floor((F.col("_place") + F.col("_before")) / size)).drop("_part", "_place", "_before", "count")


def keyset_page(rows: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next ``size`` rows after a key, in key order."""
    return rows.where(F.col(key) > after).orderBy(key).limit(size)
