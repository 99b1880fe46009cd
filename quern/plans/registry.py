"""All registered queries of the library's record operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.plans import entities, records, streams, tables, values

MODULES = [records, values, tables, entities, streams]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for m in MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.quality_report(spark, sf_dir)
