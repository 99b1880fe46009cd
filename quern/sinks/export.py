"""Sinks: write-once raw bodies, record files by type, a manifest, flat tabs, and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quern.functions.keys import content_hash
from quern.functions.text import without_controls


def new_bodies(raw: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """content_hash, prefix, body of bodies not stored yet, once each."""
    rows = raw.select(content_hash(F.col("body")).alias("content_hash"), "body").dropDuplicates(["content_hash"])
    rows = rows.join(stored.select("content_hash"), "content_hash", "left_anti") if stored is not None else rows
    return rows.withColumn("prefix", F.substring("content_hash", 1, 2))


def store_bodies(raw: DataFrame, path: str, stored: DataFrame | None = None) -> None:
    """Appends new bodies under the first two digits of their hash."""
    new_bodies(raw, stored).write.mode("append").partitionBy("prefix").parquet(path)


def write_records(records: DataFrame, path: str) -> None:
    """JSON lines, one folder per record type."""
    records.write.mode("overwrite").partitionBy("record_type").json(path)


def write_lines(rows: DataFrame, path: str) -> int:
    """JSON lines; the number of rows, counted as they are written. An empty table still leaves a folder."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    return seen.get["rows"]


def manifest(records: DataFrame) -> DataFrame:
    """record_type, records, first_key, last_key."""
    return records.groupBy("record_type").agg(F.count("*").alias("records"), F.min("record_key").alias("first_key"), F.max("record_key").alias("last_key"))


def exported(records: DataFrame, path: str, types: list[str]) -> list[tuple[str, int, str, str]]:
    """Writes JSON lines by record type, and counts them in the same pass: (record_type, records, first_key, last_key) of
    those that are there. ``types`` are all that can be."""
    seen, kind = Observation(), F.col("record_type")
    facts = [f(F.when(kind == t, F.col("record_key"))).alias(f"{name}_{k}") for k, t in enumerate(types) for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    write_records(records.observe(seen, *facts), path)
    got = seen.get
    return [(t, got[f"n_{k}"], got[f"lo_{k}"], got[f"hi_{k}"]) for k, t in enumerate(types) if got[f"n_{k}"]]


def flat(records: DataFrame, fields: list[str]) -> DataFrame:
    """The named content fields as clean text columns, one row per record."""
    return records.select("record_key", *[without_controls(F.coalesce(F.col("content")[f], F.lit(""))).alias(f) for f in fields])


def public(record_columns: DataFrame) -> DataFrame:
    """record_key, document: the public camel-case JSON of each record."""
    evidence = F.transform("evidence", lambda e: F.struct(e["field"].alias("field"), e["method"].alias("method"), e["source_url"].alias("sourceUrl"), e["source_pointer"].alias("sourcePointer")))
    doc = F.struct(
        F.lit("1.1").alias("schemaVersion"), F.col("record_key").alias("recordKey"), F.col("record_type").alias("recordType"),
        F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url")).alias("source"), F.col("content"), evidence.alias("evidence"),
    )
    return record_columns.select("record_key", F.to_json(doc).alias("document"))


def hydrated(documents: DataFrame) -> DataFrame:
    """record_key, record_type, schema_version, source_url of JSON documents in camel or older snake case.

    The camel-case name counts if it is there, even when null.
    """
    keys = F.json_object_keys("document")

    def either(camel: str, snake: str):
        return F.when(F.array_contains(keys, camel), F.get_json_object("document", f"$.{camel}")).otherwise(F.get_json_object("document", f"$.{snake}"))

    return documents.select(
        either("recordKey", "record_key").alias("record_key"), either("recordType", "record_type").alias("record_type"),
        F.coalesce(either("schemaVersion", "schema_version"), F.lit("1.0")).alias("schema_version"), F.get_json_object("document", "$.source.url").alias("source_url"),
    )
