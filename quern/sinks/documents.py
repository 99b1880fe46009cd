"""Whole public documents of records and back: JSON out, VARIANT in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types of records and methods of evidence.
TYPES = ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS"]
METHODS = ["api", "feed", "json_ld", "meta", "page_text", "llm", "inferred"]

VERSION = "1.1"


def iso(at: Column) -> Column:
    """ISO 8601 with an offset; fractions of a second only where there are any."""
    whole = F.date_trunc("second", at) == at
    return F.when(whole, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def public_document() -> Column:
    """The public camel-case JSON of a record's columns, as ``public_documents`` has them."""
    proofs = F.transform("evidence", lambda e: F.struct(e["field"].alias("field"), e["method"].alias("method"), e["source_url"].alias("sourceUrl"), e["source_pointer"].alias("sourcePointer"), e["excerpt"].alias("excerpt"), e["confidence"].alias("confidence")))
    source = F.struct(F.col("source.name").alias("name"), F.col("source.url").alias("url"), iso(F.col("source.retrieved_at")).alias("retrievedAt"), F.col("source.content_hash").alias("contentHash"))
    doc = F.struct(
        F.col("schema_version").alias("schemaVersion"), F.col("record_key").alias("recordKey"), F.col("record_type").alias("recordType"), source.alias("source"),
        F.col("content"), proofs.alias("evidence"), iso(F.col("collected_at")).alias("collectedAt"),
    )
    return F.to_json(doc, {"ignoreNullFields": "false"})


def public_documents(records: DataFrame) -> DataFrame:
    """record_key, document: the public camel-case JSON of each record.

    Records: record_key, record_type, schema_version, source (name, url, retrieved_at, content_hash), content (a
    VARIANT object), evidence (array of field, method, source_url, source_pointer, excerpt, confidence), collected_at.
    """
    return records.select("record_key", public_document().alias("document"))


#: An object's parts, all taken in one pass: what has an older name, or says something by a null, as it is.
_SOURCE = "struct<name string, url string, retrievedAt variant, retrieved_at variant, contentHash variant, content_hash variant>"
_PROOF = "struct<field string, method string, sourceUrl variant, source_url variant, sourcePointer variant, source_pointer variant, excerpt string, confidence variant>"
_PARTS = (
    "struct<schemaVersion variant, schema_version variant, recordKey variant, record_key variant, recordType variant, record_type variant, "
    f"collectedAt variant, collected_at variant, content variant, source {_SOURCE}, evidence array<{_PROOF}>>"
)


def _either(of: Column, camel: str, snake: str) -> Column:
    """A part's text; the camel-case name counts if it is there, even with a null."""
    return _text(F.coalesce(of[camel], of[snake]))


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def hydrated_records(documents: DataFrame, carried: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Records of JSON documents (document), in camel or older snake case; and those put aside (document, reason).

    A document is parsed once. Content keeps all its values and kinds. Evidence that isn't an object is passed
    over; a missing confidence is 1, a missing version 1.0. Aside go what isn't JSON or no object, a type or a method
    of evidence that isn't known, a confidence outside 0 to 1, and a missing key, source name, address or time.
    Records keep the ``carried`` columns of their documents.
    """
    p = F.col("p")
    # one-row explodes: what is computed in them isn't computed again for each use
    read = documents.select("document", *carried, F.explode(F.array(F.try_parse_json("document"))).alias("v"))
    read = read.select("document", *carried, F.col("v").isNull().alias("unread"), F.explode(F.array(F.try_variant_get("v", "$", _PARTS))).alias("p"))

    def proof(e: Column) -> Column:
        given = e["confidence"]
        return F.struct(
            e["field"].alias("field"), e["method"].alias("method"), _either(e, "sourceUrl", "source_url").alias("source_url"), _either(e, "sourcePointer", "source_pointer").alias("source_pointer"),
            e["excerpt"].alias("excerpt"), F.when(given.isNull(), 1.0).otherwise(F.try_variant_get(given, "$", "double")).alias("confidence"),
        )

    s, content = p["source"], p["content"]
    source = F.struct(s["name"].alias("name"), s["url"].alias("url"), _either(s, "retrievedAt", "retrieved_at").try_cast("timestamp").alias("retrieved_at"), _either(s, "contentHash", "content_hash").alias("content_hash"))
    fields = [
        F.col("unread"), p.isNotNull().alias("whole"), _either(p, "recordKey", "record_key").alias("record_key"), _either(p, "recordType", "record_type").alias("record_type"), F.coalesce(F.nullif(_either(p, "schemaVersion", "schema_version"), F.lit("")), F.lit("1.0")).alias("schema_version"),
        source.alias("source"), F.when(F.try_variant_get(content, "$", "struct<>").isNotNull(), content).otherwise(F.parse_json(F.lit("{}"))).alias("content"),
        F.coalesce(F.transform(F.filter(p["evidence"], lambda e: e.isNotNull()), proof), F.array().cast("array<struct<field:string,method:string,source_url:string,source_pointer:string,excerpt:string,confidence:double>>")).alias("evidence"),
        _either(p, "collectedAt", "collected_at").try_cast("timestamp").alias("collected_at"),
    ]
    records = read.select("document", *carried, F.inline(F.array(F.struct(*fields))))
    sound = lambda x: F.coalesce(x, F.lit(False))
    reason = (
        F.when(F.col("unread"), "not_json").when(~F.col("whole"), "not_object").when(F.col("record_key").isNull(), "record_key").when(~sound(F.col("record_type").isin(TYPES)), "record_type")
        .when(F.col("source.name").isNull() | F.col("source.url").isNull(), "source").when(F.col("source.retrieved_at").isNull() | F.col("collected_at").isNull(), "time")
        .when(F.exists("evidence", lambda e: ~sound(e["method"].isin(METHODS)) | e["field"].isNull()), "evidence").when(F.exists("evidence", lambda e: ~sound(e["confidence"].between(0.0, 1.0))), "confidence")
    )
    judged = records.withColumn("reason", reason)
    return judged.where("reason is null").drop("document", "unread", "whole", "reason"), judged.where("reason is not null").select("document", "reason")
