"""The quality report in one pass, and the rules that gate a submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import is_web_url
from quern.functions.text import trimmed
from quern.operators.evidence import missing_fields, unproven_fields

# The pricing models that a product may have.
PRICING = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
# What a stored record, its source and each proof must have.
ENVELOPE = ["schemaVersion", "recordKey", "recordType", "collectedAt"]
SOURCE = ["name", "url", "retrievedAt", "contentHash"]
PROOF = ["field", "method", "sourceUrl", "sourcePointer"]
CATALOG, SIGNALS = ["STARTUP", "PRODUCT", "RESEARCH_PAPER"], ["JOB", "NEWS"]


def _outside(at: Column, now: Column) -> Column:
    return ~at.between(now - F.expr("INTERVAL '24' HOUR"), now + F.expr("INTERVAL '5' MINUTE"))


def error_flags(now: Column) -> dict[str, Column]:
    """One flag per error code, of a record with record_type, source_url, content, evidence."""
    kind, content = F.col("record_type"), F.col("content")
    date = F.when(kind == "JOB", content["date"]).when(kind == "NEWS", content["published_at"]).try_cast("timestamp")
    measured = content["github_stars_collected_at"].try_cast("timestamp")
    name = F.lower(trimmed(content["productName"]))
    signal, paper, product = kind.isin(SIGNALS), kind == "RESEARCH_PAPER", kind == "PRODUCT"
    flags = {
        "invalid_source_url": ~is_web_url(F.col("source_url")),
        "missing_required_fields": F.size(missing_fields(kind, content)) > 0,
        "fields_without_evidence": F.size(unproven_fields(content, F.col("evidence"))) > 0,
        "schema_contract_mismatch": F.exists("evidence", lambda e: e["field"].isNull() | e["method"].isNull() | e["source_pointer"].isNull()),
        "outside_24h_window": signal & _outside(date, now),
        "invalid_freshness_date": signal & date.isNull(),
        "product_company_name_collision": product & (name != "") & (name == F.lower(trimmed(content["startupName"]))),
        "invalid_pricing_model": product & content["pricingModel"].isNotNull() & ~content["pricingModel"].isin(PRICING),
        "github_stars_not_direct": paper & ~F.coalesce(content["github_stars_source"] == "github_graphql", F.lit(False)),
        "github_stars_stale": paper & _outside(measured, now),
        "github_stars_timestamp_invalid": paper & measured.isNull(),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}


def _lacks(keys: Column, needed: list[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, needed)), F.coalesce(keys, F.array().cast("array<string>")))) > 0


def contract_breaks(document: Column) -> Column:
    """How often a stored record (JSON) breaks the contract: in its envelope, its source, its evidence; 3 at most."""
    proofs = F.from_json(F.get_json_object(document, "$.evidence"), "array<map<string,string>>")
    parts = [
        _lacks(F.json_object_keys(document), ENVELOPE),
        _lacks(F.json_object_keys(F.get_json_object(document, "$.source")), SOURCE),
        F.coalesce(F.exists(proofs, lambda p: p.isNotNull() & _lacks(F.map_keys(p), PROOF)), F.lit(False)),
    ]
    return sum((p.cast("int") for p in parts), F.lit(0))


def type_mismatch(document: Column, record_type: Column) -> Column:
    """The stored record calls itself another type, or none."""
    return ~F.coalesce(F.get_json_object(document, "$.recordType") == record_type, F.lit(False))


def report(records: DataFrame, now: Column) -> DataFrame:
    """One row per record type: totals, distinct keys and addresses, pass rate, and every error's count.

    Records that carry their stored ``document`` are held to the contract part by part, up to three breaks each,
    and to their type's name. Distinct keys and addresses are counted apart, from narrow scans of their own.
    """
    web = is_web_url(F.col("source_url"))
    counted = {k: v.cast("long") for k, v in error_flags(now).items()}
    if "document" in records.columns:
        counted["schema_contract_mismatch"] = contract_breaks(F.col("document")).cast("long")
        counted["record_type_mismatch"] = type_mismatch(F.col("document"), F.col("record_type")).cast("long")
    else:
        counted["record_type_mismatch"] = F.lit(0).cast("long")
    flagged = records.select("record_type", web.alias("web"), *[v.alias(k) for k, v in counted.items()])
    counts = flagged.groupBy("record_type").agg(
        F.count("*").alias("total"),
        F.count_if("web").alias("valid_source_urls"),
        F.count_if(F.col("fields_without_evidence") == 0).alias("evidence_complete"),
        *[F.sum(k).alias(k) for k in counted],
    )

    def distinct(value: Column, name: str) -> DataFrame:
        return records.select("record_type", value.alias("value")).where("value is not null").distinct().groupBy("record_type").agg(F.count("*").alias(name))

    for value, name in ((F.nullif("record_key", F.lit("")), "unique_keys"), (F.when(web, F.col("source_url")), "unique_source_urls")):
        counts = counts.join(distinct(value, name), "record_type", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return counts.withColumn("duplicate_keys", F.col("total") - F.col("unique_keys")).withColumn("pass_rate", F.coalesce(F.round(F.try_divide("evidence_complete", "total"), 4), F.lit(0.0)))


def failures(reports: DataFrame, least: int | None = 1000) -> DataFrame:
    """record_type, rule for every rule that a report breaks. ``least`` bounds the catalog types' counts."""
    kind = F.col("record_type")
    rules = {
        "too_few": F.when(kind.isin(CATALOG), F.col("total") < least).otherwise(F.col("total") < 1) if least else F.lit(False),
        "invalid_urls": F.col("valid_source_urls") != F.col("total"),
        "without_evidence": F.col("evidence_complete") != F.col("total"),
        "incomplete": F.col("missing_required_fields") > 0,
        "duplicate_keys": F.col("duplicate_keys") > 0,
        "stale_signals": F.col("outside_24h_window") > 0,
        "invalid_dates": F.col("invalid_freshness_date") > 0,
        "contract": F.col("schema_contract_mismatch") > 0,
        "urls_not_unique": kind.isin(CATALOG) & (F.col("unique_source_urls") != F.col("total")),
        "relabelled_companies": (kind == "PRODUCT") & (F.col("product_company_name_collision") > 0.05 * F.col("total")),
        "pricing": F.col("invalid_pricing_model") > 0,
        "stars_not_direct": F.col("github_stars_not_direct") > 0,
        "stars_not_current": (F.col("github_stars_stale") > 0) | (F.col("github_stars_timestamp_invalid") > 0),
    }
    broken = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))
    return reports.select("record_type", F.explode(broken).alias("rule"))
