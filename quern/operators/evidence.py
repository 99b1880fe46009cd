"""The evidence gate: what a record states must be proven field by field.

Records carry ``content`` (map of field to text) and ``evidence`` (array of structs with field, method,
source_url, source_pointer, excerpt, confidence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import populated

# The fields that each type of record must fill.
REQUIRED_FIELDS = {
    "STARTUP": ["entityName", "rawEntityName"],
    "PRODUCT": ["productName", "startupName", "rawStartupName"],
    "RESEARCH_PAPER": ["title", "authors", "paper_url", "published_date", "github_url", "github_stars"],
    "JOB": ["company", "rawCompany", "title", "date", "is_remote", "role_family", "full_text"],
    "NEWS": ["title", "publisher", "published_at", "full_text"],
}


def populated_fields(content: Column) -> Column:
    """Names of the filled fields, in order."""
    return F.array_sort(F.map_keys(F.map_filter(content, lambda _, v: populated(v))))


def proven_fields(evidence: Column) -> Column:
    """Names of the fields with evidence that names its source, in order."""
    sourced = F.filter(evidence, lambda e: F.coalesce(e["source_url"] != "", F.lit(False)))
    return F.array_sort(F.array_distinct(F.transform(sourced, lambda e: e["field"])))


def missing_fields(record_type: Column, content: Column) -> Column:
    """Required fields that aren't filled."""
    needed = F.lit(None).cast("array<string>")
    for kind, fields in REQUIRED_FIELDS.items():
        needed = F.when(record_type == kind, F.array(*map(F.lit, fields))).otherwise(needed)
    return F.array_except(F.coalesce(needed, F.array().cast("array<string>")), populated_fields(content))


def unproven_fields(content: Column, evidence: Column, exempt: tuple[str, ...] = ()) -> Column:
    """Filled fields without evidence; in the row itself, without a join."""
    return F.array_except(populated_fields(content), F.concat(proven_fields(evidence), F.array(*map(F.lit, exempt)).cast("array<string>")))


def gate(records: DataFrame, exempt: tuple[str, ...] = ()) -> DataFrame:
    """``unproven`` and ``accepted`` beside each record: failing records go aside, none stops the batch."""
    unproven = unproven_fields(F.col("content"), F.col("evidence"), exempt)
    return records.withColumn("unproven", unproven).withColumn("accepted", F.size("unproven") == 0)


def replaced(evidence: Column, fields: list[str], fresh: Column) -> Column:
    """Evidence of the named fields gives way to fresh evidence at the end."""
    return F.concat(F.filter(evidence, lambda e: ~e["field"].isin(fields)), fresh)


def quoted(document: Column, quote: Column) -> Column:
    """The quote, trimmed, isn't empty and stands in the document as it is."""
    q = F.regexp_replace(quote, r"^\s+|\s+$", "")
    return F.coalesce((q != "") & F.contains(document, q), F.lit(False))
