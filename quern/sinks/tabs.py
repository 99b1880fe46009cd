"""Flat tabs of public documents: one row a record, nested routes as columns, clean cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import without_controls

_HEAD = ["schemaVersion", "recordType", "source.name", "source.url"]
_TAIL = ["collectedAt", "source.contentHash", "recordKey"]
# The routes of each tab, in the order of its columns.
TABS = {
    "STARTUP": [*_HEAD, "content.entityName", "content.rawEntityName", "content.data.employeeCount", "content.website", "content.description", "content.batch", "content.status", "content.tags", *_TAIL],
    "PRODUCT": [
        *_HEAD, "content.productName", "content.startupName", "content.rawStartupName", "content.pricingModel", "content.accessModel", "content.sdk", "content.likes", "content.description", "content.tags",
        "content.createdAt", "content.lastModified", *_TAIL,
    ],
    "RESEARCH_PAPER": [
        *_HEAD, "content.title", "content.authors", "content.paper_url", "content.github_url", "content.github_stars", "content.github_stars_collected_at", "content.github_stars_source", "content.published_date",
        "content.abstract", *_TAIL,
    ],
    "JOB": [
        *_HEAD, "content.company", "content.rawCompany", "content.title", "content.date", "content.is_remote", "content.role_family", "content.location", "content.full_text", "content.freshness_status",
        "content.freshness_method", "content.freshness_confidence", *_TAIL,
    ],
    "NEWS": [*_HEAD, "content.title", "content.publisher", "content.authors", "content.published_at", "content.full_text", "content.freshness_status", "content.freshness_method", "content.freshness_confidence", *_TAIL],
}
# Routes that hold numbers, shares, flags and times; the others are texts.
WHOLE = ["content.data.employeeCount", "content.likes", "content.github_stars"]
SHARE = ["content.freshness_confidence"]
FLAG = ["content.is_remote"]
TIME = ["collectedAt", "content.createdAt", "content.lastModified", "content.github_stars_collected_at", "content.published_date", "content.date", "content.published_at"]


def column_name(route: str) -> str:
    return route.removeprefix("content.").replace(".", "_")


def cell(v: Column, route: str) -> Column:
    """A route's value in a document (VARIANT). A part that is missing on the way gives an empty text, a false flag, else null.

    Lists are joined by a comma and a blank, their nulls as empty; times that parse are written alike, others stay as they are.
    """
    path = f"$.{route}"
    if route in WHOLE:
        return F.try_variant_get(v, path, "bigint")
    if route in SHARE:
        return F.try_variant_get(v, path, "double")
    if route in FLAG:
        return F.coalesce(F.try_variant_get(v, path, "boolean"), F.lit(False))
    text = F.try_variant_get(v, path, "string")
    if route in TIME:
        return F.nullif(F.coalesce(F.date_format(text.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), without_controls(text)), F.lit(""))
    listed = F.try_variant_get(v, path, "array<variant>")
    joined = F.array_join(F.transform(listed, lambda e: F.coalesce(F.try_variant_get(e, "$", "string"), F.lit(""))), ", ")
    return without_controls(F.coalesce(joined, text, F.lit("")))


def tab(documents: DataFrame, record_type: str) -> DataFrame:
    """The rows of one type's tab; a document (document) is parsed once, one that isn't an object of the type has no row."""
    # a one-row explode: the parsed document isn't computed again for each column
    read = documents.select(F.explode(F.array(F.try_parse_json("document"))).alias("v"))
    own = read.where(F.try_variant_get("v", "$.recordType", "string") == record_type)
    return own.select(*[cell(F.col("v"), r).alias(column_name(r)) for r in TABS[record_type]])


def mapping_tab(log: DataFrame) -> DataFrame:
    """The mapping log's tab; a name without a canonical one has an empty cell."""
    texts = [without_controls(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("raw_name", "normalized_name", "canonical_name", "method")]
    return log.select(*texts, "confidence", "status", "resolver_version")
