"""Job boards: raw JSON bodies of five shapes to one typed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import canonical_url, stable_key
from quern.functions.text import infer_remote, role_family
from quern.functions.times import parse_absolute

# Where each board keeps its items, and which of an item's names holds what.
BOARDS = {
    "arbeitnow": {"items": "$.data", "id": "slug", "title": "title", "company": "company_name", "url": "url", "description": "description", "location": "location", "published": "created_at", "remote": "remote"},
    "remoteok": {"items": "$", "id": "id", "title": "position", "company": "company", "url": "url", "description": "description", "location": "location", "published": "date"},
    "jobicy": {"items": "$.jobs", "id": "id", "title": "jobTitle", "company": "companyName", "url": "url", "description": "jobDescription", "location": "jobGeo", "published": "pubDate", "assume_utc": True},
    "himalayas": {"items": "$.jobs", "id": "guid", "title": "title", "company": "companyName", "url": "applicationLink", "description": "description", "location": "locationRestrictions", "published": "pubDate"},
    "remotive": {"items": "$.jobs", "id": "id", "title": "title", "company": "company_name", "url": "url", "description": "description", "location": "candidate_required_location", "published": "publication_date", "assume_utc": True},
}


def items(raw: DataFrame, board: str) -> DataFrame:
    """One JSON text per item of a board's bodies; bodies that don't parse have none."""
    path = BOARDS[board]["items"]
    listed = F.from_json(F.get_json_object("body", path), "array<string>")
    return raw.where(F.col("board") == board).select("board", F.posexplode(listed).alias("pos", "item"))


def normalized(raw: DataFrame, board: str) -> DataFrame:
    """The unified columns of one board; items without id, title or url go."""
    names = BOARDS[board]

    def value(name: str) -> Column:
        return F.get_json_object("item", f"$.{names[name]}") if name in names else F.lit(None).cast("string")

    location = F.coalesce(value("location"), F.lit(""))
    as_list = F.array_join(F.from_json(location, "array<string>"), ", ")
    location = F.when(F.startswith(location, F.lit("[")), as_list).otherwise(location)
    published = parse_absolute(value("published"), bool(names.get("assume_utc")))
    rows = items(raw, board).select(
        "board", "pos", value("id").alias("source_id"), value("title").alias("title"), F.coalesce(F.nullif(value("company"), F.lit("")), F.lit("Unknown")).alias("company"),
        value("url").alias("url"), F.coalesce(value("description"), F.lit("")).alias("description"), location.alias("location"),
        infer_remote(location, value("remote").try_cast("boolean")).alias("is_remote"), published.alias("published_at"),
    )
    wanted = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("source_id", "title", "url")]
    return rows.where(wanted[0] & wanted[1] & wanted[2])


def jobs(raw: DataFrame) -> DataFrame:
    """All boards' rows, with a stable key and the role family."""
    out = None
    for board in BOARDS:
        rows = normalized(raw, board)
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("record_key", stable_key(F.lit("job"), canonical_url(F.col("url")))).withColumn("role_family", role_family(F.col("title")))
