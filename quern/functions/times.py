"""Time stamps as texts, their age, and what may be accepted as fresh."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import trimmed

#: A signal may be this old, and this far ahead of the clock; both ends count.
OLDEST, AHEAD = "INTERVAL '24' HOUR", "INTERVAL '5' MINUTE"


def parse_absolute(text: Column, assume_utc: bool = False) -> Column:
    """A text as a time: epoch seconds, ISO-8601, or the mail form. Null if it is none of these.

    ISO texts without a zone are null unless ``assume_utc``. The session's zone is taken to be UTC.
    """
    t = trimmed(text)
    epoch = F.timestamp_seconds(F.when(t.rlike(r"^-?\d{1,11}(\.\d+)?$"), t).try_cast("double"))
    zoned = t.rlike(r"(?i)[T ]\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$")
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.when(zoned | F.lit(assume_utc), t).try_cast("timestamp"))
    mail = F.regexp_replace(t, r"^[A-Za-z]{3}, ", "")
    rfc = F.coalesce(F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss xx")), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss z")))
    return F.coalesce(epoch, iso, F.when(t.rlike(r"^\d{1,2} |^[A-Za-z]{3}, "), rfc))


def parse_relative(text: Column, fetched_at: Column) -> Column:
    """struct(published_at, method, confidence): ISO with a zone is certain, "3 hours ago" counts from
    the fetch, all else is not a time."""
    t = F.coalesce(trimmed(text), F.lit(""))
    ago = r"(?i)^(?:about )?(\d+) (minute|hour)s? ago$"
    n = F.regexp_extract(t, ago, 1).try_cast("int")
    hours = F.lower(F.regexp_extract(t, ago, 2)) == "hour"
    back = F.make_dt_interval(F.lit(0), F.when(hours, n).otherwise(0), F.when(hours, 0).otherwise(n), F.lit(0))
    iso = t.try_cast("timestamp")
    is_iso = t.rlike(r"^\d{4}-\d{2}-\d{2}") & iso.isNotNull()
    zoned = t.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & t.rlike(r"\d{2}:\d{2}:\d{2}|T\d{2}:\d{2}")
    none = F.lit(None).cast("timestamp")

    def row(at: Column, method: str, confidence: float) -> Column:
        return F.struct(at.alias("published_at"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))

    return (
        F.when(t == "", row(none, "missing", 0.0))
        .when(is_iso & zoned, row(iso, "iso_8601", 1.0))
        .when(is_iso, row(none, "iso_without_timezone", 0.0))
        .when(t.rlike(ago), row(fetched_at - back, "relative_unit", 0.9))
        .otherwise(row(none, "unparsed", 0.0))
    )


def freshness(published_at: Column, fetched_at: Column, confidence: Column) -> Column:
    """struct(status, accepted): no time or one too far ahead is uncertain, one too old is stale."""
    status = (
        F.when(published_at.isNull() | (published_at > fetched_at + F.expr(AHEAD)), "UNCERTAIN")
        .when(published_at < fetched_at - F.expr(OLDEST), "STALE")
        .when(confidence >= 0.99, "VERIFIED")
        .otherwise("INFERRED")
    )
    return F.struct(status.alias("status"), (status.isin("VERIFIED", "INFERRED") & (confidence >= 0.85)).alias("accepted"))


def first_seen(previous_scan_at: Column, seen_before: Column, after_head: Column, fetched_at: Column) -> Column:
    """struct(status, accepted) of an item without a date: new since a recent scan, it is as old as the fetch at most."""
    enough = previous_scan_at.isNotNull() & ~seen_before & after_head
    recent = (previous_scan_at <= fetched_at) & (previous_scan_at >= fetched_at - F.expr(OLDEST))
    fine = F.coalesce(enough & recent, F.lit(False))
    return F.struct(F.when(fine, "INFERRED").otherwise("UNCERTAIN").alias("status"), fine.alias("accepted"))
