"""Queries of the streaming operators over logs that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sinks.shared import scratch
from quern.sources.bodies import RawBodies, append_bodies
from quern.sources.records import table
from quern.streaming import leases, sightings

_LOG = "item long, at timestamp, seq long, kind string, owner string, error string"


def _lease_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a work log of a queue with one item a user, stored as four spans of time and a late clock row."""
    kind = F.create_map(*map(F.lit, ["view", "claim", "click", "claim", "purchase", "ok", "error", "error", "signup", "error"]))
    k = F.get_json_object("props", "$.k").cast("int") % 2
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("item"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), kind[F.col("event_type")].alias("kind"), F.concat(F.lit("w"), k.cast("string")).alias("owner"), F.lit(None).cast("string").alias("error"))
    where = scratch(spark)
    for part in range(4):
        log.where(F.floor((F.day("at") - 1) / 8) == part).write.mode("append").parquet(where)
    clock = spark.range(1).select(F.lit(None).cast("long").alias("item"), F.lit("2025-01-01").cast("timestamp").alias("at"), F.lit(-1).cast("long").alias("seq"), F.lit("clock").alias("kind"), *[F.lit(None).cast("string").alias(c) for c in ("owner", "error")])
    clock.write.mode("append").parquet(where)
    # two spans a trigger, however many files a span has
    files = len(spark.read.schema(_LOG).parquet(where).inputFiles())
    return spark.readStream.schema(_LOG).option("maxFilesPerTrigger", max(2, files // 2)).parquet(where)


def _leased(spark: SparkSession, sf_dir: str) -> str:
    where = scratch(spark)
    leases.run_leases(_lease_log(spark, sf_dir), f"{where}/t", f"{where}/c", 43_200, "9 days")
    return f"{where}/t"


def stream_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transition of the queue."""
    rows = spark.read.schema(leases.TRANSITIONS.format("long")).parquet(f"{_leased(spark, sf_dir)}/transitions")
    return rows.select("item", F.unix_millis("at").alias("ms"), F.coalesce("seq", F.lit(-1).cast("long")).alias("seq"), "event", "status", "attempts", "owner")


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queue's pass put aside."""
    rows = spark.read.schema("item long, at timestamp, attempts int, owner string, error string").parquet(f"{_leased(spark, sf_dir)}/dead")
    return rows.select("item", F.unix_millis("at").alias("ms"), "attempts", "owner")


_BODY = "page long, address string, body string"


def _body_log(spark: SparkSession, sf_dir: str) -> str:
    """The pages as a log of raw bodies in three batches."""
    spark.dataSource.register(RawBodies)
    where = scratch(spark)
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.col("url").alias("address"), F.col("html").alias("body"))
    for number in range(3):
        append_bodies(pages.where(F.pmod(F.coalesce("page", F.lit(0)), F.lit(3)) == number), where, number)
    return where


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("page").alias("page_id"), "address", F.length("body").cast("long").alias("n_chars"), F.sha2("body", 256).alias("body_sha256"))


def raw_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored body, read from its log by the data source."""
    return _digests(spark.read.format("raw_bodies").schema(_BODY).load(_body_log(spark, sf_dir)))


def raw_body_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stream over the log."""
    where = scratch(spark)
    rows = _digests(spark.readStream.format("raw_bodies").schema(_BODY).load(_body_log(spark, sf_dir)))
    rows.writeStream.format("parquet").option("checkpointLocation", f"{where}/c").trigger(availableNow=True).start(f"{where}/t").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{where}/t")


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision for each user's first sight in half-daily scans of seven sources; one source skips every other day."""
    at = F.timestamp_seconds((F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 43_200) + 1) * 43_200)
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")).alias("source"), at.alias("scan_at"), F.col("user_id").cast("long").alias("item"), F.col("event_id").cast("long").alias("ord"))
    rows = rows.where("not (source = 's3' and day(scan_at) % 2 = 0)")
    where, none = scratch(spark), F.lit(None).cast("long")
    marks = rows.groupBy("source", "scan_at").agg(none.alias("item"), F.max("ord").alias("ord"))
    clock = spark.range(1).select(F.lit(None).cast("string").alias("source"), F.lit("2025-01-01").cast("timestamp").alias("scan_at"), none.alias("item"), none.alias("ord"))
    for k in range(3):
        rows.unionByName(marks).where(F.floor((F.day("scan_at") - 1) / 11) == k).write.mode("append").parquet(where)
    clock.write.mode("append").parquet(where)
    log = spark.readStream.schema("source string, scan_at timestamp, item long, ord long").option("maxFilesPerTrigger", 4).parquet(where)
    out = scratch(spark)
    # the scans aren't in order of time within the files: all of a month may be late
    sightings.run_first_seen(log, f"{out}/t", f"{out}/c", "40 days", 86_400, 4)
    done = spark.read.schema(sightings.DECISIONS.format("string", "long")).parquet(f"{out}/t")
    return done.select("source", F.unix_millis("scan_at").alias("ms"), "item", "ord", "status", "method", "accepted")


LEASES = """WITH RECURSIVE e AS (SELECT user_id AS item, (epoch_us(ts) // 1000) AS ms, event_id AS seq, 'w' || (CAST(json_extract_string(props, '$.k') AS INT) % 2) AS who,
        CASE event_type WHEN 'view' THEN 'claim' WHEN 'click' THEN 'claim' WHEN 'purchase' THEN 'ok' ELSE 'error' END AS kind, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS n FROM events),
    r AS (SELECT item, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS ms, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS who, CAST(NULL AS VARCHAR) AS event, 'PENDING' AS status, 0 AS attempts, CAST(NULL AS VARCHAR) AS owner,
            CAST(0 AS BIGINT) AS expires, CAST(0 AS BIGINT) AS due, false AS ran, CAST(NULL AS VARCHAR) AS gone, CAST(0 AS BIGINT) AS gone_at FROM (SELECT DISTINCT item FROM e)
        UNION ALL
        SELECT item, n, ms, seq, who, event,
            CASE event WHEN 'claimed' THEN 'LEASED' WHEN 'done' THEN 'DONE' WHEN 'retry' THEN 'PENDING' WHEN 'dead' THEN 'DEAD' ELSE s END, CASE WHEN event = 'claimed' THEN attempts + 1 ELSE attempts END,
            CASE event WHEN 'claimed' THEN who WHEN 'done' THEN NULL WHEN 'retry' THEN NULL WHEN 'dead' THEN NULL ELSE o END, CASE WHEN event = 'claimed' THEN ms + 43200000 ELSE expires END,
            CASE WHEN event = 'retry' THEN ms + CAST(least(300, pow(2, greatest(0, attempts - 1))) * 1000 AS BIGINT) ELSE d END, ran, gone, gone_at
        FROM (SELECT *, CASE WHEN kind = 'claim' AND s = 'PENDING' AND d <= ms THEN 'claimed' WHEN kind = 'claim' THEN 'refused' WHEN s <> 'LEASED' OR o <> who THEN 'foreign' WHEN kind = 'ok' THEN 'done'
                    WHEN attempts < 4 THEN 'retry' ELSE 'dead' END AS event
              FROM (SELECT e.*, r.attempts, r.expires, r.status = 'LEASED' AND r.expires < e.ms AS ran, r.owner AS gone, r.expires AS gone_at,
                        CASE WHEN r.status = 'LEASED' AND r.expires < e.ms THEN 'PENDING' ELSE r.status END AS s, CASE WHEN r.status = 'LEASED' AND r.expires < e.ms THEN NULL ELSE r.owner END AS o,
                        CASE WHEN r.status = 'LEASED' AND r.expires < e.ms THEN r.expires ELSE r.due END AS d
                    FROM r JOIN e ON e.item = r.item AND e.n = r.n + 1))),
    t AS (SELECT item, ms, seq, event, status, attempts, who AS owner FROM r WHERE n > 0
        UNION ALL SELECT item, gone_at, -1, 'expired', 'PENDING', attempts - CASE WHEN event = 'claimed' THEN 1 ELSE 0 END, gone FROM r WHERE ran
        UNION ALL SELECT item, expires, -1, 'expired', 'PENDING', attempts, owner FROM r WHERE status = 'LEASED' AND n = (SELECT max(n) FROM e WHERE e.item = r.item))
    """
_BODIES = "SELECT page_id, url AS address, length(html) AS n_chars, sha256(html) AS body_sha256 FROM pages"
SQL = {
    "raw_bodies": _BODIES,
    "raw_body_stream": _BODIES,
    "stream_leases": LEASES + "SELECT item, ms, seq, event, status, CAST(attempts AS INT) AS attempts, owner FROM t",
    "stream_dead_letters": LEASES + "SELECT item, ms, CAST(attempts AS INT) AS attempts, owner FROM t WHERE event = 'dead'",
    "stream_first_seen": """WITH r AS (SELECT 's' || (user_id % 7) AS source, (epoch_us(ts) // 43200000000 + 1) * 43200000 AS ms, CAST(user_id AS BIGINT) AS item, CAST(event_id AS BIGINT) AS ord FROM events),
        sight AS (SELECT source, ms, item, max(ord) AS ord FROM r WHERE NOT (source = 's3' AND day(epoch_ms(ms)) % 2 = 0) GROUP BY ALL),
        scan AS (SELECT source, ms, lag(ms) OVER w AS before, lag(max(ord)) OVER w AS head FROM sight GROUP BY source, ms WINDOW w AS (PARTITION BY source ORDER BY ms)),
        d AS (SELECT s.*, before, head < s.ord AND NOT EXISTS (SELECT 1 FROM sight p WHERE p.source = s.source AND p.item = s.item AND p.ms = before) AS enough FROM sight s JOIN scan USING (source, ms)),
        m AS (SELECT *, CASE WHEN NOT coalesce(enough AND ms - before <= 172800000, false) THEN 'first_seen_insufficient_evidence' WHEN ms - before > 86400000 THEN 'first_seen_scan_gap' ELSE 'first_seen_after_previous_head' END AS method FROM d)
        SELECT source, ms, item, ord, CASE WHEN method LIKE '%head' THEN 'INFERRED' ELSE 'UNCERTAIN' END AS status, method, method LIKE '%head' AS accepted FROM m""",
}
QUERIES = [stream_leases, stream_dead_letters, stream_first_seen, raw_bodies, raw_body_stream]
