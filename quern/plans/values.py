"""Queries of the column functions: keys, addresses, texts, times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import keys, markup, text, times
from quern.operators import evidence, fragments, queue, quotes
from quern.operators.dedupe import first_wins
from quern.operators.enrich import fallback
from quern.plans.record_sql import NOW
from quern.sources.records import now, stamp, table


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", keys.content_hash(F.col("text")).alias("hash"))


def stable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", keys.stable_key(F.concat(F.lit(" "), F.upper("source")), F.concat("lang", F.col("doc_id").cast("string"), F.lit("\t"))).alias("key"))


def raw_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select(keys.content_hash(F.col("text")).alias("hash"), "doc_id")
    return hashed.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.regexp_replace("url", "^https", "HTTPS"), F.when(F.col("page_id") % 3 == 0, "#top").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir).select("page_id", keys.canonical_url(F.col("url")).alias("canonical"))


def valid_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("page_id") % 5 == 0, F.regexp_replace("url", "^[A-Za-z]+", "ftp")).when(F.col("page_id") % 7 == 0, "https://").otherwise(F.col("url"))
    return _urls(spark, sf_dir).select("page_id", keys.is_web_url(odd).alias("valid"))


def host_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(spark, sf_dir).groupBy(keys.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


def host_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = _urls(spark, sf_dir).where("page_id % 4 = 0").select(keys.host(F.col("url")).alias("host")).distinct()
    return _urls(spark, sf_dir).withColumn("host", keys.host(F.col("url"))).join(allowed, "host", "left_semi").select("page_id", "host")


def block_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("page_id") % 9 == 0, F.concat("html", F.lit("<p>Verify you are HUMAN</p>"))).otherwise(F.col("html"))
    kind = F.when(F.col("page_id") % 2 == 0, "text/html; charset=utf-8").otherwise("text/plain")
    return table(spark, sf_dir, "pages").select("page_id", text.is_blocked(kind, body).alias("blocked"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", markup.html_text("html").alias("visible"))


def relevance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(text.is_relevant(F.col("lang"), F.col("text"))).select("doc_id")


ROLES = ["Data Scientist", "ML Engineer", "Head of Growth", "Account Executive", "Chef", "Analytics Lead", "Product Designer"]


def role_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.element_at(F.array(*map(F.lit, ROLES)), (F.col("o_orderkey") % len(ROLES)).cast("int") + 1)
    return table(spark, sf_dir, "orders").groupBy(title.alias("title"), text.role_family(title).alias("family")).agg(F.count("*").alias("n"))


def infer_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.when(F.col("o_custkey") % 3 == 0, "Berlin / REMOTE").otherwise("Berlin")
    flag = F.when(F.col("o_orderkey") % 5 == 0, F.lit(False))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.infer_remote(place, flag).alias("remote"))


def collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.collapsed(F.col("text")), 256).alias("collapsed"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = F.concat("p_name", F.lit("\x01\x1f\t"), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", text.without_controls(dirty).alias("clean"))


def split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.concat("p_name", F.lit(" , ,"), F.col("p_brand"), F.lit(","), F.col("p_type"))
    parts = text.split_list(joined)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(parts).alias("n"), F.array_join(parts, "|").alias("parts"))


def tags_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array(F.col("p_brand"), F.lit(" "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.clean_tags(tags), "|").alias("tags"))


def int_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.first_int(F.col("p_brand")).alias("brand"), text.first_int(F.col("p_type")).alias("kind"))


def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.token_estimate(F.col("text")).alias("tokens"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.element_at(F.array(*map(F.lit, [", Inc.", " LLC", " Corporation Ltd", ""])), (F.col("c_custkey") % 4).cast("int") + 1)
    return table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", form).alias("name"))


def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("c_custkey", text.normalized_name(F.col("name")).alias("normalized"))


def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.explode(text.block_keys(text.normalized_name(F.col("name"))))
    return _names(spark, sf_dir).select(found.alias("block")).groupBy("block").agg(F.count("*").alias("n"))


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("https://github.com/own"), (F.col("doc_id") % 30).cast("string"), F.lit("/repo"), (F.col("doc_id") % 90).cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, url).alias("field"), F.when(F.col("doc_id") % 4 < 3, F.concat(F.lit("Code: "), url, F.lit(".git."))).alias("summary"))


def repo_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summaries(spark, sf_dir).select("doc_id", text.repo_url(F.col("field"), F.col("summary")).alias("repo"))


def group_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    repo = text.repo_parts(text.repo_url(F.col("field"), F.col("summary")))
    rows = _summaries(spark, sf_dir).select("doc_id", repo.alias("r")).where("r.owner is not null")
    return rows.groupBy("r.owner", "r.name").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


REPO = "CASE WHEN doc_id % 4 < 3 THEN 'https://github.com/own' || (doc_id % 30) || '/repo' || (doc_id % 90) END"
FORMS = "list_element([', Inc.', ' LLC', ' Corporation Ltd', ''], CAST(c_custkey % 4 AS INT) + 1)"
NORMAL = f"regexp_replace(array_to_string(regexp_extract_all(lower(c_name || {FORMS}), '[a-z0-9]+'), ' '), '(?:^| )(?:{'|'.join(text.LEGAL_FORMS)})(?: (?:{'|'.join(text.LEGAL_FORMS)}))*$', '')"


def parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    kind = F.col("event_id") % 5
    written = (
        F.when(kind == 0, F.unix_seconds(ts).cast("string")).when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(kind == 2, F.date_format(ts, "dd MMM yyyy HH:mm:ss '+0000'"))
        .when(kind == 3, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    )
    return table(spark, sf_dir, "events").select("event_id", stamp(times.parse_absolute(written)).alias("parsed"))


def relative_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("user_id") % 40).cast("string")
    kind = F.col("event_id") % 4
    said = F.when(kind == 0, F.concat(n, F.lit(" minutes ago"))).when(kind == 1, F.concat(F.lit("about "), n, F.lit(" hours ago"))).when(kind == 2, "yesterday")
    r = times.parse_relative(said, now())
    return table(spark, sf_dir, "events").select("event_id", r.alias("r")).select("event_id", stamp("r.published_at").alias("at"), "r.method", "r.confidence")


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = F.element_at(F.array(F.lit(1.0), F.lit(0.9), F.lit(0.5)), (F.col("event_id") % 3).cast("int") + 1)
    at = F.when(F.col("event_id") % 17 != 0, F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", at.alias("at"), conf.alias("confidence"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signals(spark, sf_dir).select("event_id", times.freshness(F.col("at"), now(), F.col("confidence")).alias("f")).select("event_id", "f.status", "f.accepted")


def freshness_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(spark, sf_dir).where("accepted").select("event_id", "status")


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    head = now() - F.expr("INTERVAL '1' HOUR")
    before = events.where(F.col("at") < head).select("user_id").distinct().withColumn("seen", F.lit(True))
    users = events.groupBy("user_id").agg(F.max("at").alias("last")).join(before, "user_id", "left")
    decided = times.first_seen(head, F.coalesce("seen", F.lit(False)), F.col("last") >= head, now())
    return users.select("user_id", decided.alias("d")).select("user_id", "d.status", "d.accepted")


def backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempt = (F.col("event_id") % 12 + 1).cast("int")
    rows = table(spark, sf_dir, "events").select(attempt.alias("attempt"), queue.retry_delay(attempt).alias("requeue"), queue.backoff_ceiling(attempt).alias("ceiling"))
    return rows.groupBy("attempt", "requeue", "ceiling").agg(F.count("*").alias("n"))


def payload_shrink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.length(fragments.shrunk(F.col("text"))).alias("chars"))


def _documents_of_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return turns.select("conv_id", F.array_join(F.transform("t", lambda x: x["text"]), "\n\n").alias("document"))


KEYWORDS = ["the", "of", "and"]


def fragment_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fragments.ranked(F.col("document"), F.array(*map(F.lit, KEYWORDS)))
    rows = _documents_of_turns(spark, sf_dir).select("conv_id", F.posexplode(found).alias("place", "f"))
    return rows.select("conv_id", (F.col("place") + 1).alias("place"), "f.pos", F.round("f.score", 6).alias("score"), "f.tokens")


def fragment_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fragments.selected(F.col("document"), F.array(*map(F.lit, KEYWORDS)), F.lit(60))
    rows = _documents_of_turns(spark, sf_dir).select("conv_id", found.alias("f"))
    return rows.select("conv_id", F.size("f").alias("n"), F.aggregate("f", F.lit(0).cast("long"), lambda s, x: s + x["tokens"]).alias("tokens"))


def quote_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark text, and its last few letters as a short quote, looked for in every document."""
    benchmark = table(spark, sf_dir, "benchmark")
    few = (F.col("item_id") % 14 + 4).cast("int")
    short = benchmark.select((-F.col("item_id") - 1).alias("item"), F.substring("text", -few, few).alias("quote"))
    pairs = quotes.holders(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), benchmark.select(F.col("item_id").alias("item"), F.col("text").alias("quote")).unionByName(short))
    return pairs.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))


def fallback_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of three providers come from each customer's orders, in order of key."""
    outcome = F.element_at(F.array(*map(F.lit, ["retryable", "ok", "413", "permanent", "retryable"])), (F.col("o_orderkey") % 5).cast("int") + 1)
    orders = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 3).alias("tier"), "o_orderkey", outcome.alias("outcome"))
    tiers = orders.groupBy("o_custkey", "tier").agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "outcome"))), lambda x: x["outcome"]).alias("row"))
    by = tiers.groupBy("o_custkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("tier", "row"))), lambda x: x["row"]).alias("rows"))
    return by.select("o_custkey", fallback(F.col("rows"), 1).alias("f")).select("o_custkey", "f.provider", "f.attempts")


def first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "value")


TURNS = "d AS (SELECT conv_id, unnest(list_filter(list_transform(regexp_split_to_array(string_agg(text, chr(10) || chr(10) ORDER BY turn, text), '\\n\\s*\\n'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')) AS f, generate_subscripts(list_filter(list_transform(regexp_split_to_array(string_agg(text, chr(10) || chr(10) ORDER BY turn, text), '\\n\\s*\\n'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), 1) - 1 AS pos FROM conversations GROUP BY conv_id)"
RANKED = TURNS + """, s AS (SELECT conv_id, pos, greatest(1, (length(f) + 2) // 3) AS tokens,
    3.0 * len(list_intersect(list_distinct(regexp_extract_all(lower(f), '[a-z0-9_+-]+')), ['the', 'of', 'and'])) + CASE WHEN length(f) < 120 THEN 0.5 ELSE 0 END + CAST(1 AS DOUBLE) / (pos + 1) AS score FROM d),
  r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, pos) AS place FROM s)"""
OUT = f"(t0 < {NOW} - INTERVAL 24 HOUR)"
FRESH = f"""SELECT event_id, CASE WHEN t0 IS NULL OR t0 > {NOW} + INTERVAL 5 MINUTE THEN 'UNCERTAIN' WHEN {OUT} THEN 'STALE' WHEN conf >= 0.99 THEN 'VERIFIED' ELSE 'INFERRED' END AS status
    FROM (SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN ts END AS t0, list_element([1.0, 0.9, 0.5], CAST(event_id % 3 AS INT) + 1) AS conf FROM events)"""
URL = "CASE WHEN page_id % 3 = 0 THEN url || '#top' ELSE url END"
HOST = "lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1))"

SQL = {
    "content_hash": "SELECT doc_id, sha256(text) AS hash FROM documents",
    "stable_key": "SELECT doc_id, sha256(lower(source) || ':' || lang || doc_id) AS key FROM documents",
    "raw_dedupe": "SELECT sha256(text) AS hash, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1",
    "canonical_url": f"""WITH u AS (SELECT page_id, {HOST} AS host, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ({", ".join(f"'{t}'" for t in keys.TRACKING)}))) AS q FROM pages)
        SELECT page_id, scheme || '://' || host || CASE WHEN path IN ('', '/') THEN '/' ELSE rtrim(regexp_replace(path, '/+', '/', 'g'), '/') END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical FROM u""",
    "valid_url": "SELECT page_id, page_id % 5 <> 0 AND page_id % 7 <> 0 AS valid FROM pages",
    "host_stats": f"SELECT {HOST} AS host, count(*) AS n FROM pages GROUP BY 1",
    "host_allowlist": f"SELECT page_id, {HOST} AS host FROM pages WHERE {HOST} IN (SELECT {HOST} FROM pages WHERE page_id % 4 = 0)",
    "block_filter": "SELECT page_id, page_id % 2 = 0 AND (page_id % 9 = 0 OR regexp_matches(lower(html), 'cf-chl-|cloudflare ray id|/cdn-cgi/challenge-platform|g-recaptcha-response|datadome|verify you are human|<title>just a moment...</title>')) AS blocked FROM pages",
    "relevance_filter": "SELECT doc_id FROM documents WHERE regexp_matches(lower(lang || chr(10) || substr(coalesce(text, ''), 1, 5000)), '" + "|".join(text.RELEVANT_PHRASES) + "')",
    "role_family": f"SELECT title, CASE WHEN title = 'Data Scientist' THEN 'Research' WHEN title = 'ML Engineer' THEN 'Engineering' WHEN title = 'Head of Growth' THEN 'Marketing' WHEN title = 'Account Executive' THEN 'Sales' WHEN title = 'Analytics Lead' THEN 'Data' WHEN title = 'Product Designer' THEN 'Product' ELSE 'Other' END AS family, count(*) AS n FROM (SELECT list_element({ROLES}, CAST(o_orderkey % 7 AS INT) + 1) AS title FROM orders) GROUP BY ALL",
    "infer_remote": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN false ELSE o_custkey % 3 = 0 END AS remote FROM orders",
    "collapse_ws": "SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS collapsed FROM documents",
    "clean_text": "SELECT p_partkey, p_name || chr(9) || p_brand AS clean FROM part",
    "split_list": "SELECT p_partkey, 3 AS n, trim(p_name) || '|' || p_brand || '|' || p_type AS parts FROM part",
    "tags_clean": "SELECT p_partkey, p_brand || CASE WHEN p_partkey % 2 = 0 THEN '|' || p_type ELSE '' END AS tags FROM part",
    "int_or_none": "SELECT p_partkey, try_cast(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS brand, try_cast(regexp_extract(p_type, '[0-9]+') AS BIGINT) AS kind FROM part",
    "token_estimate": "SELECT conv_id, turn, CAST(greatest(1, (length(text) + 2) // 3) AS BIGINT) AS tokens FROM conversations",
    "normalize_name": f"SELECT c_custkey, {NORMAL} AS normalized FROM customer",
    "block_keys": f"WITH n AS (SELECT {NORMAL} AS k FROM customer), c AS (SELECT k, replace(k, ' ', '') AS s FROM n), b AS (SELECT unnest(['prefix:' || substr(s, 1, 4), 'initial:' || substr(s, 1, 1) || ':' || length(s) // 4, 'tokens:' || len(string_split(k, ' ')) || ':' || substr(s, 1, 2)]) AS block FROM c WHERE s <> '') SELECT block, count(*) AS n FROM b GROUP BY 1",
    "repo_url": f"SELECT doc_id, {REPO} AS repo FROM documents",
    "group_repos": "SELECT 'own' || (doc_id % 30) AS owner, 'repo' || (doc_id % 90) AS name, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE doc_id % 4 < 3 GROUP BY ALL",
    "parse_ts": "SELECT event_id, CASE WHEN event_id % 5 < 3 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS parsed FROM events",
    "relative_ts": f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime({NOW} - to_minutes(user_id % 40), '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime({NOW} - to_hours(user_id % 40), '%Y-%m-%d %H:%M:%S') END AS at,
        CASE event_id % 4 WHEN 2 THEN 'unparsed' WHEN 3 THEN 'missing' ELSE 'relative_unit' END AS method, CASE WHEN event_id % 4 < 2 THEN CAST(0.9 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS confidence FROM events""",
    "freshness": f"WITH f AS ({FRESH}) SELECT event_id, status, status IN ('VERIFIED', 'INFERRED') AND event_id % 3 < 2 AS accepted FROM f",
    "freshness_accept": f"WITH f AS ({FRESH}) SELECT event_id, status FROM f WHERE status IN ('VERIFIED', 'INFERRED') AND event_id % 3 < 2",
    "first_seen": f"WITH u AS (SELECT user_id, max(ts) >= {NOW} - INTERVAL 1 HOUR AND min(ts) >= {NOW} - INTERVAL 1 HOUR AS fresh FROM events GROUP BY 1) SELECT user_id, CASE WHEN fresh THEN 'INFERRED' ELSE 'UNCERTAIN' END AS status, fresh AS accepted FROM u",
    "backoff": "WITH a AS (SELECT CAST(event_id % 12 + 1 AS INT) AS attempt FROM events) SELECT attempt, CAST(least(300, pow(2, attempt - 1)) AS DOUBLE) AS requeue, CAST(least(30, 0.5 * pow(2, attempt - 1)) AS DOUBLE) AS ceiling, count(*) AS n FROM a GROUP BY ALL",
    "payload_shrink": "SELECT doc_id, CAST(least(length(text), greatest(384, length(text) // 2)) AS INT) AS chars FROM documents",
    "fragment_rank": f"WITH {RANKED} SELECT conv_id, CAST(place AS INT) AS place, CAST(pos AS INT) AS pos, round(score, 6) AS score, CAST(tokens AS BIGINT) AS tokens FROM r",
    "fragment_select": f"WITH RECURSIVE {RANKED}, g(conv_id, place, remains, n, used) AS (SELECT conv_id, 0, 60, 0, 0 FROM conversations GROUP BY conv_id UNION ALL SELECT g.conv_id, g.place + 1, CASE WHEN r.tokens <= remains THEN remains - r.tokens ELSE remains END, CASE WHEN r.tokens <= remains THEN n + 1 ELSE n END, CASE WHEN r.tokens <= remains THEN used + r.tokens ELSE used END FROM g JOIN r ON r.conv_id = g.conv_id AND r.place = g.place + 1) SELECT conv_id, CAST(max(n) AS INT) AS n, CAST(max(used) AS BIGINT) AS tokens FROM g GROUP BY conv_id",
    "quote_gate": """WITH q AS (SELECT item_id, text AS q FROM benchmark UNION ALL SELECT -item_id - 1, right(text, CAST(item_id % 14 + 4 AS INT)) FROM benchmark)
        SELECT doc_id, item_id FROM documents d JOIN q ON contains(d.text, trim(q.q, ' ' || chr(9) || chr(10) || chr(13)))""",
    "first_wins_dedupe": "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL",
}
QUERIES = [
    content_hash, stable_key, raw_dedupe, canonical_url, valid_url, host_stats, host_allowlist, block_filter, html_text, relevance_filter, role_family, infer_remote, collapse_ws, clean_text,
    split_list, tags_clean, int_or_none, token_estimate, normalize_name, block_keys, repo_url, group_repos, parse_ts, relative_ts, freshness, freshness_accept, first_seen, backoff,
    payload_shrink, fragment_rank, fragment_select, quote_gate, fallback_trace, first_wins_dedupe,
]
