"""Queries of the table operators: sources, queue, resolution, enrichment, streams.

Raw payloads are built from the tables as the sources would receive them, then parsed back.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.markup import html_text
from quern.functions.sql import register
from quern.operators import queue, resolve
from quern.operators.dedupe import batch_ids, keyset_page, latest_wins, not_yet, per_source_top, upsert
from quern.operators.enrich import accepted_answer
from quern.plans.record_sql import NOW
from quern.sinks.buckets import KeyedTable
from quern.sinks.export import new_bodies
from quern.sinks.shared import scratch
from quern.sources import adapters, boards, catalog, feeds
from quern.sources.chains import chained
from quern.sources.records import now, stamp, table
from quern.streaming import keyed


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job bodies: orders with o_orderkey % 5 = b go to board b, one body per customer."""
    o = table(spark, sf_dir, "orders").withColumn("b", F.col("o_orderkey") % 5)
    id_, title, company = F.col("o_orderkey").cast("string"), F.concat(F.col("o_orderpriority"), F.lit(" engineer")), F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    url = F.concat(F.lit("https://jobs.example/"), F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(id_))
    url = F.when(F.col("o_orderkey") % 7 != 0, url)
    at = F.col("o_orderdate").cast("timestamp")
    shapes = [
        F.to_json(F.struct(id_.alias("slug"), title.alias("title"), company.alias("company_name"), url.alias("url"), F.lit("Remote").alias("location"), F.lit(False).alias("remote"), F.unix_seconds(at).alias("created_at"))),
        F.to_json(F.struct(id_.alias("id"), title.alias("position"), company.alias("company"), url.alias("url"), F.lit("Remote").alias("location"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("date"))),
        F.to_json(F.struct(id_.alias("id"), title.alias("jobTitle"), company.alias("companyName"), url.alias("url"), F.lit("Berlin").alias("jobGeo"), stamp(at).alias("pubDate"))),
        F.to_json(F.struct(id_.alias("guid"), title.alias("title"), F.lit("").alias("companyName"), url.alias("applicationLink"), F.array(F.lit("Remote"), F.lit("EU")).alias("locationRestrictions"), F.unix_seconds(at).alias("pubDate"))),
        F.to_json(F.struct(id_.alias("id"), title.alias("title"), company.alias("company_name"), url.alias("url"), F.lit("Remote").alias("candidate_required_location"), stamp(at).alias("publication_date"))),
    ]
    item, board, wrap = F, F, F
    for k, (name, shape) in enumerate(zip(boards.BOARDS, shapes, strict=True)):
        item, board = item.when(F.col("b") == k, shape), board.when(F.col("b") == k, name)
    rows = o.select(board.alias("board"), "o_custkey", item.alias("item"))
    listed = rows.groupBy("board", "o_custkey").agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("item")), ","), F.lit("]")).alias("list"))
    wrap = F.when(F.col("board") == "arbeitnow", F.concat(F.lit('{"data":'), "list", F.lit("}"))).when(F.col("board") == "remoteok", F.col("list")).otherwise(F.concat(F.lit('{"jobs":'), "list", F.lit("}")))
    return listed.select("board", wrap.alias("body"))


def board_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _bodies(spark, sf_dir)
    out = None
    for name in boards.BOARDS:
        rows = boards.items(raw, name)
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("board").agg(F.count("*").alias("n"))


def job_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = boards.jobs(_bodies(spark, sf_dir))
    return j.select("board", F.col("source_id").cast("bigint").alias("id"), "title", "company", "location", "is_remote", stamp("published_at").alias("at"), "role_family")


def source_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = boards.jobs(_bodies(spark, sf_dir)).groupBy("board").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(b,) for b in [*boards.BOARDS, "idle"]], "board string")
    return every.join(kept, "board", "left").select("board", F.coalesce("n", F.lit(0)).alias("n"))


def per_source_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caps are the feature: 100 rows in all, an equal share for each event type."""
    events = table(spark, sf_dir, "events")
    return per_source_top(events, "event_type", 5, 100, "event_id").orderBy("event_type", "event_id").limit(100).select("event_type", "event_id")


def _feeds(spark: SparkSession, sf_dir: str, all_atom: bool = False) -> DataFrame:
    """Feeds of up to 100 items per host digit: RSS for even ones, Atom for odd ones or for all."""
    rows = table(spark, sf_dir, "pages").join(table(spark, sf_dir, "events"), F.col("page_id") == F.col("event_id")).withColumn("src", F.col("page_id") % 6).withColumn("is_rss", F.lit(not all_atom) & (F.col("src") % 2 == 0))
    path, at = F.concat(F.lit("/n/"), F.col("page_id").cast("string")), F.date_trunc("second", F.col("ts").cast("timestamp"))
    rss = F.concat(F.lit("<item><title> story  "), "event_type", F.lit("</title><link>"), path, F.lit("</link><pubDate>"), F.date_format(at, "dd MMM yyyy HH:mm:ss '+0000'"), F.lit("</pubDate></item>"))
    atom = F.concat(F.lit('<entry><id>http://arxiv.example/abs/'), F.col("page_id").cast("string"), F.lit("v2</id><title> story  "), F.col("event_type"), F.lit('</title><link rel="alternate" href="'), path, F.lit('"/><summary>a  b</summary><published>'), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</published><author><name>A</name></author><author><name>B</name></author></entry>"))
    listed = rows.groupBy("src", "is_rss", F.floor(F.col("page_id") / 600).alias("issue")).agg(F.array_join(F.sort_array(F.collect_list(F.when(F.col("is_rss"), rss).otherwise(atom))), "").alias("x"))
    body = F.when(F.col("is_rss"), F.concat(F.lit('<rss version="2.0"><channel>'), "x", F.lit("</channel></rss>"))).otherwise(F.concat(F.lit("<feed>"), "x", F.lit("</feed>")))
    return listed.select(F.col("src").cast("string").alias("source"), F.lit("https://news.example/feed").alias("base"), body.alias("body"))


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_items(_feeds(spark, sf_dir)).select("source", "url", "title", stamp("published_at").alias("at"))


def parse_atom(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = feeds.atom_papers(_feeds(spark, sf_dir, all_atom=True))
    return papers.select(F.col("paper_id").cast("bigint").alias("id"), "title", "abstract", F.array_join("authors", ",").alias("authors"))


def _with_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, before whose own HTML stands a linked-data script: an article in a graph, one with authors, or a broken one."""
    n = F.col("page_id")
    number = n.cast("string")
    authors = F.array(F.struct(F.concat(F.lit("A"), number).alias("name")), F.struct(F.lit("B, C").alias("name")))
    node = F.to_json(F.struct(F.lit("NewsArticle").alias("@type"), F.when(n % 4 == 0, F.concat(F.lit("body "), number)).alias("articleBody"), authors.alias("author")))
    script = F.when(n % 2 == 0, F.concat(F.lit('{"@graph":[{"@type":"Person"},'), node, F.lit("]}"))).otherwise("{broken")
    html = F.concat(F.lit('<script type="application/ld+json">'), script, F.lit("</script>"), "html")
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


def json_ld_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article's own body, or the page's visible text, which a script in front doesn't change."""
    pages = _with_script(spark, sf_dir).withColumn("url", F.concat(F.lit("https://a.example/"), F.col("page_id").cast("string")))
    plain = table(spark, sf_dir, "pages").select(F.concat(F.lit("https://a.example/"), F.col("page_id").cast("string")).alias("canonical"), html_text("html").alias("seen"))
    rows = feeds.article_text(pages).join(plain, "canonical")
    return rows.select("canonical", F.when(F.col("full_text") == F.col("seen"), "seen").otherwise(F.col("full_text")).alias("full_text"))


def sql_json_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked data of the pages by SQL text alone."""
    register(spark)
    return spark.sql("SELECT p.page_id, n.pos, n.type, get_json_object(n.node, '$.articleBody') AS body FROM {pages} p, LATERAL extract_json_ld(p.html) n", pages=_with_script(spark, sf_dir))


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the pages in five feeds; every seventh fetch failed, every eleventh page wasn't fetched."""
    pages, n = _with_script(spark, sf_dir), F.col("page_id")
    own = F.concat(F.lit("https://n.example/"), n.cast("string"))
    items = pages.select(F.concat(F.lit("f"), (n % 5).cast("string")).alias("source"), F.concat(own, F.lit("?utm_source=feed")).alias("url"), F.when(n % 3 == 0, F.lit("Z, Y")).alias("author"))
    return feeds.fetched_articles(items, pages.where(n % 11 != 0).select(own.alias("url"), "html", F.when(n % 7 == 0, "HTTP 500").alias("error")))


def news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = feeds.split_errors(_fetched(spark, sf_dir))
    return good.select("source", "canonical", F.array_join("authors", "|").alias("authors"), "method")


def news_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.split_errors(_fetched(spark, sf_dir))[1]


def news_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.yields(_fetched(spark, sf_dir))


def news_join_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    items = pages.select("page_id", F.concat("url", F.lit("#x")).alias("url"))
    found = feeds.news(items, pages)
    return found.select("page_id", "canonical", (F.length("full_text") > 0).alias("filled"))


def _company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = F.struct(F.concat(F.lit("s"), (F.col("s_suppkey") % 1000).cast("string")).alias("slug"), F.col("s_name").alias("name"), F.lit(" ").alias("long_description"), F.lit("one & only").alias("one_liner"), F.lit("w24").alias("batch_name"), F.concat(F.lit("about "), F.col("s_nationkey").cast("string")).alias("team_size"), F.array(F.lit("ai"), F.lit("")).alias("tags"))
    # pages of bounded size, in order of nation and then of supplier
    page = F.col("s_nationkey") * 1_000_000 + F.floor(F.col("s_suppkey") / 2500)
    bodies = table(spark, sf_dir, "supplier").groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(company)).alias("companies"))
    data = F.to_json(F.struct(F.struct("companies").alias("props")))
    escaped = F.replace(F.replace(data, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    html = F.concat(F.lit('<html><div id="app" data-page="'), escaped, F.lit('"></div></html>'))
    return bodies.select("page", html.alias("html"))


def extract_embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = catalog.startups(_company_pages(spark, sf_dir))
    return s.select("slug", "entity_name", "description", "batch", "employee_count", F.array_join("tags", ",").alias("tags"))


def _product_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name"))
    item = F.struct(F.concat(F.when(F.col("p_partkey") % 5 != 0, F.lit("own/")).otherwise(""), F.lit("my-app_"), (F.col("p_partkey") % 1500).cast("string")).alias("id"), (F.col("p_partkey") % 11 == 0).alias("private"), F.col("p_size").alias("likes"), F.lit("gradio").alias("sdk"), F.struct(title.alias("title")).alias("cardData"), F.array(F.col("p_brand"), F.lit("")).alias("tags"))
    return table(spark, sf_dir, "part").groupBy((F.floor(F.col("p_partkey") / 100)).alias("page")).agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", item.alias("i")))), lambda x: x["i"])).alias("body"))


def map_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.products(_product_bodies(spark, sf_dir)).select("id", "startup_name", "product_name", "likes", F.array_join("tags", ",").alias("tags"))


def _cursor_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """page, address, next, body of product lists of ten parts, linked three pages on; some link back, some to none. And the three starts."""
    address = lambda page: F.concat(F.lit("https://p.example/list?page="), page.cast("string"))
    part = F.col("p_partkey")
    item = F.struct(F.concat(F.lit("own/app-"), (part % 700).cast("string")).alias("id"), (part % 5 == 0).alias("private"), F.col("p_size").alias("likes"))
    bodies = table(spark, sf_dir, "part").groupBy(F.floor(part / 10).alias("page")).agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", item.alias("i")))), lambda x: x["i"])).alias("body"))
    page = F.col("page")
    to = F.when(page % 41 == 40, None).when(page % 50 == 49, page - 30).otherwise(page + 3)
    link = F.when(to.isNotNull(), F.concat(F.lit("<"), address(to), F.lit('>; rel="next", <https://p.example/list>; rel="first"')))
    pages = bodies.select("page", address(page).alias("address"), catalog.next_cursor(F.coalesce(link, F.lit(""))).alias("next"), "body")
    return pages, spark.range(3).select(address(F.col("id")).alias("start"))


def scan_filter_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in the order in which cursors lead through their pages: private ones go, the first of each id stays."""
    pages, starts = _cursor_pages(spark, sf_dir)
    inside, _ = chained(pages, starts)
    order = F.col("place") * 10 + F.substring_index("start", "=", -1).cast("long")
    raw = inside.join(pages.select("address", "body"), "address").select(order.alias("page"), "body")
    return catalog.products(raw).select("id", "likes", "page")


def scan_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chained(*_cursor_pages(spark, sf_dir))[1]


def _paper_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    paper = F.struct(F.concat(F.lit("24."), (F.col("doc_id") % 700).cast("string"), F.lit("v1")).alias("id"), F.col("lang").alias("title"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("see https://github.com/a/b"), F.col("doc_id").cast("string"), F.lit(".git)."))).alias("summary"))
    entry = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(paper.alias("paper")))).otherwise(F.to_json(paper))
    bodies = table(spark, sf_dir, "documents").groupBy((F.floor(F.col("doc_id") / 50)).alias("page")).agg(F.sort_array(F.collect_list(F.struct("doc_id", entry.alias("e")))).alias("es"))
    return bodies.select("page", F.concat(F.lit("["), F.array_join(F.transform("es", lambda x: x["e"]), ","), F.lit("]")).alias("body"))


def scan_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.papers(_paper_bodies(spark, sf_dir), require_repo=True).select("id", "title", "github_url", "record_key")


def _collected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Company pages, product lists, papers and, without an adapter, web pages, stored by source."""
    web = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.col("html").alias("body"))
    named = {"directory": _company_pages(spark, sf_dir).withColumnRenamed("html", "body"), "spaces": _product_bodies(spark, sf_dir), "papers": _paper_bodies(spark, sf_dir), "web": web}
    where = scratch(spark)
    rows = [b.select(F.lit(name).alias("source"), F.col("page").cast("long").alias("page"), "body") for name, b in named.items()]
    functools.reduce(DataFrame.unionByName, rows).write.partitionBy("source").parquet(where)
    return adapters.collect(spark.read.schema("page long, body string, source string").parquet(where), adapters.known_adapters())


def adapter_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of all sources that have an adapter, from one store of raw bodies."""
    return _collected(spark, sf_dir)[0]


def adapter_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collected(spark, sf_dir)[1]


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    stored = latest_wins(events.where("event_id % 2 = 0"), ["user_id"], "event_id")
    incoming = latest_wins(events.where("event_id % 2 = 1 and user_id % 3 > 0"), ["user_id"], "event_id")
    return upsert(stored, incoming, ["user_id"], fixed=("event_type",)).select("user_id", "event_id", "event_type", "value")


def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.select("event_type", (F.col("user_id") % 4).alias("slot"), "event_id", F.get_json_object("props", "$.k").cast("int").alias("cursor"))
    return latest_wins(rows, ["event_type", "slot"], "event_id")


def enqueue_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    stored = events.where("user_id % 2 = 0").select("event_type", "user_id").distinct()
    return not_yet(events, stored, ["event_type", "user_id"], "event_id")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    state = F.element_at(F.array(*map(F.lit, ["PENDING", "LEASED", "DONE"])), (F.col("event_id") % 3).cast("int") + 1)
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("queue_name"), state.alias("status"), (k % 6).alias("attempts"), at.alias("available_at"), (at + F.expr("INTERVAL '10' DAY")).alias("lease_expires_at"), F.lit("w0").alias("lease_owner"))


def queue_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.eligible(_items(spark, sf_dir), "view", now()).select("id", "status")


def queue_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A claim's size is its feature: 25 items."""
    return queue.claim(_items(spark, sf_dir), "view", now(), 25, "w1").select("id", "status", "attempts", "lease_owner")


def queue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy("queue_name", "status").agg(F.count("*").alias("n"))


def queue_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    move = queue.transition(F.col("id") % 4 == 0, F.col("attempts"), F.col("lease_owner"), F.when(F.col("id") % 5 == 0, "w9").otherwise("w0"))
    return _items(spark, sf_dir).select("id", move.alias("m")).select("id", "m.status", "m.delay")


def _worked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items after a worker's outcomes."""
    move = queue.transition(F.col("id") % 4 == 0, F.col("attempts"), F.col("lease_owner"), F.when(F.col("id") % 5 == 0, "w9").otherwise("w0"))
    return _items(spark, sf_dir).withColumn("status", move["status"])


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("https://jobs.example/"), F.col("id").cast("string"))
    return queue.dead_letters(_worked(spark, sf_dir), "work", url, F.when(F.col("id") % 2 == 0, "FetchError: no answer").otherwise("ParseError: no body"))


def expire_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 2 == 0, "JOB").otherwise("STARTUP")
    rows = table(spark, sf_dir, "events").select("event_id", kind.alias("record_type"), F.when(F.col("event_id") % 5 > 0, F.col("ts").cast("timestamp")).alias("at"))
    return queue.unexpired(rows, ["JOB", "NEWS"], "at", now() - F.expr("INTERVAL '24' HOUR")).select("event_id")


def keyset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page size is the feature: 100 rows after a key."""
    return keyset_page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500, 100)


def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_ids(table(spark, sf_dir, "orders").select("o_orderkey"), 200, "o_orderkey").groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


def graphql_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    repos = table(spark, sf_dir, "documents").select((F.col("doc_id") % 500).alias("repo")).distinct()
    rows = batch_ids(repos, 40, "repo").withColumn("i", F.row_number().over(Window.partitionBy("batch").orderBy("repo")) - 1)
    field = F.concat(F.lit("repo"), F.col("i").cast("string"), F.lit(": repository(owner: $owner"), F.col("i").cast("string"), F.lit(")"))
    return rows.groupBy("batch").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", field.alias("f")))), lambda x: x["f"]), " ").alias("query"))


def enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = table(spark, sf_dir, "part").where("p_partkey % 4 > 0").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("stars"))
    rows = table(spark, sf_dir, "lineitem").join(fresh, "l_partkey", "left")
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("stars").alias("refreshed"), F.sum(F.coalesce("stars", F.lit(-1))).alias("stars"))


def refresh_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_lookup(spark, sf_dir).agg(F.sum("n").alias("records"), F.sum("refreshed").alias("refreshed"), (F.sum("n") - F.sum("refreshed")).alias("unavailable"))


def key_hash_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "lineitem")
    key = F.sha2(F.concat(F.lit("benchmark:record-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")), 256)
    return orders.agg(F.count("*").alias("records"), F.ceil(F.count("*") / 200).alias("batches"), F.max(key).alias("greatest"))


def _spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names spelt anew: exact with a legal form, with a letter dropped, or of another world."""
    name = F.concat(F.lit("Brand "), F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij"), F.lit(" works"))
    spelt = F.when(F.col("c_custkey") % 3 == 0, F.concat(name, F.lit(", Inc."))).when(F.col("c_custkey") % 3 == 1, F.regexp_replace(name, "works", "wrks")).otherwise(F.concat(F.lit("Zz"), F.reverse(name)))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), F.col("c_custkey").alias("pos"), spelt.alias("raw_name"))


def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spellings(spark, sf_dir)
    both = rows.select("name", "pos").unionByName(rows.where("c_custkey % 3 = 1").select(F.col("raw_name").alias("name"), (F.col("pos") + 1_000_000).alias("pos")))
    return resolve.canonical_names(both)


def _canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.canonical_names(_spellings(spark, sf_dir).where("c_custkey % 10 < 8").select("name", "pos"))


def entity_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all customers those whose name is a canonical one, up to case and legal form."""
    found = resolve.resolve(_spellings(spark, sf_dir), _canon(spark, sf_dir)).where("method = 'exact'")
    return found.select("raw_name", "canonical_name", "method", "status")


def entity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.resolve(_spellings(spark, sf_dir), _canon(spark, sf_dir))
    return found.withColumn("confidence", F.round("confidence", 6))


def apply_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = resolve.resolve(_spellings(spark, sf_dir), _canon(spark, sf_dir))
    records = _spellings(spark, sf_dir).select("c_custkey", F.col("raw_name").alias("entity"), F.lit(None).cast("string").alias("raw"))
    return resolve.apply_canonical(records, mapping, "entity", "raw")


def llm_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    value = F.element_at(F.array(*map(F.lit, ["FREE", "PAID", "CHEAP"])), (F.col("doc_id") % 3).cast("int") + 1)
    quote = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.substring("text", 3, 20))).otherwise("never said so")
    return docs.select("doc_id", accepted_answer(F.col("text"), value, quote, ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]).alias("applied"))


def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("body"), "doc_id")
    old = new_bodies(docs.where("doc_id % 2 = 0"))
    return new_bodies(docs, old).groupBy("prefix").agg(F.count("*").alias("n"))


def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"))
    return keyed.late_split(rows, "at", now()).groupBy("lateness").agg(F.count("*").alias("n"))


def events_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"), "value")
    out = rows.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(stamp("w.start").alias("day"), "event_type", "n", "total")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    path = f"{sf_dir}/events.parquet"
    found = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir) if _is_file(spark, path) else spark.readStream.schema(schema).parquet(path)
    return found.withColumn("ts", F.col("ts").cast("timestamp"))


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    latest = KeyedTable(spark, f"{where}/t", "user_id long, event_id long, event_type string, value double", ["user_id"], ["event_id"])
    keyed.run_available(_stream(spark, sf_dir).select("user_id", "event_id", "event_type", "value"), latest.upsert, f"{where}/c")
    return latest.read()


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    rows = keyed.deduplicated(_stream(spark, sf_dir).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "60 days")
    rows.select("user_id", "event_type").writeStream.format("parquet").option("path", f"{where}/t").option("checkpointLocation", f"{where}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{where}/t")


BOARD = "list_element(['arbeitnow', 'remoteok', 'jobicy', 'himalayas', 'remotive'], CAST(o_orderkey % 5 AS INT) + 1)"
SPELT = "'Brand ' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') || ' works'"
KEY = "lower('Brand ' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') || ' works')"
STATE = "list_element(['PENDING', 'LEASED', 'DONE'], CAST(event_id % 3 AS INT) + 1)"
ITEMS = f"i AS (SELECT event_id AS id, event_type AS queue_name, {STATE} AS status, CAST(json_extract_string(props, '$.k') AS INT) % 6 AS attempts, ts FROM events)"
ELIGIBLE = f"queue_name = 'view' AND ts <= {NOW} AND (status = 'PENDING' OR status = 'LEASED' AND ts + INTERVAL 10 DAY < {NOW})"
MOVED = "CASE WHEN id % 5 = 0 THEN 'UNCHANGED' WHEN id % 4 = 0 THEN 'DONE' WHEN attempts < 4 THEN 'PENDING' ELSE 'DEAD' END"
CHAINS = """WITH RECURSIVE p AS (SELECT page, CASE WHEN page % 41 = 40 THEN NULL WHEN page % 50 = 49 THEN page - 30 ELSE page + 3 END AS link FROM (SELECT DISTINCT p_partkey // 10 AS page FROM part)),
    w AS (SELECT s AS start, CAST(0 AS BIGINT) AS place, page FROM range(3) t(s) JOIN p ON page = s UNION SELECT w.start, w.place + 1, n.page FROM w JOIN p ON p.page = w.page JOIN p n ON n.page = p.link WHERE w.place < (SELECT count(*) FROM p)),
    r AS (SELECT start, page, min(place) AS place FROM w GROUP BY ALL)
    """
SQL = {
    "scan_filter_dedupe": CHAINS + """SELECT 'own/app-' || (p_partkey % 700) AS id, arg_min(p_size, (place * 10 + start, p_partkey)) AS likes, min(place * 10 + start) AS page
        FROM r JOIN part ON p_partkey // 10 = page WHERE p_partkey % 5 <> 0 GROUP BY 1""",
    "scan_aside": CHAINS + """, a AS (SELECT r.page, 'cycle' AS reason FROM r JOIN p USING (page) JOIN r m ON m.start = r.start AND m.page = p.link WHERE m.place <= r.place
        UNION SELECT page, 'unreached' FROM p ANTI JOIN r USING (page) UNION SELECT p.link, 'missing' FROM r JOIN p USING (page) WHERE p.link NOT IN (SELECT page FROM p))
        SELECT 'https://p.example/list?page=' || page AS address, reason FROM a""",
    "board_items": f"SELECT {BOARD} AS board, count(*) AS n FROM orders GROUP BY 1",
    "job_normalize": f"""SELECT {BOARD} AS board, o_orderkey AS id, o_orderpriority || ' engineer' AS title, CASE WHEN o_orderkey % 5 = 3 THEN 'Unknown' ELSE 'c' || o_custkey END AS company,
        CASE o_orderkey % 5 WHEN 2 THEN 'Berlin' WHEN 3 THEN 'Remote, EU' ELSE 'Remote' END AS location, o_orderkey % 5 NOT IN (0, 2) AS is_remote, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, 'Engineering' AS role_family FROM orders WHERE o_orderkey % 7 <> 0""",
    "source_yields": f"SELECT {BOARD} AS board, count(*) AS n FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1 UNION ALL SELECT 'idle', 0",
    "per_source_topn": "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE r <= 20",
    "feed_items": "SELECT CAST(page_id % 6 AS VARCHAR) AS source, 'https://news.example/n/' || page_id AS url, 'story ' || event_type AS title, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at FROM pages JOIN events ON page_id = event_id",
    "parse_atom": "SELECT page_id AS id, 'story ' || event_type AS title, 'a b' AS abstract, 'A,B' AS authors FROM pages JOIN events ON page_id = event_id",
    "json_ld_article": "SELECT 'https://a.example/' || page_id AS canonical, CASE WHEN page_id % 4 = 0 THEN 'body ' || page_id ELSE 'seen' END AS full_text FROM pages",
    "sql_json_ld": """SELECT page_id, CAST(k AS INT) AS pos, CASE k WHEN 0 THEN 'Person' ELSE 'NewsArticle' END AS type, CASE WHEN k = 1 AND page_id % 4 = 0 THEN 'body ' || page_id END AS body FROM pages, range(2) r(k) WHERE page_id % 2 = 0""",
    "news_articles": """SELECT 'f' || (page_id % 5) AS source, 'https://n.example/' || page_id AS canonical, CASE WHEN page_id % 3 = 0 THEN 'Z|Y' WHEN page_id % 2 = 0 THEN 'A' || page_id || '|B|C' ELSE '' END AS authors,
        CASE WHEN page_id % 4 = 0 THEN 'json_ld' ELSE 'page_text' END AS method FROM pages WHERE page_id % 11 <> 0 AND page_id % 7 <> 0""",
    "news_errors": "SELECT 'f' || (page_id % 5) AS source, 'https://n.example/' || page_id AS url, CASE WHEN page_id % 11 = 0 THEN 'not fetched' ELSE 'HTTP 500' END AS reason FROM pages WHERE page_id % 11 = 0 OR page_id % 7 = 0",
    "news_yields": "SELECT 'f' || (page_id % 5) AS source, count(*) AS found, count(*) FILTER (page_id % 11 <> 0 AND page_id % 7 <> 0) AS accepted FROM pages GROUP BY 1",
    "extract_embedded_json": """WITH r AS (SELECT *, 's' || (s_suppkey % 1000) AS slug, row_number() OVER (PARTITION BY s_suppkey % 1000 ORDER BY s_nationkey, s_name) AS k FROM supplier)
        SELECT slug, s_name AS entity_name, 'one & only' AS description, 'W24' AS batch, CAST(s_nationkey AS BIGINT) AS employee_count, 'ai' AS tags FROM r WHERE k = 1""",
    "map_product": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey % 1500 ORDER BY p_partkey) AS k FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 11 <> 0)
        SELECT 'own/my-app_' || (p_partkey % 1500) AS id, 'own' AS startup_name, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'my app ' || (p_partkey % 1500) END AS product_name, p_size AS likes, p_brand AS tags FROM r WHERE k = 1""",
    "adapter_records": """WITH s AS (SELECT *, 's' || (s_suppkey % 1000) AS slug, row_number() OVER (PARTITION BY s_suppkey % 1000 ORDER BY s_nationkey, s_name) AS k FROM supplier),
        p AS (SELECT *, row_number() OVER (PARTITION BY p_partkey % 1500 ORDER BY p_partkey) AS k FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 11 <> 0),
        d AS (SELECT *, row_number() OVER (PARTITION BY doc_id % 700 ORDER BY doc_id) AS k FROM documents)
        SELECT 'directory' AS source, sha256('directory:' || slug) AS record_key, s_name AS title FROM s WHERE k = 1
        UNION ALL SELECT 'spaces', sha256('space:own/my-app_' || (p_partkey % 1500)), CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'my app ' || (p_partkey % 1500) END FROM p WHERE k = 1
        UNION ALL SELECT 'papers', sha256('arxiv:24.' || (doc_id % 700)), lang FROM d WHERE k = 1 AND trim(lang) <> ''""",
    "adapter_aside": """SELECT 'web' AS source, page_id AS page, 'no adapter' AS reason FROM pages
        UNION ALL SELECT 'papers', doc_id // 50, 'invalid' FROM (SELECT *, row_number() OVER (PARTITION BY doc_id % 700 ORDER BY doc_id) AS k FROM documents) WHERE k = 1 AND coalesce(trim(lang), '') = ''""",
    "scan_papers": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY doc_id % 700 ORDER BY doc_id) AS k FROM documents)
        SELECT '24.' || (doc_id % 700) || 'v1' AS id, lang AS title, 'https://github.com/a/b' || doc_id AS github_url, sha256('arxiv:24.' || (doc_id % 700)) AS record_key FROM r WHERE k = 1 AND doc_id % 2 = 0""",
    "upsert_latest": """WITH s AS (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS t, arg_max(value, event_id) AS v FROM events WHERE event_id % 2 = 0 GROUP BY 1),
        n AS (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS t, arg_max(value, event_id) AS v FROM events WHERE event_id % 2 = 1 AND user_id % 3 > 0 GROUP BY 1)
        SELECT user_id, coalesce(n.event_id, s.event_id) AS event_id, coalesce(s.t, n.t) AS event_type, coalesce(n.v, s.v) AS value FROM s FULL JOIN n USING (user_id)""",
    "checkpoint_latest": "SELECT event_type, user_id % 4 AS slot, max(event_id) AS event_id, CAST(arg_max(json_extract_string(props, '$.k'), event_id) AS INT) AS cursor FROM events GROUP BY ALL",
    "enqueue_dedupe": "SELECT event_type, user_id, min(event_id) AS event_id FROM events WHERE user_id % 2 <> 0 GROUP BY ALL",
    "queue_eligible": f"WITH {ITEMS} SELECT id, status FROM i WHERE {ELIGIBLE}",
    "queue_claim": f"WITH {ITEMS} SELECT id, 'LEASED' AS status, attempts + 1 AS attempts, 'w1' AS lease_owner FROM i WHERE {ELIGIBLE} ORDER BY id LIMIT 25",
    "queue_counts": f"WITH {ITEMS} SELECT queue_name, status, count(*) AS n FROM i GROUP BY ALL",
    "queue_transition": f"WITH {ITEMS}, m AS (SELECT id, attempts, {MOVED} AS status FROM i) SELECT id, status, CASE WHEN status = 'PENDING' THEN CAST(least(300, pow(2, greatest(0, attempts - 1))) AS DOUBLE) END AS delay FROM m",
    "dead_letters": f"""WITH {ITEMS} SELECT id, 'work' AS stage, 'https://jobs.example/' || id AS url, CASE WHEN id % 2 = 0 THEN 'FetchError' ELSE 'ParseError' END AS error_type, CASE WHEN id % 2 = 0 THEN 'no answer' ELSE 'no body' END AS message,
        '{{"id":' || id || ',"queue_name":"' || queue_name || '","attempts":' || attempts || '}}' AS payload FROM i WHERE {MOVED} = 'DEAD'""",
    "expire_signals": f"SELECT event_id FROM events WHERE NOT (event_id % 2 = 0 AND event_id % 5 > 0 AND ts < {NOW} - INTERVAL 24 HOUR)",
    "keyset_scan": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100",
    "batch_numbers": "SELECT CAST(r // 200 AS BIGINT) AS batch, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders) GROUP BY 1",
    "graphql_batches": "WITH d AS (SELECT DISTINCT doc_id % 500 AS repo FROM documents), r AS (SELECT row_number() OVER (ORDER BY repo) - 1 AS r FROM d) SELECT CAST(r // 40 AS BIGINT) AS batch, count(*) AS n, string_agg('repo' || (r % 40) || ': repository(owner: $owner' || (r % 40) || ')', ' ' ORDER BY r) AS query FROM r GROUP BY 1",
    "enrich_lookup": "SELECT l_returnflag, count(*) AS n, count(p_size) AS refreshed, CAST(sum(coalesce(p_size, -1)) AS BIGINT) AS stars FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 4 > 0 GROUP BY 1",
    "refresh_coverage": "SELECT count(*) AS records, count(p_size) AS refreshed, count(*) - count(p_size) AS unavailable FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 4 > 0",
    "key_hash_rate": "SELECT count(*) AS records, CAST(ceil(count(*) / 200) AS BIGINT) AS batches, max(sha256('benchmark:record-' || l_orderkey || '-' || l_linenumber)) AS greatest FROM lineitem",
    "canonical_names": f"SELECT {KEY} AS key, {SPELT} AS canonical FROM customer UNION ALL SELECT replace({KEY}, 'works', 'wrks'), replace({SPELT}, 'works', 'wrks') FROM customer WHERE c_custkey % 3 = 1",
    "entity_exact": f"""WITH n AS (SELECT c_custkey, {SPELT} AS name FROM customer), r AS (SELECT CASE c_custkey % 3 WHEN 0 THEN name || ', Inc.' WHEN 1 THEN replace(name, 'works', 'wrks') ELSE 'Zz' || reverse(name) END AS raw_name FROM n)
        SELECT raw_name, name AS canonical_name, 'exact' AS method, 'MATCHED' AS status FROM r JOIN n ON lower(regexp_replace(raw_name, ', Inc[.]$', '')) = lower(name) WHERE c_custkey % 10 < 8""",
    "llm_gate": "SELECT doc_id, doc_id % 3 < 2 AND doc_id % 2 = 0 AND trim(regexp_replace(substr(text, 3, 20), '^\\s+|\\s+$', '', 'g')) <> '' AS applied FROM documents",
    "raw_store": "WITH h AS (SELECT sha256(text) AS h FROM documents EXCEPT SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0) SELECT substr(h, 1, 2) AS prefix, count(*) AS n FROM h GROUP BY 1",
    "late_split": f"SELECT CASE WHEN ts < {NOW} - INTERVAL 24 HOUR THEN 'late' WHEN ts > {NOW} + INTERVAL 5 MINUTE THEN 'ahead' ELSE 'on_time' END AS lateness, count(*) AS n FROM events GROUP BY 1",
    "events_per_day": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "stream_upsert": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
}
QUERIES = [
    board_items, job_normalize, source_yields, per_source_topn, feed_items, parse_atom, json_ld_article, sql_json_ld, news_articles, news_errors, news_yields, news_join_article, extract_embedded_json, map_product, scan_filter_dedupe, scan_aside, scan_papers, adapter_records, adapter_aside, upsert_latest,
    checkpoint_latest, enqueue_dedupe, queue_eligible, queue_claim, queue_counts, queue_transition, dead_letters, expire_signals, keyset_scan, batch_numbers, graphql_batches, enrich_lookup,
    refresh_coverage, key_hash_rate, canonical_names, entity_exact, entity_resolve, apply_canonical, llm_gate, raw_store, late_split, events_per_day, stream_upsert, stream_dedupe,
]
