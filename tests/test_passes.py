"""Counts from the pass that writes, articles with an error side, and functions under SQL names."""

import json

from pyspark.sql import functions as F

from quern.functions import sql
from quern.sinks import export
from quern.sources import feeds
from quern.streaming.metrics import MetricsLog


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_export_in_one_job(spark, tmp_path):
    rows = [("JOB", f"k{i}", i) for i in range(5)] + [("NEWS", "z", 9), ("NEWS", "a", 1)]
    df = spark.createDataFrame(rows, "record_type string, record_key string, n int")
    got, n = jobs(spark, "export", lambda: export.exported(df, f"{tmp_path}/r", ["STARTUP", "JOB", "NEWS"]))
    assert got == [("JOB", 5, "k0", "k4"), ("NEWS", 2, "a", "z")] and n == 1
    assert sorted(map(tuple, export.manifest(df).collect())) == sorted(got)
    assert spark.read.json(f"{tmp_path}/r").count() == 7
    got, n = jobs(spark, "lines", lambda: export.write_lines(df, f"{tmp_path}/l"))
    assert (got, n) == (7, 1)
    assert export.write_lines(df.where("n > 99"), f"{tmp_path}/none") == 0


def test_metrics_log(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 4).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    log = MetricsLog()
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").observe("seen", F.count(F.lit(1)).alias("n"), F.max("id").alias("hi"))
        query = stream.writeStream.queryName("numbers").format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(log)
    assert log.write(spark, f"{tmp_path}/log") == 3 and log.write(spark, f"{tmp_path}/log") == 0
    rows = [r for r in spark.read.parquet(f"{tmp_path}/log").orderBy("batch").collect() if r.input_rows]
    assert sum(json.loads(r.metrics)["seen"]["n"] for r in rows) == 12
    assert {json.loads(r.metrics)["seen"]["hi"] for r in rows} == {3, 13, 23}


def ld(**node):
    return f'<script type="application/ld+json">{json.dumps({"@type": "NewsArticle", **node})}</script><p>seen text</p>'


def test_articles_and_errors(spark):
    pages = [
        ("https://a.example/1", ld(articleBody=" body ", author={"name": "Ann"}), None), ("https://a.example/2", ld(author=[{"name": "Bo"}, "x", {"name": "Cy, Di"}, {}]), None), ("https://a.example/3", "<p>plain</p>", None),
        ("https://a.example/4", None, "HTTP 500"), ("https://a.example/5", "<title>Just a moment...</title>", None), ("https://a.example/1?utm_source=x", ld(articleBody="other"), "HTTP 404"),
    ]
    items = [("s", f"https://a.example/{k}", f"t{k}", "Eve, , Flo" if k == 3 else "") for k in range(1, 7)] + [("r", "https://a.example/1#top", "t", None)]
    fetched = feeds.fetched_articles(spark.createDataFrame(items, "source string, url string, title string, author string"), spark.createDataFrame(pages, "url string, html string, error string"))
    good, bad = feeds.split_errors(fetched)
    assert {(r.source, r.url): (r.full_text, r.authors, r.method) for r in good.collect()} == {
        ("s", "https://a.example/1"): ("body", ["Ann"], "json_ld"), ("r", "https://a.example/1#top"): ("body", ["Ann"], "json_ld"),
        ("s", "https://a.example/2"): ("seen text", ["Bo", "Cy", "Di"], "page_text"), ("s", "https://a.example/3"): ("plain", ["Eve", "Flo"], "page_text"),
    }
    assert {(r.url, r.reason) for r in bad.collect()} == {("https://a.example/4", "HTTP 500"), ("https://a.example/5", "blocked"), ("https://a.example/6", "not fetched")}
    assert {tuple(r) for r in feeds.yields(fetched).collect()} == {("s", 6, 3), ("r", 1, 1)}


def test_sql_names(spark):
    sql.register(spark)
    spark.createDataFrame([(1, ld(articleBody="b") + ld(headline="h")), (2, "<p>x &amp; y</p>"), (3, None)], "id int, html string").createOrReplaceTempView("some_pages")
    rows = spark.sql("SELECT id, n.pos, n.type, get_json_object(n.node, '$.articleBody') AS body FROM some_pages, LATERAL extract_json_ld(html) n ORDER BY id, pos").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "NewsArticle", "b"), (1, 1, "NewsArticle", None)]
    assert spark.sql("SELECT html_text(html) AS t, unescaped('&lt;') AS u, name_similarity('abcd', 'abcx') AS s, joined_url('https://a.example/b/', '../c') AS j FROM some_pages WHERE id = 2").first() == ("x & y", "<", 0.75, "https://a.example/c")
