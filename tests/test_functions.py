"""Column functions on small rows with known results."""

import hashlib

from pyspark.sql import functions as F

from quern.functions import keys, markup, text, times
from quern.operators import evidence, fragments
from quern.operators.enrich import fallback


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_canonical_url(spark):
    cases = {
        "HTTPS://Shop.Test/list/?utm_medium=m&k=v#top": "https://shop.test/list?k=v",
        " http://u@h.org:80//a//b/?z=1&a=&REF=q ": "http://h.org/a/b?a=&z=1",
        "https://h.org:8443": "https://h.org:8443/",
    }
    for url, expected in cases.items():
        assert one(spark, url, keys.canonical_url) == expected


def test_stable_key(spark):
    key = one(spark, " 1234 ", lambda c: keys.stable_key(F.lit(" arXiv "), c))
    assert key == hashlib.sha256(b"arxiv:1234").hexdigest()


def test_web_url(spark):
    got = [one(spark, u, keys.is_web_url) for u in ("https://a.b/c", "ftp://a.b", "https://", "", None)]
    assert got == [True, False, False, False, False]


def test_names(spark):
    assert one(spark, "Ferrox, Inc.", text.normalized_name) == "ferrox"
    assert one(spark, "ﬁStraße Co Ltd", text.normalized_name) == "fistrasse"
    assert one(spark, "Company", text.normalized_name) == ""
    assert set(one(spark, "acme works", text.block_keys)) == {"prefix:acme", "initial:a:2", "tokens:2:ac"}
    assert one(spark, "", text.block_keys) == []


def test_similarity_is_not_symmetric(spark):
    row = spark.createDataFrame([("tide", "diet")], "a string, b string").select(text.similarity("a", "b").alias("x"), text.similarity("b", "a").alias("y")).first()
    assert (row.x, row.y) == (0.25, 0.5)


def test_roles_and_relevance(spark):
    assert one(spark, "Data Scientist", text.role_family) == "Research"
    assert one(spark, "Cook", text.role_family) == "Other"
    assert one(spark, "An LLM", lambda c: text.is_relevant(c, F.lit(None).cast("string"))) is True


def test_repo_url(spark):
    found = one(spark, "Sources at https://github.com/qed-lab/solver.git.", lambda c: text.repo_url(F.lit(None).cast("string"), c))
    assert found == "https://github.com/qed-lab/solver"


def test_times(spark):
    at = F.lit("2025-03-10 08:30:00").cast("timestamp")
    row = one(spark, "45 minutes ago", lambda c: times.parse_relative(c, at))
    assert str(row.published_at) == "2025-03-10 07:45:00" and row.method == "relative_unit"
    assert str(one(spark, "0", times.parse_absolute)) == "1970-01-01 00:00:00"
    assert one(spark, "2024-01-01 00:00:00", times.parse_absolute) is None
    assert one(spark, "2024-01-01 00:00:00", lambda c: times.parse_absolute(c, True)) is not None
    assert str(one(spark, "Tue, 02 Jan 2024 03:04:05 GMT", times.parse_absolute)) == "2024-01-02 03:04:05"


def test_freshness_bounds(spark):
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    cases = {"2024-01-01 00:00:00": "VERIFIED", "2023-12-31 23:59:59": "STALE", "2024-01-02 00:05:00": "VERIFIED", "2024-01-02 00:05:01": "UNCERTAIN", None: "UNCERTAIN"}
    for value, status in cases.items():
        assert one(spark, value, lambda c: times.freshness(c.cast("timestamp"), at, F.lit(1.0))).status == status


def test_html():
    page = "<footer>y</footer><main><h2>Opening  hours</h2><p>Nine to\n \n five\u00a0sharp</p><script>no</script></main>"
    assert markup.visible_text(page) == "Opening hours\nNine to\nfive sharp"
    assert markup.linked_nodes('<script type="application/ld+json">{"@graph":[{"a":1},2]}</script><script type="application/ld+json">{</script>') == ['{"a": 1}']


def test_fragments(spark):
    doc = "About us and more.\n\nPricing is free and paid.\n\nContact."
    words = F.array(F.lit("pricing"), F.lit("free"), F.lit("paid"))
    got = one(spark, doc, lambda c: fragments.selected(c, words, F.lit(20)))
    assert got[0].text.startswith("Pricing") and sum(f.tokens for f in got) <= 20


def test_fallback(spark):
    def run(rows, retries):
        listed = F.array(*[F.array(*map(F.lit, r)) for r in rows])
        return tuple(spark.range(1).select(fallback(listed, retries).alias("f")).first().f)

    assert run([["429", "429"], ["ok"]], 1) == (2, 3)
    assert run([["permanent"], ["ok"]], 3) == (2, 2)
    assert run([["x"], ["x"]], 0) == (0, 2)


def test_quotes(spark):
    got = [one(spark, q, lambda c: evidence.quoted(F.lit("has a free plan"), c)) for q in (" free plan ", "Free", " ", None)]
    assert got == [True, False, False, False]
