"""A record view over the star-schema tables, so that record operators run on data of any size.

Suppliers stand for startups, parts for products, documents for papers, orders for jobs, and pages with
the event of equal id for news. Flaws come by fixed rules on the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The clock of all queries: nothing depends on the time of day.
NOW = "2024-01-30 12:00:00"

FIELDS = {
    "STARTUP": ["entityName", "rawEntityName", "description"],
    "PRODUCT": ["productName", "startupName", "rawStartupName", "pricingModel", "description"],
    "RESEARCH_PAPER": ["title", "authors", "paper_url", "published_date", "github_url", "github_stars", "github_stars_source", "github_stars_collected_at", "abstract"],
    "JOB": ["company", "rawCompany", "title", "date", "is_remote", "role_family", "full_text"],
    "NEWS": ["title", "publisher", "published_at", "full_text"],
}


def now() -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{NOW}'").cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _record(rows: DataFrame, kind: str, id_: str, values: dict[str, Column]) -> DataFrame:
    """Envelope around the values: key, address, content and evidence, with their planted flaws."""
    n = F.col(id_)
    low = kind.lower()
    key = F.concat(F.lit(f"{low}:"), (n - F.when(n % 97 == 0, 1).otherwise(0)).cast("string"))
    url = F.when(n % 41 == 0, F.concat(F.lit("ftp://example.org/"), n.cast("string"))).otherwise(F.concat(F.lit(f"https://example.org/{low}/"), n.cast("string")))
    content = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[v.cast("string") for v in values.values()]))
    each = [
        F.when(~((n % 23 == 0) & F.lit(k == 0)), F.struct(F.lit(f).alias("field"), F.lit("api").alias("method"), F.lit("https://example.org").alias("source_url"), F.concat(F.lit("/"), F.lit(f)).alias("source_pointer"), F.lit(1.0).alias("confidence")))
        for k, f in enumerate(values)
    ]
    return rows.select(F.lit(kind).alias("record_type"), n.cast("long").alias("rid"), key.alias("record_key"), F.lit(low).alias("source_name"), url.alias("source_url"), content.alias("content"), F.array_compact(F.array(*each)).alias("evidence"))


def record_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_type, rid, record_key, source_name, source_url, content, evidence."""
    s, p, d, o = (table(spark, sf_dir, t) for t in ("supplier", "part", "documents", "orders"))
    news = table(spark, sf_dir, "pages").join(table(spark, sf_dir, "events"), F.col("page_id") == F.col("event_id"))
    model = F.element_at(F.array(*map(F.lit, ["FREE", "PAID", "BARTER"])), F.least(F.col("p_partkey") % 7, F.lit(2)).cast("int") + 1)
    startups = _record(s, "STARTUP", "s_suppkey", {"entityName": F.col("s_name"), "rawEntityName": F.when(F.col("s_suppkey") % 13 != 0, F.concat("s_name", F.lit(", Inc."))), "description": F.lit("")})
    collides = F.when(F.col("p_partkey") % 29 == 0, F.col("p_brand")).otherwise(F.col("p_name"))
    products = _record(p, "PRODUCT", "p_partkey", {"productName": collides, "startupName": F.col("p_brand"), "rawStartupName": F.col("p_brand"), "pricingModel": F.when(F.col("p_partkey") % 7 < 3, model), "description": F.col("p_type")})
    number = F.col("doc_id").cast("string")
    papers = _record(d, "RESEARCH_PAPER", "doc_id", {
        "title": F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), "authors": F.col("source"), "paper_url": F.concat(F.lit("https://example.org/p/"), number), "published_date": F.lit("2024-01-01"),
        "github_url": F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("https://github.com/o"), (F.col("doc_id") % 50).cast("string"), F.lit("/r"), number)), "github_stars": F.col("n_chars"),
        "github_stars_source": F.when(F.col("doc_id") % 5 == 0, "cache").otherwise("github_graphql"),
        "github_stars_collected_at": F.when(F.col("doc_id") % 7 == 0, "unknown").when(F.col("doc_id") % 11 == 0, "2024-01-01 00:00:00").otherwise("2024-01-30 06:00:00"), "abstract": F.col("text"),
    })
    jobs = _record(o, "JOB", "o_orderkey", {
        "company": F.concat(F.lit("c"), (F.col("o_custkey") % 100).cast("string")), "rawCompany": F.concat(F.lit("C"), (F.col("o_custkey") % 100).cast("string")), "title": F.col("o_orderpriority"),
        "date": F.when(F.col("o_orderkey") % 19 == 0, F.lit(None).cast("string")).when(F.col("o_orderkey") % 2 == 0, "2024-01-30 02:00:00").otherwise(stamp("o_orderdate")),
        "is_remote": (F.col("o_orderkey") % 2 == 0), "role_family": F.lit("Other"), "full_text": F.col("o_orderstatus"),
    })
    stories = _record(news, "NEWS", "page_id", {"title": F.concat(F.lit("story "), F.col("event_type")), "publisher": F.lit("example"), "published_at": stamp("ts"), "full_text": F.col("html")})
    return startups.unionByName(products).unionByName(papers).unionByName(jobs).unionByName(stories)
