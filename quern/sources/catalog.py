"""Catalog pages: companies embedded in HTML, product lists with cursors, daily papers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import stable_key
from quern.functions.markup import data_page
from quern.functions.text import clean_tags, first_int, repo_url, trimmed
from quern.operators.dedupe import first_wins


def embedded_companies(pages: DataFrame) -> DataFrame:
    """page, pos, company: JSON of each company in the page's ``data-page`` attribute; none if it lacks."""
    listed = F.from_json(F.get_json_object(data_page("html"), "$.props.companies"), "array<string>")
    return pages.select("page", F.posexplode(listed).alias("pos", "company"))


def startups(pages: DataFrame) -> DataFrame:
    """Typed startups, first of each slug."""
    f = lambda name: F.get_json_object("company", f"$.{name}")
    rows = embedded_companies(pages).select(
        "page", "pos", f("slug").alias("slug"), f("name").alias("entity_name"), F.coalesce(F.nullif(trimmed(f("long_description")), F.lit("")), f("one_liner")).alias("description"),
        f("website").alias("website"), F.upper(f("batch_name")).alias("batch"), F.coalesce(first_int(f("team_size")), first_int(f("employee_count"))).alias("employee_count"),
        clean_tags(F.from_json(f("tags"), "array<string>")).alias("tags"),
    )
    return first_wins(rows.where("slug != ''"), ["slug"], "page", "pos")


def next_cursor(link_header):
    """The address of the next page in a Link header; empty if there is none."""
    return F.regexp_extract(link_header, r'<([^>]+)>;\s*rel="next"', 1)


def products(raw: DataFrame) -> DataFrame:
    """Products of listing bodies (page, body): private ones and ids without an owner go, first of each id."""
    item = raw.select("page", F.posexplode(F.from_json("body", "array<struct<id:string,private:boolean,likes:int,sdk:string,cardData:struct<title:string,short_description:string>,tags:array<string>>>")).alias("pos", "i"))
    rows = item.where("i.id like '%/%' and not coalesce(i.private, false)").select("page", "pos", "i.*")
    slug = F.regexp_replace(F.split("id", "/", 2)[1], "[-_]", " ")
    rows = rows.select("page", "pos", "id", "likes", "sdk", F.split("id", "/", 2)[0].alias("startup_name"), F.coalesce(F.nullif(F.col("cardData.title"), F.lit("")), slug).alias("product_name"), clean_tags(F.col("tags")).alias("tags"))
    return first_wins(rows, ["id"], "page", "pos").withColumn("record_key", stable_key(F.lit("space"), F.lower("id")))


def papers(raw: DataFrame, require_repo: bool = False) -> DataFrame:
    """Papers of daily bodies (page, body); an entry may wrap its paper. First of each id, then the filter."""
    kind = "id string, title string, summary string, publishedAt string, githubRepo string, githubStars int"
    listed = F.from_json("body", "array<string>")
    item = raw.select("page", F.posexplode(listed).alias("pos", "e"))
    paper = F.from_json(F.coalesce(F.get_json_object("e", "$.paper"), F.col("e")), kind)
    rows = first_wins(item.select("page", "pos", paper.alias("p")).select("page", "pos", "p.*").where("id != ''"), ["id"], "page", "pos")
    rows = rows.withColumn("github_url", repo_url(F.col("githubRepo"), F.col("summary"))).withColumn("record_key", stable_key(F.lit("arxiv"), F.substring_index("id", "v", 1)))
    return rows.where("github_url is not null") if require_repo else rows
