"""News feeds (RSS and Atom) and article pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import canonical_url
from quern.functions.markup import html_text, joined_url, json_ld
from quern.functions.text import collapsed, is_blocked, trimmed
from quern.functions.times import parse_absolute
from quern.operators.dedupe import first_wins, per_source_top

_RSS = "channel struct<item:array<struct<title:string,link:string,pubDate:string,date:string>>>"
_ATOM = "entry array<struct<title:string,link:struct<_rel:string,_href:string>,id:string,summary:string,published:string,updated:string,author:array<struct<name:string>>>>"
# Types of linked data that are articles.
ARTICLE_TYPES = ["article", "newsarticle", "blogposting"]


def rss_items(feeds: DataFrame) -> DataFrame:
    """source, url, title, published_at of the items of RSS bodies (source, base, body)."""
    rows = feeds.select("source", "base", F.explode(F.from_xml("body", _RSS, {"ignoreNamespace": "true"})["channel"]["item"]).alias("i"))
    return _items(rows, F.col("i.link"), F.coalesce("i.pubDate", "i.date"))


def atom_entries(feeds: DataFrame) -> DataFrame:
    """The same of Atom bodies; the link's target is its ``href``."""
    rows = feeds.select("source", "base", F.explode(F.from_xml("body", _ATOM, {"ignoreNamespace": "true"})["entry"]).alias("i"))
    return _items(rows, F.col("i.link._href"), F.coalesce("i.published", "i.updated"))


def _items(rows: DataFrame, link, date) -> DataFrame:
    out = rows.select("source", joined_url("base", link).alias("url"), collapsed(F.col("i.title")).alias("title"), parse_absolute(date).alias("published_at"))
    return out.where("title != '' and url != ''")


def feed_items(feeds: DataFrame) -> DataFrame:
    """Items of bodies of either kind."""
    return rss_items(feeds.where("body like '%<rss%'")).unionByName(atom_entries(feeds.where("body not like '%<rss%'")))


def candidates(items: DataFrame, now: Column, n_sources: int, limit: int) -> DataFrame:
    """The items worth fetching: dated within a day before now (and five minutes past), an equal share of ``limit`` for each source, newest first.

    An address that two sources list counts for the first of them. Both cuts come before any page is read.
    """
    fresh = items.where(F.col("published_at").between(now - F.expr("INTERVAL '24' HOUR"), now + F.expr("INTERVAL '5' MINUTE")))
    shares = per_source_top(fresh, "source", n_sources, limit, F.col("published_at").desc(), F.col("url"))
    return first_wins(shares, ["url"], "source").orderBy("source", F.col("published_at").desc(), "url").limit(limit)


def atom_papers(feeds: DataFrame) -> DataFrame:
    """paper_id, title, abstract, published_at, authors of the entries of an archive's Atom bodies."""
    e = feeds.select(F.explode(F.from_xml("body", _ATOM, {"ignoreNamespace": "true"})["entry"]).alias("e"))
    url = F.regexp_replace(F.trim("e.id"), "^http:", "https:")
    return e.select(
        F.substring_index(F.substring_index(url, "/", -1), "v", 1).alias("paper_id"), collapsed(F.col("e.title")).alias("title"), collapsed(F.col("e.summary")).alias("abstract"),
        parse_absolute(F.col("e.published")).alias("published_at"), F.transform("e.author", lambda a: a["name"]).alias("authors"),
    )


def article_text(pages: DataFrame) -> DataFrame:
    """url, canonical, full_text: the body of the first article in linked data, else the visible text."""
    nodes = F.filter(json_ld("html"), lambda n: F.lower(F.coalesce(F.get_json_object(n, "$['@type']"), F.lit(""))).isin(ARTICLE_TYPES))
    body = F.get_json_object(F.get(nodes, 0), "$.articleBody")
    return pages.select("url", canonical_url(F.col("url")).alias("canonical"), F.coalesce(F.nullif(body, F.lit("")), html_text("html")).alias("full_text"))


def news(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items whose page was fetched, with its text; others go. The page's first spelling counts."""
    texts = article_text(pages.dropDuplicates(["url"])).groupBy("canonical").agg(F.min_by("full_text", "url").alias("full_text"))
    return items.withColumn("canonical", canonical_url(F.col("url"))).join(texts, "canonical")


def _names(author: Column) -> Column:
    """The names of a linked-data author: an object, or a list of which objects count, joined by commas."""
    listed = F.from_json(author, "array<string>")
    many = F.concat_ws(", ", F.transform(F.filter(listed, lambda a: F.startswith(F.ltrim(a), F.lit("{"))), lambda a: F.coalesce(F.get_json_object(a, "$.name"), F.lit(""))))
    return F.when(F.startswith(F.ltrim(author), F.lit("[")), many).otherwise(F.coalesce(F.get_json_object(author, "$.name"), F.lit("")))


def fetched_articles(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Every item (source, url, title, author) with what its fetch came to: canonical, full_text, authors, method, error.

    pages: url, html, error (null if the fetch went well). The error is the fetch's own, ``blocked`` for a challenge
    page, or ``not fetched``; such rows have no text. Authors are the feed's, else those of the article's linked data.
    An address counts once, canonical: of several spellings the least that went well. One pass; ``split_errors``
    parts it, and ``yields`` counts it.
    """
    own = pages.select(canonical_url(F.col("url")).alias("canonical"), "url", "html", F.when(is_blocked(F.lit("text/html"), F.col("html")), "blocked").otherwise(F.col("error")).alias("error"))
    first = own.groupBy("canonical").agg(F.min_by(F.struct("html", "error"), F.struct(F.col("error").isNotNull(), "url")).alias("page"))
    joined = items.withColumn("canonical", canonical_url(F.col("url"))).join(first, "canonical", "left")
    error = F.when(F.col("page").isNull(), "not fetched").otherwise(F.col("page.error"))
    read = joined.withColumn("error", error).withColumn("html", F.when(F.col("error").isNull(), F.col("page.html"))).drop("page")
    nodes = F.filter(json_ld("html"), lambda n: F.lower(F.coalesce(F.get_json_object(n, "$['@type']"), F.lit(""))).isin(ARTICLE_TYPES))
    read = read.withColumn("node", F.get(nodes, 0)).withColumn("body", F.nullif(trimmed(F.get_json_object("node", "$.articleBody")), F.lit("")))
    given = F.coalesce(F.nullif("author", F.lit("")), _names(F.get_json_object("node", "$.author")))
    names = F.filter(F.transform(F.split(given, ","), trimmed), lambda n: n != "")
    gone = F.col("error").isNotNull()
    return read.select(
        *items.columns, "canonical", F.when(~gone, F.coalesce("body", html_text("html"))).alias("full_text"), F.when(~gone, names).alias("authors"),
        F.when(~gone, F.when(F.col("body").isNotNull(), "json_ld").otherwise("page_text")).alias("method"), "error",
    )


def split_errors(fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles, and (source, url, reason) of the items without one."""
    return fetched.where("error is null").drop("error"), fetched.where("error is not null").select("source", F.col("canonical").alias("url"), F.col("error").alias("reason"))


def yields(fetched: DataFrame) -> DataFrame:
    """source, found, accepted: items before and after their fetch."""
    return fetched.groupBy("source").agg(F.count("*").alias("found"), F.count_if(F.col("error").isNull()).alias("accepted"))
