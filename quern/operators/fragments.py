"""Fragments of a document ranked by keywords and chosen within a token budget."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import token_estimate, trimmed


def fragments(document: Column) -> Column:
    """Paragraphs between blank lines, trimmed, blank ones dropped."""
    return F.filter(F.transform(F.split(document, r"\n\s*\n"), trimmed), lambda x: x != "")


def ranked(document: Column, keywords: Column) -> Column:
    """array of struct(score, pos, text, tokens), best first; ties keep the document's order.

    Three points for each distinct keyword, half a point for under 120 characters, and 1 / place.
    """
    lowered = F.array_distinct(F.transform(keywords, F.lower))

    def scored(text: Column, i: Column) -> Column:
        words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_+-]+"), 0))
        score = 3.0 * F.size(F.array_intersect(words, lowered)) + F.when(F.length(text) < 120, 0.5).otherwise(0.0) + 1.0 / (i + 1)
        return F.struct((-score).alias("minus"), i.alias("pos"), text.alias("text"), token_estimate(text).alias("tokens"))

    ordered = F.array_sort(F.transform(fragments(document), scored))
    return F.transform(ordered, lambda f: F.struct((-f["minus"]).alias("score"), f["pos"].alias("pos"), f["text"].alias("text"), f["tokens"].alias("tokens")))


def selected(document: Column, keywords: Column, budget: Column) -> Column:
    """The ranked fragments that fit: one too large is passed over and later ones still tried."""
    start = F.struct(budget.cast("long").alias("left"), F.array().cast("array<struct<score:double,pos:int,text:string,tokens:bigint>>").alias("taken"))

    def take(state: Column, f: Column) -> Column:
        fits = f["tokens"] <= state["left"]
        return F.struct((state["left"] - F.when(fits, f["tokens"]).otherwise(0)).alias("left"), F.when(fits, F.concat(state["taken"], F.array(f))).otherwise(state["taken"]).alias("taken"))

    return F.aggregate(ranked(document, keywords), start, take, lambda s: s["taken"])


def provider_budget(max_input_tokens: Column) -> Column:
    return F.greatest(F.lit(128), max_input_tokens - 512)


def shrunk(payload: Column) -> Column:
    """Half of a payload that was too large, 384 characters at least."""
    return F.substring(payload, F.lit(1), F.greatest(F.lit(384), F.floor(F.length(payload) / 2)).cast("int"))
