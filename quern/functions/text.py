"""Text expressions. All run inside the JVM, but for name folding, which needs Unicode tables."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Phrases that mark a text as relevant.
RELEVANT_PHRASES = [
    "artificial intelligence",
    "machine learning",
    "deep learning",
    "generative ai",
    "large language model",
    "llm",
    "computer vision",
    "nlp",
    "natural language processing",
    "applied scientist",
    "data scientist",
    "ml engineer",
    "ai engineer",
    "research scientist",
]
# Role families and the words that name them; the first family with a hit counts.
ROLE_WORDS = {
    "Research": ["research", "scientist"],
    "Data": ["data scientist", "analytics", "data engineer"],
    "Product": ["product manager", "product designer"],
    "Engineering": ["engineer", "developer", "architect"],
    "Sales": ["sales", "account executive", "business development"],
    "Marketing": ["marketing", "growth"],
}
# Legal forms dropped from the end of a name.
LEGAL_FORMS = ["co", "company", "corp", "corporation", "inc", "incorporated", "ltd", "llc", "limited"]
# Marks of a page that blocks automated reading.
BLOCK_MARKS = [
    "cf-chl-",
    "cloudflare ray id",
    "/cdn-cgi/challenge-platform",
    "g-recaptcha-response",
    "datadome",
    "verify you are human",
    "<title>just a moment...</title>",
]


def trimmed(c: Column) -> Column:
    """Without white space at either end, of any kind."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def collapsed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return trimmed(F.regexp_replace(c, r"\s+", " "))


def holds_any(c: Column, phrases: list[str]) -> Column:
    """True if any phrase is a substring."""
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(c, F.lit(p))
    return out


def is_relevant(title: Column, description: Column) -> Column:
    """Any of the phrases in the title or the description's first 5000 characters, in any case."""
    text = F.concat(title, F.lit("\n"), F.substring(F.coalesce(description, F.lit("")), 1, 5000))
    return holds_any(F.lower(text), RELEVANT_PHRASES)


def role_family(title: Column) -> Column:
    """The first family whose words the title holds, else Other."""
    out, low = F, F.lower(title)
    for family, marks in ROLE_WORDS.items():
        out = out.when(holds_any(low, marks), family)
    return out.otherwise("Other")


def infer_remote(location: Column, explicit: Column) -> Column:
    """The explicit flag if there is one, else whether the location says so."""
    return F.coalesce(explicit, F.contains(F.lower(location), F.lit("remote")))


def is_blocked(content_type: Column, body: Column) -> Column:
    """An HTML page with a block mark in its first 200,000 characters."""
    return F.contains(F.lower(content_type), F.lit("text/html")) & holds_any(F.lower(F.substring(body, 1, 200_000)), BLOCK_MARKS)


def populated(value: Column) -> Column:
    """A value of text form that isn't null, empty, or an empty list or object. 0 and false count."""
    return value.isNotNull() & ~value.isin("", "[]", "{}")


def token_estimate(text: Column) -> Column:
    """A third of the length, rounded up, at least one."""
    return F.greatest(F.lit(1), F.floor((F.length(text) + 2) / 3)).cast("long")


def first_int(text: Column) -> Column:
    """The first run of digits as a number; null if there is none or it doesn't fit."""
    return F.regexp_extract(text, r"\d+", 0).try_cast("bigint")


def split_list(text: Column) -> Column:
    """Parts between commas, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(text, ","), trimmed), lambda x: x != "")


def clean_tags(tags: Column) -> Column:
    """Tags that aren't null or blank."""
    return F.filter(tags, lambda x: x.isNotNull() & (trimmed(x) != ""))


def without_controls(text: Column) -> Column:
    """Control characters but tab and line ends, and the two non-characters of the first plane, removed."""
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]", "")


def normalized_ascii_name(name: Column) -> Column:
    """Lower-case words of letters and digits, legal forms at the end dropped; for ASCII names."""
    words = F.array_join(F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), 0), " ")
    return F.regexp_replace(words, rf"(?:^| )(?:{'|'.join(LEGAL_FORMS)})(?: (?:{'|'.join(LEGAL_FORMS)}))*$", "")


@F.pandas_udf(T.StringType())
def folded(names: pd.Series) -> pd.Series:
    """Compatibility composition and case folding, for which the JVM has no expression."""
    return names.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s).casefold())


def normalized_name(name: Column) -> Column:
    """As ``normalized_ascii_name``, for names in any script. Only what isn't ASCII leaves the JVM's rules."""
    return normalized_ascii_name(folded(name))


def block_keys(normalized: Column) -> Column:
    """Keys under which similar names meet: first letters, initial and length, word count; none if empty."""
    compact = F.replace(normalized, F.lit(" "), F.lit(""))
    keys = F.array(
        F.concat(F.lit("prefix:"), F.substring(compact, 1, 4)),
        F.concat(F.lit("initial:"), F.substring(compact, 1, 1), F.lit(":"), F.floor(F.length(compact) / 4).cast("string")),
        F.concat(F.lit("tokens:"), F.size(F.split(normalized, " ")).cast("string"), F.lit(":"), F.substring(compact, 1, 2)),
    )
    return F.when(compact == "", F.array().cast("array<string>")).otherwise(keys)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all, matching blocks longest first. Order matters slightly."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def repo_url(field: Column, summary: Column) -> Column:
    """A code repository's address: the field, else the first in the summary, tidied at the end."""
    found = F.regexp_extract(F.coalesce(summary, F.lit("")), r"(?i)https?://github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+", 0)
    url = F.coalesce(F.nullif(field, F.lit("")), F.nullif(found, F.lit("")))
    return F.regexp_replace(F.regexp_replace(url, r"[.,);\]]+$", ""), r"\.git$", "")


def repo_parts(url: Column) -> Column:
    """owner and name of a repository address; nulls if it is none."""
    pattern = r"(?i)^https?://github\.com/([^/]+)/([^/#?]+)"
    name = F.regexp_replace(F.regexp_extract(url, pattern, 2), r"\.git$", "")
    return F.struct(F.nullif(F.regexp_extract(url, pattern, 1), F.lit("")).alias("owner"), F.nullif(name, F.lit("")).alias("name"))
