"""Text and data out of HTML, by Arrow UDFs on the standard library's parser."""

from __future__ import annotations

import contextlib
import html
import itertools
import json
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose text is not content; where content is looked for, best first.
DROPPED = {"script", "style", "noscript", "svg", "nav", "footer", "form"}
ROOTS = ("article", "main", "body")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


_BLANKS, _LINE_ENDS = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")


class _Texts(HTMLParser):
    """Text nodes with the elements they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.count = dict.fromkeys(ROOTS, 0)
        self.found: list[tuple[str, frozenset]] = []

    def handle_starttag(self, tag, attrs):
        if tag in self.count:
            self.count[tag] += 1
        if tag not in VOID:
            self.open.append((tag, self.count.get(tag, 0)))

    def handle_endtag(self, tag):
        names = [t for t, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        if data.strip() and not any(t in DROPPED for t, _ in self.open):
            self.found.append((data.strip(), frozenset(self.open)))


def visible_text(source: str) -> str:
    """The first article's, main's or body's text, else the page's: one line per text node."""
    p = _Texts()
    p.feed(source)
    p.close()
    root = next(((tag, 1) for tag in ROOTS if p.count[tag]), None)
    text = "\n".join(t for t, inside in p.found if root is None or root in inside)
    # blanks within a line become one, then blanks around line ends and empty lines go
    return _LINE_ENDS.sub("\n", _BLANKS.sub(" ", text)).strip(" \n")


@F.pandas_udf(T.StringType())
def html_text(pages: pd.Series) -> pd.Series:
    """Visible text of each page."""
    return pages.map(lambda s: None if s is None else visible_text(s))


class _Attribute(HTMLParser):
    def __init__(self, name: str) -> None:
        super().__init__(convert_charrefs=True)
        self.name, self.value = name, None

    def handle_starttag(self, tag, attrs):
        if self.value is None:
            self.value = dict(attrs).get(self.name)


@F.pandas_udf(T.StringType())
def data_page(pages: pd.Series) -> pd.Series:
    """The first ``data-page`` attribute, entities resolved; null if there is none."""

    def one(s):
        p = _Attribute("data-page")
        p.feed(s or "")
        return p.value

    return pages.map(one)


class _Scripts(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.inside, self.texts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside = tag == "script" and (dict(attrs).get("type") or "").lower() == "application/ld+json"
        if self.inside:
            self.texts.append("")

    def handle_endtag(self, tag):
        self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.texts[-1] += data


def _parsed(script: str):
    with contextlib.suppress(ValueError):
        return json.loads(script)


def _opened(node) -> list:
    match node:
        case {"@graph": [*members]}:
            return members
    return [node]


def linked_nodes(source: str) -> list[str]:
    """JSON objects of all linked-data scripts: lists and graphs opened up, broken scripts passed over."""
    p = _Scripts()
    p.feed(source)
    p.close()
    roots = itertools.chain.from_iterable(x if isinstance(x, list) else [x] for x in map(_parsed, p.texts))
    return [json.dumps(x) for x in itertools.chain.from_iterable(map(_opened, roots)) if isinstance(x, dict)]


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_ld(pages: pd.Series) -> pd.Series:
    """Linked-data objects of each page."""
    return pages.map(lambda s: linked_nodes(s or ""))


@F.pandas_udf(T.StringType())
def joined_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link resolved against its page."""
    return pd.Series([None if b is None or x is None else urljoin(b, x) for b, x in zip(base, link, strict=True)])


@F.pandas_udf(T.StringType())
def unescaped(texts: pd.Series) -> pd.Series:
    """Character entities resolved."""
    return texts.map(lambda s: None if s is None else html.unescape(s))
