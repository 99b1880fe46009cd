"""Adapters: each sees its own bodies, limits hold for each, what no adapter takes goes aside."""

import json

import pytest
from pyspark.sql import functions as F

from quern.sources.adapters import collect, known_adapters


class Letters:
    """An adapter of another class: a record for each letter of a body."""

    name = "letters"

    def records(self, bodies):
        rows = bodies.select("page", F.posexplode(F.split("body", "")).alias("pos", "title"))
        return rows.select(F.concat_ws(":", "page", "pos").alias("record_key"), "title", "page", "pos")


def _bodies(spark):
    listed = json.dumps([{"id": f"own/app-{i}", "likes": i} for i in range(5)])
    rows = [("spaces", 1, listed), ("letters", 2, "abc"), ("letters", 1, "x yz"), ("letters", 3, None), ("web", 4, "<p>"), (None, 5, "abc"), ("papers", 1, "broken ["), ("directory", 1, "<p>no data</p>")]
    return spark.createDataFrame(rows, "source string, page long, body string")


def test_collect(spark):
    found, aside = collect(_bodies(spark), [*known_adapters(), Letters()])
    rows = found.collect()
    assert sorted(r.title for r in rows if r.source == "spaces") == [f"app {i}" for i in range(5)]
    assert sorted(r.title for r in rows if r.source == "letters") == list("abcxyz")
    assert {r.source for r in rows} == {"spaces", "letters"}
    assert sorted(map(tuple, aside.collect()), key=repr) == sorted([("web", 4, "no adapter"), (None, 5, "no adapter"), ("letters", 1, "invalid")], key=repr)


def test_limit_is_each_adapters_own(spark):
    found, _ = collect(_bodies(spark), [*known_adapters(), Letters()], limit=3)
    rows = found.collect()
    assert sorted(r.title for r in rows if r.source == "letters") == ["x", "y", "z"]  # page 1 comes first
    assert sum(r.source == "spaces" for r in rows) == 3


def test_none(spark):
    found, aside = collect(_bodies(spark), [])
    assert found.count() == 0 and aside.count() == 8
    found, aside = collect(_bodies(spark).limit(0), [*known_adapters(), Letters()])
    assert found.count() == aside.count() == 0
    with pytest.raises(ValueError):
        collect(_bodies(spark), [Letters(), Letters()])
