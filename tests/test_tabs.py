"""Cells of the tabs: routes, lists, numbers, times, control characters, what is missing."""

import json

from quern.sinks import tabs


def test_cells(spark):
    docs = [
        {"recordKey": "a", "recordType": "STARTUP", "schemaVersion": "1.1", "source": {"name": "s", "url": "u", "contentHash": "h"}, "collectedAt": "2024-01-02T03:04:05+01:00",
         "content": {"entityName": "A\u0001c\tme", "data": {"employeeCount": 12}, "tags": ["x", None, "y", 3], "status": None, "batch": 7}},
        {"recordKey": "b", "recordType": "STARTUP", "source": None, "content": {"data": None, "tags": []}, "collectedAt": "someday"},
        {"recordKey": "c", "recordType": "JOB", "content": {"is_remote": True, "freshness_confidence": 0.9}}, {"recordKey": "d", "recordType": "STARTUP"},
    ]
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("[1]",), ("broken",), (None,), ("",)], "document string")
    got = {r.recordKey: r for r in tabs.tab(rows, "STARTUP").collect()}
    assert set(got) == {"a", "b", "d"}
    a = got["a"]
    assert (a.entityName, a.data_employeeCount, a.tags, a.status, a.batch, a.collectedAt, a.source_name) == ("Ac\tme", 12, "x, , y, 3", "", "7", "2024-01-02 02:04:05", "s")
    assert (got["b"].tags, got["b"].data_employeeCount, got["b"].source_url, got["b"].collectedAt) == ("", None, "", "someday")
    assert got["d"].collectedAt is None and got["d"].entityName == ""
    job = tabs.tab(rows, "JOB").collect()
    assert [(r.is_remote, r.freshness_confidence, r.date) for r in job] == [(True, 0.9, None)]
    assert tabs.tab(rows.limit(0), "NEWS").collect() == []


def test_mapping(spark):
    log = spark.createDataFrame([("A\u0002", "a", None, "fuzzy", 0.5, "NEW_ENTITY", "1.0", 1)], "raw_name string, normalized_name string, canonical_name string, method string, confidence double, status string, resolver_version string, extra int")
    assert [tuple(r) for r in tabs.mapping_tab(log).collect()] == [("A", "a", "", "fuzzy", 0.5, "NEW_ENTITY", "1.0")]
