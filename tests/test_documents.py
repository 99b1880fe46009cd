"""Public documents and back: the identity, older shapes, and what goes aside."""

import json

from pyspark.sql import functions as F

from quern.sinks.documents import hydrated_records, public_documents

PROOF = {"field": "entityName", "method": "api", "sourceUrl": "https://a.example", "sourcePointer": "/n", "excerpt": None, "confidence": 0.5}
WHOLE = {
    "schemaVersion": "1.1", "recordKey": "k1", "recordType": "STARTUP", "source": {"name": "s", "url": "https://a.example", "retrievedAt": "2024-01-30T12:00:00+00:00", "contentHash": "abc"},
    "content": {"entityName": "Acmé \"x\"", "n": 3, "f": 1.5, "tags": ["a", "b"], "none": None, "deep": {"b": [1, {"c": True}]}, "": "odd"}, "evidence": [PROOF], "collectedAt": "2024-01-30T12:00:00.250000+00:00",
}
SNAKE = {
    "record_key": "k2", "record_type": "JOB", "source": {"name": "s", "url": "u", "retrieved_at": "2024-01-30T12:00:00+02:00", "content_hash": "h"}, "content": {"title": "t"},
    "evidence": [{"field": "title", "method": "feed", "source_url": "u", "source_pointer": "p"}, "odd", 3], "collected_at": "2024-01-30T12:00:00+00:00",
}


def change(doc, **parts):
    return json.dumps({k: v for k, v in {**doc, **parts}.items() if v != "gone"})


def test_round_trip(spark):
    docs = [json.dumps(WHOLE), json.dumps(SNAKE), change(WHOLE, recordKey="k3", evidence=[], content={}), change(WHOLE, recordKey="k4", schemaVersion=""), change(SNAKE, record_key="k5", recordKey="camel"), change(SNAKE, record_key="k6", evidence="gone", content="gone")]
    df = spark.createDataFrame([(d,) for d in docs], "document string")
    records, aside = hydrated_records(df)
    assert aside.count() == 0
    out = {r.record_key: json.loads(r.document) for r in public_documents(records).collect()}
    assert out["k1"] == WHOLE
    assert out["k3"]["content"] == {} and out["k3"]["evidence"] == []
    assert out["k4"]["schemaVersion"] == out["k2"]["schemaVersion"] == "1.0"
    assert set(out) == {"k1", "k2", "k3", "k4", "camel", "k6"}
    assert out["k2"]["evidence"] == [{"field": "title", "method": "feed", "sourceUrl": "u", "sourcePointer": "p", "excerpt": None, "confidence": 1.0}]
    assert out["k2"]["source"]["retrievedAt"] == "2024-01-30T10:00:00+00:00"
    once = public_documents(records)
    again = public_documents(hydrated_records(once.select("document"))[0])
    assert sorted(once.collect()) == sorted(again.collect())


def test_aside(spark):
    bad = {
        "{": "not_json", "[1]": "not_object", '"x"': "not_object", "null": "not_object", change(WHOLE, recordKey=None): "record_key", change(WHOLE, recordType="OTHER"): "record_type",
        change(WHOLE, source=None): "source", change(WHOLE, source=[1]): "source", change(WHOLE, collectedAt="soon"): "time", change(WHOLE, evidence=[{**PROOF, "method": "magic"}]): "evidence",
        change(WHOLE, evidence=[{**PROOF, "confidence": 1.5}]): "confidence", change(WHOLE, evidence=[{**PROOF, "confidence": None}]): "confidence",
    }
    records, aside = hydrated_records(spark.createDataFrame([(d,) for d in bad] + [(None,)], "document string"))
    assert records.count() == 0
    assert {r.document: r.reason for r in aside.collect()} == bad | {None: "not_json"}


def test_no_rows(spark):
    records, aside = hydrated_records(spark.createDataFrame([], "document string"))
    assert records.count() == aside.count() == public_documents(records).where(F.col("document").isNotNull()).count() == 0


def test_records_are_read_and_read_again_in_one_pass(spark):
    """The pages and the events meet in the only join: a record and its public document stay in one row."""
    from quern.plans import records

    plan = records.hydrate_records(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
