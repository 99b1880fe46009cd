"""Upserts by bucket: only touched buckets are written, reruns have no further effect, old folders go."""

import os

from quern.sinks.buckets import KeyedTable
from quern.streaming.keyed import run_available

SCHEMA = "k long, n long, v string"


def folders(path, version):
    return sorted(int(d.removeprefix("bucket=")) for d in os.listdir(f"{path}/v{version}") if d.startswith("bucket=")) if os.path.isdir(f"{path}/v{version}") else []


def test_upsert(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    t = KeyedTable(spark, path, SCHEMA, ["k"], ["n"], buckets=8)
    assert t.read().count() == 0 and t.versions() == []
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = t.upsert(df([(k, 1, "a") for k in range(100)]), 0)
    assert first == list(range(8)) == folders(f"{tmp_path}/t", 0)
    second = t.upsert(df([(5, 2, "b"), (5, 1, "old")]), 1)
    assert len(second) == 1 and folders(f"{tmp_path}/t", 1) == second
    assert t.upsert(df([]), 2) == [] and folders(f"{tmp_path}/t", 2) == []
    want = {k: (1, "a") for k in range(100)} | {5: (2, "b")}
    assert {r.k: (r.n, r.v) for r in t.read().collect()} == want
    assert second[0] not in folders(f"{tmp_path}/t", 0)  # replaced before the versions that are kept
    third = t.upsert(df([(7, 3, "c"), (None, 9, "z")]), 3)
    again = t.upsert(df([(7, 3, "c"), (None, 9, "z")]), 3)
    assert third == again and t.versions() == [2, 3]
    assert {r.k: (r.n, r.v) for r in t.read().collect()} == want | {7: (3, "c"), None: (9, "z")}


def test_stream(spark, tmp_path):
    rows = [[(k % 7, 10 * b + k, f"{b}-{k}") for k in range(9)] for b in range(3)]
    for part in rows:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    t = KeyedTable(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], ["n"], buckets=4)
    assert run_available(stream, t.upsert, f"{tmp_path}/c") == 2
    best = {}
    for k, n, v in sorted((r for part in rows for r in part), key=lambda r: r[1]):
        best[k] = (n, v)
    assert {r.k: (r.n, r.v) for r in t.read().collect()} == best
