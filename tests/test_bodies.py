"""The log of raw bodies: batches and streams of it give the same rows, tasks read their ranges alone."""

import io
import tempfile

import pytest

from quern.sources import bodies
from quern.sources.bodies import RawBodies, append_bodies, split_lines


def test_ranges_have_each_line_once():
    data = b"a\n\nbb\r\nccc\n" + b"d" * 40 + b"\nlast"
    lines = [x.rstrip(b"\r") for x in data.split(b"\n")]
    for size in range(1, len(data) + 2):
        raw = io.BufferedReader(io.BytesIO(data))
        got = [x for at in range(0, len(data), size) for x in split_lines(raw, at, min(at + size, len(data)))]
        assert got == lines, size


def test_rows_of_odd_lines():
    names = ["address", "body", "page"]
    assert bodies._row(b'{"address": "x", "page": 3}', names) == {"address": "x", "body": None, "page": 3}
    for line in (b"[1]", b"broken {", b"", b"null"):
        assert bodies._row(line, names) == {"address": None, "body": line.decode(), "page": None}


@pytest.fixture
def log(spark):
    spark.dataSource.register(RawBodies)
    return tempfile.mkdtemp(prefix="spark-")


def _frame(spark, ids):
    rows = [(i, f"https://example.org/{i}", None if i % 7 == 0 else f"line\n  é {i}" * (i % 5)) for i in ids]
    return spark.createDataFrame(rows, "page long, address string, body string").repartition(2)


def test_batch_and_stream(spark, log):
    read = lambda: {tuple(r) for r in spark.read.format("raw_bodies").option("split_bytes", 100).load(log, schema="page long, address string, body string").collect()}
    assert read() == set()
    first, second = _frame(spark, range(40)), _frame(spark, range(40, 60))
    append_bodies(first, log, 0)
    stream = spark.readStream.format("raw_bodies").schema("page long, address string, body string").option("split_bytes", 100).load(log)
    asked = stream.writeStream.format("memory").queryName("bodies_seen").option("checkpointLocation", tempfile.mkdtemp(prefix="spark-")).start()
    try:
        asked.processAllAvailable()
        assert {tuple(r) for r in spark.table("bodies_seen").collect()} == {tuple(r) for r in first.collect()} == read()
        append_bodies(second, log, 2)  # held back: batch 1 isn't there yet
        asked.processAllAvailable()
        assert spark.table("bodies_seen").count() == 40 == len(read())
        append_bodies(second.limit(0), log, 1)
        asked.processAllAvailable()
        seen = [tuple(r) for r in spark.table("bodies_seen").collect()]
        assert len(seen) == 60 and set(seen) == read() == {tuple(r) for r in first.unionByName(second).collect()}
        assert "3" in str(asked.lastProgress["sources"][0]["endOffset"])
    finally:
        asked.stop()


def test_ranges_are_tasks(spark, log):
    append_bodies(_frame(spark, range(200)), log, 0)
    reader = RawBodies({"path": log, "split_bytes": "1000"}).reader(RawBodies({"path": log}).schema)
    parts = reader.partitions()
    assert len(parts) > 5 and all(p.end - p.start <= 1000 for p in parts)
    assert spark.read.format("raw_bodies").option("split_bytes", 1000).load(log).rdd.getNumPartitions() == len(parts)
    append_bodies(_frame(spark, range(3)), log, 0)  # the same number again replaces
    assert spark.read.format("raw_bodies").load(log).count() == 3
