"""The leased queue over several micro-batches, whole and cut in other places."""

import pytest

from quern.streaming import leases

SCHEMA = "item string, at timestamp, seq long, kind string, owner string, error string"
T = "2024-01-01 00:{:02d}:{:02d}"
LOG = [
    # done by its owner; a later claim is refused
    ("a", 0, "claim", "w1"), ("a", 5, "ok", "w1"), ("a", 9, "claim", "w2"),
    # the lease of 120 s runs out by itself; the first owner's late acknowledgement is foreign, the second's counts
    ("b", 0, "claim", "w1"), ("b", 150, "claim", "w2"), ("b", 155, "ok", "w1"), ("b", 160, "ok", "w2"),
    # claimed while leased; then four failures, each due again after its delay, and dead
    ("c", 0, "claim", "w1"), ("c", 1, "claim", "w2"), ("c", 2, "error", "w1"), ("c", 2, "claim", "w1"), ("c", 10, "claim", "w1"), ("c", 11, "error", "w1"), ("c", 20, "claim", "w1"),
    ("c", 21, "error", "w1"), ("c", 60, "claim", "w1"), ("c", 61, "error", "w1"), ("c", 90, "claim", "w1"),
    # nobody comes back: the lease runs out when time goes on
    ("d", 30, "claim", "w3"),
]
WANT = {
    "a": ["claimed", "done", "refused"],
    "b": ["claimed", "expired", "claimed", "foreign", "done"],
    "c": ["claimed", "refused", "retry", "refused", "claimed", "retry", "claimed", "retry", "claimed", "dead", "refused"],
    "d": ["claimed", "expired"],
}


@pytest.mark.parametrize("cuts", [[3, 7, 12], [10], []])
def test_leases(spark, tmp_path, cuts):
    rows = [(i, T.format(s // 60, s % 60), n, k, o, "boom" if k == "error" else None) for n, (i, s, k, o) in enumerate(LOG)]
    rows = [r for n in range(4) for r in rows[n::4]] if cuts else rows  # out of order, within what ``late`` allows
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)] + [[(None, T.format(59, 0), -1, "clock", None, None)]]
    for p in parts:
        df = spark.createDataFrame(p, "item string, at string, seq long, kind string, owner string, error string")
        df.withColumn("at", df["at"].cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    log = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    leases.run_leases(log, f"{tmp_path}/out", f"{tmp_path}/check", 120, "10 minutes")
    got = spark.read.parquet(f"{tmp_path}/out/transitions").orderBy("at", "seq").collect()
    assert {i: [r.event for r in got if r.item == i] for i in WANT} == WANT
    dead = spark.read.parquet(f"{tmp_path}/out/dead").collect()
    assert [(r.item, r.attempts, r.owner, r.error) for r in dead] == [("c", 4, "w1", "boom")]
    assert len({r.batch for r in got}) >= 1


def test_a_clock_row_beside_numbered_items(spark, tmp_path):
    """The clock comes in the same batch as the items' events: their numbers stay what they are, beyond what a float holds, too."""
    big = 2**60 + 1
    events = [(7, 0, "claim"), (7, 5, "ok"), (big, 1, "claim"), (8, 2, "claim"), (8, 3, "error"), *((i, 4, "claim") for i in range(20, 50))]  # some in the clock's partition
    rows = [(i, T.format(s // 60, s % 60), n, k, "w1", None) for n, (i, s, k) in enumerate(events)] + [(None, T.format(59, 0), -1, "clock", None, None)]
    df = spark.createDataFrame(rows, "item long, at string, seq long, kind string, owner string, error string")
    df.withColumn("at", df["at"].cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/log")
    log = spark.readStream.schema(SCHEMA.replace("item string", "item long")).parquet(f"{tmp_path}/log")
    leases.run_leases(log, f"{tmp_path}/out", f"{tmp_path}/check", 120, "10 minutes")
    got = spark.read.schema(leases.TRANSITIONS.format("long")).parquet(f"{tmp_path}/out/transitions").orderBy("at", "seq").collect()
    assert {i: [r.event for r in got if r.item == i] for i in {r.item for r in got}} == {7: ["claimed", "done"], big: ["claimed", "expired"], 8: ["claimed", "retry"]} | {i: ["claimed", "expired"] for i in range(20, 50)}
