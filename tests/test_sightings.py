"""First seen over scans in several micro-batches, in order and not, against the rule in plain Python."""

import random

import pytest

from quern.streaming import sightings

T0 = 1_704_067_200
SCHEMA = "source string, at long, item string, ord long"


def scans(seed):
    """source -> [(time, {item: ord}, complete)], items come and go; one scan a source isn't complete, one comes after a gap."""
    rng, out = random.Random(seed), {}
    for source in ("a", "b"):
        at, top, held, rows = T0, 0, {}, []
        for k in range(7):
            at += 30 * 3600 if k == 4 else 6 * 3600
            held = {i: o for i, o in held.items() if rng.random() < 0.7}
            for _ in range(4):
                top += 1
                # some new items are placed behind the head
                held[f"{source}{rng.randrange(12)}"] = top if rng.random() < 0.7 else top - 9
            rows.append((at, dict(held), k != 2))
        out[source] = rows
    return out


def decided(rows):
    last, out = None, set()
    for source, several in rows.items():
        last = None
        for at, items, complete in several:
            if not complete:
                continue
            head = max(items.values())
            for item, order in items.items():
                enough = last is not None and item not in last[1] and order > last[2]
                method = "first_seen_insufficient_evidence" if not enough else "first_seen_scan_gap" if at - last[0] > 86_400 else "first_seen_after_previous_head"
                out.add((source, at, item, order, method, method.endswith("head")))
            last = (at, items, head)
    return out


@pytest.mark.parametrize(("seed", "cuts"), [(1, 1), (2, 3)])
def test_first_seen(spark, tmp_path, seed, cuts):
    data = scans(seed)
    log = [(s, at, i, o) for s, several in data.items() for at, items, _ in several for i, o in items.items()]
    log += [(s, at, i, o - 20) for s, at, i, o in log[::5]]  # repeated items count once
    log += [(s, at, None, max(items.values())) for s, several in data.items() for at, items, complete in several if complete]
    random.Random(seed).shuffle(log)
    clock = [(None, T0 + 90 * 86_400, None, None)]
    for part in [*(log[k::cuts] for k in range(cuts)), clock]:
        df = spark.createDataFrame(part, SCHEMA)
        df.select("source", df["at"].cast("timestamp").alias("scan_at"), "item", "ord").coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema("source string, scan_at timestamp, item string, ord long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    sightings.run_first_seen(stream, f"{tmp_path}/out", f"{tmp_path}/check", "30 days", parts=3)
    got = spark.read.schema(sightings.DECISIONS.format("string", "string")).parquet(f"{tmp_path}/out").collect()
    want = decided(data)
    assert len(got) == len(want)
    assert {(r.source, int(r.scan_at.timestamp()), r.item, r.ord, r.method, r.accepted) for r in got} == want
    assert {r.method for r in got} == {"first_seen_insufficient_evidence", "first_seen_scan_gap", "first_seen_after_previous_head"}
