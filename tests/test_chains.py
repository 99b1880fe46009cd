"""Cursor chains against a walk from page to page."""

import random

from quern.sources.chains import chained


def walk(pages, starts):
    places, aside = set(), set()
    for s in sorted(starts):
        if s not in pages:
            continue
        at, place, seen = s, 0, set()
        while True:
            if at not in pages:
                aside.add((at, "missing"))
                break
            seen.add(at)
            places.add((s, place, at))
            to = pages[at]
            if not to:
                break
            if to in seen:
                aside.add((at, "cycle"))
                break
            at, place = to, place + 1
    reached = {a for _, _, a in places}
    return places, aside | {(a, "unreached") for a in pages if a not in reached}


def test_chains(spark):
    rnd = random.Random(9)
    pages = {f"p{i}": f"p{i + 1}" for i in range(40)} | {"p40": "", "q0": "q1", "q1": "q2", "q2": "q0", "r0": "gone", "s0": None, "t0": "p35", "u0": "u0"}
    pages |= {f"x{i}": f"x{rnd.randrange(30)}" for i in range(30)}
    starts = {"p0", "q1", "r0", "s0", "t0", "u0", "x3", "x7", "absent"}
    rows = [*pages.items(), ("p3", "p4"), (None, "p1")]
    inside, aside = chained(spark.createDataFrame(rows, "address string, next string"), spark.createDataFrame([(s,) for s in starts] + [(None,)], "start string"))
    places, left = walk(pages, starts)
    assert {tuple(r) for r in inside.collect()} == places
    assert {tuple(r) for r in aside.collect()} == left
    none = spark.createDataFrame([], "address string, next string")
    inside, aside = chained(none, spark.createDataFrame([("p0",)], "start string"))
    assert inside.count() == aside.count() == 0
