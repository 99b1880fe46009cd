"""Conversation repair against an exhaustive search over all edits, whole and in chunks of a few rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import conversations as cv

SPACES = " \t\n\v\f\r"
GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, n int, seq string"


def cheapest(kinds, most_inserts):
    """(cost, audit, roles) of the least edit sequence with at most so many inserts in each gap, by trying all."""
    best = None
    runs = [r for k in range(most_inserts + 1) for r in product("ua", repeat=k)]
    options = []
    for k in kinds:
        one = [("D", 2, "")]
        if k != "d":
            extra = 5 if k.isupper() else 0
            one += [("K", extra, k.lower()), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]
        options.append(one)
    for gaps in product(runs, repeat=len(kinds) + 1):
        for edits in product(*options):
            audit, roles, cost = "I" * len(gaps[0]), "".join(gaps[0]), 5 * len(gaps[0])
            for (e, c, r), gap in zip(edits, gaps[1:], strict=True):
                audit, roles, cost = audit + e + "I" * len(gap), roles + r + "".join(gap), cost + c + 5 * len(gap)
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, roles
    return best


@pytest.mark.parametrize("n", [0, 1, 2])
def test_every_short_sequence(n):
    for kinds in product("suaxSUAd", repeat=n):
        tops = cv.parsed("".join(kinds))
        assert min(tops[t] for t in cv.ACCEPT if t in tops) == cheapest(kinds, 2)[:2]


@settings(max_examples=40, deadline=None)
@given(st.text("suaxSUAXd", min_size=3, max_size=5))
def test_longer_sequences(kinds):
    tops = cv.parsed(kinds)
    assert min(tops[t] for t in cv.ACCEPT if t in tops) == cheapest(kinds, 1)[:2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("suaxSUAXd", max_size=9), max_size=5))
def test_parts_make_the_whole(parts):
    tops = {0: (0, "")}
    for p in parts:
        ways = [(end, (c + cost, a + audit)) for top, (c, a) in tops.items() for end, (cost, audit) in cv.parsed(p, top).items()]
        tops = {end: min(w for e, w in ways if e == end) for end, _ in ways}
    assert tops == cv.parsed("".join(parts)) or not parts


def brute(rows):
    """The contract in plain loops, for conversations of few rows after damage."""
    after, ids = defaultdict(list), []
    for conv, turn, role, text in rows:
        ids.append(conv)
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        after[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = {}
    for conv in dict.fromkeys(ids):
        seq = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, *_ in seq if t is not None]
        faults, kinds, seen = [], [], set()
        for _, role, text in seq:
            bare = text.strip(SPACES)
            f = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(f)
            initial = role[:1] if role[:1] in list("sua") else "x"
            kinds.append("d" if f in ("blank", "duplicate") else initial.upper() if f else initial)
        tops = cv.parsed("".join(kinds))
        cost, audit = min(tops[t] for t in cv.ACCEPT if t in tops)
        if len(kinds) < 4:
            assert (cost, audit) == cheapest(kinds, 1)[:2]
        kept, at, lines = [], 0, []
        for e in audit:
            row = None if e == "I" else seq[at]
            at += e != "I"
            if e != "D":
                kept.append((e, row))
        system = bool(kept) and kept[0][0] == "K" and kept[0][1][1].startswith("s")
        for k, (e, row) in enumerate(kept):
            role = row[1] if e == "K" else ["user", "assistant"][(k - system) % 2]
            lines.append(f"{role}:{row[2] if row else ''}")
        pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(seq, seq[1:], strict=False)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation_rows():
    rnd = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(1, 7)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rnd.choice(["Good.", "why? \t", "no end", "", " \n", None, "long " * 50 + "!", f"t{turn}.", "ü…", "A.B!C?"])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 5, None]), role, text))
    for turn in range(90):  # a long one
        rows.append((1000, turn, ["user", "assistant"][turn % 2] if turn % 11 else "user", f"say {turn % 30}." if turn % 7 else "hm"))
    return [*rows, *rows[:9], (2000, None, None, None), (3000, 1, "system", "")]


def test_repair(spark):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    want = brute(rows)
    for size in (3, cv.CHUNK_ROWS):
        got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in cv.repair_digests(df, size).collect()}
        assert got == want
    edits = cv.repaired(cv.damaged(df), 3).orderBy("place").where("conv_id = 1000").collect()
    assert "".join(r.edit for r in edits) == want[1000][6]
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in edits if r.role).encode()).hexdigest() == want[1000][7]
    assert cv.repair_digests(df.where("conv_id > 9999")).count() == 0
