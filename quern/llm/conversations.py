"""Repair of conversations by generalised LR parsing of their roles.

Roles follow the grammar ``T: T u a | u a | s u a`` (or no turn at all). The parser keeps one stack for each
top state; stacks share their lower cells, so all of them are one graph. Before each row it may insert a
turn; the row itself is kept, gets another role or is deleted, each at its cost; shifts reduce as soon as a
right side is complete. Equal tops merge: the lesser (cost, audit) stays.

What a stretch of rows does to a conversation is a table from top to top, so long conversations are cut: rows
are dealt by range of conversation and turn, each chunk is parsed from every top that may come in, and a
stream over the chunks' tables (a few numbers and short audits each) picks the way through. Of two audits of
equal cost between the same tops neither begins the other, so the least whole is made of least parts.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os.path
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quern.llm.common import need, written

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What an undeleted truncated row adds.
TRUNCATED = 5
NAMES = {"u": "user", "a": "assistant"}
#: The LR automaton: shifts by (state, role), reductions by state (length of the right side), the state after T on the bottom.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 3, (2, "a"): 6, (3, "a"): 7, (4, "u"): 5, (5, "a"): 8}
REDUCE, GOTO = {6: 2, 7: 3, 8: 3}, {0: 4}
ACCEPT = (0, 4)
#: The stack under each top that can be between two rows, as cells (state, cell below).
STACKS = {0: (0, None), 1: (1, (0, None)), 2: (2, (0, None)), 3: (3, (1, (0, None))), 4: (4, (0, None)), 5: (5, (4, (0, None)))}
#: Rows of a chunk, and bytes of its texts.
CHUNK_ROWS, CHUNK_BYTES = 1024, 8_000_000
_BLANK = " \t\n\x0b\x0c\r"

Stack = tuple
#: By top: cost, audit and stack.
Tops = dict[int, tuple[int, str, Stack]]


def shifted(stack: Stack, role: str) -> Stack | None:
    """The stack after a role, reduced as far as it goes; None if the role can't come here."""
    state = SHIFT.get((stack[0], role))
    if state is None:
        return None
    stack = (state, stack)
    while pop := REDUCE.get(stack[0]):
        for _ in range(pop):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


def _merged(ways: Iterable[tuple[int, str, Stack]]) -> Tops:
    """Equal tops merged, and all turns inserted that lead to another top for the least (cost, audit)."""
    heap = [(cost, audit, stack[0], stack) for cost, audit, stack in ways]
    heapq.heapify(heap)
    tops: Tops = {}
    while heap:
        cost, audit, state, stack = heapq.heappop(heap)
        if state in tops:
            continue
        tops[state] = cost, audit, stack
        for role in NAMES:
            if (to := shifted(stack, role)) and to[0] not in tops:
                heapq.heappush(heap, (cost + COST[INSERT], audit + INSERT, to[0], to))
    return tops


def _actions(kind: str) -> list[tuple[str, int, str | None]]:
    """Edit, cost and role of what may be done to a row of a kind (see ``kind_of``)."""
    out: list[tuple[str, int, str | None]] = [(DELETE, COST[DELETE], None)]
    if kind != "d":
        extra = TRUNCATED if kind.isupper() else 0
        out.append((KEEP, COST[KEEP] + extra, kind.lower()))
        out += [(REROLE, COST[REROLE] + extra, role) for role in NAMES]
    return out


_ACTIONS = {kind: _actions(kind) for kind in "suaxSUAXd"}


def parsed(kinds: str, start: int = 0) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) by top after rows of these kinds, from a top."""
    tops = _merged([(0, "", STACKS[start])])
    for kind in kinds:
        ways = []
        for cost, audit, stack in tops.values():
            for edit, price, role in _ACTIONS[kind]:
                to = stack if role is None else shifted(stack, role)
                if to:
                    ways.append((cost + price, audit + edit, to))
        tops = _merged(ways)
    return {state: (cost, audit) for state, (cost, audit, _) in tops.items()}


_parsed_short = functools.lru_cache(100_000)(parsed)


def kind_of(role: str, fault: str | None) -> str:
    """d: must go; else the role's initial (x: none of the grammar's), as a capital if the row is truncated."""
    if fault in ("blank", "duplicate"):
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def fault_of(text: str, duplicate: bool) -> str | None:
    bare = text.rstrip(_BLANK)
    if not bare:
        return "blank"
    return "duplicate" if duplicate else None if bare[-1] in ".!?" else "truncated"


def edited(start: int, audit: str, rows: list[dict]) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) for each letter of the audit; a deleted row has neither role nor text."""
    stack, at = STACKS[start], 0
    for edit in audit:
        row = None
        if edit != INSERT:
            row, at = rows[at], at + 1
        if edit == DELETE:
            yield edit, None, None
            continue
        initial = row["role"][:1] if edit == KEEP else next(r for r in NAMES if shifted(stack, r))
        stack = shifted(stack, initial)
        yield edit, row["role"] if edit == KEEP else NAMES[initial], row["text"] if row else ""


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: the rows after damage, equal ones together with their number.

    crc32 of ``conv_id:turn`` mod 20 drops a row (0), empties its text (1), takes its ``.!?`` (2), repeats it (3)
    or makes it the user's (4). Nulls count as one space, but order and gaps know a null turn.
    """
    rows = need(conversations, "conv_id", "turn", "role", "text")
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    h = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(h == 1, "").when(h == 2, F.translate(text, ".!?", "")).otherwise(text)
    done = rows.where(h != 0).select("conv_id", "turn", F.when(h == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(h == 3, 2).otherwise(1).alias("n"))
    return done.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def in_order(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, n), dealt and sorted by conversation and turn, with ``later``: true where
    the same role and text have an earlier turn. A hot conversation is dealt out, too."""
    rows = written(rows, "turns")
    digest = F.sha2("text", 256)
    again = rows.groupBy("conv_id", "role", digest.alias("digest")).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("k")).where("k > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "digest", "first")
    tied = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (digest == F.col("digest")), "left")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return tied.select("conv_id", "turn", "role", "text", "n", later.alias("later")).repartitionByRange(*order).sortWithinPartitions(*order)


@dataclass
class Chunk:
    """Rows of one conversation that lie together, and what they count up to."""

    conv_id: object
    seq: int
    starts: tuple[int, ...]
    n: int = 0
    size: int = 0
    faults: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_role: str = ""
    last_role: str = ""
    kinds: list[str] = field(default_factory=list)
    rows: list[dict] = field(default_factory=list)

    def add(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        fault = fault_of(text, duplicate)
        if fault:
            self.faults[fault] += 1
        if self.n:
            self.illegal += not legal(self.last_role, role)
        else:
            self.first_role = role
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.last_role = role
        self.kinds.append(kind := kind_of(role, fault))
        self.rows.append({"role": role, "text": None if kind == "d" else text})
        self.n, self.size = self.n + 1, self.size + len(text)

    def row(self) -> dict:
        kinds = "".join(self.kinds)
        ways = {s: _parsed_short(kinds, s) if self.n <= 32 else parsed(kinds, s) for s in self.starts}
        cells = [{"start": s, "end": e, "cost": cost, "audit": audit} for s, tops in ways.items() for e, (cost, audit) in tops.items()]
        return {
            "conv_id": self.conv_id, "seq": self.seq, **self.faults, "illegal": self.illegal, "turns": self.turns,
            "first_turn": self.first_turn, "last_turn": self.last_turn, "first_role": self.first_role, "last_role": self.last_role, "cells": cells, "rows": self.rows,
        }


def legal(before: str, after: str) -> bool:
    return before[:1] + after[:1] in ("su", "ua", "au")


_COUNTS = "blank long, duplicate long, truncated long, illegal long"
_CHUNK = "conv_id {0}, seq long, " + _COUNTS + ", turns long, first_turn long, last_turn long, first_role string, last_role string, cells array<struct<start:int,end:int,cost:long,audit:string>>, rows array<struct<role:string,text:string>>"


def _kind(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _values(batches: Iterable[pa.RecordBatch], most: int = 1024) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield from batch.slice(at, most).to_pylist()


def _mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from rows to rows, both read as they come."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: _batches(fn(_values(batches)), arrow), schema)


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Sorted rows as chunks, each parsed. ``seq`` is in the order of the rows."""

    def run(given: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        seq, chunk, inside = TaskContext.get().partitionId() << 33, None, False
        for r in given:
            for copy in range(r["n"]):
                other = chunk is not None and chunk.conv_id != r["conv_id"]
                if chunk is None or other or chunk.n >= chunk_rows or chunk.size >= CHUNK_BYTES:
                    if chunk is not None:
                        yield chunk.row()
                    # where no conversation can have come in from elsewhere, there is one top
                    chunk, inside = Chunk(r["conv_id"], seq, (0,) if other else tuple(STACKS)), True
                    seq += 1
                chunk.add(r["turn"], r["role"], r["text"], r["later"] or copy > 0)
        if inside:
            yield chunk.row()

    return _mapped(rows, run, _CHUNK.format(_kind(rows)))


_PICK = "conv_id {0}, seq long, start int, end int, gaps long, " + _COUNTS + ", cost long"


class Way:
    """The least way to each top through the chunks of one conversation so far."""

    def __init__(self, first: dict) -> None:
        self.conv_id, self.tops = first["conv_id"], {0: (0, "", None)}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.low, self.high, self.role = 0, None, None, None

    def add(self, c: dict) -> None:
        ways: dict[int, tuple[int, str, tuple]] = {}
        for cell in c["cells"]:
            if (so_far := self.tops.get(cell["start"])) is not None:
                way = so_far[0] + cell["cost"], so_far[1] + cell["audit"], (so_far[2], c["seq"], cell["start"], cell["end"])
                if cell["end"] not in ways or way[:2] < ways[cell["end"]][:2]:
                    ways[cell["end"]] = way
        # what all audits begin with decides nothing any more
        common = len(os.path.commonprefix([audit for _, audit, _ in ways.values()]))
        self.tops = {top: (cost, audit[common:], path) for top, (cost, audit, path) in ways.items()}
        for k in self.counts:
            self.counts[k] += c[k]
        if self.role is not None:
            self.counts["illegal"] += not legal(self.role, c["first_role"])
        self.role = c["last_role"]
        if c["first_turn"] is not None:
            self.turns += c["turns"] - (c["first_turn"] == self.high)
            self.low = c["first_turn"] if self.low is None else self.low
            self.high = c["last_turn"]

    def picked(self) -> Iterator[dict]:
        """One row for each chunk, the last first."""
        cost, _, path = min((self.tops[t] for t in ACCEPT if t in self.tops), key=lambda w: w[:2])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        while path is not None:
            path, seq, start, end = path
            yield {"conv_id": self.conv_id, "seq": seq, "start": start, "end": end, "gaps": gaps, **self.counts, "cost": cost}


def picked_ways(parts: DataFrame) -> DataFrame:
    """For each chunk the tops at its two ends in the cheapest repair, and the conversation's counts and cost.

    A conversation's chunks stream through one task without their rows; a chunk is about a thousandth of them.
    """

    def run(given: Iterator[dict]) -> Iterator[dict]:
        way = None
        for c in given:
            if way is None or way.conv_id != c["conv_id"]:
                if way is not None:
                    yield from way.picked()
                way = Way(c)
            way.add(c)
        if way is not None:
            yield from way.picked()

    light = parts.drop("rows").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "seq")
    return _mapped(light, run, _PICK.format(_kind(parts)))


def repaired_chunks(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, seq, start, audit, rows and the conversation's counts: every chunk with the edits of its rows."""
    parts = written(chunks(in_order(conversations), chunk_rows), "chunks")
    ways = picked_ways(parts)
    cell = F.filter("cells", lambda x: (x["start"] == F.col("start")) & (x["end"] == F.col("end")))[0]["audit"]
    return ways.join(parts.select("seq", "cells", "rows"), "seq").select(*ways.columns, cell.alias("audit"), "rows")


def repaired(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, place, edit, role, text: every edit of the cheapest repair, in order of ``place``.

    ``rows``: conv_id, turn, role, text (role and text not null) and n, how often the row is there. Deleted rows have
    neither role nor text; inserted ones an empty text. Nothing is gathered by conversation but the chunks' tables.
    """

    def run(given: Iterator[dict]) -> Iterator[dict]:
        for c in given:
            for k, (edit, role, text) in enumerate(edited(c["start"], c["audit"], c["rows"])):
                yield {"conv_id": c["conv_id"], "place": [c["seq"], k], "edit": edit, "role": role, "text": text}

    return _mapped(repaired_chunks(rows, chunk_rows), run, f"conv_id {_kind(rows)}, place array<long>, edit string, role string, text string")


def repair_digests(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, after damage.

    Null roles and texts are one space; rows of a null id are one conversation; equal rows are there as often as
    given, the first not a duplicate of the others; rows of one turn follow in the order of role and text. A
    conversation without rows after damage has zeros, an empty audit and the empty text's hash. No rows give none.
    A hash needs a conversation's texts in order: they stream through one task, none is held longer than its chunk.
    """
    kind = _kind(conversations)
    parts = repaired_chunks(damaged(conversations), chunk_rows).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "seq")
    facts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(given: Iterator[dict]) -> Iterator[dict]:
        now, audit, digest, sep = None, [], None, b""

        def done() -> dict:
            return {"conv_id": now["conv_id"], **{f: now[f] for f in facts}, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        for c in given:
            if now is None or now["conv_id"] != c["conv_id"]:
                if now is not None:
                    yield done()
                now, audit, digest, sep = c, [], hashlib.sha256(), b""
            audit.append(c["audit"])
            for _, role, text in edited(c["start"], c["audit"], c["rows"]):
                if role is not None:
                    digest.update(sep + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    sep = b"\n"
        if now is not None:
            yield done()

    found = _mapped(parts, run, f"conv_id {kind}, " + ", ".join(f"{f} long" for f in facts) + ", audit string, repaired_sha256 string")
    every = need(conversations, "conv_id").distinct().withColumnRenamed("conv_id", "c")
    rows = every.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(f, F.lit(0).cast("long")).alias(f) for f in facts]
    return rows.select(F.col("c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
