"""Alignment of two tokenizers over the same texts, and corpus-wide counts of token pairs that overlap.

The ends of tokens as byte offsets are two sorted lists that close at the same byte, so all texts of a
block lie end to end in one pair of lists. The shorter list drives a galloping search (exponential, then
binary) into the longer, in lanes that advance together: each of its ends gets its rank in the longer list.
Ends in both lists slice the tokens into groups; the differences of ranks are the ranges of tokens that a
token overlaps. Tokens are stored once. Pairs are counted by documents (in tasks, then in Spark) and
become sorted arrays in the shared folder, which workers map into memory to look up each block's pairs.
"""

from __future__ import annotations

import itertools
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.bpe import byte_symbols
from quern.llm.common import fresh_path, need, written
from quern.llm.lm_scoring import _mapped, _store, _summed

#: The split into words that byte-level vocabularies of this kind are made with.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of packed ids that are aligned, or leave a task, at once (one text's at least).
_BYTES = 1_500_000
#: Documents' pairs that a counting task gathers before it sums them, and sums that it holds at most before it hands them on.
_FLUSH = 1_000_000
#: Above this many cached parts of texts a worker starts its cache afresh.
_CACHE = 250_000
#: Pairs that a stored file holds on average.
RANGE_PAIRS = 250_000
#: Longest stretch of ends that one lane of the galloping search goes through.
_LANE = 64


def _kind(size: int) -> str:
    """How ids are stored: in 16 bits if that will do, else in 32."""
    return "<u2" if size <= 1 << 16 else "<u4"


class ByteLevel:
    """Tokenizer A: a byte-level BPE vocabulary. Special strings inside texts are plain text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        for m, merge in enumerate(spec["model"]["merges"]):  # ids in the order of merges are ranks
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if ranks[bytes(byte_of[c] for c in a + b)] != 256 + m:
                raise ValueError(f"{path}: ids are not in the order of merges")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path}: not every byte is a token")
        self.size = 1 + max(max(ranks.values()), *(t["id"] for t in spec["added_tokens"]), 0)
        self.kind = _kind(self.size)
        self.raw = [b""] * self.size
        for raw, i in ranks.items():
            self.raw[i] = raw
        self._encode = tiktoken.Encoding("bytes", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """The ids as numbers of ``kind``. With a token for each byte they always give the text back."""
        return np.array(self._encode(" " + text), self.kind).tobytes()


class Pieces:
    """Tokenizer B: a sentence-piece model, which puts a space before a text.

    No piece goes on after a space, so what begins with spaces and ends before the next is encoded
    once and kept (up to _CACHE of them).
    """

    _parts = re.compile(" *[^ ]+| +")

    def __init__(self, path: str) -> None:
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        self.kind = _kind(self.size)
        names = [m.id_to_piece(i) for i in range(self.size)]
        self.raw = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        space = m.piece_to_id("▁")
        self.apart = space != m.unk_id() and not any("▁" in p.lstrip("▁") for p in names)
        self.first = {" ": np.array([space], self.kind).tobytes()}  # the library gives an empty text no token
        self.cache: dict[str, bytes | None] = dict(self.first)

    def _packed(self, part: str, ids: list[int]) -> bytes | None:
        """None if the pieces don't give the part back."""
        return np.array(ids, self.kind).tobytes() if b"".join(map(self.raw.__getitem__, ids)) == part.encode("utf-8", "surrogatepass") else None

    def encode(self, text: str) -> bytes | None:
        """The ids as numbers of ``kind``; None if their bytes are not those of a space and the text."""
        if not self.apart:
            return self._packed(" " + text, self.model.encode(text))
        parts = self._parts.findall(" " + text)
        cache = self.cache
        if new := [p for p in dict.fromkeys(parts) if p not in cache]:
            if len(cache) > _CACHE:
                cache.clear()
                cache.update(self.first)
                new = [p for p in dict.fromkeys(parts) if p not in cache]
            cache.update(zip(new, map(self._packed, new, self.model.encode([p[1:] for p in new], num_threads=1)), strict=True))
        found = list(map(cache.__getitem__, parts))
        return None if None in found else b"".join(found)


_loaded: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def _tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = ByteLevel(path_a), Pieces(path_b)
    return _loaded[path_a, path_b]


def encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, a, b: the tokens of every row (packed ids), empty where the text is null or empty or either
    side's bytes are not those of a space and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(path_a, path_b)
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1), 0
            left, right, size = [], [], 0
            for k in range(batch.num_rows):
                t = texts[k].as_py()
                pieces = b.encode(t) if t else None
                left.append(a.encode(t) if pieces else b"")
                right.append(pieces or b"")
                size += len(left[-1]) + len(right[-1])
                if size >= _BYTES or k == batch.num_rows - 1:  # rows leave in small batches
                    yield pa.RecordBatch.from_arrays([ids.slice(at, k + 1 - at), pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["doc_id", "a", "b"])
                    left, right, size, at = [], [], 0, k + 1

    return need(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, a binary, b binary")


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the sorted ``short``: how many of the sorted ``long`` are smaller.

    The short list is cut into lanes. Each lane's search starts where its last one ended, doubles its
    step until it has passed the value, then halves the bracket; all lanes take each step together.
    """
    n, m = len(short), len(long)
    if not n or not m:
        return np.zeros(n, np.int64)
    lanes = -(-n // _LANE)
    rank, at = np.zeros(n, np.int64), np.zeros(lanes, np.int64)
    starts = np.arange(lanes) * _LANE
    for k in range(min(_LANE, n)):
        live = np.flatnonzero(starts + k < n)
        x = short[starts[live] + k]
        low, step = at[live], np.ones(len(live), np.int64)
        # invariant: everything before ``low`` is smaller than x
        far = np.flatnonzero(long[np.minimum(low, m - 1)] < x)
        while len(far):
            probe = low[far] + step[far]
            smaller = (probe < m) & (long[np.minimum(probe, m - 1)] < x[far])
            passed = far[smaller]
            low[passed] = probe[smaller]
            step[passed] *= 2
            far = passed
        high = np.minimum(low + step, m)
        low = np.where((low < m) & (long[np.minimum(low, m - 1)] < x), low + 1, low)
        while len(left := np.flatnonzero(low < high)):
            middle = (low[left] + high[left]) // 2
            smaller = long[middle] < x[left]
            low[left[smaller]] = middle[smaller] + 1
            high[left[~smaller]] = middle[~smaller]
        rank[starts[live] + k] = at[live] = low
    return rank


class Aligned:
    """The links and groups of one block of texts: ids of both sides, laid end to end."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], len_a: np.ndarray, len_b: np.ndarray) -> None:
        self.n_a, self.n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        self.a, self.b = (np.concatenate([*x, np.zeros(0, np.uint32)]).astype(np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(len_a[self.a]), np.cumsum(len_b[self.b])
        a_drives = len(ends_a) <= len(ends_b)
        short, long, n = (ends_a, ends_b, self.n_a) if a_drives else (ends_b, ends_a, self.n_b)
        rank = gallop(short, long)
        both = long[np.minimum(rank, max(len(long) - 1, 0))] == short if len(long) else np.zeros(0, bool)
        at = np.flatnonzero(both)
        self.cut_a, self.cut_b = (at + 1, rank[at] + 1) if a_drives else (rank[at] + 1, at + 1)  # tokens up to each group's end
        # a driver's token reaches from the end of the one before it, which is a rank (and one more, if both lists hold it), to its own
        first = np.r_[0, (rank + both)[:-1]] if len(rank) else rank
        count = rank - first + 1
        near = np.repeat(np.arange(len(short)), count)
        other = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(near))
        self.link_a, self.link_b = (near, other) if a_drives else (other, near)
        self.doc = np.repeat(np.repeat(np.arange(len(n)), n), count)
        self.group_doc = np.searchsorted(np.cumsum(self.n_a), self.cut_a)

    def group_texts(self, table: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text; the table has each id before a comma, a bar and a semicolon."""
        sizes_a, sizes_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        before_b, upto_a = self.cut_b - sizes_b, self.cut_a
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + np.repeat(before_b, sizes_a)] = self.a * 3
        code[np.arange(len(self.b)) + np.repeat(upto_a, sizes_b)] = self.b * 3
        code[self.cut_a + before_b - 1] += 1
        code[self.cut_a + self.cut_b - 1] += 2
        words = list(map(table.__getitem__, code.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[x:y])[:-1] for x, y in zip([0, *ends[:-1]], ends, strict=True)]


def _blocks(batch: pa.RecordBatch, kinds: tuple[str, str]) -> Iterator[tuple[pa.Array, list[np.ndarray], list[np.ndarray]]]:
    """doc_id and the ids of both sides, in stretches of rows of about _BYTES or one row."""
    at, size, sides = 0, 0, ([], [])
    for k in range(batch.num_rows):
        for i, side in enumerate(sides):
            side.append(np.frombuffer(batch.column(i + 1)[k].as_buffer() or b"", kinds[i]))
            size += side[-1].nbytes
        if size >= _BYTES or k == batch.num_rows - 1:
            yield batch.column(0).slice(at, k + 1 - at), *sides
            at, size, sides = k + 1, 0, ([], [])


def _sizes(path_a: str, path_b: str) -> tuple[tuple[str, str], np.ndarray, np.ndarray]:
    """How ids are stored, and the bytes of each."""
    a, b = _tokenizers(path_a, path_b)
    return (a.kind, b.kind), *(np.array([len(r) for r in t.raw], np.int64) for t in (a, b))


def pair_counts(tokens: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a, b, n: in how many rows of the tokens each pair of ids is linked at least once."""

    def out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF, pa.int32()), pa.array(n, pa.int64())], ["a", "b", "n"])

    def run(batches):
        kinds, len_a, len_b = _sizes(path_a, path_b)
        parts, fresh = [], 0
        for batch in batches:
            for _, a, b in _blocks(batch, kinds):
                x = Aligned(a, b, len_a, len_b)
                keys = x.a[x.link_a] << 32 | x.b[x.link_b]
                order = np.lexsort((keys, x.doc))
                keys, doc = keys[order], x.doc[order]
                new = np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])] if len(keys) else np.zeros(0, bool)
                parts.append((keys[new], np.ones(int(new.sum()), np.int64)))
                fresh += len(parts[-1][0])
                if fresh >= _FLUSH:
                    parts, fresh = [_summed(*(np.concatenate(p) for p in zip(*parts, strict=True)))], 0
                    if len(parts[0][0]) >= _FLUSH:
                        yield out(*parts.pop())
        if parts:
            yield out(*_summed(*(np.concatenate(p) for p in zip(*parts, strict=True))))

    return tokens.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _part(a, b, parts: int):
    """The file that holds a pair, for columns and arrays alike."""
    return (a * 1_000_003 + b) % parts


def stored_counts(counts: DataFrame) -> list[dict]:
    """Sorted arrays of the pairs in the shared folder: key, and twice the count, plus one where it is its A id's highest.

    An A id's highest counts are as many rows as that vocabulary has ids at most, so they travel by broadcast.
    """
    spark, folder = counts.sparkSession, fresh_path(counts.sparkSession, "pairs")
    parts = max(16, counts.count() // RANGE_PAIRS)
    best = counts.groupBy("a").agg(F.max("n").alias("top"))
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    value = F.col("n") * 2 + (F.col("n") == F.col("top")).cast("long")
    marked = counts.join(F.broadcast(best), "a").select(_part(a, b, parts).alias("part"), F.shiftleft(a, 32).bitwiseOR(b).alias("key"), value.alias("value"))

    def run(table: pa.Table) -> pa.Table:
        part, key, value = (table.column(i).to_numpy() for i in range(3))
        order = np.argsort(key)
        return pa.table({"part": part[:1], "path": [_store(folder, "pairs", [key[order].astype("<i8"), value[order].astype("<i8")])], "n": pa.array([len(key)], pa.int64())})

    stored = written(marked.groupBy("part").applyInArrow(run, "part long, path string, n long"), "pair-files")
    return [{"parts": parts, **r.asDict()} for r in stored.toLocalIterator()]


class Counts:
    """Looks up pairs in the mapped arrays."""

    def __init__(self, files: list[dict]) -> None:
        self.parts, self.files = files[0]["parts"] if files else 1, {}
        for f in files:
            raw = _mapped(f["path"], f["n"])
            self.files[f["part"]] = np.frombuffer(raw, "<i8", f["n"]), np.frombuffer(raw, "<i8", f["n"], 8 * f["n"])

    def values(self, keys: np.ndarray) -> np.ndarray:
        """The stored values of sorted keys, all of which have been counted."""
        out, part = np.zeros(len(keys), np.int64), _part(keys >> 32, keys & 0xFFFFFFFF, self.parts)
        for k, (held, value) in self.files.items():
            mine = part == k
            out[mine] = value[np.searchsorted(held, keys[mine])]
        return out


_counts: dict[str, Counts] = {}


def _counts_of(key: str, files: list[dict]) -> Counts:
    if key not in _counts:
        _counts.clear()  # a worker serves one table of counts at a time
        _counts[key] = Counts(files)
    return _counts[key]


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: one row for every row of the documents.

    Rows without tokens (text null, empty, or not given back byte for byte by both sides) have zeros and an
    empty ``groups``. Each row counts as a document: repeated rows and equal ids are counted apart, a
    null id is kept. No rows give none. The stored tokens and counts stay for the result's reader.
    """
    tokens = written(encoded(docs, path_a, path_b), "tokens")
    files = stored_counts(written(pair_counts(tokens, path_a, path_b), "pair-counts"))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (kinds, len_a, len_b), known = _sizes(path_a, path_b), _counts_of(key, files)
        table = _numerals(max(len(len_a), len(len_b)))
        for batch in batches:
            for ids, a, b in _blocks(batch, kinds):
                x, rows = Aligned(a, b, len_a, len_b), len(ids)
                pairs, where = np.unique(x.a[x.link_a] << 32 | x.b[x.link_b], return_inverse=True)
                value = known.values(pairs)[where]
                sums = np.zeros(rows, np.int64)
                np.add.at(sums, x.doc, value >> 1)
                links, best, groups = (np.bincount(d, minlength=rows) for d in (x.doc, x.doc[value & 1 == 1], x.group_doc))
                columns = [ids, *(pa.array(c, pa.int64()) for c in (x.n_a, x.n_b, groups, links, best, sums)), pa.array(x.group_texts(table), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return tokens.mapInArrow(run, _RESULT)


_tables: dict[int, list[str]] = {}


def _numerals(size: int) -> list[str]:
    if size not in _tables:
        _tables[size] = [f"{i}{mark}" for i in range(size) for mark in ",|;"]
    return _tables[size]


def alignment_digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """As ``aligned``, the groups as SHA-256 (empty without tokens)."""
    rows = aligned(docs, path_a, path_b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
