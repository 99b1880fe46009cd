"""Language-model scoring: an interpolated modified Kneser-Ney bigram model over word hashes.

Counting: each task sums its bigrams and hands them on as packed arrays, dealt by hash range, so a
frequent word's bigrams spread over all ranges and no group grows with one key. Each range becomes a
file of sorted hashes in the shared folder, with counts for those seen more than once; what its
bigrams say about their two words goes on to word ranges, which become files of the same kind.
Scoring: workers map the files into memory and look up each block of texts' distinct bigrams in order.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import ascii_lower_words, discounts, fresh_path, local_path, map_batches, mixed, need, word_hashes, written

#: Hashes of what stands before the first word and after the last; words hold no space, so none collides by text.
START, END = (int(h) for h in word_hashes([b" start", b" end"]))
#: Bigram tokens that a range holds on average.
RANGE_TOKENS = 1_500_000
#: Distinct bigrams that a counting task gathers before it hands them on.
_FLUSH = 3_000_000
_BLOCK = 600_000  # tokens scored at once

_U8, _U4 = np.dtype("<u8"), np.dtype("<u4")


def is_held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text, mod 5, is 1. A null id counts as an empty text: held in."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def text_hashes(text: str | None) -> np.ndarray:
    """Hashes of the text's words, A-Z lowered, and of its one end."""
    return np.append(word_hashes(ascii_lower_words(text)), np.uint64(END))


def bigram_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(mixed(left) + right)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of equal width over all 64-bit hashes, in order."""
    return ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v for v in values)


def _packed_rows(kind: int, ranges: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """(group, blob) for each range, of columns sorted by range."""
    cuts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]]) if len(ranges) else []
    for a, b in zip(cuts, [*cuts[1:], len(ranges)], strict=True):
        yield int(ranges[a]) * 2 + kind, b"".join(np.ascontiguousarray(c[a:b]).tobytes() for c in columns)


def _rows_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], ["group", "blob"])


def _unpacked(blobs: list[bytes], kinds: list[np.dtype]) -> list[np.ndarray]:
    """The columns of packed arrays: each blob holds one stretch of each column, of equal length."""
    width = sum(k.itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = len(blob) // width, 0
        for out, k in zip(parts, kinds, strict=True):
            out.append(np.frombuffer(blob, k, n, at))
            at += n * k.itemsize
    return [np.concatenate([*p, np.zeros(0, k)]) for p, k in zip(parts, kinds, strict=True)]


def _store(folder: str, name: str, columns: list[np.ndarray]) -> str:
    """Writes columns one after another to a new file of the shared folder. A task's second attempt
    writes another file; only the path in the rows that Spark keeps is ever read."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    local = local_path(path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as f:
            for c in columns:
                f.write(np.ascontiguousarray(c).data)
    else:
        fs, inner = pafs.FileSystem.from_uri(path)
        fs.create_dir(os.path.dirname(inner), recursive=True)
        with fs.open_output_stream(inner) as f:
            for c in columns:
                f.write(np.ascontiguousarray(c).tobytes())
    return path


def _mapped(path: str, size: int) -> mmap.mmap | bytes:
    """A file of the shared folder in memory: mapped where it is mounted, else by way of a temporary
    file without a name, which goes with the worker."""
    if not size:
        return b""
    local = local_path(path)
    if local:
        with open(local, "rb") as f:
            return mmap.mmap(f.fileno(), 0, prot=mmap.PROT_READ)
    fs, inner = pafs.FileSystem.from_uri(path)
    with tempfile.TemporaryFile() as f, fs.open_input_stream(inner) as g:
        while chunk := g.read(1 << 24):
            f.write(chunk)
        f.flush()
        return mmap.mmap(f.fileno(), 0, prot=mmap.PROT_READ)


#: Columns of the packed arrays that travel, and of the stored files.
_BIGRAM = [_U8, _U8, _U4]  # left word, right word, count
_WORD = [_U8, _U8, _U4, _U4, _U4, _U4, _U8]  # word; as a left word: tokens, types seen once, twice, more; as a right word: types, tokens
_SINGLE, _MULTI = [_U8], [_U8, _U4]


def _count_bigrams(training: DataFrame, ranges: int) -> DataFrame:
    """(group, blob): each task's bigrams of training texts, summed, dealt by range of their hash."""

    def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        left, right = (np.concatenate(p) for p in zip(*parts, strict=True))
        key = bigram_hash(left, right)
        order = np.argsort(key)
        key, left, right = key[order], left[order], right[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[starts, len(key)]).astype(_U4)
        return _rows_batch(list(_packed_rows(0, _range_of(key[starts], ranges), [left[starts], right[starts], n])))

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if is_held_out(doc):
                    continue
                h = text_hashes(text.as_py())
                parts.append((np.append(np.uint64(START), h[:-1]), h))
                size += len(h)
                if size >= _FLUSH:
                    yield flush(parts)
                    parts, size = [], 0
        if parts:
            yield flush(parts)

    return need(training, "doc_id", "text").mapInArrow(run, "group long, blob binary")


_META = "group long, blob binary"


def _store_bigrams(counted: DataFrame, folder: str, word_ranges: int) -> DataFrame:
    """Stores each range's bigrams; hands on what they say about words, and one row of facts."""

    def run(table: pa.Table) -> pa.Table:
        group = table.column(0)[0].as_py()
        left, right, n = _unpacked(table.column(1).to_pylist(), _BIGRAM)
        key = bigram_hash(left, right)
        order = np.argsort(key, kind="stable")
        key, left, right, n = key[order], left[order], right[order], n[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, left, right, n = key[starts], left[starts], right[starts], np.add.reduceat(n.astype(np.uint64), starts)
        once = n == 1
        facts = {
            "kind": "bigram", "range": group // 2, "singles": int(once.sum()), "multi": int((~once).sum()),
            "single_path": _store(folder, "bigram-once", [key[once]]), "multi_path": _store(folder, "bigram", [key[~once], n[~once].astype(_U4)]),
            "of": [int((n == i).sum()) for i in (1, 2, 3, 4)],
        }
        one = np.ones(len(n), np.uint64)
        zero = np.zeros(len(n), np.uint64)
        as_left = _summed(left, n, (n == 1).astype(np.uint64), (n == 2).astype(np.uint64), (n > 2).astype(np.uint64), zero, zero)
        as_right = _summed(right, zero, zero, zero, zero, one, n)
        word, *stats = _summed(np.concatenate([as_left[0], as_right[0]]), *(np.concatenate(p) for p in zip(as_left[1:], as_right[1:], strict=True)))
        columns = [word, *(s.astype(k) for s, k in zip(stats, _WORD[1:], strict=True))]
        rows = list(_packed_rows(1, _range_of(word, word_ranges), columns))
        return pa.Table.from_batches([_rows_batch([*rows, (-1 - group, json.dumps(facts).encode())])])

    return counted.groupBy("group").applyInArrow(run, _META)


def _store_words(stats: DataFrame, folder: str) -> DataFrame:
    """Stores each range's words; one row of facts for each file of the model."""

    def run(table: pa.Table) -> pa.Table:
        group = table.column(0)[0].as_py()
        if group < 0:
            return table
        word, *values = _unpacked(table.column(1).to_pylist(), _WORD)
        word, *values = _summed(word, *(v.astype(np.uint64) for v in values))
        columns = [word, *(v.astype(k) for v, k in zip(values, _WORD[1:], strict=True))]
        types, tokens = values[4], values[5]
        facts = {
            "kind": "word", "range": group // 2, "n": len(word), "path": _store(folder, "word", columns),
            "tokens": int(tokens.sum()), "vocabulary": int((tokens > 0).sum()), "types": int(types.sum()), "of": [int((types == i).sum()) for i in (1, 2, 3, 4)],
        }
        return pa.Table.from_batches([_rows_batch([(group, json.dumps(facts).encode())])])

    return stats.groupBy("group").applyInArrow(run, _META)


@dataclass
class Model:
    """Where the sorted arrays lie, and the numbers that hold for the whole model."""

    bigrams: list[dict]
    words: list[dict]
    bigram_cut: tuple[float, float, float]
    word_cut: tuple[float, float, float]
    tokens: int  # N
    vocabulary: int  # V
    types: int
    word_back: float


def train(docs: DataFrame) -> Model:
    """Counts all training texts and stores the model; the driver gets a row of facts for each file."""
    spark = docs.sparkSession
    chars = need(docs, "text").agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(4, chars // 6 // RANGE_TOKENS)
    folder = fresh_path(spark, "lm")
    stored = _store_words(_store_bigrams(_count_bigrams(docs, ranges), folder, max(2, ranges // 4)), folder)
    facts = [json.loads(bytes(r.blob)) for r in written(stored, "lm-files").select("blob").toLocalIterator()]
    bigrams = sorted((f for f in facts if f["kind"] == "bigram"), key=lambda f: f["range"])
    words = sorted((f for f in facts if f["kind"] == "word"), key=lambda f: f["range"])
    seen = np.array([f["of"] for f in words] or [[0] * 4]).sum(axis=0).tolist()
    types = sum(f["types"] for f in words)
    cut = discounts(*seen)
    vocabulary = sum(f["vocabulary"] for f in words)
    n3 = vocabulary - seen[0] - seen[1]
    back = (cut[0] * seen[0] + cut[1] * seen[1] + cut[2] * n3) / types if types else 1.0
    return Model(bigrams, words, discounts(*np.array([f["of"] for f in bigrams] or [[0] * 4]).sum(axis=0).tolist()), cut, sum(f["tokens"] for f in words), vocabulary, types, back)


class Scorer:
    """Looks up blocks of texts in the mapped arrays."""

    def __init__(self, model: Model) -> None:
        self.m = model
        self.single = [(f["range"], self._arrays(f["single_path"], f["singles"], _SINGLE)) for f in model.bigrams]
        self.multi = [(f["range"], self._arrays(f["multi_path"], f["multi"], _MULTI)) for f in model.bigrams]
        self.word = [(f["range"], self._arrays(f["path"], f["n"], _WORD)) for f in model.words]

    @staticmethod
    def _arrays(path: str, n: int, kinds: list[np.dtype]) -> list[np.ndarray]:
        raw = _mapped(path, n)
        out, at = [], 0
        for k in kinds:
            out.append(np.frombuffer(raw, k, n, at) if n else np.zeros(0, k))
            at += n * k.itemsize
        return out

    @staticmethod
    def _look_up(files: list, keys: np.ndarray, values: int) -> list[np.ndarray]:
        """For sorted keys: found (as 1), then each value column; 0 where there is none.

        The files' keys are ranges in order, so each file answers one stretch of the keys.
        """
        found = np.zeros(len(keys), np.float64)
        out = [np.zeros(len(keys), np.float64) for _ in range(values)]
        for _, (names, *columns) in files:
            if not len(names):
                continue
            a, b = np.searchsorted(keys, names[0]), np.searchsorted(keys, names[-1], side="right")
            if a == b:
                continue
            pos = np.searchsorted(names, keys[a:b])
            hit = names[pos] == keys[a:b]
            found[a:b][hit] = 1
            for o, c in zip(out, columns, strict=True):
                o[a:b][hit] = c[pos[hit]]
        return [found, *out]

    def score(self, texts: list[str | None]) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of each text of a block."""
        m = self.m
        hashes = [text_hashes(t) for t in texts]
        n = np.array([len(h) for h in hashes])
        begins = np.cumsum(n) - n
        right = np.concatenate(hashes)
        left = np.empty_like(right)
        left[1:] = right[:-1]
        left[begins] = np.uint64(START)
        words, at = np.unique(np.concatenate([right, left]), return_inverse=True)
        at_right, at_left = at[: len(right)], at[len(right) :]
        _, total, n1, n2, n3, types, tokens = self._look_up(self.word, words, 6)
        cut = np.select([types == 1, types == 2, types > 2], m.word_cut, 0.0)
        unigram = (types - cut) / max(m.types, 1) + m.word_back / (m.vocabulary + 1)
        back = np.where(total > 0, (m.bigram_cut[0] * n1 + m.bigram_cut[1] * n2 + m.bigram_cut[2] * n3) / np.maximum(total, 1), 1.0)
        base = np.log10((tokens + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
        pairs, where = np.unique(bigram_hash(left, right), return_inverse=True)
        (once,) = self._look_up(self.single, pairs, 0)
        _, more = self._look_up(self.multi, pairs, 1)
        c = (once + more)[where]
        own = c - np.select([c == 1, c == 2, c > 2], m.bigram_cut, 0.0)
        p = own / np.maximum(total[at_left], 1) + back[at_left] * unigram[at_right]
        known = tokens[at_right] > 0
        return [n, np.add.reduceat(known.astype(np.int64), begins), np.add.reduceat(base[at_right], begins), np.add.reduceat(np.log10(p), begins)]


_scorers: dict[str, Scorer] = {}


def _scorer(key: str, model: Model) -> Scorer:
    if key not in _scorers:
        _scorers.clear()  # a worker serves one model at a time
        _scorers[key] = Scorer(model)
    return _scorers[key]


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Null and empty texts are their end token alone. Repeated rows get equal rows. An empty table gives
    none; without training texts every probability is the share of one unknown word.
    """
    key = uuid.uuid4().hex
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batch: pa.RecordBatch) -> pa.Table:
        s = _scorer(key, model)
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < _BLOCK:
                size += len(texts[end] or "") // 6
                end += 1
            n, known, base, score = s.score(texts[at:end])
            held = [is_held_out(d) for d in ids[at:end]]
            out.append(pa.RecordBatch.from_arrays([pa.array(ids[at:end], pa.int64()), pa.array(held), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array([model.tokens] * len(n), pa.int64()), pa.array(base), pa.array(score)], names))
            at = end
        return pa.Table.from_batches(out)

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs))
