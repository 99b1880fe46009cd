"""Substring deduplication: Rabin-Karp hashes of every fixed-length window of words.

Only windows that may repeat need counting across documents. Each window's minimizer (the least hash
of its inner half-length windows) is the same wherever the window occurs, so a window repeats only if
its minimizer does. The few minimizers of each document are counted first, map-side summed; then only
windows with a repeated minimizer have their full hashes counted. What a smaller document also starts
is removed, its windows merged into maximal intervals. No window is lost on the way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_long, free_name, map_batches, mixed, need, word_hashes, words, written

#: Base of the rolling hash, an odd number of 64 bits; arithmetic is modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``size`` words, from prefix sums of h[i] * BASE**i.

    The words' hashes are mixed 64-bit numbers, and so is each window's result.
    """
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(h) - 1, np.uint64(BASE))])
        back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, np.uint64(_INVERSE))])
        total = np.r_[np.uint64(0), np.cumsum(h * power)]
        return mixed((total[size:] - total[:-size])[:n] * back)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def minimizers(h: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words the least hash of the windows of half that length inside it."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    half = max(1, size // 2)
    return sliding_min(rolling(h, half), size - half + 1)


def intervals(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals [begin, end) of words that windows at sorted starts cover."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > size) + 1
    return starts[np.r_[0, cut]], starts[np.r_[cut - 1, len(starts) - 1]] + size


def document_minimizers(docs: DataFrame, size: int) -> DataFrame:
    """minimizer, doc_id: distinct in each row of documents with at least one window."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(minimizers(word_hashes(words(t.as_py())), size)) for t in batch.column(1)]
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), list(map(len, found)))
        return pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(found))), pa.array(ids, pa.int64())], ["minimizer", "doc_id"])

    return map_batches(need(docs, "doc_id", "text").where("doc_id is not null"), run, "minimizer long, doc_id long")


def by_window(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Distinct windows of a text, the first start of each, and its other starts; None for most, which start once."""
    found, first, n = np.unique(hashes, return_index=True, return_counts=True)
    more = [None] * len(found)
    if (often := np.flatnonzero(n > 1)).size:
        order = np.argsort(hashes, kind="stable")
        ends = np.cumsum(n)
        for k in often.tolist():
            more[k] = at[order[ends[k] - n[k] + 1 : ends[k]]]
    return found, at[first], more


def repeated_starts(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, starts: the windows of each document that also start in a smaller one, in any order."""
    found = written(document_minimizers(docs, size), "minimizers")
    repeated = found.groupBy("minimizer").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("minimizer")
    wanted = found.join(repeated, "minimizer").groupBy("doc_id").agg(F.collect_set("minimizer").alias("wanted"))
    chosen = need(docs, "doc_id", "text").join(wanted, "doc_id")

    def run(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for doc, text, want in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            h = word_hashes(words(text.as_py()))
            at = np.flatnonzero(np.isin(minimizers(h, size), want.values.to_numpy().view(np.uint64))).astype(np.int32)
            window, start, more = by_window(rolling(h, size)[at], at)
            columns = [pa.array(as_long(window)), pa.array(np.full(len(start), doc), pa.int64()), pa.array(start), pa.array(more, pa.list_(pa.int32()))]
            out.append(pa.RecordBatch.from_arrays(columns, ["window", "doc_id", "start", "more"]))
        return pa.Table.from_batches(out)

    # a window is a row of its text once, however often it starts there: a short period fills a text with few windows
    windows = written(map_batches(chosen, run, "window long, doc_id long, start int, more array<int>"), "windows")
    first = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("window", "first")
    gone = windows.join(first, "window").where("first < doc_id").groupBy("doc_id").agg(F.collect_set("start").alias("starts"), F.collect_list("more").alias("more"))
    return gone.select("doc_id", F.concat("starts", F.flatten("more")).alias("starts"))


def _with_starts(docs: DataFrame, size: int, name: str) -> DataFrame:
    return docs.join(repeated_starts(docs, size).withColumnRenamed("starts", name), "doc_id", "left")


def _cut(text: str | None, starts, size: int) -> tuple[list[bytes], int, list[bytes]]:
    """Words, number removed, words kept."""
    tokens = words(text)
    if starts is None or not len(starts):
        return tokens, 0, tokens
    begins, ends = intervals(np.unique(starts), size)
    kept, at = [], 0
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        kept += tokens[at:a]
        at = b
    kept += tokens[at:]
    return tokens, len(tokens) - len(kept), kept


def removal_digests(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per document.

    A word goes if a window of ``size`` consecutive words that covers it also starts in a document of
    smaller id; windows are judged on the input. Null and empty texts have no words. Rows of equal id
    hold nothing against each other, and a row without id loses nothing.
    """
    chosen = need(docs, "doc_id", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, removed, digest = [], [], []
        for text, starts in zip(batch.column(1), batch.column(2), strict=True):
            tokens, gone, kept = _cut(text.as_py(), starts.values.to_numpy() if starts.is_valid else None, size)
            n.append(len(tokens))
            removed.append(gone)
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return map_batches(_with_starts(chosen, size, "starts").select("doc_id", "text", "starts"), run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, size: int) -> DataFrame:
    """The documents with repeated windows cut out of their texts; other columns as they are.

    A text that loses words keeps its other words with one space between them; other texts stay as
    they are, character for character.
    """
    names = docs.columns
    starts = free_name(docs, "starts")
    joined = _with_starts(docs, size, starts).select(*[F.col(f"`{c}`") for c in names], F.col(starts))
    where = names.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, starts in zip(batch.column(where), batch.column(len(names)), strict=True):
            text = text.as_py()
            if starts.is_valid:
                _, gone, kept = _cut(text, starts.values.to_numpy(), size)
                text = b" ".join(kept).decode("utf-8", "surrogatepass") if gone else text
            out.append(text)
        columns = [pa.array(out, pa.string()) if k == where else batch.column(k) for k in range(len(names))]
        return pa.RecordBatch.from_arrays(columns, names)

    return map_batches(joined, run, docs.schema)
