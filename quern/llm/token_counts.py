"""Exact token counts at every prefix, by dynamic programming over prefixes.

Of all tokens that end a prefix exactly one is the last token of the prefix's encoding: the one that
fits the last token of what comes before it. So ``count[i] = count[i - len(token)] + 1`` goes through
a piece once and leaves the exact count at each of its prefixes. A text's counts are those of its
pieces, shifted; what a budget allows and where to cut are then lookups, with no second encoding.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Sequence
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quern.llm.bpe import _PLAIN, CACHE_WORDS, CHUNK_CHARS, MergeTable
from quern.llm.common import list_column, map_batches, need

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Pieces of more bytes than this are counted one by one.
_LOCKSTEP = 40


class PrefixCounter:
    """Counts tokens of a byte-level vocabulary at every prefix of a text."""

    _full = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    _fast = re.compile(" ?[" + "".join(chr(c) for c in range(0x250) if chr(c).isalpha()) + r"]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    _runs = regex.compile(r"\s\s+")

    def __init__(self, path: str) -> None:
        self.table = t = MergeTable(path)
        self.cache: dict[str, Sequence[int]] = {}
        self.split = re.compile("(" + "|".join(map(re.escape, t.special)) + ")") if t.special else None
        self.lengths = sorted({len(raw) for raw in t.inner})
        self.power = np.ones(t.longest + 1, np.uint64)
        np.multiply.accumulate(np.full(t.longest, _MULTIPLIER), out=self.power[1:])
        keys, ids = [], []
        for raw, i in t.inner.items():
            h = 0
            for b in raw:
                h = (h * int(_MULTIPLIER) + b + 1) & 0xFFFFFFFFFFFFFFFF
            keys.append(h)
            ids.append(i)
        order = np.argsort(np.array(keys, np.uint64))
        self.keys, self.token = np.array(keys, np.uint64)[order], np.array(ids, np.int64)[order]

    def _lockstep(self, joined: bytes, n: int) -> np.ndarray:
        """Counts at each byte prefix of pieces of one length: all pieces advance together."""
        raw = np.frombuffer(joined, np.uint8).reshape(-1, n).T.astype(np.uint64)
        rows = raw.shape[1]
        hashes = np.zeros((n + 1, rows), np.uint64)
        for i in range(n):
            hashes[i + 1] = hashes[i] * _MULTIPLIER + raw[i] + np.uint64(1)
        last, count = np.zeros((n + 1, rows), np.int64), np.zeros((n + 1, rows), np.int64)
        for i in range(1, n + 1):
            who, size, token = [], [], []
            for k in self.lengths:
                if k > i:
                    break
                h = hashes[i] - hashes[i - k] * self.power[k]
                pos = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                hit = np.flatnonzero(self.keys[pos] == h)
                who.append(hit)
                size.append(np.full(len(hit), k))
                token.append(self.token[pos[hit]])
            w, k, t = np.concatenate(who), np.concatenate(size), np.concatenate(token)
            before = i - k
            fits = before == 0
            inner = np.flatnonzero(~fits)
            fits[inner] = self.table.fits(last[before[inner], w[inner]], t[inner])
            w, k, t = w[fits], k[fits], t[fits]
            last[i, w] = t
            count[i, w] = count[i - k, w] + 1
        return count[1:].T

    def _single(self, raw: bytes) -> np.ndarray:
        """Counts at each byte prefix of one piece of any length."""
        n, t = len(raw), self.table
        last, count = [0] * (n + 1), np.zeros(n + 1, np.int64)
        known: dict[tuple[int, int], bool] = {}
        for i in range(1, n + 1):
            for k in self.lengths:
                if k > i:
                    break
                token = t.inner.get(raw[i - k : i])
                if token is None:
                    continue
                if k < i:
                    pair = (last[i - k], token)
                    if pair not in known:
                        known[pair] = bool(t.compatible(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if not known[pair]:
                        continue
                last[i], count[i] = token, count[i - k] + 1
                break
        return count[1:]

    def _learn(self, new: list[str]) -> None:
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for p in new:
            raw = p.encode("utf-8", "surrogatepass")
            groups.setdefault(len(raw), []).append((p, raw))
        for n, group in groups.items():
            for at in range(0, len(group), 8192):
                block = group[at : at + 8192]
                if n > _LOCKSTEP:
                    for p, raw in block:
                        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
                        c = self._single(raw)[np.r_[np.flatnonzero(lead)[1:] - 1, n - 1]]
                        self.cache[p] = bytes(c.tolist()) if c.max() < 256 else array("I", c.tolist())
                    continue
                joined = b"".join([raw for _, raw in block])
                lead = ((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80).reshape(-1, n)
                ends = np.roll(lead, -1, axis=1)  # a character's last byte stands before a lead byte, or last
                ends[:, -1] = True
                flat = self._lockstep(joined, n).astype(np.uint8)[ends].tobytes()
                stops = np.cumsum(ends.sum(axis=1)).tolist()
                for (p, _), x, y in zip(block, [0, *stops[:-1]], stops, strict=True):
                    self.cache[p] = flat[x:y]
        for p in ("'re", "'ve", "'ll"):
            if p in self.cache:  # cut short, the apostrophe and the letter part
                self.cache[p] = bytes([1, 2, self.cache[p][2]])

    def pieces(self, text: str) -> list[str]:
        return (self._full if _PLAIN.search(text) else self._fast).findall(text)

    def _need(self, pieces: list[list[str]]) -> None:
        cache = self.cache
        new = list({p for row in pieces for p in row if p not in cache})
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = list({p for row in pieces for p in row})
        self._learn(new)

    def _plain(self, text: str, pieces: list[str]) -> np.ndarray:
        """Counts at the character prefixes of a text without special strings."""
        if not text:
            return np.zeros(0, np.int64)
        got = list(map(self.cache.__getitem__, pieces))
        total = np.fromiter(map(itemgetter(-1), got), np.int64, len(got))
        width = np.fromiter(map(len, got), np.int64, len(got))
        try:
            inside = np.frombuffer(b"".join(got), np.uint8)
            odd = len(inside) != len(text)
        except TypeError:
            odd = True
        if odd:  # a piece of over 255 tokens
            inside = np.concatenate([np.array(list(v)) for v in got])
        counts = np.repeat(np.cumsum(total) - total, width) + inside
        for m in self._runs.finditer(text):  # cut inside white space, the run so far is one piece
            a, b = m.span()
            run = text[a:b]
            if run not in self.cache:
                self._learn([run])
            if b < len(text):
                counts[a:b] = (counts[a - 1] if a else 0) + np.array(list(self.cache[run]))
        return counts

    def totals_and_prefixes(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the exact count at every character prefix (empty and null: none).

        A prefix counts as a text of its own, special strings inside texts as their one token.
        """
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and chars < CHUNK_CHARS:
                chars += len(texts[end] or "")
                end += 1
            jobs: list[list[str]] = []
            for t in texts[at:end]:
                parts = [t or ""] if not (t and self.split and "<|" in t) else self.split.split(t)
                jobs.append(parts)
            # A part before a special string is also counted with that string as ordinary text
            flat = [[p for k in range(0, len(parts), 2) for p in ([parts[k]] if k + 1 == len(parts) else [parts[k], parts[k] + parts[k + 1][:-1]])] for parts in jobs]
            cut = [[self.pieces(p) for p in row] for row in flat]
            self._need([p for row in cut for p in row])
            for parts, row, pieces in zip(jobs, flat, cut, strict=True):
                if len(row) == 1:
                    out.append(self._plain(row[0], pieces[0]))
                    continue
                base, got, j = 0, [], 0
                for k in range(0, len(parts), 2):
                    own = self._plain(row[j], pieces[j])
                    if k + 1 < len(parts):
                        base_after = base + (int(own[-1]) if len(own) else 0) + 1
                        got += [base + self._plain(row[j + 1], pieces[j + 1]), np.array([base_after])]
                        base = base_after
                        j += 2
                    else:
                        got.append(base + own)
                out.append(np.concatenate(got))
            at = end
        return out


_counters: dict[str, PrefixCounter] = {}


def prefix_counter(path: str) -> PrefixCounter:
    """One counter and cache for each worker process and vocabulary."""
    if path not in _counters:
        gc.disable()  # as in bpe.word_encoder
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, counts array<int>: the exact token count at every character prefix of each whole text.

    Null and empty texts have an empty array; repeated rows and null ids are kept.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = prefix_counter(vocabulary).totals_and_prefixes(batch.column(1).to_pylist())
        flat = np.concatenate([*got, np.zeros(0, np.int64)]).astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column(0), list_column(flat, [len(x) for x in got], pa.int32())], ["doc_id", "counts"])

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, counts array<int>")


def count_tokens(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars: counts and the answer to one budget.

    ``fit_chars`` is the length of the longest prefix of at most ``limit`` tokens, read off the
    stored prefix counts. Null text counts as empty. One pass, no shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        size, total, fit = [], [], []
        for t, counts in zip(texts, prefix_counter(vocabulary).totals_and_prefixes(texts), strict=True):
            size.append(len(t.encode("utf-8", "surrogatepass")) if t else 0)
            total.append(int(counts[-1]) if len(counts) else 0)
            if total[-1] <= limit:
                fit.append(len(counts))
            else:
                within = np.flatnonzero(counts <= limit)
                fit.append(int(within[-1]) + 1 if len(within) else 0)
        over = [n > limit for n in total]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(total, pa.int64()), pa.array(over, pa.bool_()), pa.array(fit, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
        )

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
