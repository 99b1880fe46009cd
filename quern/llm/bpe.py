"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of every new word of a batch. A sequence of tokens is what
BPE gives exactly if each token is what BPE makes of its own characters and no two neighbours would
have merged across their border any earlier. The second test runs on all adjacent pairs of the batch
at once, in numpy. Only words with a failing pair go through exact merging.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quern.llm.common import map_batches, need

NEVER = np.int64(1) << 60
#: Above this many cached words a worker starts its cache afresh.
CACHE_WORDS = 1_000_000
#: Characters of text whose new words are encoded together.
CHUNK_CHARS = 4_000_000
#: The same for whole words, which are split into strings of ten times as many bytes.
WORD_CHUNK_CHARS = 1_000_000
#: Texts in which each character's class is the same for ``re`` and for Unicode's categories.
_PLAIN = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself if it is
    printable in Latin-1, else the next free character from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


_INNER, _FINAL = -1, -2


def _sliced(flat: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """A flat array of ids as the little-endian bytes of each word's."""
    raw, ends = flat.astype("<u4").tobytes(), (np.cumsum(lengths) * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class MergeTable:
    """Ranks of the merges of a BPE vocabulary file, and tests on token pairs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*self.ids.values(), *self.special.values()])
        symbol = byte_symbols()
        byte_of = {ord(c): b for b, c in enumerate(symbol)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.arange(self.size, dtype=np.int64)
        self.right = np.arange(self.size, dtype=np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(pairs):
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            self.merge[x, y] = (r, z)
            self.rank[z], self.left[z], self.right[z] = r, x, y
        keys = np.array([x * self.size + y for x, y in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_rank = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.pair_made = np.array([z for _, z in self.merge.values()], np.int64)[order]
        self.tested, self.verdict = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)
        self.text = [""] * self.size
        for s, i in [*self.ids.items(), *self.special.items()]:
            self.text[i] = s
        # Which tokens does BPE make of their own characters?
        made = np.flatnonzero(self.rank >= 0)
        whole = np.ones(self.size, bool)
        whole[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for z in made[np.argsort(self.rank[made])].tolist():
            whole[z] &= whole[self.left[z]] & whole[self.right[z]]
        self.whole = whole
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.base = [0] * 256
        self.base_final = [0] * 256
        n = len(self.suffix)
        for s, i in self.ids.items():
            end = bool(n) and s.endswith(self.suffix)
            raw = bytes(byte_of[ord(c)] for c in (s[:-n] if end else s))
            if whole[i] and raw:
                (self.final if end else self.inner)[raw] = i
            if len(raw) == 1:
                (self.base_final if end else self.base)[raw[0]] = i
        if not n:
            self.final, self.base_final = self.inner, self.base
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.trie: dict[int, dict] = {}
        for tokens, kind in ((self.inner, _INNER), (self.final, _FINAL)):
            for raw, i in tokens.items():
                node = self.trie
                for b in raw:
                    node = node.setdefault(b, {})
                node[kind] = i

    def compatible(self, left: np.ndarray, right: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair: True if BPE doesn't merge across the border (before the merge of that rank).

        The later of the two tokens' last merges is undone, again and again; a pair of the pieces at
        the border that would have merged sooner than what was undone shows that the border falls.
        """
        ok = np.ones(len(left), bool)
        at = np.arange(len(left))
        l, r = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(l), NEVER) if before is None else before.astype(np.int64)
        while len(at):
            key = l * self.size + r
            pos = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            falls = (self.pair_keys[pos] == key) & (self.pair_rank[pos] < limit)
            ok[at[falls]] = False
            rl, rr = self.rank[l], self.rank[r]
            go = ~falls & (np.maximum(rl, rr) >= 0)
            at, l, r, rl, rr = at[go], l[go], r[go], rl[go], rr[go]
            undo_left = rl > rr
            limit = np.where(undo_left, rl, rr + 1)  # of equal ranks, the leftmost merges first
            l = np.where(undo_left, self.right[l], l)
            r = np.where(undo_left, r, self.left[r])
        return ok

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` with the verdicts on pairs met lately kept in a fixed table of 2**20 slots."""
        key = left * self.size + right
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        ok = self.verdict[slot]
        miss = np.flatnonzero(self.tested[slot] != key)
        if len(miss):
            pair, which = np.unique(key[miss], return_inverse=True)
            ok[miss] = self.compatible(pair // self.size, pair % self.size)[which]
            self.tested[slot[miss]] = key[miss]
            # of several pairs for one slot the last stays, in both tables
            self.verdict[slot[miss]] = ok[miss]
        return ok

    def merged(self, word: bytes) -> list[int]:
        """Exact merging of one word of any length: the pair of lowest rank first, the leftmost of
        equals, from a heap over a linked list."""
        ids = [self.base[b] for b in word[:-1]] + [self.base_final[word[-1]]]
        merge, n = self.merge, len(word)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], k, ids[k], ids[k + 1]) for k in range(n - 1) if (m := merge.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], ids[j], after[k] = merge[a, b][1], -1, after[j]
            if after[j] < n:
                prior[after[j]] = k
            for x, y in ((prior[k], k), (k, after[k])):
                if x >= 0 and y < n and (m := merge.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair's merge; NEVER where there is none."""
        key = left * self.size + right
        pos = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[pos] == key, self.pair_rank[pos], NEVER), self.pair_made[pos]

    def merged_all(self, some: list[bytes]) -> list[bytes]:
        """Exact merging of many words: in each round every word has its next merge, all at once."""
        out = [b""] * len(some)
        short = [k for k, w in enumerate(some) if len(w) <= 64]
        for k, w in enumerate(some):
            if len(w) > 64:
                out[k] = np.array(self.merged(w), "<u4").tobytes()
        if not short:
            return out
        width = np.array([len(some[k]) for k in short])
        ends = np.cumsum(width)
        raw = np.frombuffer(b"".join([some[k] for k in short]), np.uint8)
        ids = np.array(self.base, np.int64)[raw]
        ids[ends - 1] = np.array(self.base_final, np.int64)[raw[ends - 1]]
        owner = np.repeat(np.arange(len(short)), width)
        rank = np.full(len(ids), NEVER)  # of the pair that starts here
        made = np.zeros(len(ids), np.int64)
        at = np.flatnonzero(owner[:-1] == owner[1:])
        rank[at], made[at] = self.pair_ranks(ids[at], ids[at + 1])
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(ids)])
            done = least == NEVER
            if done.any():
                over = np.repeat(done, sizes)
                for k, x in zip(owner[starts[done]].tolist(), _sliced(ids[over], sizes[done]), strict=True):
                    out[short[k]] = x
                ids, owner, rank, made = ids[~over], owner[~over], rank[~over], made[~over]
                continue
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            hit = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]  # the leftmost of equals
            ids[hit] = made[hit]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            rank[hit] = NEVER
            moved = hit - np.arange(len(hit))
            ids, owner, rank, made = ids[keep], owner[keep], rank[keep], made[keep]
            for at in (moved[moved + 1 < len(ids)], moved[moved > 0] - 1):
                at = at[owner[at] == owner[at + 1]]
                rank[at], made[at] = self.pair_ranks(ids[at], ids[at + 1])
        return out

    def proposed(self, word: bytes) -> list[int]:
        """Greedy longest match along a trie. Every byte is a token, so a match exists."""
        out, at, n, root = [], 0, len(word), self.trie
        while at < n:
            node, i = root, at
            while i < n and (node := node.get(word[i])):
                i += 1
                if i < n and (t := node.get(_INNER)) is not None:
                    best, end = t, i
            if node and (t := node.get(_FINAL)) is not None:
                out.append(t)
                break
            out.append(best)
            at = end
        return out

    def encoded(self, new: list[bytes]) -> list[bytes]:
        """Tokens of words, as little-endian unsigned 32-bit integers: proposal, one test of all
        pairs, exact merging of what fails."""
        if not new:
            return []
        proposals = [self.proposed(w) for w in new]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(new)), lengths)
        inside = owner[:-1] == owner[1:]
        a, b, o = flat[:-1][inside], flat[1:][inside], owner[:-1][inside]
        fits = self.fits(a, b)
        out = _sliced(flat, lengths)
        failing = np.unique(o[~fits]).tolist()
        for at in range(0, len(failing), 8192):
            block = failing[at : at + 8192]
            for k, ids in zip(block, self.merged_all([new[k] for k in block]), strict=True):
                out[k] = ids
        return out


_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")


class WordEncoder:
    """Encodes whole texts with a vocabulary of the word-end kind: NFC, lower case, white space dropped."""

    _PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|"
    #: For plain characters only; the order of alternatives that start differently is free.
    _fast = re.compile("[" + "".join(chr(c) for c in range(0x250) if chr(c).isalpha()) + r"]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+")
    _full = regex.compile(_PARTS + r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str) -> None:
        self.table = MergeTable(path)
        self.cache: dict[str, bytes] = {}
        self.split = re.compile("(" + "|".join(map(re.escape, self.table.special)) + ")") if self.table.special else None

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return [text]
            if text[:-1].isalpha():
                return [text[:-1], text[-1]]
            return self._fast.findall(text) if not _SEPARATORS.search(text) else self._full.findall(text)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self._full if _PLAIN.search(text) else self._fast).findall(text)

    def _learn(self, new: list[str]) -> None:
        """Encodes whitespace-parted stretches, whose pieces no neighbour can change."""
        pieces = [self.pieces(w) for w in new]
        order = list({p for row in pieces for p in row})
        ids = self.table.encoded([w.encode("utf-8", "surrogatepass") for w in order])
        get = dict(zip(order, ids, strict=True)).__getitem__
        for w, row in zip(new, pieces, strict=True):
            self.cache[w] = get(row[0]) if len(row) == 1 else b"".join(map(get, row))

    def encode_all(self, texts: list[str | None], cache_words: int = CACHE_WORDS) -> list[bytes]:
        """For each text the ids as little-endian unsigned 32-bit integers; null and empty texts have none.

        The strings of special tokens count as those tokens wherever a text holds them. Texts go
        through in chunks of about WORD_CHUNK_CHARS, and a chunk's new words are encoded together.
        The cache starts afresh above ``cache_words``, of about 125 bytes each.
        """
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and chars < WORD_CHUNK_CHARS:
                chars += len(texts[end] or "")
                end += 1
            rows = [[] if not t else self.split.split(t) if self.split and "<|" in t else [t] for t in texts[at:end]]
            # str.split also parts at the separators U+001C to U+001F, which aren't white space here
            parts = [[p if k % 2 else p.split() if not _SEPARATORS.search(p) else _SPACE.split(p) for k, p in enumerate(row)] for row in rows]
            cache = self.cache
            new = list({w for row in parts for part in row[::2] for w in part if w not in cache})
            if len(cache) + len(new) > cache_words:
                cache.clear()
                new = list({w for row in parts for part in row[::2] for w in part})
            self._learn(new)
            get, special = cache.__getitem__, self.table.special
            out.extend(b"".join([b"".join(map(get, p)) if k % 2 == 0 else np.array([special[p]], "<u4").tobytes() for k, p in enumerate(row)]) for row in parts)
            at = end
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings, parted by spaces, as the library gives them where a file names no decoder."""
        return " ".join(map(self.table.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder and cache for each worker process and vocabulary."""
    if path not in _encoders:
        gc.disable()  # a worker's caches hold no cycles, and collection would walk a million entries again and again
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit): every whole text, encoded.

    Null and empty texts give empty ids. Repeated rows give repeated rows; null doc_ids are kept.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = word_encoder(vocabulary)
        ids = pa.array(e.encode_all(batch.column(1).to_pylist()), pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text from doc_id, ids. Null ids give a null text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = word_encoder(vocabulary)
        text = [None if x is None else e.decode(x) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return map_batches(need(encoded, "doc_id", "ids"), run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes from the ids, keeps digests.

    One pass, no shuffle. Null text counts as empty: no tokens, digests of nothing.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = word_encoder(vocabulary)
        n, a, b = [], [], []
        for ids in e.encode_all(batch.column(1).to_pylist()):
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(e.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
