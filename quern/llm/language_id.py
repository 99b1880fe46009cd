"""Language identification by a linear-chain conditional random field over words.

A word's features are its affixes (byte n-grams that hold its edge), inner byte n-grams, itself, and the set
of languages whose lexicon has it; transitions between the labels of neighbours are learned with them. Forward
and backward sums give each word's label probabilities, so a text that switches languages is labelled word by
word; its language is the label that most of its words are expected to have.

The model is fitted on a bounded sample: SEGMENTS stretches of SPAN words a language, from anywhere in the
texts, half of them joined with a stretch of another language, so that there are switches to learn from.
Texts are labelled in blocks: long ones are cut into stretches whose transfer matrices are multiplied, so all
stretches of a block advance together and the sums over whole texts are exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_batches, mixed, need, word_hashes

#: Words of a training stretch, and stretches of each language.
SPAN, SEGMENTS = 32, 3000
#: Weights of hashed features (a power of two), and the lengths of byte n-grams.
BUCKETS, GRAMS = 1 << 18, (2, 3, 4)
EPOCHS, BATCH, RATE, DECAY = 4, 128, 0.3, 1e-6
#: The label of a text without letters.
UNDETERMINED = "und"
#: Above this many cached words a worker starts its cache afresh.
_CACHE = 600_000
_BLOCK = 4_000_000  # characters labelled at once
_STRETCH = 64


def lowered_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split() if text else []


def has_letter(word: bytes) -> bool:
    w = word.decode("utf-8", "surrogatepass")
    return w.isalpha() or any(map(str.isalpha, w))


def gram_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and, for each, the number of its word: n-grams of `` word ``, edges included."""
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    space = raw == 0x20
    of = np.cumsum(space) - 1
    feats, owner = [], []
    for n in GRAMS:
        m = len(raw) - n + 1
        if m <= 0:
            continue
        h, whole = np.full(m, np.uint64(n)), np.ones(m, bool)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + raw[i : i + m]
            if 0 < i < n - 1:
                whole &= ~space[i : i + m]
        whole &= of[:m] < len(words)
        feats.append(mixed(h[whole]) & np.uint64(BUCKETS - 1))
        owner.append(of[:m][whole])
    feats.append(word_hashes(words) & np.uint64(BUCKETS - 1))
    owner.append(np.arange(len(words)))
    return np.concatenate(feats).astype(np.int64), np.concatenate(owner)


def lexicon_feature(languages: np.ndarray) -> np.ndarray:
    """The feature of a set of languages, as bits."""
    return (mixed(languages.astype(np.uint64) + np.uint64(0x51ED)) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    """Weights by feature and label, transitions, and the words of each language's lexicon (hash and bits, sorted)."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: np.ndarray
    bits: np.ndarray

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros(len(hashes), np.uint64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, self.bits[at], np.uint64(0))

    def potentials(self, words: list[bytes], letter: np.ndarray) -> np.ndarray:
        """The score of each label for each word; zeros without a letter."""
        feats, owner = gram_features(words)
        out = np.stack([np.bincount(owner, self.weights[feats, k], len(words)) for k in range(len(self.labels))], 1)
        out += self.weights[lexicon_feature(self.languages_of(word_hashes(words)))]
        out[~letter] = 0
        return out


def _exps(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(-1, keepdims=True))


def marginals(potentials: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities at each place of chains of equal length (places, chains, labels), and the expected transitions."""
    e, move = _exps(potentials), np.exp(transitions)
    ahead, back = np.empty_like(e), np.ones_like(e)
    for t in range(len(e)):
        x = e[t] * (ahead[t - 1] @ move if t else 1)
        ahead[t] = x / x.sum(-1, keepdims=True)
    for t in range(len(e) - 2, -1, -1):
        x = (e[t + 1] * back[t + 1]) @ move.T
        back[t] = x / x.sum(-1, keepdims=True)
    p = ahead * back
    p /= p.sum(-1, keepdims=True)
    pairs = ahead[:-1, :, :, None] * move * (e[1:] * back[1:])[:, :, None, :]
    return p, (pairs / pairs.sum((-1, -2), keepdims=True)).sum((0, 1))


def label_sums(scores: np.ndarray, counted: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Expected number of each label among the counted words, for each text of a block.

    scores: words of all texts, one after another, by labels; sizes: words of each text.
    """
    labels, texts = scores.shape[1], len(sizes)
    out = np.zeros((texts, labels))
    if not len(scores):
        return out
    move = np.exp(transitions)
    per = -(-sizes // _STRETCH)
    first = np.cumsum(per) - per
    total = int(per.sum())
    text = np.repeat(np.arange(texts), per)
    begin = np.repeat(np.cumsum(sizes) - sizes, per) + (np.arange(total) - first[text]) * _STRETCH
    end = np.minimum(begin + _STRETCH, np.repeat(np.cumsum(sizes), per))
    place = begin[None, :] + np.arange(_STRETCH)[:, None]  # (place in stretch, stretch)
    real = place < end[None, :]
    e = _exps(scores)[np.minimum(place, len(scores) - 1)]
    heard = real & counted[np.minimum(place, len(scores) - 1)]
    # each stretch as one matrix, scaled
    through = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for t in range(_STRETCH):
        x = (through @ move) * e[t][:, None, :]
        through = np.where(real[t][:, None, None], x / x.sum((1, 2), keepdims=True), through)
    # what comes into each stretch from before and from behind, all texts together
    into, behind = np.full((total, labels), 1 / labels), np.full((total, labels), 1 / labels)
    enter = np.linalg.solve(move.T, np.ones(labels))  # so that the first word's sum is its own factor alone
    into[first[per > 0]] = enter
    for j in range(1, int(per.max())):
        at = first[per > j] + j
        x = np.einsum("sl,slm->sm", into[at - 1], through[at - 1])
        into[at] = x / x.sum(1, keepdims=True)
        back = first[per > j] + per[per > j] - 1 - j
        x = np.einsum("slm,sm->sl", through[back + 1], behind[back + 1])
        behind[back] = x / x.sum(1, keepdims=True)
    ahead = np.empty_like(e)
    now = into
    for t in range(_STRETCH):
        x = (now @ move) * e[t]
        now = np.where(real[t][:, None], x / x.sum(1, keepdims=True), now)
        ahead[t] = now
    sums, now = np.zeros((total, labels)), behind
    for t in range(_STRETCH - 1, -1, -1):
        p = ahead[t] * now
        sums += np.where(heard[t][:, None], p / p.sum(1, keepdims=True), 0)
        x = (e[t] * now) @ move.T
        now = np.where(real[t][:, None], x / x.sum(1, keepdims=True), now)
    np.add.at(out, text, sums)
    return out


def fit(segments: list[tuple[str, bytes]]) -> Model:
    """A model of (language, words) stretches. The order of the stretches is the order of training."""
    labels = sorted({lang for lang, _ in segments})
    index = {lang: k for k, lang in enumerate(labels)}
    vocabulary: dict[bytes, int] = {}
    chains = [([vocabulary.setdefault(w, len(vocabulary)) for w in words.split()], index[lang]) for lang, words in segments]
    chains = [(ids, lang) for ids, lang in chains if ids]
    words = list(vocabulary)
    if not chains:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    n_labels = len(labels)
    seen = np.zeros((len(words), n_labels), np.int64)  # stretches of each language that hold a word
    for ids, lang in chains:
        seen[list(set(ids)), lang] += 1
    flags = np.uint64(1) << np.arange(n_labels, dtype=np.uint64)
    feats, owner = gram_features(words)
    order = np.argsort(owner, kind="stable")
    feats, counts = feats[order], np.bincount(owner, minlength=len(words))
    starts = np.cumsum(counts) - counts
    letters = np.array([has_letter(w) for w in words])
    weights, power = np.zeros((BUCKETS, n_labels), np.float32), np.full((BUCKETS, n_labels), 1e-4, np.float32)
    moves, moves_power = np.zeros((n_labels, n_labels)), np.full((n_labels, n_labels), 1e-4)
    # every second chain is joined with one of another language
    rnd = np.random.default_rng(11)
    for _ in range(EPOCHS):
        turn = rnd.permutation(len(chains))
        mate = rnd.permutation(len(chains))
        for at in range(0, len(chains), BATCH):
            ids, gold, own = _joined([chains[k] for k in turn[at : at + BATCH]], [chains[k] for k in mate[at : at + BATCH]], rnd)
            real = ids >= 0
            used, where = np.unique(ids[real], return_inverse=True)
            size = counts[used]
            flat = feats[np.repeat(starts[used] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            mine = np.repeat(np.arange(len(used)), size)
            # a stretch's own sighting of a word says nothing about other texts: left out
            left = seen[ids[real]] - np.eye(n_labels, dtype=np.int64)[own[real]]
            lex = lexicon_feature(((left > 0) * flags).sum(1))
            score = np.stack([np.bincount(mine, weights[flat, k], len(used)) for k in range(n_labels)], 1)
            e = np.zeros((*ids.shape, n_labels))
            e[real] = (score[where] + weights[lex]) * letters[ids[real]][:, None]
            p, pairs = marginals(e, moves)
            told = np.eye(n_labels)[gold]
            slope = ((told - p)[real] * letters[ids[real]][:, None]).astype(np.float64)
            by_word = np.stack([np.bincount(where, slope[:, k], len(used)) for k in range(n_labels)], 1)
            g = np.stack([np.bincount(np.concatenate([flat, lex]), np.concatenate([by_word[mine, k], slope[:, k]]), BUCKETS) for k in range(n_labels)], 1).astype(np.float32)
            g -= DECAY * len(ids) * weights
            power += g * g
            weights += RATE * g / np.sqrt(power)
            held = np.zeros((n_labels, n_labels))
            np.add.at(held, (gold[:-1].ravel(), gold[1:].ravel()), 1)
            g = held - pairs - 1e-3 * moves
            moves_power += g * g
            moves += RATE * g / np.sqrt(moves_power)
    hashes = word_hashes(words)
    order = np.argsort(hashes)
    return Model(labels, weights, moves, hashes[order], ((seen > 0) * flags).sum(1)[order])


def _joined(chains: list, mates: list, rnd: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (-1: none), labels and the language of each word's stretch, as (place, chain); every second chain is half another's."""
    ids, gold = np.full((SPAN, len(chains)), -1), np.zeros((SPAN, len(chains)), np.int64)
    for k, ((own, lang), (other, second)) in enumerate(zip(chains, mates, strict=True)):
        if k % 2:
            cut = int(rnd.integers(1, SPAN))
            own, labels = (own[:cut] + other)[:SPAN], ([lang] * len(own[:cut]) + [second] * SPAN)[:SPAN]
        else:
            labels = [lang] * SPAN
        ids[: len(own), k] = own
        gold[:, k] = labels
    return ids, gold, gold


def _training(docs: DataFrame) -> tuple[DataFrame, Column]:
    """Rows that may be learned from: crc32 of the id as text, mod 5, is not 0; the second is true of held-out rows."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()), held_out


def sampled(docs: DataFrame) -> list[tuple[str, bytes]]:
    """About SEGMENTS stretches of each language, chosen by hash from all its words in training rows; never more."""
    training, _ = _training(need(docs, "doc_id", "text", "lang"))
    chars = {r.lang: r.chars for r in training.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).collect()}
    share = {lang: min(1.0, SEGMENTS * SPAN * 6 / max(n or 0, 1)) for lang, n in chars.items()}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, hashes, spans = [], [], []
        for doc, text, lang in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words = lowered_words(text)
            n = -(-len(words) // SPAN)
            h = mixed(np.arange(n, dtype=np.uint64) + np.uint64(zlib.crc32(str(doc).encode()) << 24))
            for k in np.flatnonzero(h < np.uint64(int(share[lang] * (2**64 - 1)))) if share[lang] < 1 else range(n):
                langs.append(lang)
                hashes.append(int(h[k] >> np.uint64(1)))
                spans.append(b" ".join(words[k * SPAN : (k + 1) * SPAN]))
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(spans, pa.binary())], ["lang", "h", "span"])

    found = map_batches(training, run, "lang string, h long, span binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["h"], r["lang"], r["span"]))
    out, taken = [], dict.fromkeys(share, 0)
    for r in found:
        if taken[r["lang"]] < SEGMENTS:
            taken[r["lang"]] += 1
            out.append((r["lang"], r["span"]))
    return out


class Labeller:
    """Labels blocks of texts; scores of words are kept."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.scores, self.letter = np.zeros((0, len(self.model.labels))), np.zeros(0, bool)

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Expected words of each label, and words with a letter, of each text."""
        words = [lowered_words(t) for t in texts]
        if len(self.rows) > _CACHE:
            self._reset()
        if new := [w for w in dict.fromkeys(chain.from_iterable(words)) if w not in self.rows]:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            letter = np.fromiter(map(has_letter, new), bool, len(new))
            self.scores = np.concatenate([self.scores, self.model.potentials(new, letter)])
            self.letter = np.concatenate([self.letter, letter])
        sizes = np.array([len(ws) for ws in words], np.int64)
        at = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        letter = self.letter[at]
        heard = np.bincount(np.repeat(np.arange(len(texts)), sizes), letter, len(texts))
        return label_sums(self.scores[at], letter, sizes, self.model.transitions), heard


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < _BLOCK:
            size += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for every row.

    The score is the share of words with a letter that are expected to have the label. A text that is null or
    has no letter is ``und`` with 0, as is every text if there was nothing to learn from; equal shares go to the
    label that sorts first. Rows without an id are held out. Only the text is read for a prediction.
    """
    state: dict[str, Labeller] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labeller = state.setdefault("it", Labeller(model))
        texts, pred, score = batch.column(2).to_pylist(), [], []
        for a, b in _blocks(texts):
            sums, heard = labeller.shares(texts[a:b])
            for row, n in zip(sums, heard, strict=True):
                k = int(row.argmax()) if len(row) and n else -1
                pred.append(UNDETERMINED if k < 0 else model.labels[k])
                score.append(0.0 if k < 0 else min(1.0, float(row[k] / n)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = need(docs, "doc_id", "text")
    _, held_out = _training(need(docs, "doc_id", "text", "lang"))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    if not model.labels:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Fits on the training rows of the documents and predicts all of them."""
    return predict(docs, fit(sampled(docs)))
