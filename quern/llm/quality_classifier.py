"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's symbols are bytes. An n-gram of up to five bytes fits a long (byte k in bits 8k), so all
its counts are Spark tables of longs: counts, contexts and lower orders meet in joins sharded by the
n-gram's code. One half of all trusted documents is counted. The model lies in the shared folder as
files of sorted codes, dealt by range; workers map them into memory and score whole documents. A
document is kept if its perplexity isn't above a quantile of all held-out trusted documents of its own
language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import discounts, exact_quantiles, fresh_path, light, map_batches, need, written
from quern.llm.lm_scoring import _mapped, _store
from quern.llm.quality_rules import halves

#: Longest n-gram, in bytes.
ORDER = 5
#: A document's perplexity may reach this quantile of its language's held-out trusted documents.
QUANTILE = 0.99
#: Degree of the power mean over words: the higher, the more a few words unlike trusted text count.
POWER = 4
#: Languages with fewer held-out trusted documents use the quantile over all languages.
LEAST_HELD = 50
#: Bytes scored at once; four times as many are counted at once.
_BLOCK = 1 << 20
#: Entries of the model that one of its files holds on average, and the least number of files.
FILE_ROWS, FILES = 1_000_000, 8
_SPACES = np.array([0x20, *range(0x09, 0x0E)])


def gram_codes(text: str | None) -> np.ndarray:
    """One code for each byte: itself in the low bits, the four before it above; zeros before the start."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    a = np.frombuffer(b"\0" * (ORDER - 1) + raw, np.uint8).astype(np.int64)
    code = np.zeros(len(raw), np.int64)
    for i in range(ORDER):
        code = (code << 8) | a[i : i + len(raw)]
    return code


def training_counts(docs: DataFrame, fit: DataFrame) -> DataFrame:
    """gram, n of the longest n-grams in the documents of ``fit`` (doc_id), summed map-side first."""
    texts = need(docs, "doc_id", "text").join(light(fit), "doc_id", "left_semi").select("text")

    def counted(codes: list[np.ndarray]) -> pa.RecordBatch:
        gram, n = np.unique(np.concatenate([*codes, np.zeros(0, np.int64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n.astype(np.int64))], ["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                codes.append(gram_codes(text.as_py()))
                size += len(codes[-1])
                if size >= 4 * _BLOCK:
                    yield counted(codes)
                    codes, size = [], 0
        yield counted(codes)

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """For orders 1 to ORDER: (gram, p) of every seen n-gram and (ctx, back) of every seen context.

    ``p`` is the interpolated probability of the last byte after the others, ``back`` the mass that a
    context leaves to the next lower order. Lower orders count distinct left neighbours.
    """
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        low = (1 << (8 * k)) - 1
        tables[k] = tables[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit(low)).alias("gram")).agg(F.count("*").alias("n"))
    probs: list[DataFrame] = []
    backs: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        t = tables[k]
        of = t.agg(*(F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4))).first()
        d1, d2, d3 = discounts(*of)
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        t = t.withColumn("ctx", F.shiftright("gram", 8)).withColumn("cut", cut)
        ctx = t.groupBy("ctx").agg((F.sum("cut") / F.sum("n")).alias("back"), F.sum("n").alias("total"))
        joined = t.join(ctx, "ctx").withColumn("own", (F.col("n") - F.col("cut")) / F.col("total"))
        if k == 1:
            p = joined.select("gram", (F.col("own") + F.col("back") / 257).alias("p"))
        else:
            below = probs[-1].select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            joined = joined.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1)))
            p = joined.join(below, "suffix").select("gram", (F.col("own") + F.col("back") * F.col("lower")).alias("p"))
        probs.append(written(p, f"kn-p{k}"))
        backs.append(ctx.select("ctx", "back"))
    return probs, backs


class ByteModel:
    """A stored model: files (lo, n, path) of sorted codes and values, each with the codes from ``lo`` up to the next one's.

    A code has its table in bits 40 up (n-grams of order k: k - 1, contexts: ORDER more) and the n-gram
    or context below; a value is the log of its probability, or of the mass that the context leaves.
    """

    def __init__(self, files: list[tuple[int, int, str]]) -> None:
        self.files = sorted(files)
        self.lows = np.array([lo for lo, _, _ in self.files], np.int64)
        self._arrays: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _table(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self._arrays:
            _, n, path = self.files[i]
            raw = _mapped(path, n)
            self._arrays[i] = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<f4", n, 8 * n)
        return self._arrays[i]

    def _find(self, table: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is in a table, and its value there, else 0."""
        codes = keys | (table << 40)
        hit, value = np.zeros(len(codes), bool), np.zeros(len(codes), np.float32)
        which = np.searchsorted(self.lows, codes, side="right") - 1
        for i in np.unique(which[which >= 0]).tolist():
            at = np.flatnonzero(which == i)
            names, values = self._table(i)
            pos = np.minimum(np.searchsorted(names, codes[at]), len(names) - 1)
            same = names[pos] == codes[at]
            hit[at[same]] = True
            value[at[same]] = values[pos[same]]
        return hit, value

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of each byte's probability after the four before it."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))
        for k in range(ORDER, 0, -1):
            gram = codes[left] & ((1 << (8 * k)) - 1)
            hit, value = self._find(k - 1, gram)
            out[left[hit]] += value[hit]
            left, gram = left[~hit], gram[~hit]
            if not len(left):
                return out
            out[left] += self._find(ORDER + k - 1, gram >> 8)[1]
        out[left] -= np.log(257)
        return out

    def perplexities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: the perplexity per byte, and that of its hardest words, exp of the power mean of
        degree POWER over the words' surprise per byte. Both are 1 for texts without any byte.

        Equal n-grams of a block of texts are looked up once.
        """
        plain, hard = np.ones(len(texts)), np.ones(len(texts))
        at = 0
        while at < len(texts):
            codes, end, size = [], at, 0
            while end < len(texts) and size < _BLOCK:
                codes.append(gram_codes(texts[end]))
                size += len(codes[-1])
                end += 1
            flat = np.concatenate(codes)
            n = np.array([len(c) for c in codes])
            some = np.flatnonzero(n)
            if len(some):
                gram, which = np.unique(flat, return_inverse=True)
                each = -self.log_probs(gram)[which]
                ends = np.cumsum(n)[some]
                begins = ends - n[some]
                first = np.zeros(len(flat), bool)  # of a word's bytes, the space before it being its own
                first[1:] = np.isin(flat[1:] & 255, _SPACES) & ~np.isin(flat[:-1] & 255, _SPACES)
                first[begins] = True
                starts = np.flatnonzero(first)
                per_word = np.add.reduceat(each, starts) / np.diff(np.r_[starts, len(flat)])
                of = np.searchsorted(starts, begins)
                words = np.diff(np.r_[of, len(starts)])
                plain[at + some] = np.exp(np.add.reduceat(each, begins) / n[some])
                hard[at + some] = np.exp((np.add.reduceat(per_word**POWER, of) / words) ** (1 / POWER))
            at = end
        return plain, hard


def stored_model(probs: list[DataFrame], backs: list[DataFrame]) -> ByteModel:
    """Stores the tables as files of sorted codes, dealt by range; the driver gets a row for each file."""
    union = None
    for i, t in enumerate([*probs, *backs]):
        gram, value = t.columns
        rows = t.select(F.col(gram).bitwiseOR(F.lit(i << 40).cast("long")).alias("code"), F.col(value).alias("value"))
        union = rows if union is None else union.unionByName(rows)
    entries = written(union, "kn-entries")
    folder = fresh_path(entries.sparkSession, "kn-model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, values = [], []
        for batch in batches:
            codes.append(batch.column(0).to_numpy().astype("<i8"))
            values.append(np.log(batch.column(1).to_numpy()).astype("<f4"))
        code, value = np.concatenate([*codes, np.zeros(0, "<i8")]), np.concatenate([*values, np.zeros(0, "<f4")])
        if len(code):
            yield pa.RecordBatch.from_pylist([{"lo": int(code[0]), "n": len(code), "path": _store(folder, "kn", [code, value])}])

    dealt = entries.repartitionByRange(max(FILES, entries.count() // FILE_ROWS), "code").sortWithinPartitions("code")
    return ByteModel([tuple(r) for r in written(dealt.mapInArrow(run, "lo long, n long, path string"), "kn-files").collect()])


def train(docs: DataFrame, fit: DataFrame | np.ndarray) -> ByteModel:
    """The model of the documents of ``fit``: a table (doc_id), or an array of ids."""
    if not isinstance(fit, DataFrame):
        fit = docs.sparkSession.createDataFrame(pd.DataFrame({"doc_id": fit}), "doc_id long")
    return stored_model(*kneser_ney(written(training_counts(docs, fit), "kn-counts")))


_SCORED = "doc_id long, lang string, byte_perplexity double, perplexity double"
_models: dict[str, ByteModel] = {}


def _model(key: str, files: list[tuple[int, int, str]]) -> ByteModel:
    if key not in _models:
        _models.clear()  # a worker serves one model at a time
        _models[key] = ByteModel(files)
    return _models[key]


def scored(docs: DataFrame, model: ByteModel) -> DataFrame:
    """doc_id, lang, byte_perplexity, perplexity of every document."""
    key, files = uuid.uuid4().hex, model.files

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain, hard = _model(key, files).perplexities(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(plain), pa.array(hard)], ["doc_id", "lang", "byte_perplexity", "perplexity"])

    return map_batches(need(docs, "doc_id", "text", "lang"), run, _SCORED)


def language_thresholds(scores: DataFrame, held: DataFrame) -> tuple[dict[str | None, float], float]:
    """Per language and over all: the QUANTILE of the perplexities of all held-out trusted documents (doc_id)."""
    judged = written(scores.join(light(held), "doc_id", "left_semi").select(F.col("lang").alias("grp"), F.col("perplexity").alias("value")), "held")
    overall = exact_quantiles(judged.select(F.lit("").alias("grp"), "value"), QUANTILE, up=True)
    by_lang = exact_quantiles(judged, QUANTILE, up=True)
    return {lang: value for lang, (n, value) in by_lang.items() if n >= LEAST_HELD}, overall[""][1] if overall else np.inf


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, byte_perplexity, perplexity, threshold, kept: one row per document.

    Empty and null texts have perplexity 1 and are kept: there is nothing to hold against them. A null
    or rare language meets the threshold over all languages; without labels all documents are kept.
    Repeated rows are judged alike.
    """
    fit, held = halves(labels)
    scores = written(scored(docs, train(docs, fit)), "perplexity")
    by_lang, overall = language_thresholds(scores, held)
    threshold = F.lit(overall)
    for lang, value in sorted((k, v) for k, v in by_lang.items() if k is not None):
        threshold = F.when(F.col("lang") == lang, value).otherwise(threshold)
    return scores.withColumn("threshold", threshold).withColumn("kept", F.col("perplexity") <= F.col("threshold"))
