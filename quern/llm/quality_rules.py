"""Quality rules: counted features, then a hashed n-gram log-likelihood ratio.

The ratio sets a trusted-target multinomial against that of the raw corpus, over hashed byte n-grams of
the lower-cased words, and divides by the number of n-grams. The target's counts come from one half of
all trusted documents; the threshold is a low quantile of all the other half's scores, so every document
meets the same fixed number. The raw counts cover every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import exact_quantiles, light, map_batches, mixed, need, word_hashes, written

#: Length of the byte n-grams, and the number of buckets that they are hashed into.
N_GRAM, BUCKETS = 5, 1 << 17
#: Smoothing added to every bucket of both multinomials.
SMOOTHING = 0.1
#: Share of trusted documents that score below the threshold.
TRUSTED_SHARE_LOST = 0.01

_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"


def trusted(labels: DataFrame) -> DataFrame:
    """doc_id, held: every id labelled of high quality and not toxic, and which half it is in.

    The halves differ in the last bit of the id's hash, so they don't depend on the rows' order. An id
    with any label against it is left out.
    """
    per_doc = need(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return per_doc.where("q = 1 and t = 0").select("doc_id", (F.xxhash64("doc_id", F.lit(5)).bitwiseAND(F.lit(1).cast("long")) == 1).alias("held"))


def halves(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id of the half to fit on, and of the half held out."""
    ids = written(trusted(labels), "trusted")
    return ids.where("not held").select("doc_id"), ids.where("held").select("doc_id")


def trusted_ids(labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Both halves as sorted arrays, to look at small tables; the operators leave them in Spark."""
    rows = trusted(labels).collect()
    return tuple(np.array(sorted(r.doc_id for r in rows if r.held == held), np.int64) for held in (False, True))


def buckets_of(text: str | None) -> np.ndarray:
    """Buckets of the byte n-grams of the lower-cased words, one space before, between and after."""
    if not text:
        return np.zeros(0, np.int64)
    a = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    n = len(a) - N_GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint32)
    for i in range(N_GRAM):
        h = h * np.uint32(0x01000193) + a[i : i + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return (h >> np.uint32(32 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def bucket_counts(docs: DataFrame, fit: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every bucket in all documents and in those of ``fit`` (doc_id); BUCKETS rows in the end."""
    marked = need(docs, "doc_id", "text").join(light(fit.select("doc_id", F.lit(True).alias("good"))), "doc_id", "left")

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                c = buckets_of(text.as_py())
                np.add.at(raw, c, 1)
                if good:
                    np.add.at(target, c, 1)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(raw[some]), pa.array(target[some])], ["bucket", "n_raw", "n_target"])

    counts = marked.select("text", "good").mapInArrow(run, "bucket long, n_raw long, n_target long").groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"].to_numpy(np.int64)] = counts["n_raw"]
    target[counts["bucket"].to_numpy(np.int64)] = counts["n_target"]
    return raw, target


def weights_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of the two smoothed multinomials."""
    p = (target + SMOOTHING) / (target.sum() + SMOOTHING * len(target))
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * len(raw))
    return np.log(p) - np.log(q)


def ratio(text: str | None, weights: np.ndarray) -> float:
    """Mean weight of the text's n-grams; 0 where it has none."""
    c = buckets_of(text)
    return float(weights[c].mean()) if len(c) else 0.0


def features(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    tokens = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    repeated = 0
    if len(tokens) >= 3:
        h = word_hashes(tokens)
        w = mixed(mixed(mixed(h[:-2]) + h[1:-1]) + h[2:])
        order = np.argsort(w, kind="stable")
        same = w[order][1:] == w[order][:-1]
        if same.any():
            twice = np.zeros(len(w), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            cover = np.zeros(len(h), bool)
            for i in range(3):
                cover[i : i + len(w)] |= twice
            repeated = int(cover.sum())
    return len(tokens), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, the features, score: one pass with a fixed-size table of weights."""
    table = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS doubles, whatever the input

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        rows = np.array([features(t) for t in texts], np.int64)
        score = [ratio(t, table.value) for t in texts]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(rows[:, i]) for i in range(5)), pa.array(score)], ["doc_id", *names, "score"])

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")


def threshold_of(scores: DataFrame, held: DataFrame) -> float:
    """A low quantile of the scores of all held-out documents (doc_id) that pass the base rules; none: -inf."""
    judged = scores.join(light(held), "doc_id", "left_semi").where(~fails_base(F.col("n_words"), F.col("n_repeat_words")))
    found = exact_quantiles(judged.select(F.lit("").alias("grp"), F.col("score").alias("value")), TRUSTED_SHARE_LOST, up=False)
    return found[""][1] if found else -np.inf


def fails_base(n_words, n_repeat_words):
    """Of numbers or columns: too few words, or over half of them in repeated windows."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: features, score, threshold, base_failed, kept.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. Without
    labels the ratio's threshold is minus infinity: the base rules decide alone. No shuffle of texts.
    """
    fit, held = halves(labels)
    scores = written(scored(docs, weights_of(*bucket_counts(docs, fit))), "scores")
    out = scores.withColumn("threshold", F.lit(threshold_of(scores, held)))
    failed = fails_base(F.col("n_words"), F.col("n_repeat_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= F.col("threshold")))


