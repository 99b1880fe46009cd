"""The word labeller: sums against all label sequences, held-out accuracy, switches inside a text, odd rows."""

import random
import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from quern.llm import language_id as lid
from tests.llm.test_operators import SCHEMA, rows

SYLLABLES = {"aa": ["th", "er", "ing", "and"], "bb": ["que", "ment", "é", "eau"], "cc": ["sch", "ung", "ü", "ein"]}
rnd = random.Random(5)


def prose(lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def by_all_sequences(scores, counted, moves):
    n, labels = scores.shape
    total, out = 0.0, np.zeros(labels)
    for seq in product(range(labels), repeat=n):
        w = np.exp(sum(scores[t, y] for t, y in enumerate(seq)) + sum(moves[a, b] for a, b in zip(seq, seq[1:], strict=False)))
        total += w
        for t, y in enumerate(seq):
            out[y] += w * counted[t]
    return out / total


def test_sums_are_those_over_all_sequences(monkeypatch):
    monkeypatch.setattr(lid, "_STRETCH", 3)  # so that short texts have several stretches
    g = np.random.default_rng(2)
    sizes, labels = np.array([1, 0, 7, 3, 4, 0, 6]), 3
    scores, counted, moves = g.normal(size=(sizes.sum(), labels)) * 2, g.random(sizes.sum()) < 0.7, g.normal(size=(labels, labels))
    got, at = lid.label_sums(scores, counted, sizes, moves), 0
    for row, n in zip(got, sizes, strict=True):
        want = by_all_sequences(scores[at : at + n], counted[at : at + n], moves) if n else np.zeros(labels)
        assert np.allclose(row, want)
        at += n
    p, pairs = lid.marginals(scores[:3][:, None, :], moves)
    assert np.allclose(p.sum(0)[0], by_all_sequences(scores[:3], np.ones(3), moves))
    assert np.isclose(pairs.sum(), 2)


def test_features_are_the_grams_of_each_word():
    words = [w.encode() for w in ["a", "über", "x" * 300, "don't"]]
    feats, owner = lid.gram_features(words)
    for k, w in enumerate(words):
        alone, _ = lid.gram_features([w])
        assert sorted(feats[owner == k]) == sorted(alone)
        assert len(alone) == 1 + sum(max(len(w) + 2 - n + 1, 0) for n in lid.GRAMS)


def test_held_out_accuracy_and_switches(spark):
    langs = list(SYLLABLES)
    docs = [(i, prose(langs[i % 3], rnd.randint(1, 90)), langs[i % 3]) for i in range(240)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = lid.fit(lid.sampled(df))
    assert model.labels == langs
    assert all(model.transitions[k, k] == model.transitions[k].max() for k in range(3))
    got = {r.doc_id: r for r in lid.predict(df, model).collect()}
    held = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1 for i, *_ in docs)
    assert sum(got[i].lang_pred == lang for i, _, lang in held) >= 0.97 * len(held) > 20
    sums, heard = lid.Labeller(model).shares([prose("aa", 60) + " " + prose("bb", 30) + " 12 --"])
    assert heard[0] == 90
    assert abs(sums[0][0] - 60) < 3 and abs(sums[0][1] - 30) < 3


def test_only_text_and_training_labels_count(spark):
    docs = [(i, prose(["aa", "bb"][i % 2], 20), ["aa", "bb"][i % 2], "s") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = df.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("t"))
    assert lid.identify(df).orderBy("doc_id").collect() == lid.identify(other).orderBy("doc_id").collect()


def test_odd_rows(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = lid.identify(df).collect()
    assert len(got) == len(rows())
    for r in got:
        text = next(t for i, t, *_ in rows() if i == r.doc_id)
        assert r.doc_id is None or (r.lang_pred == "und" and r.score == 0) == (not any(c.isalpha() for c in text or ""))
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert lid.identify(df.where("doc_id > 999")).count() == 0
    nothing = lid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    one = lid.identify(df.where("doc_id < 5").withColumn("lang", F.lit("en"))).collect()
    assert {(r.lang_pred, round(r.score, 9)) for r in one} <= {("en", 1.0), ("und", 0.0)}
