"""What a worker holds while it encodes whole texts."""

import random
import tracemalloc

import numpy as np
import public_tokenizers

from quern.llm import ann, bpe

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_encoding_splits_few_texts_at_a_time():
    rng = random.Random(3)
    known = [f"w{k}" for k in range(500)]
    texts = [" ".join(rng.choices(known, k=2000)) for _ in range(400)]
    encoder = bpe.WordEncoder(WORD_BPE)
    encoder.encode(" ".join(known))
    tracemalloc.start()
    try:
        ids = encoder.encode_all(texts)
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most - held < 25e6  # 42 MB when all texts were split at once
    assert ids == [encoder.encode(t) for t in texts]


def test_the_cache_keeps_to_its_bound():
    texts = [" ".join(f"x{k % 700}y{j}" for j in range(20)) for k in range(1000)]
    encoder, free = bpe.WordEncoder(WORD_BPE), bpe.WordEncoder(WORD_BPE)
    for at in range(0, len(texts), 10):
        some = texts[at : at + 10]
        assert encoder.encode_all(some, 600) == free.encode_all(some)
        assert len(encoder.cache) <= 600
    assert len(free.cache) == 14_000


def test_many_probes_are_not_held_at_once():
    cp = ann.CrossPolytope(64, 15_000_000)
    rng = np.random.default_rng(1)
    asked = rng.normal(size=(120, 64))
    homes = cp.buckets(asked + rng.normal(size=asked.shape), 0)
    tracemalloc.start()
    try:
        met = cp.meets(asked, 0, 16_384, homes)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 12e6  # all probes of the 120 alone are 16 MB
    assert met.tolist() == (cp.probes(asked, 0, 16_384) == homes[:, None]).any(axis=1).tolist()
    assert cp.meets(asked[:0], 0, 24, homes[:0]).tolist() == []


def test_probes_are_never_broadcast(spark):
    """The buckets' sizes travel, by a hint after a count; the queries' probes and the vectors don't, however small they look."""
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 11) - 5, 1.0, float(i)]) for i in range(300)], "vec_id long, embedding array<float>")
    found = ann.nearest(rows, k=3, query_every=50)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") == 2
    assert found.count() == 18
