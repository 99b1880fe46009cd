"""The training-data operators against the tokenizers library, plain Python and brute force.

``DOCS`` holds the odd cases: nulls in any column, empty, blank and long texts, ties, repeated rows, and
extra columns whose names clash with the operators' own.
"""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quern.llm import ann, bpe, common, components, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, queries, substring_dedup, token_counts

SPACES = " \t\n\v\f\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, key string, starts string"
rnd = random.Random(7)


def prose(n):
    return " ".join("".join(rnd.choice(["th", "er", "on", "an", "re", "é", "ü"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


BASE, PASSAGE, LINE = prose(140), prose(70), prose(40)
WORDS = BASE.split()
TEXTS = [
    BASE, BASE, BASE.replace(WORDS[60], "changed", 1), prose(30) + " " + PASSAGE + " " + prose(20), PASSAGE + " " + prose(15), None, "", " \n\t ", "one", "one two", "a\x1cb\x0bc  d",
    f"{LINE} here\nother\n\n{LINE} here", f"{LINE} there\nnew", "x" * 5000,
    "<|endoftext|>'re they'll İΣς Ω 中文字 123² !!--", prose(3000), "the end. " * 300,
]


def rows():
    out = [(i, t, ["en", "fr", None][i % 3], "s", len(t or ""), 1, 2, "k", "z") for i, t in enumerate(TEXTS)]
    return [*out, out[0], (None, BASE, "en", "s", 3, 1, 2, "k", "z"), (None, None, None, None, None, None, None, None, None)]


def words_of(t):
    out, cur = [], ""
    for c in t or "":
        if c in SPACES:
            out.append(cur)
            cur = ""
        else:
            cur += c
    return [w for w in [*out, cur] if w]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(None, 1, 0), (15, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_bpe_round_trip(docs, empty):
    lib = Tokenizer.from_file(queries.WORD_BPE)
    got = by_id(bpe.round_trip_digests(docs, queries.WORD_BPE))
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip_digests(docs, queries.WORD_BPE).count() == len(rows())
    assert bpe.round_trip_digests(empty, queries.WORD_BPE).count() == 0
    back = by_id(bpe.decode_documents(bpe.encode_documents(docs, queries.WORD_BPE), queries.WORD_BPE))
    assert back[5].text == "" and back[8].text == "one</w>"


def test_bpe_random_words():
    lib, own = Tokenizer.from_file(queries.WORD_BPE), bpe.word_encoder(queries.WORD_BPE)
    letters = "abcdefghilmnorstuéüßñ'.,!12中 \n"
    for _ in range(400):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40)))
        assert np.frombuffer(own.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_prefix_counts(docs, empty):
    lib, own = Tokenizer.from_file(queries.BYTE_BPE), token_counts.prefix_counter(queries.BYTE_BPE)
    for t in [TEXTS[14], "they're  \n\n here'll 12 ---- é  ", "a<|endoftext|> b"]:
        want = [len(lib.encode(t[: k + 1], add_special_tokens=False).ids) for k in range(len(t))]
        assert own.totals_and_prefixes([t])[0].tolist() == want
    got = by_id(token_counts.count_tokens(docs, queries.BYTE_BPE, 512))
    for i, t in enumerate(TEXTS):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].over_limit, got[i].n_bytes) == (n, n > 512, len((t or "").encode()))
        if n > 512:
            assert len(lib.encode(t[: got[i].fit_chars], add_special_tokens=False).ids) <= 512
    assert token_counts.count_tokens(empty, queries.BYTE_BPE, 512).count() == 0
    assert token_counts.prefix_counts(docs, queries.BYTE_BPE).where("doc_id = 8").first().counts[-1] == got[8].n_tokens


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 3), (20, 21), (5, 5)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in (1, 2, 3, 6, 7, 8, 9)}, 20: 20, 21: 20}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(t, n):
    w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    comp = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((comp[a], comp[b]))
                comp = {k: x if v == y else v for k, v in comp.items()}
    return comp, sets


def test_near_duplicates(spark, docs, empty):
    texts = dict(enumerate(TEXTS))
    near = [" ".join(w if rnd.random() > p else "zz" for w in WORDS) for p in (0.005, 0.01, 0.02, 0.03, 0.04) for _ in range(12)]
    texts |= {100 + k: t for k, t in enumerate(near)}
    more = spark.createDataFrame([(i, t, *[None] * 7) for i, t in texts.items() if i >= 100], SCHEMA)
    comp, sets = brute_components(texts, 3, 85)
    got = by_id(near_dedup.near_duplicates(docs.unionByName(more), 3, 85))
    assert {i: r.component_id for i, r in got.items()} == comp
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == comp[i]) for i, r in got.items())
    assert near_dedup.near_duplicates(empty, 3, 85).count() == 0


def test_substrings(docs, empty):
    first, windows = {}, defaultdict(list)
    for i, t in enumerate(TEXTS):
        w = words_of(t)
        for k in range(len(w) - 49):
            windows[i].append(tuple(w[k : k + 50]))
            first.setdefault(windows[i][-1], i)
    got = by_id(substring_dedup.removal_digests(docs, 50))
    cut = by_id(substring_dedup.remove_repeats(docs, 50))
    for i, t in enumerate(TEXTS):
        w, gone = words_of(t), set()
        for k, x in enumerate(windows[i]):
            if first[x] < i:
                gone |= set(range(k, k + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i
        assert cut[i].text == (kept if gone else t) and cut[i].key == "k"
    assert substring_dedup.removal_digests(empty, 50).count() == 0


def test_window_of_a_text_is_one_row_however_often_it_starts(spark):
    """Texts of a short period, with words of their own between: one row of the join for each window and text, not for each start."""
    texts = [" ".join(["on"] * 60 + [f"own{i}"] + ["tick", "tock"] * 100 + [f"end{i}"] + ["tick", "tock"] * 40) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with common.recorded() as tables:
        starts = {r.doc_id: r.starts for r in substring_dedup.repeated_starts(docs, 50).collect()}
    (windows,) = (t for t in tables if "/windows-" in t._written_to)
    assert windows.count() == windows.select("window", "doc_id").distinct().count()
    first, want = {}, {}
    for i, t in enumerate(texts):
        w = words_of(t)
        here = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        want[i] = [k for k, x in enumerate(here) if first.setdefault(x, i) < i]
    assert {i: sorted(s) for i, s in starts.items()} == {i: s for i, s in want.items() if s} and len(want[5]) == 193
    got = by_id(substring_dedup.removal_digests(docs, 50))
    assert [got[i].n_removed for i in range(6)] == [0, *[60 + 200 + 80] * 5]


def test_quality_rules(docs, labels, empty):
    got = by_id(quality_rules.apply_rules(docs, labels))
    for i, t in enumerate(TEXTS):
        w = words_of(t)
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(again), failed)
        assert tuple(got[i])[1:6] + (got[i].base_failed,) == want
        assert got[i].kept == (not failed and got[i].score >= got[i].threshold)
    assert quality_rules.apply_rules(empty, labels.limit(0)).count() == 0


def test_ratio_weights():
    raw, target = np.array([5.0, 1.0]), np.array([1.0, 1.0])
    w = quality_rules.weights_of(raw, target)
    assert math.isclose(w[0], math.log(1.1 / 2.2) - math.log(5.1 / 6.2))


def test_quality_classifier(spark, docs, labels, empty):
    model = quality_classifier.train(docs, np.arange(5))
    counts = Counter()
    for t in TEXTS[:5]:
        for c in quality_classifier.gram_codes(t).tolist():
            counts[c] += 1
    context = next(iter(counts)) >> 8
    codes = (np.int64(context) << 8) | np.arange(256, dtype=np.int64)
    total = np.exp(model.log_probs(codes)).sum()
    assert 0.98 < total <= 1.0 + 1e-5  # the 257th share is for no byte
    got = quality_classifier.classify(docs, labels)
    assert got.count() == len(rows())
    kept = {r.doc_id: r for r in got.collect()}
    assert all(r.kept == (r.perplexity <= r.threshold) for r in kept.values())
    assert kept[5].perplexity == 1.0 and kept[6].perplexity == 1.0
    assert quality_classifier.classify(empty, labels).count() == 0


def test_line_dedup(docs, empty):
    got = by_id(line_dedup.line_digests(docs))
    assert got[11].n_lines == 3 and got[11].n_removed == 1  # its own second copy
    assert got[12].n_removed == 1  # nearly the line of the document before
    assert got[1].n_removed == 1 and got[0].n_removed == 0 and got[5].n_lines == 0 and got[7].n_removed == 0
    cut = by_id(line_dedup.remove_duplicate_lines(docs))
    assert cut[12].text == "new" and cut[11].text == TEXTS[11].rsplit("\n", 1)[0] and cut[5].text is None and cut[1].text == ""
    assert line_dedup.line_digests(empty).count() == 0


def line_sets(line):
    return {line[i : i + 8] for i in range(max(1, len(line) - 7))}


def test_line_dedup_against_brute_force(spark):
    r = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    solid = ["".join(r.choice(letters) for _ in range(n)) for n in (30, 60, 90, 120, 200, 400)]
    lines = ["https://example.com/a/1", "https://example.com/zzz/999", "中文没有空格的一行" * 4 + "一", "short", "shorT", "12345678", "12345679"]
    for x in [*solid, LINE]:
        at = len(x) // 2
        lines += [x, x[:at] + "_" + x[at + 1 :], x[:at] + x[at + 1 :], x[:12] + "".join(r.choice(letters) for _ in x[12:])]
    comp = list(range(len(lines)))
    for i, x in enumerate(lines):
        for j in range(i):
            a, b = line_sets(x), line_sets(lines[j])
            if 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((comp[i], comp[j]))
                comp = [low if c == high else c for c in comp]
    got = line_dedup.line_digests(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {x.doc_id: x.n_removed for x in got} == {i: int(c != i) for i, c in enumerate(comp)}
    assert 0 < sum(x.n_removed for x in got) < len(lines) // 2


def test_sketches_let_long_lines_through(spark, tmp_path):
    g = np.random.default_rng(5)
    pairs = []
    for n in (100, 1000, 3000, 9000, 20000):
        for _ in range(8):
            x = g.integers(-(2**63), 2**63, n + n // 10).tolist()
            pairs.append((n, x[:n], x[n // 10 :]))  # Jaccard of 0.9 / 1.1, just above the threshold
    df = spark.createDataFrame(pairs, "n long, x array<long>, y array<long>").withColumn("pair", F.monotonically_increasing_id())
    df.write.parquet(path := f"{tmp_path}/pairs")
    df = spark.read.parquet(path)
    x, y = (line_dedup.odd_sketches(df.select(F.col("pair").alias("id"), F.explode(side).alias("h"))).toDF("pair", f"m{side}", f"o{side}") for side in "xy")
    both = x.join(y, "pair")
    assert both.count() == len(pairs) and both.where(~line_dedup._may_link("mx", "my", "ox", "oy")).count() == 0


def test_bitmaps_part_far_lines(spark):
    """Pairs at the threshold pass, of any length and with repeated shingles; those at 0.6, which fingerprints of MinHashes let through, don't."""
    g = np.random.default_rng(7)
    rows = []
    for n in (10, 50, 200, 400, 1000, 9000):
        for jaccard in (0.8, 0.6):
            for _ in range(40):
                d = round(n * (1 - jaccard) / (1 + jaccard))
                x = g.integers(-(2**63), 2**63, n + d).tolist()
                rows.append((n, jaccard, x[:n] + x[:3], x[d:]))
    spark.createDataFrame(rows, "n long, j double, x array<long>, y array<long>").coalesce(1).withColumn("pair", F.monotonically_increasing_id()).createOrReplaceTempView("pairs")
    df = spark.table("pairs")
    x, y = (line_dedup.bitmaps(df.select(F.col("pair").alias("id"), F.explode(side).alias("h"))).toDF("pair", f"m{side}", f"f{side}") for side in "xy")
    got = Counter((r.n, r.j) for r in df.join(x, "pair").join(y, "pair").where(line_dedup._alike("mx", "my", "fx", "fy")).select("n", "j").collect())
    assert all(got[n, 0.8] == 40 for n in (10, 50, 200, 400, 1000, 9000)), got
    assert all(got[n, 0.6] <= 4 for n in (200, 400)), got


def test_packing(docs, empty):
    lib = Tokenizer.from_file(queries.WORD_BPE)
    for capacity in (64, 2048):
        got = packing.pack_documents(docs, queries.WORD_BPE, capacity).collect()
        pieces, fill = defaultdict(list), defaultdict(list)
        for r in got:
            if r.doc_id is not None and r.doc_id != 0:
                pieces[r.doc_id].append(r)
            fill[r.sequence_id].append((r.offset, r.length))
        for i, t in enumerate(TEXTS[1:], 1):
            ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
            own = sorted(pieces[i], key=lambda r: r.piece)
            assert [r.start for r in own] == list(range(0, len(ids), capacity))
            assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[k : k + capacity].tobytes()) for k in range(0, len(ids), capacity)]
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
    assert packing.pack_documents(empty, queries.WORD_BPE, 64).count() == 0


def test_bin_bound():
    for _ in range(50):
        sizes = np.array([rnd.randint(1, 64) for _ in range(rnd.randint(1, 60))])
        bins, offsets, made = packing.best_fit(sizes, 64)
        assert packing.least_bins(sizes, 64) <= made
        assert all(sizes[bins == b].sum() <= 64 for b in range(made))
    assert packing.least_bins(np.array([40, 40, 40]), 64) == 3


def test_lm_scoring(docs, empty):
    train = Counter()
    pairs = Counter()
    texts = [(r[0], r[1]) for r in rows()]
    lowered = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(t)] + ["</s>"]
    for i, t in texts:
        if not lm_scoring.is_held_out(i):
            w = lowered(t)
            train.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v = sum(train.values()), len(train)
    cut2 = lm_scoring.discounts(*[sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    types = Counter(b for _, b in pairs)
    cut1 = lm_scoring.discounts(*[sum(c == k for c in types.values()) for k in (1, 2, 3, 4)])
    d = lambda cut, c: cut[min(c, 3) - 1] if c else 0.0
    back1 = sum(d(cut1, c) for c in types.values()) / len(pairs)
    total, after = Counter(), defaultdict(list)
    for (a, _), c in pairs.items():
        total[a] += c
        after[a].append(c)

    def p(a, b):
        low = (types[b] - d(cut1, types[b])) / len(pairs) + back1 / (v + 1)
        if not total[a]:
            return low
        c = pairs[a, b]
        return (c - d(cut2, c)) / total[a] + sum(d(cut2, x) for x in after[a]) / total[a] * low

    known = [*train, "unseen"]
    assert math.isclose(sum(p("the", b) for b in known), 1.0) and math.isclose(sum(p("nowhere", b) for b in known), 1.0)
    got = lm_scoring.train_and_score(docs)
    assert got.count() == len(texts)
    for r in got.collect():
        if r.doc_id is None:
            continue
        w = lowered(TEXTS[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in train for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        assert math.isclose(r.score, sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w[:-1]], w, strict=True)), rel_tol=1e-9)
    assert lm_scoring.train_and_score(empty).count() == 0


def test_nearest(spark):
    g = np.random.default_rng(3)
    x = g.normal(size=(1200, 20)).astype(np.float32)
    x[500:520] = x[0]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5100, [0.0] * 20), (5200, [float("nan")] * 20), (5300, [None] * 20), (5400, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<float>, class string")
    got = defaultdict(list)
    for r in ann.nearest(df, 10, 100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 1200, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(1200), d))[:10].tolist()
        hits += len({i for i, _ in got[q]} & set(best))
        assert all(s == d[i] for i, s in got[q]) and got[q] == sorted(got[q], key=lambda y: (y[1], y[0]))
    assert hits >= 0.9 * 120 and set(got) <= set(range(0, 1200, 100)) and [i for i, _ in got[0]] == list(range(500, 510))
    assert ann.nearest(df.limit(0), 10, 100).count() == 0


@pytest.mark.parametrize("scaled", [False, True])
def test_nearest_probes_follow_recall(spark, monkeypatch, scaled):
    """Many small buckets stand for a large table: the least number of probes finds too little there."""
    monkeypatch.setattr(ann, "BUCKET", 4)
    g = np.random.default_rng(8)
    x = g.normal(size=(6000, 24)).astype(np.float32)
    if scaled:
        x *= g.lognormal(sigma=1.0, size=(6000, 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in ann.nearest(df, 10, 60, tables=2, probes=4).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 6000, 60):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.9 * 1000


def test_pipeline(spark, tmp_path, docs, labels):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert 0 < fill <= corpus_pipeline.CAPACITY
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near dedup", "substring dedup", "packing"]


def test_pipeline_stages_own_their_tables(spark, tmp_path, docs, labels, empty):
    """Stages one after another without storing in between, over rows with clashing names, repeats and nulls."""
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for given in (docs, empty):
        kept = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path))
            assert kept.columns == given.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path))
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
