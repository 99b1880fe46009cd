"""Links right at the threshold, and the verdict of the rules, against plain Python."""

import random
from collections import Counter

import numpy as np

import corpus_pipeline
from quern.llm import line_dedup, near_dedup, quality_classifier, quality_rules
from quern.llm.common import exact_quantiles


def words(rnd, n):
    return [f"w{rnd.randrange(10**9)}" for _ in range(n)]


def test_near_pairs_at_the_threshold(spark):
    """187 words, five changed far apart: 170 of 200 shingles in common, just 0.85; of 186 words 169 of 199, just less."""
    rnd = random.Random(13)
    rows, same, apart = [], [], []
    for k in range(500):
        base = words(rnd, 187 if k < 400 else 186)
        other = list(base)
        for at in (10, 45, 80, 115, 150):
            other[at] = "changed" + base[at]
        sets = [set(zip(x, x[1:], x[2:], strict=False)) for x in (base, other)]
        common, union = len(sets[0] & sets[1]), len(sets[0] | sets[1])
        (same if 100 * common >= 85 * union else apart).append(2 * k)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    assert len(same) == 400 and len(apart) == 100
    got = {r.doc_id: r for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=85).collect()}
    assert all(got[k + 1].component_id == k + 1 and got[k + 1].kept for k in apart)
    assert all(got[k].kept for k in same + apart)
    found = sum(got[k + 1].component_id == k for k in same)
    assert found >= 398


def line_pair(rnd, n):
    """A line of n characters and the most changed one at the threshold or over: cut, extended or altered at an end."""
    line = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n - 2))
    line = f"x{line}y"
    changed = [line[:-k] for k in range(1, n)] + [line + "0123456789"[:k] for k in range(1, 10)] + [line[:-k] + "0" * k for k in range(1, n)] + [line[:k] + "#" + line[k + 1 :] for k in range(n)]
    sets = [{x[i : i + 8] for i in range(max(len(x) - 7, 1))} for x in [line, *changed]]
    near = [(len(sets[0] & s) / len(sets[0] | s), x) for s, x in zip(sets[1:], changed, strict=True) if 5 * len(sets[0] & s) >= 4 * len(sets[0] | s)]
    least = min(j for j, _ in near)
    return line, rnd.choice([x for j, x in near if j == least])


def test_line_pairs_at_the_threshold(spark):
    """The least alike pairs that still link, by length of the lines: all short ones are found, and nearly all long ones."""
    rnd, rows = random.Random(23), []
    for n in (12, 13, 14, 16, 20, 40, 48, 60, 100):
        for _ in range(300):
            a, b = line_pair(rnd, n)
            rows += [(len(rows), a, n), (len(rows) + 1, b, n)]
    got = {r.doc_id: r.n_removed for r in line_dedup.line_digests(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    found = Counter(n for i, _, n in rows if i % 2 and got[i])
    assert not any(got[i] for i, _, _ in rows if i % 2 == 0)
    assert all(found[n] == 300 for n in (12, 13, 14, 16, 20, 40))
    assert all(found[n] >= 297 for n in (48, 60, 100)), found


def plain_buckets(text):
    raw = (" " + " ".join(text.lower().split()) + " ").encode()
    out = []
    for i in range(len(raw) - quality_rules.N_GRAM + 1):
        h = 0
        for b in raw[i : i + quality_rules.N_GRAM]:
            h = (h * 0x01000193 + b) & 0xFFFFFFFF
        h ^= h >> 15
        out.append((h * 0x85EBCA6B & 0xFFFFFFFF) >> 15)
    return out


def test_rules_verdict(spark):
    rnd = random.Random(17)
    texts = [" ".join("".join(rnd.choice(["ba", "na", "so", "li", "te"]) for _ in range(3)) for _ in range(60)) for _ in range(80)]
    texts += [" ".join("".join(rnd.choice("qxzjkvw") for _ in range(6)) for _ in range(60)) for _ in range(20)]
    texts += ["too short", "again and " * 60, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(i, 0, 1) for i in range(80, 90)], "doc_id long, quality int, toxic int")
    fit, held = quality_rules.trusted_ids(labels)
    assert sorted([*fit, *held]) == list(range(60)) and len(fit) and len(held)

    raw, target = Counter(), Counter()
    for i, t in enumerate(texts):
        raw.update(plain_buckets(t) if t else [])
        if i in set(fit.tolist()):
            target.update(plain_buckets(t))
    s, n = quality_rules.SMOOTHING, quality_rules.BUCKETS
    n_raw, n_target = sum(raw.values()) + s * n, sum(target.values()) + s * n

    def score(t):
        found = plain_buckets(t) if t else []
        return sum(np.log((target[b] + s) / n_target) - np.log((raw[b] + s) / n_raw) for b in found) / len(found) if found else 0.0

    threshold = float(np.quantile([score(texts[i]) for i in held], quality_rules.TRUSTED_SHARE_LOST, method="lower"))
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs, labels).collect()}
    for i, t in enumerate(texts):
        assert np.isclose(got[i].score, score(t)) and np.isclose(got[i].threshold, threshold)
        failed = i >= 100
        assert got[i].base_failed == failed
        if abs(score(t) - threshold) > 1e-9:
            assert got[i].kept == (not failed and score(t) > threshold)
    assert not any(got[i].kept for i in range(80, 100))
    assert sum(got[i].kept for i in range(80)) >= 70


def test_all_trusted_documents_count(spark):
    """More trusted documents than any sample of 20,000: every one is in a half, and in what the half is for."""
    n = 20_500
    docs = spark.range(n).selectExpr("id AS doc_id", "'ab cd' AS text", "'en' AS lang")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    fit, held = quality_rules.trusted_ids(labels)
    assert len(fit) + len(held) == n and not set(fit.tolist()) & set(held.tolist())
    fitted, held_out = quality_rules.halves(labels)
    raw, target = quality_rules.bucket_counts(docs, fitted)
    assert raw.sum() == 3 * n and target.sum() == 3 * len(fit)
    assert quality_classifier.training_counts(docs, fitted).agg({"n": "sum"}).first()[0] == 5 * len(fit)
    scores = docs.selectExpr("doc_id", "lang", "1D AS byte_perplexity", "doc_id * 1.5D AS perplexity", "doc_id / 7D AS score", "60L AS n_words", "0L AS n_repeat_words")
    by_lang, overall = quality_classifier.language_thresholds(scores, held_out)
    want = float(np.quantile(held * 1.5, quality_classifier.QUANTILE, method="higher"))
    assert (by_lang, overall) == ({"en": want}, want)
    assert quality_rules.threshold_of(scores, held_out) == float(np.quantile(held / 7.0, quality_rules.TRUSTED_SHARE_LOST, method="lower"))


def test_exact_quantiles(spark):
    rnd = random.Random(23)
    groups = {"a": [rnd.gauss(0, 1) for _ in range(3000)], "b": [5.0] * 40 + [1.0], None: [rnd.choice([1e-9, 2e-9, 3.0, 1e9]) for _ in range(500)], "": [7.0]}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "grp string, value double")
    for share, up, method in ((0.01, False, "lower"), (0.5, True, "higher"), (0.99, True, "higher")):
        want = {g: (len(vs), float(np.quantile(vs, share, method=method))) for g, vs in groups.items()}
        assert exact_quantiles(rows, share, up) == want
    assert exact_quantiles(rows.limit(0), 0.5, True) == {}


def test_pipeline_fits_on_all_trusted_in_small_batches(spark, tmp_path, monkeypatch):
    """The quality stage's model has every trusted document of its half; a stage's settings end with it."""
    n, seen, counts = 20_500, [], quality_classifier.training_counts
    docs = spark.range(n).selectExpr("id AS doc_id", "'ab cd' AS text", "'en' AS lang")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    def noted(docs, fit):
        seen.append((fit.count(), {k: spark.conf.get(k, None) for k in corpus_pipeline.SETTINGS}))
        return counts(docs, fit)

    monkeypatch.setattr(quality_classifier, "training_counts", noted)
    before = {k: spark.conf.get(k, None) for k in corpus_pipeline.SETTINGS}
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == n
    assert seen == [(len(quality_rules.trusted_ids(labels)[0]), corpus_pipeline.SETTINGS)]
    assert {k: spark.conf.get(k, None) for k in corpus_pipeline.SETTINGS} == before
