"""Models and packings against plain Python that counts one n-gram, pair or piece at a time."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from quern.llm import packing, quality_classifier

SPACE = rb"\x20\x09-\x0d"


class PlainKneserNey:
    """Interpolated modified Kneser-Ney over bytes, by definition and recursion."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter()
        for t in texts:
            raw = b"\0" * (order - 1) + t.encode()
            top.update(raw[i : i + order] for i in range(len(raw) - order + 1))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.cuts, self.after = {}, {}
        for k, counts in self.counts.items():
            seen = Counter(counts.values())
            y = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] else 0.0
            cuts = []
            for i, instead in ((1, 0.5), (2, 1.0), (3, 1.5)):
                d = i - (i + 1) * y * seen[i + 1] / seen[i] if seen[i] else -1.0
                cuts.append(d if 0 < d < i else instead)
            self.cuts[k] = cuts
            self.after[k] = defaultdict(list)
            for g, n in counts.items():
                self.after[k][g[:-1]].append(n)

    def cut(self, k, n):
        return self.cuts[k][min(n, 3) - 1]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / 257
        counts = self.after[k].get(gram[:-1])
        if not counts:
            return self.p(gram[1:])
        n = self.counts[k][gram]
        own = n - self.cut(k, n) if n else 0.0
        return (own + sum(self.cut(k, c) for c in counts) * self.p(gram[1:])) / sum(counts)

    def surprises(self, text):
        raw = b"\0" * (self.order - 1) + text.encode()
        return [-math.log(self.p(raw[i : i + self.order])) for i in range(len(raw) - self.order + 1)]


def test_classifier_model_against_recursion(spark):
    rnd = random.Random(3)
    syllables = ["ba", "na", "so", "li", "te", "ü", " ", " ", "\n"]
    trusted = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(5, 120))) for _ in range(10)]
    others = ["banana soli te", "zzz qqq", "", "  lead and trail  ", "a", "ünter", trusted[0][:30] + " ~~~ " + trusted[1]]
    docs = spark.createDataFrame(list(enumerate(trusted + others)), "doc_id long, text string")
    model = quality_classifier.train(docs, np.arange(len(trusted)))
    plain, hard = model.perplexities(trusted + others)
    own = PlainKneserNey(trusted, quality_classifier.ORDER)
    for k, t in enumerate(trusted + others):
        s = own.surprises(t)
        if not s:
            assert plain[k] == hard[k] == 1
            continue
        assert math.isclose(plain[k], math.exp(sum(s) / len(s)), rel_tol=1e-4)
        at, means = 0, []
        for word in re.findall(rb"[%b]+[^%b]*|[^%b]+" % (SPACE, SPACE, SPACE), t.encode()):
            means.append(sum(s[at : at + len(word)]) / len(word))
            at += len(word)
        assert at == len(s)
        mean = (sum(m**quality_classifier.POWER for m in means) / len(means)) ** (1 / quality_classifier.POWER)
        assert math.isclose(hard[k], math.exp(mean), rel_tol=1e-4)


def test_model_sums_to_one(spark):
    """After any context the probabilities of all 257 symbols (one stands for none of the bytes) add up to one."""
    docs = spark.createDataFrame([(0, "banana band"), (1, "a bandana")], "doc_id long, text string")
    model = quality_classifier.train(docs, np.arange(2))
    for context in (b"bana", b"anda", b"zzzz", b"\0\0\0\0"):
        codes = np.array([int.from_bytes(context + bytes([c]), "big") for c in range(256)], np.int64)
        total = np.exp(model.log_probs(codes)).sum()
        assert 0.9 < total <= 1 + 1e-5


def test_repacking_exchanges_pieces(spark, monkeypatch):
    """Many partitions: pieces of those with a gap are dealt anew; nothing is lost, no sequence overflows."""
    rnd, capacity, calls = random.Random(11), 1000, []
    sizes = [rnd.choice([rnd.randint(1, 60), rnd.randint(300, 420), rnd.randint(480, 700)]) for _ in range(12_000)]
    packed = packing._packed
    monkeypatch.setattr(packing, "PARTITION_PIECES", 300)
    monkeypatch.setattr(packing, "_packed", lambda dealt, c: calls.append(1) or packed(dealt, c))
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "uid long, length long"), capacity).collect()
    assert len(calls) > 1
    assert sorted(r.uid for r in rows) == list(range(len(sizes)))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, sizes[r.uid]))
    for pieces in bins.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= capacity
    bound = packing.least_bins(np.array(sizes), capacity)
    assert bound <= len(bins) <= bound * 1.03


def test_bound_holds_against_search():
    """No packing of few pieces, by trying all, needs fewer bins than the bound says."""
    rnd = random.Random(5)

    def fewest(sizes, capacity):
        best = len(sizes)

        def place(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(sizes):
                best = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + sizes[k] <= capacity:
                    bins[i] += sizes[k]
                    place(k + 1, bins)
                    bins[i] -= sizes[k]
            place(k + 1, [*bins, sizes[k]])

        place(0, [])
        return best

    for _ in range(60):
        sizes = [rnd.randint(1, 20) for _ in range(rnd.randint(1, 7))]
        least = packing.least_bins(np.array(sizes), 20)
        assert least <= fewest(sizes, 20) <= packing.best_fit(np.array(sizes), 20)[2]
