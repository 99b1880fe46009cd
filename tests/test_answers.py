"""What enrichment does to records: values, proof, budget, providers in turn."""

import os
import sys

import pytest
from pyspark import cloudpickle

from quern.operators import answers
from quern.operators.answers import Refused, asked, enriched

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have the tests' folder
PROOF = "array<struct<field:string,method:string,source_url:string,source_pointer:string,excerpt:string,confidence:double>>"
SCHEMA = f"id long, record_type string, source_url string, content map<string,string>, evidence {PROOF}, outcome_note string"
OLD = [("description", "api", "u", "/d", None, 1.0), ("pricingModel", "api", "u", "/p", None, 1.0)]


class Scripted:
    """Answers by document; counts its calls in files, as tasks share no memory."""

    def __init__(self, name, answers, log=None, fails=0, refuses=False):
        self.name, self.answers, self.log, self.fails, self.refuses, self.tries = name, answers, log, fails, refuses, {}

    def extract(self, document, field):
        if self.log:
            open(f"{self.log}/{self.name}-{os.getpid()}", "a").write("x")
        if self.refuses:
            raise Refused
        self.tries[document] = self.tries.get(document, 0) + 1
        if self.tries[document] <= self.fails:
            raise TimeoutError
        return next((v for k, v in self.answers.items() if k in document), (None, None))


def product(i, text, price=None, evidence=OLD, **more):
    return (i, "PRODUCT", f"https://p/{i}", {"productName": f"n{i}", "description": text, "pricingModel": price, **more}, evidence, "kept")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def calls(path):
    return sum(len(open(f"{path}/{f}").read()) for f in os.listdir(path))


def test_effect(spark):
    long = "free " + "x" * 700
    rows = [
        product(1, "Start with a free plan, then upgrade."), product(2, "has a free plan", "PAID"), product(3, "no offer"), product(4, "a paid plan"),
        product(5, "enterprise plan"), product(6, long, evidence=None), product(7, "subscription"), (8, "JOB", "https://j/8", {"title": "Data engineer", "full_text": "builds", "role_family": "Other"}, [], "kept"),
        (9, "JOB", "https://j/9", {"title": None, "full_text": None, "role_family": "Other"}, None, None), (10, "JOB", "https://j/10", {"title": "x", "role_family": "Sales"}, None, None), (11, None, None, None, None, None),
        (None, "PRODUCT", "https://p/0", {"productName": "n", "description": "free plan", "pricingModel": None}, None, None),
    ]
    found = {"Start with": ("free", " free plan "), "a paid": ("PAID", "Paid plan"), "enterprise": ("HUGE", "enterprise plan"), "xxx": ("FREE", long), "subscription": ("PAID", "  "), "Data engineer": ("Data", "Data engineer")}
    got = {r.id: r for r in enriched(table(spark, rows), ["id"], [Scripted("one", found)]).collect()}
    assert len(got) == len(rows)
    assert {i: r.outcome for i, r in got.items()} == {1: "applied", 2: "none", 3: "none", 4: "rejected", 5: "rejected", 6: "applied", 7: "rejected", 8: "applied", 9: "rejected", 10: "none", 11: "none", None: "unasked"}
    first = got[1]
    assert first.content["pricingModel"] == "FREE" and first.content["productName"] == "n1" and first.outcome_note == "kept"
    assert [tuple(e) for e in first.evidence] == [OLD[0], ("pricingModel", "llm", "https://p/1", "llm:one", "free plan", 0.85)]
    assert [len(e.excerpt) for e in got[6].evidence] == [500]
    assert got[8].content["role_family"] == "Data" and got[4].content["pricingModel"] is None and [tuple(e) for e in got[4].evidence] == OLD
    assert got[11].content is None and got[9].evidence is None


def test_providers_in_turn(spark, tmp_path):
    rows = [product(1, "free plan")]
    found = ("FREE", "free plan")
    cases = [
        ([Scripted("a", {"free": found}, fails=1)], "applied", 2, "llm:a"), ([Scripted("a", {}, fails=9), Scripted("b", {"free": found})], "applied", 3, "llm:b"),
        ([Scripted("a", {}, refuses=True), Scripted("b", {"free": found})], "applied", 2, "llm:b"), ([Scripted("a", {}, fails=9), Scripted("b", {}, refuses=True)], "failed", 3, None),
        # an empty answer is an answer: nobody else is asked
        ([Scripted("a", {}), Scripted("b", {"free": found})], "rejected", 1, None), ([], "failed", 0, None),
    ]
    for providers, outcome, attempts, pointer in cases:
        r = enriched(table(spark, rows), ["id"], providers).collect()[0]
        proof = [e.source_pointer for e in r.evidence if e.method == "llm"]
        assert (r.outcome, r.attempts, proof) == (outcome, attempts, [pointer] if pointer else [])


@pytest.mark.parametrize("budget", [0, 3, 10])
def test_budget_and_single_asking(spark, tmp_path, budget):
    rows = [product(i, "free plan") for i in (5, 3, 9, 1, 7)]
    done = enriched(table(spark, rows), ["id"], [Scripted("a", {"free": ("FREE", "free plan")}, log=str(tmp_path))], calls=budget)
    for _ in range(2):
        assert {r.id for r in done.collect() if r.outcome == "applied"} == set(sorted([5, 3, 9, 1, 7])[:budget])
    assert calls(tmp_path) == min(budget, 5)


def test_answers_by_shuffle(spark, monkeypatch):
    rows = [product(i, "free plan" if i % 2 else "a paid plan") for i in range(1, 9)]
    provider = Scripted("a", {"free": ("FREE", "free plan")})
    by_broadcast = enriched(table(spark, rows), ["id"], [provider]).orderBy("id").collect()
    monkeypatch.setattr(answers, "BROADCAST_BYTES", -1)
    assert enriched(table(spark, rows), ["id"], [provider]).orderBy("id").collect() == by_broadcast


def test_no_rows(spark):
    assert enriched(table(spark, []), ["id"], [Scripted("a", {})]).collect() == []
    none = spark.createDataFrame([], "id long, field string, document string")
    assert asked(none, ["id"], [Scripted("a", {})], 1).collect() == []
