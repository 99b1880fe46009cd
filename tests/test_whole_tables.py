"""Queries without SQL go over whole tables."""

from quern.plans import tables
from quern.sources.records import table

SF = "/root/testdata/sf0.001"


def test_apply_canonical_takes_all_customers(spark):
    got = tables.apply_canonical(spark, SF).collect()
    assert sorted(r.c_custkey for r in got) == sorted(r.c_custkey for r in table(spark, SF, "customer").collect())
    assert {r.entity for r in got if r.raw.startswith("Zz")} == {r.raw for r in got if r.raw.startswith("Zz")}


def test_news_takes_all_pages(spark):
    got = {r.page_id for r in tables.news_join_article(spark, SF).collect()}
    assert got == {r.page_id for r in table(spark, SF, "pages").collect()}
