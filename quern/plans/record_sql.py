"""The record view of ``quern.sources.records`` in SQL, as common table expressions: one row per record
(``rec``), one per filled or empty field (``fld``), one per field with evidence (``prv``)."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-30 12:00:00'"


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


_BRANCHES = {
    "STARTUP": ("supplier", "s_suppkey", {"entityName": "s_name", "rawEntityName": "CASE WHEN s_suppkey % 13 <> 0 THEN s_name || ', Inc.' END", "description": "''"}),
    "PRODUCT": ("part", "p_partkey", {
        "productName": "CASE WHEN p_partkey % 29 = 0 THEN p_brand ELSE p_name END", "startupName": "p_brand", "rawStartupName": "p_brand",
        "pricingModel": "CASE p_partkey % 7 WHEN 0 THEN 'FREE' WHEN 1 THEN 'PAID' WHEN 2 THEN 'BARTER' END", "description": "p_type"}),
    "RESEARCH_PAPER": ("documents", "doc_id", {
        "title": "split_part(coalesce(text, ''), chr(10), 1)", "authors": "source", "paper_url": "'https://example.org/p/' || doc_id", "published_date": "'2024-01-01'",
        "github_url": "CASE WHEN doc_id % 3 <> 0 THEN 'https://github.com/o' || (doc_id % 50) || '/r' || doc_id END", "github_stars": "CAST(n_chars AS VARCHAR)",
        "github_stars_source": "CASE WHEN doc_id % 5 = 0 THEN 'cache' ELSE 'github_graphql' END",
        "github_stars_collected_at": "CASE WHEN doc_id % 7 = 0 THEN 'unknown' WHEN doc_id % 11 = 0 THEN '2024-01-01 00:00:00' ELSE '2024-01-30 06:00:00' END", "abstract": "text"}),
    "JOB": ("orders", "o_orderkey", {
        "company": "'c' || (o_custkey % 100)", "rawCompany": "'C' || (o_custkey % 100)", "title": "o_orderpriority",
        "date": f"CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN '2024-01-30 02:00:00' ELSE {_stamp('o_orderdate')} END",
        "is_remote": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END", "role_family": "'Other'", "full_text": "o_orderstatus"}),
    "NEWS": ("pages JOIN events ON page_id = event_id", "page_id", {"title": "'story ' || event_type", "publisher": "'example'", "published_at": _stamp("ts"), "full_text": "html"}),
}


def _rec(kind: str) -> str:
    source, n, _ = _BRANCHES[kind]
    low = kind.lower()
    return f"""SELECT '{kind}' AS record_type, CAST({n} AS BIGINT) AS rid, '{low}:' || ({n} - CASE WHEN {n} % 97 = 0 THEN 1 ELSE 0 END) AS record_key,
        CASE WHEN {n} % 41 = 0 THEN 'ftp://example.org/' || {n} ELSE 'https://example.org/{low}/' || {n} END AS source_url FROM {source}"""


def _fld(kind: str) -> str:
    source, n, values = _BRANCHES[kind]
    return "\nUNION ALL\n".join(f"SELECT '{kind}' AS record_type, CAST({n} AS BIGINT) AS rid, '{f}' AS field, {v} AS value, ({n} % 23 <> 0 OR {k} > 0) AS proven FROM {source}" for k, (f, v) in enumerate(values.items()))


REC = "rec AS (" + "\nUNION ALL\n".join(map(_rec, _BRANCHES)) + ")"
FLD = "fld AS (" + "\nUNION ALL\n".join(map(_fld, _BRANCHES)) + ")"
FILLED = "value IS NOT NULL AND value NOT IN ('', '[]', '{}')"
