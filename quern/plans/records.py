"""Queries over the record view: gate, report, contract, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import evidence, quality
from quern.operators.answers import Refused, enriched
from quern.operators.dedupe import latest_wins
from quern.operators.enrich import document_of, needs_pricing, with_evidence, within_budget
from quern.plans.record_sql import FILLED, FLD, NOW, REC
from quern.sinks import export, tabs
from quern.sinks.documents import hydrated_records, public_document, public_documents
from quern.sources.records import now, record_view

REQUIRED = ", ".join(f"('{k}', '{f}')" for k, fields in evidence.REQUIRED_FIELDS.items() for f in fields)
CHECKS = f"""
{REC}, {FLD}, req(record_type, field) AS (VALUES {REQUIRED}),
per AS (SELECT record_type, rid, count(*) FILTER ({FILLED}) AS filled, count(*) FILTER ({FILLED} AND NOT proven) AS unproven,
    max(value) FILTER (field IN ('date', 'published_at')) AS date, max(value) FILTER (field = 'github_stars_collected_at') AS measured,
    max(value) FILTER (field = 'github_stars_source') AS star_source, max(value) FILTER (field = 'pricingModel') AS pricing,
    max(value) FILTER (field = 'productName') AS product, max(value) FILTER (field = 'startupName') AS startup,
    string_agg(field, ',' ORDER BY field) FILTER ({FILLED}) AS names, bool_or(proven) AS has_proof,
    string_agg(field, ',' ORDER BY field) FILTER ({FILLED} AND NOT proven) AS bad
  FROM fld GROUP BY ALL),
miss AS (SELECT record_type, rid, count(*) AS missing, string_agg(field, ',' ORDER BY field) AS absent FROM fld SEMI JOIN req USING (record_type, field)
  WHERE NOT ({FILLED}) OR value IS NULL GROUP BY ALL),
flags AS (SELECT rec.*, per.* EXCLUDE (record_type, rid), coalesce(miss.missing, 0) AS missing, source_url LIKE 'http%' AS web,
    CAST(rid % 11 = 0 AS INT) + CAST(rid % 13 = 0 OR rid % 29 = 0 AS INT) + CAST(rid % 17 = 0 AND has_proof AS INT) AS rec_b,
    rec.record_type IN ('JOB', 'NEWS') AS signal, try_cast(date AS TIMESTAMP) AS dated, try_cast(measured AS TIMESTAMP) AS starred
  FROM rec JOIN per USING (record_type, rid) LEFT JOIN miss USING (record_type, rid))
"""
OUTSIDE = "NOT ({0} BETWEEN " + NOW + " - INTERVAL 24 HOUR AND " + NOW + " + INTERVAL 5 MINUTE)"
COUNTS = {
    "invalid_source_url": "NOT web",
    "missing_required_fields": "missing > 0",
    "fields_without_evidence": "unproven > 0",
    "schema_contract_mismatch": "CAST(rec_b AS BOOLEAN)",
    "record_type_mismatch": "rid % 19 = 0",
    "outside_24h_window": "signal AND " + OUTSIDE.format("dated"),
    "invalid_freshness_date": "signal AND dated IS NULL",
    "product_company_name_collision": "record_type = 'PRODUCT' AND lower(trim(product)) = lower(trim(startup))",
    "invalid_pricing_model": "record_type = 'PRODUCT' AND pricing NOT IN ('FREE', 'FREEMIUM', 'PAID', 'ENTERPRISE')",
    "github_stars_not_direct": "record_type = 'RESEARCH_PAPER' AND star_source <> 'github_graphql'",
    "github_stars_stale": "record_type = 'RESEARCH_PAPER' AND " + OUTSIDE.format("starred"),
    "github_stars_timestamp_invalid": "record_type = 'RESEARCH_PAPER' AND starred IS NULL",
}
REPORT = f"""
{CHECKS}, rep AS (SELECT record_type, count(*) AS total, count(DISTINCT record_key) AS unique_keys, count(DISTINCT CASE WHEN web THEN source_url END) AS unique_source_urls,
  count(*) FILTER (web) AS valid_source_urls, count(*) FILTER (unproven = 0) AS evidence_complete,
  {", ".join("CAST(sum(rec_b) AS BIGINT) AS " + k if k == "schema_contract_mismatch" else f"count(*) FILTER ({v}) AS {k}" for k, v in COUNTS.items())}
FROM flags GROUP BY record_type)
"""


def _stored(view: DataFrame) -> DataFrame:
    """With ``document``: the stored record, some without a part that the contract asks for, or under another type's name."""
    rid, at = F.col("rid"), F.lit("2024-01-30T12:00:00Z")
    source = F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url"), at.alias("retrievedAt"), F.when(rid % 13 != 0, F.sha2("source_url", 256)).alias("contentHash"))
    proofs = F.transform("evidence", lambda e: F.struct(e["field"].alias("field"), e["method"].alias("method"), e["source_url"].alias("sourceUrl"), F.when(rid % 17 != 0, e["source_pointer"]).alias("sourcePointer"), e["confidence"].alias("confidence")))
    kind = F.when(rid % 19 != 0, F.col("record_type")).otherwise("OTHER")
    parts = [F.lit("1.1").alias("schemaVersion"), F.col("record_key").alias("recordKey"), kind.alias("recordType"), F.when(rid % 11 != 0, at).alias("collectedAt"), F.when(rid % 29 != 0, source).alias("source"), proofs.alias("evidence")]
    return view.withColumn("document", F.to_json(F.struct(*parts)))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_stored(record_view(spark, sf_dir)), now())


def quality_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = quality_report(spark, sf_dir)
    codes = [*COUNTS, "duplicate_keys"]
    return reports.unpivot("record_type", codes, "code", "n").where("n > 0")


def submission_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failures(quality_report(spark, sf_dir))


def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = evidence.gate(record_view(spark, sf_dir), exempt=("github_url", "github_stars"))
    return gated.select("record_type", "rid", F.array_join(F.array_sort("unproven"), ",").alias("unproven"), "accepted")


def populated_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_view(spark, sf_dir).select("record_type", "rid", F.array_join(evidence.populated_fields(F.col("content")), ",").alias("names"))


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = evidence.missing_fields(F.col("record_type"), F.col("content"))
    rows = record_view(spark, sf_dir).select("record_type", "rid", F.array_join(F.array_sort(missing), ",").alias("absent"))
    return rows.where("absent != ''")


def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = record_view(spark, sf_dir)
    docs = export.public(view.withColumn("evidence", F.when(F.col("rid") % 17 != 0, F.col("evidence"))))
    keys = F.json_object_keys("document")
    whole = F.size(F.array_except(F.array(*map(F.lit, ["schemaVersion", "recordKey", "recordType", "source", "content", "evidence"])), keys)) == 0
    return docs.groupBy(F.substring_index("record_key", ":", 1).alias("kind")).agg(F.count("*").alias("n"), F.count_if(whole).alias("whole"))


def payload_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored(record_view(spark, sf_dir))
    checked = rows.select("record_type", quality.contract_breaks(F.col("document")).alias("breaks"), quality.type_mismatch(F.col("document"), F.col("record_type")).alias("other"))
    return checked.groupBy("record_type").agg(F.sum("breaks").alias("schema_contract_mismatch"), F.max("breaks").alias("most"), F.count_if("other").alias("record_type_mismatch"))


def domain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = record_view(spark, sf_dir).where("record_type = 'PRODUCT'")
    view = view.withColumn("evidence", F.transform("evidence", lambda e: e.withField("confidence", F.when(F.col("rid") % 13 == 0, 1.5).when(F.col("rid") % 13 == 1, -0.5).otherwise(e["confidence"]))))
    model = F.col("content")["pricingModel"]
    bad_confidence = F.exists("evidence", lambda e: ~e["confidence"].between(0.0, 1.0))
    return view.select("rid", F.coalesce(model, F.lit("none")).alias("pricing"), (model.isNull() | model.isin(quality.PRICING)).alias("fits"), bad_confidence.alias("bad_confidence"))


def evidence_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = F.array(F.struct(F.lit("github_stars").alias("field"), F.lit("llm").alias("method"), F.lit("https://api.example.org").alias("source_url"), F.lit("/stars").alias("source_pointer"), F.lit(0.85).alias("confidence")))
    view = record_view(spark, sf_dir).where("record_type = 'RESEARCH_PAPER'")
    out = view.select("rid", evidence.replaced(F.col("evidence"), ["github_stars"], fresh).alias("e"))
    return out.select("rid", F.size("e").alias("n"), F.element_at("e", -1)["method"].alias("last_method"), F.size(F.filter("e", lambda x: x["field"] == "github_stars")).alias("stars"))


def count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_view(spark, sf_dir).groupBy("record_type").agg(F.count("*").alias("n"))


def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.manifest(record_view(spark, sf_dir))


def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    proven = F.size(evidence.unproven_fields(F.col("content"), F.col("evidence"))) == 0
    rows = record_view(spark, sf_dir).select("record_type", F.when(F.startswith("source_url", F.lit("http")), "web").otherwise("other").alias("kind"), proven.alias("proven"))
    out = rows.rollup("record_type", "kind").agg(F.count("*").alias("n"), F.count_if("proven").alias("proven"))
    return out.select(F.coalesce("record_type", F.lit("all")).alias("record_type"), F.coalesce("kind", F.lit("all")).alias("kind"), "n", "proven")


def public_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = export.public(record_view(spark, sf_dir))
    return docs.select("record_key", F.get_json_object("document", "$.recordType").alias("record_type"), F.get_json_object("document", "$.source.url").alias("url"), F.get_json_object("document", "$.schemaVersion").alias("version"))


def hydrate_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = record_view(spark, sf_dir)
    source = F.struct(F.col("source_url").alias("url"))
    camel = F.to_json(F.struct(F.lit("1.1").alias("schemaVersion"), F.col("record_key").alias("recordKey"), F.col("record_type").alias("recordType"), source.alias("source")))
    snake = F.to_json(F.struct(F.col("record_key"), F.col("record_type"), source.alias("source")))
    return export.hydrated(view.select(F.when(F.col("rid") % 2 == 0, camel).otherwise(snake).alias("document")))


def _legacy(view: DataFrame) -> DataFrame:
    """rid, document: whole records as JSON, every other one in the older snake case, some broken."""
    rid, at, half = F.col("rid"), F.lit("2024-01-30T12:00:00+00:00"), F.col("rid") % 2 == 0
    sure = F.when(rid % 13 != 0, 0.5)
    camel = F.to_json(F.struct(
        F.lit("1.1").alias("schemaVersion"), F.col("record_key").alias("recordKey"), F.when(rid % 37 != 0, F.col("record_type")).otherwise("OTHER").alias("recordType"), at.alias("collectedAt"), F.col("content"),
        F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url"), at.alias("retrievedAt"), F.lit("h").alias("contentHash")).alias("source"),
        F.transform("evidence", lambda e: F.struct(e["field"].alias("field"), e["method"].alias("method"), e["source_url"].alias("sourceUrl"), e["source_pointer"].alias("sourcePointer"), sure.alias("confidence"))).alias("evidence"),
    ))
    snake = F.to_json(F.struct(
        "record_key", F.when(rid % 37 != 0, F.col("record_type")).otherwise("OTHER").alias("record_type"), at.alias("collected_at"), F.col("content"),
        F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url"), at.alias("retrieved_at"), F.lit("h").alias("content_hash")).alias("source"),
        F.transform("evidence", lambda e: F.struct(e["field"].alias("field"), e["method"].alias("method"), e["source_url"].alias("source_url"), e["source_pointer"].alias("source_pointer"), sure.alias("confidence"))).alias("evidence"),
    ))
    return view.select("rid", "record_key", F.when(rid % 31 == 0, F.to_json(F.array("record_key"))).when(half, camel).otherwise(snake).alias("document"))


def hydrate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records read back, and whether their public document, read again, is the same."""
    # parsing costs far more than moving rows: they are dealt out evenly, whatever files they lie in
    view = record_view(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "record_type", "rid")
    found, _ = hydrated_records(_legacy(view))
    own = F.concat_ws("|", "record_type", "record_key", "source.url")  # keys repeat
    facts = F.struct(
        "record_key", "record_type", "schema_version", F.col("source.url").alias("url"), F.size(F.json_object_keys(F.to_json("content"))).alias("fields"), F.size("evidence").alias("proofs"),
        F.aggregate("evidence", F.lit(0.0), lambda a, e: a + e["confidence"]).alias("confidence"), F.date_format("collected_at", "yyyy-MM-dd HH:mm").alias("collected"),
    )
    told = found.select(facts.alias("facts"), own.alias("record_key"), *(c for c in found.columns if c != "record_key"))
    first = told.select("facts", F.explode(F.array(public_document())).alias("document")).withColumn("first", F.col("document"))
    again, _ = hydrated_records(first, ("facts", "first"))
    return again.select("facts.*", (F.col("first") == public_document()).alias("same"))


def hydrate_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, aside = hydrated_records(_legacy(record_view(spark, sf_dir)))
    return aside.groupBy("reason").agg(F.count("*").alias("n"))


def flatten_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.flat(record_view(spark, sf_dir).where("record_type = 'JOB'"), ["company", "title", "date", "is_remote"]).withColumnRenamed("date", "dated")


def _tab(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records, _ = hydrated_records(_legacy(record_view(spark, sf_dir).where(F.col("record_type") == kind)))
        return tabs.tab(public_documents(records), kind)

    query.__name__ = f"tab_{kind.lower()}"
    query.__doc__ = f"The {kind} tab of all whole records: read back, written as public documents, flattened."
    return query


def _cell_sql(route: str) -> str:
    fixed = {"schemaVersion": "CASE WHEN rid % 2 = 0 THEN '1.1' ELSE '1.0' END", "recordType": "record_type", "source.name": "lower(record_type)", "source.url": "source_url",
             "collectedAt": "'2024-01-30 12:00:00'", "source.contentHash": "'h'", "recordKey": "record_key"}
    name = route.removeprefix("content.")
    value = f"max(value) FILTER (field = '{name}')"
    if route in fixed:
        out = f"any_value({fixed[route]})"
    elif route in tabs.WHOLE:
        out = f"TRY_CAST({value} AS BIGINT)"
    elif route in tabs.SHARE:
        out = f"TRY_CAST({value} AS DOUBLE)"
    elif route in tabs.FLAG:
        out = f"coalesce(TRY_CAST({value} AS BOOLEAN), false)"
    elif route in tabs.TIME:
        out = f"nullif(coalesce(strftime(TRY_CAST({value} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), {value}), '')"
    else:
        out = f"regexp_replace(coalesce({value}, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g')"
    return f'{out} AS "{tabs.column_name(route)}"'


def llm_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = record_view(spark, sf_dir).where("record_type = 'PRODUCT'")
    c = F.col("content")
    kind = F.when(F.col("rid") % 3 == 0, F.concat(c["description"], F.lit(" free plan"))).otherwise(c["description"])
    doc = document_of({"Product": c["productName"], "Description": kind})
    rows = view.select("rid", "record_type", c["pricingModel"].alias("pricing"), doc.alias("document"))
    return rows.where(needs_pricing(F.col("record_type"), F.col("pricing"), F.col("document"))).select("rid", F.length("document").alias("chars"))


def llm_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call budget is a feature of the operator: 50 calls, all candidates counted."""
    return within_budget(llm_candidates(spark, sf_dir), 50, "rid").groupBy("called").agg(F.count("*").alias("n"), F.max("rid").alias("last"))


def llm_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = record_view(spark, sf_dir)
    quotes = F.map_from_entries(F.transform(evidence.proven_fields(F.col("evidence")), lambda f: F.struct(f.alias("k"), F.lit("quote").alias("v"))))
    filled = F.map_filter("content", lambda _, v: v.isNotNull())
    return view.select("record_type", "rid", F.size(F.map_keys(with_evidence(filled, quotes))).alias("n"))


class Phrases:
    """A provider by fixed phrases, for runs without a network: the first phrase that a document holds answers. It is slow to
    answer (fails the first time) on some, and refuses others."""

    def __init__(self, name: str, phrases: dict[str, tuple[str | None, str | None]], busy: tuple[str, ...] = (), refused: tuple[str, ...] = ()) -> None:
        self.name, self.phrases, self.busy, self.refused = name, phrases, busy, refused

    def extract(self, document: str, field: str) -> tuple[str | None, str | None]:
        if any(p in document for p in self.refused):
            raise Refused
        if any(p in document for p in self.busy):
            raise TimeoutError
        return next((v for p, v in self.phrases.items() if p in document), (None, None))


_FIRST = Phrases("first", {"free plan": ("free", " free plan\n"), "enterprise only": ("ENTERPRISE", "enterprise grade"), "subscription": ("MONTHLY", "subscription"), "URGENT": ("Operations", "URGENT"), "MEDIUM": ("engineering", "MEDIUM")}, busy=("paid seats", "LOW"), refused=("HIGH",))
_SECOND = Phrases("second", {"paid seats": ("Paid", "paid seats"), "HIGH": ("Sales", "HIGH")}, busy=("LOW",))


def enrich_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product and job after enrichment: outcome, tries, the value, and its proof."""
    view = record_view(spark, sf_dir).where("record_type in ('PRODUCT', 'JOB')")
    offers = F.element_at(F.array(*map(F.lit, [" free plan", " enterprise only", " subscription", " paid seats", ""])), (F.col("rid") % 5).cast("int") + 1)
    told = F.transform_values("content", lambda k, v: F.when(k == "description", F.concat(v, offers)).otherwise(v))
    proofs = F.transform("evidence", lambda e: e.withField("excerpt", F.lit(None).cast("string")))
    done = enriched(view.withColumns({"content": told, "evidence": proofs}), ["record_type", "rid"], [_FIRST, _SECOND])
    field = F.when(F.col("record_type") == "PRODUCT", "pricingModel").otherwise("role_family")
    proof = F.filter("evidence", lambda e: e["field"] == field)
    return done.select("record_type", "rid", "outcome", "attempts", F.col("content")[field].alias("value"), F.size(proof).alias("proofs"), F.get(proof, F.lit(0))["method"].alias("method"),
        F.get(proof, F.lit(0))["source_pointer"].alias("pointer"), F.get(proof, F.lit(0))["excerpt"].alias("excerpt"), F.get(proof, F.lit(0))["confidence"].alias("confidence"), F.size("content").alias("fields"), F.size("evidence").alias("all_proofs"))


def latest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_wins(record_view(spark, sf_dir), ["record_key"], "rid").select("record_key", "rid", "record_type")


VR = f"WITH {REC}, {FLD}"
SQL = {
    "quality_report": f"WITH {REPORT} SELECT *, total - unique_keys AS duplicate_keys, round(evidence_complete / total, 4) AS pass_rate FROM rep",
    "quality_errors": f"WITH {REPORT} SELECT record_type, code, n FROM (UNPIVOT (SELECT *, total - unique_keys AS duplicate_keys FROM rep) ON {', '.join(COUNTS)}, duplicate_keys INTO NAME code VALUE n) WHERE n > 0",
    "submission_gate": f"""WITH {REPORT}, r AS (SELECT *, record_type IN ('STARTUP', 'PRODUCT', 'RESEARCH_PAPER') AS catalog FROM rep),
        b AS (SELECT record_type, unnest([CASE WHEN catalog AND total < 1000 OR NOT catalog AND total < 1 THEN 'too_few' END, CASE WHEN valid_source_urls <> total THEN 'invalid_urls' END,
        CASE WHEN evidence_complete <> total THEN 'without_evidence' END, CASE WHEN missing_required_fields > 0 THEN 'incomplete' END, CASE WHEN unique_keys <> total THEN 'duplicate_keys' END,
        CASE WHEN outside_24h_window > 0 THEN 'stale_signals' END, CASE WHEN invalid_freshness_date > 0 THEN 'invalid_dates' END, CASE WHEN schema_contract_mismatch > 0 THEN 'contract' END, CASE WHEN catalog AND unique_source_urls <> total THEN 'urls_not_unique' END,
        CASE WHEN record_type = 'PRODUCT' AND product_company_name_collision > 0.05 * total THEN 'relabelled_companies' END, CASE WHEN invalid_pricing_model > 0 THEN 'pricing' END,
        CASE WHEN github_stars_not_direct > 0 THEN 'stars_not_direct' END, CASE WHEN github_stars_stale > 0 OR github_stars_timestamp_invalid > 0 THEN 'stars_not_current' END]) AS rule FROM r)
        SELECT * FROM b WHERE rule IS NOT NULL""",
    "evidence_gate": f"""{VR} SELECT record_type, rid, coalesce(string_agg(field, ',' ORDER BY field) FILTER ({FILLED} AND NOT proven AND field NOT IN ('github_url', 'github_stars')), '') AS unproven,
        count(*) FILTER ({FILLED} AND NOT proven AND field NOT IN ('github_url', 'github_stars')) = 0 AS accepted FROM fld GROUP BY ALL""",
    "populated_fields": f"WITH {CHECKS} SELECT record_type, rid, coalesce(names, '') AS names FROM per",
    "required_fields": f"WITH {CHECKS} SELECT record_type, rid, absent FROM miss",
    "schema_contract": f"{VR} SELECT split_part(record_key, ':', 1) AS kind, count(*) AS n, count(*) FILTER (rid % 17 <> 0) AS whole FROM rec GROUP BY 1",
    "payload_contract": f"""{VR} SELECT record_type, CAST(sum(b) AS BIGINT) AS schema_contract_mismatch, CAST(max(b) AS INT) AS most, count(*) FILTER (rid % 19 = 0) AS record_type_mismatch
        FROM (SELECT *, CAST(rid % 11 = 0 AS INT) + CAST(rid % 13 = 0 OR rid % 29 = 0 AS INT) + CAST(rid % 17 = 0 AS INT) AS b FROM rec) GROUP BY 1""",
    "domain_checks": f"{VR} SELECT rid, coalesce(value, 'none') AS pricing, value IS NULL OR value IN ('FREE', 'PAID') AS fits, rid % 13 < 2 AS bad_confidence FROM fld WHERE field = 'pricingModel'",
    "evidence_replace": f"{VR} SELECT rid, CAST(count(*) FILTER (proven) AS INT) AS n, 'llm' AS last_method, 1 AS stars FROM fld WHERE record_type = 'RESEARCH_PAPER' GROUP BY rid",
    "count_by_type": f"{VR} SELECT record_type, count(*) AS n FROM rec GROUP BY 1",
    "export_manifest": f"{VR} SELECT record_type, count(*) AS records, min(record_key) AS first_key, max(record_key) AS last_key FROM rec GROUP BY 1",
    "quality_rollup": f"""WITH {CHECKS}, f AS (SELECT record_type, CASE WHEN web THEN 'web' ELSE 'other' END AS kind, unproven = 0 AS ok FROM flags)
        SELECT coalesce(record_type, 'all') AS record_type, coalesce(kind, 'all') AS kind, count(*) AS n, count(*) FILTER (ok) AS proven FROM f GROUP BY ROLLUP (record_type, kind)""",
    "public_contract": f"{VR} SELECT record_key, record_type, source_url AS url, '1.1' AS version FROM rec",
    "hydrate_legacy": f"{VR} SELECT record_key, record_type, CASE WHEN rid % 2 = 0 THEN '1.1' ELSE '1.0' END AS schema_version, source_url FROM rec",
    "hydrate_records": f"""{VR}, n AS (SELECT record_type, rid, count(*) AS fields, count(*) FILTER (proven) AS proofs FROM fld GROUP BY ALL)
        SELECT record_key, record_type, CASE WHEN rid % 2 = 0 THEN '1.1' ELSE '1.0' END AS schema_version, source_url AS url, CAST(fields AS INT) AS fields, CAST(proofs AS INT) AS proofs,
        CAST(proofs AS DOUBLE) * CASE WHEN rid % 13 = 0 THEN 1 ELSE 0.5 END AS confidence, '2024-01-30 12:00' AS collected, true AS same FROM rec JOIN n USING (record_type, rid) WHERE rid % 31 <> 0 AND rid % 37 <> 0""",
    "hydrate_aside": f"{VR} SELECT CASE WHEN rid % 31 = 0 THEN 'not_object' ELSE 'record_type' END AS reason, count(*) AS n FROM rec WHERE rid % 31 = 0 OR rid % 37 = 0 GROUP BY 1",
    "flatten_tabs": f"""{VR} SELECT record_key, max(value) FILTER (field = 'company') AS company, max(value) FILTER (field = 'title') AS title, coalesce(max(value) FILTER (field = 'date'), '') AS dated,
        max(value) FILTER (field = 'is_remote') AS is_remote FROM rec JOIN fld USING (record_type, rid) WHERE record_type = 'JOB' GROUP BY record_key, rid""",
    "llm_candidates": """WITH p AS (SELECT CAST(p_partkey AS BIGINT) AS rid, p_partkey % 7 AS m, 'Product: ' || CASE WHEN p_partkey % 29 = 0 THEN p_brand ELSE p_name END || chr(10) || chr(10) || 'Description: ' || p_type || CASE WHEN p_partkey % 3 = 0 THEN ' free plan' ELSE '' END AS doc FROM part)
        SELECT rid, CAST(length(doc) AS INT) AS chars FROM p WHERE m > 2 AND regexp_matches(lower(doc), 'free|freemium|paid|pricing|subscription|enterprise|plan')""",
    "llm_validate": f"{VR} SELECT record_type, rid, CAST(count(*) FILTER (value IS NOT NULL AND proven) AS INT) AS n FROM fld GROUP BY ALL",
    "enrich_records": """WITH p AS (SELECT 'PRODUCT' AS record_type, CAST(p_partkey AS BIGINT) AS rid, 'pricingModel' AS field, 5 AS fields,
            CASE p_partkey % 7 WHEN 0 THEN 'FREE' WHEN 1 THEN 'PAID' WHEN 2 THEN 'BARTER' END AS was,
            CASE WHEN p_partkey % 7 < 3 THEN -1 WHEN p_partkey % 5 < 4 THEN p_partkey % 5 WHEN regexp_matches(lower(p_name || p_type), 'free|paid|pricing|subscription|enterprise|plan') THEN 4 ELSE -1 END AS c FROM part
        UNION ALL SELECT 'JOB', CAST(o_orderkey AS BIGINT), 'role_family', 7, 'Other', CASE WHEN o_orderpriority LIKE '%URGENT' THEN 5 WHEN o_orderpriority LIKE '%MEDIUM' THEN 6 WHEN o_orderpriority LIKE '%LOW' THEN 7 WHEN o_orderpriority LIKE '%HIGH' THEN 8 ELSE 4 END FROM orders),
        a(c, outcome, attempts, answer, provider, quote) AS (VALUES (-1, 'none', 0, NULL, NULL, NULL), (0, 'applied', 1, 'FREE', 'first', 'free plan'), (1, 'rejected', 1, NULL, NULL, NULL), (2, 'rejected', 1, NULL, NULL, NULL), (3, 'applied', 3, 'PAID', 'second', 'paid seats'),
            (4, 'rejected', 1, NULL, NULL, NULL), (5, 'applied', 1, 'Operations', 'first', 'URGENT'), (6, 'rejected', 1, NULL, NULL, NULL), (7, 'failed', 4, NULL, NULL, NULL), (8, 'applied', 2, 'Sales', 'second', 'HIGH'))
        SELECT record_type, rid, outcome, CAST(attempts AS INT) AS attempts, coalesce(answer, was) AS value, 1 AS proofs, CASE WHEN answer IS NULL THEN 'api' ELSE 'llm' END AS method,
            CASE WHEN answer IS NULL THEN '/' || field ELSE 'llm:' || provider END AS pointer, quote AS excerpt, CAST(CASE WHEN answer IS NULL THEN 1.0 ELSE 0.85 END AS DOUBLE) AS confidence, CAST(fields AS INT) AS fields,
            CAST(fields - CASE WHEN rid % 23 = 0 THEN 1 ELSE 0 END AS INT) AS all_proofs FROM p JOIN a USING (c)""",
    "latest_records": f"{VR} SELECT record_key, max(rid) AS rid, any_value(record_type) AS record_type FROM rec GROUP BY 1",
}
SQL["llm_budget"] = f"WITH c AS ({SQL['llm_candidates']}), r AS (SELECT rid, row_number() OVER (ORDER BY rid) <= 50 AS called FROM c) SELECT called, count(*) AS n, max(rid) AS last FROM r GROUP BY called"
SQL |= {f"tab_{k.lower()}": f"{VR} SELECT {', '.join(map(_cell_sql, routes))} FROM rec JOIN fld USING (record_type, rid) WHERE record_type = '{k}' AND rid % 31 <> 0 AND rid % 37 <> 0 GROUP BY rid" for k, routes in tabs.TABS.items()}
QUERIES = [*map(_tab, tabs.TABS), quality_report, quality_errors, submission_gate, evidence_gate, populated_fields, required_fields, schema_contract, payload_contract, domain_checks, evidence_replace, count_by_type, export_manifest, quality_rollup, public_contract, hydrate_legacy, hydrate_records, hydrate_aside, flatten_tabs, llm_candidates, llm_budget, llm_validate, enrich_records, latest_records]
