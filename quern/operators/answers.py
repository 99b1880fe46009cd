"""The enrichment's effect on records: open questions, providers asked on executors, and answers that set values with their proof."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import trimmed
from quern.operators.enrich import document_of, needs_pricing
from quern.operators.evidence import replaced
from quern.sinks.shared import stored

# What may be answered, how sure an answer is, and how much of its quote is kept.
PRICING_MODELS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
ROLE_FAMILIES = ["Research", "Data", "Product", "Engineering", "Sales", "Marketing", "Operations", "Other"]
CONFIDENCE, EXCERPT = 0.85, 500
#: Answers of up to this many bytes in all travel by broadcast; more are joined by shuffle.
BROADCAST_BYTES = 32 << 20


class Refused(Exception):
    """A provider's answer that asking again won't change: the next provider is asked."""


class Provider(Protocol):
    """A named provider. Any exception but ``Refused`` is worth another try."""

    name: str

    def extract(self, document: str, field: str) -> tuple[str | None, str | None]: ...


def open_question(record_type: Column, content: Column) -> Column:
    """struct(field, document) of what a record leaves open, else null: a product's price model, a job's role family."""
    offer = document_of({"Product": content["productName"], "Tagline": content["tagline"], "Description": content["description"]})
    post = F.concat(F.lit("Job title: "), F.coalesce(content["title"], F.lit("")), F.lit("\n\nDescription: "), F.coalesce(content["full_text"], F.lit("")))
    priced = F.coalesce(needs_pricing(record_type, content["pricingModel"], offer), F.lit(False))
    return F.when(priced, F.struct(F.lit("pricingModel").alias("field"), offer.alias("document"))).when(
        (record_type == "JOB") & (content["role_family"] == "Other"), F.struct(F.lit("role_family").alias("field"), post.alias("document"))
    )


def asked(questions: DataFrame, keys: list[str], providers: Sequence[Provider], retries: int) -> DataFrame:
    """keys, value, quote, provider, attempts, selected from the first provider that answers; provider is null if all failed.

    ``questions`` has keys, field, document. Each provider is tried ``retries`` + 1 times.
    """

    def one(document: str, field: str) -> tuple:
        tries = 0
        for p in providers:
            for _ in range(retries + 1):
                tries += 1
                try:
                    return (*p.extract(document, field), p.name, tries)
                except Refused:
                    break
                except Exception:  # noqa: BLE001, S112 - whatever a provider raises is a try
                    continue
        return (None, None, None, tries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [one(d, f) for d, f in zip(pdf["document"], pdf["field"], strict=True)]
            yield pdf[keys].assign(**dict(zip(["value", "quote", "provider", "attempts"], map(list, zip(*found, strict=True)), strict=True))) if found else pdf[keys].assign(value=None, quote=None, provider=None, attempts=0)

    kinds = ", ".join(f"`{k}` {questions.schema[k].dataType.simpleString()}" for k in keys)
    return questions.select(*keys, "field", "document").mapInPandas(run, f"{kinds}, value string, quote string, provider string, attempts int")


def _proof(kind, facts: dict[str, Column]) -> Column:
    """Evidence with the fields that the records' own has; what isn't known is null."""
    return F.struct(*[facts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.elementType.fields])


def enriched(records: DataFrame, keys: list[str], providers: Sequence[Provider], calls: int | None = None, retries: int = 1) -> DataFrame:
    """All records, with ``outcome`` and ``attempts``: accepted answers are set in ``content``, and their proof takes
    the place of the field's evidence.

    Records have unique ``keys``, record_type, source_url, content (map) and evidence. Outcomes: ``none`` (nothing open),
    ``unasked`` (over the budget of ``calls``, taken in order of keys), ``failed`` (no provider answered), ``rejected``
    (value or quote missing, value not allowed, quote not in the document word for word), ``applied``. Rows with a null
    key are never asked. Answers are stored once: nothing is asked again when the result is read twice.
    """
    open_ = records.withColumn("_open", open_question(F.col("record_type"), F.col("content")))
    questions = open_.where("_open is not null").where(" and ".join(f"`{k}` is not null" for k in keys)).select(*keys, "_open.field", "_open.document")
    if calls is not None:
        # the budget comes out in one partition: it is spread again, so that executors ask side by side
        questions = questions.orderBy(*keys).limit(calls).repartition(*keys)
    answers = stored(asked(questions, keys, providers, retries))
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (*keys, "value", "quote", "provider")]
    held = answers.agg(F.sum(sum(texts, F.lit(64))).alias("n")).first()["n"] or 0
    answers = answers.select(*keys, F.struct("value", "quote", "provider", "attempts").alias("_answer"))
    rows = open_.join(F.broadcast(answers) if held <= BROADCAST_BYTES else answers, keys, "left")
    field, document, answer = F.col("_open.field"), F.col("_open.document"), F.col("_answer")
    value = F.when(field == "pricingModel", F.upper(answer["value"])).otherwise(answer["value"])
    quote = trimmed(answer["quote"])
    allowed = F.when(field == "pricingModel", value.isin(PRICING_MODELS)).otherwise(value.isin(ROLE_FAMILIES))
    fine = F.coalesce(allowed & (quote != "") & F.contains(document, quote), F.lit(False))
    proof = _proof(records.schema["evidence"].dataType, {
        "field": field, "method": F.lit("llm"), "source_url": F.col("source_url"), "source_pointer": F.concat(F.lit("llm:"), answer["provider"]), "excerpt": F.substring(quote, 1, EXCERPT), "confidence": F.lit(CONFIDENCE),
    })
    content = F.map_concat(F.map_filter("content", lambda k, _: k != field), F.create_map(field, value))
    outcome = F.when(F.col("_open").isNull(), "none").when(answer.isNull(), "unasked").when(answer["provider"].isNull(), "failed").when(fine, "applied").otherwise("rejected")
    old = F.coalesce("evidence", F.array().cast(records.schema["evidence"].dataType))
    done = rows.withColumns({"outcome": outcome, "attempts": F.coalesce(answer["attempts"], F.lit(0)), "_content": F.when(fine, content).otherwise(F.col("content")), "_evidence": F.when(fine, replaced(old, [field], F.array(proof))).otherwise(F.col("evidence"))})
    own = [F.col("_content").alias(c) if c == "content" else F.col("_evidence").alias(c) if c == "evidence" else F.col(c) for c in records.columns]
    return done.select(*own, "outcome", "attempts")
