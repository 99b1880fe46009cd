"""The registered queries of the training-data operators, with the production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm import alignment, ann, bpe, conversations, language_id, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, substring_dedup, token_counts
from quern.llm.common import documents

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir), WORD_BPE)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), BYTE_BPE, limit=512)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digests(documents(spark, sf_dir), size=50)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=3, percent=85)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_BPE, capacity=2048)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.train_and_score(documents(spark, sf_dir))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=10, query_every=100)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(documents(spark, sf_dir), BYTE_BPE, PIECES)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_bpe_round_trip,
        op2_token_counts,
        op3_line_dedup,
        op4_substring_dedup,
        op5_quality_rules,
        op6_quality_classifier,
        op7_near_dedup,
        op8_best_fit_packing,
        op9_lm_scoring,
        op10_nearest_neighbours,
        op11_tokenizer_alignment,
        op12_language_id,
        op13_conversation_repair,
    ]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
v AS (SELECT doc_id, start, array_to_string(w[start:start + 49], ' ') AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS start FROM d)),
f AS (SELECT win, min(doc_id) AS first FROM v GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS pos FROM v JOIN f USING (win) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
         FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS_SQL.format(LOWERED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * p.c >= 85 * (x.c + y.c - p.c)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_dedup": OP4_SQL, "op7_near_dedup": OP7_SQL}
