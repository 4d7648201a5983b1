"""Registered queries of the operators for training data, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemorph.llm import (
    decontamination, disclosure, fill_in_middle, hard_negatives, jaccard_join, language_id, language_model, licences, mixing, neighbours, quality_rules, simhash,
    token_counts,
)
from telemorph.llm.shared import read


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_held_out(read(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), n=3, percent=90)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_held_out(read(spark, sf_dir, "documents"))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.digest(disclosure.detect(read(spark, sf_dir, "documents")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read(spark, sf_dir, "documents"))


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_of_hundredth(read(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(read(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hundredth(read(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        op1_lm_scoring, op2_ngram_jaccard, op3_language_id, op4_licence_scan, op5_token_counts, op6_personal_data,
        op7_decontamination, op8_quality_rules, op9_source_mixing, op10_nearest_vectors, op11_fill_in_middle, op12_hard_negatives, op13_simhash, pipeline,
    )
}

_TEMPLATES = ", ".join("('{}', '{}')".format(name, wording.replace("'", "''")) for name, wording in licences.TEMPLATES.items())

ORACLES: dict[str, str] = {
    "op4_licence_scan": f"""
WITH normal AS (
  SELECT licence AS id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
  FROM (SELECT licence, string_split(trim(regexp_replace(lower(wording), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
        FROM (VALUES {_TEMPLATES}) t(licence, wording))),
lines AS (
  SELECT doc_id, row_number() OVER () AS line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
  FROM (SELECT doc_id, string_split(trim(regexp_replace(lower(line), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))),
scored AS (
  SELECT l.doc_id, l.line, n.id, 2.0::DOUBLE * len(list_intersect(l.grams, n.grams)) / (len(l.grams) + len(n.grams)) AS dice
  FROM lines l, normal n WHERE len(l.grams) > 0 AND len(l.grams) <= 100),
best AS (
  SELECT doc_id, count(DISTINCT line) AS n_notices, arg_min(id, (-dice, id)) AS licence, max(dice) AS dice
  FROM scored WHERE dice >= 0.8 GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n_notices, 0)::BIGINT AS n_notices, b.licence, b.dice
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
""",
}
