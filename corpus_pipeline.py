"""From raw documents to a training mix, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next one's ``docs``.

Null, empty and blank texts have no letters, so the first stage rejects them; a
text of any length is worked on whole. Null sources are a source of their own,
null languages are filled. Rows that repeat both doc_id and text count as copies,
of which one stays; rows that share a doc_id only, or have none, are documents of
their own. Further columns, whatever their names, are carried along. Empty tables
give no rows.
"""

from __future__ import annotations

import functools
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from telemorph.llm import decontamination, disclosure, jaccard_join, language_id, mixing  # noqa: E402
from telemorph.llm.shared import read, shared_folder, stage  # noqa: E402

#: Least share of the letters that must be expected in the found language.
SURE = 0.5


#: Columns of documents. Operators see these and one more; everything else lies in it.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shielded(step):
    """A stage whose operator cannot mistake other columns of ``docs`` for its own:
    they pass it as one struct, under a name that no column has, and come out as
    they were. What the last stage adds replaces columns of the same name."""

    @functools.wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = [c for c in docs.columns if c not in COLUMNS]
        if not more:
            return step(spark, docs, sf_dir)
        rest = "other_columns"
        while rest in docs.columns:
            rest += "_"
        own = [c for c in docs.columns if c in COLUMNS]
        packed = docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in more]).alias(rest))
        out = step(spark, packed, sf_dir)
        added = [c for c in out.columns if c not in (*own, rest)]
        return out.select(*[F.col(f"`{c}`") if c in own else F.col(rest)[c].alias(c) for c in docs.columns if c not in added], *added)

    return run_step


@shielded
def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3. Rejects documents without letters and those in which no
    language holds the larger part; a missing ``lang`` is filled with what was
    found."""
    field = language_id.learn(docs)
    found = language_id.identify_rows(docs, field)
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= SURE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


@shielded
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


@shielded
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. Documents with benchmark passages go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


@shielded
def hide_people(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6. Personal data and terms that give it away are generalised or removed."""
    rewritten = disclosure.sanitised(docs)
    return rewritten.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@shielded
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. Every document as often as the mix takes it, with its pass and shard."""
    return mixing.mix(docs)


STAGES = [
    ("language", find_language),
    ("copies", drop_copies),
    ("benchmark", drop_benchmark),
    ("people", hide_people),
    ("mix", mix_sources),
]

#: No SQL states a fitted field or the drawing of blocks; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return stage(STAGES[-1][1](spark, docs, sf_dir))
