"""The pipeline on the smallest tables, and on rows meant to upset it."""

import corpus_pipeline
import pytest
from odd_rows import TEXTS
from pyspark.sql import functions as F

from telemorph.llm import decontamination, jaccard_join
from telemorph.llm.shared import read

FOLDER = "/root/testdata/sf0.001"
NAMES = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect(spark):
    docs = read(spark, FOLDER, "documents")
    by_id = {r.doc_id for r in jaccard_join.jaccard_components(docs).where("doc_id = component_id").collect()}
    leaked = {r.doc_id for r in decontamination.contaminated(docs, read(spark, FOLDER, "benchmark")).where("n_items > 0").collect()}
    mixed = corpus_pipeline.run(spark, FOLDER).cache()
    kept = {r.doc_id for r in mixed.select("doc_id").collect()}
    assert kept <= by_id - leaked and len(kept) > 0.5 * len(by_id - leaked)
    assert mixed.where(F.col("text").rlike(r"[a-z]@mail[0-9]+\.example\.com")).count() == 0
    assert mixed.groupBy("doc_id").count().where("count > 2").count() == 0


def plain_copies(rows):
    """One row of every group of texts with 0.8 or more of their 5-word shingles in common."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label, sets


def test_copies_are_told_apart_by_row(spark):
    rows = [(1, "one text here"), (2, "one text here"), (2, "another text"), (None, "another text"), (None, "a third text"), (None, "a third text"), (3, None), (3, " "), (5, "x y"), (5, "x y")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "v") for i, t in rows], NAMES + ", _none string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in jaccard_join.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, "one text here"), (2, "another text"), (None, "a third text"), (3, None), (3, " "), (5, "x y")], key=str)


def test_copies_equal_the_plain_version(spark):
    docs = read(spark, FOLDER, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    label, sets = plain_copies(rows)
    want = sorted(rows[i][0] for i, root in enumerate(label) if root == i or not sets[i])
    assert sorted(r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, FOLDER).select("doc_id").collect()) == want


@pytest.mark.parametrize("step", [f for _, f in corpus_pipeline.STAGES])
def test_stages_carry_odd_rows_and_columns(spark, step):
    clash = "spans string, text_key int, _key string, hinted string, row string, digest int, cell string, pass string, shard int, other_columns string"
    more = ("a", 1, "b", "c", "d", 2, "e", "f", 3, "g")
    texts = [t for t in TEXTS if t is None or len(t) < 1000]
    made = [(i % 11 if i != 5 else None, t, "en" if i % 2 else None, None if i % 4 == 0 else f"s{i % 2}", 1, *more) for i, t in enumerate([*texts, texts[8], texts[8]])]
    docs = spark.createDataFrame(made, f"{NAMES}, {clash}").repartition(2)
    out = step(spark, docs, FOLDER)
    assert set(docs.columns) <= set(out.columns)
    for r in out.collect():
        assert (r["spans"], r["text_key"], r["_key"], r["hinted"], r["row"], r["digest"], r["cell"], r["other_columns"]) == ("a", 1, "b", "c", "d", 2, "e", "g")
    empty = spark.createDataFrame([], f"{NAMES}, {clash}")
    assert step(spark, empty, FOLDER).count() == 0
