"""Quality scores by a sparse ensemble of rules.

Shallow boosted trees over statistics of a text are fitted to a bounded sample;
every path from a root is a rule, a conjunction of comparisons. A logistic
regression with an L1 penalty picks and weighs the rules, and those left become
one Spark column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.llm.hashing import BLANK, token_hashes
from telemorph.llm.language_model import pieces
from telemorph.llm.shared import in_fold, outside_fold, stage

_UPPER, _DIGIT, _END, _MARK, _HIGH = range(1, 6)
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _UPPER, _DIGIT, _HIGH
_CLASS[[ord(c) for c in ".!?"]] = _END
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = _MARK

STATISTICS = [
    "n_words", "word_bytes", "upper_share", "digit_share", "end_share", "mark_share", "high_share",
    "bang_share", "bar_share", "distinct_words", "n_lines", "distinct_lines", "line_words", "top_word",
]


def measure(texts: list) -> pd.DataFrame:
    """Statistics of whole texts; all are 0 for null, empty and blank ones."""
    hashes, offsets = token_hashes(texts)
    rows = np.zeros((len(texts), len(STATISTICS)))
    for i, text in enumerate(texts):
        words = hashes[offsets[i] : offsets[i + 1]]
        if not len(words):
            continue
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        kinds = np.bincount(_CLASS[data], minlength=6)
        solid = len(data) - int(BLANK[data].sum())
        _, times = np.unique(words, return_counts=True)
        lines = [line for line in text.split("\n") if line.strip()]
        rows[i] = (
            len(words), solid / len(words), kinds[_UPPER] / solid, kinds[_DIGIT] / solid, kinds[_END] / len(words),
            kinds[_MARK] / solid, kinds[_HIGH] / solid, text.count("!") / len(words), text.count("|") / len(words),
            len(times) / len(words), len(lines), len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)), times.max() / len(words),
        )
    return pd.DataFrame(rows, columns=STATISTICS)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pieces(batches):
            yield pd.concat([batch["doc_id"], measure(batch["text"].tolist())], axis=1)

    return docs.select("doc_id", "text").mapInPandas(rows, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


#: One comparison: statistic, threshold, and whether it must be at most that.
Condition = tuple[int, float, bool]


@dataclass
class Rules:
    base: float
    rules: list[tuple[float, tuple[Condition, ...]]]

    def column(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        total = F.lit(self.base)
        for weight, conditions in self.rules:
            held = F.lit(True)
            for which, threshold, most in conditions:
                value = F.col(STATISTICS[which])
                held = held & ((value <= threshold) if most else (value > threshold))
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(conditions: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for which, threshold, most in conditions:
        out &= (x[:, which] <= threshold) if most else (x[:, which] > threshold)
    return out


def grow(x: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int, path: tuple, out: list) -> np.ndarray:
    """Grow one tree on gradients; adds the path of every node to ``out`` and
    returns the step for each row."""
    steps = np.full(len(x), 0.0)
    steps[rows] = slope[rows].sum() / (curve[rows].sum() + 1.0)
    if path:
        out.append(path)
    if depth == 0 or len(rows) < 20:
        return steps
    best, where = 1e-6, None
    total, weight = slope[rows].sum(), curve[rows].sum()
    for which, edges in enumerate(cuts):
        if not len(edges):
            continue
        place = np.searchsorted(edges, x[rows, which], "left")
        left = np.cumsum(np.bincount(place, slope[rows], len(edges) + 1))[:-1]
        heavy = np.cumsum(np.bincount(place, curve[rows], len(edges) + 1))[:-1]
        gain = left**2 / (heavy + 1.0) + (total - left) ** 2 / (weight - heavy + 1.0) - total**2 / (weight + 1.0)
        gain[(heavy < 1e-3) | (weight - heavy < 1e-3)] = 0.0
        if gain.max() > best:
            best, where = gain.max(), (which, float(edges[gain.argmax()]))
    if where:
        which, threshold = where
        low = x[rows, which] <= threshold
        for side, most in ((rows[low], True), (rows[~low], False)):
            if len(side):
                steps[side] = grow(x, cuts, slope, curve, side, depth - 1, (*path, (which, threshold, most)), out)[side]
    return steps


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-3, rounds: int = 300) -> Rules:
    """Rules for labels 0 and 1. Without labels the probability is one half,
    with one kind of label it stays near that one."""
    if not len(y):
        return Rules(0.0, [])
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    start = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return Rules(start, [])
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 49)))for k in range(x.shape[1])]
    margin, paths = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        margin = margin + 0.3 * grow(x, cuts, y - p, p * (1 - p), np.arange(len(y)), depth, (), paths)
    paths = sorted(set(paths))
    matrix = np.stack([holds(path, x) for path in paths], 1).astype(np.float32)
    _, first = np.unique(np.packbits(matrix.astype(bool), axis=0), axis=1, return_index=True)  # rules that hold for the same rows
    first = np.array([k for k in sorted(first) if 0 < matrix[:, k].mean() < 1], int)
    paths, matrix = [paths[k] for k in first], matrix[:, first]
    # Proximal gradient with momentum for logistic loss and an L1 penalty.
    middle = matrix.mean(0)
    centred = matrix - middle
    size = np.linalg.norm(centred, 2) ** 2 / (4 * len(y)) if matrix.size else 1.0
    weight, ahead, base, momentum = np.zeros(len(paths)), np.zeros(len(paths)), start, 1.0
    for _ in range(rounds):
        gap = 1 / (1 + np.exp(-(base + centred @ ahead))) - y
        step = ahead - (centred.T @ gap) / len(y) / size
        after = np.sign(step) * np.maximum(np.abs(step) - penalty / size, 0.0)
        base -= 4 * gap.mean()
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, weight, momentum = after + (momentum - 1) / faster * (after - weight), after, faster
    kept = [(float(w), path) for w, path in zip(weight, paths, strict=True) if abs(w) > 1e-4]
    return Rules(float(base - middle @ weight), kept)


def learn(measured: DataFrame, labels: DataFrame, sample: int = 8000) -> Rules:
    """Rules from about ``sample`` labelled rows: ``measured`` joined with
    ``labels`` (doc_id, quality) where quality is 0 or 1. A document with several
    labels teaches each of them."""
    marks = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = measured.select("doc_id", *STATISTICS).join(marks, "doc_id")
    total = known.count()
    draw = F.pmod(F.xxhash64(F.lit(3), "doc_id", "quality"), F.lit(1 << 30))
    share = int(min(1.0, sample / max(1, total)) * (1 << 30))
    rows = known.withColumn("draw", draw).where(F.col("draw") < share).orderBy("draw", "doc_id", "quality", *STATISTICS).limit(2 * sample).collect()
    values = np.array([[r[s] for s in STATISTICS] for r in rows]).reshape(len(rows), len(STATISTICS))
    return fit(values, np.array([r["quality"] for r in rows], float))


def score(measured: DataFrame, rules: Rules, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (probability of label 1) and predicted for every row of ``measured``."""
    scored = measured.withColumn("_score", rules.column())
    return scored.select("doc_id", F.col("_score").alias("score"), F.when(F.col("_score") >= threshold, 1).otherwise(0).alias("predicted"))


def score_held_out(docs: DataFrame, labels: DataFrame, sample: int = 8000) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), learnt from labelled
    documents outside fold 2 of 4. Null, empty and blank texts have statistics of
    0 and are scored like any other; equal rows get equal scores; rows without
    doc_id are scored and teach nothing; other columns are ignored."""
    measured = stage(statistics(docs))
    rules = learn(measured.where(outside_fold(F.col("doc_id"), 4, 2)), labels, sample)
    return score(measured, rules).withColumn("held_out", in_fold(F.col("doc_id"), 4, 2))
