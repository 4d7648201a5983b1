"""Nearest vectors by multi-index hashing.

A rotation learned from a sample (principal axes, then alternating between
rounding to signs and rotating back) turns vectors into binary codes. A code is
split into substrings, each with its own index from substring value to rows. If
two codes differ in at most r bits, some substring differs in at most r / m
bits, so probing every index with all values that near returns every code within
r. What is within r is ranked by its exact distance.

Rows are dealt to blocks and queries to every block; a block indexes its rows,
and returns its k nearest for each query, which are merged per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemorph.llm.shared import stage

#: Bits of a substring.
PART = 16
#: Rows of a block and queries that meet it at once.
BLOCK, QUERIES = 8192, 16384
_ONES = np.array([bin(i).count("1") for i in range(1 << PART)], np.uint8)


@dataclass
class Coder:
    """Mean and rotated axes; a code has one bit for each axis."""

    mean: np.ndarray
    axes: np.ndarray

    @property
    def parts(self) -> int:
        return self.axes.shape[1] // PART

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of 16-bit substrings for each vector."""
        bits = (vectors - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def fit_coder(sample: np.ndarray, bits: int = 128, rounds: int = 20) -> Coder:
    """Learn axes from a bounded sample. More bits than dimensions come from
    several rotations, each learned from another random start."""
    size = sample.shape[1]
    mean = sample.mean(0) if len(sample) else np.zeros(size)
    centred = sample - mean
    values, axes = np.linalg.eigh(centred.T @ centred / max(1, len(sample)) + 1e-12 * np.eye(size))
    axes = axes[:, ::-1]
    rng, found = np.random.default_rng(5), []
    while sum(a.shape[1] for a in found) < bits:
        turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
        projected = centred @ axes
        for _ in range(rounds if len(sample) else 0):
            left, _, right = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
            turn = (left @ right).T
        found.append(axes @ turn)
    return Coder(mean, np.concatenate(found, 1)[:, :bits])


class Index:
    """Substring indexes over a block of codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.tables = codes, []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, starts = np.unique(codes[order, j], return_index=True)
            self.tables.append((values, np.r_[starts, len(order)], order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose codes differ from ``code`` in at most ``radius`` bits."""
        near = radius // len(code)
        found = np.zeros(len(self.codes), bool)
        for part, (values, starts, order) in zip(code, self.tables, strict=True):
            hit = np.flatnonzero(_ONES[values ^ part] <= near)
            sizes = starts[hit + 1] - starts[hit]
            if len(hit):
                skip = np.repeat(starts[hit] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
                found[order[np.arange(sizes.sum()) + skip]] = True
        rows = np.flatnonzero(found)
        return rows[_ONES[self.codes[rows] ^ code].sum(1, dtype=np.int64) <= radius]


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    """vec_id and embedding (doubles) of rows that take part."""
    row = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return row.where(F.col("vec_id").isNotNull() & (F.size("embedding") == dimensions) & fine & F.exists("embedding", lambda x: x != 0))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, bits: int = 128, radius: int = 58, sample: int = 4096
) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` (vec_id, embedding) for each row of
    ``queries`` (the same columns), but for those with the query's own vec_id:
    query_id, rank from 1, vec_id, score (Euclidean distance in double precision).

    Equal distances go to the smaller vec_id. Rows take no part if vec_id or
    embedding is null, the vector is zero or of another length than most, or a
    component is null or not finite. Rows that repeat (vec_id, embedding) count
    once. A block in which fewer than ``k`` codes lie within ``radius`` widens it
    until there are as many, or all. The rotation is learned from ``sample``
    rows; every row is indexed. Other columns are ignored; empty tables give no rows.
    """
    spark = vectors.sparkSession
    usual = vectors.where("embedding is not null").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimensions = usual["d"] if usual else 0
    rows = stage(usable(vectors, dimensions))
    asked = usable(queries, dimensions)
    total = rows.count()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    share = int(min(1.0, 1.5 * sample / max(1, total)) * (1 << 30))
    drawn = rows.where(draw <= share).orderBy(draw, "vec_id").limit(sample).collect()
    learned = np.array([r["embedding"] for r in drawn]).reshape(len(drawn), dimensions) if dimensions else np.zeros((0, 1))
    coder = spark.sparkContext.broadcast(fit_coder(learned, bits))
    blocks, groups = max(1, -(-total // BLOCK)), max(1, -(-asked.count() // QUERIES))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        own, other = frame[~frame["asking"]], frame[frame["asking"]]
        columns = ["query_id", "vec_id", "score"]
        if not len(own) or not len(other):
            return pd.DataFrame({c: [] for c in columns})
        ids, points = own["vec_id"].to_numpy(np.int64), np.stack(own["embedding"].to_list()).astype(float)
        seeking = np.stack(other["embedding"].to_list()).astype(float)
        index, codes = Index(coder.value.codes(points)), coder.value.codes(seeking)
        out = []
        for query, vector, code in zip(other["vec_id"].to_numpy(np.int64), seeking, codes, strict=True):
            reach = radius
            while True:
                found = index.within(code, reach)
                found = found[ids[found] != query]
                if len(found) >= k or reach >= bits:
                    break
                reach = min(bits, reach + PART)
            distance = np.sqrt(((points[found] - vector) ** 2).sum(1))
            for at in np.lexsort((ids[found], distance))[:k]:
                out.append((query, ids[found[at]], distance[at]))
        return pd.DataFrame(out, columns=columns)

    dealt = rows.select("vec_id", "embedding", F.lit(False).alias("asking"), F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    seeking = asked.distinct().select("vec_id", "embedding", F.lit(True).alias("asking"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(groups)).cast("int").alias("group"))
    found = dealt.distinct().union(seeking).groupBy("block", "group").applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_of_hundredth(vectors: DataFrame) -> DataFrame:
    """:func:`nearest` for every row whose vec_id is divisible by 100."""
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))
