"""Hard negatives by inner product, found in cover trees.

For an anchor's positives (the best rows of its own label) the negatives sought
are the best rows of other labels whose score lies in a window below the
positive's: close to the anchor, but not so close that they may be positives
under a wrong label.

1. Lift. A vector gets one more coordinate, so that all lie on a sphere of the
   longest vector's size. Angles between lifted vectors are a metric, and the
   angle to an anchor (lifted by 0) orders rows by inner product.
2. Cells. Every row goes to the nearest of at most ``PIVOTS`` rows; a cell's
   covering angle is measured over all its rows. With at most that many numbers
   in hand an anchor first asks the cell that may hold the highest products, and
   then all cells that may still hold one of its windows' best.
3. Cover tree. The blocks of a cell are indexed by nets: a node's centres are
   picked farthest first from its own centre on, until half its covering angle is
   reached or there are ``FAN``. So centres nest from level to level, cover all
   rows below them and are at least the level's angle apart. Levels have measured
   angles instead of a fixed series, so near-random vectors, all about equally
   far apart, do not make one child for each row. Rows of a frequent label have a
   tree of their own.
4. Descent. With the angle t from the anchor to a centre and the covering angle c
   all products below lie between |a| L cos(t + c) and |a| L cos(t - c). Nodes are
   visited in the order of the upper bound; those outside all windows that can
   still gain are skipped. Leaves are scored in whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemorph.functions.scalars import int_div
from telemorph.llm.shared import stage

#: Rows that cells are built around at most, and rows for each.
PIVOTS, CELL = 1024, 4096
#: Rows of a block, and anchors that meet it at once.
BLOCK, ANCHORS = 8192, 1024
#: Rows of a leaf, children of a node, and rows scored at once.
LEAF, FAN, BATCH = 64, 32, 512
#: Added to angles: above the rounding error of the angle of nearly equal vectors.
SLACK = 1e-6
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
ASKING = "anchor_id long, row long, label long, point array<long>, lo array<long>, hi array<long>, block int"


def lift(points: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors of one more dimension; ``longest`` is at least any vector's size."""
    longest = longest or 1.0
    points = points / longest
    return np.c_[points, np.sqrt(np.maximum(0.0, 1.0 - (points**2).sum(1)))]


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def bounds(anchors: np.ndarray, centres: np.ndarray, covering: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each anchor with anything the centres cover."""
    size = np.sqrt((anchors**2).sum(1))[:, None]
    t = angle(anchors @ centres[:, :-1].T / np.where(size > 0, size, 1.0))
    reach = covering + SLACK
    scale = size * (longest or 1.0)
    return scale * np.cos(np.minimum(np.pi, t + reach)) - scale * SLACK, scale * np.cos(np.maximum(0.0, t - reach)) + scale * SLACK


def products(points: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: by floating point where that is exact."""
    largest = float(np.abs(points).max(initial=0)) * float(np.abs(anchor).max(initial=0)) * len(anchor)
    if largest < 2**52:
        return (points.astype(float) @ anchor.astype(float)).astype(np.int64)
    return points @ anchor


class CoverTree:
    """Nets over the rows of a block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> None:
        self.ids, self.labels, self.points = ids, labels, points
        self.longest = float(np.sqrt((points.astype(float) ** 2).sum(1).max(initial=0)))
        self.unit = lift(points.astype(float), self.longest)
        self.nodes: list[tuple[int, float, int, int]] = []  # centre, covering angle, least and greatest label
        self.children: list[list[int]] = []
        self.rows: list[np.ndarray] = []
        names, label_of, sizes = np.unique(labels, return_inverse=True, return_counts=True)
        frequent = np.flatnonzero(sizes >= LEAF)
        groups = [np.flatnonzero(label_of == i) for i in frequent] + [np.flatnonzero(~np.isin(label_of, frequent))]
        self.roots = [self.grow(rows, int(rows[0])) for rows in groups if len(rows)]
        self.centres = self.unit[[n[0] for n in self.nodes]]
        self.covering = np.array([n[1] for n in self.nodes])
        self.least, self.most = (np.array([n[i] for n in self.nodes]) for i in (2, 3))

    def grow(self, rows: np.ndarray, centre: int) -> int:
        cosine = self.unit[rows] @ self.unit[centre]
        covering = float(angle(cosine.min()))
        node = len(self.nodes)
        self.nodes.append((centre, covering, int(self.labels[rows].min()), int(self.labels[rows].max())))
        self.children.append([])
        self.rows.append(rows)
        if len(rows) > LEAF and covering > SLACK:
            centres, nearest = [centre], np.zeros(len(rows), np.int64)
            while len(centres) < FAN and angle(cosine.min()) > covering / 2:
                far = int(rows[cosine.argmin()])
                closer = self.unit[rows] @ self.unit[far]
                nearest[closer > cosine] = len(centres)
                cosine = np.maximum(cosine, closer)
                centres.append(far)
            self.children[node] = [self.grow(rows[nearest == i], c) for i, c in enumerate(centres) if (nearest == i).any()]
            self.rows[node] = rows[:0]
        return node

    def best(self, anchors: Anchors, same: bool, k: int) -> Iterator[tuple[int, int, int, int]]:
        """(anchor's place, window, id, product) of the ``k`` best rows in each
        window of each anchor, of its own label or of all others."""
        lower, upper = bounds(anchors.points.astype(float), self.centres, self.covering, self.longest)
        for i, label in enumerate(anchors.labels):
            fits = (self.least <= label) & (label <= self.most) if same else (self.least != label) | (self.most != label)
            for window, found in self.descend(anchors.at(i), lower[i], upper[i], fits, same, k):
                for name, score in found:
                    yield i, window, name, score

    def descend(self, anchor: tuple, lower: np.ndarray, upper: np.ndarray, fits: np.ndarray, same: bool, k: int) -> Iterator[tuple[int, list]]:
        own, label, point, lo, hi = anchor
        need = [x if x <= y else None for x, y in zip(lo, hi, strict=True)]
        best: list[list[tuple[int, int]]] = [[] for _ in lo]  # (-product, id), best first

        def useful(node: int) -> bool:
            return bool(fits[node]) and any(n is not None and upper[node] >= n and lower[node] <= y for n, y in zip(need, hi, strict=True))

        def score(rows: np.ndarray) -> None:
            taken = (self.labels[rows] == label) == same
            rows = rows[taken & (self.ids[rows] != own)]
            values = products(self.points[rows], point)
            for w, (least, most) in enumerate(zip(need, hi, strict=True)):
                if least is None:
                    continue
                inside = np.flatnonzero((values >= least) & (values <= most))
                if len(inside) > k:
                    inside = inside[np.lexsort((self.ids[rows[inside]], -values[inside]))[:k]]
                best[w] = sorted(best[w] + [(-int(values[j]), int(self.ids[rows[j]])) for j in inside])[:k]
                if len(best[w]) == k:
                    need[w] = max(least, -best[w][-1][0])

        heap = [(-upper[r], r) for r in self.roots]
        heapq.heapify(heap)
        waiting: list[np.ndarray] = []
        while heap:
            node = heapq.heappop(heap)[1]
            if useful(node):
                for child in self.children[node]:
                    if useful(child):
                        heapq.heappush(heap, (-upper[child], child))
                if len(self.rows[node]):
                    waiting.append(self.rows[node])
            if waiting and (not heap or sum(map(len, waiting)) >= BATCH):
                score(np.concatenate(waiting))
                waiting = []
        for w, found in enumerate(best):
            yield w, [(name, -value) for value, name in found]


class Anchors:
    """Asking rows of a task."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.ids, self.labels = rows["anchor_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        self.points = np.stack(rows["point"].to_list()).astype(np.int64)
        self.lo, self.hi = ([[int(x) for x in one] for one in rows[c]] for c in ("lo", "hi"))

    def at(self, i: int) -> tuple[int, int, np.ndarray, list[int], list[int]]:
        return int(self.ids[i]), int(self.labels[i]), self.points[i], self.lo[i], self.hi[i]


class Search:
    """All rows in cells and blocks, and searches over them."""

    def __init__(self, rows: DataFrame) -> None:
        spark = rows.sparkSession
        size = F.aggregate("point", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        total, squared = rows.agg(F.count("*"), F.max(size)).first()
        longest = float(np.sqrt(squared or 0.0))
        count = min(PIVOTS, max(1, total // CELL))
        drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "point").limit(count).select("point").collect()
        units = lift(np.array([r["point"] for r in drawn], float), longest) if drawn else np.zeros((0, 1))

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                cosine = lift(np.stack(batch["point"].to_list()).astype(float), longest) @ units.T
                cell = cosine.argmax(1)
                yield batch.assign(cell=cell.astype(np.int32), covering=angle(cosine[np.arange(len(cell)), cell]))

        placed = stage(rows.mapInPandas(place, "vec_id long, label long, point array<long>, cell int, covering double"))
        cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("covering").alias("covering")).collect()}
        numbers = sorted(cells)
        self.units, self.longest = units[numbers], longest
        self.covering = np.array([cells[c]["covering"] for c in numbers])
        self.parts = np.array([-(-cells[c]["n"] // BLOCK) for c in numbers], np.int64)
        self.first_block = np.cumsum(self.parts) - self.parts
        if not numbers:
            self.rows = placed.select(F.lit(0).alias("block"), "vec_id", "label", "point")
            return
        layout = spark.createDataFrame(
            [(c, int(a), int(n)) for c, a, n in zip(numbers, self.first_block, self.parts, strict=True)], "cell int, first int, parts int"
        )
        block = (F.col("first") + F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.col("parts"))).cast("int")
        self.rows = placed.join(F.broadcast(layout), "cell").select(block.alias("block"), "vec_id", "label", "point")

    def choose(self, asking: DataFrame, first: bool) -> DataFrame:
        """``asking`` with each block to visit: those of the cell with the highest
        bound, or of all other cells that may hold something of a window."""
        units, covering, longest = self.units, self.covering, self.longest
        parts, first_block = self.parts, self.first_block

        def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch) or not len(units):
                    continue
                lower, upper = bounds(np.stack(batch["point"].to_list()).astype(float), units, covering, longest)
                visits = []
                for i, (lo, hi) in enumerate(zip(batch["lo"], batch["hi"], strict=True)):
                    lo, hi = np.asarray(lo, float)[:, None], np.asarray(hi, float)[:, None]
                    top = upper[i].argmax()
                    cells = ((upper[i] >= lo) & (lower[i] <= hi) & (lo <= hi)).any(0)
                    cells = np.flatnonzero(cells & ((np.arange(len(units)) == top) == first))
                    visits.append([b for c in cells for b in range(first_block[c], first_block[c] + parts[c])])
                yield batch.assign(block=visits).explode("block").dropna(subset=["block"]).astype({"block": "int32"})

        return asking.mapInPandas(blocks, ASKING)

    def best(self, asking: DataFrame, same: bool, k: int) -> DataFrame:
        """(anchor_id, row, window, vec_id, score, rank) of the ``k`` best rows of
        each anchor's windows; ``row`` tells apart anchors of equal vec_id."""
        own = ["anchor_id", "row", "window"]
        ranked = F.row_number().over(Window.partitionBy(*own).orderBy(F.desc("score"), "vec_id"))

        def top(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", ranked).where(F.col("rank") <= k)

        begun = stage(top(self.visit(self.choose(asking, True), same, k)))
        full = begun.where(F.col("rank") == k).groupBy("anchor_id", "row").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
        higher = F.transform("lo", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("reached", w), x)))
        raised = asking.join(full, ["anchor_id", "row"], "left").withColumn("lo", F.when(F.col("reached").isNull(), F.col("lo")).otherwise(higher)).drop("reached")
        rest = self.visit(self.choose(raised.select(*asking.columns), False), same, k)
        return stage(top(begun.drop("rank").unionByName(rest)))

    def visit(self, chosen: DataFrame, same: bool, k: int) -> DataFrame:
        chosen = stage(chosen)
        crowds = chosen.groupBy("block").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("groups"))
        group = F.pmod(F.xxhash64(F.lit(4), "anchor_id", "row"), F.col("groups")).cast("int").alias("group")
        every = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")
        none = F.lit(None).cast("array<long>")
        seeking = chosen.join(crowds, "block").select("block", group, F.lit(True).alias("asking"), "anchor_id", "row", "label", "point", "lo", "hi")
        held = self.rows.join(crowds, "block").select(
            "block", every, F.lit(False).alias("asking"), F.col("vec_id").alias("anchor_id"), F.lit(0).cast("long").alias("row"), "label", "point",
            none.alias("lo"), none.alias("hi"),
        )

        def search(frame: pd.DataFrame) -> pd.DataFrame:
            asked, own = frame[frame["asking"]], frame[~frame["asking"]]
            columns = ["anchor_id", "row", "window", "vec_id", "score"]
            if not len(asked) or not len(own):
                return pd.DataFrame({c: [] for c in columns})
            tree = CoverTree(own["anchor_id"].to_numpy(np.int64), own["label"].to_numpy(np.int64), np.stack(own["point"].to_list()).astype(np.int64))
            anchors, rows = Anchors(asked), asked["row"].to_numpy(np.int64)
            found = [(anchors.ids[i], rows[i], w, name, score) for i, w, name, score in tree.best(anchors, same, k)]
            return pd.DataFrame(found, columns=columns)

        return held.unionByName(seeking).groupBy("block", "group").applyInPandas(search, "anchor_id long, row long, window int, vec_id long, score long")


def whole(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and point (floor(scale * x) of every component) of the rows that take part."""
    row = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    ).where("vec_id is not null and label is not null and vector is not null")
    fine = row.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usual = fine.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    point = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    return fine.where(F.size("vector") == (usual["d"] if usual else 0)).select("vec_id", "label", point.alias("point"))


def hundredth(x: Column) -> Column:
    """floor(x / 100) in whole numbers."""
    return int_div(x - F.pmod(x, F.lit(100)), 100)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Hard negatives for the rows of ``vectors`` (vec_id, label, embedding) that
    ``anchor`` names, a condition on vec_id, label and point: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of the vectors ``floor(scale * x)``, in whole
    numbers; equal ones go to the smaller vec_id. Positives are the first
    ``positives`` rows of the anchor's label but for those of its own vec_id.
    Negatives are the first ``negatives`` rows of other labels with
    ``low`` * positive <= 100 * negative <= ``high`` * positive, so positives
    below zero have none. Rows take no part if vec_id, label or embedding is
    null, the vector's length is not the usual one, or a component is null or not
    finite; zero vectors do. Products must fit 64 bits. Rows that repeat vec_id,
    label and vector count once; a vec_id with several vectors or labels is
    several rows. Other columns are ignored; an empty table gives no rows.
    """
    rows = stage(whole(vectors, scale).distinct())
    search = Search(rows)
    all_scores = [F.array(F.lit(end).cast("long")).alias(name) for end, name in ((LOWEST, "lo"), (HIGHEST, "hi"))]
    anchors = rows.where(anchor).select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "point").alias("row"), "label", "point", *all_scores)
    found = search.best(anchors, True, positives).select("anchor_id", "row", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    lo, hi = -hundredth(-low * F.col("positive_score")), hundredth(high * F.col("positive_score"))
    ordered = F.sort_array(F.collect_list(F.struct("nth", lo.alias("lo"), hi.alias("hi"))))
    windows = found.groupBy("anchor_id", "row").agg(ordered.alias("w"))
    asking = anchors.drop("lo", "hi").join(windows, ["anchor_id", "row"]).select("anchor_id", "row", "label", "point", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    hard = search.best(asking, False, negatives).select("anchor_id", "row", (F.col("window") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(hard, ["anchor_id", "row", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_hundredth(vectors: DataFrame) -> DataFrame:
    """:func:`mine` for anchors whose vec_id is divisible by 100; every seventh
    vec_id first moves to the next of ten labels."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
