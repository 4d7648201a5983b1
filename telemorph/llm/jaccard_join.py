"""Documents linked by the Jaccard coefficient of their n-gram sets.

A document's set holds the hashes of its distinct ``n``-word shingles. Equal
sets form a class, and only classes are joined:

1. Deal. Two sets of similarity t differ in at most D = (1 - t) / (1 + t) *
   (|A| + |B|) shingles, D bounded by their size class. The shingles are cut by
   hash range into more than D cells, so at least one cell holds the same
   shingles in both. Every
   class pairs with the smallest of each cell only, never all with all, and is
   compared with those of them it shares most cells with. Of a cell that many
   classes of one batch share only a few meet in the cell's task, so that task
   grows with the batches, not with the members.
2. Bound. Shingles are hashed into ``GROUPS`` groups; the counts per group are a
   point. Two sets share at most the sum of the smaller coordinates, which
   drops pairs before their shingles are compared. What the tree finds is bounded
   again by finer groups, which large sets need.
   Linked classes share many cells, so those that share few with all others
   leave.
3. Search. Linked classes meet in the cells of each that have the fewest members,
   so only those are searched. Cells whose members the links found so far leave in
   one component are done. In all others the members outside the largest component are searched in
   an R-tree of count vectors over the cell, block by block: a node's box bounds
   the overlap with everything below it, points bound it again. What survives
   names two components that may be linked; their surviving members are verified
   against the shingles until a link is found. As long as that finds links, a
   member only names the nearest and the first of those it meets in other
   components: a group whose members are linked among each other grows together
   in few rounds, without its pairs. One search for all that survives ends it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemorph.llm.components import components
from telemorph.llm.hashing import U, combine, mix, token_hashes
from telemorph.llm.shared import only_with, stage, text_pieces, without

#: Coordinates of a point, and of the fine one that what the tree finds must pass too.
GROUPS, FINE = 64, 512
#: Points of an R-tree leaf, and leaves below a node.
LEAF, FAN = 32, 16
#: Sets from which on no cells need to be nearly empty for a pair to be found.
LARGE = 128
#: Classes that one is compared with first: those it shares most cells with.
FIRST = 3
#: Members of a cell that one batch sends to the cell's task; further ones go past it.
FEW = 4
#: Bytes of texts whose cell keys a task packs together, and of those that are Python
#: strings and shingles at once.
HELD, SLICE = 4 << 20, 1 << 20
#: Ranges that are none: of sketches, and of members past a cell's task.
SKETCH, PAST = -2, -1
#: Members of a cell, and members outside its largest component, searched at once.
BLOCK, SEARCH_BLOCK = 4096, 1024
#: Of these, members that go down a tree together, and pairs of vectors compared at once.
TOGETHER, COMPARED = 64, 4096


def shingle_sets(texts: list, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text. A text of fewer than
    ``n`` words has its whole sequence as one; without words it has none."""
    tokens, offsets = token_hashes(texts)
    whole = tokens
    for i in range(1, n):
        if len(whole) > 1:
            whole = combine(whole[:-1], tokens[i:])
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= n:
            yield np.unique(whole[a : b - n + 1])
        elif b > a:
            short = tokens[a]
            for token in tokens[a + 1 : b]:
                short = combine(np.array([short]), np.array([token]))[0]
            yield mix(np.array([short ^ U(b - a)]))
        else:
            yield np.zeros(0, U)


def sliced_sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    """:func:`shingle_sets` of a batch's texts, of which a slice is held at a time."""
    for part in text_pieces(iter([batch]), SLICE):
        yield from shingle_sets(part.column("text").to_pylist(), n)


def digest(shingles: np.ndarray) -> int:
    """One 64-bit number for a set, from its sorted shingles."""
    with np.errstate(over="ignore"):
        total = mix(shingles + U(0x51)).sum(dtype=U) * U(3) + mix(shingles ^ U(0xABCDEF)).sum(dtype=U)
    return int(mix(np.array([total + U(len(shingles))])).view(np.int64)[0])


class Rule:
    """Jaccard >= numerator / denominator, in whole numbers."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.ratio = percent / 100

    def size_class(self, size: int) -> int:
        """Sets of one pair lie in the same class or in neighbouring ones."""
        return int(np.floor(np.log(size) / -np.log(self.ratio) + 1e-9))

    def most_differing(self, size_class: int) -> int:
        """Shingles in which two linked sets of this class and the one below can differ."""
        largest = self.ratio ** -(size_class + 1) + 1
        return int(2 * largest * (100 - self.percent) / (100 + self.percent) + 1e-6)

    def linked(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)

    def needed(self, sizes: np.ndarray) -> np.ndarray:
        """The least overlap of a linked pair, from the added sizes."""
        return -(-self.percent * sizes // (100 + self.percent))


def cells(shingles: np.ndarray, rule: Rule) -> tuple[np.ndarray, list[int]]:
    """Keys of one set: for its own size class and the next, one for the content
    of each cell, the class's last bit in bit 16. Any two linked sets that differ
    share as many keys of one class as they fill cells beyond the shingles that
    can differ: those numbers, for even and odd classes, come with the keys.

    With D differing shingles all but D cells are equal in both. Empty cells say
    nothing and are left out, so a set must fill more than D of them. Large sets
    do: that 128 or more hashes fall into D of 1.6 D cells is as likely as a
    collision of two hashes. Small sets are cut into more cells, and if nearly the
    whole set (all but D shingles) still lies in D of them, the empty ones count
    too; if that holds for one set of a pair in its strict form (all of it in D
    cells), it holds in this form for the other.
    """
    keys, needed = [], [1 << 30, 1 << 30]
    own = rule.size_class(len(shingles))
    sums = np.zeros(len(shingles) + 1, U)
    np.cumsum(mix(shingles ^ U(0x77)), out=sums[1:])
    for size_class in (own, own + 1):
        differ = rule.most_differing(size_class)
        if differ < 1:
            continue  # linked sets of this size are equal
        large = rule.ratio ** -(size_class - 1) >= LARGE
        count = int(np.ceil(1.6 * differ)) + 2 if large else 4 * differ + 12
        edges = (np.arange(1, count, dtype=U) * U((1 << 64) // count)).astype(U)
        at = np.r_[0, np.searchsorted(shingles, edges), len(shingles)]
        sizes = np.diff(at)
        with np.errstate(over="ignore"):
            content = sums[at[1:]] - sums[at[:-1]]
            names = mix(np.arange(count, dtype=U) + U(size_class) * U(1 << 32))
        found = (combine(content, names) & U((1 << 64) - 1 - (1 << 16))) | U((size_class & 1) << 16)
        needed[size_class & 1] = max(1, int((sizes > 0).sum()) - differ)
        concentrated = not large and np.sort(sizes)[::-1][:differ].sum() >= len(shingles) - differ
        keys.append(found if concentrated else found[sizes > 0])
    return np.concatenate(keys) if keys else np.zeros(0, U), needed


def points(shingles: np.ndarray) -> np.ndarray:
    """Shingles per fine group; the groups cut across the cells."""
    return np.bincount((mix(shingles) % U(FINE)).astype(np.int64), minlength=FINE)


def coarse(fine: np.ndarray) -> np.ndarray:
    """Points of ``GROUPS`` coordinates from fine ones, whose groups they unite."""
    return fine.reshape(*fine.shape[:-1], FINE // GROUPS, GROUPS).sum(-2, dtype=np.int64)


def packed(fine: np.ndarray) -> bytes:
    """A fine point in one byte a coordinate, or in two or four where counts need them."""
    most = fine.max(initial=0)
    return fine.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def unpacked(fine: bytes) -> np.ndarray:
    return np.frombuffer(fine, {FINE: np.uint8, 2 * FINE: np.uint16}.get(len(fine), np.uint32))


def dense(cells: DataFrame, sketches: DataFrame) -> DataFrame:
    """Cells without the classes that share too few with any others to link, and
    without the cells that are then left to one class."""
    odd = F.col("cell") % 2 != 0
    needed = sketches.where("n_shingles > 0").groupBy("digest").agg(F.first("even").alias("even"), F.first("odd").alias("odd"))
    shared = cells.groupBy("digest", odd.alias("is_odd")).agg(F.count("*").alias("n")).join(needed, "digest")
    alive = shared.where(F.col("n") >= F.when(F.col("is_odd"), F.col("odd")).otherwise(F.col("even"))).select("digest", "is_odd")
    left = cells.select("cell", "digest", odd.alias("is_odd")).join(alive, ["digest", "is_odd"], "left_semi").drop("is_odd")
    several = left.groupBy("cell").agg(F.min("digest").alias("least"), F.max("digest").alias("most"), F.count("*").alias("members")).where("least <> most")
    return left.join(several.select("cell", "least", "members"), "cell").select("cell", "digest", "least", "members")


def rarest(cells: DataFrame, sketches: DataFrame) -> DataFrame:
    """The cells in which linked classes are sure to meet. Two classes that share
    at least ``needed`` cells, of n that one of them has, share one of the
    n - needed + 1 of it that have the fewest members, and likewise of the other.
    Passages that many documents hold fill cells with many members, which few
    classes then have to look for links in."""
    needed = sketches.where("n_shingles > 0").groupBy("digest").agg(F.first("even").alias("even"), F.first("odd").alias("odd"))
    rows = cells.select("cell", "digest", "members", (F.col("cell") % 2 != 0).alias("is_odd")).join(needed, "digest")
    own = Window.partitionBy("digest", "is_odd")
    ranked = rows.withColumn("n", F.count("*").over(own)).withColumn("nth", F.row_number().over(own.orderBy("members", "cell")))
    return ranked.where(F.col("nth") <= F.col("n") - F.when(F.col("is_odd"), F.col("odd")).otherwise(F.col("even")) + 1).select("cell", "digest")


def linked_classes(docs: DataFrame, n: int, rule: Rule, parts: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, n_shingles, digest) per document, and the links (a, b) between
    classes of equal sets that make up the components. ``row`` tells rows apart
    that differ in doc_id or text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    nothing = (1 << 30, 1 << 30)

    def dealt(id_type: pa.DataType, columns: list) -> pa.RecordBatch:
        types = [id_type, *[pa.int64()] * 3, *[pa.int32()] * 3, pa.int64(), pa.binary(), pa.binary()]
        length = next(len(c) for c in columns if c is not None)
        arrays = [pa.nulls(length, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "row", "n_shingles", "digest", "even", "odd", "part", "lane", "keys", "owners"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass over the texts: a sketch of every document, and the cell keys
        of every set packed by hash range."""
        for batch in text_pieces(batches, HELD):
            keys, owners, needed, sizes, names = [], [], {0: nothing}, [], []
            for s in sliced_sets(batch, n):
                name = digest(s) if len(s) else 0
                if name not in needed:
                    found, needed[name] = cells(s, rule)
                    keys.append(found)
                    owners.append(np.full(len(found), name, np.int64))
                sizes.append(len(s))
                names.append(name)
            ids, rows = batch.column("doc_id"), batch.column("row")
            least = [[needed[name][i] for name in names] for i in (0, 1)]
            lane = zlib.crc32(np.array(names, np.int64).tobytes())
            yield dealt(ids.type, [ids, rows, sizes, names, *least, [SKETCH] * len(names), [lane] * len(names), None, None])
            keys = np.concatenate(keys) if keys else np.zeros(0, U)
            owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], owners[order]
            bounds = np.searchsorted(keys, (np.arange(parts, dtype=U) * U((1 << 64) // parts)).astype(U))
            part = np.repeat(np.arange(parts), np.diff(np.r_[bounds, len(keys)]))
            nth = np.arange(len(keys)) - np.searchsorted(keys, keys)
            keys = (keys >> U(16)).astype(np.uint32)  # within a part the next bits tell cells apart; a false pair is verified like any other
            # A cell that fills up within a batch has several members whatever other
            # batches hold: those beyond the first few need not meet the rest in one task.
            past = nth >= FEW
            rows = []
            if past.any():
                past_owners = owners[past].tobytes()
                rows.append((PAST, zlib.crc32(past_owners), ((part[past] << 32) + keys[past].astype(np.int64)).tobytes(), past_owners))
            part, keys, owners = part[~past], keys[~past], owners[~past]
            bounds = np.searchsorted(part, np.arange(parts + 1))
            rows += [(p, 0, keys[a:b].tobytes(), owners[a:b].tobytes()) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
            if rows:
                yield dealt(ids.type, [None] * 6 + [list(column) for column in zip(*rows, strict=True)])

    def crowded(rows: pd.DataFrame) -> pd.DataFrame:
        """Sketches as they are, and of the cells those with several members."""
        columns = ["doc_id", "row", "n_shingles", "digest", "even", "odd"]
        if rows["part"].iloc[0] == SKETCH:
            return rows[columns].assign(cell=None)
        owners = np.concatenate([np.frombuffer(x, np.int64) for x in rows["owners"]])
        if rows["part"].iloc[0] == PAST:
            found = pd.DataFrame({"cell": np.concatenate([np.frombuffer(x, np.int64) for x in rows["keys"]]), "digest": owners})
            return found.assign(doc_id=None, row=None, n_shingles=None, even=None, odd=None)
        keys = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["keys"]])
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[first, len(keys)])
        cell = (int(rows["part"].iloc[0]) << 32) + keys.astype(np.int64)
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]
        several = np.repeat(np.maximum.reduceat(owners, first) != owners[first], sizes)
        found = pd.DataFrame({"cell": cell[fresh & several], "digest": owners[fresh & several]})
        return found.assign(doc_id=None, row=None, n_shingles=None, even=None, odd=None)

    body = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    drawn = f"doc_id {kind}, row long, n_shingles long, digest long, even int, odd int"
    drawn_cells = body.mapInArrow(deal, f"{drawn}, part int, lane long, keys binary, owners binary")
    # Copies of a text in several batches repeat a member; that only makes its cells look fuller.
    read = stage(drawn_cells.repartition(parts, "part", "lane").groupBy("part", "lane").applyInPandas(crowded, f"{drawn}, cell long"))
    sketches = read.where("cell is null").drop("cell")
    filled = stage(dense(dense(read.where("cell is not null").select("cell", "digest"), sketches), sketches))
    pairs = stage(filled.where("digest <> least").groupBy(F.col("digest").alias("a"), F.col("least").alias("b")).agg(F.count("*").alias("n")))

    # The shingles of one document of every class in a pair.
    involved = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    chosen = sketches.where("n_shingles > 0 and doc_id is not null").join(involved, "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))

    def points_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64())]
        for batch in text_pieces(batches, SLICE):
            sets = ((s, points(s)) for s in shingle_sets(batch.column("text").to_pylist(), n))
            rows = [(digest(s) if len(s) else 0, len(s), coarse(fine).astype(np.int32), packed(fine), s.view(np.int64)) for s, fine in sets]
            columns = [pa.array(list(column), t) for column, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "size", "point", "fine", "shingles"])

    with_text = only_with(body.select("doc_id", "text"), "doc_id", stage(chosen.select("doc_id")))
    sets = with_text.select("text").mapInArrow(points_of, "digest long, size long, point array<int>, fine binary, shingles array<long>")
    sets = stage(sets.join(chosen.select("digest"), "digest", "left_semi").dropDuplicates(["digest"]))

    # Bound by the points alone, then compare shingles.
    narrow = sets.select("digest", "size", "point")
    least = F.aggregate(F.zip_with("point_a", "point_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    first = pairs.withColumn("nth", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b"))).where(F.col("nth") <= FIRST)
    bounded = (
        first.join(narrow.select(F.col("digest").alias("a"), F.col("size").alias("size_a"), F.col("point").alias("point_a")), "a")
        .join(narrow.select(F.col("digest").alias("b"), F.col("size").alias("size_b"), F.col("point").alias("point_b")), "b")
        .where(least * (100 + rule.percent) >= rule.percent * (F.col("size_a") + F.col("size_b")))
        .select("a", "b", "size_a", "size_b")
    )
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    verified = (
        bounded.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("shingles_a")), "a")
        .join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("shingles_b")), "b")
        .where(100 * both >= rule.percent * (F.col("size_a") + F.col("size_b") - both))
        .select("a", "b")
    )
    links = stage(verified)
    searched = stage(rarest(filled, sketches))
    while True:
        fresh = stage(search_cells(searched, links, sets, rule, parts, every=False))
        if fresh.isEmpty():
            break
        links = links.union(fresh)
    return sketches, links.union(search_cells(searched, links, sets, rule, parts, every=True))


def search_cells(cells: DataFrame, links: DataFrame, sets: DataFrame, rule: Rule, parts: int, every: bool) -> DataFrame:
    """Links between members of a cell that ``links`` leave apart: with ``every``
    enough to join what belongs together, else those of the first and the nearest
    that each member meets."""
    linked = components(links).select(F.col("node").alias("digest"), F.col("root").alias("part"))
    members = cells.join(linked, "digest", "left").withColumn("part", F.coalesce("part", "digest"))
    sizes = members.groupBy("cell", "part").agg(F.count("*").alias("n"))
    split = sizes.groupBy("cell").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("members"), F.max("n").alias("largest"))
    blocks, searches = F.ceil(F.col("members") / BLOCK), F.ceil((F.col("members") - F.col("largest")) / SEARCH_BLOCK)
    open_cells = split.where("parts > 1").select("cell", "main", blocks.cast("int").alias("blocks"), searches.cast("int").alias("searches"))
    todo = stage(members.join(open_cells, "cell"))
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    search = F.pmod(F.xxhash64(F.lit(1), "digest"), F.col("searches")).cast("int")
    columns = ["digest", "cell", "part"]
    indexed = todo.select(*columns, F.lit(False).alias("asking"), block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("searches") - 1)).alias("search"))
    asking = todo.where("part <> main").select(*columns, F.lit(True).alias("asking"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), search.alias("search"))
    bucket = F.pmod(F.xxhash64("cell", "block", "search"), F.lit(parts)).alias("bucket")
    rows = indexed.union(asking).select(bucket, "*").join(sets.select("digest", "fine"), "digest")

    def bound(rows: pd.DataFrame) -> pd.DataFrame:
        names, parts, fine = (rows[c].to_numpy() for c in ("digest", "part", "fine"))
        found = [np.zeros((0, 4), np.int64)]
        for held, asked in sides(rows, ["cell", "block", "search"], rows["asking"].to_numpy()):
            found.append(near_parts(names, parts, fine, held, asked, rule, every))
        return pd.DataFrame(np.concatenate(found), columns=["p", "q", "digest", "part"]).drop_duplicates()

    near = rows.groupBy("bucket").applyInPandas(bound, "p long, q long, digest long, part long").distinct()
    both = F.pmod(F.xxhash64("p", "q"), F.lit(parts)).alias("bucket")
    compared = near.select(both, "*").join(sets.select("digest", "point", "shingles"), "digest")

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        names, points, sets = (rows[c].to_numpy() for c in ("digest", "point", "shingles"))
        both = sides(rows, ["p", "q"], (rows["part"] != rows["p"]).to_numpy())
        found = [link for left, right in both if (link := first_link(names, points, sets, left, right, rule))]
        return pd.DataFrame(found, columns=["a", "b"])

    return compared.groupBy("bucket").applyInPandas(verify, "a long, b long")


def sides(rows: pd.DataFrame, keys: list[str], second: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the first and of the second kind of rows of every group that
    has both. Most groups have a few rows only: none is cut out as a frame."""
    columns = [rows[key].to_numpy() for key in keys]
    order = np.lexsort((second, *columns))
    edge = np.zeros(max(len(order) - 1, 0), bool)
    for column in columns:
        edge |= np.diff(column[order]) != 0
    starts = np.flatnonzero(np.r_[True, edge]) if len(order) else np.zeros(0, np.int64)
    seconds = np.r_[0, np.cumsum(second[order])]
    for a, b in zip(starts, np.r_[starts[1:], len(order)], strict=True):
        middle = b - (seconds[b] - seconds[a])
        if a < middle < b:
            yield order[a:middle], order[middle:b]


def overlaps(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Summed smaller coordinates of pairs of rows, some pairs at a time."""
    found = np.zeros(len(i), np.int64)
    for a in range(0, len(i), COMPARED):
        some = slice(a, a + COMPARED)
        found[some] = np.minimum(left[i[some]], right[j[some]]).sum(1, dtype=np.int64)
    return found


class Tree:
    """R-tree over count vectors, packed level by level after sorting by tiles."""

    def __init__(self, vectors: np.ndarray) -> None:
        order = np.lexsort((vectors[:, 0], vectors[:, 1] // 4, vectors.sum(1) // 8))
        self.order, self.vectors = order, vectors[order]
        self.sizes = self.vectors.sum(1, dtype=np.int64)
        self.levels = []
        low, high, width = self.vectors, self.vectors, LEAF
        while True:
            starts = np.arange(0, len(low), width)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((low.sum(1, dtype=np.int64), high, width))
            if len(high) == 1:
                break
            width = FAN

    def search(self, vectors: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
        """Positions (of a vector, of a point) of all whose summed smaller
        coordinates reach the overlap that a linked pair of these sizes needs, in
        the order of the vectors. They go down the tree level by level together."""
        sizes = vectors.sum(1, dtype=np.int64)
        asked, inside = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            least_size, high, width = self.levels[depth]
            near = overlaps(high, vectors, inside, asked) >= rule.needed(sizes[asked] + least_size[inside])
            below = len(self.levels[depth - 1][1]) if depth else len(self.vectors)
            asked, inside = np.repeat(asked[near], width), (inside[near][:, None] * width + np.arange(width)).ravel()
            asked, inside = asked[inside < below], inside[inside < below]
        near = overlaps(self.vectors, vectors, inside, asked) >= rule.needed(sizes[asked] + self.sizes[inside])
        return asked[near], self.order[inside[near]]


def near_parts(names: np.ndarray, parts: np.ndarray, points: np.ndarray, held: np.ndarray, asked: np.ndarray, rule: Rule, every: bool) -> np.ndarray:
    """Rows (p, q, digest, part) for members of two parts of a cell, p < q, that the
    points, coarse in the tree and then fine, do not keep apart: ``every`` such
    pair, or for each asking member its nearest by the bound and the one with the
    smallest digest."""
    fine = np.stack([unpacked(x) for x in points[held]])
    tree, sizes = Tree(coarse(fine)), fine.sum(1, dtype=np.int64)
    found = [np.zeros((0, 4), np.int64)]
    for first in range(0, len(asked), TOGETHER):
        some = asked[first : first + TOGETHER]
        vectors = np.stack([unpacked(x) for x in points[some]])
        own = vectors.sum(1, dtype=np.int64)
        by, at = tree.search(coarse(vectors), rule)
        apart = parts[held[at]] != parts[some[by]]
        by, at = by[apart], at[apart]
        least = overlaps(fine, vectors, at, by)
        near = least >= rule.needed(own[by] + sizes[at])
        by, at, least = by[near], at[near], least[near]
        if not every and len(by):
            nearest = np.lexsort((-least / (sizes[at] + own[by]), by))
            smallest = np.lexsort((names[held[at]], by))
            firsts = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
            kept = np.bincount(by, minlength=len(some))[by] <= 2
            kept[nearest[firsts]] = kept[smallest[firsts]] = True
            by, at = by[kept], at[kept]
        mine, other = some[by], held[at]
        p, q = np.minimum(parts[mine], parts[other]), np.maximum(parts[mine], parts[other])
        pairs = [np.stack([p, q, names[x], parts[x]], 1) for x in (mine, other)]
        found.append(np.unique(np.concatenate(pairs), axis=0) if len(by) else found[0])
    return np.concatenate(found)


def first_link(names: np.ndarray, points: np.ndarray, sets: np.ndarray, left: np.ndarray, right: np.ndarray, rule: Rule) -> tuple[int, int] | None:
    """A link between the members of two parts, if there is one."""
    tree = Tree(np.stack(points[right]).astype(np.int64))
    for first in range(0, len(left), TOGETHER):
        some = left[first : first + TOGETHER]
        for by, at in zip(*tree.search(np.stack(points[some]).astype(np.int64), rule), strict=True):
            mine, other = np.asarray(sets[some[by]]), np.asarray(sets[right[at]])
            if rule.linked(len(np.intersect1d(mine, other, assume_unique=True)), len(mine), len(other)):
                return int(names[some[by]]), int(names[right[at]])
    return None


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, parts: int | None = None) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, n_shingles and
    component_id, the smallest doc_id that links reach.

    Two documents link when the Jaccard coefficient of their sets of ``n``-word
    shingles is ``percent`` / 100 or more, decided in whole numbers. Words are
    compared after lower-casing A to Z. Null, empty and blank texts have an
    empty set and link with nothing; equal sets always link. Rows that repeat a
    doc_id each come out, and rows without doc_id stand alone with a null
    component_id. Other columns are ignored. ``parts``: hash ranges of the cell
    keys, by default eight for each shuffle partition.
    """
    spark = docs.sparkSession
    parts = parts or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketches, links = linked_classes(docs, n, Rule(percent), parts)
    roots = components(links).select(F.col("node").alias("digest"), "root")
    found = sketches.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"))
    named = found.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(lowest, "root").select("digest", "component_id")
    labelled = sketches.join(labels, "digest", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return labelled.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def labelled_rows(docs: DataFrame, n: int, percent: int, parts: int | None = None) -> DataFrame:
    """doc_id, row, n_shingles, digest and root (the component's smallest class) of every row of ``docs``."""
    parts = parts or 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketches, links = linked_classes(docs, n, Rule(percent), parts)
    roots = components(links).select(F.col("node").alias("digest"), "root")
    classes = sketches.where("n_shingles > 0").select("digest").distinct().join(roots, "digest", "left")
    named = classes.select("digest", F.coalesce("root", "digest").alias("root"))
    return sketches.select("doc_id", "row", "n_shingles", "digest").join(stage(named), "digest", "left")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near copies: of every component the row with the smallest
    doc_id stays (null ids last, then by the row's hash), whatever ids its rows
    repeat. Rows that repeat doc_id and text of the one that stays go as well.
    Rows without words all stay. An empty table gives no rows; other columns are
    carried along, and may have any names but ``_row``."""
    rows = stage(labelled_rows(docs, n, percent).where("n_shingles > 0").select("root", "row", "doc_id"))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    kept = rows.groupBy("root").agg(F.min(first)["row"].alias("kept"))
    counted = stage(rows.groupBy("root", "row").agg(F.count("*").alias("n")).join(kept, "root").select("row", (F.col("row") == F.col("kept")).alias("stays"), "n"))
    gone = counted.where("not stays").select(F.col("row").alias("_row"))
    keyed = without(docs.withColumn("_row", F.xxhash64("doc_id", "text")), "_row", gone)
    repeated = counted.where("stays and n > 1").select(F.col("row").alias("_row"))
    once = without(keyed, "_row", repeated).unionByName(only_with(keyed, "_row", repeated).dropDuplicates(["_row"]))
    return once.drop("_row")
