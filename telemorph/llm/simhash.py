"""Near copies by SimHash and multi-index hashing.

A text's fingerprint has a bit for each of 64 hash bits: whether more than half
of its shingles' hashes set it. Fingerprints that differ in few bits link.

1. Equal fingerprints are one node; only distinct ones are indexed.
2. Index. A fingerprint is cut into segments, each with a radius; the radii are
   chosen so that, differing in at most ``radius`` bits in all, two fingerprints
   are within the radius of some segment (adding one to each radius gives more
   than ``radius`` in all). Every fingerprint stands in each segment's table
   under its segment's value, and asks for all values in the Hamming ball around
   it. Of two values that differ, only the smaller one asks, so a pair meets once
   a segment. A pair of segments suits small tables, more of them smaller ones:
   what a table returns and what is asked is weighed by :func:`layout`.
3. Stars. Every member and asker of an entry is compared with the entry's
   smallest member: a grouping and a join, whatever the entry's size. This
   already gathers dense groups of near copies.
4. Rest. Of entries whose rows the stars leave apart, rows outside the entry's
   largest component meet all its rows, block by block, so no task holds more
   than two blocks of an entry. Complete distances are verified there, and each
   task gives enough links to join what belongs together instead of all pairs.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.llm.components import components
from telemorph.llm.language_model import pieces
from telemorph.llm.shared import stage

BITS, SEED = 64, 42
#: Words are maximal runs of bytes other than space and tab to carriage return.
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text cut into words at once, and characters of texts held at once.
PIECE, HELD = 1 << 20, 2 << 20
#: Rows of an entry that meet at once, and pairs compared at once.
BLOCK, PAIRS = 4096, 1 << 20
#: Rows of entries that one task verifies, about.
TASK = 1 << 18


def shingle_hashes(text: str | None, n: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the text's ``n``-word shingles, repeats included, in
    arrays of bounded size. Fewer than ``n`` words are one shingle, none give none."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    held: list[bytes] = []
    at, given = 0, False
    while at < len(raw):
        end = BLANK.search(raw, at + PIECE)
        cut = end.start() if end else len(raw)
        held += WORDS.findall(raw, at, cut)
        at = cut
        if len(held) >= n:
            joined, lengths = b" ".join(held), np.array([len(w) + 1 for w in held])
            ends = np.cumsum(lengths)
            spans = zip((ends - lengths).tolist(), (ends[n - 1 :] - 1).tolist(), strict=False)
            yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(held) - n + 1)
            held, given = held[len(held) - n + 1 :], True
    if held and not given:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: str | None, n: int) -> int:
    """The text's fingerprint as a signed 64-bit number; 0 without words."""
    total, votes = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(text, n):
        total += len(hashes)
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<i8")[0])


def layout(nodes: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of the segments, for a number of distinct
    fingerprints: of all numbers of segments the one with the least work, which
    is one for each value asked and for each fingerprint returned. Any layout
    finds all links."""

    def cut(count: int) -> list[tuple[int, int, int]]:
        edges = [BITS * i // count for i in range(count + 1)]
        spare = radius - count + 1
        radii = [spare // count + (i < spare % count) for i in range(count)]
        return [(a, b - a, r) for a, b, r in zip(edges[:-1], edges[1:], radii, strict=True)]

    def work(segments: list[tuple[int, int, int]]) -> float:
        return sum(sum(comb(w, k) for k in range(r + 1)) * (1 + nodes / 2**w) for _, w, r in segments)

    return min((cut(count) for count in range(1 if radius == 0 else 2, radius + 2)), key=work)


def entries(nodes: DataFrame, segments: list[tuple[int, int, int]]) -> DataFrame:
    """(segment, value, fp, member): every node in each table, and what it asks for."""

    def row(number: int, value: Column, member: bool) -> Column:
        return F.struct(F.lit(number).alias("segment"), value.alias("value"), F.lit(member).alias("member"))

    def of_segment(number: int, shift: int, width: int, radius: int) -> Column:
        value = F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1 if width < BITS else -1)
        flips = [sum(1 << bit for bit in chosen) for k in range(1, radius + 1) for chosen in itertools.combinations(range(width), k)]
        own = F.array(row(number, value, True))
        if not flips:
            return own
        ball = F.transform(F.array(*[F.lit(flip).cast("long") for flip in flips]), lambda flip: value.bitwiseXOR(flip))
        return F.concat(own, F.transform(F.filter(ball, lambda v: v > value), lambda v: row(number, v, False)))

    every = F.concat(*[of_segment(i, *segment) for i, segment in enumerate(segments)])
    return nodes.select("fp", F.explode(every).alias("at")).select("at.segment", "at.value", "fp", "at.member")


def near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def joined(rows: pd.DataFrame, radius: int) -> Iterator[tuple[int, int]]:
    """Links that join the components of ``rows`` (entry, fp, part, member,
    asking) which verified pairs of an entry connect; one of a pair asks and one
    is a member of the table."""
    rows = rows.sort_values("entry", kind="stable")
    held, asking = rows[~rows["asking"]], rows[rows["asking"]]
    codes, parts, member, at = (held[c].to_numpy() for c in ("fp", "part", "member", "entry"))
    first, last = np.searchsorted(at, asking["entry"], "left"), np.searchsorted(at, asking["entry"], "right")
    reach = np.cumsum(last - first)
    own, own_part, own_member = (asking[c].to_numpy() for c in ("fp", "part", "member"))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = root[x]
        return x

    start = 0
    while start < len(own):
        stop = max(start + 1, int(np.searchsorted(reach, (reach[start - 1] if start else 0) + PAIRS, "right")))
        widths = (last - first)[start:stop]
        i = np.repeat(np.arange(start, stop), widths)
        j = np.arange(len(i)) - np.repeat(np.cumsum(widths) - widths, widths) + np.repeat(first[start:stop], widths)
        hit = np.bitwise_count((own[i] ^ codes[j]).view(np.uint64)) <= radius
        hit &= (own_part[i] != parts[j]) & (own_member[i] | member[j])
        for a, b in zip(i[hit].tolist(), j[hit].tolist(), strict=True):
            p, q = find(int(own_part[a])), find(int(parts[b]))
            if p != q:
                root[max(p, q)] = min(p, q)
                yield int(own[a]), int(codes[b])
        start = stop


def link_fingerprints(nodes: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(node, root) for every one of the distinct fingerprints ``nodes`` (fp) that
    links with another: root is the smallest of those that links reach.
    ``block``: rows of an entry that meet at once."""
    segments = layout(nodes.count(), radius)
    rows = entries(nodes, segments)
    hubs = rows.groupBy("segment", "value").agg(F.min(F.when(F.col("member"), F.col("fp"))).alias("hub"), F.count("*").alias("n")).where("hub is not null and n > 1")
    # Entries without a member or with one row alone go before the second step.
    rows = stage(rows.join(hubs, ["segment", "value"]).select("segment", "value", "fp", "member", "hub"))
    stars = stage(rows.where((F.col("fp") != F.col("hub")) & near(F.col("fp"), F.col("hub"), radius)).select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct())

    gathered = stage(components(stars)).select(F.col("node").alias("fp"), F.col("root").alias("part"))
    placed = stage(rows.join(gathered, "fp", "left").select("segment", "value", "fp", "member", F.coalesce("part", "fp").alias("part")))
    sizes = placed.groupBy("segment", "value", "part").agg(F.count("*").alias("n"))
    split = sizes.groupBy("segment", "value").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.sum("n").alias("rows"), F.max("n").alias("largest"))
    outside = F.col("rows") - F.col("largest")
    apart = stage(
        split.where("rows > largest").select(
            "segment", "value", "main", "rows", outside.alias("outside"),
            F.ceil(F.col("rows") / block).cast("int").alias("blocks"), F.ceil(outside / block).cast("int").alias("searches"),
        )
    )
    meeting = apart.agg(F.sum(F.col("rows") * F.col("searches") + F.col("outside") * F.col("blocks")).alias("n")).first()["n"] or 0
    todo = placed.join(apart.select("segment", "value", "main", "blocks", "searches"), ["segment", "value"])
    counts = {"block": "blocks", "search": "searches"}
    place = {name: F.pmod(F.xxhash64(F.lit(seed), "fp"), F.col(counts[name])).cast("int") for name, seed in (("block", 1), ("search", 2))}

    def dealt(rows: DataFrame, asking: bool, block: Column, search: Column) -> DataFrame:
        entry = F.xxhash64("segment", "value", "block", "search")
        copies = rows.withColumn("block", block).withColumn("search", search)
        return copies.select(F.pmod(entry, F.lit(-(-meeting // TASK) or 1)).alias("task"), entry.alias("entry"), "fp", "part", "member", F.lit(asking).alias("asking"))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    held = dealt(todo, False, place["block"], every("searches"))
    seeking = dealt(todo.where("part <> main"), True, every("blocks"), place["search"])

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(joined(rows, radius)), columns=["a", "b"], dtype="int64")

    return components(stars.union(held.union(seeking).groupBy("task").applyInPandas(verify, "a long, b long")))


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pieces(batches, HELD):
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": [fingerprint(t, n) for t in batch["text"]]})

    return docs.select("doc_id", "text").mapInPandas(sketch, f"doc_id {kind}, fp long")


def near_copies(docs: DataFrame, n: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16
    lower-case hex digits) and component_id, the smallest doc_id that links reach.

    Two texts link if their fingerprints differ in at most ``radius`` of 64 bits;
    a bit is set if more than half of the XXH64 hashes (seed 42) of the text's
    ``n``-word shingles, repeats included, set it, so ties clear it. Words are
    compared after lower-casing A to Z. Texts of fewer than ``n`` words have one
    shingle; null, empty and blank texts the fingerprint 0, which links like any
    other. Repeated rows each come out. Rows without doc_id link too, but give no
    component its number: it is null where no row has one. Texts are read whole,
    piece by piece. Other columns are ignored; an empty table gives no rows.
    """
    sketches = stage(fingerprints(docs, n))
    nodes = stage(sketches.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = link_fingerprints(nodes.select("fp"), radius).select(F.col("node").alias("fp"), "root")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labels = stage(named.join(named.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id", "n"))
    # At most a thousand fingerprints can hold a thousandth of all rows each: these
    # are broadcast, so that rows of a frequent one need not meet in one partition.
    least = max(2, -(-(nodes.agg(F.sum("n").alias("n")).first()["n"] or 0) // 1000))
    frequent = labels.where(F.col("n") >= least).select("fp", F.col("component_id").alias("known"), F.lit(True).alias("is_frequent"))
    looked_up = sketches.join(F.broadcast(frequent), "fp", "left")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    often = looked_up.where("is_frequent").select("doc_id", shown, F.col("known").alias("component_id"))
    seldom = looked_up.where("is_frequent is null").select("doc_id", "fp").join(labels, "fp").select("doc_id", shown, "component_id")
    return often.unionByName(seldom)
