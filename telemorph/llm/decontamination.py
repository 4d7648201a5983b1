"""Benchmark passages in documents by spaced seeds.

A seed is a mask over neighbouring words: only the positions marked 1 are
hashed, the others may hold anything. Documents and benchmark items are hashed at
every position and joined on equal hashes; around each hit the two are laid side
by side, and a window of ``WINDOW`` words that covers the seed must agree in
``LEAST`` of them. Items shorter than the window are compared whole, with the
same share, by masks of their own.

However the words that may differ lie in a window, some mask of its width hits
only equal words, so no window that passes the comparison is missed.

Positions meet a bitmap of the benchmark's hashes first, of fixed size, inside the
array of the text, so that nearly all leave before they become rows; what passes is
joined exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.llm.shared import SLOTS, lower_ascii, stage, without, words

WINDOW, LEAST = 12, 9
# By width of the window, masks that hit every placement of the words that may differ.
MASKS_OF = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("11",), 5: ("111", "1101"), 6: ("1111", "11011"), 7: ("11011",),
    8: ("111", "1101"), 9: ("111",), 10: ("11101", "1111"), 11: ("11101",), WINDOW: ("11101", "10111"),
}
MASKS = tuple(sorted({mask for masks in MASKS_OF.values() for mask in masks}))


def hashes(text: Column) -> Column:
    """Hash of every word, A to Z lower-cased."""
    return F.transform(words(lower_ascii(text)), lambda w: F.xxhash64(w))


def width(item: Column) -> Column:
    """Words of an item's windows."""
    return F.least(F.lit(WINDOW), F.size(item))


def by_length(widths: list[int]) -> dict[int, list[int]]:
    """Numbers of the masks that windows of the ``widths`` need, by length."""
    used = [n for n, mask in enumerate(MASKS) if any(mask in MASKS_OF[w] for w in widths)]
    return {length: [n for n in used if len(MASKS[n]) == length] for length in sorted({len(MASKS[n]) for n in used})}


def _seed(own: Column, number: int, place: Column) -> Column:
    """The hash under a mask whose first word is at ``place``, from 0."""
    return F.xxhash64(F.lit(number), *[F.get(own, place + i) for i, mark in enumerate(MASKS[number]) if mark == "1"])


def _core(own: Column, numbers: list[int], place: Column) -> Column:
    """The hash of the words that all of these masks, of one length, look at."""
    marks = [i for i, column in enumerate(zip(*[MASKS[n] for n in numbers], strict=True)) if set(column) == {"1"}]
    return F.xxhash64(F.lit(-len(MASKS[numbers[0]])), *[F.get(own, place + i) for i in marks])


def _places(own: Column, length: int) -> Column:
    return F.when(F.size(own) >= length, F.sequence(F.lit(0), F.size(own) - length)).otherwise(F.array().cast("array<int>"))


def item_seeds(items: DataFrame, widths: list[int]) -> DataFrame:
    """(item_id, item, mask, item_at, seed, core) for every place of an item where
    a mask of its width fits; ``item_at`` counts from 1."""
    item = F.col("item")

    def rows(n: int, numbers: list[int]) -> Column:
        wanted = width(item).isin([w for w in widths if MASKS[n] in MASKS_OF[w]])
        places = F.when(wanted, _places(item, len(MASKS[n])))
        return F.transform(places, lambda at: F.struct(F.lit(n).alias("mask"), (at + 1).alias("item_at"), _seed(item, n, at).alias("seed"), _core(item, numbers, at).alias("core")))

    parts = [rows(n, numbers) for numbers in by_length(widths).values() for n in numbers]
    return items.select("item_id", "item", F.inline(F.flatten(F.array_compact(F.array(*parts)))))


def text_seeds(own: Column, widths: list[int], bits: Column) -> Column:
    """(mask, at, seed) for the places of a text whose seeds may be known. What the
    masks of one length have in common is looked up first."""

    def found(length: int, numbers: list[int]) -> Column:
        def here(at: Column) -> Column:
            seeds = F.array(*[F.struct(F.lit(n).alias("mask"), (at + 1).alias("at"), _seed(own, n, at).alias("seed")) for n in numbers])
            return F.filter(seeds, lambda s: _known(bits, s["seed"]))

        cores = F.transform(_places(own, length), lambda at: _core(own, numbers, at))
        places = F.filter(F.transform(cores, lambda core, at: F.when(_known(bits, core), at)), lambda at: at.isNotNull())
        return F.flatten(F.transform(places, here))

    return F.concat(*[found(length, numbers) for length, numbers in by_length(widths).items()])


def _bit(seed: Column) -> Column:
    return F.shiftright(seed, 32).bitwiseAND(F.lit(63)).cast("int")


def _known(bits: Column, seed: Column) -> Column:
    word = F.get(bits, seed.bitwiseAND(F.lit(SLOTS - 1)).cast("int"))
    return F.call_function("shiftright", word, _bit(seed)).bitwiseAND(F.lit(1)) != 0


def bitmap(known: DataFrame) -> Column:
    """Seeds and cores in one array of ``SLOTS`` words, whatever their number, as a
    scalar of the query that uses it. The more it holds the more others pass."""
    hashes = known.select(F.explode(F.array("seed", "core")).alias("seed"))
    held = hashes.select(F.col("seed").bitwiseAND(F.lit(SLOTS - 1)).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("seed"))).alias("bits"))
    every = known.sparkSession.range(SLOTS).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("bits"))
    slots = held.unionByName(every).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    return slots.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "bits"))), lambda row: row["bits"])).scalar()


def agreement(near: Column, item: Column, shift: Column, at: Column, mask: Column) -> Column:
    """The most equal words of any window that covers the seed. ``near`` are the
    document's hashes around it, its first one ``shift`` places before the seed;
    ``at`` is the seed's place in the item."""
    span = F.element_at(F.array(*[F.lit(len(m)) for m in MASKS]), mask + 1)
    wide = width(item)
    # Places relative to the seed's first word at which both have words.
    low = F.greatest(-shift, 1 - at)
    high = F.least(F.size(near) - shift - 1, F.size(item) - at)
    same = F.transform(F.sequence(low, high), lambda k: (F.get(near, k + shift) == F.get(item, at - 1 + k)).cast("int"))
    first = F.greatest(low, span - wide)
    last = F.least(F.lit(0), high - wide + 1)
    starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.array_max(F.transform(starts, lambda s: F.aggregate(F.slice(same, s - low + 1, wide), F.lit(0), lambda a, b: a + b)))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, item_id, equal, of): texts of ``docs`` that hold a window of a
    benchmark item, with the equal words of the best one and its width."""
    items = benchmark.where("item_id is not null").select("item_id", hashes(F.col("text")).alias("item")).where(F.size("item") > 0)
    # At most WINDOW numbers: masks that no item needs are not laid over the texts.
    widths = sorted(row["w"] for row in items.select(width(F.col("item")).alias("w")).distinct().collect()) or [WINDOW]
    known = stage(item_seeds(items, widths))
    texts = docs.select(F.xxhash64("text").alias("text_key"), hashes(F.col("text")).alias("own"))
    # What the seeds of a text pass with is cut out before it becomes rows, so no row holds the whole text.
    before = lambda at: F.least(at - 1, F.lit(WINDOW - 1))
    cut = F.transform(
        text_seeds(F.col("own"), widths, F.col("bits")),
        lambda s: F.struct(s["seed"].alias("seed"), s["mask"].alias("mask"), before(s["at"]).alias("shift"), F.slice(F.col("own"), s["at"] - before(s["at"]), before(s["at"]) + WINDOW).alias("near")),
    )
    kept = texts.withColumn("bits", bitmap(known)).select("text_key", F.inline(cut)).distinct()
    met = kept.join(known, ["seed", "mask"])
    checked = met.select("text_key", "item_id", width(F.col("item")).alias("of"), agreement(F.col("near"), F.col("item"), F.col("shift"), F.col("item_at"), F.col("mask")).alias("equal"))
    return checked.where(F.col("equal") * WINDOW >= LEAST * F.col("of")).groupBy("text_key", "item_id", "of").agg(F.max("equal").alias("equal"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_items (items of
    ``benchmark`` (item_id, text) it overlaps), item_id (the smallest of them) and
    equal_words (the most in any window).

    Documents without overlap, null and empty texts among them, have 0 items and
    nulls. Items without id or words match nothing; equal item ids count
    once. Equal rows get equal results, rows without doc_id are kept,
    other columns are ignored; empty tables give 0 items everywhere or no rows.
    """
    found = stage(overlaps(docs, benchmark)).groupBy("text_key").agg(F.countDistinct("item_id").alias("n"), F.min("item_id").alias("item_id"), F.max("equal").alias("equal_words"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key")).join(found, "text_key", "left")
    return rows.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_items"), "item_id", F.col("equal_words").cast("long").alias("equal_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item."""
    unwanted = stage(overlaps(docs, benchmark).select("text_key").distinct())
    return without(docs.withColumn("text_key", F.xxhash64("text")), "text_key", unwanted).select(*docs.columns)
