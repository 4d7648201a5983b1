"""Mixing sources to target weights with a hypergeometric splitting tree.

A source's documents lie in ``BLOCKS`` blocks by hash. A source gives all its
blocks once for every whole time its target holds its size, and for the rest
blocks in a fixed random order until the next would exceed the target; from the
blocks that follow, single documents are drawn.

The block quotas of all sources are then split down a binary tree over the
output shards: at each node half of all its blocks, drawn without replacement,
go left, so every shard gets exact quotas that follow a multivariate
hypergeometric law. A shard draws its quota of each source as the next blocks in
that source's random order; no block is drawn twice. Rows are shuffled within a
shard by a random sort key.

Only hashes of ids and seeds decide, so reruns agree. The tree works on blocks,
of which there are at most ``BLOCKS`` a source and pass, not on documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemorph.llm.shared import SPACE, stage

BLOCKS = 1024
#: Blocks are given whole while so many documents remain; the blocks that a target
#: cuts are as many as it takes to hold that many.
CUT = 64
#: Passes over the cut blocks that fill what is left of the target with documents that still fit.
FILLS = 6
# The weights of sources in order, repeating.
WEIGHTS = (3, 1, 2)
BLANKS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, SPACE))).cast("long")


def draw(seed: int, name: str, *columns) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(name), *columns)


def keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with its size, source key (null last) and block."""
    known = [F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name")]
    block = F.pmod(draw(seed, "block", "doc_id", "_size"), F.lit(BLOCKS)).cast("int")
    return docs.withColumn("_size", word_count(F.col("text"))).select("*", *known).withColumn("_block", block)


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """(_none, _name, source_size) with target: weights in order of the names,
    ``share`` of all sizes, no target above ``most`` times its source's size.

    Resharing what is above the limits by weight ends where every target is the
    smaller of its limit and one level times its weight; sources meet their
    limits in order of limit / weight.
    """
    place = F.row_number().over(Window.orderBy("_none", "_name")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    limit = F.lit(most) * F.col("source_size")
    weighed = sources.withColumn("weight", weight.cast("double")).withColumn("limit", limit)
    order = Window.orderBy(F.col("limit") / F.col("weight"), "_none", "_name")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    among = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = weighed.withColumn("level", left / among)
    # The first source whose limit is not below the level sets it for all after it.
    level = F.min(F.when(F.col("limit") >= F.col("level") * F.col("weight") * (1 - 1e-12), F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)
    target = F.least("limit", F.coalesce(level["level"], F.lit(float("inf"))) * F.col("weight"))
    return levelled.withColumn("target", target).select("_none", "_name", "source_size", "target")


def plan(rows: DataFrame, seed: int, share: float, most: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (doc_id, _none, _name, _size, _block): the sources with their targets,
    the blocks with the passes they give whole, and the documents drawn from cut
    blocks."""
    blocks = stage(rows.groupBy("_none", "_name", "_block").agg(F.sum("_size").alias("words"), F.count("*").alias("n")))
    sources = stage(targets(blocks.groupBy("_none", "_name").agg(F.sum("words").alias("source_size")), share, most))
    named = ["_none", "_name"]
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("int")
    order = Window.partitionBy(*named).orderBy(draw(seed, "order", "_name", "_block"), "_block")
    summed = blocks.join(sources, named).withColumn("whole", whole)
    summed = summed.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    summed = summed.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    n_upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.sum("n").over(Window.partitionBy(*named)) - n_upto
    summed = summed.withColumn("n_upto", n_upto).withColumn("after", after)
    inside = (F.col("upto") <= F.col("rest")) & (F.col("rest") > 0) & (F.col("after") >= CUT)
    summed = summed.withColumn("inside", inside)
    everything = Window.partitionBy(*named)
    n_inside = F.coalesce(F.max(F.when(F.col("inside"), F.col("n_upto"))).over(everything), F.lit(0))
    gap = F.col("rest") - F.coalesce(F.max(F.when(F.col("inside"), F.col("upto"))).over(everything), F.lit(0))
    cut = ~F.col("inside") & (gap > 0) & (F.col("n_upto") - F.col("n") - n_inside < CUT)
    given = stage(summed.select(*named, "_block", (F.col("whole") + F.col("inside").cast("int")).alias("passes"), cut.alias("cut"), gap.alias("open")))

    # Documents of the cut blocks: what still fits, larger ones first.
    left = given.where("cut").select(*named, "_block", "open")
    items = stage(
        rows.join(left, [*named, "_block"])
        .where("_size > 0")
        .groupBy(*named, "_block", "doc_id", "_size")
        .agg(F.count("*").alias("copies"), F.first("open").alias("open"))
        .withColumn("worth", F.col("_size") * F.col("copies"))
    )
    state = items.withColumn("chosen", F.lit(False))
    for k in range(FILLS):
        fits = ~F.col("chosen") & (F.col("worth") <= F.col("open"))
        mine = Window.partitionBy(*named).orderBy(F.when(fits, 0).otherwise(1), F.desc("worth"), draw(seed, f"fill{k}", "doc_id", "_size"), "doc_id", "_size")
        upto = F.sum(F.when(fits, F.col("worth")).otherwise(0)).over(mine.rowsBetween(Window.unboundedPreceding, 0))
        state = state.withColumn("now", fits & (upto <= F.col("open")))
        taken = F.sum(F.when(F.col("now"), F.col("worth")).otherwise(0)).over(Window.partitionBy(*named))
        state = state.withColumn("chosen", F.col("chosen") | F.col("now")).withColumn("open", F.col("open") - taken).drop("now")
    # One more where going above the target comes nearer to it.
    nearest = Window.partitionBy(*named).orderBy(F.col("chosen").cast("int"), "worth", "doc_id", "_size")
    last = ~F.col("chosen") & (F.row_number().over(nearest) == 1) & (F.col("worth") < 2 * F.col("open"))
    drawn = state.withColumn("chosen", F.col("chosen") | last).where("chosen").select(*named, "_block", "doc_id", "_size")
    return sources, given, stage(drawn)


def split_quotas(units: DataFrame, depth: int, seed: int) -> DataFrame:
    """(_none, _name, shard, quota): the units of each source that every one of
    2 ** ``depth`` shards gets."""
    named = ["_none", "_name"]
    quotas = units.groupBy(*named).agg(F.count("*").alias("quota")).withColumn("shard", F.lit(0))
    for level in range(depth):
        each = quotas.select(*named, "shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("i"))
        shuffled = Window.partitionBy("shard").orderBy(draw(seed, f"level{level}", "shard", *named, "i"), *named, "i")
        half = F.floor((F.count("*").over(Window.partitionBy("shard")) + 1) / 2)
        side = (F.row_number().over(shuffled) > half).cast("int")
        quotas = each.select(*named, "i", (F.col("shard") * 2 + side).alias("shard")).groupBy(*named, "shard").agg(F.count("*").alias("quota"))
    return quotas


def assign(given: DataFrame, depth: int, seed: int) -> DataFrame:
    """(_none, _name, _block, pass, shard): the shard of every pass of every block."""
    named = ["_none", "_name"]
    passes = F.col("passes") + F.col("cut").cast("int")
    units = stage(given.where(passes > 0).select(*named, "_block", F.explode(F.sequence(F.lit(1), passes)).alias("pass")))
    quotas = stage(split_quotas(units, depth, seed))
    before = F.sum("quota").over(Window.partitionBy(*named).orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("quota")
    slots = quotas.withColumn("before", before).select(*named, "shard", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("quota"))).alias("nth"))
    permuted = Window.partitionBy(*named).orderBy(draw(seed, "permute", "_name", "_block", "pass"), "_block", "pass")
    return units.withColumn("nth", F.row_number().over(permuted).cast("long")).join(slots, [*named, "nth"]).drop("nth")


def mix(docs: DataFrame, depth: int = 4, seed: int = 1, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, text, source and any others) as
    often as they are taken, with ``pass`` (1 for the first time), ``shard``
    (0 to 2 ** depth - 1) and ``place`` (sort key within the shard).

    Null source is a source of its own, after all others. Null, empty and blank
    texts have size 0 and come with their block. Equal rows are taken alike;
    rows without doc_id take part. A source whose sizes are all 0 has target 0
    and gives nothing. Columns named like those added are replaced.
    """
    own = docs.drop("pass", "shard", "place")
    rows = keyed(own, seed)
    _, given, drawn = plan(stage(rows.select("doc_id", "_none", "_name", "_size", "_block")), seed, share, most)
    units = stage(assign(given, depth, seed).join(given, ["_none", "_name", "_block"]))
    taken = rows.join(units, ["_none", "_name", "_block"])
    chosen = drawn.withColumn("_chosen", F.lit(True)).withColumnRenamed("doc_id", "_id")
    same = [taken[c] == chosen[c] for c in ("_none", "_name", "_block", "_size")]
    partial = F.col("pass") > F.col("passes")  # only the cut block's last pass
    whole = taken.where(~partial)
    cut = taken.where(partial).join(chosen, [*same, taken["doc_id"].eqNullSafe(chosen["_id"])], "left_semi")
    place = draw(seed, "place", "doc_id", "_size", "pass")
    return whole.unionByName(cut).select(*own.columns, "pass", "shard", place.alias("place"))


def taken_words(docs: DataFrame, seed: int = 1, share: float = 1.5, most: float = 2.0, depth: int = 4) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size,
    source_size, target of its source, taken (words that :func:`mix` takes of
    it, repeats counted) and shards (how many shards hold it)."""
    rows = stage(keyed(docs.select("doc_id", "text", "source"), seed).drop("text", "source"))
    sources, given, drawn = plan(rows, seed, share, most)
    units = assign(given, depth, seed)
    keys = ["_none", "_name", "_block"]
    counts = units.groupBy(*keys).agg(F.count("*").alias("units"), F.countDistinct("shard").alias("shards"))
    blocks = given.join(counts, keys, "left").select(*keys, "cut", F.coalesce("units", F.lit(0)).alias("units"), F.coalesce("shards", F.lit(0)).alias("shards"))
    joined = rows.join(blocks, keys).join(sources, ["_none", "_name"])
    chosen = drawn.withColumn("_chosen", F.lit(True)).withColumnRenamed("doc_id", "_id")
    same = [joined[c] == chosen[c] for c in (*keys, "_size")]
    found = joined.join(chosen, [*same, joined["doc_id"].eqNullSafe(chosen["_id"])], "left").select(joined["*"], "_chosen")
    # A cut block's last unit counts for its drawn documents only.
    times = F.col("units") - F.when(F.col("cut") & F.col("_chosen").isNull(), 1).otherwise(0)
    return found.select("doc_id", F.col("_size").alias("size"), "source_size", F.col("target").cast("double").alias("target"), (F.col("_size") * times).cast("long").alias("taken"), F.col("shards").cast("long").alias("shards"))


def write_shards(mixed: DataFrame, path: str, depth: int = 4) -> None:
    """Write a mix as one folder per shard, each shuffled."""
    mixed.repartition(1 << depth, "shard").sortWithinPartitions("shard", "place").write.mode("overwrite").partitionBy("shard").parquet(path)
