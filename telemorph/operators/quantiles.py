"""Exact quantiles that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer,
which cannot hold a group with a third of a large table. Here ranks are selected
by refining a histogram whose buckets are cut from the leading bits of a double:

1. rows are counted per group and bucket; the few buckets that hold a wanted
   rank are located among those counts;
2. only rows of these buckets are counted per value (the others are dropped
   before the shuffle by a bitmap of bounded size), and the ranks are located
   among the values.

There are 2^16 buckets per power of two, so a group of any size has as many
counts as its values span, and the values ordered in one step are those that
agree in 17 leading bits. Nothing is approximated, and nothing runs before the
result is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemorph.operators.sizing import only_maybe_in

BUCKETS = 1 << 16
# Keeps the exponents of all doubles positive.
EXPONENT_OFFSET = 1100


def value_bucket(value: Column) -> Column:
    """Bucket of a double; it grows with the value.

    The size is scaled by a power of two, which is exact. If LOG2 rounds to a
    neighbouring integer next to a power of two, the formula still yields the
    same or the adjacent number, so order is kept.
    """
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    scaled = size / F.pow(F.lit(2.0), exponent.cast("double")) * F.lit(BUCKETS)
    sign = F.when(value < 0, -1).otherwise(1)
    regular = sign * ((exponent + F.lit(EXPONENT_OFFSET)) * F.lit(BUCKETS) + F.floor(scaled) - F.lit(BUCKETS))
    limit = F.lit((1024 + EXPONENT_OFFSET + 1) * BUCKETS).cast("bigint")
    return (
        F.when(F.isnan(value), limit + F.lit(1))
        .when(size == F.lit(float("inf")), sign * limit)
        .when(value == 0, F.lit(0).cast("bigint"))
        .otherwise(regular)
    )


def _descend(sizes: DataFrame, group: list[str], part: str) -> DataFrame:
    """From ranks ``_t`` within ``group`` to ranks within ``group`` and ``part``,
    given the rows ``_n`` of every part: the parts that hold a target, each target
    counted from the part's start."""
    upto = F.sum("_n").over(Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, 0))

    def shifted(t: Column) -> Column:
        return F.struct(t["name"].alias("name"), t["side"].alias("side"), (t["rank"] - F.col("_start")).alias("rank"), t["share"].alias("share"))

    inside = F.filter(F.transform("_t", shifted), lambda t: (t["rank"] >= 0) & (t["rank"] < F.col("_n")))
    return sizes.withColumn("_start", upto - F.col("_n")).select(*group, part, inside.alias("_t")).where(F.size("_t") > 0)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per group: one column per entry of
    ``quantiles`` (name to fraction). NULL values are ignored, so a group
    without other values is left out."""
    # One struct key: NULLs inside it compare as equal.
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    rows = df.where(F.col(value).isNotNull()).select(key.alias("_key"), F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_bucket", value_bucket(F.col("_v")))

    def target(name: str, q: float, side: str) -> Column:
        rank = F.lit(q) * (F.col("_total") - F.lit(1))
        at = F.floor(rank) if side == "lo" else F.ceil(rank)
        return F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), at.cast("bigint").alias("rank"), (rank - F.floor(rank)).alias("share"))

    wanted = F.array(*[target(n, q, side) for n, q in quantiles.items() for side in ("lo", "hi")])
    sizes = rows.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_total", F.sum("_n").over(Window.partitionBy("_key")))
    buckets = _descend(sizes.withColumn("_t", wanted), ["_key"], "_bucket")
    near = only_maybe_in(rows, ["_key", "_bucket"], buckets)
    counts = near.groupBy("_key", "_bucket", "_v").agg(F.count(F.lit(1)).alias("_n"))
    targets = _descend(counts.join(buckets, ["_key", "_bucket"]), ["_key", "_bucket"], "_v")
    hits = targets.select("_key", "_v", F.explode("_t").alias("_hit"))

    def picked(name: str, side: str, field: str) -> Column:
        return F.max(F.when((F.col("_hit.name") == name) & (F.col("_hit.side") == side), F.col(field)))

    ends = hits.groupBy("_key").agg(
        *[
            column
            for n in quantiles
            for column in (
                picked(n, "lo", "_v").alias(f"{n}_lo"),
                picked(n, "hi", "_v").alias(f"{n}_hi"),
                picked(n, "lo", "_hit.share").alias(f"{n}_share"),
            )
        ]
    )

    def between(n: str) -> Column:
        low, high, share = F.col(f"{n}_lo"), F.col(f"{n}_hi"), F.col(f"{n}_share")
        return F.when(share == 0, low).otherwise(low + (high - low) * share).alias(n)

    return ends.select(*[F.col(f"_key.`{k}`").alias(k) for k in keys], *[between(n) for n in quantiles])
