"""Ordered work within a series, cut into pieces of time.

A window partitioned by series alone puts one busy series into one task. Here
windows are partitioned by (series, piece of time); what crosses an edge is
brought in by a second, small step or lent in the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemorph.functions.scalars import int_div

CHUNK_MS = 3_600_000


def with_previous(df: DataFrame, keys: list[str], ts: str, value: str, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Add ``prev_ts`` and ``prev_value``, the sample before this one in its
    series (NULL for the first)."""
    chunked = df.withColumn("_chunk", int_div(F.col(ts), chunk_ms))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts, value)
    point = F.struct(F.col(ts).alias("ts"), F.col(value).alias("value"))
    # One row per chunk: its last point, handed to the chunk that follows.
    ends = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.max(point).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")))
        .drop("_last")
    )
    here = chunked.withColumn("_here", F.lag(point).over(inside))
    same = F.col("_chunk") == F.col("_ec")
    renamed = ends.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_ec"), "_carry")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_e{i}"))
    joined = here.join(renamed, same, "left").withColumn("_prev", F.coalesce("_here", "_carry"))
    return joined.select(
        *df.columns, F.col("_prev.ts").alias("prev_ts"), F.col("_prev.value").alias("prev_value")
    )


# ---- trailing windows from panes -----------------------------------------------------------
#
# Time is cut into panes that divide the range. The window (t - range, t] of a row
# is then the end of one earlier pane, whole panes, and the beginning of the row's
# own pane. Every row goes to its own pane and, as an edge, to the pane whose
# windows begin in its own; both in one exchange. Whole panes between them take
# part as one row each. So no task holds more of a series than two panes, however
# long the range, and a window costs the same however many rows it holds.


def pane_ms(range_ms: int, longest_ms: int = CHUNK_MS) -> int:
    """The longest pane of at most ``longest_ms`` that divides the range."""
    parts = max(1, -(-range_ms // longest_ms))
    while range_ms % parts:
        parts += 1
    return range_ms // parts


def step(before: Column, after: Column) -> Column:
    """Increase of a counter between two samples; a falling value is a reset."""
    return F.when(after < before, after).otherwise(after - before)


def _panes(df: DataFrame, keys: list[str], ts: str, value: str, range_ms: int, pane: int, every: bool) -> DataFrame:
    """(keys, _pane, _edge, _at, _ts, _rows, _n, _total, _least, _v): instants in
    their own pane and as edges. ``_at`` is the instant up to which one lies in the
    windows of its pane, ``_least`` and ``_v`` are its least and greatest value.
    With ``every`` all rows of an instant count; else the greatest value stands
    for them, as the only row."""
    places = [F.struct(int_div(F.col(ts) + shift, pane).alias("pane"), F.lit(shift > 0).alias("edge"), (F.col(ts) + shift).alias("at")) for shift in (0, range_ms)]
    rows = df.withColumn("_place", F.explode(F.array(*places))).select(
        *keys, F.col("_place.pane").alias("_pane"), F.col("_place.edge").alias("_edge"), F.col("_place.at").alias("_at"), F.col(ts).alias("_ts"), F.col(value).alias("_v")
    )
    # Everything below asks for rows of a pane in one task, and so runs behind this exchange.
    spread = rows.repartition(*keys, "_pane")
    instant = spread.groupBy(*keys, "_pane", "_edge", "_at", "_ts")
    if every:
        counts = [F.count(F.lit(1)).alias("_rows"), F.count("_v").alias("_n")]
        return instant.agg(*counts, F.sum("_v").alias("_total"), F.min("_v").alias("_least"), F.max("_v").alias("_v"))
    known = F.col("_v").isNotNull().cast("long")
    return instant.agg(F.max("_v").alias("_v")).withColumns({"_rows": F.lit(1).cast("long"), "_n": known, "_total": F.col("_v"), "_least": F.col("_v")})


def _until_here(keys: list[str]) -> Window:
    """Edges in the window of the current row: those that leave it later."""
    return Window.partitionBy(*keys, "_pane").orderBy(F.col("_at").desc(), F.col("_edge").asc()).rowsBetween(Window.unboundedPreceding, 0)


def _between(panes: DataFrame, keys: list[str], count: int, columns: dict[str, Callable[[Window], Column]]) -> DataFrame:
    """Per pane, ``columns`` over the ``count`` whole panes before it. Panes of a
    series are few whatever its rows, so this is the one step ordered by series."""
    before = Window.partitionBy(*keys).orderBy("_pane").rangeBetween(-count, -1)
    return panes.select(*keys, "_pane", *[make(before).alias(name) for name, make in columns.items()])


def _beside(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Join by series and pane, NULL keys included."""
    renamed = others.withColumnsRenamed({k: f"_r_{k}" for k in [*keys, "_pane"]})
    same = F.col("_pane") == F.col("_r__pane")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return rows.join(renamed, same, "left").drop(*[f"_r_{k}" for k in [*keys, "_pane"]])


def trailing_aggregates(
    df: DataFrame, keys: list[str], ts: str, value: str, range_ms: int, longest_ms: int = CHUNK_MS, every: bool = False
) -> DataFrame:
    """(keys, ts, n, total, least, most): number, sum, least and greatest value of the rows
    in ``(t - range_ms, t]`` at every instant t of a series that has a row. With
    ``every`` all rows of an instant count and each of them comes out."""
    pane = pane_ms(range_ms, longest_ms)
    rows = _panes(df, keys, ts, value, range_ms, pane, every).withColumn("_most", F.col("_v"))
    own = Window.partitionBy(*keys, "_pane", "_edge").orderBy("_ts").rowsBetween(Window.unboundedPreceding, 0)
    makers = {"n": F.sum, "total": F.sum, "least": F.min, "most": F.max}
    parts = {name: [make(f"_{name}").over(own), make(F.when(F.col("_edge"), F.col(f"_{name}"))).over(_until_here(keys))] for name, make in makers.items()}
    here = rows.withColumns({f"_{name}{i}": c for name, cs in parts.items() for i, c in enumerate(cs)}).where(~F.col("_edge"))
    count = range_ms // pane - 1
    if count:
        whole = rows.where(~F.col("_edge")).groupBy(*keys, "_pane").agg(*[make(f"_{name}").alias(f"_{name}") for name, make in makers.items()])
        between = _between(whole, keys, count, {f"_{n}2": lambda w, n=n, make=make: make(f"_{n}").over(w) for n, make in makers.items()})
        here = _beside(here, between, keys)
    numbers = range(3 if count else 2)
    n, total = (sum((F.coalesce(F.col(f"_{name}{i}"), F.lit(0)) for i in numbers[1:]), F.coalesce(F.col(f"_{name}0"), F.lit(0))) for name in ("n", "total"))
    least, most = (pick(*[F.col(f"_{name}{i}") for i in numbers]) for name, pick in (("least", F.least), ("most", F.greatest)))
    out = here.select(*keys, F.col("_ts").alias(ts), n.alias("n"), F.when(n > 0, total).alias("total"), least.alias("least"), most.alias("most"), "_rows")
    return (out.withColumn("_row", F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))).drop("_row") if every else out).drop("_rows")


def trailing_increase(
    df: DataFrame, keys: list[str], ts: str, value: str, range_ms: int, longest_ms: int = CHUNK_MS, every: bool = False
) -> DataFrame:
    """(keys, ts, n, rows, increase) of a counter over ``(t - range_ms, t]`` at every
    instant t of a series that has a row: the steps between the n rows there, of
    which ``rows`` are at t itself. With ``every`` the rows of an instant follow
    one another by value.

    A run of rows is summed up by its first and last value and the increase
    between them; two runs join by the step from one to the other."""
    pane = pane_ms(range_ms, longest_ms)
    rows = _panes(df, keys, ts, value, range_ms, pane, every)
    run = Window.partitionBy(*keys, "_pane", "_edge").orderBy("_ts")
    upto = run.rowsBetween(Window.unboundedPreceding, 0)
    # From the row before the instant to its first row, and on to its last one.
    rows = rows.withColumn("_inside", F.coalesce(F.col("_v") - F.col("_least"), F.lit(0.0)))
    rows = rows.withColumn("_step", F.coalesce(step(F.lag("_v").over(run), F.col("_least")), F.lit(0.0)) + F.col("_inside"))
    rows = rows.withColumns({"_gain": F.sum("_step").over(upto), "_first": F.first("_least").over(upto), "_n": F.sum("_rows").over(upto)})
    edge = F.when(F.col("_edge"), F.struct("_v", "_gain", (F.col("_gain") - F.col("_inside")).alias("_before")))
    seen = _until_here(keys)
    here = rows.withColumns(
        {"_newest": F.first(edge, ignorenulls=True).over(seen), "_oldest": F.last(edge, ignorenulls=True).over(seen), "_edges": F.sum(F.when(F.col("_edge"), F.col("_rows"))).over(seen)}
    ).where(~F.col("_edge"))
    count = range_ms // pane - 1
    gain, n, before = F.col("_newest._gain") - F.col("_oldest._before"), F.coalesce("_edges", F.lit(0)), F.col("_newest._v")
    if count:
        whole = rows.where(~F.col("_edge")).groupBy(*keys, "_pane").agg(
            F.min_by("_least", "_ts").alias("_head"), F.max_by("_v", "_ts").alias("_last"), F.max_by("_gain", "_ts").alias("_grown"), F.sum("_rows").alias("_rows")
        )
        whole = whole.withColumn("_joint", F.coalesce(step(F.lag("_last").over(Window.partitionBy(*keys).orderBy("_pane")), F.col("_head")), F.lit(0.0)))
        whole = _between(
            whole, keys, count,
            {
                "_mid_first": lambda w: F.first("_head").over(w), "_mid_last": lambda w: F.last("_last").over(w), "_mid_n": lambda w: F.sum("_rows").over(w),
                "_mid_gain": lambda w: F.sum(F.col("_grown") + F.col("_joint")).over(w) - F.first("_joint").over(w),
            },
        )
        here = _beside(here, whole, keys)
        middle = F.col("_mid_n").isNotNull()
        gain = F.coalesce(gain, F.lit(0.0)) + F.when(middle, F.col("_mid_gain") + F.coalesce(step(before, F.col("_mid_first")), F.lit(0.0))).otherwise(0.0)
        n, before = n + F.coalesce("_mid_n", F.lit(0)), F.coalesce("_mid_last", before)
    increase = F.coalesce(gain, F.lit(0.0)) + F.coalesce(step(before, F.col("_first")), F.lit(0.0)) + F.col("_gain")
    return here.select(*keys, F.col("_ts").alias(ts), (n + F.col("_n")).alias("n"), F.col("_rows").alias("rows"), increase.alias("increase"))
