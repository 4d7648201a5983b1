"""Range scans, pruned scans, pages, and reports of counts, bounds and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemorph.functions.scalars import int_div, ts_bucket


def scan_range(df: DataFrame, ts: str, start, end, closed: str = "(]") -> DataFrame:
    """Rows with ``ts`` between two bounds. ``closed`` is ``(]``, ``[)`` or
    ``[]``. Adjacent half-open ranges see every row exactly once. The bounds are
    plain comparisons on the stored column, so the scan can skip row groups."""
    if closed not in ("(]", "[)", "[]"):
        raise ValueError(f"unknown closure {closed!r}")
    column = F.col(ts)
    lower = column >= start if closed[0] == "[" else column > start
    upper = column <= end if closed[1] == "]" else column < end
    return df.where(lower & upper)


def scan_service(df: DataFrame, service: str, start, end, service_col: str = "serviceName", ts: str = "timestamp") -> DataFrame:
    return scan_range(df.where(F.col(service_col) == service), ts, start, end, "[]")


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def rows_after(df: DataFrame, service: str, ts_value, service_col: str = "serviceName", ts: str = "timestamp") -> DataFrame:
    """Rows from a point on in the order of services (ascending) and time
    (descending): a page is their first ones."""
    svc = F.col(service_col)
    return df.where((svc > service) | ((svc == service) & (F.col(ts) <= ts_value)))


# ---- counts and bounds -------------------------------------------------------


def count_rows(df: DataFrame, ts: str | None = None, start=None, end=None, closed: str = "[]") -> DataFrame:
    if ts is not None and start is not None:
        df = scan_range(df, ts, start, end, closed)
    return df.agg(F.count(F.lit(1)).alias("num_total"))


def service_inventory(df: DataFrame, service_col: str = "serviceName", ts: str = "timestamp") -> DataFrame:
    """First and last timestamp and row count per service, by service."""
    return (
        df.groupBy(F.col(service_col))
        .agg(F.min(ts).alias("mint"), F.max(ts).alias("maxt"), F.count(F.lit(1)).alias("num_total"))
        .orderBy(service_col)
    )


def time_bounds(df: DataFrame, ts: str = "timestamp_ms") -> DataFrame:
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


# ---- ordering and paging -----------------------------------------------------


def page_by_time(df: DataFrame, limit: int, offset: int, ts: str = "timestamp", tiebreak: str = "errorID") -> DataFrame:
    """One page in time order; the tie-break makes pages disjoint."""
    return df.orderBy(ts, tiebreak).offset(offset).limit(limit)


def ordered(df: DataFrame, cols: list[Column]) -> DataFrame:
    """Total order. Give a unique last column: it lets the range exchange cut
    through a value many rows share."""
    return df.orderBy(*cols)


# ---- coverage of time ----------------------------------------------------------


def service_rates(inventory: DataFrame) -> DataFrame:
    """Rows per second of every service of an inventory, over its own time."""
    seconds = F.unix_seconds("maxt") - F.unix_seconds("mint") + F.lit(1)
    return inventory.withColumn("rate", int_div(F.col("num_total"), seconds))


def bucket_counts(df: DataFrame, service_col: str = "serviceName", ts: str = "timestamp") -> DataFrame:
    """Rows per service and half hour: combined before the shuffle, so a service
    that holds most rows sends as many as any other."""
    return df.groupBy(service_col, ts_bucket(F.unix_seconds(ts)).alias("ts_bucket_start")).agg(F.count(F.lit(1)).alias("num_total"))


def time_gaps(counts: DataFrame, service_col: str = "serviceName", width: int = 1800) -> DataFrame:
    """Stretches ``[gap_start, gap_end)`` in which a service has no rows between two
    that have, from its counts per half hour."""
    following = F.lead("ts_bucket_start").over(Window.partitionBy(service_col).orderBy("ts_bucket_start"))
    spans = counts.select(service_col, (F.col("ts_bucket_start") + F.lit(width)).alias("gap_start"), following.alias("gap_end"))
    return spans.where("gap_end > gap_start")
