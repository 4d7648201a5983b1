"""Retention: reading TTLs from table definitions, expiry, hot and cold tiers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions.scalars import BUCKET_SECONDS, int_div

# How a definition spells its TTL clauses.
DELETE_PATTERN = r"toIntervalSecond\(([0-9]*)\)"
MOVE_PATTERN = r"toIntervalSecond\(([0-9]*)\) TO VOLUME '(\S+)'"

ABSENT = -1


def _seconds(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(text, pattern, 1).try_cast("bigint"), F.lit(ABSENT))


def parse_ttl(defs: DataFrame, text: str = "engine_full") -> DataFrame:
    """Delete TTL, move TTL (seconds, -1 when absent) and cold tier name. The
    delete TTL is the first interval anywhere in the text."""
    column = F.col(text)
    return defs.withColumns(
        {
            "delete_ttl": _seconds(column, DELETE_PATTERN),
            "move_ttl": _seconds(column, MOVE_PATTERN),
            "cold_tier": F.regexp_extract(column, MOVE_PATTERN, 2),
        }
    )


def ttl_hours(ttl: Column) -> Column:
    """Whole hours, as the oldest jobs report them."""
    return F.when(ttl == ABSENT, ttl).otherwise(int_div(ttl, 3600))


def _age_base(kind: str) -> Column:
    """Epoch second a row's TTL counts from."""
    if kind == "logs":
        return int_div(F.col("timestamp"), 1_000_000_000)
    if kind == "spans":
        return F.unix_seconds("timestamp")
    if kind == "resources":
        return F.col("seen_at_ts_bucket_start") + F.lit(BUCKET_SECONDS)
    if kind == "trace_summary":
        return F.unix_seconds("end")
    raise ValueError(f"unknown table kind {kind!r}")


def _epoch(as_of: datetime | int) -> int:
    return as_of if isinstance(as_of, int) else int(as_of.timestamp())


def apply_retention(df: DataFrame, kind: str, ttl: int, as_of: datetime | int) -> DataFrame:
    """Rows still alive at ``as_of``; everything when no TTL is set."""
    if ttl == ABSENT:
        return df
    return df.where(_age_base(kind) + F.lit(ttl) > F.lit(_epoch(as_of)))


def assign_tier(df: DataFrame, kind: str, move_ttl: int, as_of: datetime | int, cold: str = "cold") -> DataFrame:
    """Add a ``tier`` column to write the table by. Trace summaries never move."""
    if move_ttl == ABSENT or kind == "trace_summary":
        return df.withColumn("tier", F.lit("hot"))
    moved = _age_base(kind) + F.lit(move_ttl) <= F.lit(_epoch(as_of))
    return df.withColumn("tier", F.when(moved, F.lit(cold)).otherwise(F.lit("hot")))


def reconcile_ttl(old: DataFrame, current: DataFrame, key: str = "name") -> DataFrame:
    """What to do with the current table's TTL, from two ``parse_ttl`` outputs:
    keep a cold tier that is already set, do nothing when both agree or the old
    table has no delete TTL, else copy the old values."""
    a = old.select(key, *[F.col(c).alias(f"old_{c}") for c in ("delete_ttl", "move_ttl", "cold_tier")])
    b = current.select(key, *[F.col(c).alias(f"cur_{c}") for c in ("delete_ttl", "move_ttl")])
    same = (F.col("old_delete_ttl") == F.col("cur_delete_ttl")) & (F.col("old_move_ttl") == F.col("cur_move_ttl"))
    action = (
        F.when(F.col("cur_move_ttl") != ABSENT, F.lit("keep"))
        .when(same | (F.col("old_delete_ttl") == ABSENT), F.lit("none"))
        .otherwise(F.lit("copy"))
    )
    copied = action == "copy"
    return a.join(b, key).select(
        key,
        action.alias("action"),
        F.when(copied, F.col("old_delete_ttl")).otherwise(F.col("cur_delete_ttl")).alias("delete_ttl"),
        F.when(copied, F.col("old_move_ttl")).otherwise(F.col("cur_move_ttl")).alias("move_ttl"),
        F.when(copied, F.col("old_cold_tier")).otherwise(F.lit("")).alias("cold_tier"),
    )
