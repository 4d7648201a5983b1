"""Scalar conversions shared by the upgrade jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SECONDS = 1800
HOUR_MS = 3_600_000


def int_div(value: Column, divisor: int | Column) -> Column:
    """Integer division without a detour over DOUBLE (epoch ns exceed 2^53)."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.call_function("div", value, divisor)


# ---- time ------------------------------------------------------------------


def ns_to_ts(ns: Column) -> Column:
    """Epoch nanoseconds to a timestamp, cut to the microsecond Spark keeps."""
    return F.timestamp_micros(int_div(ns, 1000))


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_to_ns(ts: Column) -> Column:
    return F.unix_micros(ts) * F.lit(1000)


def date_to_epoch(date: Column, unit: str = "ms") -> Column:
    """Midnight UTC of a date. ``unit='s'`` gives whole seconds."""
    seconds = F.unix_seconds(date.cast("timestamp"))
    if unit == "s":
        return seconds
    if unit == "ms":
        return seconds * F.lit(1000)
    raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")


def ts_bucket(seconds: Column, size: int = BUCKET_SECONDS) -> Column:
    """Start of the fixed-size bucket an epoch second falls in."""
    return int_div(seconds, size) * F.lit(size)


def align_to_hour(start_ms: Column, end_ms: Column) -> tuple[Column, Column]:
    """Widen a millisecond range outward to full hours."""
    lower = int_div(start_ms, HOUR_MS) * F.lit(HOUR_MS)
    upper = int_div(end_ms + F.lit(HOUR_MS - 1), HOUR_MS) * F.lit(HOUR_MS)
    return lower, upper


# ---- coercions --------------------------------------------------------------


def text_to_bool(value: Column) -> Column:
    return F.coalesce(F.lower(value) == F.lit("true"), F.lit(False))


def int_to_bool(value: Column) -> Column:
    return F.coalesce(value != F.lit(0), F.lit(False))


def narrow_int(value: Column, bits: int, wrap: bool = True) -> Column:
    """Fit an integer into ``bits`` bits: two's-complement wrap, or NULL when
    it does not fit (``wrap=False``)."""
    target = {8: "tinyint", 16: "smallint", 32: "int"}[bits]
    if not wrap:
        return value.try_cast(target)
    low = F.pmod(value.cast("bigint"), F.lit(1 << bits))
    half, span = F.lit(1 << (bits - 1)), F.lit(1 << bits)
    return F.when(low >= half, low - span).otherwise(low).cast(target)


# ---- names ------------------------------------------------------------------


def sanitize_name(name: Column) -> Column:
    """Drop everything but ASCII letters and digits."""
    return F.regexp_replace(name, "[^0-9A-Za-z]", "")


def datatype_class(dtype: Column) -> Column:
    """Attribute storage class of a declared data type."""
    kind = F.lower(dtype)
    return (
        F.when(kind.isin("int64", "float64"), F.lit("number"))
        .when(kind == "bool", F.lit("bool"))
        .otherwise(F.lit("string"))
    )


def promoted_name(kind: Column, dtype: Column, name: Column) -> Column:
    """Column name of a promoted attribute; dots become ``$$``."""
    return F.concat_ws("_", F.lower(kind), F.lower(dtype), F.replace(name, F.lit("."), F.lit("$$")))


def temporality(value: Column) -> Column:
    return F.when(value.isin("Cumulative", "Delta"), value).otherwise(F.lit("Unspecified"))
