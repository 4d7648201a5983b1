"""Checks that run beside the upgrade jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class EmptyInput(RuntimeError):
    pass


class UnresolvedNames(RuntimeError):
    pass


def count_parity(a: DataFrame, b: DataFrame, delta: int = 1000) -> DataFrame:
    """Row counts of two tables, and whether they differ by at most ``delta``.
    Each side is reduced to one counter row per task before they meet."""
    tagged = a.select(F.lit("a").alias("side")).unionAll(b.select(F.lit("b").alias("side")))
    counts = tagged.agg(
        F.count_if(F.col("side") == "a").alias("count_a"),
        F.count_if(F.col("side") == "b").alias("count_b"),
    )
    diff = F.abs(F.col("count_a") - F.col("count_b"))
    return counts.select("count_a", "count_b", diff.alias("difference"), (diff <= delta).alias("within_delta"))


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail early when there is nothing to do; reads one row at most."""
    if df.isEmpty():
        raise EmptyInput(f"{what} has no rows")
    return df


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and normalised numbers; NULL if malformed."""
    return F.to_json(F.try_parse_json(text))


def json_changed(old: Column, new: Column) -> Column:
    """Whether two JSON texts differ in content. Malformed text counts as
    different from everything."""
    return ~F.coalesce(canonical_json(old) == canonical_json(new), F.lit(False))


def pending_documents(docs: DataFrame, flag: str, data: str = "data") -> DataFrame:
    """Documents that do not carry ``"flag": true`` at their top level."""
    done = F.try_variant_get(F.try_parse_json(data), f"$.{flag}", "boolean")
    return docs.where(~F.coalesce(done, F.lit(False)))


def unresolved(pairs: DataFrame, name: str, target: str) -> DataFrame:
    """Names without a counterpart."""
    return pairs.where(F.col(target).isNull() | (F.col(target) == "")).select(name).distinct()


def require_resolved(pairs: DataFrame, name: str, target: str, what: str, shown: int = 20) -> DataFrame:
    """Fail when any name is unresolved; only a few of them enter the message."""
    missing = unresolved(pairs, name, target)
    examples = [row[0] for row in missing.orderBy(name).limit(shown).collect()]
    if examples:
        raise UnresolvedNames(f"{what} without a counterpart: {', '.join(examples)}")
    return pairs
