"""Numbers the oldest documents use instead of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, as stored in documents. 19 to 21 are unassigned.
AGGREGATIONS = {
    1: "noop", 2: "count", 3: "count_distinct", 4: "sum", 5: "avg", 6: "max", 7: "min",
    8: "p05", 9: "p10", 10: "p20", 11: "p25", 12: "p50", 13: "p75", 14: "p90", 15: "p95", 16: "p99",
    17: "rate", 18: "sum_rate",
    22: "rate_sum", 23: "rate_avg", 24: "rate_max", 25: "rate_min",
    26: "hist_quantile_50", 27: "hist_quantile_75", 28: "hist_quantile_90",
    29: "hist_quantile_95", 30: "hist_quantile_99",
}
REDUCTIONS = {1: "last", 2: "sum", 3: "avg", 4: "max", 5: "min"}
QUERY_TYPES = {1: "builder", 2: "clickhouse_sql", 3: "promql"}
PANEL_NUMBERS = {1: "graph", 2: "value"}
PANEL_NAMES = {"TIME_SERIES": "graph", "VALUE": "value"}


def _lookup(mapping: dict, column: Column, default: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, column), default)


def legacy_operator(column: Column) -> Column:
    return _lookup(AGGREGATIONS, column.cast("int"), F.lit("noop"))


def legacy_reduce(column: Column) -> Column:
    return _lookup(REDUCTIONS, column.cast("int"), F.lit("last"))


def legacy_query_type(column: Column) -> Column:
    return _lookup(QUERY_TYPES, column.cast("int"), F.lit("builder"))


def legacy_panel(column: Column, numbered: bool = False) -> Column:
    """Panel type of a rule (a number) or of a dashboard (a name; unknown names
    are kept)."""
    if numbered:
        return _lookup(PANEL_NUMBERS, column.cast("int"), F.lit("graph"))
    return _lookup(PANEL_NAMES, column, column)
