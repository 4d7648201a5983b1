"""Builder queries and requests derived from the events, with planted faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.sources.derived import events
from telemorph.sources.tables import Tables


def _choice(number: Column, *names: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number + 1).cast("int"))


def _key(name: Column, data_type: Column, kind: Column, column: bool) -> Column:
    return F.struct(name.alias("key"), data_type.alias("dataType"), kind.alias("type"), F.lit(column).alias("isColumn"))


def _query() -> Column:
    eid, k, user = F.col("event_id"), F.col("k"), F.col("user_id")
    text = F.lit("string")
    filters = F.struct(
        F.when(F.col("event_type") == "error", "XOR").otherwise("AND").alias("op"),
        F.array(
            F.struct(_key(F.col("event_type"), F.when(k % 4 == 0, "text").otherwise("string"), F.lit("tag"), False).alias("key")),
            F.struct(_key(F.when(eid % 17 == 0, "").otherwise("host"), text, F.when(eid % 5 == 0, "").otherwise("resource"), True).alias("key")),
        ).alias("items"),
    )
    return F.struct(
        F.when(eid % 11 == 0, "").otherwise("A").alias("queryName"),
        F.when(eid % 7 == 0, "A+B").when(eid % 13 == 0, "").otherwise("A").alias("expression"),
        _choice(user % 5, "traces", "logs", "metrics", "metrics", "files").alias("dataSource"),
        _choice(F.abs(k) % 6, "count", "sum", "noop", "rate", "p95", "median").alias("aggregateOperator"),
        F.when(eid % 3 != 0, _key(F.col("event_type"), text, F.lit("tag"), False)).alias("aggregateAttribute"),
        filters.alias("filters"),
        F.when(user % 2 == 0, F.array(_key(F.col("svc"), text, F.lit("tag"), False))).alias("groupBy"),
    )


def builder_specs(t: Tables) -> DataFrame:
    """One builder query per event; every 23rd is torn."""
    whole = F.to_json(_query())
    return events(t).select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 23 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("data"))


def request_specs(t: Tables) -> DataFrame:
    """One request per event."""
    eid = F.col("event_id")
    request = F.struct(
        F.when(F.col("user_id") % 9 != 0, F.create_map(F.lit("A"), _query())).alias("builderQueries"),
        F.when(eid % 4 == 0, F.create_map(F.lit("C"), F.struct(F.when(eid % 19 == 0, "").otherwise("SELECT 1").alias("query")))).alias("chQueries"),
        _choice(F.abs(F.col("k")) % 5, "value", "graph", "table", "list", "pie").alias("panelType"),
        _choice(F.col("user_id") % 4, "builder", "clickhouse_sql", "promql", "sql").alias("queryType"),
    )
    return events(t).select(eid.alias("id"), F.to_json(request).alias("data"))
