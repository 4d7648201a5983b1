"""Dashboards and alert rules derived from parts: one of each per part.

``p_partkey % 3`` picks the query language of a dashboard's panels and
``p_partkey % 2`` whether they read metrics or logs. Some documents are not
JSON, already done, or hold a query that cannot be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.operators.sizing import spread
from telemorph.sources.tables import Tables
from telemorph.sources.templates import fill

METRICS_DATABASE = "telemetry_metrics"
LOG_TABLE = "telemetry_logs.logs"

BROKEN_JSON, DONE, BAD_VARIABLE, BAD_PANEL = 41, 37, 43, 29

BUILDER_PANEL = (
    '{"id": "w«j»", "title": "«name»", "panelTypes": "graph", "extra": {"keep": [1, 2.50]}, "query": {"queryType": "builder",'
    ' "promql": [], "clickhouse_sql": [], "builder": {"queryData": [{"queryName": "A", "dataSource": "«src»",'
    ' "aggregateOperator": "sum", "aggregateAttribute": {"key": "app_event_value", "dataType": "float64", "type": "tag"},'
    ' "filters": {"op": "AND", "items": [{"key": {"key": "service_name", "dataType": "string", "type": "tag"}, "op": "=",'
    ' "value": "svc«s»"}]}, "groupBy": [{"key": "event_type", "dataType": "string", "type": "tag"}], "orderBy":'
    ' [{"columnName": "event_type", "order": "asc"}], "legend": "{{event_type}} of event_type_x"}], "queryFormulas":'
    ' [{"queryName": "F1", "expression": "A * app_event_value", "legend": "{{event_type}}"}]}}}'
)
SQL_PANEL = (
    '{"id": "w«j»", "title": "«name»", "query": {"queryType": "clickhouse_sql", "builder": {"queryData": [], "queryFormulas": []},'
    ' "promql": [], "clickhouse_sql": [{"name": "A", "legend": "{{service_name}}", "query": "«text»"}]}}'
)
PROM_PANEL = (
    '{"id": "w«j»", "title": "«name»", "query": {"queryType": "promql", "builder": {"queryData": [], "queryFormulas": []},'
    ' "clickhouse_sql": [], "promql": [{"name": "A", "legend": "{{event_type}}", "query": "«text»"}]}}'
)
# Query texts as they stand inside JSON strings.
METRICS_SQL = (
    "SELECT service_name, sum(value) AS v\\r\\n\\n FROM telemetry_metrics.samples WHERE metric_name = 'app_event_value'"
    " AND event_type IN ({{.event_type}}) GROUP BY service_name  \\n"
)
LOGS_SQL = (
    "SELECT resource_string_service_name AS s, count() FROM telemetry_logs.logs WHERE"
    " attributes_string_value[indexOf(attributes_string_key, 'event_type')] = 'x' GROUP BY s"
)
BROKEN_SQL = "SELECT 'oops service_name"
PROM = (
    'sum(rate(app_event_value{service_name=\\"svc«s»\\",event_type=~\\"a|b\\"}[5m])) by (event_type)'
    ' / ignoring(k8s_node_name) app_other{x=\\"$service_name\\"}'
)
VARIABLE = "SELECT DISTINCT service_name FROM telemetry_metrics.series WHERE env = {{.env}}"
DASHBOARD = (
    '{"title": "«name»", "unknown": {"b": "é", "a": null}, "variables": {"v1": {"name": "service_name", "queryValue": "«variable»"}},'
    ' "layout": [«layout»], "widgets": [«panels»]«flag»}'
)


def _part(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return spread(t.part, "p_partkey").select(
        key.alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("size"),
        (F.lit(1) + F.col("p_size") % 4).alias("n"),
        (key % 3).alias("kind"),
        F.when(key % 2 == 0, "metrics").otherwise("logs").alias("src"),
        (key % 10).alias("s"),
    )


def _each_panel(make) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), make), ", ")


def dashboards(t: Tables) -> DataFrame:
    key, name, s = F.col("id"), F.col("name"), F.col("s")

    def panel(j: Column) -> Column:
        broken = (key % BAD_PANEL == 0) & (j == 0)
        sql = F.when(broken, BROKEN_SQL).when(F.col("src") == "metrics", METRICS_SQL).otherwise(LOGS_SQL)
        return (
            F.when(F.col("kind") == 0, fill(BUILDER_PANEL, j=j, name=name, src=F.col("src"), s=s))
            .when(F.col("kind") == 1, fill(SQL_PANEL, j=j, name=name, text=sql))
            .otherwise(fill(PROM_PANEL, j=j, name=name, text=fill(PROM, s=s)))
        )

    def entry(j: Column) -> Column:
        style = (key + j) % 5
        own = F.concat(F.lit("w"), j)
        text = (
            F.when(style == 0, own)
            .when((style == 1) | ((style == 3) & (key % 7 == 0)), "")
            .when(style == 2, "empty")
            .when(style == 3, (j + 1).cast("string"))
            .otherwise(F.concat(own, F.lit("-old")))
        )
        return fill('{"i": "«i»", "h": 2, "y": «j»}', i=text, j=j)

    layout = F.concat(F.when(key % 7 == 0, '{"i": "zz", "h": 1}, ').otherwise(""), _each_panel(entry))
    text = fill(
        DASHBOARD,
        name=name,
        variable=F.when(key % BAD_VARIABLE == 0, "SELECT 'oops").otherwise(VARIABLE),
        layout=layout,
        panels=_each_panel(panel),
        flag=F.when(key % DONE == 0, ', "dotMigrated": true, "collapsableRowsMigrated": true').otherwise(""),
    )
    return _part(t).select("id", F.when(key % BROKEN_JSON == 0, F.substring(text, 1, 40)).otherwise(text).alias("data"))


# The source address holds {"builderQueries": {"A": {"dataSource": "metrics",
# "aggregateAttribute": {"key": "app_event_value"}}}}, encoded three times.
SOURCE = (
    "http://host/alerts?panel=x&compositeQuery=%25257B%252522builderQueries%252522%25253A%25257B%252522A%252522%25253A%25257B"
    "%252522dataSource%252522%25253A%252522metrics%252522%25252C%252522aggregateAttribute%252522%25253A%25257B"
    "%252522key%252522%25253A%252522app_event_value%252522%25257D%25257D%25257D%25257D&n=«s»"
)
RULE = (
    '{"alert": "«name»", "condition": {"op": "1", "target": «size», "compositeQuery": {"queryType": "«type»", "builderQueries":'
    ' {"A": {"queryName": "A", "dataSource": "«src»", "expression": "A", "aggregateAttribute": {"key": "app_event_value",'
    ' "dataType": "float64", "type": "tag"}, "groupBy": [{"key": "event_type", "dataType": "string", "type": "tag"}],'
    ' "orderBy": [{"columnName": "event_type", "order": "asc"}], "legend": "{{event_type}}"},'
    ' "F1": {"queryName": "F1", "dataSource": "", "expression": "A * 2", "legend": "{{event_type}}"}},'
    ' "chQueries": {"A": {"query": "«sql»", "disabled": false}}, "promQueries": {"A": {"query": "«prom»", "legend": "event_type"}}}},'
    ' "labels": {"service_name": "event_type is «s»", "n": 5}, "annotations": {"description": "app_event_value high", "summary": "x"},'
    ' "source": "«source»"}'
)


def rules(t: Tables) -> DataFrame:
    key = F.col("id")
    sql = F.when(key % BAD_PANEL == 0, "SELECT (1 FROM telemetry_metrics.series").when(F.col("src") == "metrics", METRICS_SQL).otherwise(LOGS_SQL)
    text = fill(
        RULE,
        name=F.col("name"),
        size=F.col("size"),
        src=F.col("src"),
        s=F.col("s"),
        type=F.when(F.col("kind") == 0, "builder").otherwise("clickhouse_sql"),
        sql=sql,
        prom=fill(PROM, s=F.col("s")),
        source=F.when(key % 4 == 0, "").otherwise(fill(SOURCE, s=F.col("s"))),
    )
    done = F.when(key % BROKEN_JSON == 0, F.substring(text, 1, 40)).when(key % DONE == 0, '{"condition": 3}').otherwise(text)
    return _part(t).select("id", done.alias("data"))


LEGACY_PANEL = (
    '{"id": "w«j»", "panelTypes": "«panel»", "title": "«name»", "extra": 1, "queryData": {"data": {"legend": "old"}}, "query": {"queryType": «type»,'
    ' "clickHouse": [{"name": "A", "rawQuery": "select «j»", "legend": "l", "disabled": true}], "promQL": [{"query": "up", "name": "A",'
    ' "legend": "", "disabled": false}], "metricsBuilder": {"formulas": [{"name": "F1", "expression": "A / 2", "legend": "f", "disabled": false}],'
    ' "queryBuilder": [{"aggregateOperator": «op», "metricName": "m«s»", "name": "A", "legend": "q", "disabled": false, "groupBy": ["g1", "g2"],'
    ' "tagFilters": {"op": "AND", "items": [{"key": "k", "op": "NIN", "value": ["a", «s»]}]}, "reduceTo": «reduce»}]}}}'
)


def legacy_dashboards(t: Tables) -> DataFrame:
    """Old builder form; every eleventh one is in the present form already."""
    key = F.col("id")

    def panel(j: Column) -> Column:
        return fill(
            LEGACY_PANEL, j=j, name=F.col("name"), s=F.col("s"), panel=F.when(key % 2 == 0, "TIME_SERIES").otherwise("VALUE"),
            type=key % 4, op=F.lit(1) + (key + j) % 31, reduce=key % 7,
        )

    old = fill('{"title": "«name»", "variables": {"v": {"type": "QUERY"}}, "widgets": [«panels»]}', name=F.col("name"), panels=_each_panel(panel))
    new = F.lit('{"widgets": [{"query": {"queryType": "builder"}}]}')
    return _part(t).select("id", F.when(key % 11 == 0, new).otherwise(old).alias("data"))


LEGACY_RULE = (
    '{"alert": "«name»", "evalWindow": «window», "frequency": "«frequency»", "extra": [1], "condition": {"op": "1", "target": «s»,'
    ' "matchType": "2", "compositeMetricQuery": {"panelType": «panel», "queryType": «type», "builderQueries": {"A": {"queryName": "A",'
    ' "metricName": "m", "aggregateOperator": «op», "expression": "A", "disabled": false, "groupBy": ["g"], "reduceTo": 2,'
    ' "tagFilters": {"op": "OR", "items": [{"key": "k", "op": "LIKE", "value": "v"}]}}}, "chQueries": {"A": {"query": "q", "disabled": true}},'
    ' "promQueries": {"A": {"query": "p", "stats": "all"}}}}}'
)


def legacy_rules(t: Tables) -> DataFrame:
    """Old rules; every eleventh one is in the present form already."""
    key = F.col("id")
    text = fill(
        LEGACY_RULE, name=F.col("name"), s=F.col("s"), window=F.col("size").cast("bigint") * 60_000_000_000,
        frequency=F.concat((key % 90).cast("string"), F.lit("m1.5s")), panel=key % 4, type=key % 5, op=F.lit(1) + key % 31,
    )
    new = F.lit('{"condition": {"compositeQuery": {"queryType": "builder"}}}')
    return _part(t).select("id", F.when(key % 11 == 0, new).otherwise(text).alias("data"))


def promql_dashboards(t: Tables) -> DataFrame:
    """The first form: panels holding a list of PromQL queries."""
    key = F.col("id")

    def panel(j: Column) -> Column:
        return fill('{"id": "w«j»", "query": [{"query": "up«j»", "legend": "l"}, {"query": "down", "legend": ""}], "keep": «s»}', j=j, s=F.col("s"))

    old = fill('{"title": "«name»", "widgets": [«panels»]}', name=F.col("name"), panels=_each_panel(panel))
    new = F.lit('{"widgets": [{"query": {"queryType": 3}}]}')
    return _part(t).select("id", F.when(key % 11 == 0, new).otherwise(old).alias("data"))
