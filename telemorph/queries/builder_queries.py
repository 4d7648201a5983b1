"""Builder queries over derived logs, spans and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemorph.operators import logs, spans
from telemorph.plans import builder as B
from telemorph.plans import spec as S
from telemorph.plans import spec_faults
from telemorph.queries.oracle_inputs import with_
from telemorph.queries.registry import query
from telemorph.sources import derived as d
from telemorph.sources import derived_specs as ds

START, END = 0, 4_000_000_000_000  # whole tables
FROM, TO = 1_704_844_800_000, 1_705_708_800_000  # ten days from 2024-01-10, where a range is asked for
STEP = 21_600
IN_RANGE = f"ms >= {START} AND ms < {END}"
BUCKET = f"(ms // {STEP * 1000}) * {STEP * 1000}"


def key(name, dtype="string", kind="tag", column=False):
    return {"key": name, "dataType": dtype, "type": kind, "isColumn": column}


VALUE, ETYPE = key("value", "float64"), key("event.type")
SERVICE, HOST = key("service.name", kind="resource"), key("host.name", kind="resource")
K, IS_ERROR, BODY = key("k", "int64"), key("is_error", "bool"), key("body", column=True)


def spec(source="logs", operator="count", name="A", **more):
    base = {
        "queryName": name, "expression": name, "dataSource": source, "aggregateOperator": operator, "stepInterval": STEP,
        "aggregateAttribute": {}, "filters": {"op": "AND", "items": []}, "groupBy": [],
    }
    return {**base, **more}


def item(k, op, value=None):
    return {"key": k, "op": op, "value": value}


def logs_source(t):
    return B.logs_source(logs.upgrade_logs_v2(d.logs_v1(t)))


def traces_source(t):
    return B.traces_source(spans.upgrade_spans_v3(d.spans_v2(t).withColumn("links", F.lit(""))))


def metrics_source(t):
    return B.metrics_source(d.samples_v4(t), d.series_v4(t))


MAKE = {"logs": logs_source, "traces": traces_source, "metrics": metrics_source}


def run(t, one, panel="graph", **more):
    sources = {one["dataSource"]: MAKE[one["dataSource"]](t)}
    return B.run_builder_query(sources, one, START, END, panel=panel, **more)


def rounded(df, digits=6):
    return df.withColumn("value", F.round("value", digits))


def series_sql(value, labels="'{}'", source="logs", where="TRUE", name="A", bucket=BUCKET):
    return (
        f"SELECT '{name}' AS query_name, {bucket} AS ts, {labels} AS labels, round(CAST({value} AS DOUBLE), 6) AS value "
        f"FROM {source} WHERE {IN_RANGE} AND {where} GROUP BY 2, 3"
    )


def by(name, column):
    return f"""'{{"{name}":"' || {column} || '"}}'"""


# ---- sources, keys, filters --------------------------------------------------------------

for _source, _cte in (("logs", "logs"), ("traces", "spans"), ("metrics", "points")):

    @query(f"b01_{_source}", with_(_cte, series_sql("count(*)", source=_cte)))
    def b01(t, source=_source):
        return run(t, spec(source))


KEYS = {
    "column": (key("severity_text", column=True), "severity_text", by("severity_text", "severity_text")),
    "resource": (HOST, "host", by("host.name", "coalesce(host, '')")),
    "string": (ETYPE, "event_type", by("event.type", "event_type")),
    "number": (K, "k", by("k", "CAST(k AS VARCHAR)")),
    "bool": (IS_ERROR, "is_error", by("is_error", "CAST(is_error AS VARCHAR)")),
}
for _name, (_key, _column, _labels) in KEYS.items():

    @query(f"b02_key_{_name}", with_("logs", series_sql("count(*)", _labels)))
    def b02(t, group=_key):
        return run(t, spec(groupBy=[group]))


FILTERS = {
    "b03_filter_and": ([item(ETYPE, "=", "error"), item(K, ">", 50)], "AND", "event_type = 'error' AND k > 50"),
    "b03_filter_or": ([item(ETYPE, "=", "error"), item(K, ">", 90)], "OR", "(event_type = 'error' OR k > 90)"),
    "b03_filter_empty": ([], "", "TRUE"),
    "b04_equal": ([item(ETYPE, "=", "click")], "AND", "event_type = 'click'"),
    "b04_not_equal": ([item(HOST, "!=", "h1")], "AND", "coalesce(host, '') <> 'h1'"),
    "b05_greater": ([item(K, ">", 60)], "AND", "k > 60"),
    "b05_greater_or_equal": ([item(K, ">=", 60)], "AND", "k >= 60"),
    "b05_less": ([item(VALUE, "<", 20.5)], "AND", "value < 20.5"),
    "b05_less_or_equal": ([item(VALUE, "<=", 20.5)], "AND", "value <= 20.5"),
    "b06_in": ([item(SERVICE, "in", ["svc1", "svc3"])], "AND", "svc IN ('svc1', 'svc3')"),
    "b06_not_in": ([item(HOST, "nin", ["h0", "h1"])], "AND", "coalesce(host, '') NOT IN ('h0', 'h1')"),
    "b07_contains": ([item(BODY, "contains", "r {")], "AND", "contains(body, 'r {')"),
    "b07_not_contains": ([item(BODY, "ncontains", "r {")], "AND", "NOT contains(body, 'r {')"),
    "b08_regex": ([item(BODY, "regex", "^(click|view).*1\\}$")], "AND", "regexp_matches(body, '^(click|view).*1\\}$')"),
    "b08_not_regex": ([item(BODY, "nregex", "^(click|view)")], "AND", "NOT regexp_matches(body, '^(click|view)')"),
    "b09_like": ([item(BODY, "like", "%k\": 1_}")], "AND", "body LIKE '%k\": 1_}'"),
    "b09_not_like": ([item(BODY, "nlike", "click%")], "AND", "body NOT LIKE 'click%'"),
    "b10_exists": ([item(HOST, "exists")], "AND", "host IS NOT NULL"),
    "b10_not_exists": ([item(HOST, "nexists")], "AND", "host IS NULL"),
}
for _name, (_items, _op, _where) in FILTERS.items():

    @query(_name, with_("logs", series_sql("count(*)", by("event.type", "event_type"), where=_where)))
    def filtered(t, items=_items, op=_op):
        return run(t, spec(groupBy=[ETYPE], filters={"op": op, "items": items}))


@query("b09_like_ignoring_case", with_("logs", series_sql("count(*)", where="body ILIKE 'CLICK%'")))
def b09_ignoring_case(t):
    return run(t, spec(filters={"op": "AND", "items": [item(BODY, "like", "CLICK%")]}), ignore_case=True)


@query("b11_step_interval", with_("logs", series_sql("count(*)", bucket="(ms // 300000) * 300000")))
def b11(t):
    return run(t, spec(stepInterval=300))


@query("b12_group_by", with_("logs", series_sql("count(*)", """'{"event.type":"' || event_type || '","service.name":"' || svc || '"}'""")))
def b12(t):
    return run(t, spec(groupBy=[SERVICE, ETYPE]))


# ---- aggregations of logs and spans -----------------------------------------------------------

LOG_VALUES = {
    "b14_count": ("count", "count(*)"),
    "b15_count_distinct": ("count_distinct", "count(DISTINCT value)"),
    "b16_sum": ("sum", "sum(value)"),
    "b17_avg": ("avg", "avg(value)"),
    "b18_min": ("min", "min(value)"),
    "b19_max": ("max", "max(value)"),
    **{f"b{20 + i}_{n}": (n, f"quantile_cont(value, {q})") for i, (n, q) in enumerate(S.QUANTILES.items())},
    "b29_rate": ("rate", f"count(*) / {float(STEP)}"),
    **{f"b{30 + i}_{f}_rate": (f"{f}_rate", f"{f}(value) / {float(STEP)}") for i, f in enumerate(S.SIMPLE)},
    **{f"b{34 + i}_rate_{f}": (f"rate_{f}", f"{f}(value) / {float(STEP)}") for i, f in enumerate(S.SIMPLE)},
}
for _name, (_operator, _sql) in LOG_VALUES.items():

    @query(f"{_name}_logs", with_("logs", series_sql(_sql, by("event.type", "event_type"))))
    def of_logs(t, operator=_operator):
        return rounded(run(t, spec(operator=operator, aggregateAttribute=VALUE, groupBy=[ETYPE])))


@query("b25_p75_traces", with_("spans", series_sql("quantile_cont(duration_nano, 0.75)", by("service.name", "svc"), source="spans")))
def b25_traces(t):
    duration = key("duration_nano", "int64", column=True)
    return rounded(run(t, spec("traces", "p75", aggregateAttribute=duration, groupBy=[SERVICE])))


@query("b13_noop_logs", with_("logs", f"""
    SELECT 'A' AS query_name, ms AS ts, '{{}}' AS labels, value FROM logs WHERE {IN_RANGE} AND event_type = 'error'"""))
def b13_logs(t):
    only = {"op": "AND", "items": [item(ETYPE, "=", "error")]}
    return run(t, spec(operator="noop", aggregateAttribute=VALUE, filters=only))


# ---- aggregations of metrics -------------------------------------------------------------------

METRIC = key("app_event_value", "float64")
M_SERVICE = key("service_name")
POINTS = f"raw AS (SELECT *, {BUCKET} AS b FROM points WHERE metric_name = 'app_event_value' AND {IN_RANGE})"
PEAKS = f"{POINTS}, peak AS (SELECT fingerprint, any_value(svc) AS svc, any_value(labels) AS labels, b, max(value) AS v FROM raw GROUP BY 1, 4)"
RATE = "CASE WHEN v < lag(v) OVER w THEN v ELSE v - lag(v) OVER w END / ((b - lag(b) OVER w) / 1000.0)"
RATES = f"{PEAKS}, rates AS (SELECT *, {RATE} AS r FROM peak WINDOW w AS (PARTITION BY fingerprint ORDER BY b))"
SERVICE_LABELS = by("service_name", "svc")

METRIC_VALUES = {
    "b14_count": ("count", "count(*)"),
    "b15_count_distinct": ("count_distinct", "count(DISTINCT value)"),
    "b16_sum": ("sum", "sum(value)"),
    "b17_avg": ("avg", "avg(value)"),
    "b18_min": ("min", "min(value)"),
    "b19_max": ("max", "max(value)"),
    "b24_p50": ("p50", "quantile_cont(value, 0.5)"),
    "b28_p99": ("p99", "quantile_cont(value, 0.99)"),
}
for _name, (_operator, _sql) in METRIC_VALUES.items():

    @query(f"{_name}_metrics", with_("points", f"""
        WITH {POINTS} SELECT 'A' AS query_name, b AS ts, {SERVICE_LABELS} AS labels, round(CAST({_sql} AS DOUBLE), 6) AS value FROM raw GROUP BY 2, 3"""))
    def of_metrics(t, operator=_operator):
        return rounded(run(t, spec("metrics", operator, aggregateAttribute=METRIC, groupBy=[M_SERVICE])))


@query("b13_noop_metrics", with_("points", f"""
    WITH {POINTS} SELECT 'A' AS query_name, ms AS ts, labels, value FROM raw"""))
def b13_metrics(t):
    return run(t, spec("metrics", "noop", aggregateAttribute=METRIC))


@query("b29_rate_metrics", with_("points", f"""
    WITH {RATES} SELECT 'A' AS query_name, b AS ts, labels, round(r, 9) AS value FROM rates WHERE r IS NOT NULL"""))
def b29_metrics(t):
    return rounded(run(t, spec("metrics", "rate", aggregateAttribute=METRIC)), 9)


for _i, _fn in enumerate(S.SIMPLE):

    @query(f"b{30 + _i}_{_fn}_rate_metrics", with_("points", f"""
        WITH {RATES} SELECT 'A' AS query_name, b AS ts, {SERVICE_LABELS} AS labels, round({_fn}(r), 9) AS value FROM rates WHERE r IS NOT NULL GROUP BY 2, 3"""))
    def series_rate(t, fn=_fn):
        return rounded(run(t, spec("metrics", f"{fn}_rate", aggregateAttribute=METRIC, groupBy=[M_SERVICE])), 9)

    @query(f"b{34 + _i}_rate_{_fn}_metrics", with_("points", f"""
        WITH {PEAKS}, grouped AS (SELECT svc, b, {_fn}(v) AS v FROM peak GROUP BY 1, 2),
        rates AS (SELECT svc, b, {RATE} AS r FROM grouped WINDOW w AS (PARTITION BY svc ORDER BY b))
        SELECT 'A' AS query_name, b AS ts, {SERVICE_LABELS} AS labels, round(r, 9) AS value FROM rates WHERE r IS NOT NULL"""))
    def group_rate(t, fn=_fn):
        return rounded(run(t, spec("metrics", f"rate_{fn}", aggregateAttribute=METRIC, groupBy=[M_SERVICE])), 9)


def histogram_source(t):
    """The quantity histogram as a metric: one series per flag and bound."""
    rows = d.quantity_histogram(t)
    bound = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    rows = rows.withColumn("labels", F.to_json(F.struct(F.lit("line_quantity_bucket").alias("__name__"), bound.alias("le"), F.col("l_returnflag").alias("returnflag"))))
    rows = rows.withColumn("fingerprint", F.xxhash64("labels"))
    points = rows.select(
        F.lit("line_quantity_bucket").alias("metric_name"), "fingerprint", "labels", "value",
        F.unix_millis(F.to_timestamp(F.concat("month", F.lit("-01")))).alias("unix_milli"),
    )
    return B.metrics_source(points.drop("labels"), points.drop("value"))


def hist_quantile_sql(q, out):
    return f"""
    h AS (SELECT *, coalesce(lag(value) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS lo, max(value) OVER (PARTITION BY l_returnflag, month) * {q} AS rank
          FROM hist WINDOW w AS (PARTITION BY l_returnflag, month ORDER BY le)),
    c AS (SELECT * FROM h WHERE value >= rank AND rank > 0 QUALIFY row_number() OVER (PARTITION BY l_returnflag, month ORDER BY le) = 1),
    {out} AS (SELECT l_returnflag, month, CASE WHEN le = 'infinity'::DOUBLE THEN lo ELSE lo + (le - lo) * (rank - below) / (value - below) END AS v FROM c)"""


for _i, (_name, _q) in enumerate(S.HIST_QUANTILES.items()):

    @query(f"b{38 + _i}_{_name}", with_("hist", f"""
        WITH {hist_quantile_sql(_q, 'res')}
        SELECT 'A' AS query_name, epoch_ms(strptime(month || '-01', '%Y-%m-%d')) AS ts, {by('returnflag', 'l_returnflag')} AS labels, round(v, 6) AS value FROM res"""))
    def hist(t, operator=_name):
        one = spec("metrics", operator, aggregateAttribute=key("line_quantity_bucket", "float64"), groupBy=[key("returnflag")], stepInterval=86_400)
        return rounded(B.run_builder_query({"metrics": histogram_source(t)}, one, 0, 2_000_000_000_000))


# ---- after the aggregation ---------------------------------------------------------------------------


@query("b44_having", with_("logs", f"""
    SELECT * FROM ({series_sql('count(*)', by('service.name', 'svc'))}) WHERE value > 10 AND value <> 12"""))
def b44(t):
    having = [{"columnName": "value", "op": ">", "value": 10}, {"columnName": "value", "op": "!=", "value": 12}]
    return run(t, spec(groupBy=[SERVICE], having=having))


@query("b45_order_by", with_("logs", f"{series_sql('count(*)', by('service.name', 'svc'))} ORDER BY 4 DESC, 3, 2"))
def b45(t):
    return run(t, spec(groupBy=[SERVICE], orderBy=[{"columnName": "value", "order": "desc"}]))


@query("b46_limit_groups", with_("logs", f"""
    WITH s AS ({series_sql('sum(value)', by('service.name', 'svc'))})
    SELECT * FROM s WHERE labels IN (SELECT labels FROM s GROUP BY 1 ORDER BY sum(value) DESC, labels LIMIT 3)"""))
def b46_groups(t):
    return rounded(run(t, spec(operator="sum", aggregateAttribute=VALUE, groupBy=[SERVICE], limit=3)))


@query("b46_limit_rows", with_("logs", f"""
    SELECT 'A' AS query_name, ms AS ts, '{{"body":"' || replace(body, '"', '\\"') || '","event.type":"' || event_type || '"}}' AS labels
    FROM logs WHERE {IN_RANGE} ORDER BY ms DESC, id LIMIT 25 OFFSET 50"""))
def b46_rows(t):
    return run(t, spec(operator="noop", selectColumns=[BODY, ETYPE], offset=50, pageSize=25), panel="list").drop("value")


@query("b47_select_columns", with_("logs", f"""
    SELECT 'A' AS query_name, ms AS ts, '{{"k":"' || CAST(k AS VARCHAR) || '","service.name":"' || svc || '"}}' AS labels
    FROM logs WHERE {IN_RANGE} AND is_error"""))
def b47(t):
    only = {"op": "AND", "items": [item(IS_ERROR, "=", True)]}
    order = [{"columnName": "timestamp", "order": "asc"}]
    return run(t, spec(operator="noop", selectColumns=[K, SERVICE], filters=only, orderBy=order), panel="list").drop("value")


SERIES = series_sql("sum(value)", by("service.name", "svc"))
for _how, _sql in {"last": "arg_max(value, ts)", "sum": "sum(value)", "avg": "avg(value)", "min": "min(value)", "max": "max(value)"}.items():

    @query(f"b48_reduce_{_how}", with_("logs", f"""
        SELECT 'A' AS query_name, labels, round({_sql}, 6) AS value FROM ({SERIES}) GROUP BY labels"""))
    def reduced(t, how=_how):
        out = run(t, spec(operator="sum", aggregateAttribute=VALUE, groupBy=[SERVICE], reduceTo=how), panel="table")
        return rounded(out).drop("ts")


FORMULA = {
    "A": spec(operator="sum", aggregateAttribute=VALUE, groupBy=[ETYPE], disabled=True),
    "B": spec(name="B", groupBy=[ETYPE]),
    "F1": {"queryName": "F1", "expression": "(A / B) * 100 - 1"},
}


@query("b49_formula", with_("logs", series_sql("sum(value) / count(*) * 100 - 1", by("event.type", "event_type"), name="F1")))
def b49(t):
    sources = {"logs": logs_source(t)}
    results = {n: B.run_builder_query(sources, FORMULA[n], START, END) for n in ("A", "B")}
    return rounded(B.run_formula(results, FORMULA["F1"]["expression"], "F1"))


@query("b50_panel_value", with_("logs", f"""
    SELECT 'A' AS query_name, '{{}}' AS labels, avg(value) AS value FROM ({series_sql('count(*)')})"""))
def b50_value(t):
    return run(t, spec(reduceTo="avg"), panel="value").drop("ts")


@query("b50_panel_table", with_("logs", f"""
    SELECT 'A' AS query_name, labels, sum(value) AS value FROM ({series_sql('count(*)', by('service.name', 'svc'))}) GROUP BY labels
    ORDER BY value DESC, labels LIMIT 4"""))
def b50_table(t):
    order = [{"columnName": "value", "order": "desc"}]
    return run(t, spec(groupBy=[SERVICE], reduceTo="sum", limit=4, orderBy=order), panel="table").drop("ts")


@query("b51_composite", with_("logs spans", f"""
    {series_sql('count(*)', by('event.type', 'event_type'), name='B')}
    UNION ALL {series_sql('sum(value) / count(*) * 100 - 1', by('event.type', 'event_type'), name='F1')}
    UNION ALL {series_sql('count(*)', by('service.name', 'svc'), source='spans', name='C')}"""))
def b51(t):
    queries = {**FORMULA, "C": spec("traces", name="C", groupBy=[SERVICE])}
    composite = {"queryType": "builder", "panelType": "graph", "builderQueries": queries}
    return rounded(B.run_composite({"logs": logs_source(t), "traces": traces_source(t)}, composite, START, END))


@query("b53_range_step_variables", with_("logs", f"""
    SELECT 'A' AS query_name, (ms // 3600000) * 3600000 AS ts, '{{}}' AS labels, CAST(count(*) AS DOUBLE) AS value FROM logs
    WHERE ms >= {FROM + 1000} AND ms < {TO - 7_200_000} AND svc IN ('svc2', 'svc4') AND event_type = 'view' GROUP BY 2"""))
def b53(t):
    items = [item(SERVICE, "in", "{{.services}}"), item(ETYPE, "=", "$kind")]
    composite = {"queryType": "builder", "panelType": "graph", "builderQueries": {"A": spec(filters={"op": "AND", "items": items})}}
    variables = {"services": ["svc2", "svc4"], "kind": "view"}
    return B.run_composite({"logs": logs_source(t)}, composite, FROM + 1000, TO - 7_200_000, variables, step=3600)


@query("b54_result_values", with_("logs", f"""
    SELECT ts, labels, CASE WHEN value = trunc(value) THEN CAST(CAST(value * 1000000 AS BIGINT) AS VARCHAR) ELSE '?' END AS text
    FROM ({series_sql('count(*)', by('event.type', 'event_type'))})"""))
def b54(t):
    out = run(t, spec(groupBy=[ETYPE]))
    return out.select("ts", "labels", B.point_text(F.col("value") * 1_000_000).alias("text"))


# ---- rules ------------------------------------------------------------------------------------------------

MATCHES = {
    "none": ("0", "FALSE"),
    "at_least_once": ("1", "bool_or(value > 60)"),
    "all_the_times": ("2", "bool_and(value > 60)"),
    "on_average": ("3", "avg(value) > 60"),
    "in_total": ("4", "sum(value) > 60"),
}
HOURLY = "SELECT '{\"service.name\":\"' || svc || '\"}' AS labels, (ms // 3600000) * 3600000 AS ts, max(value) AS value FROM logs GROUP BY 1, 2"


def hourly_peaks(t):
    one = spec(operator="max", aggregateAttribute=VALUE, groupBy=[SERVICE], stepInterval=3600)
    return B.run_builder_query({"logs": logs_source(t)}, one, START, END)


for _name, (_code, _sql) in MATCHES.items():

    @query(f"b58_{_name}", with_("logs", f"WITH h AS ({HOURLY}) SELECT labels, {_sql} AS matched FROM h WHERE ts > {START} AND ts <= {END} GROUP BY 1"))
    def rule_matches(t, code=_code):
        points = hourly_peaks(t).where((F.col("ts") > START) & (F.col("ts") <= END))
        return B.match_series(points, {"op": ">", "target": 60, "matchType": code})


DAY = 86_400_000


@query("b59_rule_states", with_("logs", f"""
    WITH h AS ({HOURLY}),
    n AS (SELECT labels, avg(value) > 27 AS matched FROM h WHERE ts > {TO - DAY} AND ts <= {TO} GROUP BY 1),
    p AS (SELECT labels, avg(value) > 27 AS matched FROM h WHERE ts > {TO - 2 * DAY} AND ts <= {TO - DAY} GROUP BY 1)
    SELECT n.labels, n.matched, CASE WHEN NOT n.matched THEN 'inactive' WHEN coalesce(p.matched, FALSE) THEN 'firing' ELSE 'pending' END AS state
    FROM n LEFT JOIN p USING (labels)
    UNION ALL SELECT labels, matched, 'disabled' FROM n"""))
def b59(t):
    rule = {"op": ">", "target": 27, "matchType": "3"}
    points = hourly_peaks(t)
    active = B.evaluate_rule(points, rule, TO, DAY)
    return active.unionByName(B.evaluate_rule(points, {**rule, "disabled": True}, TO, DAY))


# ---- checks of stored specifications ---------------------------------------------------

SPEC = """SELECT event_id AS id, CASE WHEN event_id % 11 = 0 THEN '' ELSE 'A' END AS name,
      CASE WHEN event_id % 7 = 0 THEN 'A+B' WHEN event_id % 13 = 0 THEN '' ELSE 'A' END AS expr,
      ['traces', 'logs', 'metrics', 'metrics', 'files'][user_id % 5 + 1] AS source,
      ['count', 'sum', 'noop', 'rate', 'p95', 'median'][abs(k) % 6 + 1] AS op, event_id % 3 <> 0 AS has_attr, user_id % 2 = 0 AS grouped,
      event_type, k, user_id, event_id FROM ev"""
FAULTS = """SELECT id, 'queryName is missing' AS fault FROM s WHERE name = ''
    UNION ALL SELECT id, 'expression is missing' FROM s WHERE expr = ''
    UNION ALL SELECT id, 'no data source is called ''files''' FROM s WHERE name = expr AND source = 'files'
    UNION ALL SELECT id, 'no aggregation is called ''median''' FROM s WHERE name = expr AND op = 'median'
    UNION ALL SELECT id, '''' || op || ''' over metrics needs an attribute' FROM s
      WHERE name = expr AND source = 'metrics' AND op NOT IN ('noop', 'count') AND NOT has_attr
    UNION ALL SELECT id, 'filters are joined by AND or OR' FROM s WHERE event_type = 'error'
    UNION ALL SELECT id, 'filter 1: no data type is called ''text''' FROM s WHERE k % 4 = 0
    UNION ALL SELECT id, 'filter 2: it has no name' FROM s WHERE event_id % 17 = 0
    UNION ALL SELECT id, 'filter 2: a column must be a tag or a resource' FROM s WHERE event_id % 5 = 0
    UNION ALL SELECT id, '''' || op || ''' over metrics cannot be grouped' FROM s WHERE source = 'metrics' AND grouped AND op IN ('noop', 'rate')"""


@query("b43_query_faults", with_("ev", f"""
    WITH s AS ({SPEC} WHERE event_id % 23 <> 0) {FAULTS}
    UNION ALL SELECT event_id, 'it is no JSON object' FROM ev WHERE event_id % 23 = 0"""))
def b43(t):
    return spec_faults.list_query_faults(ds.builder_specs(t))


@query("b52_request_faults", with_("ev", f"""
    WITH s AS ({SPEC} WHERE user_id % 9 <> 0), f AS ({FAULTS})
    SELECT id, 'query A: ' || fault AS fault FROM f
    UNION ALL SELECT event_id, 'query C: its text is missing' FROM ev WHERE event_id % 4 = 0 AND event_id % 19 = 0
    UNION ALL SELECT event_id, 'there is no query' FROM ev WHERE user_id % 9 = 0 AND event_id % 4 <> 0
    UNION ALL SELECT event_id, 'no panelType is called ''pie''' FROM ev WHERE abs(k) % 5 = 4
    UNION ALL SELECT event_id, 'no queryType is called ''sql''' FROM ev WHERE user_id % 4 = 3"""))
def b52(t):
    return spec_faults.list_request_faults(ds.request_specs(t))


# ---- rule states over time -----------------------------------------------------------------

RULE_STEP = 6 * 3_600_000


@query("b59_rule_history", with_("logs", f"""
    WITH h AS ({HOURLY}),
    lent AS (SELECT labels, (unnest(range((ts + {RULE_STEP} - 1) // {RULE_STEP}, (ts + {RULE_STEP} - 1) // {RULE_STEP} + {DAY // RULE_STEP}))) * {RULE_STEP} AS t, value FROM h),
    m AS (SELECT labels, t, avg(value) > 27 AS matched FROM lent GROUP BY 1, 2),
    b AS (SELECT m.labels, m.t, m.matched, coalesce(w.matched, FALSE) AS before, coalesce(p.matched, FALSE) AS previous
          FROM m LEFT JOIN m w ON w.labels = m.labels AND w.t = m.t - {DAY} LEFT JOIN m p ON p.labels = m.labels AND p.t = m.t - {RULE_STEP}),
    g AS (SELECT *, max(CASE WHEN matched AND NOT previous THEN t END) OVER (PARTITION BY labels ORDER BY t) AS begun FROM b)
    SELECT labels, t AS ts, matched, CASE WHEN NOT matched THEN 'inactive' WHEN before THEN 'firing' ELSE 'pending' END AS state,
           CASE WHEN matched THEN begun END AS since
    FROM g"""))
def b59_history(t):
    return B.rule_states(hourly_peaks(t), {"op": ">", "target": 27, "matchType": "3"}, RULE_STEP, DAY)
