"""Request shapes over derived spans, errors and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemorph.operators import errors, logs, spans
from telemorph.plans import requests as R
from telemorph.queries.oracle_inputs import with_
from telemorph.queries.registry import query
from telemorph.sources import derived as d

T0, T1 = "1970-01-01 00:00:00", "2096-10-02 00:00:00"  # whole tables
FROM, TO = "2024-01-10 00:00:00", "2024-01-20 00:00:00"  # where a range is asked for
IN_RANGE = f"ts >= TIMESTAMP '{T0}' AND ts <= TIMESTAMP '{T1}'"


def ts(text):
    return F.lit(text).cast("timestamp")


def span_rows(t):
    return spans.upgrade_spans_v3(d.spans_v2(t).withColumn("links", F.lit("")))


def error_rows(t):
    return errors.upgrade_errors(d.errors_v1(t))


def log_rows(t):
    return logs.upgrade_logs_v2(d.logs_v1(t))


# ---- tag predicates -----------------------------------------------------------------

TAGS = {
    "in": (("event.type", R.SPAN, "In", ["click", "view"]), "event_type IN ('click', 'view')"),
    "not_in": (("event.type", R.SPAN, "NotIn", ["click", "view"]), "event_type NOT IN ('click', 'view')"),
    "equals": (("service.name", R.RESOURCE, "Equals", ["svc3"]), "svc = 'svc3'"),
    "not_equals": (("host.name", R.RESOURCE, "NotEquals", ["h1"]), "coalesce(host <> 'h1', TRUE)"),
    "exists": (("host.name", R.RESOURCE, "Exists", []), "host IS NOT NULL"),
    "not_exists": (("host.name", R.RESOURCE, "NotExists", []), "host IS NULL"),
    "contains": (("http.route", R.SPAN, "Contains", ["r/3", "r/4"]), "(contains(route, 'r/3') OR contains(route, 'r/4'))"),
    "not_contains": (("http.route", R.SPAN, "NotContains", ["r/3"]), "NOT contains(route, 'r/3')"),
    "less": (("k", R.SPAN, "LessThan", [20]), "k < 20"),
    "less_or_equal": (("k", R.SPAN, "LessThanEquals", [20.0]), "k <= 20"),
    "greater": (("k", R.SPAN, "GreaterThan", [80]), "k > 80"),
    "greater_or_equal": (("k", R.SPAN, "GreaterThanEquals", [80]), "k >= 80"),
    "starts_with": (("event.type", R.SPAN, "StartsWith", ["cl", "pu"]), "(starts_with(event_type, 'cl') OR starts_with(event_type, 'pu'))"),
    "not_starts_with": (("event.type", R.SPAN, "NotStartsWith", ["cl"]), "NOT starts_with(event_type, 'cl')"),
    "bool": (("even", R.SPAN, "Equals", [True]), "even"),
}
for _name, (_tag, _where) in TAGS.items():

    @query(f"c01_tag_{_name}", with_("spans", f"SELECT span_id FROM spans WHERE {_where}"))
    def tagged(t, tag=_tag):
        return span_rows(t).where(R.tag_predicate(*tag)).select("span_id")


@query("c01_string_tag_of_numeric_value", with_("spans", """
    SELECT span_id, 'string' AS kind FROM spans WHERE k + 1 = 5 UNION ALL SELECT span_id, 'number' FROM spans WHERE k = 5
    UNION ALL SELECT span_id, 'not' FROM spans WHERE k + 1 NOT IN (5, 7)"""))
def c01_data_type(t):
    """The data type decides where one name stands for a text and for a number."""
    rows = span_rows(t)
    rows = rows.withColumn("attributes_string", F.map_concat("attributes_string", F.create_map(F.lit("k"), (F.col("attributes_number")["k"] + 1).cast("long").cast("string"))))
    tests = {"string": ("Equals", [5], "string"), "number": ("Equals", ["5"], "number"), "not": ("NotIn", [5, 7.0], "string")}
    kinds = [F.when(R.tag_predicate("k", R.SPAN, *test), F.lit(kind)) for kind, test in tests.items()]
    return rows.select("span_id", F.explode(F.array_compact(F.array(*kinds))).alias("kind"))


# ---- spans ----------------------------------------------------------------------------

OVERVIEW = """count(*) AS calls, round(avg(duration_nano), 2) AS avg_duration, count(*) FILTER (WHERE has_error) AS errors,
    round(quantile_cont(duration_nano, 0.99), 2) AS p99, round(count(*) FILTER (WHERE has_error) / count(*), 9) AS error_rate"""


def _rounded(df):
    return df.withColumns({"avg_duration": F.round("avg_duration", 2), "p99": F.round("p99", 2), "error_rate": F.round("error_rate", 9)})


@query("c02_service_list", with_("spans", f"SELECT svc AS service, {OVERVIEW} FROM spans WHERE ts >= TIMESTAMP '{FROM}' AND ts <= TIMESTAMP '{TO}' GROUP BY 1"))
def c02(t):
    return _rounded(R.service_overview(span_rows(t), ts(FROM), ts(TO)))


@query("c02_service_overview", with_("spans", f"""
    SELECT svc AS service, us // 1000000 // 86400 * 86400 AS bucket, {OVERVIEW} FROM spans WHERE {IN_RANGE} GROUP BY 1, 2"""))
def c02_steps(t):
    return _rounded(R.service_overview(span_rows(t), ts(T0), ts(T1), step=86_400))


@query("c03_top_operations", with_("spans", """
    SELECT name, round(quantile_cont(duration_nano, 0.5), 2) AS p50, round(quantile_cont(duration_nano, 0.95), 2) AS p95, round(quantile_cont(duration_nano, 0.99), 2) AS p99,
      count(*) AS calls, count(*) FILTER (WHERE has_error) AS errors FROM spans WHERE svc = 'svc3' GROUP BY 1 ORDER BY quantile_cont(duration_nano, 0.99) DESC, name LIMIT 3"""))
def c03(t):
    out = R.top_operations(span_rows(t), "svc3", 3)
    return out.withColumns({p: F.round(p, 2) for p in ("p50", "p95", "p99")})


@query("c04_usage", with_("spans", "SELECT us // 1000000 // 7200 * 7200 AS bucket, count(*) AS count FROM spans GROUP BY 1"))
def c04(t):
    return R.usage(span_rows(t), 2)


PARAMS = {
    "start": T0, "end": T1, "serviceName": ["svc1", "svc2", "svc3"], "operation": ["click"], "exclude": ["operation"],
    "minDuration": 1_000_000, "maxDuration": 60_000_000,
}
WHERE = f"{IN_RANGE} AND svc IN ('svc1', 'svc2', 'svc3') AND name <> 'click' AND duration_nano BETWEEN 1000000 AND 60000000"


def params(**more):
    return {**PARAMS, "start": ts(T0), "end": ts(T1), **more}


@query("c05_filtered_spans", with_("spans", f"""
    SELECT span_id, duration_nano FROM spans WHERE {WHERE} AND even ORDER BY duration_nano, span_id LIMIT 40 OFFSET 20"""))
def c05(t):
    tags = [{"key": "even", "operator": "Equals", "values": [True]}]
    page = params(limit=40, offset=20, orderParam="duration", order="ascending", tags=tags)
    return R.filtered_spans(span_rows(t), page).select("span_id", "duration_nano")


AGGREGATES = {
    "calls": (("calls", "count"), "CAST(count(*) AS DOUBLE)"),
    "calls_rate": (("calls", "rate_per_sec"), "count(*) / 86400.0"),
    "duration_avg": (("duration", "avg"), "avg(duration_nano)"),
    "duration_max": (("duration", "max"), "CAST(max(duration_nano) AS DOUBLE)"),
    "duration_p95": (("duration", "p95"), "quantile_cont(duration_nano, 0.95)"),
    "error_rate": (("error", "rate"), "count(*) FILTER (WHERE has_error) / count(*)"),
}
for _name, ((_dimension, _how), _sql) in AGGREGATES.items():

    @query(f"c06_span_aggregates_{_name}", with_("spans", f"""
        SELECT us // 1000000 // 86400 * 86400 AS bucket, http_method AS "group", round({_sql}, 6) AS value FROM spans WHERE {WHERE} GROUP BY 1, 2"""))
    def c06(t, dimension=_dimension, how=_how):
        wanted = params(step=86_400, groupBy="httpMethod", dimension=dimension, aggregationOption=how)
        return R.span_aggregates(span_rows(t), wanted).withColumn("value", F.round("value", 6))


@query("c07_span_facets", with_("spans", f"""
    WITH m AS (SELECT * FROM spans WHERE {WHERE})
    SELECT 'serviceName' AS facet, svc AS value, count(*) AS count FROM m GROUP BY 2
    UNION ALL SELECT 'status', CASE WHEN has_error THEN 'error' ELSE 'ok' END, count(*) FROM m GROUP BY 2
    UNION ALL SELECT 'httpUrl', http_url, count(*) FROM m GROUP BY 2"""))
def c07(t):
    return R.span_facets(span_rows(t), params(getFilters=["serviceName", "status", "httpUrl"]))


@query("c08_tag_keys", with_("spans", """
    SELECT * FROM (VALUES ('event.type', 'string'), ('http.route', 'string'), ('k', 'number'), ('even', 'bool')) v(key, kind) WHERE (SELECT count(*) FROM spans) > 0"""))
def c08_keys(t):
    return R.tag_keys(span_rows(t))


@query("c08_tag_values", with_("spans", "SELECT DISTINCT route AS value FROM spans ORDER BY 1 LIMIT 3"))
def c08(t):
    return R.tag_values(span_rows(t), "http.route", "string", 3)


# ---- errors ---------------------------------------------------------------------------------


@query("c09_list_errors", with_("errors_v1", f"""
    SELECT md5("serviceName" || "exceptionType" || "exceptionMessage") AS "groupID", any_value("exceptionType") AS "exceptionType",
      any_value("serviceName") AS "serviceName", count(*) AS "exceptionCount", min(us) AS first_us, max(us) AS last_us
    FROM errors_v1 WHERE {IN_RANGE} GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 15 OFFSET 5"""))
def c09(t):
    out = R.list_errors(error_rows(t), {"start": ts(T0), "end": ts(T1), "limit": 15, "offset": 5})
    return out.select(
        "groupID", "exceptionType", "serviceName", "exceptionCount",
        F.unix_micros("firstSeen").alias("first_us"), F.unix_micros("lastSeen").alias("last_us"),
    )


@query("c09_count_errors", with_("errors_v1", f"""
    SELECT count(DISTINCT "exceptionType" || "exceptionMessage") AS count FROM errors_v1 WHERE {IN_RANGE} AND "serviceName" = 'svc4'"""))
def c09_count(t):
    return R.count_errors(error_rows(t), {"start": ts(T0), "end": ts(T1), "serviceName": "svc4"})


@query("c09_get_error", with_("errors_v1", """
    WITH g AS (SELECT *, md5("serviceName" || "exceptionType" || "exceptionMessage") AS gid FROM errors_v1)
    SELECT gid AS "groupID", "errorID", us FROM g WHERE gid = (SELECT max(gid) FROM g) ORDER BY us DESC, "errorID" LIMIT 1"""))
def c09_get(t):
    rows = error_rows(t)
    last_group = rows.agg(F.max("groupID").alias("g")).first()["g"]
    return R.get_error(rows, last_group).select("groupID", "errorID", F.unix_micros("timestamp").alias("us"))


# ---- logs -------------------------------------------------------------------------------------


@query("c10_logs_page", with_("logs", """
    SELECT id, ns FROM logs WHERE contains(body, 'error') AND ns BETWEEN 1704844800000000000 AND 1705708800000000000 AND id > 'log5' ORDER BY id LIMIT 30"""))
def c10(t):
    page = {"timestampStart": 1_704_844_800 * 10**9, "timestampEnd": 1_705_708_800 * 10**9, "q": "error", "idGt": "log5", "limit": 30}
    return R.logs_page(log_rows(t), page).select("id", F.col("timestamp").alias("ns"))


@query("c10_logs_aggregate", with_("logs", """
    SELECT ns // 1000000000 // 21600 * 21600 AS bucket, severity_text AS "group", count(*) AS count FROM logs GROUP BY 1, 2"""))
def c10_aggregate(t):
    return R.logs_aggregate(log_rows(t), {"step": 21_600, "groupBy": "severity_text"})


@query("c11_suggest_attributes", with_("logs", """
    SELECT * FROM (VALUES ('event.type', 'string', 'tag'), ('host.name', 'string', 'resource'), ('is_error', 'bool', 'tag'), ('service.name', 'string', 'resource'), ('value', 'float64', 'tag')) v("key", "dataType", "type")
    WHERE (SELECT count(*) FROM logs) > 0 ORDER BY 1 LIMIT 4"""))
def c11(t):
    return R.suggest_attributes(log_rows(t), "e", 4)


@query("c11_suggest_values", with_("logs", "SELECT DISTINCT event_type AS value FROM logs WHERE contains(event_type, 'i') ORDER BY 1 LIMIT 2"))
def c11_values(t):
    return R.suggest_values(log_rows(t), "attributes_string", "event.type", "i", 2)


@query("c12_ttl_request", with_("logs", """
    SELECT id, CASE WHEN ns // 1000000000 + 432000 <= 1706572800 THEN 's3' ELSE 'hot' END AS tier FROM logs WHERE ns // 1000000000 + 1296000 > 1706572800"""))
def c12(t):
    from telemorph.operators import retention

    kept = retention.apply_retention(log_rows(t), "logs", 1_296_000, 1_706_572_800)
    return retention.assign_tier(kept, "logs", 432_000, 1_706_572_800, "s3").select("id", "tier")
