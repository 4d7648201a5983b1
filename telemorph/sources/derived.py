"""Telemetry tables derived row by row from the stored tables.

The stored tables hold no telemetry in the old layouts, so the queries derive
it: every event becomes an error, span, log line and metric point, every part a
dashboard, alert rule and table definition. All expressions are deterministic,
and edge cases (missing, duplicate and clashing values) are planted by event id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemorph.functions.scalars import int_div, ts_to_ns
from telemorph.sources.tables import Tables

# Instant at which metric names change from the normalized to the original form.
CUTOVER = "2024-01-20 00:00:00"


def events(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        "ts",
        F.unix_micros("ts").alias("us"),
        "user_id",
        "event_type",
        "value",
        "props",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.concat(F.lit("svc"), F.col("user_id") % 10).alias("svc"),
    )


def errors_v1(t: Tables) -> DataFrame:
    eid = F.col("event_id")
    return events(t).where("event_type = 'error'").select(
        F.md5(eid.cast("string")).alias("errorID"),
        F.concat(F.lit("Err"), F.col("user_id") % 7).alias("exceptionType"),
        F.col("props").alias("exceptionStacktrace"),
        F.when(eid % 3 == 0, "True").when(eid % 3 == 1, "false").otherwise("").alias("exceptionEscaped"),
        F.concat(F.lit("k="), F.col("k") % 5).alias("exceptionMessage"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("s"), eid).alias("spanID"),
        F.concat(F.lit("t"), int_div(eid, 8)).alias("traceID"),
        F.concat(F.lit("s"), eid - 1).alias("parentSpanID"),
        F.col("svc").alias("serviceName"),
    )


_EMPTY_SPAN_TEXTS = [
    "externalHttpMethod", "externalHttpUrl", "component", "dbSystem", "dbOperation", "dbName", "peerService",
    "httpCode", "httpMethod", "httpUrl", "httpRoute", "httpHost", "gRPCMethod", "msgSystem", "msgOperation",
]


def spans_v1(t: Tables) -> DataFrame:
    eid = F.col("event_id")
    empty = F.array().cast("array<string>")
    return events(t).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("s"), eid).alias("spanID"),
        F.concat(F.lit("t"), int_div(eid, 8)).alias("traceID"),
        F.when(eid % 8 == 0, "").otherwise(F.concat(F.lit("s"), eid - 1)).alias("parentSpanID"),
        F.col("svc").alias("serviceName"),
        F.col("event_type").alias("name"),
        # Beyond eight bits for some rows, to show the wrap.
        (eid % 6 + F.when(eid % 50 == 0, 256).otherwise(0)).cast("int").alias("kind"),
        F.when(F.col("event_type") == "error", F.lit(2) + F.when(eid % 4 == 0, 65536).otherwise(0)).otherwise(0).cast("bigint").alias("statusCode"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("hasError"),
        F.round(F.col("value") * 1e6).cast("bigint").alias("durationNano"),
        F.when(eid % 3 == 0, empty).otherwise(F.array("event_type")).alias("events"),
        empty.alias("tags"),
        F.array(F.lit("event.type"), F.lit("k")).alias("tagsKeys"),
        F.array(F.col("event_type"), F.col("k").cast("string")).alias("tagsValues"),
        F.create_map(F.lit("k"), F.col("k").cast("string"), F.lit("event.type"), F.col("event_type")).alias("tagMap"),
        F.when(eid % 7 == 0, "").otherwise(F.col("props")).alias("references"),
        F.concat(F.lit("g"), eid % 2).alias("gRPCCode"),
        *[F.lit("").alias(c) for c in _EMPTY_SPAN_TEXTS],
    )


def spans_v2(t: Tables) -> DataFrame:
    eid, error = F.col("event_id"), F.col("event_type") == "error"
    return events(t).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("t"), int_div(eid, 8)).alias("traceID"),
        F.concat(F.lit("s"), eid).alias("spanID"),
        F.when(eid % 8 == 0, "").otherwise(F.concat(F.lit("s"), eid - 1)).alias("parentSpanID"),
        F.col("event_type").alias("name"),
        (eid % 6).cast("tinyint").alias("kind"),
        F.concat(F.lit("kind"), eid % 6).alias("spanKind"),
        F.round(F.col("value") * 1e6).cast("bigint").alias("durationNano"),
        F.when(error, 2).otherwise(0).cast("smallint").alias("statusCode"),
        F.lit("").alias("statusMessage"),
        F.when(error, "Error").otherwise("Unset").alias("statusCodeString"),
        F.create_map(F.lit("event.type"), F.col("event_type"), F.lit("http.route"), F.concat(F.lit("/r/"), F.col("k") % 5)).alias("stringTagMap"),
        F.create_map(F.lit("k"), F.col("k").cast("double")).alias("numberTagMap"),
        F.create_map(F.lit("even"), F.col("k") % 2 == 0).alias("boolTagMap"),
        _resource_map().alias("resourceTagsMap"),
        F.array("event_type").alias("events"),
        F.lit("").alias("externalHttpMethod"),
        F.lit("").alias("externalHttpUrl"),
        F.lit("").alias("dbName"),
        F.lit("").alias("dbOperation"),
        F.when(F.col("event_type") == "purchase", "POST").otherwise("GET").alias("httpMethod"),
        F.concat(F.lit("/u/"), F.col("k") % 5).alias("httpUrl"),
        F.lit("").alias("httpHost"),
        error.alias("hasError"),
        F.when(error, "500").otherwise("200").alias("responseStatusCode"),
        F.lit("unknown").alias("isRemote"),
    )


def _resource_map():
    """service.name always, host.name for every other user."""
    return F.when(
        F.col("user_id") % 2 == 0,
        F.create_map(F.lit("service.name"), F.col("svc"), F.lit("host.name"), F.concat(F.lit("h"), F.col("user_id") % 3)),
    ).otherwise(F.create_map(F.lit("service.name"), F.col("svc")))


def span_models_v2(t: Tables) -> DataFrame:
    """One model per span; none for every 97th, no references for every 89th,
    and a second, later one for every 101st."""
    eid = F.col("event_id")

    def model(suffix: str):
        refs = F.concat(
            F.lit(', "references": [{"spanId":"s'), eid - 1, F.lit(suffix), F.lit('","refType":"CHILD_OF"}]')
        )
        return F.concat(F.lit('{"spanID": "s'), eid, F.lit('"'), F.when(eid % 89 == 0, "").otherwise(refs), F.lit("}"))

    rows = F.filter(
        F.array(
            F.struct(F.col("ts").alias("timestamp"), model("").alias("model"), F.lit(True).alias("keep")),
            F.struct(
                F.timestamp_micros(F.col("us") + 1).alias("timestamp"), model("x").alias("model"), (eid % 101 == 0).alias("keep")
            ),
        ),
        lambda r: r["keep"],
    )
    return (
        events(t)
        .where(eid % 97 != 0)
        .select(F.concat(F.lit("t"), int_div(eid, 8)).alias("traceID"), F.explode(rows).alias("r"))
        .select("r.timestamp", "traceID", "r.model")
    )


def logs_v1(t: Tables) -> DataFrame:
    eid, k = F.col("event_id"), F.col("k")
    clash, host = eid % 5 == 0, F.col("user_id") % 2 == 0
    return events(t).select(
        (ts_to_ns(F.col("ts")) + eid % 1000).alias("timestamp"),
        F.concat(F.lit("log"), eid).alias("id"),
        F.concat(F.lit("t"), int_div(eid, 8)).alias("trace_id"),
        F.concat(F.lit("s"), eid).alias("span_id"),
        (eid % 2).alias("trace_flags"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("severity_text"),
        F.when(F.col("event_type") == "error", 17).otherwise(9).cast("smallint").alias("severity_number"),
        F.concat_ws(" ", "event_type", "props").alias("body"),
        F.array(F.lit("event.type")).alias("attributes_string_key"),
        F.array("event_type").alias("attributes_string_value"),
        F.array(F.lit("k")).alias("attributes_int64_key"),
        F.array(k).alias("attributes_int64_value"),
        # A float under the integer's key, which must win.
        F.when(clash, F.array(F.lit("value"), F.lit("k"))).otherwise(F.array(F.lit("value"))).alias("attributes_float64_key"),
        F.when(clash, F.array(F.col("value"), k + F.lit(0.5))).otherwise(F.array("value")).alias("attributes_float64_value"),
        F.array(F.lit("is_error")).alias("attributes_bool_key"),
        F.array(F.col("event_type") == "error").alias("attributes_bool_value"),
        F.when(host, F.array(F.lit("service.name"), F.lit("host.name"))).otherwise(F.array(F.lit("service.name"))).alias("resources_string_key"),
        F.when(host, F.array(F.col("svc"), F.concat(F.lit("h"), F.col("user_id") % 3))).otherwise(F.array("svc")).alias("resources_string_value"),
    )


def _text_id(text):
    """An unsigned 64-bit id beyond the signed range, from a text."""
    digits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("decimal(20,0)")
    return (F.lit("10000000000000000000").cast("decimal(20,0)") + digits).cast("decimal(20,0)")


def _labels_v1():
    return F.concat(
        F.lit('{"__name__":"app_event_value","event_type":"'), F.col("event_type"),
        F.lit('","service_name":"'), F.col("svc"), F.lit('"}'),
    )


def samples_v1(t: Tables) -> DataFrame:
    return events(t).select(
        _text_id(_labels_v1()).alias("fingerprint"),
        int_div(F.col("us"), 1000).alias("timestamp_ms"),
        "value",
    )


def series_v1(t: Tables) -> DataFrame:
    """Catalog rows per day; the series of signups at svc9 has none."""
    return (
        events(t)
        .where("not (event_type = 'signup' and svc = 'svc9')")
        .select(_text_id(_labels_v1()).alias("fingerprint"), F.to_date("ts").alias("date"), _labels_v1().alias("labels"))
        .distinct()
    )


def metric_points(t: Tables) -> DataFrame:
    """Points of three metrics: every event a gauge, errors also a summary,
    signups also a counter that exists only under its normalized name."""
    ev = events(t).withColumn("normalized", F.col("ts") < F.lit(CUTOVER).cast("timestamp"))
    node = F.concat(F.lit("node"), F.col("user_id") % 3)

    def point(name: str, kind: str, parts: list, keep):
        return F.struct(F.lit(name).alias("metric_name"), F.lit(kind).alias("type"), F.concat(*parts).alias("labels"), keep.alias("keep"))

    def text(*pieces):
        return [F.lit(p) if isinstance(p, str) else p for p in pieces]

    etype, svc, norm = F.col("event_type"), F.col("svc"), F.col("normalized")
    error, signup = etype == "error", etype == "signup"
    points = F.array(
        point("app_event_value", "Gauge", text('{"__name__":"app_event_value","event_type":"', etype, '","k8s_node_name":"', node, '","scope_ver":"v1","service_name":"', svc, '"}'), norm),
        point("app.event.value", "Gauge", text('{"__name__":"app.event.value","event.type":"', etype, '","scope.ver":"v1","service.name":"', svc, '","service_name":"', svc, '"}'), ~norm),
        point("app_latency", "Summary", text('{"__name__":"app_latency","quantile":"0.9","service_name":"', svc, '"}'), norm & error),
        point("app.latency.quantile", "Summary", text('{"__name__":"app.latency.quantile","service.name":"', svc, '"}'), ~norm & error),
        point("app_legacy_total", "Sum", text('{"__name__":"app_legacy_total","service_name":"', svc, '"}'), norm & signup),
    )
    kept = ev.withColumn("p", F.explode(F.filter(points, lambda p: p["keep"])))
    flavour = F.element_at(F.array(F.lit("Cumulative"), F.lit("Delta"), F.lit("Unspecified")), (F.col("user_id") % 3 + 1).cast("int"))
    return kept.select(
        "p.metric_name",
        "p.type",
        flavour.alias("temporality"),
        "p.labels",
        "normalized",
        int_div(F.col("us"), 1000).alias("unix_milli"),
        "value",
    ).withColumn("fingerprint", _text_id(F.concat("labels", "temporality")))


def series_v4(t: Tables) -> DataFrame:
    """One catalog row per series and hour."""
    empty = F.create_map().cast("map<string,string>")
    hour = int_div(F.col("unix_milli"), 3_600_000) * F.lit(3_600_000)
    return (
        metric_points(t)
        .select("temporality", "metric_name", "type", "fingerprint", hour.alias("unix_milli"), "labels", "normalized")
        .distinct()
        .select(
            F.lit("default").alias("env"),
            "temporality",
            "metric_name",
            F.lit("").alias("description"),
            F.lit("").alias("unit"),
            "type",
            (F.col("type") == "Sum").alias("is_monotonic"),
            "fingerprint",
            "unix_milli",
            "labels",
            empty.alias("attrs"),
            empty.alias("scope_attrs"),
            empty.alias("resource_attrs"),
            "normalized",
        )
    )


def samples_v4(t: Tables) -> DataFrame:
    return metric_points(t).select(
        F.lit("default").alias("env"), "temporality", "metric_name", "fingerprint", "unix_milli", "value",
        F.lit(0).cast("bigint").alias("flags"),
    )


def attribute_metadata(t: Tables) -> DataFrame:
    """(attr_name, attr_type) as every event reports them; service.name is
    reported both as resource and as point."""
    pairs = [
        ("service.name", "resource"), ("service.name", "point"), ("k8s.node.name", "resource"),
        ("scope.ver", "scope"), ("event.type", "point"), ("quantile", "point"),
    ]
    rows = [F.struct(F.lit(n).alias("attr_name"), F.lit(k).alias("attr_type")) for n, k in pairs]
    rows.append(F.struct(F.concat(F.lit("user."), F.col("user_id") % 10).alias("attr_name"), F.lit("point").alias("attr_type")))
    return events(t).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# (name, data type, type) every event reports; twins in underscore spelling, one
# of them with another data type, and two top-level names.
FIELD_ROWS = [
    ("event.type", "string", "attribute"),
    ("event_type", "string", "attribute"),
    ("k", "int64", "attribute"),
    ("value", "float64", "attribute"),
    ("is_error", "bool", "attribute"),
    ("body", "string", "attribute"),
    ("timestamp", "int64", "attribute"),
    ("service.name", "string", "resource"),
    ("service_name", "string", "resource"),
    ("host.name", "string", "resource"),
    ("host_name", "int64", "resource"),
]


def field_reports(t: Tables) -> DataFrame:
    """Field names with data type and type, once per event that has them."""
    rows = [F.struct(F.lit(n).alias("name"), F.lit(d).alias("datatype"), F.lit(k).alias("type")) for n, d, k in FIELD_ROWS]
    rows.append(F.struct(F.concat(F.lit("user."), F.col("user_id") % 10).alias("name"), F.lit("string").alias("datatype"), F.lit("attribute").alias("type")))
    return events(t).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def field_catalog(t: Tables) -> DataFrame:
    return field_reports(t).distinct()


def table_definitions(t: Tables, shift: int = 0) -> DataFrame:
    """One table definition per part, with five kinds of TTL clauses."""
    size, kind = F.col("p_size"), (F.col("p_partkey") + F.col("p_size") * shift) % 5
    delete = F.concat(F.lit("TTL toDateTime(timestamp / 1000000000) + toIntervalSecond("), (size % 30 + 1) * 86400, F.lit(")"))
    move = F.concat(F.lit("toDateTime(timestamp / 1000000000) + toIntervalSecond("), (size % 7 + 1) * 86400, F.lit(") TO VOLUME '"))
    tail = F.lit("' SETTINGS index_granularity = 8192")
    text = (
        F.when(kind == 0, F.concat(delete, F.lit(" SETTINGS index_granularity = 8192")))
        .when(kind == 1, F.concat(delete, F.lit(" DELETE, "), move, F.lit("cold"), tail))
        .when(kind == 2, F.concat(delete, F.lit(" DELETE, "), move, F.lit("s3"), tail))
        .when(kind == 3, F.lit("ORDER BY id SETTINGS index_granularity = 8192"))
        .otherwise(F.concat(F.lit("TTL "), move, F.lit("cold"), tail))
    )
    return t.part.select(F.concat(F.lit("tbl_"), "p_partkey").alias("name"), text.alias("engine_full"))


# Upper bounds of the quantity histogram; the last one is open.
QUANTITY_BOUNDS = [10.0, 20.0, 30.0, 40.0, 50.0, float("inf")]


def quantity_histogram(t: Tables) -> DataFrame:
    """Cumulative bucket counts of line quantities by return flag and month."""
    counts = [F.count_if(F.col("l_quantity") <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(QUANTITY_BOUNDS)]
    grouped = t.lineitem.groupBy("l_returnflag", F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(*counts)
    buckets = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"c{i}").cast("double").alias("value")) for i, b in enumerate(QUANTITY_BOUNDS)])
    return grouped.select("l_returnflag", "month", F.explode(buckets).alias("b")).select("l_returnflag", "month", "b.le", "b.value")
