"""Row upgrades of errors, spans and logs, with their scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from telemorph.functions import hashing, maps, scalars
from telemorph.operators import errors, logs, spans
from telemorph.queries.oracle_inputs import hash_of, pair_bytes, with_
from telemorph.queries.registry import query
from telemorph.session import checkpoint_dir
from telemorph.sources import derived as d


# ---- errors and old spans --------------------------------------------------------


@query("p01_upgrade_spans_v2", with_("ev", """
    SELECT 's' || event_id AS "spanID", us, event_id % 6 AS kind,
           CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS "statusCode", event_type = 'error' AS "hasError",
           CAST(round(value * 1e6) AS BIGINT) AS "durationNano", CAST(k AS VARCHAR) AS tag_k, '' AS "gRPCCode",
           CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS n_events FROM ev"""))
def p01(t):
    out = spans.upgrade_spans(d.spans_v1(t))["spans"]
    return out.select(
        "spanID", F.unix_micros("timestamp").alias("us"), F.col("kind").cast("bigint").alias("kind"),
        F.col("statusCode").cast("int").alias("statusCode"), "hasError", "durationNano",
        F.col("tagMap")["k"].alias("tag_k"), "gRPCCode", F.size("events").alias("n_events"),
    )


@query("p02_span_model_json", with_("ev", r"""
    SELECT 't' || (event_id // 8) AS "traceID", us,
      '{"traceId":"t' || (event_id // 8) || '","spanId":"s' || event_id || '","name":"' || event_type || '"' ||
      CASE WHEN round(value * 1e6) = 0 THEN '' ELSE ',"durationNano":' || CAST(round(value * 1e6) AS BIGINT) END ||
      ',"startTimeUnixNano":' || (us // 1000000) || ',"serviceName":"' || svc || '"' ||
      CASE WHEN event_id % 6 = 0 THEN '' ELSE ',"kind":' || (event_id % 6) END ||
      CASE WHEN event_id % 7 = 0 THEN '' ELSE ',"references":"' || replace(props, '"', '\"') || '"' END ||
      CASE WHEN event_type = 'error' THEN ',"statusCode":2' ELSE '' END ||
      ',"tagMap":{"event.type":"' || event_type || '","k":"' || k || '"}' ||
      CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"event":["' || event_type || '"]' END ||
      CASE WHEN event_type = 'error' THEN ',"hasError":true' ELSE '' END || '}' AS model
    FROM ev"""))
def p02(t):
    out = spans.upgrade_spans(d.spans_v1(t))["models"]
    return out.select("traceID", F.unix_micros("timestamp").alias("us"), "model")


@query("p03_upgrade_errors", with_("errors_v1", """
    SELECT "errorID", md5("serviceName" || "exceptionType" || "exceptionMessage") AS "groupID", us, "traceID", "spanID",
           "serviceName", "exceptionType", "exceptionMessage", "exceptionStacktrace", "exceptionEscaped" = 'True' AS "exceptionEscaped"
    FROM errors_v1"""))
def p03(t):
    out = errors.upgrade_errors(d.errors_v1(t))
    return out.withColumn("us", F.unix_micros("timestamp")).drop("timestamp")


@query("p04_bool_coercion", with_("ev", """
    SELECT event_id, coalesce(event_id % 3 = 0, FALSE) AS from_text, coalesce(event_id % 4 <> 0, FALSE) AS from_int FROM ev"""))
def p04(t):
    eid = F.col("event_id")
    text = F.when(eid % 3 == 0, "TRUE").when(eid % 3 == 1, "yes")
    return t.events.select(
        "event_id", scalars.text_to_bool(text).alias("from_text"), scalars.int_to_bool(eid % 4).alias("from_int")
    )


@query("p05_narrow_int", with_("ev", """
    SELECT event_id, CASE WHEN x % 256 >= 128 THEN x % 256 - 256 ELSE x % 256 END AS wrapped8,
           CASE WHEN (x * 7) % 65536 >= 32768 THEN (x * 7) % 65536 - 65536 ELSE (x * 7) % 65536 END AS wrapped16,
           CASE WHEN x <= 127 THEN x ELSE -1 END AS safe8
    FROM (SELECT event_id, event_id * 3 AS x FROM ev)"""))
def p05(t):
    x = F.col("event_id") * 3
    return t.events.select(
        "event_id",
        scalars.narrow_int(x, 8).cast("bigint").alias("wrapped8"),
        scalars.narrow_int(x * 7, 16).cast("bigint").alias("wrapped16"),
        F.coalesce(scalars.narrow_int(x, 8, wrap=False).cast("bigint"), F.lit(-1)).alias("safe8"),
    )


# ---- logs ------------------------------------------------------------------------


@query("p06_arrays_to_map", with_("ev", """
    SELECT event_id, event_type AS a, CASE WHEN event_id % 4 = 0 THEN 'last' ELSE 'first' END AS b,
           CASE WHEN event_id % 4 = 0 THEN '{"a":"' || event_type || '","b":"last"}' ELSE '{"a":"' || event_type || '","b":"first"}' END AS json
    FROM ev"""))
def p06(t):
    repeat = F.col("event_id") % 4 == 0
    keys = F.when(repeat, F.array(F.lit("b"), F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit("a")))
    values = F.when(repeat, F.array(F.lit("first"), F.col("event_type"), F.lit("last"))).otherwise(F.array(F.lit("first"), F.col("event_type")))
    m = maps.arrays_to_map(keys, values)
    return t.events.select("event_id", m["a"].alias("a"), m["b"].alias("b"), maps.map_json(m).alias("json"))


@query("p07_merge_number_attrs", with_("logs", """
    SELECT id, 'k' AS key, round(k, 6) AS value FROM logs UNION ALL SELECT id, 'value', round(value, 6) FROM logs"""))
def p07(t):
    out = logs.upgrade_logs_v2(d.logs_v1(t)).select("id", F.explode("attributes_number"))
    return out.select("id", "key", F.round("value", 6).alias("value"))


@query("p08_upgrade_logs_v2", with_("logs", """
    SELECT id, bucket AS ts_bucket_start, ns AS timestamp, 0 AS observed_timestamp, severity_text, body, event_type AS attr_event_type,
           is_error AS attr_is_error, svc AS service, host, '' AS scope_name, '' AS scope_version, '{}' AS scope_json FROM logs"""))
def p08(t):
    out = logs.upgrade_logs_v2(d.logs_v1(t))
    return out.select(
        "id", "ts_bucket_start", "timestamp", "observed_timestamp", "severity_text", "body",
        F.col("attributes_string")["event.type"].alias("attr_event_type"),
        F.col("attributes_bool")["is_error"].alias("attr_is_error"),
        F.col("resources_string")["service.name"].alias("service"),
        F.try_element_at("resources_string", F.lit("host.name")).alias("host"),
        "scope_name", "scope_version", maps.map_json(F.col("scope_string")).alias("scope_json"),
    )


@query("p12_ts_bucket", with_("ev", """
    SELECT event_id, (us // 1000000 // 1800) * 1800 AS half_hour, (us // 1000000 // 3600) * 3600 AS hour FROM ev"""))
def p12(t):
    seconds = F.unix_seconds("ts")
    return t.events.select("event_id", scalars.ts_bucket(seconds).alias("half_hour"), scalars.ts_bucket(seconds, 3600).alias("hour"))


@query("p13_align_to_hour", with_("ev", """
    SELECT event_id, (ms // 3600000) * 3600000 AS lower_ms, ((ms + 90000 + 3599999) // 3600000) * 3600000 AS upper_ms
    FROM (SELECT event_id, us // 1000 AS ms FROM ev)"""))
def p13(t):
    ms = F.unix_millis("ts")
    lower, upper = scalars.align_to_hour(ms, ms + 90_000)
    return t.events.select("event_id", lower.alias("lower_ms"), upper.alias("upper_ms"))


RESOURCE_HASH = hash_of(
    f"(CASE WHEN host IS NULL THEN []::HUGEINT[] ELSE {pair_bytes(chr(39) + 'host.name' + chr(39), 'host')} END || "
    f"{pair_bytes(chr(39) + 'service.name' + chr(39), 'svc')})"
)


@query("p27_resource_fingerprint", with_("logs", f"""
    WITH fp AS (SELECT labels, {RESOURCE_HASH} AS fp FROM (SELECT DISTINCT labels, host, svc FROM logs))
    SELECT l.id, fp.fp AS resource_fingerprint FROM logs l JOIN fp USING (labels)"""))
def p27(t):
    return logs.upgrade_logs(d.logs_v1(t))["logs"].select("id", "resource_fingerprint")


@query("p28_resource_json", with_("logs", "SELECT id, labels FROM logs"))
def p28(t):
    return logs.upgrade_logs_v2(d.logs_v1(t)).select("id", hashing.resource_json(F.col("resources_string")).alias("labels"))


@query("a10_resource_catalog", with_("logs", f"""
    SELECT labels, {RESOURCE_HASH} AS fingerprint, bucket AS seen_at_ts_bucket_start
    FROM (SELECT DISTINCT labels, host, svc, bucket FROM logs)"""))
def a10(t):
    return logs.upgrade_logs(d.logs_v1(t))["resources"]


# ---- newer spans -----------------------------------------------------------------


@query("p09_upgrade_spans_v3", with_("spans", f"""
    WITH fp AS (SELECT labels, {RESOURCE_HASH} AS fp FROM (SELECT DISTINCT labels, host, svc FROM spans))
    SELECT bucket AS ts_bucket_start, fp.fp AS resource_fingerprint, us, trace_id, span_id, parent_span_id, name, kind, kind_string,
           duration_nano, status_code, status_code_string, event_type AS attr_event_type, CAST(k AS DOUBLE) AS attr_k, even AS attr_even,
           labels AS resource_json, http_method, http_url, has_error, response_status_code, links
    FROM spans JOIN fp USING (labels)"""))
def p09(t):
    out = spans.upgrade_spans_to_v3(d.spans_v2(t), d.span_models_v2(t))["spans"]
    return out.select(
        "ts_bucket_start", "resource_fingerprint", F.unix_micros("timestamp").alias("us"), "trace_id", "span_id",
        "parent_span_id", "name", F.col("kind").cast("bigint").alias("kind"), "kind_string", "duration_nano",
        F.col("status_code").cast("int").alias("status_code"), "status_code_string",
        F.col("attributes_string")["event.type"].alias("attr_event_type"),
        F.col("attributes_number")["k"].alias("attr_k"), F.col("attributes_bool")["even"].alias("attr_even"),
        hashing.resource_json(F.col("resources_string")).alias("resource_json"),
        "http_method", "http_url", "has_error", "response_status_code", "links",
    )


@query("p29_span_links", with_("spans", """
    SELECT span_id, replace(links, 'x"', '"') AS links FROM spans WHERE event_id % 97 <> 0
    UNION ALL SELECT span_id, links FROM spans WHERE event_id % 97 <> 0 AND event_id % 101 = 0"""))
def p29(t):
    return spans.span_links(d.span_models_v2(t)).select("span_id", "links")


@query("j02_attach_links", with_("spans", "SELECT span_id, trace_id, links FROM spans"))
def j02(t):
    out = spans.attach_links(d.spans_v2(t), d.span_models_v2(t))
    return out.select(F.col("spanID").alias("span_id"), F.col("traceID").alias("trace_id"), "links")


@query("j02_links_of_stored_spans", with_("spans", "SELECT span_id, trace_id, links FROM spans"))
def j02_stored(t):
    """The same over spans stored in buckets, which the join leaves where they lie."""
    name = f"spans_{uuid.uuid4().hex}"
    stored = spans.store_spans(d.spans_v2(t), name, f"{checkpoint_dir(t.spark)}/{name}", buckets=16)
    out = spans.attach_links(stored, d.span_models_v2(t))
    return out.select(F.col("spanID").alias("span_id"), F.col("traceID").alias("trace_id"), "links")


@query("j02_unmatched_links", with_("spans", "SELECT span_id, trace_id FROM spans WHERE event_id % 97 = 0"))
def j02_unmatched(t):
    out = spans.unmatched_links(d.spans_v2(t), d.span_models_v2(t))
    return out.select(F.col("spanID").alias("span_id"), F.col("traceID").alias("trace_id"))


@query("a10_resource_catalog_spans", with_("spans", f"""
    SELECT labels, {RESOURCE_HASH} AS fingerprint, bucket AS seen_at_ts_bucket_start
    FROM (SELECT DISTINCT labels, host, svc, bucket FROM spans)"""))
def a10_spans(t):
    return spans.upgrade_spans_to_v3(d.spans_v2(t), d.span_models_v2(t))["resources"]
