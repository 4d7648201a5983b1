"""Scans, counts, paging, window plans, sinks and parity checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from telemorph.operators import errors, logs, metrics, scans, sinks, spans, verify
from telemorph.queries.oracle_inputs import with_
from telemorph.queries.registry import query
from telemorph.session import checkpoint_dir
from telemorph.sources import derived as d

# 2024-01-10 00:00 to 2024-01-20 00:00; both are bucket and hour edges.
T0, T1 = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
T0_S, T1_S = 1_704_844_800, 1_705_708_800


def ts(text: str):
    return F.lit(text).cast("timestamp")


@query("flagship_error_groups", with_("errors_v1", """
    SELECT "serviceName" AS service, md5("serviceName" || "exceptionType" || "exceptionMessage") AS group_id,
           count(*) AS errors, min(us) AS first_seen_us, max(us) AS last_seen_us
    FROM errors_v1 GROUP BY 1, 2"""))
def flagship_error_groups(t):
    upgraded = errors.upgrade_errors(d.errors_v1(t))
    return upgraded.groupBy(F.col("serviceName").alias("service"), F.col("groupID").alias("group_id")).agg(
        F.count(F.lit(1)).alias("errors"),
        F.min(F.unix_micros("timestamp")).alias("first_seen_us"),
        F.max(F.unix_micros("timestamp")).alias("last_seen_us"),
    )


for _name, _closed, _low, _high in (("open_closed", "(]", ">", "<="), ("closed_open", "[)", ">=", "<"), ("closed", "[]", ">=", "<=")):

    @query(f"s01_scan_range_{_name}", with_("logs", f"""
        SELECT id, ns FROM logs WHERE ns {_low} {T0_S}000000000 AND ns {_high} {T1_S}000000000"""))
    def s01(t, closed=_closed):
        rows = scans.scan_range(d.logs_v1(t), "timestamp", T0_S * 10**9, T1_S * 10**9, closed)
        return rows.select("id", F.col("timestamp").alias("ns"))


@query("s02_scan_service", with_("errors_v1", f"""
    SELECT "errorID", us FROM errors_v1
    WHERE "serviceName" = 'svc3' AND ts >= TIMESTAMP '{T0}' AND ts <= TIMESTAMP '{T1}'"""))
def s02(t):
    return scans.scan_service(d.errors_v1(t), "svc3", ts(T0), ts(T1)).select("errorID", F.unix_micros("timestamp").alias("us"))


@query("s03_select_columns", "SELECT event_id, event_type FROM events")
def s03(t):
    return scans.select_columns(t.events, ["event_id", "event_type"])


@query("s05_read_documents", with_("ev", """
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'quarantine' ELSE 'document' END AS target FROM ev"""))
def s05(t):
    from telemorph.sources.tables import parse_documents

    torn = F.when(F.col("event_id") % 11 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    good, bad = parse_documents(t.events.select("event_id", torn.alias("data")), key="event_id")
    return good.select("event_id", F.lit("document").alias("target")).unionByName(
        bad.select("event_id", F.lit("quarantine").alias("target"))
    )


@query("s06_write_upgraded", with_("logs", """
    SELECT CAST(CAST(to_timestamp(bucket) AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS day, count(*) AS n, min(ns) AS first_ns, max(ns) AS last_ns
    FROM logs GROUP BY 1"""))
def s06(t):
    """Write the upgraded logs by day, rerun it, and read the table back."""
    rows = logs.upgrade_logs_v2(d.logs_v1(t)).withColumn("day", F.to_date(F.timestamp_seconds("ts_bucket_start")))
    rows = rows.select("day", "timestamp", "id", "body", "attributes_string")
    path = f"{checkpoint_dir(t.spark)}/s06-{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.write_upgraded(rows, path, ["day"], mode="overwrite")
    return (
        t.spark.read.parquet(path)
        .groupBy(F.col("day").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_ns"), F.max("timestamp").alias("last_ns"))
    )


@query("s07_fan_out", with_("spans", """
    SELECT 'spans' AS output, count(*) AS n FROM spans UNION ALL
    SELECT 'resources', count(*) FROM (SELECT DISTINCT bucket, labels FROM spans)"""))
def s07(t):
    out = spans.upgrade_spans_to_v3(d.spans_v2(t), d.span_models_v2(t))
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("output"), "n") for name, df in out.items()]
    return counts[0].unionByName(counts[1])


@query("s08_move_time_series", with_("series1", """
    SELECT 'app_event_value' AS metric_name, epoch_ms(CAST(d AS TIMESTAMP)) AS timestamp_ms, labels, event_type AS object_event_type
    FROM series1"""))
def s08(t):
    moved = metrics.move_time_series(d.series_v1(t))
    return moved.select(
        "metric_name", "timestamp_ms", "labels", F.variant_get("labels_object", "$.event_type", "string").alias("object_event_type")
    )


@query("s09_apply_updates", """
    SELECT event_id AS id, CASE WHEN event_type = 'error' THEN '{"seen":true}' ELSE props END AS data FROM events""")
def s09(t):
    docs = t.events.select(F.col("event_id").alias("id"), F.col("props").alias("data"))
    changed = t.events.where("event_type = 'error'").select(F.col("event_id").alias("id"), F.lit('{"seen":true}').alias("data"))
    return sinks.apply_updates(docs, changed)


@query("s12_rows_after", with_("errors_v1", f"""
    SELECT "errorID" FROM errors_v1 WHERE "serviceName" > 'svc4' OR ("serviceName" = 'svc4' AND ts <= TIMESTAMP '{T0}')"""))
def s12(t):
    return scans.rows_after(d.errors_v1(t), "svc4", ts(T0)).select("errorID")


@query("s13_epoch_conversions", with_("logs", """
    SELECT id, ns // 1000 AS from_ns_us, (ns // 1000000) * 1000 AS from_ms_us FROM logs"""))
def s13(t):
    from telemorph.functions.scalars import int_div, ms_to_ts, ns_to_ts

    ns = F.col("timestamp")
    return d.logs_v1(t).select(
        "id", F.unix_micros(ns_to_ts(ns)).alias("from_ns_us"), F.unix_micros(ms_to_ts(int_div(ns, 1_000_000))).alias("from_ms_us")
    )


# ---- counts, bounds, plans -------------------------------------------------------


@query("a01_count_rows", with_("logs", f"""
    SELECT 'all' AS scope, count(*) AS num_total FROM logs UNION ALL
    SELECT 'range', count(*) FROM logs WHERE ns > {T0_S}000000000 AND ns <= {T1_S}000000000"""))
def a01(t):
    rows = d.logs_v1(t)
    ranged = scans.count_rows(rows, "timestamp", T0_S * 10**9, T1_S * 10**9, "(]")
    return scans.count_rows(rows).select(F.lit("all").alias("scope"), "num_total").unionByName(
        ranged.select(F.lit("range").alias("scope"), "num_total")
    )


INVENTORY = 'SELECT "serviceName" AS s, min(us) AS mint, max(us) AS maxt, count(*) AS n FROM errors_v1 GROUP BY 1'


@query("a02_service_inventory", with_("errors_v1", """
    SELECT "serviceName", min(us) AS min_us, max(us) AS max_us, count(*) AS num_total FROM errors_v1 GROUP BY 1"""))
def a02(t):
    inv = scans.service_inventory(d.errors_v1(t))
    return inv.select("serviceName", F.unix_micros("mint").alias("min_us"), F.unix_micros("maxt").alias("max_us"), "num_total")


@query("a03_time_bounds", with_("ev", "SELECT min(us // 1000) AS min_ts, max(us // 1000) AS max_ts FROM ev"))
def a03(t):
    return scans.time_bounds(d.samples_v1(t))


@query("a12_service_rates", with_("errors_v1", f"""
    WITH inv AS ({INVENTORY}) SELECT s AS "serviceName", n AS num_total, n // (maxt // 1000000 - mint // 1000000 + 1) AS rate FROM inv"""))
def a12(t):
    return scans.service_rates(scans.service_inventory(d.errors_v1(t))).select("serviceName", "num_total", "rate")


@query("a13_bucket_counts", with_("errors_v1", """
    SELECT "serviceName", (us // 1000000) // 1800 * 1800 AS ts_bucket_start, count(*) AS num_total FROM errors_v1 GROUP BY 1, 2"""))
def a13(t):
    return scans.bucket_counts(d.errors_v1(t))


@query("l01_page_by_time", with_("errors_v1", """
    SELECT "errorID", us FROM errors_v1 ORDER BY ts, "errorID" LIMIT 20 OFFSET 40"""))
def l01(t):
    return scans.page_by_time(d.errors_v1(t), 20, 40).select("errorID", F.unix_micros("timestamp").alias("us"))


@query("l02_ordered", with_("errors_v1", 'SELECT "serviceName", us, "errorID" FROM errors_v1 ORDER BY 1, 2 DESC, 3'))
def l02(t):
    rows = d.errors_v1(t).select("serviceName", F.unix_micros("timestamp").alias("us"), "errorID")
    return scans.ordered(rows, [F.col("serviceName"), F.col("us").desc(), F.col("errorID")])


@query("l03_time_gaps", with_("errors_v1", """
    WITH b AS (SELECT DISTINCT "serviceName", (us // 1000000) // 1800 * 1800 AS s FROM errors_v1),
    n AS (SELECT "serviceName", s + 1800 AS gap_start, lead(s) OVER (PARTITION BY "serviceName" ORDER BY s) AS gap_end FROM b)
    SELECT "serviceName", gap_start, gap_end FROM n WHERE gap_end > gap_start"""))
def l03(t):
    return scans.time_gaps(scans.bucket_counts(d.errors_v1(t)))


@query("v01_count_parity", with_("spans", """
    WITH n AS (SELECT count(*) AS count_a,
                      count(*) FILTER (WHERE event_id % 97 <> 0) + count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 101 = 0) AS count_b
               FROM spans)
    SELECT count_a, count_b, abs(count_a - count_b) AS difference, abs(count_a - count_b) <= 1000 AS within_delta FROM n"""))
def v01(t):
    return verify.count_parity(d.spans_v2(t), d.span_models_v2(t))


@query("v02_require_rows", with_("errors_v1", "SELECT count(*) AS num_total FROM errors_v1"))
def v02(t):
    return scans.count_rows(verify.require_rows(d.errors_v1(t)))
