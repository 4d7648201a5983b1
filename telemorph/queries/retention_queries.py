"""TTL texts, expiry and tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemorph.operators import logs, retention
from telemorph.queries.oracle_inputs import with_
from telemorph.queries.registry import query
from telemorph.sources import derived as d

AS_OF = 1_706_572_800  # 2024-01-30 00:00:00
TTL = 15 * 86_400
MOVE = 5 * 86_400


@query("r01_parse_ttl", with_("ttls", "SELECT name, delete_ttl, move_ttl, cold_tier FROM ttls"))
def r01(t):
    return retention.parse_ttl(d.table_definitions(t)).drop("engine_full")


@query("r01_ttl_hours", with_("ttls", "SELECT name, CASE delete_ttl WHEN -1 THEN -1 ELSE delete_ttl // 3600 END AS hours FROM ttls"))
def r01_hours(t):
    parsed = retention.parse_ttl(d.table_definitions(t))
    return parsed.select("name", retention.ttl_hours(F.col("delete_ttl")).alias("hours"))


@query("r02_apply_retention_logs", with_("logs", f"SELECT id FROM logs WHERE ns // 1000000000 + {TTL} > {AS_OF}"))
def r02_logs(t):
    return retention.apply_retention(logs.upgrade_logs_v2(d.logs_v1(t)), "logs", TTL, AS_OF).select("id")


@query("r02_apply_retention_spans", with_("spans", f"SELECT span_id FROM spans WHERE us // 1000000 + {TTL} > {AS_OF}"))
def r02_spans(t):
    return retention.apply_retention(d.spans_v2(t), "spans", TTL, AS_OF).select(F.col("spanID").alias("span_id"))


@query("r02_apply_retention_resources", with_("logs", f"""
    SELECT DISTINCT labels, bucket AS seen_at_ts_bucket_start FROM logs WHERE bucket + 1800 + {TTL} > {AS_OF}"""))
def r02_resources(t):
    catalog = logs.upgrade_logs(d.logs_v1(t))["resources"]
    return retention.apply_retention(catalog, "resources", TTL, AS_OF).select("labels", "seen_at_ts_bucket_start")


SUMMARY = "summary AS (SELECT trace_id, max(us) AS end_us, count(*) AS n FROM spans GROUP BY 1)"


def _trace_summary(t):
    return d.spans_v2(t).groupBy(F.col("traceID").alias("trace_id")).agg(F.max("timestamp").alias("end"), F.count(F.lit(1)).alias("n"))


@query("r02_apply_retention_trace_summary", with_("spans", f"WITH {SUMMARY} SELECT trace_id, n FROM summary WHERE end_us // 1000000 + {TTL} > {AS_OF}"))
def r02_summary(t):
    return retention.apply_retention(_trace_summary(t), "trace_summary", TTL, AS_OF).select("trace_id", "n")


@query("r03_assign_tier", with_("logs", f"""
    SELECT id, CASE WHEN ns // 1000000000 + {MOVE} <= {AS_OF} THEN 's3' ELSE 'hot' END AS tier FROM logs"""))
def r03(t):
    return retention.assign_tier(logs.upgrade_logs_v2(d.logs_v1(t)), "logs", MOVE, AS_OF, "s3").select("id", "tier")


@query("r03_assign_tier_trace_summary", with_("spans", f"WITH {SUMMARY} SELECT trace_id, 'hot' AS tier FROM summary"))
def r03_summary(t):
    return retention.assign_tier(_trace_summary(t), "trace_summary", MOVE, AS_OF).select("trace_id", "tier")


@query("r04_reconcile_ttl", with_("ttls", """
    WITH acted AS (SELECT *, CASE WHEN cur_move <> -1 THEN 'keep'
               WHEN delete_ttl = -1 OR (delete_ttl = cur_delete AND move_ttl = cur_move) THEN 'none' ELSE 'copy' END AS action FROM ttls)
    SELECT name, action, CASE action WHEN 'copy' THEN delete_ttl ELSE cur_delete END AS delete_ttl,
           CASE action WHEN 'copy' THEN move_ttl ELSE cur_move END AS move_ttl, CASE action WHEN 'copy' THEN cold_tier ELSE '' END AS cold_tier
    FROM acted"""))
def r04(t):
    old = retention.parse_ttl(d.table_definitions(t))
    return retention.reconcile_ttl(old, retention.parse_ttl(d.table_definitions(t, shift=1)))


@query("r02_ttl_request", with_("spans", f"""
    SELECT span_id, CASE WHEN us // 1000000 + {MOVE} <= {AS_OF} THEN 'cold' ELSE 'hot' END AS tier
    FROM spans WHERE us // 1000000 + {TTL} > {AS_OF}"""))
def ttl_request(t):
    """Delete and move in one request."""
    rows = retention.apply_retention(d.spans_v2(t), "spans", TTL, AS_OF)
    return retention.assign_tier(rows, "spans", MOVE, AS_OF).select(F.col("spanID").alias("span_id"), "tier")
