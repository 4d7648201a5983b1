"""SQL and PromQL constructs the rewritten query texts are made of, run on the
stored tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from telemorph.functions.maps import map_json
from telemorph.functions.scalars import int_div, ns_to_ts, ts_bucket
from telemorph.operators.quantiles import exact_percentiles
from telemorph.plans import promql as P
from telemorph.queries.builder_queries import hist_quantile_sql
from telemorph.queries.oracle_inputs import with_
from telemorph.queries.registry import query
from telemorph.sources import derived as d

# ---- SQL -------------------------------------------------------------------------------


@query("x_sql_1_projection_filter", "SELECT event_id, value FROM events WHERE event_type = 'error' AND value > 50")
def x_sql_1(t):
    return t.events.where("event_type = 'error' and value > 50").select("event_id", "value")


@query("x_sql_2_group_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def x_sql_2(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("x_sql_3_order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def x_sql_3(t):
    return t.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("x_sql_4_having", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 70")
def x_sql_4(t):
    return t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where("n > 70")


@query("x_sql_5_inner_join", """
    SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def x_sql_5(t):
    # Orders are counted per customer first: a customer with very many orders
    # reaches the join as one row per task.
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("p"))
    joined = per_customer.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey").join(t.nation, "n_nationkey")
    return joined.groupBy("n_name").agg(F.sum("n").alias("orders"), F.round(F.sum("p"), 2).alias("total"))


@query("x_sql_6_in_subquery", """
    SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def x_sql_6(t):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(wanted, "o_custkey", "left_semi").select("o_orderkey")


@query("x_sql_7_case_when", """
    SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size, count(*) AS n FROM lineitem GROUP BY 1""")
def x_sql_7(t):
    size = F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 30, "medium").otherwise("large")
    return t.lineitem.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"))


@query("x_sql_8_subquery_distinct", """
    SELECT l_suppkey, count(*) AS parts FROM (SELECT DISTINCT l_suppkey, l_partkey FROM (SELECT * FROM lineitem WHERE l_discount > 0.05)) GROUP BY 1""")
def x_sql_8(t):
    inner = t.lineitem.where("l_discount > 0.05").select("l_suppkey", "l_partkey").distinct()
    return inner.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("parts"))


@query("x_sql_9_window_average", """
    SELECT event_id, round(avg(value) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts), 6) AS running FROM events""")
def x_sql_9(t):
    """Running average per user and day; the default frame includes ties."""
    per_day = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts")
    return t.events.select("event_id", F.round(F.avg("value").over(per_day), 6).alias("running"))


@query("x_sql_10_explode", """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1""")
def x_sql_10(t):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("x_sql_11_parameters", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice >= 200000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def x_sql_11(t):
    text = """SELECT o_orderstatus, count(*) AS n FROM {orders}
              WHERE o_totalprice >= :floor AND array_contains(:priorities, o_orderpriority) GROUP BY 1"""
    priorities = F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))
    return t.spark.sql(text, args={"floor": 200_000, "priorities": priorities}, orders=t.orders)


@query("x_sql_12_count_if_any_last", """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1""")
def x_sql_12(t):
    return t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")
    )


@query("x_sql_13_json", """
    SELECT event_id, json_extract_string(props, '$.k') AS text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS typed,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS by_variant FROM events""")
def x_sql_13(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("text"),
        F.from_json("props", "k bigint")["k"].alias("typed"),
        F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("by_variant"),
    )


@query("x_sql_14_array_tests", """
    SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red') AS has_red, coalesce(list_position(string_split(p_name, ' '), 'ring'), 0) AS ring_at FROM part""")
def x_sql_14(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", F.array_contains(words, "red").alias("has_red"), F.array_position(words, "ring").cast("int").alias("ring_at")
    )


@query("x_sql_15_ilike", "SELECT doc_id FROM documents WHERE text ILIKE '%THE %'")
def x_sql_15(t):
    return t.documents.where(F.col("text").ilike("%THE %")).select("doc_id")


@query("x_sql_16_intervals", with_("logs", """
    SELECT (ns // 1000000000 // 240) * 240 AS bucket, count(*) AS n FROM logs
    WHERE ns BETWEEN 1704844800000000000 AND 1704844800000000000 + CAST(7 AS BIGINT) * 86400 * 1000000000 GROUP BY 1"""))
def x_sql_16(t):
    start = F.lit("2024-01-10 00:00:00").cast("timestamp")
    rows = d.logs_v1(t).select("timestamp").withColumn("at", ns_to_ts(F.col("timestamp")))
    rows = rows.where(F.col("at").between(start, start + F.expr("INTERVAL 7 DAYS")))
    return rows.groupBy(ts_bucket(F.unix_seconds("at"), 240).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("x_sql_17_quantile", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 4) AS q90 FROM lineitem GROUP BY 1")
def x_sql_17(t):
    out = exact_percentiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"q90": 0.9})
    return out.withColumn("q90", F.round("q90", 4))


@query("x_sql_18_ratio_of_buckets", with_("logs", """
    WITH e AS (SELECT (ns // 1000000000 // 3600) * 3600 AS ts, count(*) AS v FROM logs WHERE is_error GROUP BY 1),
         a AS (SELECT (ns // 1000000000 // 3600) * 3600 AS ts, count(*) AS v FROM logs GROUP BY 1)
    SELECT a.ts, round(e.v / a.v * 100, 6) AS value FROM e JOIN a USING (ts)"""))
def x_sql_18(t):
    bucket = ts_bucket(int_div(F.col("timestamp"), 1_000_000_000), 3600).alias("ts")
    rows = d.logs_v1(t)
    errors = rows.where("severity_text = 'ERROR'").groupBy(bucket).agg(F.count(F.lit(1)).alias("e"))
    everything = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("a"))
    return errors.join(everything, "ts").select("ts", F.round(F.col("e") / F.col("a") * 100, 6).alias("value"))


# ---- PromQL ----------------------------------------------------------------------------------

HOUR = 3_600_000
RANGE = 6 * HOUR
LOOKBACK = 2 * HOUR


def series(t):
    """One series per event type and service, a sample per event."""
    labels = F.create_map(F.lit("__name__"), F.lit("app_value"), F.lit("event"), F.col("event_type"), F.lit("service"), F.col("svc"))
    return d.events(t).select(labels.alias("labels"), int_div(F.col("us"), 1000).alias("ts"), "value")


def shown(df, digits=6):
    return df.select(map_json(F.col("labels")).alias("labels"), "ts", F.round("value", digits).alias("value"))


FULL = """'{"__name__":"app_value","event":"' || event_type || '","service":"' || svc || '"}'"""
BARE = """'{"event":"' || event_type || '","service":"' || svc || '"}'"""
BY_SERVICE = """'{"service":"' || svc || '"}'"""
BY_EVENT = """'{"event":"' || event_type || '"}'"""
EVENTS = "s AS (SELECT event_type, svc, us // 1000 AS ms, value FROM ev)"
INSTANTS = f"""{EVENTS}, inst AS (SELECT event_type, svc, g * {HOUR} AS ts, arg_max(value, ms) AS value
    FROM (SELECT *, unnest(range((ms + {HOUR - 1}) // {HOUR}, (ms + {LOOKBACK - 1}) // {HOUR} + 1)) AS g FROM s) GROUP BY 1, 2, 3)"""


def instants(t):
    return P.instants(series(t), HOUR, LOOKBACK)


@query("x_pq_1_selector", with_("ev", f"""
    WITH {EVENTS} SELECT {FULL} AS labels, ms AS ts, value FROM s
    WHERE svc <> 'svc1' AND regexp_full_match(event_type, 'cl.*|view') AND NOT regexp_full_match(svc, 'svc[2-4]') AND event_type <> 'x'"""))
def x_pq_1(t):
    matchers = [("service", "!=", "svc1"), ("event", "=~", "cl.*|view"), ("service", "!~", "svc[2-4]"), ("__name__", "=", "app_value")]
    return shown(P.select_series(series(t), matchers))


DELTAS = f"""{EVENTS}, d AS (SELECT *, lag(ms) OVER w AS pms, CASE WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS delta
    FROM s WINDOW w AS (PARTITION BY event_type, svc ORDER BY ms, value))"""


@query("x_pq_2_rate", with_("ev", f"""
    WITH {DELTAS}
    SELECT {FULL.replace('event_type', 'a.event_type').replace('svc', 'a.svc')} AS labels, a.ms AS ts, round(sum(b.delta) / {RANGE / 1000}, 9) AS value
    FROM d a JOIN d b ON a.event_type = b.event_type AND a.svc = b.svc AND b.ms <= a.ms AND b.pms > a.ms - {RANGE} GROUP BY a.event_type, a.svc, a.ms"""))
def x_pq_2(t):
    return shown(P.rate(series(t), RANGE), 9)


@query("x_pq_2_irate", with_("ev", f"""
    WITH {DELTAS} SELECT {FULL} AS labels, ms AS ts, round(delta / ((ms - pms) / 1000.0), 9) AS value FROM d WHERE ms - pms < {RANGE} AND ms > pms"""))
def x_pq_2_irate(t):
    return shown(P.irate(series(t), RANGE), 9)


@query("x_pq_3_sum_by", with_("ev", f"WITH {INSTANTS} SELECT {BY_SERVICE} AS labels, ts, round(sum(value), 6) AS value FROM inst GROUP BY 1, 2"))
def x_pq_3(t):
    return shown(P.aggregate(instants(t), "sum", by=["service"]))


@query("x_pq_3_max_without", with_("ev", f"WITH {INSTANTS} SELECT {BY_EVENT} AS labels, ts, round(max(value), 6) AS value FROM inst GROUP BY 1, 2"))
def x_pq_3_without(t):
    return shown(P.aggregate(instants(t), "max", without=["service", "__name__"]))


@query("x_pq_4_histogram_quantile", with_("hist", f"""
    WITH {hist_quantile_sql(0.95, 'res')}
    SELECT '{{"returnflag":"' || l_returnflag || '"}}' AS labels, epoch_ms(strptime(month || '-01', '%Y-%m-%d')) AS ts, round(v, 6) AS value FROM res"""))
def x_pq_4(t):
    bound = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    rows = d.quantity_histogram(t).select(
        F.create_map(F.lit("le"), bound, F.lit("returnflag"), F.col("l_returnflag")).alias("labels"),
        F.unix_millis(F.to_timestamp(F.concat("month", F.lit("-01")))).alias("ts"),
        "value",
    )
    return shown(P.histogram_quantile(rows, 0.95))


TRAILING = f"OVER (PARTITION BY event_type, svc ORDER BY ms RANGE BETWEEN {RANGE - 1} PRECEDING AND CURRENT ROW)"
for _how in ("max", "avg"):

    @query(f"x_pq_5_{_how}_over_time", with_("ev", f"WITH {EVENTS} SELECT {FULL} AS labels, ms AS ts, round({_how}(value) {TRAILING}, 6) AS value FROM s"))
    def x_pq_5(t, how=_how):
        return shown(P.over_time(series(t), how, RANGE))


@query("x_pq_6_offset", with_("ev", f"WITH {EVENTS} SELECT {FULL} AS labels, ms + 1800000 AS ts, value FROM s"))
def x_pq_6(t):
    return shown(P.offset(series(t), 1_800_000))


@query("x_pq_7_subquery", with_("ev", f"""
    WITH {INSTANTS} SELECT {FULL} AS labels, ts, round(avg(value) OVER (PARTITION BY event_type, svc ORDER BY ts RANGE BETWEEN {RANGE - 1} PRECEDING AND CURRENT ROW), 6) AS value FROM inst"""))
def x_pq_7(t):
    return shown(P.subquery(series(t), "avg", RANGE, HOUR, LOOKBACK))


VIEWS = f"""{INSTANTS}, l AS (SELECT * FROM inst WHERE event_type = 'view'), r AS (SELECT * FROM inst WHERE event_type = 'click')"""


def two_sides(t):
    now = instants(t)
    return P.select_series(now, [("event", "=", "view")]), P.select_series(now, [("event", "=", "click")])


@query("x_pq_8_divide_on", with_("ev", f"""
    WITH {VIEWS} SELECT '{{"service":"' || l.svc || '"}}' AS labels, l.ts, round(l.value / r.value, 6) AS value FROM l JOIN r USING (svc, ts) WHERE r.value <> 0"""))
def x_pq_8(t):
    left, right = two_sides(t)
    return shown(P.binary_op(left, right, "/", on=["service"]))


@query("x_pq_8_add_ignoring", with_("ev", f"""
    WITH {VIEWS} SELECT '{{"service":"' || l.svc || '"}}' AS labels, l.ts, round(l.value + r.value, 6) AS value FROM l JOIN r USING (svc, ts)"""))
def x_pq_8_ignoring(t):
    left, right = two_sides(t)
    return shown(P.binary_op(left, right, "+", ignoring=["event"]))


@query("x_pq_8_group_left", with_("ev", f"""
    WITH {INSTANTS}, t AS (SELECT svc, ts, sum(value) AS total FROM inst GROUP BY 1, 2)
    SELECT {BARE} AS labels, ts, round(value / total, 6) AS value FROM inst JOIN t USING (svc, ts) WHERE total <> 0"""))
def x_pq_8_group_left(t):
    now = instants(t)
    return shown(P.binary_op(now, P.aggregate(now, "sum", by=["service"]), "/", on=["service"], group="left"))


@query("x_pq_8_group_right", with_("ev", f"""
    WITH {VIEWS} SELECT '{{"event":"' || i.event_type || '","kind":"view","service":"' || i.svc || '"}}' AS labels, i.ts, round(l.value - i.value, 6) AS value
    FROM l JOIN inst i ON l.svc = i.svc AND l.ts = i.ts"""))
def x_pq_8_group_right(t):
    left, _ = two_sides(t)
    named = P.label_join(left, "kind", "", ["event"])
    return shown(P.binary_op(named, instants(t), "-", on=["service"], group="right", include=["kind"]))


@query("x_pq_9_comparison", with_("ev", f"""
    WITH {VIEWS} SELECT '{{"__name__":"app_value","event":"view","service":"' || l.svc || '"}}' AS labels, l.ts, round(l.value, 6) AS value FROM l JOIN r USING (svc, ts) WHERE l.value > r.value"""))
def x_pq_9(t):
    left, right = two_sides(t)
    return shown(P.binary_op(left, right, ">", on=["service"]))


@query("x_pq_9_equal_bool", with_("ev", f"""
    WITH {VIEWS} SELECT '{{"service":"' || l.svc || '"}}' AS labels, l.ts, CAST(CAST(l.value = r.value AS INT) AS DOUBLE) AS value FROM l JOIN r USING (svc, ts)"""))
def x_pq_9_bool(t):
    left, right = two_sides(t)
    return shown(P.binary_op(left, right, "==", on=["service"], as_bool=True))


@query("x_pq_9_scalar", with_("ev", f"""
    WITH {INSTANTS}, one AS (SELECT ts, value AS s FROM inst WHERE event_type = 'view' AND svc = 'svc3')
    SELECT {FULL} AS labels, ts, round(value, 6) AS value FROM inst JOIN one USING (ts) WHERE value > s"""))
def x_pq_9_scalar(t):
    now = instants(t)
    one = P.scalar(P.select_series(now, [("event", "=", "view"), ("service", "=", "svc3")]))
    return shown(P.compare_scalar(now, ">", one))


SETS = {
    "and": "SELECT l.* FROM l WHERE EXISTS (SELECT 1 FROM r WHERE r.svc = l.svc AND r.ts = l.ts)",
    "unless": "SELECT l.* FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.svc = l.svc AND r.ts = l.ts)",
    "or": "SELECT l.* FROM l UNION ALL SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM l WHERE r.svc = l.svc AND r.ts = l.ts)",
}
for _op, _sql in SETS.items():

    @query(f"x_pq_10_{_op}", with_("ev", f"WITH {VIEWS} SELECT {FULL} AS labels, ts, round(value, 6) AS value FROM ({_sql})"))
    def x_pq_10(t, op=_op):
        left, right = two_sides(t)
        return shown(P.set_op(left, right, op, on=["service"]))


for _name, _order in (("topk", "DESC"), ("bottomk", "ASC")):

    @query(f"x_pq_11_{_name}", with_("ev", f"""
        WITH {INSTANTS} SELECT labels, ts, round(value, 6) AS value FROM (SELECT *, {FULL} AS labels FROM inst)
        QUALIFY row_number() OVER (PARTITION BY ts ORDER BY value {_order}, labels) <= 3"""))
    def x_pq_11(t, name=_name):
        return shown(getattr(P, name)(instants(t), 3))


@query("x_pq_12_quantile", with_("ev", f"WITH {INSTANTS} SELECT {BY_EVENT} AS labels, ts, round(quantile_cont(value, 0.9), 6) AS value FROM inst GROUP BY 1, 2"))
def x_pq_12(t):
    return shown(P.quantile(instants(t), 0.9, by=["event"]))


@query("x_pq_12_sort_desc", with_("ev", f"WITH {INSTANTS} SELECT {FULL} AS labels, ts, round(value, 6) AS value FROM inst ORDER BY 3 DESC, 2, 1"))
def x_pq_12_sort(t):
    return shown(P.sort_desc(instants(t)))


GRID_START, GRID_END = 1_704_067_200_000, 1_706_659_200_000  # January 2024


@query("x_pq_13_absent", with_("ev", f"""
    WITH {EVENTS}, g AS (SELECT unnest(range({GRID_START}, {GRID_END} + 1, {HOUR})) AS ts), p AS (SELECT ms FROM s WHERE svc = 'svc1' AND event_type = 'view')
    SELECT '{{"service":"svc1"}}' AS labels, ts, 1.0::DOUBLE AS value FROM g WHERE NOT EXISTS (SELECT 1 FROM p WHERE ms <= ts AND ms > ts - {LOOKBACK})"""))
def x_pq_13(t):
    one = P.select_series(series(t), [("service", "=", "svc1"), ("event", "=", "view")])
    return shown(P.absent(one, GRID_START, GRID_END, HOUR, {"service": "svc1"}, LOOKBACK))


@query("x_pq_13_absent_over_time", with_("ev", f"""
    WITH {EVENTS}, g AS (SELECT unnest(range({GRID_START}, {GRID_END} + 1, {HOUR})) AS ts), p AS (SELECT ms FROM s WHERE svc = 'svc1' AND event_type = 'view')
    SELECT '{{}}' AS labels, ts, 1.0::DOUBLE AS value FROM g WHERE NOT EXISTS (SELECT 1 FROM p WHERE ms <= ts AND ms > ts - {RANGE})"""))
def x_pq_13_range(t):
    one = P.select_series(series(t), [("service", "=", "svc1"), ("event", "=", "view")])
    return shown(P.absent_over_time(one, RANGE, GRID_START, GRID_END, HOUR))


@query("x_pq_14_label_join", with_("ev", f"""
    WITH {EVENTS} SELECT '{{"__name__":"app_value","both":"' || svc || '-' || event_type || '","event":"' || event_type || '","service":"' || svc || '"}}' AS labels, ms AS ts, value FROM s"""))
def x_pq_14(t):
    return shown(P.label_join(series(t), "both", "-", ["service", "event"]))
