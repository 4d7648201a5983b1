"""Paths that only matter on large or skewed data, forced on small data."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemorph.operators import quantiles, resources, sinks, sizing, spans, timeseries
from telemorph.plans import promql


def naive(values, q):
    ordered = sorted(values)
    rank = q * (len(ordered) - 1)
    low = int(rank)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (rank - low)


def awkward_values(seed):
    rng = random.Random(seed)
    values = [rng.uniform(-5, 5) for _ in range(300)] + [rng.lognormvariate(0, 20) for _ in range(200)]
    values += [-rng.lognormvariate(0, 20) for _ in range(100)] + [0.0, -0.0, 1.0, 2.0, 4.0, 1.0 - 2**-53, 2.0 - 2**-52] + [7.25] * 500
    values += [1.0 + i * 2**-50 for i in range(200)] + [5e-324, -5e-324, 1.7e308]
    rng.shuffle(values)
    return values


def test_exact_percentiles(spark):
    groups = {"hot": awkward_values(1), None: awkward_values(2)[:7], "one": [3.5], "same": [2.5] * 40}
    rows = [(g, i % 2, v) for g, vs in groups.items() for i, v in enumerate(vs)] + [("hot", 0, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    wanted = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {(r["g"], r["h"]): r for r in quantiles.exact_percentiles(df, ["g", "h"], "v", wanted).collect()}
    expected = {}
    for g, h, v in rows:
        if v is not None:
            expected.setdefault((g, h), []).append(v)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        for name, q in wanted.items():
            assert math.isclose(got[key][name], naive(values, q), rel_tol=1e-12, abs_tol=1e-300), (key, name)


def jobs_so_far(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_hot_group_percentiles_are_lazy(spark):
    """A third of all rows, in one narrow value range, belong to one group."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("g"), (1 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 1e9).alias("v")
    )
    before = jobs_so_far(spark)
    got = quantiles.exact_percentiles(rows, ["g"], "v", {"a": 0.5, "b": 0.999})
    assert jobs_so_far(spark) == before
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    plain = rows.groupBy("g").agg(F.percentile("v", 0.5).alias("a"), F.percentile("v", 0.999).alias("b"))
    have, want = ({r["g"]: (r["a"], r["b"]) for r in df.collect()} for df in (got, plain))
    assert have.keys() == want.keys() and all(math.isclose(x, y, rel_tol=1e-12) for g in have for x, y in zip(have[g], want[g]))


def test_bitmap_keeps_what_is_wanted(spark):
    rows = spark.range(10_000).select("id", (F.col("id") % 7).alias("k"))
    kept = {r["id"] for r in sizing.only_maybe_in(rows, ["id", "k"], rows.where("id < 100")).collect()}
    assert set(range(100)) <= kept and len(kept) < 300


def test_value_buckets_keep_order(spark):
    values = sorted(set(awkward_values(3)))
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", quantiles.value_bucket(F.col("v")).alias("b")).collect()
    keys = [r["b"] for r in sorted(rows, key=lambda r: r["v"])]
    assert keys == sorted(keys)


def samples(spark):
    rng = random.Random(4)
    rows = [("hot", rng.randrange(0, 3_000_000), float(rng.randrange(100))) for _ in range(2000)]
    rows += [(None, i * 1000, float(i)) for i in range(50)]
    return spark.createDataFrame(list({(s, t): (s, t, v) for s, t, v in rows}.values()), "s string, ts bigint, v double")


def test_previous_across_chunks(spark):
    df = samples(spark)
    plain = Window.partitionBy("s").orderBy("ts")
    want = {(r["s"], r["ts"]): (r["p"], r["q"]) for r in df.withColumns({"p": F.lag("ts").over(plain), "q": F.lag("v").over(plain)}).collect()}
    for chunk in (1000, 70_000, 10_000_000):
        got = timeseries.with_previous(df, ["s"], "ts", "v", chunk).collect()
        assert {(r["s"], r["ts"]): (r["prev_ts"], r["prev_value"]) for r in got} == want


def plain_windows(rows, range_ms):
    """Per (series, ts): number, sum, least, greatest and increase in (t - range, t]."""
    series = {}
    for s, t, v in rows:
        points = series.setdefault(s, {})
        points[t] = max(v, points.get(t, v))
    out = {}
    for s, points in series.items():
        ordered = sorted(points.items())
        for i, (t, _) in enumerate(ordered):
            inside = [v for u, v in ordered[: i + 1] if u > t - range_ms]
            grown = sum(b if b < a else b - a for a, b in zip(inside, inside[1:]))
            out[s, t] = (len(inside), sum(inside), min(inside), max(inside), grown)
    return out


@pytest.mark.parametrize(("range_ms", "longest_ms"), [(50_000, 10**9), (50_000, 50_000), (50_000, 7_000), (4_000_000, 60_000), (13, 5), (600_000, 3_600_000)])
def test_trailing_windows_from_panes(spark, range_ms, longest_ms):
    df = samples(spark)
    df = df.union(df.where("ts % 3 = 0").withColumn("v", F.lit(40.0)))
    want = plain_windows([tuple(r) for r in df.collect()], range_ms)
    totals = timeseries.trailing_aggregates(df, ["s"], "ts", "v", range_ms, longest_ms).collect()
    assert {(r["s"], r["ts"]): (r["n"], r["total"], r["least"], r["most"]) for r in totals} == {k: v[:4] for k, v in want.items()}
    grown = timeseries.trailing_increase(df, ["s"], "ts", "v", range_ms, longest_ms).collect()
    assert len(grown) == len(want)
    for r in grown:
        n, *_, increase = want[r["s"], r["ts"]]
        assert r["n"] == n and math.isclose(r["increase"], increase, abs_tol=1e-9)


@pytest.mark.parametrize(("range_ms", "longest_ms"), [(50_000, 10**9), (50_000, 7_000), (4_000_000, 60_000), (13, 5)])
def test_samples_of_one_instant_all_count(spark, range_ms, longest_ms):
    df = samples(spark).fillna("none", ["s"])
    df = df.union(df.where("ts % 3 = 0").withColumn("v", F.lit(40.0))).union(df.where("ts % 5 = 0"))
    rows = sorted(tuple(r) for r in df.collect())
    want, grown = [], {}
    for s, t, _ in rows:
        inside = [v for r, u, v in rows if r == s and t - range_ms < u <= t]
        want.append((s, t, len(inside), round(sum(inside), 6), min(inside), max(inside)))
        increase = sum(b if b < a else b - a for a, b in zip(inside, inside[1:]))
        grown[s, t] = (len(inside), sum((r, u) == (s, t) for r, u, _ in rows), round(increase, 6))
    totals = timeseries.trailing_aggregates(df, ["s"], "ts", "v", range_ms, longest_ms, every=True).collect()
    assert sorted((r["s"], r["ts"], r["n"], round(r["total"], 6), r["least"], r["most"]) for r in totals) == want
    got = timeseries.trailing_increase(df, ["s"], "ts", "v", range_ms, longest_ms, every=True).collect()
    assert len(got) == len(grown) and {(r["s"], r["ts"]): (r["n"], r["rows"], round(r["increase"], 6)) for r in got} == grown


def test_rates_and_ranges_of_repeated_instants(spark):
    made = [({"a": "x"}, t, v) for t, v in [(0, 5.0), (10, 3.0), (10, 7.0), (20, 7.0), (20, 7.0)]]
    df = spark.createDataFrame(made, "labels map<string,string>, ts long, value double")
    # Steps by (ts, value): reset to 3, up to 7, and nothing more; two samples at 10 and at 20.
    assert sorted((r["ts"], r["value"]) for r in promql.rate(df, 1000).collect()) == [(10, 14.0), (20, 14.0)]
    averages = sorted((r["ts"], r["value"]) for r in promql.over_time(df, "avg", 1000).collect())
    assert averages == [(0, 5.0), (10, 5.0), (10, 5.0), (20, 5.8), (20, 5.8)]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") , plan


def test_one_exchange_of_samples(spark):
    df = samples(spark)
    for out in (timeseries.trailing_increase(df, ["s"], "ts", "v", 50_000), timeseries.trailing_aggregates(df, ["s"], "ts", "v", 50_000)):
        count, plan = exchanges(out)
        assert plan.count("Exchange") == plan.count("Exchange hashpartitioning") == count == 1


def test_topk_of_one_instant_is_spread(spark):
    rows = spark.range(40_000).select(F.create_map(F.lit("i"), F.col("id").cast("string")).alias("labels"), F.lit(5).cast("long").alias("ts"), (F.col("id") % 977).cast("double").alias("value"))
    got = promql.topk(rows, 5000)
    assert "_share" in exchanges(got)[1]
    want = sorted(((-(i % 977), f'{{"i":"{i}"}}') for i in range(40_000)))[:5000]
    assert sorted((-r["value"], f'{{"i":"{r["labels"]["i"]}"}}') for r in got.collect()) == [(float(v), s) for v, s in want]


def test_fingerprints_of_frequent_and_rare_resources(spark):
    rows = spark.range(200).select("id", F.concat(F.lit('{"service.name":"s'), F.col("id") % 7, F.lit('"}')).alias("labels"))
    before = jobs_so_far(spark)
    every, few = resources.attach_fingerprint(rows, "labels"), resources.attach_fingerprint(rows, "labels", frequent=2)
    assert jobs_so_far(spark) == before
    assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, every.collect()))
    assert got == sorted(map(tuple, few.collect())) and len({fp for _, fp in got}) == 7
    assert {fp for _, fp in got} == {r["fingerprint"] for r in resources.fingerprint_resources(rows.withColumn("ts_bucket_start", F.lit(0)), "labels")[1].collect()}


def test_stored_spans_are_not_moved_for_their_links(spark, tmp_path):
    hours = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600)
    rows = spark.range(96).select(
        hours.alias("timestamp"), F.concat(F.lit("s"), F.col("id") % 40).alias("spanID"), F.lit("t").alias("traceID"), F.create_map(F.lit("k"), F.lit("old")).alias("tags")
    )
    models = rows.select("timestamp", "traceID", F.concat(F.lit('{"spanID":"'), "spanID", F.lit('","references":['), F.unix_seconds("timestamp"), F.lit("]}")).alias("model"))
    stored = spans.store_spans(rows, "stored_spans_test", str(tmp_path / "spans"), buckets=8)
    out = spans.attach_links(stored, models)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left, right = plan[: plan.index("FileScan")].split("SortMergeJoin")[1], plan[plan.index("FileScan") :]
    assert "Exchange" not in left and "Bucketed: true" in right and "Exchange" in right and "tags" not in right[right.index("Exchange") :]
    assert all(r["links"] == f"[{int(r['timestamp'].timestamp())}]" for r in out.collect()) and out.count() == 96
    again = rows.where("timestamp >= '2024-01-02' and timestamp < '2024-01-03'").withColumn("tags", F.create_map(F.lit("k"), F.lit("new")))
    spans.store_spans(again, "stored_spans_test", buckets=8)
    days = {(str(r["day"]), r["tag"]): r["count"] for r in spark.table("stored_spans_test").groupBy("day", F.col("tags")["k"].alias("tag")).count().collect()}
    assert days == {("2024-01-01", "old"): 24, ("2024-01-02", "new"): 24, ("2024-01-03", "old"): 24, ("2024-01-04", "old"): 24}
    spark.sql("DROP TABLE stored_spans_test")


def test_broadcast_only_when_measured_small(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("name"))
    assert sizing.measured_bytes(df) >= 1000 * sizing.ROW_OVERHEAD_BYTES
    assert sizing.broadcast_if_small(df)[1] and not sizing.broadcast_if_small(df, limit=10)[1]


def test_staged_table_is_read_back(spark):
    df = sizing.staged(spark.range(10).withColumn("m", F.create_map(F.lit("a"), F.col("id"))))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 10


def test_rerun_replaces_only_its_partitions(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("day"))
    sinks.write_upgraded(df, str(tmp_path / "t"), ["day"], mode="overwrite")
    sinks.write_upgraded(df.where("day = 1"), str(tmp_path / "t"), ["day"], mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100
