import pytest
from pyspark.sql import functions as F

from telemorph.operators import fields, logs, metrics, retention, scans, sinks, spans, verify
from telemorph.sources import derived as d
from telemorph.sources.tables import Tables, parse_documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


TTL = "TTL toDateTime(timestamp / 1000000000) + toIntervalSecond(1296000)"
MOVE = "toDateTime(timestamp / 1000000000) + toIntervalSecond(1728000) TO VOLUME '{}' SETTINGS index_granularity = 8192, ttl_only_drop_parts = 1"


@pytest.mark.parametrize(
    "text,want",
    [
        (TTL + " SETTINGS index_granularity = 8192, ttl_only_drop_parts = 1", (1296000, -1, "")),
        (TTL + " DELETE, " + MOVE.format("cold"), (1296000, 1728000, "cold")),
        (TTL + " DELETE, " + MOVE.format("s3"), (1296000, 1728000, "s3")),
        ("ORDER BY id", (-1, -1, "")),
        ("TTL " + MOVE.format("cold"), (1728000, 1728000, "cold")),
    ],
)
def test_parse_ttl(spark, text, want):
    row = retention.parse_ttl(spark.createDataFrame([(text,)], "engine_full string")).first()
    assert (row["delete_ttl"], row["move_ttl"], row["cold_tier"]) == want


def test_promoted_column_is_found(spark):
    table = spark.createDataFrame([("en",)], "`resource_string_telemetry$$sdk$$language` string")
    rows = [("telemetry.sdk.language", "String", "resource"), ("telemetry.sdk.language", "int64", "resource"), ("other", "string", "resource")]
    found = fields.promoted_fields(table, spark.createDataFrame(rows, "name string, datatype string, type string"))
    assert [(r["name"], r["datatype"]) for r in found.collect()] == [("telemetry.sdk.language", "String")]


def test_adjacent_ranges_see_every_row_once(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "ts")
    edges = [0, 10, 50, 100]
    seen = [r["ts"] for lo, hi in zip(edges, edges[1:]) for r in scans.scan_range(df, "ts", lo, hi, "(]").collect()]
    assert sorted(seen) == list(range(1, 101))


def test_gaps_lie_between_rows(spark):
    counts = spark.createDataFrame([("a", 0), ("a", 1800), ("a", 7200), ("b", 3600)], "serviceName string, ts_bucket_start bigint")
    assert [tuple(r) for r in scans.time_gaps(counts).collect()] == [("a", 3600, 7200)]


def test_pages_are_disjoint_and_complete(t):
    rows = d.errors_v1(t).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    total = rows.count()
    ids = [r["errorID"] for off in range(0, total, 40) for r in scans.page_by_time(rows, 40, off).select("errorID").collect()]
    assert len(ids) == total == len(set(ids))


def test_span_upgrade_keeps_every_row(t):
    out = spans.upgrade_spans_to_v3(d.spans_v2(t), d.span_models_v2(t))
    assert out["spans"].count() == t.events.count()
    assert out["spans"].columns[:2] == ["ts_bucket_start", "resource_fingerprint"] and len(out["spans"].columns) == 29
    ids = out["resources"].select("fingerprint").distinct()
    assert out["spans"].join(ids, F.col("resource_fingerprint") == F.col("fingerprint"), "left_anti").count() == 0


def test_grpc_columns_only_with_fix(t):
    old = d.spans_v1(t)
    assert spans.upgrade_spans_v2(old).where("gRPCCode <> ''").count() == 0
    assert spans.upgrade_spans_v2(old, fix=True).where("gRPCCode = ''").count() == 0


def test_log_upgrade_columns(t):
    out = logs.upgrade_logs(d.logs_v1(t))["logs"]
    assert out.columns == logs.LOG_V2_COLUMNS and out.count() == t.events.count()


def test_links_by_trace(spark):
    sp = spark.createDataFrame([("s", "t1"), ("s", "t2")], "spanID string, traceID string").withColumn("timestamp", F.timestamp_seconds(F.lit(1000)))
    models = spark.createDataFrame(
        [("t1", '{"spanID":"s","references":[1]}'), ("t2", '{"spanID":"s","references":null}'), ("t3", "no json")], "traceID string, model string"
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(1001)))
    by_trace = {r["traceID"]: r["links"] for r in spans.attach_links(sp, models, by_trace=True).collect()}
    assert by_trace == {"t1": "[1]", "t2": "null"}


def test_parse_overrides():
    assert metrics.parse_overrides(" a = b ,c=d,bad, =x,y=", {"a": "old", "z": "1"}) == {"a": "b", "c": "d", "z": "1"}


def test_oldest_row_decides_a_fingerprint(spark):
    rows = [(1, "m", "Delta", '{"x":"1"}', 200), (1, "m", "Delta", '{"x":"2"}', 100)]
    series = spark.createDataFrame(rows, "fingerprint bigint, metric_name string, temporality string, labels string, unix_milli bigint")
    new = series.drop("unix_milli").withColumns({"new_fingerprint": F.col("labels"), "new_metric_name": F.lit("n")})
    assert metrics.fingerprint_map(series, new).collect()[0]["new_fingerprint"] == '{"x":"2"}'


CATALOG = "env string, temporality string, metric_name string, description string, unit string, type string, is_monotonic boolean, fingerprint bigint, unix_milli bigint, labels string, normalized boolean"
SAMPLES = "env string, temporality string, metric_name string, fingerprint bigint, unix_milli bigint, value double, flags bigint"
DETAILS = "metric_name string, orig_name string, key_map map<string,string>, class_map map<string,string>"


def upgraded(spark, identities, first, last):
    """The upgrade of one sample a minute of each identity (fingerprint, name,
    temporality) over the first hour, with the catalog row of that hour."""
    catalog = [("e", kind, name, "", "", "Gauge", False, fp, 0, f'{{"__name__":"{name}"}}', True) for fp, name, kind in identities]
    samples = [("e", kind, name, fp, minute * 60_000, 1.0, 0) for fp, name, kind in identities for minute in range(60)]
    names = sorted({name for _, name, _ in identities} - {"left_out"})
    details = spark.createDataFrame([(n, n.replace("_", "."), {}, {}) for n in names], DETAILS)
    return metrics.upgrade_metrics(spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(samples, SAMPLES), details, first, last)


def test_samples_of_a_cut_hour_find_their_series(spark):
    out = upgraded(spark, [(1, "a_b", "Delta")], 1_800_000, 3_600_000)
    assert out["samples"].count() == 30 and out["unmatched_samples"].count() == 0 and out["series"].count() == 0


def test_identities_of_one_fingerprint_stay_apart(spark):
    out = upgraded(spark, [(1, "a_b", "Delta"), (1, "c_d", "Delta"), (1, "a_b", None), (1, "left_out", "Delta")], 0, 3_600_000)
    found = {(r["metric_name"], r["temporality"]): r["count"] for r in out["samples"].groupBy("metric_name", "temporality").count().collect()}
    assert found == {("a.b", "Delta"): 60, ("c.d", "Delta"): 60, ("a.b", None): 60}
    assert out["unmatched_samples"].select("metric_name").distinct().collect() == [("left_out",)] and out["series"].count() == 3


def test_unresolved_names_fail_the_job(spark):
    pairs = spark.createDataFrame([("a", "x"), ("b", None)], "norm_name string, orig_name string")
    with pytest.raises(verify.UnresolvedNames, match="metrics without a counterpart: b"):
        verify.require_resolved(pairs, "norm_name", "orig_name", "metrics")
    assert verify.require_resolved(pairs.where("norm_name = 'a'"), "norm_name", "orig_name", "metrics").count() == 1


def test_empty_input_fails_the_job(spark):
    with pytest.raises(verify.EmptyInput):
        verify.require_rows(spark.range(0), "logs")


def test_too_many_names_for_arrays(t):
    with pytest.raises(ValueError, match="attribute_classes"):
        metrics.attribute_class_arrays(d.attribute_metadata(t), limit=3)


def test_documents_split(spark):
    docs = spark.createDataFrame([(1, '{"a":1}'), (2, "[1]"), (3, "{"), (4, None)], "id int, data string")
    good, bad = parse_documents(docs)
    assert [r["id"] for r in good.collect()] == [1] and sorted(r["id"] for r in bad.collect()) == [2, 3, 4]


def test_updates_keep_other_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "id int, data string")
    new = sinks.apply_updates(docs, docs.where("id = 2").withColumn("data", F.lit("c")))
    assert sorted(map(tuple, new.collect())) == [(1, "a"), (2, "c")]
    again = sinks.apply_updates(new, docs.where("id = 2").withColumn("data", F.lit("c")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_source_survives_without_parity(spark):
    with pytest.raises(RuntimeError):
        sinks.finalise(spark, "no_such_table", parity_ok=False, drop_source=True)
    assert sinks.finalise(spark, "no_such_table", parity_ok=True) is False


def test_source_goes_with_its_files_after_parity(spark, tmp_path):
    spark.range(5).write.option("path", str(tmp_path / "old")).saveAsTable("retired_source")
    assert sinks.finalise(spark, "retired_source", parity_ok=True, drop_source=True)
    assert not spark.catalog.tableExists("retired_source") and not (tmp_path / "old").exists()


def test_reset_keeps_the_schema(t):
    assert sinks.reset_table(t.events).schema == t.events.schema and sinks.reset_table(t.events).count() == 0


def test_range_filter_reaches_the_scan(spark):
    df = scans.select_columns(scans.scan_range(spark.read.parquet(f"{FOLDER}/events.parquet"), "event_id", 10, 20), ["event_id", "value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_id,10)" in plan and "LessThanOrEqual(event_id,20)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_tags_of_every_type(spark):
    from telemorph.plans.requests import SPAN, tag_predicate

    spans = spark.sql("select 1 as id, map('k', 'v') as attributes_string, map('n', 1.0D) as attributes_number, map('b', true) as attributes_bool, map('r', 'x') as resources_string")
    for key, kind in (("k", "string"), ("n", "number"), ("b", "bool")):
        assert spans.where(tag_predicate(key, SPAN, "Exists", data_type=kind)).count() == 1
        assert spans.where(tag_predicate(key, SPAN, "NotExists", data_type=kind)).count() == 0


def test_query_names_go_on_after_z(spark):
    from telemorph.operators.legacy_documents import _query_name

    names = {r.id: r.n for r in spark.range(800).select("id", _query_name(F.col("id")).alias("n")).collect()}
    assert [names[i] for i in (0, 25, 26, 51, 52, 701, 702, 728)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "ABA"]
    assert len(set(names.values())) == 800
