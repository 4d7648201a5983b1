import json
from urllib.parse import quote_plus, unquote_plus

import pytest
from pyspark.sql import functions as F

from telemorph.operators import documents as D
from telemorph.operators import legacy_documents as L
from telemorph.operators import log_fields as LF

DB, TABLE = "telemetry_metrics", "telemetry_logs.distributed_logs"


def run(spark, job, docs, *args):
    rows = [(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(docs)]
    out = job(spark.createDataFrame(rows, "id int, data string"), *args)
    return [r.asDict() for r in out.orderBy("id").collect()]


@pytest.fixture(scope="module")
def names(spark):
    return D.NameMapping(
        spark.createDataFrame([("app_event_value", "app.event.value"), ("job:rate", "job.rate")], "norm_name string, orig_name string"),
        spark.createDataFrame([("app_event_value", "service_name", "service.name")], "norm_name string, norm_key string, orig_key string"),
        spark.createDataFrame([("service_name", "service.name"), ("node", "k8s.node")], "norm_key string, orig_key string"),
    )


def key(name, kind, dtype="string"):
    return {"key": name, "dataType": dtype, "type": kind, "isColumn": False, "isJSON": False}


# ---- names of metrics ------------------------------------------------------------------


def test_dashboard_panels_in_list_and_map(spark, names):
    panel = {"id": "p", "query": {"promql": [{"query": "job:rate{node=\"$node\"} + app_event_value", "legend": "node"}]}}
    broken = {"id": "b", "query": {"promql": [{"query": "sum(job:rate"}], "clickhouse_sql": [{"query": "SELECT node", "legend": "node"}]}}
    doc = {"widgets": [panel, broken, 3], "panelMap": {"x": panel, "y": [1]}, "keep": {"n": 1.5}}
    row = run(spark, D.rewrite_dashboards, [doc], names, DB)[0]
    new = json.loads(row["data"])
    want = {"query": '{"job.rate",node="$node"} + {"app.event.value"}', "legend": "k8s.node"}
    assert new["widgets"][0]["query"]["promql"] == [want] == new["panelMap"]["x"]["query"]["promql"]
    assert new["widgets"][1] == broken and new["widgets"][2] == 3 and new["panelMap"]["y"] == [1]
    assert new["keep"] == {"n": 1.5} and new["dotMigrated"] is True
    assert (row["changed"], row["panel_errors"], row["error"]) == (True, 1, None)


def test_dashboards_are_rewritten_once(spark, names):
    doc = {"widgets": [{"query": {"builder": {"queryData": [{"dataSource": "metrics", "x": "node"}]}}}]}
    first = run(spark, D.rewrite_dashboards, [doc], names, DB)[0]["data"]
    again = run(spark, D.rewrite_dashboards, [first], names, DB)[0]
    assert again["data"] == first and again["changed"] is False


def test_sql_without_known_metric_uses_all_attributes(spark, names):
    text = "SELECT node, service_name FROM telemetry_metrics.samples WHERE metric_name = 'unknown_metric'"
    doc = {"widgets": [{"query": {"clickhouse_sql": [{"query": text}]}}]}
    new = json.loads(run(spark, D.rewrite_dashboards, [doc], names, DB)[0]["data"])
    assert new["widgets"][0]["query"]["clickhouse_sql"][0]["query"] == text.replace("node", "`k8s.node`").replace("service_name", "`service.name`")


def test_equal_texts_of_many_documents_are_rewritten_once(spark, names, monkeypatch):
    staged, seen = D.staged, []

    def counted(df):
        out = staged(df)
        seen.append(out.count())
        return out

    monkeypatch.setattr(D, "staged", counted)
    panel = {"query": {"promql": [{"query": "job:rate", "legend": "node"}]}}
    docs = [{"id": i, "widgets": [panel] * (1 + i % 3)} for i in range(20)]
    new = run(spark, D.rewrite_dashboards, docs, names, DB)
    want = {"query": '{"job.rate"}', "legend": "k8s.node"}
    assert all(json.loads(r["data"])["widgets"][-1]["query"]["promql"] == [want] for r in new)
    # One part, two texts in it.
    assert [n for n in seen if n] == [1, 2, 1]


def test_flat_rows_of_odd_panels_and_only_those_asked_for(spark):
    sql = {"name": "A", "query": "select 1", "legend": 7}
    odd = [3, None, {"query": "x"}, {"query": {"promql": {"query": "up"}, "clickhouse_sql": [sql, 5, {"query": 8}, {"query": "select 2"}], "builder": [1]}}]
    builder = {"queryData": [{"queryName": "B"}], "queryFormulas": [{"expression": "B", "legend": ""}, "y"]}
    docs = [{"widgets": odd, "panelMap": {"p": {"query": {"builder": builder, "promql": [{"query": "up"}]}}}, "variables": {"v": {"queryValue": "q"}, "w": 1}}, {"widgets": 3}, "no"]
    stored = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(9, "{")], "id int, data string")
    got = {(r.id, r.panel, r.lang, r.pos, r.name, r.text) for r in D.flatten_queries(stored).collect()}
    texts = {
        (0, "3", "sql", 0, "A", "select 1"), (0, "3", "sql", 3, None, "select 2"), (0, "p", "builder", 0, "B", '{"queryName":"B"}'), (0, "p", "formula", 0, None, "B"),
        (0, "p", "formula_legend", 0, None, ""), (0, "p", "promql", 0, None, "up"), (0, None, "variable", 0, "v", "q"),
    }
    assert got == texts
    some = D.flatten_queries(stored, langs=["promql", "variable"]).collect()
    assert {(r.lang, r.text) for r in some} == {("promql", "up"), ("variable", "q")}


def test_rows_are_made_once_for_rewriting(spark, names):
    stored = spark.createDataFrame([(1, json.dumps({"widgets": [{"query": {"promql": [{"query": "job:rate"}]}}]}))], "id int, data string")
    out = D.rewrite_names(D.flatten_queries(stored, langs=["promql"]).select("id", "lang", "text"), names)
    assert "parse_json" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r.text for r in out.collect()] == ['{"job.rate"}']


def test_alert_with_embedded_query(spark, names):
    embedded = {"builderQueries": {"A": {"dataSource": "metrics", "k": "node", "t": "a+b c/ü*~"}}}
    source = "https://h/x?b=1&compositeQuery=" + quote_plus(quote_plus(quote_plus(json.dumps(embedded)))) + "&a=2#f"
    rule = {"condition": {"compositeQuery": {"builderQueries": {"A": {"dataSource": "logs", "k": "node"}}}}, "source": source, "labels": {"node": "x", "n": 1}}
    new = json.loads(run(spark, D.rewrite_alerts, [rule], names, DB)[0]["data"])
    assert new["condition"]["compositeQuery"]["builderQueries"]["A"] == {"dataSource": "logs", "k": "node"}
    assert new["labels"] == {"k8s.node": "x", "n": 1}
    query = new["source"].split("?")[1].split("#")[0]
    parts = dict(p.split("=") for p in query.split("&"))
    assert list(parts) == ["a", "b", "compositeQuery"] and new["source"].endswith("#f")
    plain = unquote_plus(unquote_plus(unquote_plus(parts["compositeQuery"])))
    assert json.loads(plain)["builderQueries"]["A"] == {"dataSource": "metrics", "k": "k8s.node", "t": "a+b c/ü*~"}


def test_rules_that_cannot_be_read_are_left_alone(spark, names):
    out = run(spark, D.rewrite_alerts, ["{", {"condition": 1}, {"a": "node"}], names, DB)
    assert [r["error"] for r in out] == ["invalid JSON", "no composite query", "no composite query"]
    assert not any(r["changed"] for r in out)


# ---- log fields --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def log_fields(spark):
    rows = [
        ("attributes_string_service_name", "service.name"),
        ("resources_string_container_name", "container.name"),
        ("attributes_float64_extra_info_request_timings_sys_schedule_thread", "extra_info.request_timings.sys.schedule_thread"),
        ("resources_string_service_name", "service.name"),
        ("attributes_string_request_context_test_name", "request_context.test_name"),
    ]
    return spark.createDataFrame(rows, "ref string, new_name string")


def log_query(field, container):
    return {
        "queryName": "A", "dataSource": "logs", "aggregateAttribute": key("", "", ""), "expression": "A", "legend": "{{" + container + "}}",
        "filters": {"op": "AND", "items": [{"key": key(field, "tag"), "value": "c", "op": "="}]},
        "groupBy": [key(container, "resource")], "orderBy": [{"columnName": container, "order": "asc"}],
    }


def test_alert_with_formula(spark, log_fields):
    def rule(field, container):
        queries = {
            "A": log_query(field, container),
            "F1": {"queryName": "F1", "expression": "A * 100", "legend": "{{" + container + "}}"},
            "M": {"queryName": "M", "dataSource": "metrics", "expression": "M", "legend": "{{container_name}}"},
        }
        return {"condition": {"compositeQuery": {"queryType": "builder", "builderQueries": queries, "chQueries": {"A": {"query": "select 1"}}}}, "op": "1"}

    new = run(spark, LF.rename_log_fields_alerts, [rule("service_name", "container_name")], log_fields, TABLE)[0]
    assert json.loads(new["data"]) == rule("service.name", "container.name") and new["changed"]


def test_dashboard_with_formula(spark, log_fields):
    def board(field, container):
        builder = {"queryData": [log_query(field, container)], "queryFormulas": [{"legend": "x {{" + container + "}}"}]}
        return {"widgets": [{"query": {"queryType": "builder", "builder": builder}}, {"id": "no query"}]}

    new = run(spark, LF.rename_log_fields_dashboards, [board("service_name", "container_name")], log_fields, TABLE)[0]
    assert json.loads(new["data"]) == board("service.name", "container.name")


def test_documents_without_a_change_are_not_written(spark, log_fields):
    """One change of each kind alone is seen, and others leave the text as it is."""
    query = {"queryName": "A", "dataSource": "logs", "groupBy": [key("x", "tag")], "orderBy": [{"columnName": "x"}], "legend": "{{x}}", "filters": {"items": [3, None]}}
    group = {**query, "groupBy": [key("container_name", "resource"), None]}

    def board(entry, kind="builder", legend="l", sql=None):
        return {"t": None, "widgets": [None, {"query": {"queryType": kind, "builder": {"queryData": [entry], "queryFormulas": [{"legend": legend}]}, "clickhouse_sql": sql}}]}

    attribute = {**query, "aggregateAttribute": key("service_name", "tag")}
    filtered = {**query, "filters": {"items": [{"key": key("service_name", "tag")}]}}
    mapped = [{"query": "select resource_string_service_name from " + TABLE}]
    same = [board(query), board({**attribute, "dataSource": "metrics"}), board(query, sql=mapped), board(attribute, "promql"), {"widgets": 3}, 5]
    new = [board(attribute), board(filtered), board(group), board(query, "clickhouse_sql", sql=mapped)]
    out = run(spark, LF.rename_log_fields_dashboards, [*same, *new], log_fields, TABLE)
    assert [r["changed"] for r in out] == [False] * len(same) + [True] * len(new)
    assert [r["data"] for r in out[: len(same)]] == [json.dumps(d) for d in same]
    attribute["aggregateAttribute"]["key"] = filtered["filters"]["items"][0]["key"]["key"] = "service.name"
    group["groupBy"][0]["key"], mapped[0]["query"] = "container.name", "select resource_string_service$$name from " + TABLE
    assert [json.loads(r["data"]) for r in out[len(same) :]] == new
    renamed = board({**group, "groupBy": [key("container_name", "resource")]}, legend="{{container_name}}")
    assert json.loads(run(spark, LF.rename_log_fields_dashboards, [renamed], log_fields, TABLE)[0]["data"])["widgets"][1]["query"]["builder"]["queryFormulas"] == [{"legend": "{{container.name}}"}]
    plan = LF.rename_log_fields_dashboards(spark.createDataFrame([(1, "{}")], "id int, data string"), log_fields, TABLE)._jdf.queryExecution().optimizedPlan().toString()
    assert "_old" not in plan


SQL_CASES = [
    (
        "SELECT quantile(0.9)(attributes_float64_value[indexOf(attributes_float64_key, '{}')]) AS value FROM " + TABLE
        + " WHERE has(attributes_float64_key, '{}') AND attribute_string_team = 'x'",
        "extra_info_request_timings_sys_schedule_thread", "extra_info.request_timings.sys.schedule_thread",
    ),
    (
        "select resource_string_{} as service, count() as n from " + TABLE + " group by resource_string_{} order by n desc limit 20;",
        "service_name", "service$$name",
    ),
    (
        "SELECT A.request_context_test_name FROM (SELECT attributes_string_value[indexOf(attributes_string_key, '{}')] as request_context_test_name"
        " from " + TABLE + ") as A INNER JOIN (SELECT 1 FROM t WHERE indexOf(attributes_string_key, '{}') > 0) as B ON A.ts = B.ts",
        "request_context_test_name", "request_context.test_name",
    ),
]


@pytest.mark.parametrize("template,old,new", SQL_CASES)
def test_log_fields_in_sql(spark, log_fields, template, old, new):
    def rule(name):
        return {"condition": {"compositeQuery": {"queryType": "clickhouse_sql", "chQueries": {"A": {"query": template.replace("{}", name)}}}}}

    out = run(spark, LF.rename_log_fields_alerts, [rule(old)], log_fields, TABLE)[0]
    assert json.loads(out["data"]) == rule(new)

    def board(name):
        return {"widgets": [{"query": {"queryType": "clickhouse_sql", "builder": {}, "clickhouse_sql": [{"query": template.replace("{}", name)}, {"name": "B"}]}}]}

    out = run(spark, LF.rename_log_fields_dashboards, [board(old)], log_fields, TABLE)[0]
    assert json.loads(out["data"]) == board(new)


def test_log_fields_in_every_sql_entry_of_an_alert(spark, log_fields):
    template, old, new = SQL_CASES[0]

    def rule(name):
        entries = {k: {"query": template.replace("{}", name), "disabled": k == "C"} for k in ("A", "B", "C")}
        return {"condition": {"compositeQuery": {"queryType": "clickhouse_sql", "chQueries": {**entries, "D": {"disabled": True}}}}}

    out = run(spark, LF.rename_log_fields_alerts, [rule(old)], log_fields, TABLE)[0]
    assert json.loads(out["data"]) == rule(new)


def test_sql_on_other_tables_is_left_alone(spark, log_fields):
    rule = {"condition": {"compositeQuery": {"queryType": "clickhouse_sql", "chQueries": {"A": {"query": "select resource_string_service_name from t"}}}}}
    assert run(spark, LF.rename_log_fields_alerts, [rule], log_fields, TABLE)[0]["changed"] is False


# ---- legacy documents ----------------------------------------------------------------------


def test_layout_repair_and_height(spark):
    widgets = [{"id": "a"}, {"id": "b"}, {"id": "c"}, {"id": "d"}]
    layout = [{"i": "", "h": 1}, {"i": "xbx", "h": 2, "w": 9}, {"i": "empty", "h": 3}, {"i": "4", "h": 4}, {"i": "other", "h": 5}]
    out = json.loads(run(spark, L.repair_layout, [{"widgets": widgets, "layout": layout, "k": 1}])[0]["data"])
    assert [e["i"] for e in out["layout"]] == ["a", "b", "c", "d", "other"] and out["layout"][1]["w"] == 9 and out["k"] == 1
    once = run(spark, L.double_layout_height, [{"layout": layout}])[0]["data"]
    assert [e["h"] for e in json.loads(once)["layout"]] == [2, 4, 6, 8, 10]
    assert run(spark, L.double_layout_height, [once])[0]["changed"] is False


def test_legacy_jobs_skip_what_is_done_or_broken(spark):
    done = {"widgets": [{"query": {"queryType": "promql", "promql": []}}]}
    for job in (L.upgrade_dashboards_v3, L.upgrade_dashboards_promql):
        out = run(spark, job, ["{", done])
        assert [r["changed"] for r in out] == [False, False] and out[0]["error"] == "invalid JSON" and json.loads(out[1]["data"]) == done
    rule = {"condition": {"compositeQuery": {"queryType": "builder"}}, "evalWindow": "5m"}
    assert run(spark, L.upgrade_rules_v3, [rule])[0]["changed"] is False


def test_panels_without_builder_queries_keep_their_titles(spark):
    doc = {"widgets": [{"id": "w", "title": "T", "yAxisUnit": "s", "timePreferance": "G", "query": {"queryType": 3, "promQL": [{"query": "up", "name": "A"}]}}]}
    new = json.loads(run(spark, L.upgrade_dashboards_v3, [doc])[0]["data"])["widgets"][0]
    assert (new["title"], new["yAxisUnit"], new["timePreferance"]) == ("T", "s", "G")
    assert new["query"]["queryType"] == "promql" and new["query"]["promql"][0]["query"] == "up" and new["query"]["builder"]["queryData"] == []


def test_builder_form_is_told_without_copying_panels(spark):
    """only the query types of panels are read, whatever else a document holds."""
    texts = [
        '{"widgets":[{"query":{"queryType":1}},{"query":{"queryType":"builder"},"other":[1]}]}',
        '{"widgets":[7,null,"x",{"query":[1]},{"query":{"queryType":null}},{}]}',
        '{"widgets":{"query":{"queryType":"builder"}}}',
        '{"_":"x","widgets":[3,{"query":{"queryType":"promql"}}]}',
        '{"_":"x"}', "[1]", "null", "{",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, data string")
    told = docs.select("id", F.coalesce(L.is_builder_dashboard(F.try_parse_json("data")), F.lit(False)).alias("told"))
    assert [r.told for r in told.orderBy("id").collect()] == [True, False, False, True, False, False, False, False]
    assert "array<variant>" not in told._jdf.queryExecution().analyzed().toString()
    done = L.upgrade_dashboards_v3(docs).orderBy("id").collect()
    assert [r.error for r in done] == [None] * 5 + ["invalid JSON"] * 3 and [r.id for r in done if r.changed] == [1]
    assert [r.data == text for r, text in zip(done, texts, strict=True)] == [not r.changed for r in done]
