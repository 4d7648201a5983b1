import pytest
from pyspark.sql import functions as F

from telemorph.plans import builder as B
from telemorph.plans import promql as P
from telemorph.plans import requests as R
from telemorph.plans import spec as S


def query(**more):
    base = {"queryName": "A", "expression": "A", "dataSource": "logs", "aggregateOperator": "count"}
    return {**base, **more}


KEY = {"key": "x", "dataType": "string", "type": "tag", "isColumn": False}

BAD = [
    (query(queryName=""), "queryName is missing"),
    (query(dataSource="disk"), "no data source is called 'disk'"),
    (query(aggregateOperator="median"), "no aggregation is called 'median'"),
    (query(dataSource="metrics", aggregateOperator="sum"), "needs an attribute"),
    (query(filters={"op": "XOR", "items": []}), "joined by AND or OR"),
    (query(filters={"op": "AND", "items": [{"key": {"key": ""}, "op": "="}]}), "filter 1: it has no name"),
    (query(groupBy=[KEY, {**KEY, "dataType": "date"}]), "grouping 2: no data type is called 'date'"),
    (query(groupBy=[{**KEY, "isColumn": True, "type": ""}]), "must be a tag or a resource"),
    (query(selectColumns=[{**KEY, "key": ""}]), "selected column 1: it has no name"),
    (query(dataSource="metrics", aggregateOperator="noop", groupBy=[KEY]), "cannot be grouped"),
    (query(expression=""), "expression is missing"),
]


@pytest.mark.parametrize("spec,message", BAD)
def test_bad_specs(spec, message):
    with pytest.raises(S.InvalidSpec, match=message.replace("(", r"\(")):
        S.check_builder_query(spec)


@pytest.mark.parametrize("operator", S.AGGREGATIONS)
@pytest.mark.parametrize("source", S.DATA_SOURCES)
def test_attribute_requirement(operator, source):
    free = source != "metrics" or operator in ("noop", "count", "count_distinct")
    assert S.requires_attribute(operator, source) != free


def test_composites():
    graph = {"panelType": "graph", "queryType": "builder"}
    bad = [
        (graph, "there is no query"),
        ({**graph, "builderQueries": {"A": {}}}, "query A: queryName is missing; query A: expression is missing"),
        ({**graph, "promQueries": {"B": {"query": ""}}}, "query B: its text is missing"),
        ({**graph, "builderQueries": {"A": query()}, "panelType": "pie"}, "no panelType is called 'pie'"),
        ({**graph, "builderQueries": {"A": query()}, "queryType": "unknown"}, "no queryType is called 'unknown'"),
    ]
    for composite, message in bad:
        with pytest.raises(S.InvalidSpec, match=message):
            S.check_composite(composite)


def points(spark, rows):
    return spark.createDataFrame(rows, "labels string, ts bigint, value double")


@pytest.mark.parametrize("text", ["A; drop", "__import__('os')", "A.B", "A if A else 1", "C + 1", "A +", "lambda: 1"])
def test_formula_grammar(spark, text):
    with pytest.raises(S.InvalidSpec):
        B.run_formula({"A": points(spark, [("{}", 1, 2.0)])}, text, "F")


def test_formula_values(spark):
    a, b = points(spark, [("{}", 1, 6.0), ("{}", 2, 1.0), ("x", 1, 1.0)]), points(spark, [("{}", 1, 2.0), ("{}", 2, 0.0)])
    rows = B.run_formula({"A": a, "B": b}, "-(A / B) + sqrt(4) * 10", "F").collect()
    assert [(r["query_name"], r["ts"], r["value"]) for r in rows] == [("F", 1, 17.0)]


def test_counter_reset(spark):
    df = spark.createDataFrame([("s", 0, 5.0), ("s", 1000, 9.0), ("s", 3000, 2.0)], "series string, ts bigint, v double")
    assert sorted((r["ts"], r["v"]) for r in B.counter_rate(df, ["series"]).collect()) == [(1000, 4.0), (3000, 1.0)]


def test_open_bucket_gives_its_lower_bound(spark):
    df = spark.createDataFrame([("g", 10.0, 1.0), ("g", float("inf"), 4.0)], "g string, le double, v double")
    assert B.histogram_quantile(df, ["g"], 0.9).first()["value"] == 10.0
    assert B.histogram_quantile(df, ["g"], 0.125).first()["value"] == 5.0


@pytest.mark.parametrize("value,text", [(1e7, "10000000"), (0.00012, "0.00012"), (-2.50, "-2.5"), (3.0, "3"), (0.0, "0"), (1e16, "10000000000000000")])
def test_point_text(spark, value, text):
    assert spark.range(1).select(B.point_text(F.lit(value)).alias("x")).first()["x"] == text


def test_unknown_operators(spark):
    with pytest.raises(S.InvalidSpec):
        B.match_series(points(spark, []), {"op": ">=", "target": 1, "matchType": "1"})
    with pytest.raises(ValueError):
        R.tag_predicate("a", R.SPAN, "Near", ["x"])
    with pytest.raises(ValueError):
        P.set_op(*[spark.createDataFrame([], "labels map<string,string>, ts bigint, value double")] * 2, "xor")


def test_scalar_of_several_series_is_not_a_number(spark):
    df = spark.createDataFrame([({"a": "1"}, 1, 2.0), ({"a": "2"}, 1, 3.0), ({"a": "1"}, 2, 4.0)], "labels map<string,string>, ts bigint, value double")
    got = {r["ts"]: r["value"] for r in P.scalar(df).collect()}
    assert got[2] == 4.0 and got[1] != got[1]


def test_approximate_aggregations(spark):
    rows = [("a", i, float(i)) for i in range(1000)]
    logs = spark.createDataFrame(rows, "id string, n bigint, v double").select(
        "id", (F.col("n") * 1_000_000).alias("timestamp"), F.create_map(F.lit("v"), F.col("v")).alias("attributes_number")
    )
    value = {"key": "v", "dataType": "float64", "type": "tag", "isColumn": False}
    for operator, exact in (("count_distinct", 1000.0), ("p50", 499.5)):
        spec = query(aggregateOperator=operator, aggregateAttribute=value, stepInterval=60)
        run = lambda approximate, spec=spec: B.run_builder_query({"logs": B.logs_source(logs)}, spec, 0, 60_000, approximate=approximate).first()["value"]
        assert run(False) == exact
        assert abs(run(True) - exact) <= 0.1 * exact


def test_every_query_disabled(spark):
    logs = spark.createDataFrame([("a", 1)], "id string, timestamp bigint")
    composite = {"builderQueries": {"A": query(disabled=True)}, "panelType": "graph", "queryType": "builder"}
    with pytest.raises(S.InvalidSpec, match="disabled"):
        B.run_composite({"logs": B.logs_source(logs)}, composite, 0, 10)
