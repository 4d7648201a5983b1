"""Upgrading the oldest dashboards and alert rules to the present document form.

Parts whose form changes are read as structs and written anew; everything else
in a document, known or not, is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions import variants as V
from telemorph.functions.scalars import int_div
from telemorph.operators.sizing import spread
from telemorph.plans.legacy_names import legacy_operator, legacy_panel, legacy_query_type, legacy_reduce

STEP_SECONDS = 60
LAYOUT_FLAG = "collapsableRowsMigrated"

_FILTERS = "struct<op:string,items:array<struct<key:string,op:string,value:variant>>>"
_OLD_QUERY = (
    "struct<clickHouse:array<struct<legend:string,name:string,rawQuery:string,disabled:boolean>>,"
    "promQL:array<struct<query:string,disabled:boolean,name:string,legend:string>>,"
    "metricsBuilder:struct<formulas:array<struct<disabled:boolean,expression:string,legend:string,name:string>>,"
    "queryBuilder:array<struct<aggregateOperator:int,disabled:boolean,groupBy:array<string>,legend:string,metricName:string,"
    f"name:string,tagFilters:{_FILTERS},reduceTo:int>>>,queryType:int>"
)
_OLD_RULE_QUERY = (
    f"struct<queryName:string,metricName:string,tagFilters:{_FILTERS},groupBy:array<string>,"
    "aggregateOperator:int,expression:string,disabled:boolean,reduceTo:int>"
)



def _query_name(i: Column) -> Column:
    """A to Z, then AA to ZZ, then three letters, by place from 0."""
    def letter(n: Column) -> Column:
        return F.char(F.lit(65) + F.pmod(n, F.lit(26)))

    pair, triple = i - 26, i - 26 - 26 * 26
    return (
        F.when(i < 26, letter(i))
        .when(i < 26 + 26 * 26, F.concat(letter(F.floor(pair / 26)), letter(pair)))
        .otherwise(F.concat(letter(F.floor(triple / 676)), letter(F.floor(triple / 26)), letter(triple)))
    )

def _or(column: Column, default) -> Column:
    return F.coalesce(column, F.lit(default))


def _each(items: Column, make) -> Column:
    """Transform a possibly missing array into an array of objects."""
    return F.coalesce(F.to_variant_object(F.transform(items, make)), F.parse_json(F.lit("[]")))


def _key(name: Column, dtype: str, kind: str, is_column: bool) -> Column:
    return F.struct(
        _or(name, "").alias("key"),
        F.lit(dtype).alias("dataType"),
        F.lit(kind).alias("type"),
        F.lit(is_column).alias("isColumn"),
    )


def _tag(name: Column) -> Column:
    return _key(name, "string", "tag", False)


def _filter_set(filters: Column, item_id=None) -> Column:
    """Conjunction of the old filters with lower-case operators."""

    def item(f: Column, i: Column) -> Column:
        parts = [] if item_id is None else [item_id(i).alias("id")]
        return F.struct(
            *parts,
            _tag(f["key"]).alias("key"),
            F.coalesce(f["value"], F.parse_json(F.lit("null"))).alias("value"),
            F.lower(f["op"]).alias("op"),
        )

    return F.struct(F.lit("AND").alias("op"), _each(filters["items"], item).alias("items"))


def _builder_query(old: Column, name: Column, expression: Column, filters: Column, extra: list[Column]) -> Column:
    return F.struct(
        _or(name, "").alias("queryName"),
        F.lit("metrics").alias("dataSource"),
        legacy_operator(old["aggregateOperator"]).alias("aggregateOperator"),
        _key(old["metricName"], "float64", "", True).alias("aggregateAttribute"),
        F.lit(STEP_SECONDS).alias("stepInterval"),
        filters.alias("filters"),
        _each(old["groupBy"], _tag).alias("groupBy"),
        _or(expression, "").alias("expression"),
        _or(old["disabled"], False).alias("disabled"),
        F.lit(0).alias("limit"),
        F.lit(0).alias("offset"),
        F.lit(0).alias("pageSize"),
        legacy_reduce(old["reduceTo"]).alias("reduceTo"),
        *extra,
    )


def _empty_results() -> Column:
    return F.parse_json(
        F.lit('{"data":{"legend":"","query":"","queryData":[]},"error":false,"errorMessage":"","loading":false}')
    )


# ---- dashboards to the builder model ------------------------------------------------------


def _new_query(old: Column, doc_id: Column, panel: Column) -> Column:
    none = F.parse_json(F.lit("[]"))

    def builder(q: Column, position: Column) -> Column:
        # Filter ids are derived from their place, so that a rerun repeats them.
        item_id = lambda i: F.md5(F.concat_ws("/", doc_id.cast("string"), panel.cast("string"), position.cast("string"), i.cast("string")))
        extra = [none.alias("having"), none.alias("orderBy"), _or(q["legend"], "").alias("legend")]
        return _builder_query(q, q["name"], q["name"], _filter_set(q["tagFilters"], item_id), extra)

    def formula(f: Column) -> Column:
        return F.struct(
            _or(f["disabled"], False).alias("disabled"),
            _or(f["expression"], "").alias("expression"),
            _or(f["legend"], "").alias("legend"),
            _or(f["name"], "").alias("name"),
            _or(f["name"], "").alias("queryName"),
        )

    def sql(q: Column) -> Column:
        return F.struct(_or(q["legend"], "").alias("legend"), _or(q["name"], "").alias("name"), _or(q["rawQuery"], "").alias("rawQuery"), _or(q["disabled"], False).alias("disabled"))

    def prom(q: Column) -> Column:
        return F.struct(_or(q["query"], "").alias("query"), _or(q["disabled"], False).alias("disabled"), _or(q["name"], "").alias("name"), _or(q["legend"], "").alias("legend"))

    return F.to_variant_object(
        F.struct(
            _each(old["clickHouse"], sql).alias("clickhouse_sql"),
            _each(old["promQL"], prom).alias("promql"),
            F.struct(
                _each(old["metricsBuilder"]["formulas"], formula).alias("queryFormulas"),
                _each(old["metricsBuilder"]["queryBuilder"], builder).alias("queryData"),
            ).alias("builder"),
            legacy_query_type(old["queryType"]).alias("queryType"),
        )
    )


def is_builder_dashboard(doc: Column) -> Column:
    """Whether a dashboard is in the present form already: some panel names its
    query type by a string."""
    kind = "struct<query:struct<queryType:variant>>"  # no other part of a panel is copied
    widgets = V.no_items(F.try_variant_get(doc, "$.widgets", f"array<{kind}>"), kind)
    return F.exists(widgets, lambda w: V.text(w["query"]["queryType"]).isNotNull())


def _converted(docs: DataFrame, data: str, skip, convert) -> DataFrame:
    """Apply ``convert`` to the parsed documents; (…, data, changed, error)."""
    doc = F.col("_doc")
    parsed = V.evaluated(spread(docs, data), _doc=F.try_parse_json(data))
    new = F.when(V.is_object(doc) & ~F.coalesce(skip(doc), F.lit(False)), F.to_json(convert(doc)))
    done = V.evaluated(parsed, _new=new)
    done = V.evaluated(done, changed=F.coalesce(F.col("_new") != F.to_json("_doc"), F.lit(False)))
    return done.withColumns(
        {data: F.coalesce("_new", data), "error": F.when(~V.is_object(doc), F.lit("invalid JSON"))}
    ).drop("_doc", "_new")


def upgrade_dashboards_v3(docs: DataFrame, key: str = "id", data: str = "data") -> DataFrame:
    """Legacy dashboards to the builder model: numbers to names, filters and
    grouping to attribute keys, formulas, variable names. Title, unit and time
    preference are kept for every panel."""

    def widget(w: Column, i: Column) -> Column:
        old = V.field(w, "query").try_cast(_OLD_QUERY)
        panel = V.text(V.field(w, "panelTypes"))
        return F.coalesce(
            V.let(
                old,
                lambda q: F.when(
                    q.isNotNull(),
                    V.with_fields(w, query=_new_query(q, F.col(key), i), queryData=_empty_results(), panelTypes=legacy_panel(_or(panel, ""))),
                ),
            ),
            w,
        )

    def convert(doc: Column) -> Column:
        return V.edit_fields(
            doc,
            {
                "variables": lambda v: F.coalesce(
                    F.to_variant_object(F.transform_values(V.entries(v), lambda k, x: V.with_fields(x, name=k))), v
                ),
                "widgets": lambda a: F.coalesce(F.to_variant_object(F.transform(V.items(a), widget)), a),
            },
        )

    return _converted(docs, data, is_builder_dashboard, convert)


# ---- alert rules to the builder model -------------------------------------------------------

# Nanoseconds per unit of a duration text (fixed values).
UNITS = {
    "ns": 1, "us": 1_000, "µs": 1_000, "ms": 1_000_000, "s": 1_000_000_000,
    "m": 60_000_000_000, "h": 3_600_000_000_000,
}


def duration_ns(value: Column) -> Column:
    """A duration as nanoseconds: a number, or a text like ``1h30m``. NULL if it
    is neither."""
    texts = V.text(value)
    part = r"([0-9]*\.?[0-9]+)(ns|us|µs|ms|s|m|h)"
    units = F.create_map(*[F.lit(x) for k, v in UNITS.items() for x in (k, v)])
    total = F.aggregate(
        F.regexp_extract_all(texts, F.lit(part), F.lit(0)),
        F.lit(0).cast("decimal(38,9)"),
        lambda acc, p: (
            acc + F.regexp_extract(p, part, 1).cast("decimal(28,9)") * F.try_element_at(units, F.regexp_extract(p, part, 2)).cast("decimal(15,0)")
        ).cast("decimal(38,9)"),
    ).cast("bigint")
    signed = F.when(F.startswith(texts, F.lit("-")), -total).otherwise(total)
    valid = texts.rlike(rf"\A[+-]?(?:0|(?:{part})+)\z")
    return F.when(texts.isNotNull(), F.when(valid, signed)).otherwise(value.try_cast("double").try_cast("bigint"))


def duration_text(ns: Column) -> Column:
    """Canonical text of nanoseconds: ``5m0s``, ``1h30m0s``, ``1.5s``, ``20ms``."""

    def trimmed(whole: Column, fraction: Column, digits: int, unit: str) -> Column:
        rest = F.regexp_replace(F.lpad(fraction.cast("string"), digits, "0"), r"0+\z", "")
        return F.concat(whole.cast("string"), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit(unit))

    def scaled(size: Column, unit_ns: int, digits: int, unit: str) -> Column:
        return trimmed(int_div(size, unit_ns), size % unit_ns, digits, unit)

    def shown(size: Column) -> Column:
        seconds = int_div(size, UNITS["s"])
        rest = trimmed(seconds % 60, size % UNITS["s"], 9, "s")
        minutes = int_div(seconds, 60)
        hours = int_div(minutes, 60)
        return (
            F.when(size == 0, "0s")
            .when(size < UNITS["us"], F.concat(size.cast("string"), F.lit("ns")))
            .when(size < UNITS["ms"], scaled(size, UNITS["us"], 3, "µs"))
            .when(size < UNITS["s"], scaled(size, UNITS["ms"], 6, "ms"))
            .when(minutes == 0, rest)
            .when(hours == 0, F.concat(minutes.cast("string"), F.lit("m"), rest))
            .otherwise(F.concat(hours.cast("string"), F.lit("h"), (minutes % 60).cast("string"), F.lit("m"), rest))
        )

    return F.concat(F.when(ns < 0, "-").otherwise(""), V.let(F.abs(ns), shown))


def normal_duration(value: Column) -> Column:
    return F.coalesce(duration_text(duration_ns(value)).cast("variant"), value)


def upgrade_rules_v3(docs: DataFrame, key: str = "id", data: str = "data") -> DataFrame:
    """Legacy alert rules to the builder model, with durations as canonical text.
    Rules that hold no legacy query are left as they are."""

    def values(value: Column, make) -> Column:
        return F.coalesce(
            F.to_variant_object(F.transform_values(V.entries(value), lambda _, x: make(x))), F.parse_json(F.lit("{}"))
        )

    def sql(x: Column) -> Column:
        return F.to_variant_object(
            F.struct(_or(V.text(V.field(x, "query")), "").alias("query"), V.is_true(V.field(x, "disabled")).alias("disabled"))
        )

    def prom(x: Column) -> Column:
        stats = V.text(V.field(x, "stats"))
        base = sql(x)
        return F.when(_or(stats, "") != "", V.with_fields(base, stats=stats)).otherwise(base)

    def builder(x: Column) -> Column:
        old = x.try_cast(_OLD_RULE_QUERY)
        return V.let(old, lambda q: F.to_variant_object(_builder_query(q, q["queryName"], q["expression"], _filter_set(q["tagFilters"]), [])))

    def condition(c: Column) -> Column:
        old = V.field(c, "compositeMetricQuery")
        new = F.to_variant_object(
            F.struct(
                values(V.field(old, "builderQueries"), builder).alias("builderQueries"),
                values(V.field(old, "chQueries"), sql).alias("chQueries"),
                values(V.field(old, "promQueries"), prom).alias("promQueries"),
                legacy_panel(V.field(old, "panelType").try_cast("int"), numbered=True).alias("panelType"),
                legacy_query_type(V.field(old, "queryType").try_cast("int")).alias("queryType"),
            )
        )
        return V.with_fields(V.without_fields(c, "compositeMetricQuery"), compositeQuery=new)

    def convert(doc: Column) -> Column:
        return V.edit_fields(doc, {"evalWindow": normal_duration, "frequency": normal_duration, "condition": condition})

    return _converted(docs, data, lambda doc: V.path(doc, "condition", "compositeMetricQuery").isNull(), convert)


# ---- PromQL-only dashboards -------------------------------------------------------------------


def is_multi_language(doc: Column) -> Column:
    widgets = V.no_items(V.items(V.field(doc, "widgets")), "variant")
    return F.exists(widgets, lambda w: V.entries(V.field(w, "query")).isNotNull())


# A panel's other languages start with one empty query named A (fixed values).
_PLACEHOLDER_SQL = '[{"legend":"","name":"A","rawQuery":"","disabled":false}]'
_PLACEHOLDER_BUILDER = (
    '{"formulas":[],"queryBuilder":[{"aggregateOperator":1,"disabled":false,"groupBy":[],"legend":"","metricName":"",'
    '"name":"A","tagFilters":{"op":"AND","items":[]},"reduceTo":1}]}'
)


def upgrade_dashboards_promql(docs: DataFrame, data: str = "data") -> DataFrame:
    """Dashboards whose panels hold a plain list of PromQL queries to panels with
    all three languages; queries are named A, B, C, ..."""

    def widget(w: Column) -> Column:
        old = V.items(V.field(w, "query"))

        def prom(q: Column, i: Column) -> Column:
            return F.struct(
                _or(V.text(V.field(q, "query")), "").alias("query"),
                F.lit(False).alias("disabled"),
                _query_name(i).alias("name"),
                _or(V.text(V.field(q, "legend")), "").alias("legend"),
            )

        query = F.to_variant_object(
            F.struct(
                F.parse_json(F.lit(_PLACEHOLDER_SQL)).alias("clickHouse"),
                _each(old, prom).alias("promQL"),
                F.parse_json(F.lit(_PLACEHOLDER_BUILDER)).alias("metricsBuilder"),
                F.lit(3).alias("queryType"),
            )
        )
        return V.with_fields(w, query=query, queryData=_empty_results(), queryType=F.lit(3))

    return _converted(
        docs, data, is_multi_language, lambda doc: V.edit_fields(doc, {"widgets": lambda a: V.edit_items(a, widget)})
    )


# ---- layout ---------------------------------------------------------------------------------------


def repair_layout(docs: DataFrame, data: str = "data") -> DataFrame:
    """Give every panel its layout entry: the first entry, from the panel's own
    place on, whose id is the panel's, contains it, is empty, ``empty`` or the
    entry's number gets the panel's id."""

    def convert(doc: Column) -> Column:
        panels = F.transform(
            V.no_items(V.items(V.field(doc, "widgets")), "variant"),
            lambda w, i: F.struct(i.alias("place"), _or(V.text(V.field(w, "id")), "").alias("panel_id")),
        )

        def assign(layout: Column, panel: Column) -> Column:
            fits = F.transform(
                layout,
                lambda e, j: (j >= panel["place"])
                & V.let(
                    _or(V.text(V.field(e, "i")), ""),
                    lambda i: F.contains(i, panel["panel_id"]) | i.isin("", "empty") | (i == (j + 1).cast("string")),
                ),
            )
            return V.let(
                F.array_position(fits, True) - 1,
                lambda at: F.transform(
                    layout, lambda e, j: F.when(j == at, V.with_fields(e, i=panel["panel_id"])).otherwise(e)
                ),
            )

        return V.edit_fields(
            doc, {"layout": lambda a: F.coalesce(F.to_variant_object(F.aggregate(panels, V.items(a), assign)), a)}
        )

    return _converted(docs, data, lambda doc: F.lit(False), convert)


def double_layout_height(docs: DataFrame, data: str = "data") -> DataFrame:
    """Double the height of every layout entry, once per document."""

    def entry(e: Column) -> Column:
        return V.edit_fields(e, {"h": lambda h: F.coalesce((h.try_cast("bigint") * 2).cast("variant"), h)})

    def convert(doc: Column) -> Column:
        return V.with_fields(V.edit_fields(doc, {"layout": lambda a: V.edit_items(a, entry)}), **{LAYOUT_FLAG: F.lit(True)})

    return _converted(docs, data, lambda doc: V.is_true(V.field(doc, LAYOUT_FLAG)), convert)
