"""Faults of builder queries and of requests, over tables of specifications.

The rules are those of ``plans/spec.py``, which checks one specification before
its job starts; here they are column expressions over JSON text, so a whole
table of stored specifications is checked in one pass, one row per fault.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.plans import spec as S

KEY = "struct<key:string,dataType:string,type:string,isColumn:boolean>"
QUERY = (
    f"struct<queryName:string,expression:string,dataSource:string,aggregateOperator:string,aggregateAttribute:{KEY},"
    f"filters:struct<op:string,items:array<struct<key:{KEY}>>>,groupBy:array<{KEY}>,selectColumns:array<{KEY}>>"
)
REQUEST = f"struct<builderQueries:map<string,{QUERY}>,chQueries:map<string,struct<query:string>>,promQueries:map<string,struct<query:string>>,panelType:string,queryType:string>"
UNREADABLE = "it is no JSON object"


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _quoted(before: str, value: Column, after: str = "") -> Column:
    return F.concat(F.lit(f"{before}'"), _text(value), F.lit(f"'{after}"))


def _found(*faults: Column) -> Column:
    return F.array_compact(F.array(*faults))


def _empty(faults: Column) -> Column:
    return F.coalesce(faults, F.array().cast("array<string>"))


def key_faults(key: Column) -> Column:
    """What is wrong with an attribute key, as an array of texts."""
    kind = _text(key["dataType"])
    column = F.coalesce(key["isColumn"], F.lit(False)) & ~_text(key["type"]).isin("tag", "resource")
    return _found(
        F.when(_text(key["key"]) == "", F.lit("it has no name")),
        F.when(~kind.isin(S.DATA_TYPES), _quoted("no data type is called ", kind)),
        F.when(column, F.lit("a column must be a tag or a resource")),
    )


def _keys_at(place: str, keys: Column, key: Callable[[Column], Column]) -> Column:
    """Faults of a list of keys, with the place of each."""

    def numbered(item: Column, i: Column) -> Column:
        return F.transform(key_faults(key(item)), lambda fault: F.concat(F.lit(f"{place} "), (i + 1).cast("string"), F.lit(": "), fault))

    return _empty(F.flatten(F.transform(keys, numbered)))


def query_faults(query: Column) -> Column:
    """What is wrong with a builder query, as an array of texts; one that only
    names others in its expression needs no source of its own."""
    name, expression = _text(query["queryName"]), _text(query["expression"])
    source, operator = _text(query["dataSource"]), _text(query["aggregateOperator"])
    attribute = query["aggregateAttribute"]
    given = (F.concat(*[_text(attribute[c]) for c in ("key", "dataType", "type")]) != "") | F.coalesce(attribute["isColumn"], F.lit(False))
    needs = (source == "metrics") & ~operator.isin("noop", "count", "count_distinct")
    own = name == expression
    grouped = F.coalesce(F.size(query["groupBy"]), F.lit(0)) > 0
    first = _found(
        F.when(name == "", F.lit("queryName is missing")),
        F.when(expression == "", F.lit("expression is missing")),
        F.when(own & ~source.isin(S.DATA_SOURCES), _quoted("no data source is called ", source)),
        F.when(own & ~operator.isin(S.AGGREGATIONS), _quoted("no aggregation is called ", operator)),
        F.when(own & needs & ~given, _quoted("", operator, " over metrics needs an attribute")),
        F.when(~_text(query["filters"]["op"]).isin("", "AND", "OR"), F.lit("filters are joined by AND or OR")),
    )
    last = _found(F.when((source == "metrics") & grouped & operator.isin("noop", "rate"), _quoted("", operator, " over metrics cannot be grouped")))
    return F.concat(
        first,
        _keys_at("filter", query["filters"]["items"], lambda item: item["key"]),
        _keys_at("grouping", query["groupBy"], lambda key: key),
        _keys_at("selected column", query["selectColumns"], lambda key: key),
        last,
    )


def _listed(specs: DataFrame, kind: str, faults: Callable[[Column], Column], key: str, data: str) -> DataFrame:
    """(key, fault) for every fault of a table of specifications."""
    readable = F.try_parse_json(data).try_cast("map<string,variant>").isNotNull()
    parsed = specs.select(key, readable.alias("_readable"), F.from_json(data, kind).alias("_spec"))
    every = F.when(F.col("_readable"), faults(F.col("_spec"))).otherwise(F.array(F.lit(UNREADABLE)))
    return parsed.select(key, F.explode(every).alias("fault"))


def list_query_faults(specs: DataFrame, key: str = "id", data: str = "data") -> DataFrame:
    """Faults of builder queries stored as JSON text; faultless ones have no row."""
    return _listed(specs, QUERY, query_faults, key, data)


def list_request_faults(specs: DataFrame, key: str = "id", data: str = "data") -> DataFrame:
    """Faults of requests of several queries stored as JSON text."""

    def faults(request: Column) -> Column:
        def named(entry: Column, found: Column) -> Column:
            return F.transform(found, lambda fault: F.concat(F.lit("query "), entry["key"], F.lit(": "), fault))

        builder = F.transform(F.map_entries(request["builderQueries"]), lambda e: named(e, query_faults(e["value"])))
        texts = [
            F.transform(F.map_entries(request[field]), lambda e: named(e, _found(F.when(_text(e["value"]["query"]) == "", F.lit("its text is missing")))))
            for field in ("chQueries", "promQueries")
        ]
        none = request["builderQueries"].isNull() & request["chQueries"].isNull() & request["promQueries"].isNull()
        return F.concat(
            *[_empty(F.flatten(x)) for x in (builder, *texts)],
            _found(
                F.when(none, F.lit("there is no query")),
                *[
                    F.when(~_text(request[field]).isin(known), _quoted(f"no {field} is called ", request[field]))
                    for field, known in (("panelType", S.PANEL_TYPES), ("queryType", S.QUERY_TYPES))
                ],
            ),
        )

    return _listed(specs, REQUEST, faults, key, data)
