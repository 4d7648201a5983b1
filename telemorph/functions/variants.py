"""Editing JSON documents of unknown schema as VARIANT columns.

An edit turns one level of a document into a map or array of variants, changes
the entries it knows, and leaves all others as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRIES = "map<string,variant>"
ITEMS = "array<variant>"


def entries(value: Column) -> Column:
    """The object's entries, NULL if the value is not an object."""
    return value.try_cast(ENTRIES)


def items(value: Column) -> Column:
    return value.try_cast(ITEMS)


def field(value: Column, name: str) -> Column:
    return path(value, name)


def path(value: Column, *names: str) -> Column:
    """The value some fields deep, NULL if there is none. Read by path: a cast to
    entries would copy all the other fields too."""
    return F.try_variant_get(value, ".".join(["$", *names]), "variant")


def text(value: Column) -> Column:
    """The string, NULL for any other kind of value."""
    return F.when(F.schema_of_variant(value) == "STRING", value.try_cast("string"))


def is_true(value: Column) -> Column:
    return F.coalesce(value.try_cast("boolean"), F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def evaluated(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each is computed once per row. The generator
    keeps the optimizer from copying their expressions into every filter and
    projection that uses them."""
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once")
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, packed).select(*kept, *[F.col(f"_once.{n}").alias(n) for n in columns])


def edit_fields(value: Column, edits: dict[str, Callable[[Column], Column]]) -> Column:
    """Change named fields of an object where they are present."""

    def edited(key: Column, old: Column) -> Column:
        chain = None
        for name, change in edits.items():
            chain = (F if chain is None else chain).when(key == name, change(old))
        return chain.otherwise(old)

    return F.coalesce(F.to_variant_object(F.transform_values(entries(value), edited)), value)


def edit_values(value: Column, change: Callable[[Column], Column]) -> Column:
    """Change every value of an object."""
    return F.coalesce(F.to_variant_object(F.transform_values(entries(value), lambda _, old: change(old))), value)


def edit_items(value: Column, change: Callable[[Column], Column]) -> Column:
    """Change every item of an array."""
    return F.coalesce(F.to_variant_object(F.transform(items(value), lambda item: change(item))), value)


def is_object(value: Column) -> Column:
    """Whether it is an object; its fields are not copied."""
    return value.try_cast("struct<_:boolean>").isNotNull()


def json_field(name: Column, text: Column) -> Column:
    """One field of an object's JSON text."""
    quoted = F.when(name.rlike(r"\A\w+\z"), F.concat(F.lit('"'), name, F.lit('"'))).otherwise(F.to_json(name.cast("variant")))
    return F.concat(quoted, F.lit(":"), text)


def json_fields(value: Column, edits: dict[str, Callable[[Column], Column]], **new: Column) -> Column:
    """The JSON text of an object, in which the given edits write the text of the
    fields they name, and ``new`` fields are set. Nothing is built again on the way
    up but one text."""

    def one(entry: Column) -> Column:
        chain = None
        for name, change in edits.items():
            chain = (F if chain is None else chain).when(entry["key"] == name, change(entry["value"]))
        return F.struct(entry["key"], json_field(entry["key"], chain.otherwise(F.to_json(entry["value"]))).alias("json"))

    fields = entries(value)
    if new:
        fields = F.map_concat(fields, F.create_map(*[part for name, column in new.items() for part in (F.lit(name), column.cast("variant"))]))
    written = F.transform(F.map_entries(fields), one)
    if new:
        written = F.array_sort(written)
    text = F.concat(F.lit("{"), F.array_join(F.transform(written, lambda f: f["json"]), ","), F.lit("}"))
    return F.coalesce(text, F.to_json(value))


def json_array(texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def json_items(value: Column, change: Callable[[Column], Column]) -> Column:
    """The JSON text of an array whose items ``change`` writes."""
    return F.coalesce(json_array(F.transform(items(value), lambda item: change(item))), F.to_json(value))


def with_fields(value: Column, **new: Column) -> Column:
    """Set fields of an object, adding those it lacks."""
    pairs = [part for name, column in new.items() for part in (F.lit(name), column.cast("variant"))]
    return F.coalesce(F.to_variant_object(F.map_concat(entries(value), F.create_map(*pairs))), value)


def without_fields(value: Column, *names: str) -> Column:
    kept = F.map_filter(entries(value), lambda key, _: ~key.isin(*names))
    return F.coalesce(F.to_variant_object(kept), value)


def no_items(column: Column, kind: str) -> Column:
    """An empty array of the given element type instead of NULL."""
    return F.coalesce(column, F.array().cast(f"array<{kind}>"))
