"""Renaming log fields (underscore to dotted spelling) in documents.

The field references of a document are joined against the field mapping and come
back as a map in its row. Only documents that refer to a mapped field are written
anew, each once, and of their text only the levels above a change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions import variants as V
from telemorph.operators.documents import STRING_MAP
from telemorph.operators.sizing import broadcast_if_small

# ---- references ------------------------------------------------------------------------


def reference(kind: Column, dtype: Column, name: Column) -> Column:
    """Lookup key of a field reference, as ``fields.field_mapping`` builds it."""
    group = F.when(kind == "tag", F.lit("attributes")).otherwise(F.lit("resources"))
    return F.concat_ws("_", group, F.lower(dtype), name)


def _attribute_reference(attribute: Column) -> Column:
    kind, dtype, name = (V.text(V.field(attribute, f)) for f in ("type", "dataType", "key"))
    return F.when(kind.isNotNull() & dtype.isNotNull() & name.isNotNull(), reference(kind, dtype, name))


# An array lookup in SQL text, and a word that may be a promoted column.
_LOOKUP = r"(attributes|resources)_(\w+?)_key,(\s*)'([^']*)'"
_SQL_PIECES = rf"{_LOOKUP}|\w+|\W"
_PROMOTED = r"\A(attribute|resource)_(\w+?)(_exists)?\z"


def _lookup_reference(piece: Column) -> Column:
    parts = [F.regexp_extract(piece, _LOOKUP, i) for i in (1, 2, 4)]
    return F.when(piece.rlike(rf"\A{_LOOKUP}\z"), F.concat_ws("_", *parts))


def _column_reference(piece: Column) -> Column:
    group, rest = F.regexp_extract(piece, _PROMOTED, 1), F.regexp_extract(piece, _PROMOTED, 2)
    return F.when(piece.rlike(_PROMOTED), F.concat(group, F.lit("s_"), rest))


def sql_references(text: Column) -> Column:
    pieces = F.transform(
        F.regexp_extract_all(text, F.lit(_SQL_PIECES), F.lit(0)),
        lambda p: F.coalesce(_lookup_reference(p), _column_reference(p)),
    )
    return F.array_compact(pieces)


def _builder_references(entry: Column) -> Column:
    filters = V.no_items(V.items(V.path(entry, "filters", "items")), "variant")
    groups = V.no_items(V.items(V.field(entry, "groupBy")), "variant")
    attributes = F.concat(
        F.array(V.field(entry, "aggregateAttribute")), F.transform(filters, lambda i: V.field(i, "key")), groups
    )
    return F.array_compact(F.transform(attributes, _attribute_reference))


def resolve_fields(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Reference rows (with ``ref``) joined to their new name."""
    known, _ = broadcast_if_small(mapping.select("ref", "new_name"))
    return refs.join(known, "ref")


def _attach(docs: DataFrame, refs: Column, mapping: DataFrame, key: str, data: str) -> DataFrame:
    """Add ``_doc`` and ``_fields``. Documents are moved as text and parsed where
    they are read."""
    docs = docs.repartition(F.col(key))
    mentioned = V.evaluated(docs.select(key, data), _doc=F.try_parse_json(data)).select(key, F.explode(F.array_distinct(refs)).alias("ref"))
    found = resolve_fields(mentioned, mapping)
    maps = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ref", "new_name"))).alias("_fields"))
    empty = F.create_map().cast(STRING_MAP)
    joined = docs.join(maps, key, "left").withColumn("_fields", F.coalesce("_fields", empty))
    return V.evaluated(joined, _doc=F.try_parse_json(data))


# ---- renaming -----------------------------------------------------------------------------


def rename_attribute(attribute: Column, fields: Column) -> Column:
    """A key object under its dotted name; anything else unchanged."""

    def renamed(ref: Column) -> Column:
        new = F.try_element_at(fields, ref)
        return F.when(new.isNotNull(), V.edit_fields(attribute, {"key": lambda _: new.cast("variant")})).otherwise(attribute)

    return V.let(_attribute_reference(attribute), renamed)


def rename_log_fields_sql(text: Column, fields: Column, table: str) -> Column:
    """Rename lookups by key and promoted columns in an SQL text that reads the
    log table; whole names only. A promoted column takes its ``_exists`` column
    along."""

    def renamed(piece: Column) -> Column:
        by_key = F.try_element_at(fields, _lookup_reference(piece))
        by_column = F.try_element_at(fields, _column_reference(piece))
        head, rest, exists = (F.regexp_extract(piece, _PROMOTED, i) for i in (1, 2, 3))
        dtype = F.substring(rest, F.lit(1), F.length(rest) - F.length(by_column))
        column = F.concat(head, F.lit("_"), dtype, F.replace(by_column, F.lit("."), F.lit("$$")), exists)
        lookup = F.concat(
            F.regexp_extract(piece, r"\A([^']*)'", 1), F.lit("'"), by_key, F.lit("'")
        )
        return F.coalesce(F.when(by_key.isNotNull(), lookup), F.when(by_column.isNotNull(), column), piece)

    rewritten = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_SQL_PIECES), F.lit(0)), renamed), "")
    return F.when(F.contains(text, F.lit(table)), rewritten).otherwise(text)


def _group_renames(entries: Column, fields: Column) -> Column:
    """Old to new name of every renamed group-by key of the given log queries."""
    keys = F.flatten(F.transform(entries, lambda e: V.no_items(V.items(V.field(e, "groupBy")), "variant")))
    pairs = F.transform(
        keys,
        lambda k: F.struct(V.text(V.field(k, "key")).alias("old"), F.try_element_at(fields, _attribute_reference(k)).alias("new")),
    )
    return F.map_from_entries(F.filter(pairs, lambda p: p["new"].isNotNull()))


def _legend(text: Column, renames: Column) -> Column:
    """``{{old}}`` to ``{{new}}``."""
    pieces = F.regexp_extract_all(text, F.lit(r"(?s)\{\{.*?\}\}|[^{]+|\{"), F.lit(0))

    def renamed(piece: Column) -> Column:
        new = F.try_element_at(renames, F.substring(piece, F.lit(3), F.length(piece) - 4))
        return F.coalesce(F.when(F.startswith(piece, F.lit("{{")), F.concat(F.lit("{{"), new, F.lit("}}"))), piece)

    return F.array_join(F.transform(pieces, renamed), "")


def _legend_edit(renames: Column):
    return lambda v: F.coalesce(_legend(V.text(v), renames).cast("variant"), v)


def _builder_edit(entry: Column, fields: Column, renames: Column) -> Column:
    def rename(attribute: Column) -> Column:
        return rename_attribute(attribute, fields)

    def order(item: Column) -> Column:
        return V.edit_fields(
            item, {"columnName": lambda v: F.coalesce(F.try_element_at(renames, V.text(v)).cast("variant"), v)}
        )

    return V.edit_fields(
        entry,
        {
            "aggregateAttribute": rename,
            "filters": lambda f: V.edit_fields(f, {"items": lambda a: V.edit_items(a, lambda i: V.edit_fields(i, {"key": rename}))}),
            "groupBy": lambda a: V.edit_items(a, rename),
            "orderBy": lambda a: V.edit_items(a, order),
            "legend": _legend_edit(renames),
        },
    )


def _differs(old: Column, new: Column) -> Column:
    return F.coalesce(new != old, F.lit(False))


def _legend_differs(legend: Column, renames: Column) -> Column:
    return _differs(V.text(legend), _legend(V.text(legend), renames))


def _builder_differs(entry: Column, fields: Column, renames: Column) -> Column:
    """Whether ``_builder_edit`` changes the entry."""
    items = V.no_items(V.items(V.path(entry, "filters", "items")), "variant")
    groups, orders = (V.no_items(V.items(V.field(entry, name)), "variant") for name in ("groupBy", "orderBy"))
    attributes = F.concat(F.array(V.field(entry, "aggregateAttribute")), F.transform(items, lambda i: V.field(i, "key")), groups)

    def renamed(attribute: Column) -> Column:
        return _differs(V.text(V.field(attribute, "key")), F.try_element_at(fields, _attribute_reference(attribute)))

    def reordered(item: Column) -> Column:
        return V.let(V.text(V.field(item, "columnName")), lambda name: _differs(name, F.try_element_at(renames, name)))

    return F.exists(attributes, renamed) | F.exists(orders, reordered) | _legend_differs(V.field(entry, "legend"), renames)


def _reads_logs(entry: Column) -> Column:
    return F.coalesce(V.text(V.field(entry, "dataSource")) == "logs", F.lit(False))


def _finish(done: DataFrame, new: Column, key: str, data: str, changes: Column | None = None) -> DataFrame:
    """Without a mapped field no edit changes anything, so none is tried. Writing a
    document costs most: where ``changes`` tells whether there is something to
    change, only such documents are written, and none twice to compare it."""
    mapped = F.size("_fields") > 0
    if changes is None:
        edited = V.evaluated(done, _new=F.when(mapped, new), _old=F.when(mapped, F.to_json("_doc")))
        edited = V.evaluated(edited, changed=F.coalesce(F.col("_new") != F.col("_old"), F.lit(False)))
    else:
        edited = V.evaluated(done, changed=F.when(mapped, F.coalesce(changes, F.lit(False))).otherwise(F.lit(False)))
        edited = V.evaluated(edited, _new=F.when(F.col("changed"), new))
    return edited.select(
        key,
        F.when(F.col("changed"), F.col("_new")).otherwise(F.col(data)).alias(data),
        "changed",
        F.when(~V.is_object(F.col("_doc")), F.lit("invalid JSON")).alias("error"),
    )


# Where a panel refers to fields: cast once, and no other field is touched.
_PANEL = "struct<query:struct<builder:struct<queryData:array<variant>>,clickhouse_sql:array<struct<query:variant>>>>"


def rename_log_fields_dashboards(docs: DataFrame, mapping: DataFrame, table: str, key: str = "id", data: str = "data") -> DataFrame:
    """Rename log fields in the panels of dashboards: builder queries on logs with
    their order and legends, and SQL that reads ``table``."""
    doc = F.col("_doc")
    panels = F.try_variant_get(doc, "$.widgets", f"array<{_PANEL}>")
    fields = F.col("_fields")

    def refs(widget: Column) -> Column:
        builder = V.no_items(widget["query"]["builder"]["queryData"], "variant")
        sql = V.no_items(widget["query"]["clickhouse_sql"], "struct<query:variant>")
        return F.concat(
            F.flatten(F.transform(builder, _builder_references)),
            F.flatten(F.transform(sql, lambda e: V.no_items(sql_references(V.text(e["query"])), "string"))),
        )

    found = F.flatten(F.transform(V.no_items(panels, _PANEL), refs))
    joined = _attach(docs, found, mapping, key, data)

    def sql_entry(entry: Column) -> Column:
        return V.json_fields(
            entry, {"query": lambda v: F.to_json(F.coalesce(rename_log_fields_sql(V.text(v), fields, table).cast("variant"), v))}
        )

    def builder(value: Column) -> Column:
        on_logs = F.filter(V.no_items(V.items(V.field(value, "queryData")), "variant"), _reads_logs)

        def edited(renames: Column) -> Column:
            legend = _legend_edit(renames)
            return V.json_fields(
                value,
                {
                    "queryData": lambda a: V.json_items(
                        a, lambda e: F.to_json(F.when(_reads_logs(e), _builder_edit(e, fields, renames)).otherwise(e))
                    ),
                    "queryFormulas": lambda a: V.json_items(a, lambda f: V.json_fields(f, {"legend": lambda v: F.to_json(legend(v))})),
                },
            )

        return F.when(F.size(on_logs) > 0, V.let(_group_renames(on_logs, fields), edited)).otherwise(F.to_json(value))

    def query(value: Column) -> Column:
        kind = V.text(V.field(value, "queryType"))
        return (
            F.when(V.field(value, "builder").isNull(), F.to_json(value))
            .when(kind == "clickhouse_sql", V.json_fields(value, {"clickhouse_sql": lambda a: V.json_items(a, sql_entry)}))
            .when(kind == "builder", V.json_fields(value, {"builder": builder}))
            .otherwise(F.to_json(value))
        )

    def builder_differs(value: Column) -> Column:
        on_logs = F.filter(V.no_items(V.items(V.field(value, "queryData")), "variant"), _reads_logs)
        formulas = V.no_items(V.items(V.field(value, "queryFormulas")), "variant")

        def differs(renames: Column) -> Column:
            entries = F.exists(on_logs, lambda e: _builder_differs(e, fields, renames))
            return entries | F.exists(formulas, lambda f: _legend_differs(V.field(f, "legend"), renames))

        return F.when(F.size(on_logs) > 0, V.let(_group_renames(on_logs, fields), differs)).otherwise(F.lit(False))

    def query_differs(value: Column) -> Column:
        kind = V.text(V.field(value, "queryType"))
        texts = F.transform(V.no_items(V.items(V.field(value, "clickhouse_sql")), "variant"), lambda e: V.text(V.field(e, "query")))
        return (
            F.when(V.field(value, "builder").isNull(), F.lit(False))
            .when(kind == "clickhouse_sql", F.exists(texts, lambda q: _differs(q, rename_log_fields_sql(q, fields, table))))
            .when(kind == "builder", builder_differs(V.field(value, "builder")))
            .otherwise(F.lit(False))
        )

    new = V.json_fields(doc, {"widgets": lambda a: V.json_items(a, lambda w: V.json_fields(w, {"query": query}))})
    queries = F.try_variant_get(doc, "$.widgets", "array<struct<query:variant>>")
    return _finish(joined, new, key, data, F.exists(queries, lambda w: F.coalesce(query_differs(w["query"]), F.lit(False))))


def rename_log_fields_alerts(docs: DataFrame, mapping: DataFrame, table: str, key: str = "id", data: str = "data") -> DataFrame:
    """The same for alert rules; formulas (entries whose expression is not their
    own name) get their legend renamed."""
    doc = F.col("_doc")
    composite = V.path(doc, "condition", "compositeQuery")
    fields = F.col("_fields")
    queries = V.no_items(F.map_values(V.entries(V.field(composite, "builderQueries"))), "variant")
    sql_entries = V.no_items(F.map_values(V.entries(V.field(composite, "chQueries"))), "variant")
    in_sql = F.flatten(F.transform(sql_entries, lambda e: V.no_items(sql_references(V.text(V.field(e, "query"))), "string")))
    refs = F.concat(F.flatten(F.transform(queries, _builder_references)), in_sql)
    joined = _attach(docs, refs, mapping, key, data)

    def is_query(entry: Column, name: Column) -> Column:
        return F.coalesce(V.text(V.field(entry, "expression")) == name, F.lit(False))

    def builder_queries(value: Column) -> Column:
        own = F.transform(F.map_entries(V.entries(value)), lambda e: F.when(is_query(e["value"], e["key"]) & _reads_logs(e["value"]), e["value"]))

        def edited(renames: Column) -> Column:
            def one(name: Column, entry: Column) -> Column:
                return (
                    F.when(is_query(entry, name) & _reads_logs(entry), _builder_edit(entry, fields, renames))
                    .when(is_query(entry, name), entry)
                    .otherwise(V.edit_fields(entry, {"legend": _legend_edit(renames)}))
                )

            return F.coalesce(F.to_variant_object(F.transform_values(V.entries(value), one)), value)

        return V.let(_group_renames(V.no_items(F.array_compact(own), "variant"), fields), edited)

    def sql_queries(value: Column) -> Column:
        def one(entry: Column) -> Column:
            return V.edit_fields(
                entry, {"query": lambda v: F.coalesce(rename_log_fields_sql(V.text(v), fields, table).cast("variant"), v)}
            )

        return V.edit_values(value, one)

    kind = V.text(V.field(composite, "queryType"))

    def condition_edit(query: Column) -> Column:
        return (
            F.when(kind == "clickhouse_sql", V.edit_fields(query, {"chQueries": sql_queries}))
            .when(kind == "builder", V.edit_fields(query, {"builderQueries": builder_queries}))
            .otherwise(query)
        )

    new = F.to_json(
        V.edit_fields(doc, {"condition": lambda c: V.edit_fields(c, {"compositeQuery": condition_edit})})
    )
    return _finish(joined, new, key, data)


