"""Renaming metrics and attributes in dashboards and alert rules.

Documents are rows of (id, data). Their parts (the query of a panel, variables, a
rule's composite query, labels) are taken out and each distinct part is rewritten
once; so are the distinct texts of the parts (queries, legends, builder entries).
The names a text mentions are joined against the name mapping and come back as
small maps in its row. New texts and parts are joined to what holds the old ones
and put in their places. Neither they nor the mapping are gathered or broadcast by
force, however large they are, and what a row carries is bounded by the text of
its document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions import rewrite as R
from telemorph.functions import variants as V
from telemorph.operators.sizing import staged

STRING_MAP = "map<string,string>"
MIGRATED = "dotMigrated"


@dataclass
class NameMapping:
    """``metrics`` (norm_name, orig_name), ``attributes`` per metric (norm_name,
    norm_key, orig_key), ``everywhere`` (norm_key, orig_key)."""

    metrics: DataFrame
    attributes: DataFrame
    everywhere: DataFrame


def mapping_from(tables: dict[str, DataFrame]) -> NameMapping:
    """The mapping found by ``metrics.name_mapping``."""
    known = tables["pairs"].where("orig_name is not null").select("norm_name", "orig_name")
    return NameMapping(known, tables["attributes"].select("norm_name", "norm_key", "orig_key"), tables["global"])


@dataclass
class Names:
    """The part of the mapping one document needs, as columns of its row."""

    metrics: Column
    everywhere: Column
    words: Column
    exact: Column
    attributes: Column


# ---- the mapping, and the part of it a document needs --------------------------------


def rank_replacements(mapping: NameMapping) -> DataFrame:
    """One row per name: its meaning as a metric, as an attribute, and what
    replaces it as a word in a text, which is the longer of the two. Keys known
    for single metrics only are listed without a meaning of their own."""
    rows = mapping.metrics.select(F.col("norm_name").alias("name"), F.lit("metric").alias("kind"), F.col("orig_name").alias("new")).unionByName(
        mapping.everywhere.select(F.col("norm_key").alias("name"), F.lit("attribute").alias("kind"), F.col("orig_key").alias("new"))
    ).where("new is not null")
    keys = mapping.attributes.select(F.col("norm_key").alias("name"), F.lit("key").alias("kind"), F.lit(None).cast("string").alias("new"))
    return (
        rows.unionByName(keys)
        .where("name <> ''")
        .groupBy("name")
        .agg(
            F.max(F.when(F.col("kind") == "metric", F.col("new"))).alias("metric_new"),
            F.max(F.when(F.col("kind") == "attribute", F.col("new"))).alias("attribute_new"),
            F.max_by("new", F.when(F.col("new").isNotNull(), F.struct(F.length("new"), "kind", "new"))).alias("word_new"),
        )
    )


# Escape sequences of JSON text, and the spellings a name can have in it.
_ESCAPES = r"\\u[0-9A-Fa-f]{4}|\\."
_WIDEST = r"[\w:./-]+"
_NARROWER = [r"\w+", r"[\w:]+", r"[\w:.]+"]


def mentioned_names(text: Column) -> Column:
    """Everything in a JSON text that could be a name."""

    def all_of(value: Column, pattern: str, group: int = 0) -> Column:
        return F.regexp_extract_all(value, F.lit(pattern), F.lit(group))

    def with_parts(pieces: Column) -> Column:
        mixed = F.filter(pieces, lambda p: p.rlike(r"[^\w]"))
        parts = F.flatten(F.transform(mixed, lambda p: F.concat(*[all_of(p, n) for n in _NARROWER])))
        return F.concat(pieces, parts)

    words = V.let(F.array_distinct(all_of(F.regexp_replace(text, _ESCAPES, " "), _WIDEST)), with_parts)
    strings = all_of(text, r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"', 1)
    return F.array_distinct(F.concat(words, strings))


def attach_names(docs: DataFrame, mapping: NameMapping, mentioned: Column, key: str = "id") -> tuple[DataFrame, Names]:
    """Add the maps of ``Names`` to every document. Documents are clustered by
    their key first: the work per document is heavy, and the joins below then
    need no further exchange of them."""
    docs = docs.repartition(F.col(key))
    mentions = docs.select(key, F.explode(mentioned).alias("name"))
    # A metric's row brings its attributes along, so one join finds all a document
    # may need and one grouping takes what it names.
    attribute = F.struct("norm_name", "norm_key", "orig_key")
    of_metric = mapping.attributes.where("orig_key is not null").groupBy(F.col("norm_name").alias("name")).agg(F.collect_list(attribute).alias("_of_metric"))
    known = rank_replacements(mapping).join(of_metric, "name", "left")
    hits = mentions.join(known, "name").withColumn("exact_new", F.coalesce("metric_new", "attribute_new"))

    def gathered(column: str, wanted: Column | None = None) -> Column:
        keep = F.col(column).isNotNull() if wanted is None else wanted
        return F.map_from_entries(F.collect_list(F.when(keep, F.struct("name", column))))

    maps = hits.groupBy(key).agg(
        gathered("metric_new").alias("_metrics"),
        gathered("attribute_new").alias("_everywhere"),
        gathered("word_new", F.col("name").rlike(r"\A\w+\z")).alias("_words"),
        gathered("exact_new").alias("_exact"),
        F.sort_array(F.flatten(F.collect_list(F.when(F.col("metric_new").isNotNull(), F.col("_of_metric"))))).alias("_attributes"),
        F.collect_set("name").alias("_named"),
    )
    maps = maps.withColumn("_attributes", F.filter("_attributes", lambda a: F.array_contains("_named", a["norm_key"]))).drop("_named")
    empty = F.create_map().cast(STRING_MAP)
    columns = ["_metrics", "_everywhere", "_words", "_exact"]
    joined = docs.join(maps, key, "left")
    joined = joined.withColumns({c: F.coalesce(F.col(c), empty) for c in columns}).withColumn(
        "_attributes",
        F.coalesce("_attributes", F.array().cast("array<struct<norm_name:string,norm_key:string,orig_key:string>>")),
    )
    return joined, Names(*[F.col(c) for c in [*columns, "_attributes"]])


# ---- query texts -----------------------------------------------------------------------


def _mapping_of(names: Names, referenced: Column) -> Column:
    """Attribute maps of the referenced metrics (later names win) and the metric
    names themselves."""
    attributes = F.map_from_entries(
        F.transform(
            F.filter(names.attributes, lambda a: F.array_contains(referenced, a["norm_name"])),
            lambda a: F.struct(a["norm_key"], a["orig_key"]),
        )
    )
    return F.map_concat(attributes, F.map_filter(names.metrics, lambda name, _: F.array_contains(referenced, name)))


def referenced_metrics(candidates: Column, metrics: Column) -> Column:
    return F.array_intersect(F.map_keys(metrics), candidates)


def new_sql(text: Column, names: Names, with_metrics: Column) -> Column:
    """An SQL text under new names. ``with_metrics`` says whether the text may
    name metrics at all; if none is named, the mapping over all metrics is used."""

    def rewritten(query: Column) -> Column:
        found = F.when(with_metrics, referenced_metrics(R.sql_metric_names(query), names.metrics))

        def with_found(referenced: Column) -> Column:
            chosen = F.when(F.size(referenced) > 0, _mapping_of(names, referenced)).otherwise(names.everywhere)
            return V.let(chosen, lambda mapping: R.rewrite_sql(query, mapping, names.everywhere))

        return V.let(V.no_items(found, "string"), with_found)

    return V.let(R.clean_query_text(R.template_to_param(text)), rewritten)


def new_promql(text: Column, names: Names) -> Column:
    def rewritten(query: Column) -> Column:
        referenced = referenced_metrics(R.prom_metric_names(query), names.metrics)
        return V.let(_mapping_of(names, referenced), lambda mapping: R.rewrite_promql(query, mapping))

    return V.let(R.template_to_param(text), rewritten)


def new_text(text: Column, names: Names) -> Column:
    """A plain text: replaced as a whole if it is a name, else word by word."""
    return F.coalesce(F.try_element_at(names.exact, text), R.replace_tokens(text, names.words))


def _text_edit(change):
    """Lift a text function to a variant: strings change, other values stay."""

    def edit(value: Column) -> Column:
        return V.let(V.text(value), lambda s: F.coalesce(F.when(s != "", change(s)).cast("variant"), value))

    return edit


def _is_sql_on_metrics(query: Column, database: str) -> Column:
    return F.contains(query, F.lit(database))


# ---- each distinct text once --------------------------------------------------------------

# Kinds of texts: SQL (which may name metrics if it reads their database), SQL that is
# rewritten only if it does, SQL that may name metrics always, so also the query of a
# variable, whose parameters are renamed too, PromQL, plain text, and builder entries as JSON, of which
# those not on metrics follow the names of their dashboard's variables (``given``).
SQL, SQL_ON_METRICS, SQL_ALWAYS, VARIABLE = "sql", "sql_on_metrics", "sql_always", "variable"
PROMQL, TEXT, ENTRY, OTHER_ENTRY = "promql", "text", "entry", "other_entry"
_TEXT = "struct<kind:string,text:string,given:string>"
_QUOTED = "(?s)" + "|".join([R.DOUBLE_QUOTED, R.SINGLE_QUOTED, R.BACK_QUOTED])


def _as(kind, text: Column, given: Column | None = None) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), text.alias("text"), (F.lit("") if given is None else given).alias("given"))


def _names_in(kind: Column, text: Column, given: Column) -> Column:
    """What a text may name: its words, itself, and everything it holds in quotes."""
    json = F.when(kind.isin(ENTRY, OTHER_ENTRY), F.concat_ws(" ", text, given)).otherwise(F.to_json(F.struct(text.alias("text"))))
    quoted = F.transform(F.regexp_extract_all(text, F.lit(_QUOTED), F.lit(0)), lambda p: F.substring(p, F.lit(2), F.length(p) - 2))
    return F.array_distinct(F.concat(mentioned_names(json), F.array(text), quoted))


def new_texts(texts: DataFrame, mapping: NameMapping, database: str) -> DataFrame:
    """Distinct texts (kind, text, given) with ``new``, the text under new names,
    and ``error``, why it cannot be read; an unreadable text has no new one."""
    kind, text, given = F.col("kind"), F.col("text"), F.col("given")
    keyed = texts.distinct().withColumn("_text", F.sha2(F.to_json(F.struct("kind", "given", "text")), 256))
    named, names = attach_names(keyed, mapping, _names_in(kind, text, given), "_text")
    query = R.template_to_param(text)
    is_sql = kind.isin(SQL, SQL_ON_METRICS, SQL_ALWAYS, VARIABLE)
    read = V.evaluated(named, error=F.when(is_sql, R.sql_error(R.clean_query_text(query))).when(kind == PROMQL, R.prom_error(query)))
    variables = F.map_from_entries(F.transform(F.from_json(given, "array<string>"), lambda s: F.struct(s, new_text(s, names))))
    reads_metrics = _is_sql_on_metrics(text, database)
    always = F.lit(True)
    new = (
        F.when(F.col("error").isNotNull(), None)
        .when(kind == PROMQL, new_promql(text, names))
        .when(kind == SQL, new_sql(text, names, reads_metrics))
        .when(kind == SQL_ON_METRICS, F.when(reads_metrics, new_sql(text, names, always)).otherwise(text))
        .when(kind == SQL_ALWAYS, new_sql(text, names, always))
        .when(kind == VARIABLE, R.replace_placeholders(new_sql(text, names, always), names.everywhere))
        .when(kind == TEXT, new_text(text, names))
        .when(kind == ENTRY, R.rename_in_json(text, names.exact, names.words))
        .when(kind == OTHER_ENTRY, V.let(variables, lambda known: R.rename_in_json(text, known, known)))
    )
    done = V.evaluated(read, new=new)
    broken = kind.isin(ENTRY, OTHER_ENTRY) & F.try_parse_json("new").isNull()
    return done.select("kind", "text", "given", F.when(broken, text).otherwise(F.col("new")).alias("new"), "error")


def _place(kind: Column, text: Column, given: Column) -> Column:
    return F.concat_ws(":", kind, given, text)


@dataclass
class Texts:
    """The new texts of a document, as a map column of its row."""

    known: Column

    def _found(self, kind: str, text: Column, given: Column) -> Column:
        return F.try_element_at(self.known, _place(F.lit(kind), text, given))

    def new(self, kind: str, text: Column, given: Column | None = None) -> Column:
        """The text under new names; NULL if it cannot be read."""
        return self._found(kind, text, F.lit("") if given is None else given)["new"]

    def error(self, kind: str, text: Column, given: Column | None = None) -> Column:
        return self._found(kind, text, F.lit("") if given is None else given)["error"]

    def bad(self, kind: str, text: Column, given: Column | None = None) -> Column:
        """Whether it cannot be read. No text is no fault."""
        return F.coalesce(self.error(kind, text, given).isNotNull(), F.lit(False))

    def edit(self, kind: str):
        return _text_edit(lambda s: self.new(kind, s))

    def json(self, kind: str):
        """The same edit, giving JSON text."""

        def edit(value: Column) -> Column:
            return V.let(V.text(value), lambda s: F.to_json(F.coalesce(F.when(s != "", self.new(kind, s)).cast("variant"), value)))

        return edit


def attach_texts(docs: DataFrame, texts: Column, renew, mapping: NameMapping, database: str, key: str) -> tuple[DataFrame, Texts]:
    """Add the new form of their ``texts`` to documents, as ``renew`` (``new_texts``
    or ``new_parts``) gives it. The distinct new texts are staged, so that Spark knows their size when it joins them; documents are
    clustered by their key, and where the join is a broadcast they move only once."""
    held = F.filter(texts, lambda t: t["text"] != "")
    distinct = docs.select(F.explode(held).alias("t")).select("t.*")
    new = staged(renew(distinct, mapping, database))
    docs = docs.repartition(F.col(key))
    rows = docs.select(key, F.explode(F.array_distinct(held)).alias("t")).select(key, "t.*")
    place = _place(F.col("kind"), F.col("text"), F.col("given"))
    entry = F.struct(place, F.struct("new", "error"))
    maps = rows.join(new, ["kind", "text", "given"]).groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("_texts"))
    return docs.join(maps, key, "left"), Texts(F.col("_texts"))


# ---- dashboards -------------------------------------------------------------------------


# What of a query or a panel is text: cast once, and no other field is touched.
_FORMULAS = "array<struct<expression:variant,legend:variant>>"
_ENTRIES = "array<struct<query:variant,legend:variant>>"
_BUILDER = f"struct<queryData:array<variant>,queryFormulas:{_FORMULAS}>"
_QUERY = f"struct<clickhouse_sql:{_ENTRIES},promql:{_ENTRIES},builder:{_BUILDER}>"


def _builder_edits(texts: Texts, entry_edit) -> dict:
    legend = texts.json(TEXT)
    return {
        "queryData": lambda a: V.json_items(a, entry_edit),
        "queryFormulas": lambda a: V.json_items(a, lambda f: V.json_fields(f, {"expression": legend, "legend": legend})),
    }


def _texts_of(items: Column, *makes) -> Column:
    """The texts found in every item, one of each of ``makes``."""
    each = F.flatten(F.transform(items, lambda item: F.array(*[make(item) for make in makes])))
    return V.no_items(each, _TEXT)


def _texts_in(kind: str, name: str):
    return lambda item: _as(kind, V.text(V.field(item, name)))


def _part_in(kind: str, name: str):
    return lambda item: _as(kind, V.text(item[name]))


def _formula_texts(builder: Column) -> Column:
    return _texts_of(builder["queryFormulas"], _part_in(TEXT, "expression"), _part_in(TEXT, "legend"))


def _on_metrics(entry: Column) -> Column:
    return F.coalesce(V.text(V.field(entry, "dataSource")) == "metrics", F.lit(False))


def variable_names(doc: Column) -> Column:
    """The names of a dashboard's variables, as JSON."""
    old = F.transform(V.no_items(F.map_values(V.entries(V.field(doc, "variables"))), "variant"), lambda v: V.text(V.field(v, "name")))
    return F.to_json(F.filter(old, lambda s: s != ""))


def query_texts(query: Column, given: Column) -> Column:
    """The texts of a panel's query."""

    def entry(e: Column) -> Column:
        on_metrics = _on_metrics(e)
        return F.when(
            V.field(e, "dataSource").isNotNull(),
            _as(F.when(on_metrics, ENTRY).otherwise(OTHER_ENTRY), F.to_json(e), F.when(on_metrics, "").otherwise(given)),
        )

    return F.concat(
        _texts_of(query["clickhouse_sql"], _part_in(SQL, "query"), _part_in(TEXT, "legend")),
        _texts_of(query["promql"], _part_in(PROMQL, "query"), _part_in(TEXT, "legend")),
        _texts_of(query["builder"]["queryData"], entry),
        _formula_texts(query["builder"]),
    )


def variable_texts(value: Column) -> Column:
    variables = V.entries(value)
    values = V.no_items(F.map_values(variables), "variant")
    keys = F.transform(V.no_items(F.map_keys(variables), "string"), lambda k: _as(TEXT, k))
    return F.concat(_texts_of(values, _texts_in(VARIABLE, "queryValue"), _texts_in(TEXT, "name")), keys)


def new_variables(variables: Column, texts: Texts) -> Column:
    """Rename variables: their query, their name, and their key."""
    edits = {"queryValue": texts.edit(VARIABLE), "name": texts.edit(TEXT)}
    renamed = F.transform(
        F.map_entries(V.entries(variables)),
        lambda e: F.struct(F.coalesce(texts.new(TEXT, e["key"]), e["key"]), V.edit_fields(e["value"], edits)),
    )
    return F.coalesce(F.to_variant_object(F.map_from_entries(renamed)), variables)


def variables_error(value: Column, texts: Texts) -> Column:
    """Whether a variable's query cannot be read; such a document is left alone."""
    variables = V.no_items(F.map_values(V.entries(value)), "variant")
    return F.exists(variables, lambda v: texts.bad(VARIABLE, V.text(V.field(v, "queryValue"))))


def query_error(query: Column, texts: Texts) -> Column:
    def any_bad(entries: Column, kind: str) -> Column:
        return F.coalesce(F.exists(entries, lambda e: texts.bad(kind, V.text(e["query"]))), F.lit(False))

    return any_bad(query["clickhouse_sql"], SQL) | any_bad(query["promql"], PROMQL)


def new_query(query: Column, texts: Texts, given: Column) -> Column:
    """The JSON text of a panel's query under new names."""
    legend = texts.json(TEXT)

    def builder_entry(entry: Column) -> Column:
        def renamed(json: Column) -> Column:
            new = F.when(_on_metrics(entry), texts.new(ENTRY, json)).otherwise(texts.new(OTHER_ENTRY, json, given))
            return F.coalesce(F.when(V.field(entry, "dataSource").isNotNull(), new), json)

        return V.let(F.to_json(entry), renamed)

    sql = {"query": texts.json(SQL), "legend": legend}
    prom = {"query": texts.json(PROMQL), "legend": legend}

    def sql_entry(entry: Column) -> Column:
        has_query = F.coalesce(V.text(V.field(entry, "query")) != "", F.lit(False))
        return F.when(has_query, V.json_fields(entry, sql)).otherwise(F.to_json(entry))

    edits = {
        "builder": lambda b: V.json_fields(b, _builder_edits(texts, builder_entry)),
        "clickhouse_sql": lambda a: V.json_items(a, sql_entry),
        "promql": lambda a: V.json_items(a, lambda e: V.json_fields(e, prom)),
    }
    return V.json_fields(query, edits)


def rewrite_dashboards(docs: DataFrame, mapping: NameMapping, database: str, key: str = "id", data: str = "data") -> DataFrame:
    """Rename metrics and attributes in dashboards. Returns (id, data, changed,
    error, panel_errors). Invalid JSON, documents already done and documents with
    an unreadable variable query keep their text; so do panels with an unreadable
    query."""

    # Panels stand in a list or under names; both are rewritten as one list.
    def panels(doc: Column, kind: str) -> Column:
        listed, named = F.try_variant_get(doc, "$.widgets", f"array<{kind}>"), F.try_variant_get(doc, "$.panelMap", f"map<string,{kind}>")
        return F.concat(V.no_items(listed, kind), V.no_items(F.map_values(named), kind))

    # The names of its variables matter to a query with builder entries only.
    def given_to(query: Column, given: Column) -> Column:
        return F.when(F.contains(query, F.lit('"dataSource"')), given).otherwise(F.lit(""))

    def held(doc: Column) -> Column:
        def in_panels(given: Column) -> Column:
            queries = F.transform(panels(doc, "struct<query:variant>"), lambda p: F.to_json(p["query"]))
            return F.transform(queries, lambda q: _as(PANEL, q, given_to(q, given)))

        return F.concat(V.let(variable_names(doc), in_panels), F.array(_as(VARIABLES, F.to_json(V.field(doc, "variables")))))

    attached, parts = attach_texts(docs, V.let(F.try_parse_json(data), held), new_parts, mapping, database, key)
    doc, given = F.col("_doc"), F.col("_given")
    parsed = V.evaluated(attached, _doc=F.try_parse_json(data))
    parsed = V.evaluated(
        parsed,
        _given=variable_names(doc),
        _done=V.is_true(V.field(doc, MIGRATED)),
        _error=F.when(~V.is_object(doc), F.lit("invalid JSON")).when(
            parts.bad(VARIABLES, F.to_json(V.field(doc, "variables"))), F.lit("variables")
        ),
    )
    pending = F.col("_error").isNull() & ~F.col("_done")

    def panel(w: Column) -> Column:
        def with_query(q: Column) -> Column:
            new = F.coalesce(parts.new(PANEL, q, given_to(q, given)), q)
            return F.struct(
                parts.bad(PANEL, q, given_to(q, given)).alias("bad"),
                F.when(pending, V.json_fields(w, {"query": lambda _: new})).alias("json"),
            )

        return V.let(F.to_json(V.field(w, "query")), with_query)

    parsed = V.evaluated(parsed, _panels=F.transform(panels(doc, "variant"), panel))
    written = F.transform("_panels", lambda p: p["json"])

    def new_list(old: Column) -> Column:
        return F.coalesce(V.json_array(F.slice(written, 1, F.size(old.try_cast("array<struct<_:boolean>>")))), F.to_json(old))

    def new_map(old: Column) -> Column:
        def of(keys: Column) -> Column:
            own = F.slice(written, F.size(written) - F.size(keys) + 1, F.size(keys))
            fields = F.zip_with(keys, own, V.json_field)
            return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))

        return F.coalesce(V.let(F.map_keys(old.try_cast("map<string,struct<_:boolean>>")), of), F.to_json(old))

    renamed = V.json_fields(
        doc,
        {"variables": lambda v: renewed(parts, VARIABLES, v), "widgets": new_list, "panelMap": new_map},
        **{MIGRATED: F.lit(True)},
    )
    new = F.when(pending, renamed)
    done = V.evaluated(parsed.withColumn("_panel_errors", F.size(F.filter("_panels", lambda p: p["bad"]))), _new=new)
    return _outcome(done, key, data)


def _outcome(done: DataFrame, key: str, data: str) -> DataFrame:
    # A document that is rewritten gets its mark, so it changes always.
    return done.withColumn("changed", F.col("_new").isNotNull()).select(
        key,
        F.when(F.col("changed"), F.col("_new")).otherwise(F.col(data)).alias(data),
        "changed",
        F.col("_error").alias("error"),
        F.coalesce("_panel_errors", F.lit(0)).alias("panel_errors"),
    )


# ---- alert rules --------------------------------------------------------------------------


_COMPOSITE = f"struct<promQueries:map<string,{_ENTRIES[6:-1]}>,chQueries:map<string,{_ENTRIES[6:-1]}>,builderQueries:map<string,variant>,builder:{_BUILDER}>"


def composite_texts(query: Column) -> Column:
    """The texts of a rule's composite query."""

    def entry(e: Column) -> Column:
        return F.when(V.is_object(e), _as(ENTRY, F.to_json(e)))

    def of(parts: Column) -> Column:
        entries = V.no_items(F.map_values(parts["builderQueries"]), "variant")
        return F.concat(
            _texts_of(F.map_values(parts["promQueries"]), _part_in(PROMQL, "query"), _part_in(TEXT, "legend")),
            _texts_of(F.map_values(parts["chQueries"]), _part_in(SQL_ON_METRICS, "query"), _part_in(TEXT, "legend")),
            F.when(F.exists(entries, _on_metrics), _texts_of(entries, entry)).otherwise(F.array().cast(f"array<{_TEXT}>")),
            _texts_of(parts["builder"]["queryData"], lambda e: F.when(_on_metrics(e), _as(ENTRY, F.to_json(e)))),
            _formula_texts(parts["builder"]),
        )

    return V.let(query.try_cast(_COMPOSITE), of)


def bad_queries(composite: Column, texts: Texts) -> Column:
    """Number of queries that cannot be read."""

    def count(name: str, kind: str) -> Column:
        queries = V.no_items(F.map_values(V.entries(V.field(composite, name))), "variant")
        return F.size(F.filter(queries, lambda e: texts.bad(kind, V.text(V.field(e, "query")))))

    return count("promQueries", PROMQL) + count("chQueries", SQL_ON_METRICS)


def new_composite(query: Column, texts: Texts, database: str) -> Column:
    """The JSON text of a rule's composite query under new names. Entries that cannot be read
    keep their text. If one builder query reads metrics, all of them are renamed."""
    legend = texts.json(TEXT)
    prom = {"query": texts.json(PROMQL), "legend": legend}
    sql = {"query": texts.json(SQL_ON_METRICS), "legend": legend}

    def rename(entry: Column) -> Column:
        return V.let(F.to_json(entry), lambda json: F.coalesce(texts.new(ENTRY, json), json))

    def values(value: Column, change) -> Column:
        fields = F.transform(F.map_entries(V.entries(value)), lambda e: V.json_field(e["key"], change(e["value"])))
        return F.coalesce(F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}")), F.to_json(value))

    def builder_queries(queries: Column) -> Column:
        any_metrics = F.exists(V.no_items(F.map_values(V.entries(queries)), "variant"), _on_metrics)
        renamed = values(queries, lambda e: F.when(V.is_object(e), rename(e)).otherwise(F.to_json(e)))
        return F.when(any_metrics, renamed).otherwise(F.to_json(queries))

    def prom_entry(entry: Column) -> Column:
        bad = texts.bad(PROMQL, V.text(V.field(entry, "query")))
        return F.when(bad, F.to_json(entry)).otherwise(V.json_fields(entry, prom))

    def sql_entry(entry: Column) -> Column:
        def edited(q: Column) -> Column:
            reads_metrics = F.coalesce(_is_sql_on_metrics(q, database), F.lit(False))
            return F.when(reads_metrics & texts.bad(SQL_ON_METRICS, q), F.to_json(entry)).otherwise(V.json_fields(entry, sql))

        return V.let(V.text(V.field(entry, "query")), edited)

    return V.json_fields(
        query,
        {
            "promQueries": lambda m: values(m, prom_entry),
            "chQueries": lambda m: values(m, sql_entry),
            "builderQueries": builder_queries,
            "builder": lambda b: V.json_fields(
                b, _builder_edits(texts, lambda e: F.when(_on_metrics(e), rename(e)).otherwise(F.to_json(e)))
            ),
        },
    )


def label_texts(labels: Column) -> Column:
    entries = V.entries(labels)
    keys = F.transform(V.no_items(F.map_keys(entries), "string"), lambda k: _as(TEXT, k))
    return F.concat(keys, _texts_of(F.map_values(entries), lambda v: _as(TEXT, V.text(v))))


def new_labels(labels: Column, texts: Texts) -> Column:
    """Rename label keys and values; values that are not strings stay as they are."""
    renamed = F.transform(
        F.map_entries(V.entries(labels)),
        lambda e: F.struct(F.coalesce(texts.new(TEXT, e["key"]), e["key"]), texts.edit(TEXT)(e["value"])),
    )
    return F.coalesce(F.to_variant_object(F.map_from_entries(renamed)), labels)


# Query parameter of a rule's source address that holds a composite query.
SOURCE_PARAM = "compositeQuery"


def _url_encode(text: Column) -> Column:
    """Percent-encoding as the documents hold it: ``*`` escaped, ``~`` not."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def source_query(source: Column) -> Column:
    """The JSON text inside a source address: one decoding for the address, two
    for the value. NULL if it has none or it is not decodable."""
    raw = F.regexp_extract(F.regexp_extract(source, r"\?([^#]*)", 1), rf"(?:\A|&){SOURCE_PARAM}=([^&]*)", 1)
    decoded = F.try_url_decode(F.try_url_decode(F.try_url_decode(raw)))
    return F.when(raw != "", decoded)


def new_source(source: Column, embedded: Column) -> Column:
    """The address with ``embedded`` (JSON text) as its query; other parameters stay,
    in key order. Unchanged if there is no embedded query."""
    parts = F.transform(
        F.filter(F.split(F.regexp_extract(source, r"\?([^#]*)", 1), "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.try_url_decode(F.regexp_extract(p, r"\A([^=]*)", 1)).alias("key"),
            F.try_url_decode(F.regexp_extract(p, r"\A[^=]*=(.*)", 1)).alias("value"),
        ),
    )
    query = _url_encode(_url_encode(embedded))
    encoded = F.transform(
        F.array_sort(parts, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)),
        lambda p: F.concat(
            _url_encode(p["key"]),
            F.lit("="),
            _url_encode(F.when(p["key"] == SOURCE_PARAM, query).otherwise(p["value"])),
        ),
    )
    head, tail = F.regexp_extract(source, r"\A([^?#]*)", 1), F.regexp_extract(source, r"(#.*)\z", 1)
    address = F.concat(head, F.lit("?"), F.array_join(encoded, "&"), tail)
    return F.when(F.startswith(embedded, F.lit("{")), address).otherwise(source)


# ---- each distinct part once ----------------------------------------------------------------

# Kinds of parts, all JSON but the address of a rule.
PANEL, VARIABLES, COMPOSITE, NOTES, LABELS, ADDRESS = "panel", "variables", "composite", "notes", "labels", "address"


def new_parts(parts: DataFrame, mapping: NameMapping, database: str) -> DataFrame:
    """Distinct parts (kind, text, given) with ``new``, the part under new names, and
    ``error``: set for panels and variables that cannot be read, which have no new
    form, and the number of unreadable queries of a composite query."""
    kind, text, given = F.col("kind"), F.col("text"), F.col("given")
    keyed = staged(parts.distinct().withColumn("_part", F.sha2(F.to_json(F.struct("kind", "given", "text")), 256)))
    value = F.when(kind == ADDRESS, F.try_parse_json(source_query(text))).otherwise(F.try_parse_json(text))

    def held(v: Column) -> Column:
        notes = F.array(*[_texts_in(TEXT, name)(v) for name in ("description", "summary")])
        return (
            F.when(kind == PANEL, query_texts(v.try_cast(_QUERY), given))
            .when(kind == VARIABLES, variable_texts(v))
            .when(kind.isin(COMPOSITE, ADDRESS), composite_texts(v))
            .when(kind == NOTES, notes)
            .when(kind == LABELS, label_texts(v))
        )

    attached, texts = attach_texts(keyed, V.let(value, held), new_texts, mapping, database, "_part")
    read = V.evaluated(attached, _value=value)
    v = F.col("_value")
    faults = F.when(kind == COMPOSITE, bad_queries(v, texts))
    error = (
        F.when((kind == PANEL) & query_error(v.try_cast(_QUERY), texts), F.lit("unreadable"))
        .when((kind == VARIABLES) & variables_error(v, texts), F.lit("unreadable"))
        .when(faults > 0, faults.cast("string"))
    )
    read = V.evaluated(read, error=error)
    note = texts.json(TEXT)
    new = (
        F.when(kind.isin(PANEL, VARIABLES) & F.col("error").isNotNull(), None)
        .when(kind == PANEL, new_query(v, texts, given))
        .when(kind == VARIABLES, F.to_json(new_variables(v, texts)))
        .when(kind == COMPOSITE, new_composite(v, texts, database))
        .when(kind == ADDRESS, new_source(text, new_composite(v, texts, database)))
        .when(kind == NOTES, V.json_fields(v, {"description": note, "summary": note}))
        .when(kind == LABELS, F.to_json(new_labels(v, texts)))
    )
    return V.evaluated(read, new=new).select("kind", "text", "given", "new", "error")


def renewed(parts: Texts, kind: str, value: Column) -> Column:
    """The JSON text of a part in its new form, or as it is."""
    return V.let(F.to_json(value), lambda json: F.coalesce(parts.new(kind, json), json))


def rewrite_alerts(docs: DataFrame, mapping: NameMapping, database: str, key: str = "id", data: str = "data") -> DataFrame:
    """Rename metrics and attributes in alert rules. Same result as
    ``rewrite_dashboards``; a rule without a composite query is left alone."""

    def held(doc: Column) -> Column:
        fields = [
            _as(COMPOSITE, F.to_json(V.path(doc, "condition", "compositeQuery"))), _as(NOTES, F.to_json(V.field(doc, "annotations"))),
            _as(LABELS, F.to_json(V.field(doc, "labels"))), _as(ADDRESS, V.text(V.field(doc, "source"))),
        ]
        return F.array(*fields)

    attached, parts = attach_texts(docs, V.let(F.try_parse_json(data), held), new_parts, mapping, database, key)
    doc = F.col("_doc")
    parsed = V.evaluated(attached, _doc=F.try_parse_json(data))
    composite = V.path(doc, "condition", "compositeQuery")
    parsed = V.evaluated(
        parsed,
        _error=F.when(~V.is_object(doc), F.lit("invalid JSON")).when(
            ~V.is_object(composite), F.lit("no composite query")
        ),
        _panel_errors=F.coalesce(parts.error(COMPOSITE, F.to_json(composite)).cast("int"), F.lit(0)),
    )
    renamed = V.json_fields(
        doc,
        {
            "condition": lambda c: V.json_fields(c, {"compositeQuery": lambda q: renewed(parts, COMPOSITE, q)}),
            "annotations": lambda a: renewed(parts, NOTES, a),
            "labels": lambda m: renewed(parts, LABELS, m),
            "source": parts.json(ADDRESS),
        },
        **{MIGRATED: F.lit(True)},
    )
    pending = F.col("_error").isNull() & ~V.is_true(V.field(doc, MIGRATED))
    new = F.when(pending, renamed)
    return _outcome(V.evaluated(parsed, _new=new), key, data)


# ---- flat views ---------------------------------------------------------------------------


def _row(panel: Column, lang: str, pos: Column, name: Column, text: Column) -> Column:
    return F.struct(
        panel.cast("string").alias("panel"),
        F.lit(lang).alias("lang"),
        pos.cast("int").alias("pos"),
        name.cast("string").alias("name"),
        text.alias("text"),
    )


_ROW = "struct<panel:string,lang:string,pos:int,name:string,text:string>"


# What of a panel comes out as rows: cast once, and no other field is touched.
_NAMED = "array<struct<name:variant,query:variant,legend:variant>>"
_NAMED_FORMULAS = "array<struct<queryName:variant,expression:variant,legend:variant>>"
_FLAT = f"struct<query:struct<clickhouse_sql:{_NAMED},promql:{_NAMED},builder:struct<queryData:array<variant>,queryFormulas:{_NAMED_FORMULAS}>>>"


def _panel_rows(widget: Column, panel: Column, langs: list[str]) -> Column:
    """Rows of one panel (``_FLAT``) in the given languages."""
    query = widget["query"]
    formulas = query["builder"]["queryFormulas"]
    sources = {
        "builder": (query["builder"]["queryData"], lambda e: V.text(V.field(e, "queryName")), F.to_json),
        "formula": (formulas, lambda e: V.text(e["queryName"]), lambda e: V.text(e["expression"])),
        "sql": (query["clickhouse_sql"], lambda e: V.text(e["name"]), lambda e: V.text(e["query"])),
        "promql": (query["promql"], lambda e: V.text(e["name"]), lambda e: V.text(e["query"])),
        "formula_legend": (formulas, lambda e: V.text(e["queryName"]), lambda e: V.text(e["legend"])),
        "sql_legend": (query["clickhouse_sql"], lambda e: V.text(e["name"]), lambda e: V.text(e["legend"])),
        "promql_legend": (query["promql"], lambda e: V.text(e["name"]), lambda e: V.text(e["legend"])),
    }

    def of(lang: str) -> Column:
        items, name, text = sources[lang]
        return V.no_items(F.transform(items, lambda e, i: _row(panel, lang, i, name(e), text(e))), _ROW)

    return F.concat(F.array().cast(f"array<{_ROW}>"), *[of(lang) for lang in sources if lang in langs])


LANGS = ["builder", "formula", "sql", "promql", "formula_legend", "sql_legend", "promql_legend", "variable"]


def flatten_queries(docs: DataFrame, key: str = "id", data: str = "data", langs: list[str] | None = None) -> DataFrame:
    """One row per text a dashboard holds: (id, panel, lang, pos, name, text), or
    per text in one of ``langs`` (of ``LANGS``)."""
    langs = LANGS if langs is None else langs
    parsed = docs.withColumn("_doc", F.try_parse_json(data))
    doc = F.col("_doc")
    none = F.lit(None).cast("string")

    def keyed(value: Column, make) -> Column:
        return V.no_items(F.transform(F.array_sort(F.map_keys(V.entries(value))), lambda k, i: make(k, F.try_element_at(V.entries(value), k), i)), _ROW)

    listed = F.try_variant_get(doc, "$.widgets", f"array<{_FLAT}>")
    named = F.try_variant_get(doc, "$.panelMap", f"map<string,{_FLAT}>")
    rows = [
        F.flatten(V.no_items(F.transform(listed, lambda w, i: _panel_rows(w, i, langs)), f"array<{_ROW}>")),
        F.flatten(V.no_items(F.transform(F.map_entries(named), lambda e: _panel_rows(e["value"], e["key"], langs)), f"array<{_ROW}>")),
    ]
    if "variable" in langs:
        rows.append(keyed(V.field(doc, "variables"), lambda k, v, i: _row(none, "variable", i, k, V.text(V.field(v, "queryValue")))))
    return parsed.select(key, F.explode(F.concat(*rows)).alias("r")).select(key, "r.*").where("text is not null")


def flatten_rules(docs: DataFrame, key: str = "id", data: str = "data") -> DataFrame:
    """One row per text an alert rule holds."""
    parsed = docs.withColumn("_doc", F.try_parse_json(data))
    doc = F.col("_doc")
    composite = V.path(doc, "condition", "compositeQuery")
    none = F.lit(None).cast("string")

    def keyed(value: Column, lang: str, text) -> Column:
        entries = V.entries(value)
        return V.no_items(
            F.transform(F.array_sort(F.map_keys(entries)), lambda k, i: _row(none, lang, i, k, text(F.try_element_at(entries, k)))), _ROW
        )

    def query_text(entry: Column) -> Column:
        return V.text(V.field(entry, "query"))

    rows = F.concat(
        keyed(V.field(composite, "builderQueries"), "builder", F.to_json),
        keyed(V.field(composite, "chQueries"), "sql", query_text),
        keyed(V.field(composite, "promQueries"), "promql", query_text),
        keyed(V.field(doc, "annotations"), "annotation", V.text),
        keyed(V.field(doc, "labels"), "label", V.text),
        F.array(_row(none, "source", F.lit(0), none, V.text(V.field(doc, "source")))),
    )
    return parsed.select(key, F.explode(rows).alias("r")).select(key, "r.*").where("text is not null")


def extract_references(queries: DataFrame, names: DataFrame, keys: list[str], lang: str = "lang", text: str = "text") -> DataFrame:
    """Known names (rows with ``name``) each query refers to, sorted. What is
    gathered per query are names out of its own text."""
    candidates = F.when(F.col(lang) == "sql", R.sql_metric_names(F.col(text))).when(F.col(lang) == "promql", R.prom_metric_names(F.col(text)))
    mentions = queries.select(*keys, F.explode(candidates).alias("name")).join(names.select("name").distinct(), "name", "left_semi")
    return mentions.groupBy(*keys).agg(F.sort_array(F.collect_set("name")).alias("references"))


def rewrite_names(queries: DataFrame, mapping: NameMapping, key: str = "id", lang: str = "lang", text: str = "text") -> DataFrame:
    """Query rows (key, lang, text) under new names; ``error`` says why a text was
    left as it is. The rows are staged, as making them may be the larger part of
    the work and they are read twice."""
    kind = F.when(F.col(lang) == "sql", SQL_ALWAYS).when(F.col(lang) == "promql", PROMQL).otherwise(TEXT)
    queries = staged(queries.select(key, lang, text))
    rows = queries.select(key, lang, text, kind.alias("_kind"), F.coalesce(text, F.lit("")).alias("_text"))
    held = rows.where(F.col("_kind") != TEXT).select(F.col("_kind").alias("kind"), F.col("_text").alias("text"), F.lit("").alias("given"))
    new = staged(new_texts(held, mapping, "")).select(F.col("kind").alias("_kind"), F.col("text").alias("_text"), "new", "error")
    joined = rows.join(new, ["_kind", "_text"], "left")
    return joined.select(key, lang, F.coalesce("new", text).alias(text), "error")
