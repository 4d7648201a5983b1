"""The field catalog, promotion of attributes to columns, and index layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemorph.functions import scalars
from telemorph.operators import fields, logs
from telemorph.queries.oracle_inputs import with_
from telemorph.queries.registry import query
from telemorph.sources import derived as d

# Fields promoted to columns in the old log table used below.
PROMOTED = [
    ("attribute", "event_type", "string"),
    ("attribute", "k", "int64"),
    ("attribute", "is_error", "bool"),
    ("resource", "service.name", "string"),
    ("resource", "host_name", "string"),
]


def _old_table(t):
    """A log table with array attributes and some promoted columns."""
    table = d.logs_v1(t)
    for kind, name, dtype in PROMOTED:
        table = fields.promote_array_field(table, kind, name, dtype)
    return table


STORED = """stored AS (SELECT * FROM fields WHERE (type, datatype, name) IN (
    ('attribute','string','event_type'), ('attribute','int64','k'), ('attribute','bool','is_error'), ('resource','string','service.name')))"""


@query("s04_promoted_fields", with_("fields", f"""
    WITH {STORED} SELECT name, datatype, type, type || '_' || datatype || '_' || replace(name, '.', '$$') AS column_name FROM stored"""))
def s04(t):
    return fields.promoted_fields(_old_table(t), d.field_catalog(t))


@query("a06_distinct_fields", with_("fields", "SELECT DISTINCT name, datatype FROM fields"))
def a06(t):
    return fields.distinct_fields(d.field_reports(t))


@query("u01_union_fields", with_("fields", """
    SELECT name, datatype, 'attribute' AS type FROM fields WHERE type = 'attribute'
    UNION ALL SELECT name, datatype, 'resource' FROM fields WHERE type = 'resource'"""))
def u01(t):
    catalog = d.field_catalog(t)
    split = {kind: catalog.where(F.col("type") == kind).drop("type") for kind in ("attribute", "resource")}
    return fields.union_fields(split["attribute"], split["resource"])


@query("p19_exclude_top_level", with_("fields", """
    SELECT * FROM fields WHERE name NOT IN ('timestamp','id','trace_id','span_id','trace_flags','severity_text','severity_number','body')"""))
def p19(t):
    return fields.exclude_top_level(d.field_catalog(t))


TWINS = """twins AS (SELECT a.* FROM fields a WHERE contains(a.name, '.') AND EXISTS (
    SELECT 1 FROM fields b WHERE b.name = replace(a.name, '.', '_') AND b.datatype = a.datatype AND b.type = a.type))"""


@query("j07_dotted_twins", with_("fields", f"WITH {TWINS} SELECT * FROM twins"))
def j07(t):
    return fields.dotted_twins(d.field_catalog(t))


@query("j07_dotted_twins_promoted", with_("fields", f"WITH {TWINS} SELECT * FROM twins WHERE name = 'event.type'"))
def j07_promoted(t):
    return fields.dotted_twins(d.field_catalog(t), fields.schema_columns(_old_table(t)))


@query("j07_field_mapping", with_("fields", f"""
    WITH {TWINS} SELECT type || 's_' || datatype || '_' || replace(name, '.', '_') AS ref, name AS new_name FROM twins"""))
def j07_mapping(t):
    return fields.field_mapping(d.field_catalog(t))


@query("j09_drop_underscore_twins", with_("fields", """
    SELECT * FROM fields a WHERE NOT EXISTS (
      SELECT 1 FROM fields b WHERE contains(b.name, '.') AND replace(b.name, '.', '_') = a.name AND b.datatype = a.datatype AND b.type = a.type)"""))
def j09(t):
    return fields.drop_underscore_twins(d.field_catalog(t))


@query("p14_promote_field", with_("logs", """
    SELECT id, event_type AS "attribute_string_event$$type", coalesce(host, '') AS "resource_string_host$$name",
           CAST(trunc(k) AS BIGINT) AS attribute_number_k, is_error AS attribute_bool_is_error, '' AS attribute_string_missing FROM logs"""))
def p14(t):
    out = logs.upgrade_logs_v2(d.logs_v1(t))
    for kind, name, dtype in (
        ("attribute", "event.type", "string"), ("resource", "host.name", "String"), ("attribute", "k", "int64"),
        ("attribute", "is_error", "bool"), ("attribute", "missing", "string"),
    ):
        out = fields.promote_field(out, kind, name, dtype)
    return out.select(
        "id", "attribute_string_event$$type", "resource_string_host$$name", "attribute_number_k", "attribute_bool_is_error",
        "attribute_string_missing",
    )


@query("p14_promote_array_field", with_("logs", """
    SELECT id, coalesce(host, '') AS "resource_string_host$$name", host IS NOT NULL AS "resource_string_host$$name_exists",
           0 AS attribute_int64_missing, FALSE AS attribute_int64_missing_exists FROM logs"""))
def p14_arrays(t):
    out = fields.promote_array_field(d.logs_v1(t), "resource", "host.name", "string")
    out = fields.promote_array_field(out, "attribute", "missing", "int64")
    return out.select("id", *[c for c in out.columns if "host$$" in c or "missing" in c])


@query("p15_presence_column", with_("logs", """
    SELECT id, host IS NOT NULL AS "resource_string_host$$name_exists", TRUE AS attribute_number_k_exists FROM logs"""))
def p15(t):
    out = fields.promote_field(logs.upgrade_logs_v2(d.logs_v1(t)), "resource", "host.name", "string")
    out = fields.promote_field(out, "attribute", "k", "float64")
    return out.select("id", "resource_string_host$$name_exists", "attribute_number_k_exists")


@query("p16_promoted_name", with_("fields", """
    SELECT name, datatype, type, type || '_' || datatype || '_' || replace(name, '.', '$$') AS column_name FROM fields"""))
def p16(t):
    name = scalars.promoted_name(F.col("type"), F.upper("datatype"), F.col("name"))
    return d.field_catalog(t).withColumn("column_name", name)


@query("p17_datatype_class", with_("fields", """
    SELECT name, datatype, type, CASE WHEN datatype IN ('int64','float64') THEN 'number' WHEN datatype = 'bool' THEN 'bool' ELSE 'string' END AS storage_class,
      type || '_' || CASE WHEN datatype IN ('int64','float64') THEN 'number' WHEN datatype = 'bool' THEN 'bool' ELSE 'string' END || '_' || replace(name, '.', '$$') AS column_name
    FROM fields"""))
def p17(t):
    return fields.class_column(d.field_catalog(t))


@query("p18_rename_promoted", with_("logs", """
    SELECT id, event_type AS attribute_string_event_type, is_error AS attribute_bool_is_error, body FROM logs"""))
def p18(t):
    flat = d.logs_v1(t).select(
        "id", F.get("attributes_string_value", 0).alias("event_type"), F.get("attributes_bool_value", 0).alias("is_error"), "body"
    )
    return fields.rename_promoted(
        flat, [("attribute", "string", "event_type"), ("attribute", "bool", "is_error"), ("attribute", "string", "body"), ("resource", "string", "gone")]
    )


@query("r05_bloom_columns", with_("fields", """
    SELECT column_name, column_name || '_idx' AS index_name, 0.01::DOUBLE AS fpp FROM (
      SELECT type || '_' || CASE WHEN datatype IN ('int64','float64') THEN 'number' ELSE 'string' END || '_' || replace(name, '.', '$$') AS column_name
      FROM fields WHERE datatype <> 'bool')"""))
def r05(t):
    return fields.bloom_columns(d.field_catalog(t))


@query("r05_bloom_write", with_("logs", "SELECT event_type, count(*) AS n FROM logs GROUP BY 1"))
def r05_write(t):
    """Write promoted columns with bloom filters and read the table back."""
    import uuid

    from telemorph.operators.sinks import write_upgraded
    from telemorph.session import checkpoint_dir

    out = fields.promote_field(logs.upgrade_logs_v2(d.logs_v1(t)), "attribute", "event.type", "string")
    out = out.select("id", F.col("attribute_string_event$$type").alias("event_type"))
    path = f"{checkpoint_dir(t.spark)}/r05-{uuid.uuid4().hex}"
    write_upgraded(out, path, mode="overwrite", options=fields.bloom_options([("event_type", "string"), ("is_error", "bool")]))
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("r06_stale_indexes", with_("fields", """
    SELECT name || '_idx' AS index_name FROM fields WHERE name IN ('k', 'value', 'service_name') GROUP BY 1"""))
def r06(t):
    """Indexes still named after bare fields; those of top-level fields stay."""
    catalog = d.field_catalog(t)
    indexed = catalog.where(F.col("name").isin("k", "value", "service_name", "body")).select(
        F.concat("name", F.lit("_idx")).alias("index_name")
    )
    other = catalog.select(F.concat("type", F.lit("_"), "name", F.lit("_idx")).alias("index_name"))
    return fields.stale_indexes(catalog, indexed.unionByName(other).distinct())
