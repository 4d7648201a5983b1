"""Attribute fields: the catalog, promotion to columns, renames, layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions.maps import DEFAULTS, array_lookup, has_key, map_lookup
from telemorph.functions.scalars import datatype_class, promoted_name

# Fixed value: log fields that are columns by themselves.
TOP_LEVEL_FIELDS = [
    "timestamp",
    "id",
    "trace_id",
    "span_id",
    "trace_flags",
    "severity_text",
    "severity_number",
    "body",
]

SPARK_TYPES = {"string": "string", "int64": "bigint", "float64": "double", "bool": "boolean"}
BLOOM_FPP = 0.01


def _underscored(name: str = "name") -> Column:
    return F.replace(F.col(name), F.lit("."), F.lit("_"))


# ---- the catalog ---------------------------------------------------------------


def distinct_fields(catalog: DataFrame) -> DataFrame:
    return catalog.select("name", "datatype").distinct()


def union_fields(attributes: DataFrame, resources: DataFrame) -> DataFrame:
    """Attribute and resource fields in one list, tagged by type."""
    return attributes.withColumn("type", F.lit("attribute")).unionByName(
        resources.withColumn("type", F.lit("resource"))
    )


def exclude_top_level(fields: DataFrame) -> DataFrame:
    return fields.where(~F.col("name").isin(TOP_LEVEL_FIELDS))


def schema_columns(table: DataFrame) -> DataFrame:
    """Column names and types of a table as rows (as many as the table is wide)."""
    names = {"string": "string", "bigint": "int64", "double": "float64", "boolean": "bool"}
    rows = [(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in table.schema]
    return table.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def promoted_fields(table: DataFrame, fields: DataFrame) -> DataFrame:
    """Fields that are stored as a column of their own type in ``table``."""
    columns = F.broadcast(schema_columns(table))  # as many rows as the table has columns
    candidates = fields.withColumn("column_name", promoted_name(F.col("type"), F.col("datatype"), F.col("name")))
    return candidates.withColumn("column_type", F.lower("datatype")).join(
        columns, ["column_name", "column_type"], "left_semi"
    ).drop("column_type")


def dotted_twins(fields: DataFrame, promoted: DataFrame | None = None) -> DataFrame:
    """Dotted fields whose underscore spelling exists with the same type and data
    type. With ``promoted`` (rows with ``column_name``) the underscore spelling
    must also be a stored column."""
    twins = fields.select(F.col("name").alias("_twin"), "datatype", "type")
    dotted = fields.where(F.contains("name", F.lit("."))).withColumn("_twin", _underscored())
    found = dotted.join(twins, ["_twin", "datatype", "type"], "left_semi")
    if promoted is not None:
        found = found.withColumn(
            "column_name", F.concat_ws("_", F.lower("type"), F.lower("datatype"), "_twin")
        ).join(promoted.select("column_name"), "column_name", "left_semi").drop("column_name")
    return found.drop("_twin")


def field_mapping(fields: DataFrame) -> DataFrame:
    """Reference key (``attributes_string_service_name``) to dotted name, for
    renaming field references in documents."""
    return dotted_twins(fields).select(
        F.concat_ws(
            "_",
            F.when(F.col("type") == "attribute", F.lit("attributes")).otherwise(F.lit("resources")),
            F.lower("datatype"),
            _underscored(),
        ).alias("ref"),
        F.col("name").alias("new_name"),
    )


def drop_underscore_twins(fields: DataFrame) -> DataFrame:
    """Remove the underscore spelling wherever the dotted one exists."""
    dotted = (
        fields.where(F.contains("name", F.lit(".")))
        .select(_underscored().alias("name"), "datatype", "type")
        .distinct()
    )
    return fields.join(dotted, ["name", "datatype", "type"], "left_anti")


# ---- promotion -----------------------------------------------------------------


def promote_field(df: DataFrame, kind: str, name: str, dtype: str) -> DataFrame:
    """Add the promoted column and its ``_exists`` companion for one field of a
    typed-map table. Missing keys read as the type default."""
    dtype = dtype.lower()
    group = "number" if dtype in ("int64", "float64") else "bool" if dtype == "bool" else "string"
    source = F.col(f"{kind}s_{group}")
    column = f"{kind}_{group}_{name.replace('.', '$$')}"
    value = map_lookup(source, name, F.lit(DEFAULTS[group])).cast(SPARK_TYPES.get(dtype, "string"))
    return df.withColumns({column: value, f"{column}_exists": has_key(source, name)})


def promote_array_field(df: DataFrame, kind: str, name: str, dtype: str) -> DataFrame:
    """The same for a table that still keeps parallel key and value arrays."""
    dtype = dtype.lower()
    keys, values = F.col(f"{kind}s_{dtype}_key"), F.col(f"{kind}s_{dtype}_value")
    column = f"{kind}_{dtype}_{name.replace('.', '$$')}"
    default = {"string": F.lit(""), "bool": F.lit(False)}.get(dtype, F.lit(0)).cast(SPARK_TYPES.get(dtype, "string"))
    return df.withColumns(
        {
            column: array_lookup(keys, values, F.lit(name), default),
            f"{column}_exists": F.coalesce(F.array_contains(keys, name), F.lit(False)),
        }
    )


def class_column(fields: DataFrame) -> DataFrame:
    """Promoted column name and storage class of every field."""
    group = datatype_class(F.col("datatype"))
    return fields.withColumns(
        {"storage_class": group, "column_name": promoted_name(F.col("type"), group, F.col("name"))}
    )


def rename_promoted(df: DataFrame, fields: list[tuple[str, str, str]]) -> DataFrame:
    """Bulk rename of columns still called by their bare field name to
    ``<type>_<datatype>_<name>``; ``fields`` holds (type, datatype, name).
    Top-level fields and columns the table lacks are left alone."""
    present = set(df.columns)
    renames = {
        name: f"{kind.lower()}_{dtype.lower()}_{name}"
        for kind, dtype, name in fields
        if name in present and name not in TOP_LEVEL_FIELDS
    }
    return df.withColumnsRenamed(renames)


# ---- layout --------------------------------------------------------------------


def bloom_options(columns: list[tuple[str, str]], fpp: float = BLOOM_FPP) -> dict[str, str]:
    """Parquet writer options for bloom filters on promoted columns, given as
    (column, datatype). Booleans get none: two values are not worth a filter."""
    options = {}
    for column, dtype in columns:
        if dtype.lower() == "bool":
            continue
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.fpp#{column}"] = str(fpp)
    return options


def bloom_columns(fields: DataFrame) -> DataFrame:
    """The same decision as rows, for a whole catalog."""
    named = class_column(fields)
    return named.where(F.lower("datatype") != "bool").select(
        "column_name", F.concat("column_name", F.lit("_idx")).alias("index_name"), F.lit(BLOOM_FPP).alias("fpp")
    )


def stale_indexes(fields: DataFrame, layout: DataFrame) -> DataFrame:
    """Indexes of the current layout (rows with ``index_name``) that belong to
    listed, not top-level fields under their bare name and should go."""
    wanted = exclude_top_level(fields).select(F.concat("name", F.lit("_idx")).alias("index_name")).distinct()
    return layout.join(wanted, "index_name", "left_semi")
