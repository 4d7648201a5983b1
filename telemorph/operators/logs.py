"""Log rows: parallel attribute arrays to typed maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemorph.functions.hashing import resource_json
from telemorph.functions.maps import arrays_to_map, empty_map, merge_number_attrs
from telemorph.functions.scalars import int_div, ts_bucket
from telemorph.operators.resources import fingerprint_resources

LOG_V2_COLUMNS = [
    "ts_bucket_start", "resource_fingerprint", "timestamp", "observed_timestamp", "id", "trace_id",
    "span_id", "trace_flags", "severity_text", "severity_number", "body", "attributes_string",
    "attributes_number", "attributes_bool", "resources_string", "scope_name", "scope_version",
    "scope_string",
]


def upgrade_logs_v2(df: DataFrame) -> DataFrame:
    """Typed maps, time bucket, and defaults for the fields the old layout does
    not have. The fingerprint is added by ``upgrade_logs``."""
    return df.select(
        ts_bucket(int_div(F.col("timestamp"), 1_000_000_000)).alias("ts_bucket_start"),
        "timestamp",
        F.lit(0).cast("bigint").alias("observed_timestamp"),
        "id",
        "trace_id",
        "span_id",
        "trace_flags",
        "severity_text",
        "severity_number",
        "body",
        arrays_to_map(F.col("attributes_string_key"), F.col("attributes_string_value")).alias("attributes_string"),
        merge_number_attrs(
            F.col("attributes_int64_key"),
            F.col("attributes_int64_value"),
            F.col("attributes_float64_key"),
            F.col("attributes_float64_value"),
        ).alias("attributes_number"),
        arrays_to_map(F.col("attributes_bool_key"), F.col("attributes_bool_value")).alias("attributes_bool"),
        arrays_to_map(F.col("resources_string_key"), F.col("resources_string_value")).alias("resources_string"),
        F.lit("").alias("scope_name"),
        F.lit("").alias("scope_version"),
        empty_map().alias("scope_string"),
    )


def upgrade_logs(df: DataFrame) -> dict[str, DataFrame]:
    """Second-layout logs and their resource catalog."""
    rows = upgrade_logs_v2(df).withColumn("_labels", resource_json(F.col("resources_string")))
    rows, catalog = fingerprint_resources(rows, "_labels")
    return {"logs": rows.select(*LOG_V2_COLUMNS), "resources": catalog}
