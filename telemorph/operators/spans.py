"""Span tables: flat rows to the second layout, second to third, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions.hashing import resource_json
from telemorph.functions.maps import sorted_map
from telemorph.functions.scalars import int_to_bool, narrow_int, ts_bucket, ts_to_ns
from telemorph.operators.resources import fingerprint_resources

# Column order of the second layout's main table.
SPAN_V2_COLUMNS = [
    "timestamp", "traceID", "spanID", "parentSpanID", "serviceName", "name", "kind", "durationNano",
    "statusCode", "externalHttpMethod", "externalHttpUrl", "component", "dbSystem", "dbName",
    "dbOperation", "peerService", "events", "httpMethod", "httpUrl", "httpCode", "httpRoute",
    "httpHost", "msgSystem", "msgOperation", "hasError", "tagMap", "gRPCMethod", "gRPCCode",
]

# Old to new column names of the third layout, in its column order. The bucket
# and the resource fingerprint stand before these, the links after them.
SPAN_V3_NAMES = {
    "timestamp": "timestamp",
    "traceID": "trace_id",
    "spanID": "span_id",
    "parentSpanID": "parent_span_id",
    "name": "name",
    "kind": "kind",
    "spanKind": "kind_string",
    "durationNano": "duration_nano",
    "statusCode": "status_code",
    "statusMessage": "status_message",
    "statusCodeString": "status_code_string",
    "stringTagMap": "attributes_string",
    "numberTagMap": "attributes_number",
    "boolTagMap": "attributes_bool",
    "resourceTagsMap": "resources_string",
    "events": "events",
    "externalHttpMethod": "external_http_method",
    "externalHttpUrl": "external_http_url",
    "dbName": "db_name",
    "dbOperation": "db_operation",
    "httpMethod": "http_method",
    "httpUrl": "http_url",
    "httpHost": "http_host",
    "hasError": "has_error",
    "responseStatusCode": "response_status_code",
    "isRemote": "is_remote",
}


def upgrade_spans_v2(df: DataFrame, fix: bool = False) -> DataFrame:
    """Second-layout main rows. The gRPC columns stay empty as in the old job;
    ``fix=True`` carries them over."""
    return df.select(
        *[c for c in SPAN_V2_COLUMNS if c not in ("kind", "statusCode", "hasError", "gRPCMethod", "gRPCCode")],
        narrow_int(F.col("kind"), 8).alias("kind"),
        narrow_int(F.col("statusCode"), 16).alias("statusCode"),
        int_to_bool(F.col("hasError")).alias("hasError"),
        (F.col("gRPCMethod") if fix else F.lit("")).alias("gRPCMethod"),
        (F.col("gRPCCode") if fix else F.lit("")).alias("gRPCCode"),
    ).select(*SPAN_V2_COLUMNS)


def span_model_json(fix: bool = False) -> Column:
    """The nested span as JSON text; fields holding their zero value are left
    out. The start time is in whole seconds unless ``fix`` is set."""

    def text(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    def number(value: Column) -> Column:
        return F.nullif(value, F.lit(0).cast("bigint"))

    start = ts_to_ns(F.col("timestamp")) if fix else F.unix_seconds("timestamp")
    return F.to_json(
        F.struct(
            text("traceID").alias("traceId"),
            text("spanID").alias("spanId"),
            text("name").alias("name"),
            number(F.col("durationNano")).alias("durationNano"),
            number(start).alias("startTimeUnixNano"),
            text("serviceName").alias("serviceName"),
            number(narrow_int(F.col("kind"), 8).cast("bigint")).alias("kind"),
            text("references").alias("references"),
            number(narrow_int(F.col("statusCode"), 16).cast("bigint")).alias("statusCode"),
            F.when(F.size("tagMap") > 0, sorted_map(F.col("tagMap"))).alias("tagMap"),
            F.when(F.size("events") > 0, F.col("events")).alias("event"),
            F.when(int_to_bool(F.col("hasError")), F.lit(True)).alias("hasError"),
        )
    )


def span_models(df: DataFrame, fix: bool = False) -> DataFrame:
    return df.select("timestamp", "traceID", span_model_json(fix).alias("model"))


def upgrade_spans(df: DataFrame, fix: bool = False) -> dict[str, DataFrame]:
    """Main table and model table from one scan of the old rows."""
    return {"spans": upgrade_spans_v2(df, fix), "models": span_models(df, fix)}


def span_links(models: DataFrame) -> DataFrame:
    """Span id and its references as canonical JSON, ``null`` where a model has
    none. Models that are not JSON come out with a NULL span id."""
    model = F.try_parse_json("model")
    return models.select(
        "timestamp",
        "traceID",
        F.try_variant_get(model, "$.spanID", "string").alias("span_id"),
        F.coalesce(F.to_json(F.try_variant_get(model, "$.references", "variant")), F.lit("null")).alias("links"),
    )


def window_of(timestamp: str = "timestamp") -> Column:
    """The half hour a span or model belongs to."""
    return ts_bucket(F.unix_seconds(timestamp))


def link_rows(models: DataFrame, by_trace: bool = False) -> DataFrame:
    """(ts_bucket_start, spanID, links), or with traceID, of every span that a
    model names: the newest model of a window wins."""
    keys = ["ts_bucket_start", "spanID", *(["traceID"] if by_trace else [])]
    named = span_links(models).where(F.col("span_id").isNotNull()).withColumnRenamed("span_id", "spanID")
    return named.withColumn("ts_bucket_start", window_of()).groupBy(*keys).agg(F.max_by("links", F.struct("timestamp", "links")).alias("links"))


def attach_links(spans: DataFrame, models: DataFrame, by_trace: bool = False) -> DataFrame:
    """Add ``links`` to spans from the models of the same half hour by span id.
    The newest model of a span wins; spans without one get ``''``. ``by_trace``
    also matches the trace id. Spans that hold their ``ts_bucket_start`` keep it;
    stored by :func:`store_spans` they are joined where they lie, and only the
    narrow link rows move."""
    links = link_rows(models, by_trace)
    keys = [c for c in links.columns if c != "links"]
    placed = spans if "ts_bucket_start" in spans.columns else spans.withColumn("ts_bucket_start", window_of())
    found = placed.join(links, keys, "left").withColumn("links", F.coalesce("links", F.lit("")))
    return found.select(*spans.columns, "links")


def store_spans(spans: DataFrame, table: str, path: str | None = None, buckets: int = 512) -> DataFrame:
    """Spans as a table of daily partitions, bucketed by half hour and span id, so
    that the link join of any later run needs no exchange of the wide rows. If the
    table exists, the days that ``spans`` holds are replaced and others stay."""
    session = spans.sparkSession
    rows = spans.withColumn("ts_bucket_start", window_of()).withColumn("day", F.to_date(F.timestamp_seconds("ts_bucket_start")))
    # One exchange when the rows arrive: a bucket of a day is written by one task.
    bucket = F.pmod(F.hash("ts_bucket_start", "spanID"), F.lit(buckets))
    rows = rows.repartition("day", bucket)
    if session.catalog.tableExists(table):
        rows.select(*session.table(table).columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)
    else:
        writer = rows.write.partitionBy("day").bucketBy(buckets, "ts_bucket_start", "spanID").sortBy("ts_bucket_start", "spanID")
        (writer.option("path", path) if path else writer).saveAsTable(table)
    return session.table(table)


def unmatched_links(spans: DataFrame, models: DataFrame) -> DataFrame:
    """Spans no model of their half hour belongs to (report)."""
    ids = span_links(models).select(F.col("span_id").alias("spanID"), window_of().alias("ts_bucket_start"))
    keyed = spans.select("traceID", "spanID", window_of().alias("ts_bucket_start"))
    return keyed.join(ids, ["ts_bucket_start", "spanID"], "left_anti").select("traceID", "spanID")


def upgrade_spans_v3(df: DataFrame, *more: str) -> DataFrame:
    """Rename to the third layout; ``df`` must already hold ``links`` and any
    further columns to carry along."""
    return df.select(
        window_of().alias("ts_bucket_start"),
        *[F.col(old).alias(new) for old, new in SPAN_V3_NAMES.items()],
        "links",
        *more,
    )


def upgrade_spans_to_v3(spans: DataFrame, models: DataFrame, by_trace: bool = False) -> dict[str, DataFrame]:
    """Third-layout spans and their resource catalog."""
    # Resources need no links: the catalog is found without that join.
    labelled = spans.withColumn("_labels", resource_json(F.col("resourceTagsMap")))
    bucketed = labelled if "ts_bucket_start" in spans.columns else labelled.withColumn("ts_bucket_start", window_of())
    rows, catalog = fingerprint_resources(bucketed, "_labels")
    upgraded = upgrade_spans_v3(attach_links(rows, models, by_trace), "resource_fingerprint")
    ordered = ["ts_bucket_start", "resource_fingerprint", *SPAN_V3_NAMES.values(), "links"]
    return {"spans": upgraded.select(*ordered), "resources": catalog}
