"""Metric series and samples: catalog moves, pairing of the two name spellings,
label rewriting and fingerprint changes.

"Normalized" names have their special characters replaced by underscores; the
upgrade maps them back to the original, dotted names.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemorph.functions.hashing import labels_json, series_fingerprint, with_extras
from telemorph.functions.scalars import align_to_hour, date_to_epoch, sanitize_name, temporality
from telemorph.operators.scans import scan_range
from telemorph.operators.sizing import staged

TEMPORALITY_LABEL = "__temporality__"

# Attribute names that are known not to pair up by spelling.
DEFAULT_ATTRIBUTE_OVERRIDES = {"k8s_node_name": "k8s.node.name", "quantile": "quantile"}

CLASS_ORDER = ["resource", "scope", "point"]


# ---- first layout ---------------------------------------------------------------


def metric_name(labels: Column) -> Column:
    return F.coalesce(F.get_json_object(labels, "$.__name__"), F.lit(""))


def last_wins(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """One row per key: the value with the largest order columns."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def attach_metric_name(samples: DataFrame, series: DataFrame) -> DataFrame:
    """Add the metric name to samples by fingerprint; ``''`` when unknown."""
    names = last_wins(
        series.select("fingerprint", "date", metric_name(F.col("labels")).alias("metric_name")),
        ["fingerprint"],
        ["date", "metric_name"],
        "metric_name",
    )
    return samples.join(names, "fingerprint", "left").select(
        F.coalesce("metric_name", F.lit("")).alias("metric_name"), "fingerprint", "timestamp_ms", "value"
    )


def move_time_series(series: DataFrame, unit: str = "ms") -> DataFrame:
    """Catalog rows of the second layout. ``unit='s'`` reproduces the old job,
    which put seconds into the millisecond column."""
    return series.select(
        metric_name(F.col("labels")).alias("metric_name"),
        "fingerprint",
        date_to_epoch(F.col("date"), unit).alias("timestamp_ms"),
        "labels",
        F.parse_json("labels").alias("labels_object"),
    )


# ---- pairing of metric names ----------------------------------------------------


def distinct_metrics(series: DataFrame) -> DataFrame:
    return series.select("metric_name", "type", "normalized").distinct()


def pair_metrics(series: DataFrame) -> DataFrame:
    """Normalized to original metric name, by equality of the names without
    special characters; NULL when there is no original. Of several names with
    one key the last in name order is taken. A Summary without an original falls
    back to the original of ``<key>quantile``."""
    by_key = (
        distinct_metrics(series)
        .groupBy(sanitize_name(F.col("metric_name")).alias("name_key"))
        .agg(
            F.max(F.when(F.col("normalized"), F.struct("metric_name", "type"))).alias("norm"),
            F.max(F.when(~F.col("normalized"), F.col("metric_name"))).alias("orig_name"),
        )
    )
    fallback = by_key.select(
        F.col("name_key").alias("fallback_key"), F.col("orig_name").alias("fallback_name")
    ).where(F.col("fallback_name").isNotNull())
    normalized = by_key.where(F.col("norm").isNotNull()).withColumn(
        "fallback_key",
        F.when(
            F.col("orig_name").isNull() & (F.col("norm.type") == "Summary"),
            F.concat("name_key", F.lit("quantile")),
        ),
    )
    return normalized.join(fallback, "fallback_key", "left").select(
        F.col("norm.metric_name").alias("norm_name"),
        F.coalesce("orig_name", "fallback_name").alias("orig_name"),
        F.col("norm.type").alias("metric_type"),
    )


def parse_overrides(text: str | None, defaults: dict[str, str] | None = None) -> dict[str, str]:
    """``a=b,c=d`` over a default map; incomplete pairs are ignored."""
    merged = dict(defaults or {})
    for part in (text or "").split(","):
        name, found, target = part.partition("=")
        if found and name.strip() and target.strip():
            merged[name.strip()] = target.strip()
    return merged


def mapping_rows(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """A configuration map as rows."""
    return spark.createDataFrame(sorted(mapping.items()), "name string, target string")


def resolve_missing(pairs: DataFrame, overrides: DataFrame) -> DataFrame:
    """Fill pairs without an original from ``overrides`` (name, target)."""
    given = overrides.select(F.col("name").alias("norm_name"), "target")
    return pairs.join(given, "norm_name", "left").select(
        "norm_name", F.coalesce("orig_name", "target").alias("orig_name"), "metric_type"
    )


def skip_metrics(pairs: DataFrame, skip: DataFrame) -> DataFrame:
    """Leave out the metrics listed in ``skip`` (name)."""
    return pairs.join(skip.select(F.col("name").alias("norm_name")), "norm_name", "left_anti")


# ---- pairing of attribute names ---------------------------------------------------


def label_keys(series: DataFrame) -> DataFrame:
    """Distinct label keys per metric, without reserved ones."""
    return (
        series.select("metric_name", "normalized", F.explode(F.json_object_keys("labels")).alias("key"))
        .where(~F.startswith("key", F.lit("__")))
        .distinct()
    )


def _keys_of(keys: DataFrame, pairs: DataFrame, normalized: bool) -> DataFrame:
    """Keys per (pair, key without special characters)."""
    name = "norm_name" if normalized else "orig_name"
    side = keys.where(F.col("normalized") == F.lit(normalized)).withColumnRenamed("metric_name", name)
    rows = side.join(pairs.select("norm_name", "orig_name").where(F.col("orig_name").isNotNull()), name)
    grouped = rows.groupBy("norm_name", sanitize_name(F.col("key")).alias("clean"))
    if normalized:
        return grouped.agg(F.max("key").alias("norm_key"))
    # A spelling with a dot is preferred, then name order.
    preferred = F.min(F.struct((~F.contains("key", F.lit("."))).alias("undotted"), F.col("key")))
    return grouped.agg(preferred["key"].alias("orig_key"))


def pair_attributes(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per metric pair, label keys that agree without special characters:
    (norm_name, norm_key, orig_key). ``keys`` comes from ``label_keys``."""
    norm, orig = _keys_of(keys, pairs, True), _keys_of(keys, pairs, False)
    return norm.join(orig, ["norm_name", "clean"]).select("norm_name", "norm_key", "orig_key")


def attribute_diff(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """Keys only one of the two spellings has: (norm_name, side, key)."""
    norm, orig = _keys_of(keys, pairs, True), _keys_of(keys, pairs, False)
    on = ["norm_name", "clean"]
    only_norm = norm.join(orig, on, "left_anti").select("norm_name", F.lit("normalized").alias("side"), F.col("norm_key").alias("key"))
    only_orig = orig.join(norm, on, "left_anti").select("norm_name", F.lit("original").alias("side"), F.col("orig_key").alias("key"))
    return only_norm.unionByName(only_orig)


def merge_mappings(attributes: DataFrame) -> DataFrame:
    """One key mapping over all metrics; the last metric in name order wins."""
    return (
        attributes.groupBy("norm_key")
        .agg(F.max_by("orig_key", F.struct("norm_name", "orig_key")).alias("orig_key"))
    )


def resolve_attributes(attributes: DataFrame, one_sided: DataFrame, merged: DataFrame, overrides: DataFrame) -> DataFrame:
    """Complete mapping rows (norm_name, norm_key, orig_key, source). A key only
    the normalized spelling has is looked up in the mapping of all metrics, then
    in the overrides; ``orig_key`` stays NULL where neither knows it."""
    missing = one_sided.where(F.col("side") == "normalized").select("norm_name", F.col("key").alias("norm_key"))
    everywhere = merged.select("norm_key", F.col("orig_key").alias("merged_key"))
    given = overrides.select(F.col("name").alias("norm_key"), F.col("target").alias("given_key"))
    resolved = (
        missing.join(everywhere, "norm_key", "left")
        .join(given, "norm_key", "left")
        .select(
            "norm_name",
            "norm_key",
            F.coalesce("merged_key", "given_key").alias("orig_key"),
            F.when(F.col("merged_key").isNotNull(), F.lit("merged"))
            .when(F.col("given_key").isNotNull(), F.lit("override"))
            .otherwise(F.lit("unresolved"))
            .alias("source"),
        )
    )
    return attributes.withColumn("source", F.lit("metric")).unionByName(resolved)


def global_mapping(merged: DataFrame, overrides: DataFrame) -> DataFrame:
    """The mapping over all metrics with every override written over it."""
    given = overrides.select(F.col("name").alias("norm_key"), F.col("target").alias("given_key"))
    return merged.join(given, "norm_key", "full").select(
        "norm_key", F.coalesce("given_key", "orig_key").alias("orig_key")
    )


# ---- attribute classes ------------------------------------------------------------


def attribute_classes(metadata: DataFrame) -> DataFrame:
    """Distinct attribute names per class, as rows for joins."""
    return metadata.where(F.col("attr_type").isin(CLASS_ORDER)).select("attr_type", "attr_name").distinct()


def attribute_class_arrays(metadata: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """The same as three sorted arrays in one row. Only distinct names reach the
    final task; when there are more than ``limit`` this refuses, and the row form
    above, which has no such bound, must be used."""
    classes = attribute_classes(metadata)
    if classes.count() > limit:
        raise ValueError("too many attribute names for arrays: use attribute_classes")
    return classes.agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("attr_type") == kind, F.col("attr_name")))).alias(f"{kind}_attrs")
            for kind in CLASS_ORDER
        ]
    )


def attribute_class(metadata: DataFrame) -> DataFrame:
    """One class per name: resource before scope before point."""
    rank = F.min(F.array_position(F.array(*map(F.lit, CLASS_ORDER)), F.col("attr_type")))
    return (
        metadata.where(F.col("attr_type").isin(CLASS_ORDER))
        .groupBy("attr_name")
        .agg(rank.alias("rank"))
        .select("attr_name", F.element_at(F.array(*map(F.lit, CLASS_ORDER)), F.col("rank").cast("int")).alias("attr_class"))
    )


# ---- series and samples -------------------------------------------------------------


def labels_map(labels: Column) -> Column:
    return F.from_json(labels, "map<string,string>")


def rename_labels(labels: Column, mapping: Column) -> Column:
    """Rename the keys of a label map; keys without a mapping are dropped."""
    renamed = F.transform(
        F.map_entries(labels),
        lambda e: F.struct(F.try_element_at(mapping, e["key"]).alias("key"), e["value"].alias("value")),
    )
    return F.map_from_entries(F.filter(renamed, lambda e: e["key"].isNotNull()))


def classify_attrs(labels: Column, classes: Column) -> tuple[Column, Column, Column]:
    """Split a label map into (resource, scope, point) by a key-to-class map;
    keys without a class are dropped."""

    def of(kind: str) -> Column:
        return F.map_filter(labels, lambda k, _: F.coalesce(F.try_element_at(classes, k) == kind, F.lit(False)))

    return tuple(of(kind) for kind in CLASS_ORDER)


def metric_details(pairs: DataFrame, attributes: DataFrame, classes: DataFrame) -> DataFrame:
    """Per metric: original name, key mapping and class of each original key.
    What is gathered per metric are its distinct label keys (its schema)."""
    entries = (
        attributes.where(F.col("orig_key").isNotNull())
        .join(classes, F.col("orig_key") == F.col("attr_name"), "left")
        .groupBy("norm_name")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("norm_key", "orig_key"))).alias("key_map"),
            F.map_from_entries(
                F.collect_set(F.when(F.col("attr_class").isNotNull(), F.struct("orig_key", "attr_class")))
            ).alias("class_map"),
        )
    )
    empty = F.create_map().cast("map<string,string>")
    return pairs.join(entries, "norm_name", "left").select(
        F.col("norm_name").alias("metric_name"),
        "orig_name",
        F.coalesce("key_map", empty).alias("key_map"),
        F.coalesce("class_map", empty).alias("class_map"),
    )


# What a sample names its series by, and a catalog row with its labels.
IDENTITY = ["fingerprint", "metric_name", "temporality"]
SERIES_KEY = [*IDENTITY, "labels_id"]


def with_labels_id(series: DataFrame) -> DataFrame:
    """Series with the SHA-256 of their label text, which stands for the text in
    joins and groupings."""
    return series if "labels_id" in series.columns else series.withColumn("labels_id", F.unhex(F.sha2("labels", 256)))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, nulls equal; the columns of ``left``, then the others of ``right``."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_{k}" for k in keys])


def rewrite_series(series: DataFrame, details: DataFrame) -> DataFrame:
    """New identity of each distinct series: original name, attribute maps,
    fingerprint and labels text. Rows of metrics without details drop out (see
    ``unmapped_series``). The label text moves once, to its series."""
    keyed = with_labels_id(series).groupBy(*SERIES_KEY).agg(F.any_value("labels").alias("labels"))
    distinct = keyed.join(details, "metric_name")
    renamed = distinct.withColumn("_labels", rename_labels(labels_map(F.col("labels")), F.col("key_map")))
    resource, scope, point = classify_attrs(F.col("_labels"), F.col("class_map"))
    split = renamed.withColumns(
        {
            "new_resource_attrs": resource,
            "new_scope_attrs": scope,
            "new_attrs": with_extras(point, {TEMPORALITY_LABEL: temporality(F.col("temporality"))}),
        }
    )
    return split.select(
        *SERIES_KEY,
        F.col("orig_name").alias("new_metric_name"),
        "new_resource_attrs",
        "new_scope_attrs",
        "new_attrs",
        series_fingerprint(
            F.col("new_resource_attrs"), F.col("new_scope_attrs"), F.col("new_attrs"), F.col("orig_name")
        ).alias("new_fingerprint"),
        labels_json(
            F.col("orig_name"), F.col("new_attrs"), F.col("new_scope_attrs"), F.col("new_resource_attrs")
        ).alias("new_labels"),
    )


def upgrade_series(series: DataFrame, rewritten: DataFrame) -> DataFrame:
    """Series rows under their new identity, no longer flagged as normalized."""
    bare = with_labels_id(series).drop("labels")
    return join_null_safe(bare, with_labels_id(rewritten).drop("labels"), SERIES_KEY).select(
        "env",
        "temporality",
        F.col("new_metric_name").alias("metric_name"),
        "description",
        "unit",
        "type",
        "is_monotonic",
        F.col("new_fingerprint").alias("fingerprint"),
        "unix_milli",
        F.col("new_labels").alias("labels"),
        F.col("new_attrs").alias("attrs"),
        F.col("new_scope_attrs").alias("scope_attrs"),
        F.col("new_resource_attrs").alias("resource_attrs"),
        F.lit(False).alias("normalized"),
    )


def unmapped_series(series: DataFrame, details: DataFrame) -> DataFrame:
    """Series rows of skipped or unpaired metrics (quarantine)."""
    return series.join(details.select("metric_name"), "metric_name", "left_anti")


def fingerprint_map(series: DataFrame, rewritten: DataFrame) -> DataFrame:
    """New fingerprint and name of every old identity (fingerprint, name,
    temporality). Where one has several label texts, its oldest row decides."""
    oldest = with_labels_id(series).groupBy(*SERIES_KEY).agg(F.min("unix_milli").alias("first_ms"))
    rewritten = with_labels_id(rewritten).select(*SERIES_KEY, "new_fingerprint", "new_metric_name")
    choice = F.struct(F.col("first_ms"), F.col("new_fingerprint"))
    return (
        join_null_safe(oldest, rewritten, SERIES_KEY)
        .groupBy(*IDENTITY)
        .agg(F.min_by(F.struct("new_fingerprint", "new_metric_name"), choice).alias("to"))
        .select(*IDENTITY, "to.new_fingerprint", "to.new_metric_name")
    )


def samples_of_series(samples: DataFrame, series: DataFrame, start_ms: int, end_ms: int, closed: str = "(]") -> DataFrame:
    """Samples in the range whose fingerprint is in the catalog of the range
    widened to full hours."""
    lower, upper = align_to_hour(F.lit(start_ms).cast("bigint"), F.lit(end_ms).cast("bigint"))
    wanted = series.where(F.col("unix_milli").between(lower, upper)).select("fingerprint").distinct()
    return scan_range(samples, "unix_milli", start_ms, end_ms, closed).join(wanted, "fingerprint", "left_semi")


def matched_samples(samples: DataFrame, catalog: DataFrame, fp_map: DataFrame) -> DataFrame:
    """Samples whose fingerprint is in the catalog, with the new fingerprint and
    name of their identity, null where no rewritten series claims them. What a
    fingerprint's few identities become is gathered first, so the samples meet
    one table by one key; a fingerprint that many samples share is split at run
    time by the skew rule (see the session)."""
    become = F.collect_list(F.struct("metric_name", "temporality", "new_fingerprint", "new_metric_name")).alias("_become")
    known = catalog.select("fingerprint").distinct().join(fp_map.groupBy("fingerprint").agg(become), "fingerprint", "left")
    same = F.filter("_become", lambda b: b["metric_name"].eqNullSafe(F.col("metric_name")) & b["temporality"].eqNullSafe(F.col("temporality")))
    found = samples.join(known, "fingerprint").withColumn("_to", F.try_element_at(same, F.lit(1)))
    return found.select(*samples.columns, "_to.new_fingerprint", "_to.new_metric_name")


def remap_samples(matched: DataFrame) -> DataFrame:
    """Matched samples under their new fingerprint and metric name."""
    return matched.where(F.col("new_fingerprint").isNotNull()).select(
        "env",
        "temporality",
        F.col("new_metric_name").alias("metric_name"),
        F.col("new_fingerprint").alias("fingerprint"),
        "unix_milli",
        "value",
        "flags",
    )


def unmatched_samples(matched: DataFrame) -> DataFrame:
    """Samples no rewritten series claims (report)."""
    return matched.where(F.col("new_fingerprint").isNull()).drop("new_fingerprint", "new_metric_name")


# ---- the range to upgrade ------------------------------------------------------------


def first_normalized_ts(series: DataFrame) -> DataFrame:
    return series.where("normalized").agg(F.min("unix_milli").alias("first_ts"))


def cutover_ts(series: DataFrame, samples: DataFrame) -> DataFrame:
    """Earliest sample of an original series within an hour of the first
    original series row."""
    originals = series.where(~F.col("normalized"))
    begin = originals.agg(F.min("unix_milli").alias("t0")).scalar()
    hour = F.lit(3_600_000)
    ids = originals.where(F.col("unix_milli") <= begin + hour).select("fingerprint").distinct()
    near = samples.where((F.col("unix_milli") >= begin - hour) & (F.col("unix_milli") <= begin + hour))
    return near.join(ids, "fingerprint", "left_semi").agg(F.min("unix_milli").alias("last_ts"))


# ---- the whole job ----------------------------------------------------------------


def name_mapping(series: DataFrame, metric_overrides: DataFrame, attribute_overrides: DataFrame, skip: DataFrame) -> dict[str, DataFrame]:
    """Metric pairs and attribute rows of the upgrade, with what stays open."""
    # All as small as the name catalog, and read by several steps.
    resolved, keys = staged(resolve_missing(pair_metrics(series), metric_overrides)), staged(label_keys(series))
    pairs = skip_metrics(resolved, skip)
    attributes = staged(pair_attributes(keys, pairs))
    merged = merge_mappings(attributes)
    complete = resolve_attributes(attributes, attribute_diff(keys, pairs), merged, attribute_overrides)
    return {
        "pairs": pairs,
        "attributes": complete,
        "global": global_mapping(merged, attribute_overrides),
        "open_metrics": resolved.where(F.col("orig_name").isNull()).select("norm_name"),
        "open_attributes": complete.where(F.col("source") == "unresolved").select("norm_key").distinct(),
    }


def upgrade_metrics(series: DataFrame, samples: DataFrame, details: DataFrame, first_ms: int, last_ms: int) -> dict[str, DataFrame]:
    """Rewrite the normalized series and samples in ``[first_ms, last_ms)``.
    Catalog rows bear the full hour, so identities come from the range widened
    to full hours: samples of an hour that a bound cuts find theirs. They feed
    three outputs and are staged once."""
    lower, upper = align_to_hour(F.lit(first_ms).cast("bigint"), F.lit(last_ms).cast("bigint"))
    catalog = with_labels_id(series.where("normalized").where(F.col("unix_milli").between(lower, upper)))
    old = scan_range(catalog, "unix_milli", first_ms, last_ms, "[)")
    rewritten = staged(rewrite_series(catalog, details))
    wanted = scan_range(samples, "unix_milli", first_ms, last_ms, "[)")
    matched = matched_samples(wanted, catalog, fingerprint_map(catalog, rewritten))
    return {
        "series": upgrade_series(old, rewritten),
        "samples": remap_samples(matched),
        "quarantined_series": unmapped_series(old, details),
        "unmatched_samples": unmatched_samples(matched),
    }
