"""Metric catalogs, name pairing, series rewriting and sample remapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemorph.functions import hashing, maps, scalars
from telemorph.operators import metrics
from telemorph.operators.sizing import staged
from telemorph.queries.oracle_inputs import hash_of, pair_bytes, text_bytes, with_
from telemorph.queries.registry import query
from telemorph.sources import derived as d

METRIC_OVERRIDES = "app_legacy_total=app.legacy.total, broken, =x"


def _overrides(t):
    spark = t.spark
    return {
        "metric_overrides": metrics.mapping_rows(spark, metrics.parse_overrides(METRIC_OVERRIDES)),
        "attribute_overrides": metrics.mapping_rows(spark, metrics.DEFAULT_ATTRIBUTE_OVERRIDES),
        "skip": metrics.mapping_rows(spark, {"app_unwanted": "true"}),
    }


def _series(t):
    """The catalog as a stored table, as the jobs find it."""
    return staged(d.series_v4(t))


def _mapping(t, series=None):
    return metrics.name_mapping(_series(t) if series is None else series, **_overrides(t))


def _details(t, series=None):
    m = _mapping(t, series)
    return staged(metrics.metric_details(m["pairs"], m["attributes"], metrics.attribute_class(d.attribute_metadata(t))))


# ---- first layout ------------------------------------------------------------------


@query("j01_attach_metric_name", with_("ev", """
    SELECT CASE WHEN event_type = 'signup' AND svc = 'svc9' THEN '' ELSE 'app_event_value' END AS metric_name,
           us // 1000 AS timestamp_ms, value FROM ev"""))
def j01(t):
    return metrics.attach_metric_name(d.samples_v1(t), d.series_v1(t)).select("metric_name", "timestamp_ms", "value")


@query("p10_metric_name", with_("series1", "SELECT labels, 'app_event_value' AS metric_name FROM series1"))
def p10(t):
    return d.series_v1(t).select("labels", metrics.metric_name(F.col("labels")).alias("metric_name"))


@query("p11_date_to_epoch", with_("series1", """
    SELECT labels, epoch_ms(CAST(d AS TIMESTAMP)) AS ms, epoch_ms(CAST(d AS TIMESTAMP)) // 1000 AS s FROM series1"""))
def p11(t):
    day = F.col("date")
    return d.series_v1(t).select("labels", scalars.date_to_epoch(day).alias("ms"), scalars.date_to_epoch(day, "s").alias("s"))


@query("a11_last_wins", with_("ev", """
    SELECT user_id, arg_max(event_type, ts) AS event_type FROM ev GROUP BY 1"""))
def a11(t):
    return metrics.last_wins(t.events, ["user_id"], ["ts", "event_id"], "event_type")


# ---- names -------------------------------------------------------------------------

CLEAN = "regexp_replace({}, '[^0-9A-Za-z]', '', 'g')"

PAIRS = f"""names AS (SELECT {CLEAN.format('metric_name')} AS nk, max(metric_name) FILTER (WHERE normalized) AS norm,
             max(mtype) FILTER (WHERE normalized) AS mtype, max(metric_name) FILTER (WHERE NOT normalized) AS orig
      FROM series4 GROUP BY 1),
    pairs AS (SELECT a.norm AS norm_name, coalesce(a.orig, b.orig) AS orig_name, a.mtype AS metric_type
      FROM names a LEFT JOIN names b ON a.orig IS NULL AND a.mtype = 'Summary' AND b.nk = a.nk || 'quantile'
      WHERE a.norm IS NOT NULL),
    resolved AS (SELECT norm_name, coalesce(orig_name, CASE norm_name WHEN 'app_legacy_total' THEN 'app.legacy.total' END) AS orig_name, metric_type FROM pairs)"""

KEYS = f"""keys AS (SELECT DISTINCT metric_name, normalized, key, {CLEAN.format('key')} AS clean
      FROM (SELECT metric_name, normalized, unnest(json_keys(labels)) AS key FROM series4) WHERE NOT starts_with(key, '__'))"""

ATTRS = """nk AS (SELECT p.norm_name, k.clean, max(k.key) AS norm_key FROM resolved p JOIN keys k ON k.metric_name = p.norm_name AND k.normalized GROUP BY 1, 2),
    ok AS (SELECT p.norm_name, k.clean, coalesce(min(k.key) FILTER (WHERE k.key LIKE '%.%'), min(k.key)) AS orig_key
           FROM resolved p JOIN keys k ON k.metric_name = p.orig_name AND NOT k.normalized GROUP BY 1, 2),
    matched AS (SELECT norm_name, norm_key, orig_key FROM nk JOIN ok USING (norm_name, clean)),
    merged AS (SELECT norm_key, arg_max(orig_key, norm_name) AS orig_key FROM matched GROUP BY 1),
    lone AS (SELECT nk.* FROM nk WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.norm_name = nk.norm_name AND ok.clean = nk.clean))"""

GIVEN = "(VALUES ('k8s_node_name', 'k8s.node.name'), ('quantile', 'quantile')) AS g(norm_key, given)"


@query("a07_distinct_metrics", with_("series4", "SELECT DISTINCT metric_name, mtype AS type, normalized FROM series4"))
def a07(t):
    return metrics.distinct_metrics(d.series_v4(t))


@query("p20_sanitize_name", with_("series4", f"""
    SELECT DISTINCT metric_name, {CLEAN.format('metric_name')} AS clean, labels, {CLEAN.format('labels')} AS clean_labels FROM series4"""))
def p20(t):
    clean = scalars.sanitize_name
    return d.series_v4(t).select(
        "metric_name", clean(F.col("metric_name")).alias("clean"), "labels", clean(F.col("labels")).alias("clean_labels")
    ).distinct()


@query("j04_pair_metrics", with_("series4", f"WITH {PAIRS} SELECT * FROM pairs"))
def j04(t):
    return metrics.pair_metrics(d.series_v4(t))


@query("j10_resolve_missing", with_("series4", f"WITH {PAIRS} SELECT * FROM resolved"))
def j10(t):
    return metrics.resolve_missing(metrics.pair_metrics(d.series_v4(t)), _overrides(t)["metric_overrides"])


@query("j11_skip_metrics", with_("series4", f"WITH {PAIRS} SELECT * FROM pairs WHERE norm_name <> 'app_latency'"))
def j11(t):
    skip = metrics.mapping_rows(t.spark, {"app_latency": "true", "absent": "true"})
    return metrics.skip_metrics(metrics.pair_metrics(d.series_v4(t)), skip)


@query("v05_unresolved_metrics", with_("series4", f"WITH {PAIRS} SELECT norm_name FROM pairs WHERE orig_name IS NULL"))
def v05(t):
    from telemorph.operators.verify import unresolved

    return unresolved(metrics.pair_metrics(d.series_v4(t)), "norm_name", "orig_name")


@query("v05_unresolved_attributes", with_("series4", f"""
    WITH {PAIRS}, {KEYS}, {ATTRS}
    SELECT DISTINCT l.norm_key FROM lone l WHERE l.norm_key NOT IN (SELECT norm_key FROM merged) AND l.norm_key <> 'quantile'"""))
def v05_attributes(t):
    given = _overrides(t) | {"attribute_overrides": metrics.mapping_rows(t.spark, {"quantile": "quantile"})}
    return metrics.name_mapping(_series(t), **given)["open_attributes"]


@query("a09_label_keys", with_("series4", f"WITH {KEYS} SELECT metric_name, normalized, key FROM keys"))
def a09(t):
    return metrics.label_keys(d.series_v4(t))


@query("j05_pair_attributes", with_("series4", f"WITH {PAIRS}, {KEYS}, {ATTRS} SELECT * FROM matched"))
def j05(t):
    series = _series(t)
    pairs = metrics.resolve_missing(metrics.pair_metrics(series), _overrides(t)["metric_overrides"])
    return metrics.pair_attributes(metrics.label_keys(series), pairs)


@query("j06_attribute_diff", with_("series4", f"""
    WITH {PAIRS}, {KEYS}, {ATTRS}
    SELECT norm_name, 'normalized' AS side, norm_key AS key FROM lone
    UNION ALL SELECT ok.norm_name, 'original', ok.orig_key FROM ok
    WHERE NOT EXISTS (SELECT 1 FROM nk WHERE ok.norm_name = nk.norm_name AND ok.clean = nk.clean)"""))
def j06(t):
    series = _series(t)
    pairs = metrics.resolve_missing(metrics.pair_metrics(series), _overrides(t)["metric_overrides"])
    return metrics.attribute_diff(metrics.label_keys(series), pairs)


@query("a14_merge_mappings", with_("series4", f"WITH {PAIRS}, {KEYS}, {ATTRS} SELECT * FROM merged"))
def a14(t):
    series = _series(t)
    pairs = metrics.resolve_missing(metrics.pair_metrics(series), _overrides(t)["metric_overrides"])
    return metrics.merge_mappings(metrics.pair_attributes(metrics.label_keys(series), pairs))


RESOLVED_ATTRS = f"""complete AS (SELECT norm_name, norm_key, orig_key, 'metric' AS source FROM matched UNION ALL
      SELECT l.norm_name, l.norm_key, coalesce(m.orig_key, g.given),
             CASE WHEN m.orig_key IS NOT NULL THEN 'merged' WHEN g.given IS NOT NULL THEN 'override' ELSE 'unresolved' END
      FROM lone l LEFT JOIN merged m USING (norm_key) LEFT JOIN {GIVEN} USING (norm_key))"""


@query("j12_resolve_attributes", with_("series4", f"WITH {PAIRS}, {KEYS}, {ATTRS}, {RESOLVED_ATTRS} SELECT * FROM complete"))
def j12(t):
    return _mapping(t)["attributes"]


@query("j12_global_mapping", with_("series4", f"""
    WITH {PAIRS}, {KEYS}, {ATTRS}
    SELECT norm_key, coalesce(g.given, m.orig_key) AS orig_key FROM merged m FULL JOIN {GIVEN} USING (norm_key)"""))
def j12_global(t):
    return _mapping(t)["global"]


# ---- attribute classes ---------------------------------------------------------------

METADATA = """meta AS (
    SELECT unnest(['service.name','service.name','k8s.node.name','scope.ver','event.type','quantile','user.' || (user_id % 10)]) AS attr_name,
           unnest(['resource','point','resource','scope','point','point','point']) AS attr_type FROM ev)"""


@query("a08_attribute_classes", with_("ev", f"WITH {METADATA} SELECT DISTINCT attr_name, attr_type FROM meta"))
def a08(t):
    return metrics.attribute_classes(d.attribute_metadata(t))


@query("a08_attribute_class_arrays", with_("ev", f"""
    WITH {METADATA} SELECT string_agg(DISTINCT attr_name, ',' ORDER BY attr_name) FILTER (WHERE attr_type = 'resource') AS resource_attrs,
      string_agg(DISTINCT attr_name, ',' ORDER BY attr_name) FILTER (WHERE attr_type = 'scope') AS scope_attrs,
      string_agg(DISTINCT attr_name, ',' ORDER BY attr_name) FILTER (WHERE attr_type = 'point') AS point_attrs FROM meta"""))
def a08_arrays(t):
    out = metrics.attribute_class_arrays(d.attribute_metadata(t))
    return out.select(*[F.array_join(c, ",").alias(c) for c in out.columns])


# ---- series --------------------------------------------------------------------------

NEW_SERIES = """fresh AS (SELECT DISTINCT fingerprint, metric_name, temporality, labels, event_type, node, svc,
        CASE metric_name WHEN 'app_event_value' THEN 'app.event.value' WHEN 'app_latency' THEN 'app.latency.quantile' ELSE 'app.legacy.total' END AS new_name
      FROM series4 WHERE normalized),
    hashed AS (SELECT *, """ + hash_of(
    "(CASE WHEN node IS NULL THEN []::HUGEINT[] ELSE " + pair_bytes("'k8s.node.name'", "node") + " END || "
    + pair_bytes("'service.name'", "svc")
    + " || CASE WHEN node IS NULL THEN []::HUGEINT[] ELSE " + pair_bytes("'scope.ver'", "'v1'") + " END || "
    + pair_bytes("'__temporality__'", "temporality")
    + " || CASE metric_name WHEN 'app_event_value' THEN " + pair_bytes("'event.type'", "coalesce(event_type, '')")
    + " WHEN 'app_latency' THEN " + pair_bytes("'quantile'", "'0.9'") + " ELSE []::HUGEINT[] END || "
    + text_bytes("'__name__'") + " || [255::HUGEINT] || " + text_bytes("new_name") + ")"
) + """ AS new_fingerprint,
        '{"__name__":"' || new_name || '","__temporality__":"' || temporality || '"' ||
        CASE metric_name WHEN 'app_event_value' THEN ',"event.type":"' || event_type || '","k8s.node.name":"' || node || '","scope.ver":"v1"'
             WHEN 'app_latency' THEN ',"quantile":"0.9"' ELSE '' END ||
        ',"service.name":"' || svc || '"}' AS new_labels
      FROM fresh)"""  # fmt: skip


def _rewritten(t):
    stored = _series(t)
    series = stored.where("normalized")
    return series, metrics.rewrite_series(series, _details(t, stored))


@query("p22_labels_map", with_("series4", """
    SELECT DISTINCT fingerprint, key, json_extract_string(labels, '$."' || key || '"') AS value
    FROM (SELECT fingerprint, labels, unnest(json_keys(labels)) AS key FROM series4)"""))
def p22(t):
    exploded = d.series_v4(t).select("fingerprint", F.explode(metrics.labels_map(F.col("labels"))))
    return exploded.select(F.col("fingerprint").cast("string").alias("fingerprint"), "key", "value").distinct()


@query("p23_rename_labels", with_("series4", """
    SELECT DISTINCT fingerprint, '{' || CASE WHEN event_type IS NULL THEN '' ELSE '"event.type":"' || event_type || '",' END ||
           '"service.name":"' || svc || '"}' AS renamed FROM series4 WHERE normalized"""))
def p23(t):
    mapping = F.create_map(F.lit("event_type"), F.lit("event.type"), F.lit("service_name"), F.lit("service.name"))
    renamed = metrics.rename_labels(metrics.labels_map(F.col("labels")), mapping)
    series = d.series_v4(t).where("normalized")
    return series.select(F.col("fingerprint").cast("string").alias("fingerprint"), maps.map_json(renamed).alias("renamed")).distinct()


@query("p24_classify_attrs", with_("series4", """
    SELECT DISTINCT fingerprint, 'resource' AS attr_class, 'service.name' AS key, svc AS value FROM series4 WHERE normalized
    UNION ALL SELECT DISTINCT fingerprint, 'resource', 'k8s.node.name', node FROM series4 WHERE normalized AND node IS NOT NULL
    UNION ALL SELECT DISTINCT fingerprint, 'scope', 'scope.ver', 'v1' FROM series4 WHERE normalized AND node IS NOT NULL
    UNION ALL SELECT DISTINCT fingerprint, 'point', 'event.type', event_type FROM series4 WHERE normalized AND event_type IS NOT NULL
    UNION ALL SELECT DISTINCT fingerprint, 'point', 'quantile', '0.9' FROM series4 WHERE normalized AND mtype = 'Summary'
    UNION ALL SELECT DISTINCT fingerprint, 'point', '__temporality__', temporality FROM series4 WHERE normalized"""))
def p24(t):
    _, out = _rewritten(t)
    parts = [
        out.select("fingerprint", F.lit(kind).alias("attr_class"), F.explode(column))
        for kind, column in (("resource", "new_resource_attrs"), ("scope", "new_scope_attrs"), ("point", "new_attrs"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        F.col("fingerprint").cast("string").alias("fingerprint"), "attr_class", "key", "value"
    )


@query("p25_series_fingerprint", with_("series4", f"WITH {NEW_SERIES} SELECT fingerprint, new_fingerprint FROM hashed"))
def p25(t):
    _, out = _rewritten(t)
    return out.select(
        F.col("fingerprint").cast("string").alias("fingerprint"), F.col("new_fingerprint").cast("string").alias("new_fingerprint")
    )


@query("p25_fingerprint", with_("ev", "SELECT DISTINCT event_type, svc, " + hash_of("(" + pair_bytes("'a.b'", "event_type") + " || " + pair_bytes("'service.name'", "svc") + ")") + " AS fingerprint FROM (SELECT DISTINCT event_type, svc FROM ev)"))
def p25_plain(t):
    labels = F.create_map(F.lit("service.name"), F.col("svc"), F.lit("a.b"), F.col("event_type"))
    distinct = d.events(t).select("event_type", "svc").distinct()
    return distinct.select("event_type", "svc", hashing.fingerprint(labels).cast("string").alias("fingerprint"))


@query("p26_labels_json", with_("ev", r"""
    SELECT event_id, '{"__name__":"m","a":"' || event_type || '\n\t\"q\"\\","z":"' || svc || '"}' AS labels FROM ev"""))
def p26(t):
    rough = F.concat("event_type", F.lit('\n\t"q"\\'))
    first = F.create_map(F.lit("z"), F.lit("lost"), F.lit("a"), rough)
    return d.events(t).select("event_id", hashing.labels_json(F.lit("m"), first, F.create_map(F.lit("z"), F.col("svc"))).alias("labels"))


@query("p21_temporality", with_("ev", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Cumulative' WHEN 1 THEN 'Delta' ELSE 'Unspecified' END AS temporality FROM ev"""))
def p21(t):
    r = F.col("event_id") % 4
    raw = F.when(r == 0, "Cumulative").when(r == 1, "Delta").when(r == 2, "delta")
    return t.events.select("event_id", scalars.temporality(raw).alias("temporality"))


@query("p31_upgrade_series", with_("series4", f"""
    WITH {NEW_SERIES}
    SELECT h.new_fingerprint AS fingerprint, h.new_name AS metric_name, s.hour_ms AS unix_milli, h.new_labels AS labels, FALSE AS normalized, s.mtype AS type
    FROM series4 s JOIN hashed h USING (fingerprint) WHERE s.normalized"""))
def p31(t):
    series, out = _rewritten(t)
    return metrics.upgrade_series(series, out).select(
        F.col("fingerprint").cast("string").alias("fingerprint"), "metric_name", "unix_milli", "labels", "normalized", "type"
    )


@query("p32_drop_reserved_keys", with_("series4", """
    SELECT DISTINCT labels, regexp_replace(labels, '"__name__":"[^"]*",', '') AS kept FROM series4"""))
def p32(t):
    kept = maps.map_json(maps.drop_reserved_keys(metrics.labels_map(F.col("labels"))))
    return d.series_v4(t).select("labels", kept.alias("kept")).distinct()


# ---- ranges and samples -----------------------------------------------------------------


@query("a04_first_normalized_ts", with_("series4", "SELECT min(hour_ms) AS first_ts FROM series4 WHERE normalized"))
def a04(t):
    return metrics.first_normalized_ts(d.series_v4(t))


CUT = """t0 AS (SELECT min(hour_ms) AS t0 FROM series4 WHERE NOT normalized),
    cut AS (SELECT min(ms) AS last_ts FROM points, t0 WHERE ms BETWEEN t0 - 3600000 AND t0 + 3600000
            AND fingerprint IN (SELECT fingerprint FROM series4, t0 WHERE NOT normalized AND hour_ms <= t0 + 3600000))"""


@query("a05_cutover_ts", with_("series4 points", f"WITH {CUT} SELECT last_ts FROM cut"))
def a05(t):
    return metrics.cutover_ts(d.series_v4(t), d.samples_v4(t))


@query("j03_samples_of_series", with_("points", """
    SELECT fingerprint, ms AS unix_milli, value FROM points
    WHERE ms > 1704844830000 AND ms <= 1704931230000 AND fingerprint IN (
      SELECT fingerprint FROM points WHERE normalized AND hour_ms BETWEEN 1704844800000 AND 1704934800000)"""))
def j03(t):
    wanted = metrics.samples_of_series(d.samples_v4(t), d.series_v4(t).where("normalized"), 1_704_844_830_000, 1_704_931_230_000)
    return wanted.select(F.col("fingerprint").cast("string").alias("fingerprint"), "unix_milli", "value")


@query("j08_fingerprint_map", with_("series4", f"""
    WITH {NEW_SERIES} SELECT fingerprint, new_fingerprint, new_name AS new_metric_name FROM hashed"""))
def j08(t):
    series, out = _rewritten(t)
    fp = metrics.fingerprint_map(series, out)
    return fp.select(
        F.col("fingerprint").cast("string").alias("fingerprint"), F.col("new_fingerprint").cast("string").alias("new_fingerprint"), "new_metric_name"
    )


def _bounds(series, samples):
    first = metrics.first_normalized_ts(series).first()["first_ts"]
    return first, metrics.cutover_ts(series, samples).first()["last_ts"]


@query("p30_remap_samples", with_("series4 points", f"""
    WITH {NEW_SERIES}, {CUT}
    SELECT h.new_name AS metric_name, h.new_fingerprint AS fingerprint, p.ms AS unix_milli, p.value, p.temporality
    FROM points p JOIN hashed h USING (fingerprint), cut
    WHERE p.ms >= (SELECT min(hour_ms) FROM series4 WHERE normalized) AND p.ms < cut.last_ts"""))
def p30(t):
    series, samples = _series(t), d.samples_v4(t)
    first, last = _bounds(series, samples)
    out = metrics.upgrade_metrics(series, samples, _details(t, series), first, last)["samples"]
    return out.select("metric_name", F.col("fingerprint").cast("string").alias("fingerprint"), "unix_milli", "value", "temporality")


@query("p30_remap_samples_inside_hour", with_("series4 points", f"""
    WITH {NEW_SERIES}, {CUT}
    SELECT h.new_name AS metric_name, h.new_fingerprint AS fingerprint, p.ms AS unix_milli, p.value, p.temporality
    FROM points p JOIN hashed h USING (fingerprint), cut
    WHERE p.ms >= (SELECT min(hour_ms) + 1800000 FROM series4 WHERE normalized) AND p.ms < cut.last_ts - 1500000"""))
def p30_inside_hour(t):
    """Both bounds lie inside an hour, whose catalog rows bear the full hour."""
    series, samples = _series(t), d.samples_v4(t)
    first, last = _bounds(series, samples)
    out = metrics.upgrade_metrics(series, samples, _details(t, series), first + 1_800_000, last - 1_500_000)["samples"]
    return out.select("metric_name", F.col("fingerprint").cast("string").alias("fingerprint"), "unix_milli", "value", "temporality")


@query("j08_quarantine", with_("series4 points", """
    SELECT 'series' AS kind, metric_name, count(*) AS n FROM series4 WHERE normalized AND metric_name = 'app_legacy_total' GROUP BY 2
    UNION ALL SELECT 'samples', metric_name, count(*) FROM points WHERE normalized AND metric_name = 'app_legacy_total' GROUP BY 2"""))
def j08_quarantine(t):
    """Without an override the counter has no original name: its series and
    samples are reported instead of being written under an empty name."""
    given = _overrides(t) | {"skip": metrics.mapping_rows(t.spark, {"app_legacy_total": "true"})}
    series, samples = _series(t), d.samples_v4(t)
    m = metrics.name_mapping(series, **given)
    details = metrics.metric_details(m["pairs"], m["attributes"], metrics.attribute_class(d.attribute_metadata(t)))
    first, last = _bounds(series, samples)
    out = metrics.upgrade_metrics(series, samples, staged(details), first, last)
    return (
        out["quarantined_series"].select(F.lit("series").alias("kind"), "metric_name")
        .unionByName(out["unmatched_samples"].select(F.lit("samples").alias("kind"), "metric_name"))
        .groupBy("kind", "metric_name").agg(F.count(F.lit(1)).alias("n"))
    )
