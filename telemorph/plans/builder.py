"""Evaluating builder queries over logs, spans and metrics.

The model names its operators but defines little of what they compute; the
definitions here are this package's own and are stated at each function. Times
are epoch milliseconds, ranges are ``[start, end)``. Results are long: one row
per (query_name, ts, labels, value), labels being canonical JSON text.
"""

from __future__ import annotations

import ast
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemorph.functions.maps import DEFAULTS, has_key, map_json, map_lookup
from telemorph.functions.scalars import int_div
from telemorph.operators.quantiles import exact_percentiles
from telemorph.plans import spec as S

# ---- table adapters ------------------------------------------------------------------


# Series rows bear the full hour.
HOUR_MS = 3_600_000


@dataclass
class Source:
    """A telemetry table: its rows, epoch milliseconds, and how keys are stored.
    Metrics keep all keys in one label map, in series rows beside the samples."""

    kind: str
    df: DataFrame
    ts_ms: Column
    labels: str | None = None
    series: DataFrame | None = None

    def catalog(self, metric: str | None, start: int, end: int) -> DataFrame:
        """(fingerprint, label_map) of the series with samples in ``[start, end)``.
        Series rows bear the full hour of their samples; the conditions are on
        stored columns, so other metrics and times are not read."""
        rows = self.series.where((F.col("unix_milli") >= start // HOUR_MS * HOUR_MS) & (F.col("unix_milli") < end))
        if metric:
            rows = rows.where(F.col("metric_name") == metric)
        one = rows.groupBy("fingerprint").agg(F.max("labels").alias("_labels"))
        return one.select("fingerprint", F.from_json("_labels", "map<string,string>").alias(self.labels))

    def column(self, key: dict) -> tuple[Column, Column]:
        """Value (the type default where missing) and presence of a key."""
        name = key["key"]
        if self.labels is not None:
            attrs = F.col(self.labels)
            return map_lookup(attrs, name, F.lit("")), has_key(attrs, name)
        if key.get("isColumn"):
            column = F.col(f"`{name}`")
            return column, column.isNotNull()
        if key.get("type") == "resource":
            attrs, group = F.col("resources_string"), "string"
        else:
            group = {"int64": "number", "float64": "number", "bool": "bool"}.get(key.get("dataType", ""), "string")
            attrs = F.col(f"attributes_{group}")
        return map_lookup(attrs, name, F.lit(DEFAULTS[group])), has_key(attrs, name)


def logs_source(logs: DataFrame) -> Source:
    return Source("logs", logs, int_div(F.col("timestamp"), 1_000_000))


def traces_source(spans: DataFrame) -> Source:
    return Source("traces", spans, F.unix_millis("timestamp"))


def metrics_source(samples: DataFrame, series: DataFrame) -> Source:
    """Samples and the hourly rows of their series."""
    return Source("metrics", samples, F.col("unix_milli"), "label_map", series)


# ---- filters ----------------------------------------------------------------------------


def _bound(value, variables: dict):
    """Put variables (``$x``, ``{{.x}}``, ``{{x}}``) into a filter value."""
    if isinstance(value, list):
        return [_bound(v, variables) for v in value]
    if isinstance(value, str):
        for name, given in variables.items():
            if value in (f"${name}", f"{{{{.{name}}}}}", f"{{{{{name}}}}}"):
                return given
    return value


def filter_condition(source: Source, item: dict, variables: dict | None = None, ignore_case: bool = False) -> Column:
    """One filter. Comparisons see the type default where the key is missing."""
    value, present = source.column(item["key"])
    given = _bound(item.get("value"), variables or {})
    many = given if isinstance(given, list) else [given]
    matches = value.ilike(given) if ignore_case and isinstance(given, str) else None
    operator = item["op"].lower()
    text = value.cast("string")
    conditions = {
        "=": lambda: value == given,
        "!=": lambda: value != given,
        ">": lambda: value > given,
        ">=": lambda: value >= given,
        "<": lambda: value < given,
        "<=": lambda: value <= given,
        "in": lambda: value.isin(many),
        "nin": lambda: ~value.isin(many),
        "contains": lambda: text.contains(given),
        "ncontains": lambda: ~text.contains(given),
        "regex": lambda: text.rlike(given),
        "nregex": lambda: ~text.rlike(given),
        "like": lambda: text.like(given) if matches is None else matches,
        "nlike": lambda: ~(text.like(given) if matches is None else matches),
        "exists": lambda: present,
        "nexists": lambda: ~present,
    }
    if operator not in conditions:
        raise S.InvalidSpec(f"invalid operator: {item['op']}")
    return conditions[operator]()


def filter_set(source: Source, filters: dict | None, variables: dict | None = None, ignore_case: bool = False) -> Column:
    items = (filters or {}).get("items") or []
    if not items:
        return F.lit(True)
    combine = or_ if (filters.get("op") or "AND") == "OR" else and_
    return reduce(combine, [filter_condition(source, i, variables, ignore_case) for i in items])


# ---- aggregation ----------------------------------------------------------------------------

# Relative standard deviation of approximate distinct counts.
DISTINCT_ERROR = 0.02
SIMPLE = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def _labels_of(source: Source, groups: list[dict]) -> Column:
    if not groups:
        return F.lit("{}")
    pairs = [part for g in groups for part in (F.lit(g["key"]), source.column(g)[0].cast("string"))]
    return map_json(F.create_map(*pairs))


def _bucket(source: Source, step_s: int) -> Column:
    step = step_s * 1000
    return int_div(source.ts_ms, step) * F.lit(step)


def quantiles(rows: DataFrame, wanted: dict[str, float], approximate: bool = False) -> DataFrame:
    """Quantiles of ``v`` per (labels, ts): exact, or a sketch on request."""
    if approximate:
        return rows.groupBy("labels", "ts").agg(*[F.percentile_approx("v", q).alias(n) for n, q in wanted.items()])
    return exact_percentiles(rows, ["labels", "ts"], "v", wanted)


def counter_rate(df: DataFrame, keys: list[str]) -> DataFrame:
    """Increase per second between successive buckets of a counter; a falling
    value is a reset and counts from zero. The window runs over one row per
    bucket, so a partition is bounded by the range divided by the step."""
    steps = Window.partitionBy(*keys).orderBy("ts")
    before, elapsed = F.lag("v").over(steps), (F.col("ts") - F.lag("ts").over(steps)) / 1000
    gained = F.when(F.col("v") < before, F.col("v")).otherwise(F.col("v") - before)
    return df.withColumn("v", gained / elapsed).where("v is not null")


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float, le: str = "le", value: str = "v", out: str = "value") -> DataFrame:
    """Quantile of cumulative bucket counts, interpolated inside the bucket that
    holds the rank; in the open last bucket its lower bound. A group has as many
    rows as it has bucket bounds."""
    per_bound = buckets.groupBy(*keys, le).agg(F.sum(value).alias("_c"))
    bounds = Window.partitionBy(*keys).orderBy(le)
    placed = per_bound.withColumns(
        {
            "_rank": F.lit(q) * F.max("_c").over(Window.partitionBy(*keys)),
            "_below": F.coalesce(F.lag("_c").over(bounds), F.lit(0.0)),
            "_from": F.coalesce(F.lag(le).over(bounds), F.lit(0.0)),
        }
    ).where((F.col("_c") >= F.col("_rank")) & (F.col("_rank") > 0))
    share = F.try_divide(F.col("_rank") - F.col("_below"), F.col("_c") - F.col("_below"))
    estimate = F.when(F.col(le) == float("inf"), F.col("_from")).otherwise(F.col("_from") + (F.col(le) - F.col("_from")) * share)
    first = placed.groupBy(*keys).agg(F.min_by(F.struct("_below", "_c", "_from", "_rank", le), F.col(le)).alias("_hit"))
    flat = first.select(*keys, "_hit.*")
    return flat.select(*keys, estimate.alias(out))


def _aggregate(rows: DataFrame, operator: str, step_s: int, approximate: bool) -> DataFrame:
    """(labels, ts, value) of log or span rows (labels, ts, v)."""
    groups = ["labels", "ts"]
    if operator in S.QUANTILES:
        return quantiles(rows, {"value": S.QUANTILES[operator]}, approximate)
    if operator in S.HIST_QUANTILES:
        raise S.InvalidSpec(f"{operator} needs metrics")
    if operator == "count":
        value = F.count(F.lit(1))
    elif operator == "count_distinct":
        value = F.approx_count_distinct("v", DISTINCT_ERROR) if approximate else F.count_distinct("v")
    elif operator in SIMPLE:
        value = SIMPLE[operator]("v")
    else:
        # An amount per second of the step.
        amount = F.count(F.lit(1)) if operator == "rate" else SIMPLE[operator.replace("rate", "").strip("_")]("v")
        value = amount / F.lit(float(step_s))
    return rows.groupBy(*groups).agg(value.cast("double").alias("value"))


# How per-series partial results of a bucket add up (sum, count, min, max of it).
COMBINE = {
    "count": lambda: F.sum("n").cast("double"),
    "sum": lambda: F.sum("s"),
    "avg": lambda: F.sum("s") / F.sum("n"),
    "min": lambda: F.min("lo"),
    "max": lambda: F.max("hi"),
}


def _aggregate_metrics(samples: DataFrame, info: DataFrame, operator: str, approximate: bool) -> DataFrame:
    """(labels, ts, value) of samples (fingerprint, ts, v), given (fingerprint,
    labels, series, le) per series.

    Where the operator allows it, samples are first reduced to one row per series
    and bucket: those rows are joined and shuffled, not the samples, and a series
    with very many samples weighs no more than any other.
    """
    groups = ["labels", "ts"]
    if operator in S.QUANTILES or operator == "count_distinct":
        rows = samples.join(info, "fingerprint")
        if operator in S.QUANTILES:
            return quantiles(rows, {"value": S.QUANTILES[operator]}, approximate)
        distinct = F.approx_count_distinct("v", DISTINCT_ERROR) if approximate else F.count_distinct("v")
        return rows.groupBy(*groups).agg(distinct.cast("double").alias("value"))
    per_series = samples.groupBy("fingerprint", "ts").agg(
        F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    rows = per_series.join(info, "fingerprint")
    if operator in COMBINE:
        return rows.groupBy(*groups).agg(COMBINE[operator]().alias("value"))
    if operator in S.HIST_QUANTILES:
        peaks = rows.groupBy("series", *groups, "le").agg(F.max("hi").alias("v"))
        return histogram_quantile(peaks, groups, S.HIST_QUANTILES[operator])
    peaks = rows.groupBy("series", *groups).agg(F.max("hi").alias("v"))
    if operator == "rate":
        return counter_rate(peaks, ["series"]).select(*groups, F.col("v").alias("value"))
    fn = SIMPLE[operator.replace("rate", "").strip("_")]
    if operator in S.SERIES_RATES:
        return counter_rate(peaks, ["series"]).groupBy(*groups).agg(fn("v").alias("value"))
    return counter_rate(peaks.groupBy(*groups).agg(fn("v").alias("v")), ["labels"]).select(*groups, F.col("v").alias("value"))


# ---- after the aggregation ------------------------------------------------------------------------

COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def apply_having(result: DataFrame, having: list[dict] | None) -> DataFrame:
    """Conditions on the aggregated value."""
    for item in having or []:
        operator = (item.get("op") or item.get("operator") or "").lower()
        given = item["value"]
        if operator in ("in", "nin"):
            inside = F.col("value").isin(given)
            result = result.where(inside if operator == "in" else ~inside)
        elif operator in COMPARE:
            result = result.where(COMPARE[operator](F.col("value"), given))
        else:
            raise S.InvalidSpec(f"invalid operator: {operator}")
    return result


def _order_columns(order_by: list[dict] | None, groups: set[str]) -> list[Column]:
    columns = []
    for item in order_by or []:
        name = item["columnName"]
        column = (
            F.get_json_object("labels", f"$['{name}']")
            if name in groups
            else F.col("ts" if name in ("timestamp", "ts") else "value")
        )
        columns.append(column.desc() if item.get("order", "asc").lower() == "desc" else column.asc())
    return columns


def top_groups(result: DataFrame, limit: int, order_by: list[dict] | None) -> DataFrame:
    """The series of the first ``limit`` groups, ranked by the sum of their values
    (largest first unless the value is ordered ascending), then by labels."""
    ascending = any(o["columnName"] == "value" and o.get("order", "asc").lower() == "asc" for o in order_by or [])
    total = F.col("total").asc() if ascending else F.col("total").desc()
    ranked = result.groupBy("labels").agg(F.sum("value").alias("total")).orderBy(total, "labels").limit(limit)
    return result.join(ranked.select("labels"), "labels", "left_semi")


def reduce_series(result: DataFrame, how: str = "last") -> DataFrame:
    """One value per series. ``avg`` etc. run over its buckets."""
    if how == "last":
        reduced = F.max_by("value", F.struct("ts", "value"))
    elif how in SIMPLE:
        reduced = SIMPLE[how]("value")
    else:
        raise S.InvalidSpec(f"invalid reduce to operator: {how}")
    keys = [c for c in ("query_name", "labels") if c in result.columns]
    return result.groupBy(*keys).agg(F.lit(None).cast("bigint").alias("ts"), reduced.alias("value"))


# ---- queries ------------------------------------------------------------------------------------------


def _in_range(source: Source, start: int, end: int) -> DataFrame:
    """Rows in ``[start, end)``, by a condition on the stored column."""
    stored = {"logs": ("timestamp", 1_000_000), "metrics": ("unix_milli", 1)}
    if source.kind in stored:
        column, factor = stored[source.kind]
        return source.df.where((F.col(column) >= start * factor) & (F.col(column) < end * factor))
    low, high = (F.timestamp_millis(F.lit(x)) for x in (start, end))
    return source.df.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))


def _series_info(source: Source, catalog: DataFrame, condition: Column, groups: list[dict], operator: str) -> DataFrame:
    """Catalog rows that pass the filters, with their group labels. Label work is
    done here, once per series instead of once per sample."""
    every = map_json(F.col(source.labels))
    labels = every if operator in ("noop", "rate") else _labels_of(source, groups)
    bound = F.replace(map_lookup(F.col(source.labels), "le", F.lit("")), F.lit("+Inf"), F.lit("Infinity"))
    # The buckets of one histogram differ in ``le`` only.
    series = map_json(F.map_filter(source.labels, lambda k, _: k != "le")) if operator in S.HIST_QUANTILES else every
    return catalog.where(condition).select(
        "fingerprint", labels.alias("labels"), series.alias("series"), bound.try_cast("double").alias("le")
    )


def run_builder_query(
    sources: dict[str, Source],
    spec: dict,
    start: int,
    end: int,
    variables: dict | None = None,
    panel: str = "graph",
    approximate: bool = False,
    ignore_case: bool = False,
) -> DataFrame:
    """(query_name, ts, labels, value) of one builder query."""
    S.check_builder_query(spec)
    source = sources[spec["dataSource"]]
    name, operator, step = spec["queryName"], spec["aggregateOperator"], int(spec.get("stepInterval") or 60)
    attribute = spec.get("aggregateAttribute") or {}
    rows = _in_range(source, start, end)
    if source.kind == "metrics" and attribute.get("key"):
        rows = rows.where(F.col("metric_name") == attribute["key"])
    condition = filter_set(source, spec.get("filters"), variables, ignore_case)
    groups = spec.get("groupBy") or []
    catalog = source.catalog(attribute.get("key"), start, end) if source.series is not None else None

    if panel == "list":
        if catalog is not None:
            rows = rows.join(catalog, "fingerprint")
        return _list_rows(Source(source.kind, rows.where(condition), source.ts_ms, source.labels), spec, name)

    if catalog is not None:
        info = _series_info(source, catalog, condition, groups, operator)
        if operator == "noop":
            raw = rows.select("fingerprint", source.ts_ms.alias("ts"), F.col("value"))
            result = raw.join(info, "fingerprint").select("ts", "labels", "value")
        else:
            samples = rows.select("fingerprint", _bucket(source, step).alias("ts"), F.col("value").alias("v"))
            result = _aggregate_metrics(samples, info, operator, approximate)
    else:
        rows = rows.where(condition)
        value = source.column(attribute)[0] if attribute.get("key") else F.lit(1)
        labels = _labels_of(source, groups)
        if operator == "noop":
            result = rows.select(source.ts_ms.alias("ts"), labels.alias("labels"), value.cast("double").alias("value"))
        else:
            prepared = rows.select(labels.alias("labels"), _bucket(source, step).alias("ts"), value.alias("v"))
            result = _aggregate(prepared, operator, step, approximate)
    result = apply_having(result.select("ts", "labels", "value"), spec.get("having"))
    order, limit = spec.get("orderBy"), int(spec.get("limit") or 0)
    if panel == "graph" and limit:
        result = top_groups(result, limit, order)
    if panel in ("value", "table"):
        result = reduce_series(result, spec.get("reduceTo") or "last").select("ts", "labels", "value")
    columns = _order_columns(order, {g["key"] for g in groups})
    if panel == "table" and (limit or columns):
        result = _page(result.orderBy(*columns, "labels"), spec)
    elif columns:
        result = result.orderBy(*columns, "labels", "ts")
    return result.select(F.lit(name).alias("query_name"), "ts", "labels", "value")


def _page(result: DataFrame, spec: dict) -> DataFrame:
    offset, limit = int(spec.get("offset") or 0), int(spec.get("limit") or spec.get("pageSize") or 0)
    result = result.offset(offset) if offset else result
    return result.limit(limit) if limit else result


def _list_rows(source: Source, spec: dict, name: str) -> DataFrame:
    """Raw rows: the selected columns as JSON, newest first unless ordered."""
    selected = spec.get("selectColumns") or []
    pairs = [part for key in selected for part in (F.lit(key["key"]), source.column(key)[0].cast("string"))]
    data = map_json(F.create_map(*pairs)) if pairs else F.lit("{}")
    unique = {"logs": "id", "traces": "span_id", "metrics": "fingerprint"}[source.kind]
    columns = []
    for item in spec.get("orderBy") or []:
        by_time = item["columnName"] in ("timestamp", "ts")
        column = source.ts_ms if by_time else source.column({"key": item["columnName"], "isColumn": True, "type": "tag"})[0]
        columns.append(column.desc() if item.get("order", "asc").lower() == "desc" else column.asc())
    rows = source.df.orderBy(*(columns or [source.ts_ms.desc()]), F.col(unique))
    picked = _page(rows, spec)
    return picked.select(
        F.lit(name).alias("query_name"), source.ts_ms.alias("ts"), data.alias("labels"), F.lit(None).cast("double").alias("value")
    )


# ---- formulas and composites -------------------------------------------------------------------------------

_FUNCTIONS = {"abs": F.abs, "sqrt": F.sqrt, "exp": F.exp, "ln": F.ln, "log2": F.log2, "log10": F.log10}


def formula_column(expression: str, names: set[str]) -> Column:
    """Arithmetic over query names: ``+ - * /``, parentheses, numbers and a few
    functions. Division by zero gives NULL."""
    operators = {
        ast.Add: lambda a, b: a + b,
        ast.Sub: lambda a, b: a - b,
        ast.Mult: lambda a, b: a * b,
        ast.Div: F.try_divide,
    }

    def build(node) -> Column:
        if isinstance(node, ast.BinOp) and type(node.op) in operators:
            return operators[type(node.op)](build(node.left), build(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            inner = build(node.operand)
            return -inner if isinstance(node.op, ast.USub) else inner
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return F.lit(float(node.value))
        if isinstance(node, ast.Name) and node.id in names:
            return F.col(f"`{node.id}`")
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id in _FUNCTIONS and len(node.args) == 1:
            return _FUNCTIONS[node.func.id](build(node.args[0]))
        raise S.InvalidSpec(f"formula not understood: {expression}")

    try:
        return build(ast.parse(expression, mode="eval").body)
    except SyntaxError as error:
        raise S.InvalidSpec(f"formula not understood: {expression}") from error


def run_formula(results: dict[str, DataFrame], expression: str, name: str) -> DataFrame:
    """A formula over query results, joined on equal time and labels; points for
    which the formula has no value are left out."""
    try:
        used = sorted({n.id for n in ast.walk(ast.parse(expression, mode="eval")) if isinstance(n, ast.Name)} & results.keys())
    except SyntaxError as error:
        raise S.InvalidSpec(f"formula not understood: {expression}") from error
    if not used:
        raise S.InvalidSpec(f"formula names no query: {expression}")
    # One aggregation instead of a chain of full joins.
    tagged = [results[q].select("ts", "labels", F.lit(q).alias("q"), "value") for q in used]
    together = reduce(DataFrame.unionByName, tagged)
    wide = together.groupBy("ts", "labels").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(q) for q in used])
    value = formula_column(expression, set(used))
    return wide.select(F.lit(name).alias("query_name"), "ts", "labels", value.alias("value")).where("value is not null")


def run_composite(sources: dict[str, Source], composite: dict, start: int, end: int, variables: dict | None = None, step: int | None = None) -> DataFrame:
    """All enabled builder queries and formulas of a composite query. Disabled
    queries only feed formulas. ``step`` replaces the queries' own steps."""
    S.check_composite(composite)
    panel = composite.get("panelType", "graph")
    queries = composite.get("builderQueries") or {}
    results, formulas = {}, {}
    for name, spec in queries.items():
        if spec["expression"] != spec["queryName"]:
            formulas[name] = spec
            continue
        spec = {**spec, "stepInterval": step} if step else spec
        results[name] = run_builder_query(sources, spec, start, end, variables, panel)
    for name, spec in formulas.items():
        results[name] = run_formula({q: results[q] for q in results if q not in formulas}, spec["expression"], name)
    shown = [results[name] for name, spec in queries.items() if not spec.get("disabled")]
    if not shown:
        raise S.InvalidSpec("every query is disabled")
    return reduce(DataFrame.unionByName, shown)


def point_text(value: Column) -> Column:
    """A value as decimal text without an exponent, in its shortest form."""
    plain = value.cast("string").try_cast("decimal(38,18)").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+\z", "$1"), r"\.\z", "")
    huge = F.replace(F.format_number(value, 0), F.lit(","), F.lit(""))
    return F.coalesce(F.when(F.abs(value) < 1e15, trimmed), huge)


# ---- rules ---------------------------------------------------------------------------------------------------

MATCH_TYPES = {"0": "none", "1": "at_least_once", "2": "all_the_times", "3": "on_average", "4": "in_total"}


def _point_matches(rule: dict) -> Callable[[Column], Column]:
    """A rule's comparison with its target."""
    compare = COMPARE.get(rule["op"])
    if compare is None or rule["op"] in (">=", "<="):
        raise S.InvalidSpec(f"unknown comparison: {rule['op']}")
    return lambda value: compare(value, F.lit(float(rule["target"])))


FOUND = ("any", "every", "total", "n")


def _points(rule: dict, value: Column) -> list[Column]:
    """What a rule needs to know of points: whether any and every one matches, their
    total and number. These add up over parts of time. NULL is no point."""
    point = _point_matches(rule)(value)
    return [F.bool_or(point), F.bool_and(point), F.sum(value), F.count(value)]


def _matched(rule: dict, found: list[Column]) -> Column:
    """Whether points match, from what :func:`_points` found of them."""
    any_one, every_one, total, n = found
    matches = _point_matches(rule)
    outcomes = {
        "none": F.lit(False),
        "at_least_once": any_one,
        "all_the_times": every_one,
        "on_average": matches(total / n),
        "in_total": matches(total),
    }
    how = MATCH_TYPES.get(str(rule.get("matchType", "0")))
    if how is None:
        raise S.InvalidSpec(f"unknown match type: {rule.get('matchType')}")
    return outcomes[how]


def _named(prefix: str, columns: list[Column]) -> list[Column]:
    return [column.alias(f"{prefix}_{name}") for column, name in zip(columns, FOUND, strict=True)]


def _back(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}_{name}") for name in FOUND]


def match_series(series: DataFrame, rule: dict) -> DataFrame:
    """Whether each series (labels) matches a threshold rule over the points given."""
    found = series.groupBy("labels").agg(*_named("now", _points(rule, F.col("value"))))
    return found.select("labels", _matched(rule, _back("now")).alias("matched"))


def _state(matched: Column, before: Column) -> Column:
    return F.when(~matched, "inactive").when(F.coalesce(before, F.lit(False)), "firing").otherwise("pending")


def evaluate_rule(series: DataFrame, rule: dict, now_ms: int, window_ms: int) -> DataFrame:
    """State per series at ``now_ms``: matched in this window and the one before is
    firing, in this one only is pending. A disabled rule is disabled. Both windows
    are read in one pass."""
    both = series.where((F.col("ts") > now_ms - 2 * window_ms) & (F.col("ts") <= now_ms))
    now = F.col("ts") > now_ms - window_ms
    found = both.groupBy("labels").agg(
        F.count(F.when(now, 1)).alias("_seen"),
        *_named("now", _points(rule, F.when(now, F.col("value")))),
        *_named("before", _points(rule, F.when(~now, F.col("value")))),
    )
    matched, before = _matched(rule, _back("now")), _matched(rule, _back("before"))
    state = F.when(F.lit(bool(rule.get("disabled"))), "disabled").otherwise(_state(matched, before))
    return found.where("_seen > 0").select("labels", matched.alias("matched"), state.alias("state"))


def rule_states(series: DataFrame, rule: dict, step_ms: int, window_ms: int) -> DataFrame:
    """State per series at every multiple of the step whose window holds a point,
    with the instant ``since`` which it has matched without a break.

    Points are reduced per series and step first; a window is made of whole steps,
    so only those rows are lent to the windows they lie in. The last step is
    ordered by series, over one row for each instant."""
    if window_ms % step_ms:
        raise S.InvalidSpec("the window must be a multiple of the step")
    count = window_ms // step_ms
    cell = int_div(F.col("ts") + F.lit(step_ms - 1), step_ms)
    cells = series.groupBy("labels", cell.alias("_cell")).agg(*_named("cell", _points(rule, F.col("value"))))
    lent = cells.withColumn("_at", F.explode(F.sequence("_cell", F.col("_cell") + F.lit(count - 1))))
    added = [add(column) for add, column in zip((F.bool_or, F.bool_and, F.sum, F.sum), _back("cell"), strict=True)]
    found = lent.groupBy("labels", "_at").agg(*_named("window", added))
    matched = found.select("labels", "_at", _matched(rule, _back("window")).alias("matched"))
    ordered = Window.partitionBy("labels").orderBy("_at")

    def at(distance: int) -> Column:
        return F.coalesce(F.first("matched").over(ordered.rangeBetween(-distance, -distance)), F.lit(False))

    runs = matched.withColumns({"_before": at(count), "_previous": at(1)})
    begun = F.when(F.col("matched") & ~F.col("_previous"), F.col("_at"))
    since = F.last(begun, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return runs.withColumn("_since", since).select(
        "labels", (F.col("_at") * F.lit(step_ms)).alias("ts"), "matched", _state(F.col("matched"), F.col("_before")).alias("state"),
        F.when(F.col("matched"), F.col("_since") * F.lit(step_ms)).alias("since"),
    )
