"""Request shapes over spans, errors and logs: services, operations, facets,
pages and suggestions. The request model only names them; what each returns is
defined here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions.maps import has_key
from telemorph.functions.scalars import int_div
from telemorph.operators.quantiles import exact_percentiles
from telemorph.operators.scans import scan_range

# ---- tag predicates ---------------------------------------------------------------------

RESOURCE, SPAN = "ResourceAttribute", "SpanAttribute"
TAG_MAPS = {"string": "attributes_string", "number": "attributes_number", "bool": "attributes_bool"}


def _tag_map(tag_type: str, values: list, data_type: str | None = None) -> str:
    """Typed map a tag is looked up in: by its type and data type; where none is
    given, by the first value."""
    first = values[0] if values else ""
    data_type = data_type or ("bool" if isinstance(first, bool) else "number" if isinstance(first, (int, float)) else "string")
    return "resources_string" if tag_type == RESOURCE and data_type == "string" else TAG_MAPS[data_type]


def _as_held(value, kind: str):
    """A value as the map it is looked for in holds it."""
    if kind == TAG_MAPS["number"]:
        return float(value)
    if kind == TAG_MAPS["bool"]:
        return value if isinstance(value, bool) else str(value).lower() == "true"
    if isinstance(value, bool):
        return str(value).lower()
    return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)


def tag_predicate(key: str, tag_type: str, op: str, values: list | None = None, data_type: str | None = None) -> Column:
    """Condition on one tag of ``data_type`` string, number or bool, which the values are taken as. Of several values
    one must hold; for the negated operators none may. A missing tag fails every positive operator."""
    kind = _tag_map(tag_type, values or [], data_type)
    values = [_as_held(value, kind) for value in values or []]
    attrs = F.col(kind)
    tag, present = F.try_element_at(attrs, F.lit(key)), has_key(attrs, key)

    def any_of(test) -> Column:
        return F.coalesce(reduce(lambda a, b: a | b, [test(tag, v) for v in values]), F.lit(False))

    tests = {
        "In": lambda: any_of(lambda t, v: t == v),
        "Equals": lambda: any_of(lambda t, v: t == v),
        "Contains": lambda: any_of(lambda t, v: t.contains(v)),
        "StartsWith": lambda: any_of(lambda t, v: t.startswith(v)),
        "LessThan": lambda: any_of(lambda t, v: t < v),
        "LessThanEquals": lambda: any_of(lambda t, v: t <= v),
        "GreaterThan": lambda: any_of(lambda t, v: t > v),
        "GreaterThanEquals": lambda: any_of(lambda t, v: t >= v),
        "Exists": lambda: present,
        "NotExists": lambda: ~present,
    }
    negated = {"NotIn": "In", "NotEquals": "Equals", "NotContains": "Contains", "NotStartsWith": "StartsWith"}
    if op in negated:
        return ~tests[negated[op]]()
    if op not in tests:
        raise ValueError(f"unknown operator: {op}")
    return tests[op]()


def _with_tags(df: DataFrame, tags: list[dict] | None) -> DataFrame:
    for tag in tags or []:
        df = df.where(tag_predicate(tag["key"], tag.get("tagType", SPAN), tag["operator"], tag.get("values"), tag.get("dataType")))
    return df


# ---- spans -------------------------------------------------------------------------------

SERVICE = "service.name"


def _service() -> Column:
    return F.coalesce(F.try_element_at("resources_string", F.lit(SERVICE)), F.lit(""))


def _bucket(ts: Column, step_s: int) -> Column:
    return int_div(F.unix_seconds(ts), step_s) * F.lit(step_s)


def service_overview(spans: DataFrame, start, end, step: int | None = None, tags: list[dict] | None = None) -> DataFrame:
    """Calls, average and 99th percentile duration and error share per service,
    and per step (epoch seconds) when one is given."""
    rows = _with_tags(scan_range(spans, "timestamp", start, end, "[]"), tags).withColumn("service", _service())
    keys = ["service"]
    if step:
        rows, keys = rows.withColumn("bucket", _bucket(F.col("timestamp"), step)), ["service", "bucket"]
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        F.avg("duration_nano").alias("avg_duration"),
        F.count_if("has_error").alias("errors"),
    )
    p99 = exact_percentiles(rows, keys, "duration_nano", {"p99": 0.99})
    # Groups without any duration have no percentile; keys may be null.
    other = p99.select(*[F.col(k).alias(f"_{k}") for k in keys], "p99")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = counts.join(other, same, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn("error_rate", F.col("errors") / F.col("calls"))


def top_operations(spans: DataFrame, service: str, n: int, start=None, end=None, tags: list[dict] | None = None) -> DataFrame:
    """The ``n`` span names of a service with the largest 99th percentile."""
    rows = spans if start is None else scan_range(spans, "timestamp", start, end, "[]")
    rows = _with_tags(rows.where(_service() == service), tags)
    quantiles = exact_percentiles(rows, ["name"], "duration_nano", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    calls = rows.groupBy("name").agg(F.count(F.lit(1)).alias("calls"), F.count_if("has_error").alias("errors"))
    other = quantiles.withColumnRenamed("name", "_name")
    joined = calls.join(other, F.col("name").eqNullSafe(F.col("_name")), "left").select("name", *[c for c in quantiles.columns if c != "name"], "calls", "errors")
    return joined.orderBy(F.col("p99").desc_nulls_last(), "name").limit(n)


def usage(spans: DataFrame, step_hours: int, service: str | None = None) -> DataFrame:
    """Spans per step of hours (epoch seconds)."""
    rows = spans if service is None else spans.where(_service() == service)
    return rows.groupBy(_bucket(F.col("timestamp"), step_hours * 3600).alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


# Request field to span column; the service name lives in the resource map.
SPAN_FIELDS = {
    "traceID": "trace_id",
    "operation": "name",
    "status": "has_error",
    "httpCode": "response_status_code",
    "httpUrl": "http_url",
    "httpHost": "http_host",
    "httpMethod": "http_method",
    "responseStatusCode": "response_status_code",
    "spanKind": "kind_string",
}


def _span_field(name: str) -> Column:
    if name == "serviceName":
        return _service()
    if name == "status":
        return F.when(F.col("has_error"), "error").otherwise("ok")
    return F.col(SPAN_FIELDS[name])


def _matching_spans(spans: DataFrame, params: dict) -> DataFrame:
    """Spans of a request: list filters, negated for names in ``exclude``, a
    duration range, a time range and tags."""
    rows = spans
    if params.get("start") is not None:
        rows = scan_range(rows, "timestamp", params["start"], params["end"], "[]")
    excluded = set(params.get("exclude") or [])
    for name in ["serviceName", *SPAN_FIELDS]:
        wanted = params.get(name)
        if wanted:
            wanted = wanted if isinstance(wanted, list) else [wanted]
            inside = _span_field(name).isin(wanted)
            rows = rows.where(~inside if name in excluded else inside)
    if params.get("minDuration") is not None:
        rows = rows.where(F.col("duration_nano") >= int(params["minDuration"]))
    if params.get("maxDuration") is not None:
        rows = rows.where(F.col("duration_nano") <= int(params["maxDuration"]))
    return _with_tags(rows, params.get("tags"))


ORDER_COLUMNS = {"timestamp": "timestamp", "duration": "duration_nano"}


def filtered_spans(spans: DataFrame, params: dict) -> DataFrame:
    """One page of matching spans; the span id breaks ties."""
    rows = _matching_spans(spans, params)
    column = F.col(ORDER_COLUMNS[params.get("orderParam", "timestamp")])
    ordered = rows.orderBy(column.asc() if params.get("order") == "ascending" else column.desc(), "span_id")
    return ordered.offset(int(params.get("offset") or 0)).limit(int(params["limit"]))


def span_aggregates(spans: DataFrame, params: dict) -> DataFrame:
    """A dimension (calls, duration, error) aggregated per step and group."""
    rows = _matching_spans(spans, params)
    keys = [_bucket(F.col("timestamp"), int(params["step"])).alias("bucket")]
    if params.get("groupBy"):
        keys.append(_span_field(params["groupBy"]).cast("string").alias("group"))
    names = ["bucket", "group"][: len(keys)]
    dimension, how = params.get("dimension", "calls"), params.get("aggregationOption", "count")
    rows = rows.select(*keys, "duration_nano", "has_error")
    if dimension == "duration" and how in ("p50", "p95", "p99"):
        return exact_percentiles(rows, names, "duration_nano", {"value": int(how[1:]) / 100})
    value = {
        ("calls", "count"): F.count(F.lit(1)).cast("double"),
        ("calls", "rate_per_sec"): F.count(F.lit(1)) / F.lit(float(params["step"])),
        ("duration", "avg"): F.avg("duration_nano"),
        ("duration", "min"): F.min("duration_nano").cast("double"),
        ("duration", "max"): F.max("duration_nano").cast("double"),
        ("error", "count"): F.count_if("has_error").cast("double"),
        ("error", "rate"): F.count_if("has_error") / F.count(F.lit(1)),
    }[dimension, how]
    return rows.groupBy(*names).agg(value.alias("value"))


def span_facets(spans: DataFrame, params: dict) -> DataFrame:
    """Counts per value of every requested filter, in long form (facet, value,
    count). All facets come from one pass over the rows."""
    rows = _matching_spans(spans, params)
    pairs = [
        F.struct(F.lit(name).alias("facet"), _span_field(name).cast("string").alias("value")) for name in params["getFilters"]
    ]
    return rows.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.facet", "p.value").agg(F.count(F.lit(1)).alias("count"))


def tag_keys(spans: DataFrame) -> DataFrame:
    """Distinct tag keys with their kind."""
    keys = F.concat(*[_keys_with_kind(kind, column) for kind, column in TAG_MAPS.items()])
    return spans.select(F.explode(keys).alias("k")).select("k.*").distinct()


def _keys_with_kind(kind: str, column: str) -> Column:
    return F.transform(F.map_keys(column), lambda k: F.struct(k.alias("key"), F.lit(kind).alias("kind")))


def tag_values(spans: DataFrame, key: str, kind: str, limit: int) -> DataFrame:
    """Distinct values of a tag in text form, first ``limit`` in order."""
    value = F.try_element_at(F.col(TAG_MAPS[kind]), F.lit(key)).cast("string")
    return spans.select(value.alias("value")).where("value is not null").distinct().orderBy("value").limit(limit)


# ---- errors ----------------------------------------------------------------------------------


def _matching_errors(errors: DataFrame, params: dict) -> DataFrame:
    rows = errors
    if params.get("start") is not None:
        rows = scan_range(rows, "timestamp", params["start"], params["end"], "[]")
    for name in ("serviceName", "exceptionType"):
        if params.get(name):
            rows = rows.where(F.col(name) == params[name])
    return rows


def list_errors(errors: DataFrame, params: dict) -> DataFrame:
    """Error groups: count, first and last seen; one ordered page."""
    groups = _matching_errors(errors, params).groupBy("groupID").agg(
        F.max("exceptionType").alias("exceptionType"),
        F.max("exceptionMessage").alias("exceptionMessage"),
        F.max("serviceName").alias("serviceName"),
        F.count(F.lit(1)).alias("exceptionCount"),
        F.min("timestamp").alias("firstSeen"),
        F.max("timestamp").alias("lastSeen"),
    )
    column = F.col(params.get("orderParam", "exceptionCount"))
    ordered = groups.orderBy(column.asc() if params.get("order") == "ascending" else column.desc(), "groupID")
    return ordered.offset(int(params.get("offset") or 0)).limit(int(params["limit"]))


def count_errors(errors: DataFrame, params: dict) -> DataFrame:
    """Number of error groups."""
    return _matching_errors(errors, params).agg(F.count_distinct("groupID").alias("count"))


def get_error(errors: DataFrame, group_id: str, error_id: str | None = None, timestamp=None) -> DataFrame:
    """One error by its id, or the newest of a group."""
    rows = errors.where(F.col("groupID") == group_id)
    if error_id is not None:
        rows = rows.where(F.col("errorID") == error_id)
    if timestamp is not None:
        rows = rows.where(F.col("timestamp") == timestamp)
    return rows.orderBy(F.col("timestamp").desc(), "errorID").limit(1)


# ---- logs ------------------------------------------------------------------------------------


def _matching_logs(logs: DataFrame, params: dict) -> DataFrame:
    rows = logs
    if params.get("timestampStart") is not None:
        rows = scan_range(rows, "timestamp", params["timestampStart"], params["timestampEnd"], "[]")
    if params.get("q"):
        rows = rows.where(F.contains("body", F.lit(params["q"])))
    return rows


def logs_page(logs: DataFrame, params: dict) -> DataFrame:
    """A page of logs. ``idGt``/``idLt`` continue after a known id, so a later
    page costs no more than the first."""
    rows = _matching_logs(logs, params)
    if params.get("idGt"):
        rows = rows.where(F.col("id") > params["idGt"])
    if params.get("idLt"):
        rows = rows.where(F.col("id") < params["idLt"])
    column = F.col(params.get("orderBy", "id"))
    return rows.orderBy(column.desc() if params.get("order") == "desc" else column.asc(), "id").limit(int(params["limit"]))


def logs_aggregate(logs: DataFrame, params: dict) -> DataFrame:
    """Log counts per step (epoch seconds) and value of a group column."""
    rows = _matching_logs(logs, params)
    step = int(params["step"])
    bucket = int_div(int_div(F.col("timestamp"), 1_000_000_000), step) * F.lit(step)
    keys = [bucket.alias("bucket")] + ([F.col(params["groupBy"]).alias("group")] if params.get("groupBy") else [])
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


# ---- suggestions --------------------------------------------------------------------------------


def suggest_attributes(df: DataFrame, text: str, limit: int) -> DataFrame:
    """Attribute keys containing ``text``, with data type and kind."""
    sources = [
        ("attributes_string", "string", "tag"),
        ("attributes_number", "float64", "tag"),
        ("attributes_bool", "bool", "tag"),
        ("resources_string", "string", "resource"),
    ]

    def keys(column: str, dtype: str, kind: str) -> Column:
        return F.transform(
            F.map_keys(column), lambda k: F.struct(k.alias("key"), F.lit(dtype).alias("dataType"), F.lit(kind).alias("type"))
        )

    found = df.select(F.explode(F.concat(*[keys(*s) for s in sources])).alias("k")).select("k.*").distinct()
    return found.where(F.contains("key", F.lit(text))).orderBy("key", "dataType", "type").limit(limit)


def suggest_values(df: DataFrame, column: str, key: str, text: str, limit: int) -> DataFrame:
    """Values of an attribute containing ``text``."""
    value = F.try_element_at(F.col(column), F.lit(key)).cast("string").alias("value")
    return df.select(value).where(F.contains("value", F.lit(text))).distinct().orderBy("value").limit(limit)
