"""Document jobs, checked against the documents they should produce."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from telemorph.functions import rewrite as R
from telemorph.functions import variants as V
from telemorph.operators import documents as D
from telemorph.operators import legacy_documents as L
from telemorph.operators import log_fields as LF
from telemorph.operators import sinks, verify
from telemorph.operators.sizing import staged
from telemorph.plans import legacy_names
from telemorph.queries.registry import query
from telemorph.session import checkpoint_dir
from telemorph.sources import derived_documents as dd
from telemorph.sources import tables
from telemorph.sources.templates import fill_sql


def _dashboards(t):
    """The documents as a stored table, as the jobs find them."""
    return staged(dd.dashboards(t))


def _rules(t):
    return staged(dd.rules(t))


def _mapping(t) -> D.NameMapping:
    """A configured name mapping."""
    make = t.spark.createDataFrame
    return D.NameMapping(
        make([("app_event_value", "app.event.value"), ("app_latency", "app.latency.quantile")], "norm_name string, orig_name string"),
        make(
            [("app_event_value", "service_name", "service.name"), ("app_event_value", "event_type", "event.type")],
            "norm_name string, norm_key string, orig_key string",
        ),
        make(
            [("service_name", "service.name"), ("event_type", "event.type"), ("k8s_node_name", "k8s.node.name")],
            "norm_key string, orig_key string",
        ),
    )


def _field_mapping(t):
    return t.spark.createDataFrame(
        [("attributes_string_event_type", "event.type"), ("attributes_string_service_name", "service.name"), ("resources_string_service_name", "service.name")],
        "ref string, new_name string",
    )


# ---- expected documents --------------------------------------------------------------

PART = """part_docs AS (SELECT p_partkey AS id, p_name AS name, p_size AS size, 1 + p_size % 4 AS n, p_partkey % 3 AS kind,
    CASE WHEN p_partkey % 2 = 0 THEN 'metrics' ELSE 'logs' END AS src, p_partkey % 10 AS s FROM part)"""


def panels(template_by_case: str, separator: str = ",") -> str:
    """Join one text per panel; ``j`` is the panel's place."""
    return f"array_to_string(list_transform(range(n), lambda j: {template_by_case}), '{separator}')"


def _builder(metric, service, etype, legend, order, formula, formula_legend):
    return (
        '{"extra":{"keep":[1,2.5]},"id":"w«j»","panelTypes":"graph","query":{"builder":{"queryData":[{"aggregateAttribute":{"dataType":"float64","key":"'
        + metric + '","type":"tag"},"aggregateOperator":"sum","dataSource":"«src»","filters":{"items":[{"key":{"dataType":"string","key":"' + service
        + '","type":"tag"},"op":"=","value":"svc«s»"}],"op":"AND"},"groupBy":[{"dataType":"string","key":"' + etype + '","type":"tag"}],"legend":"' + legend
        + '","orderBy":[{"columnName":"' + order + '","order":"asc"}],"queryName":"A"}],"queryFormulas":[{"expression":"' + formula + '","legend":"'
        + formula_legend + '","queryName":"F1"}]},"clickhouse_sql":[],"promql":[],"queryType":"builder"},"title":"«name»"}'
    )


def _sql(legend, text):
    return (
        '{"id":"w«j»","query":{"builder":{"queryData":[],"queryFormulas":[]},"clickhouse_sql":[{"legend":"' + legend + '","name":"A","query":"' + text
        + '"}],"promql":[],"queryType":"clickhouse_sql"},"title":"«name»"}'
    )


def _prom(legend, text):
    return (
        '{"id":"w«j»","query":{"builder":{"queryData":[],"queryFormulas":[]},"clickhouse_sql":[],"promql":[{"legend":"' + legend + '","name":"A","query":"'
        + text + '"}],"queryType":"promql"},"title":"«name»"}'
    )


def _f(template: str) -> str:
    return fill_sql(template, j="j", name="name", src="src", s="s")


OLD_BUILDER = _builder("app_event_value", "service_name", "event_type", "{{event_type}} of event_type_x", "event_type", "A * app_event_value", "{{event_type}}")
NEW_METRICS_BUILDER = _builder("app.event.value", "service.name", "event.type", "{{event.type}} of event_type_x", "event.type", "A * app.event.value", "{{event.type}}")
NEW_LOGS_BUILDER = _builder("app_event_value", "service.name", "event_type", "{{event_type}} of event_type_x", "event_type", "A * app.event.value", "{{event.type}}")
NEW_METRICS_SQL = (
    "SELECT `service.name`, sum(value) AS v\\n FROM telemetry_metrics.samples WHERE metric_name = 'app.event.value'"
    " AND `event.type` IN ($event.type) GROUP BY `service.name`"
)
NEW_LOGS_SQL = dd.LOGS_SQL.replace("'event_type'", "'event.type'")
NEW_PROM = (
    'sum(rate({\\"app.event.value\\",\\"service.name\\"=\\"svc«s»\\",\\"event.type\\"=~\\"a|b\\"}[5m])) by (\\"event.type\\")'
    ' / ignoring (\\"k8s_node_name\\") {\\"app_other\\",x=\\"$service.name\\"}'
)
OLD_METRICS_SQL = dd.METRICS_SQL

NEW_PANELS = panels(f"""CASE
    WHEN kind = 0 AND src = 'metrics' THEN {_f(NEW_METRICS_BUILDER)}
    WHEN kind = 0 THEN {_f(NEW_LOGS_BUILDER)}
    WHEN kind = 1 AND id % {dd.BAD_PANEL} = 0 AND j = 0 THEN {_f(_sql('{{service_name}}', dd.BROKEN_SQL))}
    WHEN kind = 1 AND src = 'metrics' THEN {_f(_sql('{{service.name}}', NEW_METRICS_SQL))}
    WHEN kind = 1 THEN {_f(_sql('{{service.name}}', NEW_LOGS_SQL))}
    ELSE {_f(_prom('{{event.type}}', NEW_PROM))} END""")

# Layout entries after the repair, and as they are stored.
OLD_ENTRY = f"""CASE WHEN (id + j) % 5 = 0 THEN 'w' || j WHEN (id + j) % 5 = 1 OR ((id + j) % 5 = 3 AND id % 7 = 0) THEN '' WHEN (id + j) % 5 = 2 THEN 'empty'
    WHEN (id + j) % 5 = 3 THEN CAST(j + 1 AS VARCHAR) ELSE 'w' || j || '-old' END"""


def layout(entry: str, factor: int) -> str:
    first = f"""CASE WHEN id % 7 = 0 THEN '{{"h":{factor},"i":"zz"}},' ELSE '' END"""
    one = fill_sql('{"h":«h»,"i":"«i»","y":«j»}', h=str(2 * factor), i=entry, j="j")
    return f"{first} || {panels(one)}"


NEW_VARIABLES = '{"v1":{"name":"service.name","queryValue":"SELECT DISTINCT `service.name` FROM telemetry_metrics.series WHERE env = $env"}}'
OLD_VARIABLES = '{"v1":{"name":"service_name","queryValue":"' + dd.VARIABLE + '"}}'

OK_DASHBOARD = f"id % {dd.BROKEN_JSON} <> 0 AND id % {dd.DONE} <> 0 AND id % {dd.BAD_VARIABLE} <> 0"
OK_RULE = f"id % {dd.BROKEN_JSON} <> 0 AND id % {dd.DONE} <> 0"


@query("d09_rewrite_dashboards", f"""
    WITH {PART} SELECT id, {fill_sql('{"dotMigrated":true,"layout":[«layout»],"title":"«name»","unknown":{"a":null,"b":"é"},"variables":' + NEW_VARIABLES + ',"widgets":[«panels»]}', layout=layout(OLD_ENTRY, 1), name="name", panels=NEW_PANELS)} AS data
    FROM part_docs WHERE {OK_DASHBOARD}""")
def d09(t):
    out = D.rewrite_dashboards(_dashboards(t), _mapping(t), dd.METRICS_DATABASE)
    return out.where("changed").select("id", "data")


@query("s05_documents_job", f"""
    WITH {PART} SELECT id, 'dashboards' AS output, {fill_sql('{"dotMigrated":true,"layout":[«layout»],"title":"«name»","unknown":{"a":null,"b":"é"},"variables":' + NEW_VARIABLES + ',"widgets":[«panels»]}', layout=layout(OLD_ENTRY, 1), name="name", panels=NEW_PANELS)} AS data
    FROM part_docs WHERE {OK_DASHBOARD}
    UNION ALL SELECT id, 'unreadable', NULL FROM part_docs WHERE id % {dd.BROKEN_JSON} = 0""")
def s05_job(t):
    """Stored documents read, rewritten and written as one job, and read back."""
    root = f"{checkpoint_dir(t.spark)}/documents-{uuid.uuid4().hex}"
    sinks.write_upgraded(dd.dashboards(t), f"{root}/old")
    good, bad = tables.read_documents(t.spark, f"{root}/old")
    new = D.rewrite_dashboards(good, _mapping(t), dd.METRICS_DATABASE)
    paths = sinks.write_all({"dashboards": new.select("id", "data", "changed"), "unreadable": bad}, root)
    written, unread = (t.spark.read.parquet(paths[name]) for name in ("dashboards", "unreadable"))
    nothing = F.lit(None).cast("string").alias("data")
    return written.where("changed").select("id", F.lit("dashboards").alias("output"), "data").unionByName(unread.select("id", F.lit("unreadable").alias("output"), nothing))


@query("d09_rename_variables", f"""
    WITH {PART} SELECT id, 'v1' AS name, 'SELECT DISTINCT `service.name` FROM telemetry_metrics.series WHERE env = $env' AS text FROM part_docs WHERE {OK_DASHBOARD}""")
def d09_variables(t):
    out = D.rewrite_dashboards(_dashboards(t), _mapping(t), dd.METRICS_DATABASE).where("changed")
    return D.flatten_queries(out, langs=["variable"]).select("id", "name", "text")


@query("d10_panel_isolation", f"""
    WITH {PART} SELECT id, {OK_DASHBOARD} AS changed,
      CASE WHEN id % {dd.BROKEN_JSON} = 0 THEN 'invalid JSON' WHEN id % {dd.BAD_VARIABLE} = 0 THEN 'variables' END AS error,
      CASE WHEN kind = 1 AND id % {dd.BAD_PANEL} = 0 AND id % {dd.BROKEN_JSON} <> 0 THEN 1 ELSE 0 END AS panel_errors FROM part_docs""")
def d10(t):
    return D.rewrite_dashboards(_dashboards(t), _mapping(t), dd.METRICS_DATABASE).drop("data")


def _sql_text(json_text: str) -> str:
    """A text as it is, not as it stands inside JSON."""
    return json_text.replace("\\r", "\r").replace("\\n", "\n").replace('\\"', '"')


@query("d01_flatten_dashboards", f"""
    WITH {PART}, p AS (SELECT *, unnest(range(n)) AS j FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0)
    SELECT id, CAST(j AS VARCHAR) AS panel, 'sql' AS lang, 0 AS pos, CASE WHEN id % {dd.BAD_PANEL} = 0 AND j = 0 THEN {_f(dd.BROKEN_SQL)}
           WHEN src = 'metrics' THEN {_f(_sql_text(dd.METRICS_SQL))} ELSE {_f(dd.LOGS_SQL)} END AS text FROM p WHERE kind = 1
    UNION ALL SELECT id, CAST(j AS VARCHAR), 'sql_legend', 0, '{{{{service_name}}}}' FROM p WHERE kind = 1
    UNION ALL SELECT id, CAST(j AS VARCHAR), 'promql', 0, {_f(_sql_text(dd.PROM))} FROM p WHERE kind = 2
    UNION ALL SELECT id, CAST(j AS VARCHAR), 'promql_legend', 0, '{{{{event_type}}}}' FROM p WHERE kind = 2
    UNION ALL SELECT id, CAST(j AS VARCHAR), 'formula', 0, 'A * app_event_value' FROM p WHERE kind = 0
    UNION ALL SELECT id, CAST(j AS VARCHAR), 'formula_legend', 0, '{{{{event_type}}}}' FROM p WHERE kind = 0
    UNION ALL SELECT id, NULL, 'variable', 0, CASE WHEN id % {dd.BAD_VARIABLE} = 0 THEN 'SELECT ''oops' ELSE '{dd.VARIABLE}' END FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0""")
def d01(t):
    return D.flatten_queries(dd.dashboards(t)).where("lang <> 'builder'").drop("name")


@query("d01_flatten_rules", f"""
    WITH {PART} SELECT id, 'promql' AS lang, 'A' AS name, {_f(_sql_text(dd.PROM))} AS text FROM part_docs WHERE {OK_RULE}
    UNION ALL SELECT id, 'annotation', 'description', 'app_event_value high' FROM part_docs WHERE {OK_RULE}
    UNION ALL SELECT id, 'annotation', 'summary', 'x' FROM part_docs WHERE {OK_RULE}
    UNION ALL SELECT id, 'label', 'service_name', 'event_type is ' || s FROM part_docs WHERE {OK_RULE}
    UNION ALL SELECT id, 'source', NULL, CASE WHEN id % 4 = 0 THEN '' ELSE {_f(dd.SOURCE)} END FROM part_docs WHERE {OK_RULE}""")
def d01_rules(t):
    return D.flatten_rules(dd.rules(t)).where("lang not in ('builder', 'sql')").select("id", "lang", "name", "text")


def _queries(t, *langs):
    flat = D.flatten_queries(dd.dashboards(t), langs=list(langs or ("sql", "promql")))
    return flat.select(F.concat_ws("/", "id", "panel").alias("id"), "lang", "text")


@query("d02_extract_references", f"""
    WITH {PART}, p AS (SELECT *, unnest(range(n)) AS j FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0)
    SELECT id || '/' || j AS id, 'app_event_value' AS references FROM p
    WHERE kind = 2 OR (kind = 1 AND src = 'metrics' AND NOT (id % {dd.BAD_PANEL} = 0 AND j = 0))""")
def d02(t):
    names = _mapping(t).metrics.select(F.col("norm_name").alias("name"))
    out = D.extract_references(_queries(t), names, ["id"])
    return out.select("id", F.array_join("references", ",").alias("references"))


@query("d03_rewrite_names", f"""
    WITH {PART}, p AS (SELECT *, unnest(range(n)) AS j FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0)
    SELECT id || '/' || j AS id, 'promql' AS lang, {_f(_sql_text(NEW_PROM))} AS text, NULL AS error FROM p WHERE kind = 2
    UNION ALL SELECT id || '/' || j, 'sql', CASE WHEN id % {dd.BAD_PANEL} = 0 AND j = 0 THEN {_f(dd.BROKEN_SQL)}
       WHEN src = 'metrics' THEN {_f(_sql_text(NEW_METRICS_SQL))} ELSE {_f(NEW_LOGS_SQL)} END,
       CASE WHEN id % {dd.BAD_PANEL} = 0 AND j = 0 THEN 'unclosed quote' END FROM p WHERE kind = 1""")
def d03(t):
    return D.rewrite_names(_queries(t), _mapping(t))


MAPPED_PROM = NEW_PROM.replace("k8s_node_name", "k8s.node.name")


@query("d03_rewrite_names_from_series", f"""
    WITH {PART}, p AS (SELECT *, unnest(range(n)) AS j FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0)
    SELECT id || '/' || j AS id, 'promql' AS lang, {_f(_sql_text(MAPPED_PROM))} AS text FROM p WHERE kind = 2""")
def d03_from_series(t):
    """The whole way: names are paired from the series catalog, then used."""
    from telemorph.queries.metric_queries import _mapping as name_mapping

    out = D.rewrite_names(_queries(t, "promql"), D.mapping_from(name_mapping(t)))
    return out.where("error is null").drop("error")


# ---- text functions on stored texts ---------------------------------------------------


def _words(pairs):
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


@query("d04_replace_tokens", r"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\bthe\b', 'THE.ONE', 'g'), '\bde\b', 'DE', 'g')) AS digest FROM documents""")
def d04(t):
    return t.documents.select("doc_id", F.md5(R.replace_tokens(F.col("text"), _words({"the": "THE.ONE", "de": "DE"}))).alias("digest"))


@query("d05_rename_in_json", """
    SELECT event_id, '{"event.type":{"deep":["app.event.value","x event.type y\\n' || event_type || '",' || event_id || ',null]},"keep service_name":"' ||
           CASE WHEN event_type = 'error' THEN 'failure' ELSE event_type END || '","props":' || replace(props, ': ', ':') || '}' AS data FROM events""")
def d05(t):
    text = F.concat(
        F.lit('{"event_type": {"deep": ["app_event_value", "x event_type y\\n'), "event_type", F.lit('", '), "event_id", F.lit(', null]}, "keep service_name": "'),
        "event_type", F.lit('", "props": '), "props", F.lit("}"),
    )
    exact = _words({"event_type": "event.type", "service_name": "service.name", "app_event_value": "app.event.value", "error": "failure"})
    words = _words({"event_type": "event.type"})
    return t.events.select("event_id", F.to_json(R.rename_variant(F.parse_json(text), exact, words)).alias("data"))


@query("d06_template_to_param", """
    SELECT event_id, 'a = $' || event_type || ' and b in ($x) {{1' || '}} {{ $y }}' AS text FROM events""")
def d06(t):
    text = F.concat(F.lit("a = {{ ."), "event_type", F.lit(" }} and b in ({{x}}) {{1}} {{ $y }}"))
    return t.events.select("event_id", R.template_to_param(text).alias("text"))


@query("d07_replace_placeholders", """
    SELECT event_id, 'a = $' || CASE WHEN event_type = 'error' THEN 'event.error' ELSE event_type END || ' $error_x $$ error' AS text FROM events""")
def d07(t):
    text = F.concat(F.lit("a = $"), "event_type", F.lit(" $error_x $$ error"))
    return t.events.select("event_id", R.replace_placeholders(text, _words({"error": "event.error"})).alias("text"))


@query("d08_clean_query_text", r"""
    SELECT event_id, 'SELECT ' || event_type || E'\n  FROM t\n WHERE x' AS text FROM events""")
def d08(t):
    text = F.concat(F.lit("\n SELECT ".lstrip()), "event_type", F.lit(" \t\r\n\n\n  FROM t\r\n \t \n WHERE x  \n"))
    return t.events.select("event_id", R.clean_query_text(text).alias("text"))


@query("l04_rank_replacements", """
    SELECT * FROM (VALUES ('app_event_value', 'app.event.value'), ('app_latency', 'app.latency.quantile'), ('service_name', 'service.name'),
      ('event_type', 'event.type'), ('k8s_node_name', 'k8s.node.name')) AS v(name, word_new)
    WHERE (SELECT count(*) FROM part) > 0""")
def l04(t):
    """Replacements used by the dashboards at hand."""
    mentions = dd.dashboards(t).select(F.explode(D.mentioned_names(F.concat("data", F.lit(" app_latency")))).alias("name")).distinct()
    return D.rank_replacements(_mapping(t)).join(mentions, "name", "left_semi").select("name", "word_new")


# ---- alert rules ------------------------------------------------------------------------

NEW_SOURCE = (
    "http://host/alerts?compositeQuery=%25257B%252522builderQueries%252522%25253A%25257B%252522A%252522%25253A%25257B"
    "%252522aggregateAttribute%252522%25253A%25257B%252522key%252522%25253A%252522app.event.value%252522%25257D%25252C"
    "%252522dataSource%252522%25253A%252522metrics%252522%25257D%25257D%25257D&n=«s»&panel=x"
)


def _rule_builder(metric, etype, formula_etype):
    return (
        '{"A":{"aggregateAttribute":{"dataType":"float64","key":"' + metric + '","type":"tag"},"dataSource":"«src»","expression":"A","groupBy":[{"dataType":"string","key":"'
        + etype + '","type":"tag"}],"legend":"{{' + etype + '}}","orderBy":[{"columnName":"' + etype + '","order":"asc"}],"queryName":"A"},'
        '"F1":{"dataSource":"","expression":"A * 2","legend":"{{' + formula_etype + '}}","queryName":"F1"}}'
    )


RULE_SQL = f"""CASE WHEN id % {dd.BAD_PANEL} = 0 THEN 'SELECT (1 FROM telemetry_metrics.series' WHEN src = 'metrics' THEN {_f(NEW_METRICS_SQL)} ELSE {_f(dd.LOGS_SQL)} END"""
RULE_TYPE = "CASE WHEN kind = 0 THEN 'builder' ELSE 'clickhouse_sql' END"

NEW_RULE = fill_sql(
    '{"alert":"«name»","annotations":{"description":"app.event.value high","summary":"x"},"condition":{"compositeQuery":{"builderQueries":«builder»,'
    '"chQueries":{"A":{"disabled":false,"query":"«sql»"}},"promQueries":{"A":{"legend":"event.type","query":"«prom»"}},"queryType":"«type»"},"op":"1","target":«size»},'
    '"dotMigrated":true,"labels":{"n":5,"service.name":"event.type is «s»"},"source":"«source»"}',
    name="name", size="size", s="s", type=RULE_TYPE, sql=RULE_SQL, prom=_f(NEW_PROM),
    builder=f"CASE WHEN src = 'metrics' THEN {_f(_rule_builder('app.event.value', 'event.type', 'event.type'))} ELSE {_f(_rule_builder('app_event_value', 'event_type', 'event_type'))} END",
    source=f"CASE WHEN id % 4 = 0 THEN '' ELSE {_f(NEW_SOURCE)} END",
)


@query("d11_rewrite_alerts", f"WITH {PART} SELECT id, {NEW_RULE} AS data FROM part_docs WHERE {OK_RULE}")
def d11(t):
    return D.rewrite_alerts(_rules(t), _mapping(t), dd.METRICS_DATABASE).where("changed").select("id", "data")


@query("d11_alert_errors", f"""
    WITH {PART} SELECT id, {OK_RULE} AS changed, CASE WHEN id % {dd.BROKEN_JSON} = 0 THEN 'invalid JSON' WHEN id % {dd.DONE} = 0 THEN 'no composite query' END AS error,
      CASE WHEN {OK_RULE} AND id % {dd.BAD_PANEL} = 0 THEN 1 ELSE 0 END AS panel_errors FROM part_docs""")
def d11_errors(t):
    return D.rewrite_alerts(_rules(t), _mapping(t), dd.METRICS_DATABASE).drop("data")


@query("d12_rewrite_source_url", f"WITH {PART} SELECT id, {_f(NEW_SOURCE)} AS source FROM part_docs WHERE {OK_RULE} AND id % 4 <> 0")
def d12(t):
    out = D.rewrite_alerts(_rules(t), _mapping(t), dd.METRICS_DATABASE).where("changed")
    return out.select("id", F.get_json_object("data", "$.source").alias("source")).where("source <> ''")


# ---- log fields ---------------------------------------------------------------------------

LOG_BUILDER = _builder("app_event_value", "service.name", "event.type", "{{event.type}} of event_type_x", "event.type", "A * app_event_value", "{{event.type}}")
LOG_SQL = (
    "SELECT resource_string_service$$name AS s, count() FROM telemetry_logs.logs WHERE"
    " attributes_string_value[indexOf(attributes_string_key, 'event.type')] = 'x' GROUP BY s"
)


@query("d13_rename_log_fields", f"""
    WITH {PART} SELECT id, {fill_sql('[«p»]', p=panels(f"CASE WHEN kind = 0 THEN {_f(LOG_BUILDER)} WHEN id % {dd.BAD_PANEL} = 0 AND j = 0 THEN {_f(_sql('{{service_name}}', dd.BROKEN_SQL))} ELSE {_f(_sql('{{service_name}}', LOG_SQL))} END"))} AS widgets
    FROM part_docs WHERE src = 'logs' AND id % {dd.BROKEN_JSON} <> 0 AND (kind = 0 OR (kind = 1 AND (n > 1 OR id % {dd.BAD_PANEL} <> 0)))""")
def d13(t):
    out = LF.rename_log_fields_dashboards(_dashboards(t), _field_mapping(t), dd.LOG_TABLE).where("changed")
    return out.select("id", F.to_json(V.field(F.parse_json("data"), "widgets")).alias("widgets"))


LOG_RULE = _rule_builder("app_event_value", "event.type", "event.type")


@query("d13_rename_log_fields_alerts", f"""
    WITH {PART} SELECT id, CASE WHEN kind = 0 THEN {_f(LOG_RULE)} ELSE {_f(_rule_builder('app_event_value', 'event_type', 'event_type'))} END AS builder,
      CASE WHEN kind = 0 THEN CASE WHEN id % {dd.BAD_PANEL} = 0 THEN 'SELECT (1 FROM telemetry_metrics.series' ELSE {_f(dd.LOGS_SQL)} END ELSE {_f(LOG_SQL)} END AS sql
    FROM part_docs WHERE src = 'logs' AND {OK_RULE} AND (kind = 0 OR id % {dd.BAD_PANEL} <> 0)""")
def d13_alerts(t):
    out = LF.rename_log_fields_alerts(_rules(t), _field_mapping(t), dd.LOG_TABLE).where("changed")
    composite = V.path(F.parse_json("data"), "condition", "compositeQuery")
    return out.select(
        "id", F.to_json(V.field(composite, "builderQueries")).alias("builder"), V.text(V.path(composite, "chQueries", "A", "query")).alias("sql")
    )


@query("d14_rename_log_fields_sql", f"""
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'select resource_string_service_name from other' ELSE
      'select resource_string_service$$name, resource_string_service$$name_exists, resource_string_service_names, attributes_string_value[indexOf(attributes_string_key, ''event.type'')]' ||
      ' from telemetry_logs.logs where x = ''event_type'' and y = ' || user_id END AS text FROM events""")
def d14(t):
    text = F.when(F.col("event_id") % 3 == 0, "select resource_string_service_name from other").otherwise(
        F.concat(
            F.lit(
                "select resource_string_service_name, resource_string_service_name_exists, resource_string_service_names,"
                " attributes_string_value[indexOf(attributes_string_key, 'event_type')] from telemetry_logs.logs where x = 'event_type' and y = "
            ),
            "user_id",
        )
    )
    fields = _words({"resources_string_service_name": "service.name", "attributes_string_event_type": "event.type"})
    return t.events.select("event_id", LF.rename_log_fields_sql(text, fields, dd.LOG_TABLE).alias("text"))


@query("j13_resolve_fields", """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'attributes_string_service_name' ELSE 'resources_string_service_name' END AS ref,
           'service.name' AS new_name FROM events WHERE event_id % 3 <> 0""")
def j13(t):
    eid = F.col("event_id")
    name = F.when(eid % 3 == 0, "other_name").otherwise("service_name")
    refs = t.events.select("event_id", LF.reference(F.when(eid % 2 == 0, "tag").otherwise("resource"), F.lit("String"), name).alias("ref"))
    return LF.resolve_fields(refs, _field_mapping(t))


# ---- legacy documents ------------------------------------------------------------------------

OPERATORS = "CASE {} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in legacy_names.AGGREGATIONS.items()) + " ELSE 'noop' END"
REDUCE = "CASE {} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in legacy_names.REDUCTIONS.items()) + " ELSE 'last' END"
TYPES = "CASE {} WHEN 2 THEN 'clickhouse_sql' WHEN 3 THEN 'promql' ELSE 'builder' END"

V3_PANEL = fill_sql(
    '{"extra":1,"id":"w«j»","panelTypes":"«panel»","query":{"builder":{"queryData":[{"aggregateAttribute":{"dataType":"float64","isColumn":true,"key":"m«s»","type":""},'
    '"aggregateOperator":"«op»","dataSource":"metrics","disabled":false,"expression":"A","filters":{"items":[{"id":"«fid»","key":{"dataType":"string","isColumn":false,"key":"k","type":"tag"},'
    '"op":"nin","value":["a",«s»]}],"op":"AND"},"groupBy":[{"dataType":"string","isColumn":false,"key":"g1","type":"tag"},{"dataType":"string","isColumn":false,"key":"g2","type":"tag"}],'
    '"having":[],"legend":"q","limit":0,"offset":0,"orderBy":[],"pageSize":0,"queryName":"A","reduceTo":"«reduce»","stepInterval":60}],'
    '"queryFormulas":[{"disabled":false,"expression":"A / 2","legend":"f","name":"F1","queryName":"F1"}]},"clickhouse_sql":[{"disabled":true,"legend":"l","name":"A","rawQuery":"select «j»"}],'
    '"promql":[{"disabled":false,"legend":"","name":"A","query":"up"}],"queryType":"«type»"},'
    '"queryData":{"data":{"legend":"","query":"","queryData":[]},"error":false,"errorMessage":"","loading":false},"title":"«name»"}',
    j="j", name="name", s="s", panel="CASE WHEN id % 2 = 0 THEN 'graph' ELSE 'value' END", op=OPERATORS.format("1 + (id + j) % 31"),
    reduce=REDUCE.format("id % 7"), type=TYPES.format("id % 4"), fid="md5(id || '/' || j || '/0/0')",
)


@query("d15_upgrade_dashboards_v3", f"""
    WITH {PART} SELECT id, {fill_sql('{"title":"«name»","variables":{"v":{"name":"v","type":"QUERY"}},"widgets":[«p»]}', name="name", p=panels(V3_PANEL))} AS data
    FROM part_docs WHERE id % 11 <> 0""")
def d15(t):
    return L.upgrade_dashboards_v3(dd.legacy_dashboards(t)).where("changed").select("id", "data")


V3_RULE = fill_sql(
    '{"alert":"«name»","condition":{"compositeQuery":{"builderQueries":{"A":{"aggregateAttribute":{"dataType":"float64","isColumn":true,"key":"m","type":""},"aggregateOperator":"«op»",'
    '"dataSource":"metrics","disabled":false,"expression":"A","filters":{"items":[{"key":{"dataType":"string","isColumn":false,"key":"k","type":"tag"},"op":"like","value":"v"}],"op":"AND"},'
    '"groupBy":[{"dataType":"string","isColumn":false,"key":"g","type":"tag"}],"limit":0,"offset":0,"pageSize":0,"queryName":"A","reduceTo":"sum","stepInterval":60}},'
    '"chQueries":{"A":{"disabled":true,"query":"q"}},"panelType":"«panel»","promQueries":{"A":{"disabled":false,"query":"p","stats":"all"}},"queryType":"«type»"},'
    '"matchType":"2","op":"1","target":«s»},"evalWindow":"«window»","extra":[1],"frequency":"«frequency»"}',
    name="name", s="s", op=OPERATORS.format("1 + id % 31"), panel="CASE id % 4 WHEN 2 THEN 'value' ELSE 'graph' END", type=TYPES.format("id % 5"),
    window="CASE WHEN size = 0 THEN '0s' WHEN size < 60 THEN size || 'm0s' ELSE (size // 60) || 'h' || (size % 60) || 'm0s' END",
    frequency="CASE WHEN id % 90 = 0 THEN '1.5s' WHEN id % 90 < 60 THEN (id % 90) || 'm1.5s' ELSE '1h' || (id % 90 - 60) || 'm1.5s' END",
)


@query("d16_upgrade_rules_v3", f"WITH {PART} SELECT id, {V3_RULE} AS data FROM part_docs WHERE id % 11 <> 0")
def d16(t):
    return L.upgrade_rules_v3(dd.legacy_rules(t)).where("changed").select("id", "data")


@query("d16_durations", """
    SELECT event_id, CASE WHEN s = 0 THEN '0s' WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' || (s % 60) || 's'
      ELSE (s // 3600) || 'h' || (s // 60 % 60) || 'm' || (s % 60) || 's' END AS from_number,
      CASE WHEN s < 3600 THEN CASE WHEN s < 60 THEN CASE WHEN s = 0 THEN '0s' ELSE s || 's' END ELSE (s // 60) || 'm' || (s % 60) || 's' END
      ELSE (s // 3600) || 'h' || (s // 60 % 60) || 'm' || (s % 60) || 's' END AS from_text,
      CASE WHEN event_id % 1000 = 0 THEN '0s' ELSE (event_id % 1000) || 'ms' END AS short FROM (SELECT event_id, event_id * 7 AS s FROM events)""")
def d16_durations(t):
    s = F.col("event_id") * 7

    def shown(value):
        return V.text(L.normal_duration(value.cast("variant")))

    return t.events.select(
        "event_id",
        shown(s * 1_000_000_000).alias("from_number"),
        shown(F.concat(s.cast("string"), F.lit("s"))).alias("from_text"),
        shown(F.concat((F.col("event_id") % 1000).cast("string"), F.lit("ms"))).alias("short"),
    )


D17_PANEL = fill_sql(
    '{"id":"w«j»","keep":«s»,"query":{"clickHouse":[{"disabled":false,"legend":"","name":"A","rawQuery":""}],"metricsBuilder":{"formulas":[],"queryBuilder":[{"aggregateOperator":1,'
    '"disabled":false,"groupBy":[],"legend":"","metricName":"","name":"A","reduceTo":1,"tagFilters":{"items":[],"op":"AND"}}]},'
    '"promQL":[{"disabled":false,"legend":"l","name":"A","query":"up«j»"},{"disabled":false,"legend":"","name":"B","query":"down"}],"queryType":3},'
    '"queryData":{"data":{"legend":"","query":"","queryData":[]},"error":false,"errorMessage":"","loading":false},"queryType":3}',
    j="j", s="s",
)


@query("d17_upgrade_dashboards_promql", f"""
    WITH {PART} SELECT id, {fill_sql('{"title":"«name»","widgets":[«p»]}', name="name", p=panels(D17_PANEL))} AS data FROM part_docs WHERE id % 11 <> 0""")
def d17(t):
    return L.upgrade_dashboards_promql(dd.promql_dashboards(t)).where("changed").select("id", "data")


@query("d18_repair_layout", f"""
    WITH {PART} SELECT id, {fill_sql('[«p»]', p=layout("'w' || j", 1))} AS layout FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0""")
def d18(t):
    out = L.repair_layout(dd.dashboards(t)).where("error is null")
    return out.select("id", F.to_json(V.field(F.parse_json("data"), "layout")).alias("layout"))


@query("d19_double_layout_height", f"""
    WITH {PART} SELECT id, CASE WHEN id % {dd.DONE} = 0 THEN {fill_sql('[«p»]', p=layout(OLD_ENTRY, 1))} ELSE {fill_sql('[«p»]', p=layout(OLD_ENTRY, 2))} END AS layout,
      id % {dd.DONE} <> 0 AS changed, TRUE AS flag FROM part_docs WHERE id % {dd.BROKEN_JSON} <> 0""")
def d19(t):
    out = L.double_layout_height(L.double_layout_height(dd.dashboards(t)).drop("error").withColumnRenamed("changed", "first"))
    doc = F.parse_json("data")
    return out.where("error is null").select(
        "id", F.to_json(V.field(doc, "layout")).alias("layout"), F.col("first").alias("changed"), V.is_true(V.field(doc, L.LAYOUT_FLAG)).alias("flag")
    )


@query("d20_present_form", f"WITH {PART} SELECT id, id % 11 = 0 AS builder_form, TRUE AS old_is_object, id % 11 = 0 AS three_languages FROM part_docs")
def d20(t):
    old, first = dd.legacy_dashboards(t), dd.promql_dashboards(t).withColumnRenamed("data", "first")
    both = old.join(first, "id")
    doc = F.parse_json("data")
    return both.select(
        "id", L.is_builder_dashboard(doc).alias("builder_form"), V.entries(doc).isNotNull().alias("old_is_object"),
        L.is_multi_language(F.parse_json("first")).alias("three_languages"),
    )


# ---- verification ------------------------------------------------------------------------------


@query("v03_json_changed", "SELECT event_id, event_id % 3 = 0 AS changed FROM events")
def v03(t):
    spaced = F.concat(F.lit('{ "b": [1.0, 2], "a" : '), "props", F.lit(" }"))
    other = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"a":'), "props", F.lit(',"b":[2,1]}'))).otherwise(
        F.concat(F.lit('{"a":'), "props", F.lit(',"b":[1,2.0]}'))
    )
    return t.events.select("event_id", verify.json_changed(spaced, other).alias("changed"))


@query("v04_pending_documents", f"WITH {PART} SELECT id FROM part_docs WHERE id % {dd.DONE} <> 0 OR id % {dd.BROKEN_JSON} = 0")
def v04(t):
    return verify.pending_documents(dd.dashboards(t), D.MIGRATED).select("id")


@query("b55_legacy_operator", f"SELECT event_id, {OPERATORS.format('event_id % 35')} AS name FROM events")
def b55(t):
    return t.events.select("event_id", legacy_names.legacy_operator(F.col("event_id") % 35).alias("name"))


@query("b56_legacy_reduce", f"SELECT event_id, {REDUCE.format('event_id % 8')} AS name FROM events")
def b56(t):
    return t.events.select("event_id", legacy_names.legacy_reduce(F.col("event_id") % 8).alias("name"))


@query("b57_legacy_types", f"""
    SELECT event_id, {TYPES.format('event_id % 5')} AS query_type, CASE event_id % 4 WHEN 2 THEN 'value' ELSE 'graph' END AS panel_number,
      CASE event_id % 3 WHEN 0 THEN 'graph' WHEN 1 THEN 'value' ELSE 'TABLE' END AS panel_name FROM events""")
def b57(t):
    eid = F.col("event_id")
    name = F.when(eid % 3 == 0, "TIME_SERIES").when(eid % 3 == 1, "VALUE").otherwise("TABLE")
    return t.events.select(
        "event_id",
        legacy_names.legacy_query_type(eid % 5).alias("query_type"),
        legacy_names.legacy_panel(eid % 4, numbered=True).alias("panel_number"),
        legacy_names.legacy_panel(name).alias("panel_name"),
    )


