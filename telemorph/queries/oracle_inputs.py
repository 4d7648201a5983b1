"""The derived tables once more, as SQL for the checking engine.

Maps and arrays are spelled out as plain columns there, so that the SQL states
the expected content without the functions under test.
"""

from __future__ import annotations

# name -> (names it needs, query)
CTES: dict[str, tuple[list[str], str]] = {
    "ev": ([], """
        SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type, value, props,
               CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT) AS k, 'svc' || (user_id % 10) AS svc
        FROM events"""),
    "errors_v1": (["ev"], """
        SELECT md5(CAST(event_id AS VARCHAR)) AS "errorID", 'Err' || (user_id % 7) AS "exceptionType",
               props AS "exceptionStacktrace",
               CASE event_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' ELSE '' END AS "exceptionEscaped",
               'k=' || (k % 5) AS "exceptionMessage", ts, us, 's' || event_id AS "spanID",
               't' || (event_id // 8) AS "traceID", svc AS "serviceName"
        FROM ev WHERE event_type = 'error'"""),
    # Flat logs: one column per attribute the map may hold.
    "logs": (["ev"], """
        SELECT event_id, 'log' || event_id AS id, us * 1000 + event_id % 1000 AS ns,
               ((us // 1000000) // 1800) * 1800 AS bucket,
               CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity_text,
               event_type || ' ' || props AS body, event_type, value,
               CASE WHEN event_id % 5 = 0 THEN k + 0.5 ELSE CAST(k AS DOUBLE) END AS k,
               event_type = 'error' AS is_error, svc,
               CASE WHEN user_id % 2 = 0 THEN 'h' || (user_id % 3) END AS host,
               CASE WHEN user_id % 2 = 0
                    THEN '{"host.name":"h' || (user_id % 3) || '","service.name":"' || svc || '"}'
                    ELSE '{"service.name":"' || svc || '"}' END AS labels,
               us // 1000 AS ms
        FROM ev"""),
    "spans": (["ev"], """
        SELECT event_id, ts, us, us // 1000 AS ms, 't' || (event_id // 8) AS trace_id, 's' || event_id AS span_id,
               CASE WHEN event_id % 8 = 0 THEN '' ELSE 's' || (event_id - 1) END AS parent_span_id,
               event_type AS name, event_id % 6 AS kind, 'kind' || (event_id % 6) AS kind_string,
               CAST(round(value * 1e6) AS BIGINT) AS duration_nano,
               CASE WHEN event_type = 'error' THEN 2 ELSE 0 END AS status_code,
               CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Unset' END AS status_code_string,
               event_type, '/r/' || (k % 5) AS route, k, k % 2 = 0 AS even, svc,
               CASE WHEN user_id % 2 = 0 THEN 'h' || (user_id % 3) END AS host,
               CASE WHEN user_id % 2 = 0
                    THEN '{"host.name":"h' || (user_id % 3) || '","service.name":"' || svc || '"}'
                    ELSE '{"service.name":"' || svc || '"}' END AS labels,
               CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS http_method,
               '/u/' || (k % 5) AS http_url, event_type = 'error' AS has_error,
               CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS response_status_code,
               ((us // 1000000) // 1800) * 1800 AS bucket,
               CASE WHEN event_id % 97 = 0 THEN ''
                    WHEN event_id % 89 = 0 THEN 'null'
                    ELSE '[{"refType":"CHILD_OF","spanId":"s' || (event_id - 1) ||
                         CASE WHEN event_id % 101 = 0 THEN 'x' ELSE '' END || '"}]' END AS links
        FROM ev"""),
    "series1": (["ev"], """
        SELECT DISTINCT event_type, svc, CAST(ts AS DATE) AS d,
               '{"__name__":"app_event_value","event_type":"' || event_type || '","service_name":"' || svc || '"}' AS labels
        FROM ev WHERE NOT (event_type = 'signup' AND svc = 'svc9')"""),
    "points": (["ev"], """
        SELECT q.*, CAST(10000000000000000000 + CAST('0x' || substr(md5(labels || temporality), 1, 12) AS BIGINT)::HUGEINT AS VARCHAR) AS fingerprint,
               (ms // 3600000) * 3600000 AS hour_ms
        FROM (
          SELECT event_id, us // 1000 AS ms, value, event_type, svc, 'node' || (user_id % 3) AS node,
                 ts < TIMESTAMP '2024-01-20' AS normalized,
                 CASE user_id % 3 WHEN 0 THEN 'Cumulative' WHEN 1 THEN 'Delta' ELSE 'Unspecified' END AS temporality,
                 m.metric_name, m.mtype, m.labels
          FROM ev, LATERAL (
            SELECT 'app_event_value' AS metric_name, 'Gauge' AS mtype,
                   '{"__name__":"app_event_value","event_type":"' || event_type || '","k8s_node_name":"node' || (user_id % 3) ||
                   '","scope_ver":"v1","service_name":"' || svc || '"}' AS labels WHERE ts < TIMESTAMP '2024-01-20'
            UNION ALL
            SELECT 'app.event.value', 'Gauge',
                   '{"__name__":"app.event.value","event.type":"' || event_type || '","scope.ver":"v1","service.name":"' || svc ||
                   '","service_name":"' || svc || '"}' WHERE ts >= TIMESTAMP '2024-01-20'
            UNION ALL
            SELECT 'app_latency', 'Summary', '{"__name__":"app_latency","quantile":"0.9","service_name":"' || svc || '"}'
            WHERE ts < TIMESTAMP '2024-01-20' AND event_type = 'error'
            UNION ALL
            SELECT 'app.latency.quantile', 'Summary', '{"__name__":"app.latency.quantile","service.name":"' || svc || '"}'
            WHERE ts >= TIMESTAMP '2024-01-20' AND event_type = 'error'
            UNION ALL
            SELECT 'app_legacy_total', 'Sum', '{"__name__":"app_legacy_total","service_name":"' || svc || '"}'
            WHERE ts < TIMESTAMP '2024-01-20' AND event_type = 'signup'
          ) m
        ) q"""),
    "series4": (["points"], """
        SELECT DISTINCT fingerprint, metric_name, mtype, temporality, labels, normalized, hour_ms, event_type_l AS event_type, svc, node_l AS node
        FROM (SELECT *, CASE WHEN mtype = 'Gauge' THEN event_type END AS event_type_l,
                        CASE WHEN metric_name = 'app_event_value' THEN node END AS node_l FROM points)"""),
    "fields": (["ev"], """
        SELECT DISTINCT name, datatype, type FROM (
          SELECT unnest(['event.type','event_type','k','value','is_error','body','timestamp','service.name','service_name','host.name','host_name','user.' || (user_id % 10)]) AS name,
                 unnest(['string','string','int64','float64','bool','string','int64','string','string','string','int64','string']) AS datatype,
                 unnest(['attribute','attribute','attribute','attribute','attribute','attribute','attribute','resource','resource','resource','resource','attribute']) AS type
          FROM ev)"""),
    "defs": ([], """
        SELECT p_partkey, 'tbl_' || p_partkey AS name, p_size, p_partkey % 5 AS kind, (p_partkey + p_size) % 5 AS kind2,
               (p_size % 30 + 1) * 86400 AS del, (p_size % 7 + 1) * 86400 AS mov
        FROM part"""),
    "ttls": (["defs"], """
        SELECT *, CASE kind WHEN 3 THEN -1 WHEN 4 THEN mov ELSE del END AS delete_ttl,
                  CASE WHEN kind IN (1, 2, 4) THEN mov ELSE -1 END AS move_ttl,
                  CASE kind WHEN 1 THEN 'cold' WHEN 2 THEN 's3' WHEN 4 THEN 'cold' ELSE '' END AS cold_tier,
                  CASE kind2 WHEN 3 THEN -1 WHEN 4 THEN mov ELSE del END AS cur_delete,
                  CASE WHEN kind2 IN (1, 2, 4) THEN mov ELSE -1 END AS cur_move
        FROM defs"""),
    "hist": ([], """
        SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS month, b.le,
               CAST(count(*) FILTER (WHERE l_quantity <= b.le) AS DOUBLE) AS value
        FROM lineitem, (VALUES (10.0::DOUBLE), (20.0), (30.0), (40.0), (50.0), ('infinity'::DOUBLE)) AS b(le)
        GROUP BY 1, 2, 3"""),
}


def with_(names: str, body: str) -> str:
    """``body`` under the named derived tables and what they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        for other in CTES[name][0]:
            add(other)
        if name not in needed:
            needed.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in needed)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def text_bytes(text: str) -> str:
    """List of the byte values of an ASCII text expression."""
    return f"list_transform(string_split({text}, ''), lambda c: unicode(c)::HUGEINT)"


def pair_bytes(key: str, value: str) -> str:
    return f"({text_bytes(key)} || [255::HUGEINT] || {text_bytes(value)} || [255::HUGEINT])"


def hash_of(byte_lists: str) -> str:
    """64-bit FNV-1a of a byte list, as text."""
    return (
        f"CAST(list_reduce([14695981039346656037::HUGEINT] || {byte_lists}, "
        "lambda h, b: (xor(h, b) * 1099511628211::HUGEINT) % 18446744073709551616::HUGEINT) AS VARCHAR)"
    )
