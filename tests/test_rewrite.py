"""Names inside query text. Expected texts are compared as token streams: spaces,
keyword case, optional AS and the place of a label list do not count."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telemorph.functions import rewrite as R


def literal_map(pairs):
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def sql_tokens(text):
    pieces = re.findall(r"'[^']*'|`[^`]*`|\$[\w.]+|\w+|\S", text)
    return [p if p[0] in "'`$" else p.lower() for p in pieces if p.lower() != "as"]


def prom_tokens(text):
    text = re.sub(r"\(\s*\)", "", text)
    return Counter(re.findall(r'"[^"]*"|\w+|[^\s\w]', text))


# Shapes of own making; each expectation follows from one rule: mapped metrics move
# into braces as quoted names, mapped labels are quoted where they stand.
QUEUE = {"queue_depth": "queue.depth", "queue_name": "queue.name", "batch_errors": "batch.errors"}

PROM_CASES = [
    ("queue_depth", QUEUE, '{"queue.depth"}'),
    ('queue_depth{queue_name="in",zone!="b"}', QUEUE, '{"queue.depth","queue.name"="in",zone!="b"}'),
    ("min by (queue_name) (queue_depth) * 2", QUEUE, 'min by ("queue.name") ({"queue.depth"}) * 2'),
    ("increase(batch_errors[10m] offset 2h)", QUEUE, 'increase({"batch.errors"}[10m] offset 2h)'),
    ("deriv(queue_depth[1h:2m])", QUEUE, 'deriv({"queue.depth"}[1h:2m])'),
    ("(queue_depth - batch_errors) / queue_depth", QUEUE, '({"queue.depth"} - {"batch.errors"}) / {"queue.depth"}'),
    ("count without (queue_name) (batch_errors > 0)", QUEUE, 'count without ("queue.name") ({"batch.errors"} > 0)'),
    ('{__name__="queue_depth"}', QUEUE, '{__name__="queue.depth"}'),
]


@pytest.mark.parametrize("query,mapping,want", PROM_CASES)
def test_promql(spark, query, mapping, want):
    assert one(spark, R.prom_error(F.lit(query))) is None
    assert prom_tokens(one(spark, R.rewrite_promql(F.lit(query), literal_map(mapping)))) == prom_tokens(want)


def test_promql_names_and_errors(spark):
    names = one(spark, R.prom_metric_names(F.lit('sum by (x) (rate(a_b{c="d"}[5m])) / on (y) max(e) + {__name__="f"} and g offset 5m')))
    assert sorted(names) == ["a_b", "e", "f", "g"]
    assert one(spark, R.prom_error(F.lit('rate(a{b="c[5m])'))) is not None
    assert one(spark, R.prom_error(F.lit("rate(a[5m]"))) is not None
    assert one(spark, R.prom_error(F.lit(" "))) == "empty"


SQL_CASES = [
    ("SELECT queue_name FROM t", QUEUE, "SELECT `queue.name` FROM t"),
    ("SELECT max(v) FROM t WHERE m = 'queue_depth' OR m = 'other'", QUEUE, "SELECT max(v) FROM t WHERE m = 'queue.depth' OR m = 'other'"),
    ("WITH q AS (SELECT queue_name, v FROM t) SELECT q.queue_name, sum(q.v) FROM q GROUP BY 1", QUEUE, "WITH q AS (SELECT `queue.name`, v FROM t) SELECT q.`queue.name`, sum(q.v) FROM q GROUP BY 1"),
    ("SELECT x.v FROM t x LEFT JOIN u y ON y.queue_name = x.queue_name", QUEUE, "SELECT x.v FROM t x LEFT JOIN u y ON y.`queue.name` = x.`queue.name`"),
    ("SELECT v FROM t WHERE EXISTS (SELECT 1 FROM u WHERE u.queue_name = $queue_name)", QUEUE, "SELECT v FROM t WHERE EXISTS (SELECT 1 FROM u WHERE u.`queue.name` = $queue.name)"),
    ("SELECT lag(v) OVER (ORDER BY queue_name) FROM t UNION ALL SELECT 0", QUEUE, "SELECT lag(v) OVER (ORDER BY `queue.name`) FROM t UNION ALL SELECT 0"),
    ("SELECT if(queue_name = '', 'none', queue_name) FROM t LIMIT 5", QUEUE, "SELECT if(`queue.name` = '', 'none', `queue.name`) FROM t LIMIT 5"),
]


@pytest.mark.parametrize("query,mapping,want", SQL_CASES)
def test_sql(spark, query, mapping, want):
    assert one(spark, R.sql_error(F.lit(query))) is None
    got = one(spark, R.rewrite_sql(F.lit(query), literal_map(mapping), literal_map({})))
    assert sql_tokens(got) == sql_tokens(want)


def test_sql_second_mapping_and_quotes(spark):
    text = "SELECT `a_b`, \"c_d\", x.a_b, a_bc -- a_b stays\nFROM t /* a_b */ WHERE v = 'a_b' AND w = 'it''s a_b' AND p = $a_b"
    got = one(spark, R.rewrite_sql(F.lit(text), literal_map({"a_b": "a.b"}), literal_map({"a.b": "a.x", "c_d": "c.d"})))
    assert got == (
        "SELECT `a.x`, `c.d`, x.`a.x`, a_bc -- a_b stays\nFROM t /* a_b */ WHERE v = 'a.x' AND w = 'it''s a_b' AND p = $a.b"
    )


@pytest.mark.parametrize("text,bad", [("SELECT 'x FROM t", True), ("SELECT (1", True), ("hello there", True), ("(select 1)", False), ("-- c\nWITH a AS (SELECT 1) SELECT * FROM a", False)])
def test_sql_error(spark, text, bad):
    assert (one(spark, R.sql_error(F.lit(text))) is not None) == bad


def test_text_helpers(spark):
    m = literal_map({"a_b": "a.b", "n": "x"})
    assert one(spark, R.replace_tokens(F.lit("{{a_b}} a_bc (a_b)"), m)) == "{{a.b}} a_bc (a.b)"
    assert one(spark, R.replace_placeholders(F.lit("$a_b $a_bc $$a_b a_b"), m)) == "$a.b $a_bc $$a.b a_b"
    assert one(spark, R.template_to_param(F.lit("{{ .env }} {{x1}} {{a-b}}"))) == "$env $x1 {{a-b}}"
    assert one(spark, R.clean_query_text(F.lit("a \t\r\n\n\n  \n b\n"))) == "a\n b"


def test_rename_in_json(spark):
    m = literal_map({"a_b": "a.b", "foo_bar": "foo.bar"})
    text = F.to_json(F.parse_json(F.lit(r'{"a_b": {"k": ["foo_bar", "x\nfoo_bar \"a_b\" \\a_b", 1, null, true]}, "x a_b": "é a_b"}')))
    got = one(spark, R.rename_in_json(text, m, m))
    assert got == r'{"a.b":{"k":["foo.bar","x\nfoo.bar \"a.b\" \\a.b",1,null,true]},"x a_b":"é a.b"}'


def test_long_text_does_not_overflow(spark):
    long = "SELECT '" + "x\\'" * 50_000 + "' FROM a_b"
    got = one(spark, R.rewrite_sql(F.lit(long), literal_map({"a_b": "a.b"}), literal_map({})))
    assert got.endswith("`a.b`") and len(got) == len(long) + 2
