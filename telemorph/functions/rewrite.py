"""Replacing names inside query text, JSON text and plain text.

All functions work on tokens cut out by one regular expression per language;
nothing is parsed further than needed to tell names, strings and label lists
apart. Names come as MAP<old, new> columns of the same row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemorph.functions.variants import let, no_items

# Quoted pieces, written so that matching needs no backtracking.
DOUBLE_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
SINGLE_QUOTED = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
BACK_QUOTED = r"`[^`]*+`"


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _look(mapping: Column, name: Column) -> Column:
    return F.try_element_at(mapping, name)


def _inner(piece: Column) -> Column:
    """A quoted piece without its quotes."""
    return F.substring(piece, F.lit(2), F.length(piece) - 2)


# ---- plain text --------------------------------------------------------------------


def replace_tokens(text: Column, mapping: Column) -> Column:
    """Replace whole words. Words are maximal runs of letters, digits and ``_``."""
    return F.array_join(F.transform(_all(text, r"\w+|\W+"), lambda w: F.coalesce(_look(mapping, w), w)), "")


def replace_placeholders(text: Column, mapping: Column) -> Column:
    """Replace ``$name`` by ``$new`` where the whole name is mapped."""
    renamed = F.transform(
        _all(text, r"\$\w+|[^$]+|\$"),
        lambda p: F.coalesce(
            F.when(F.startswith(p, F.lit("$")), F.concat(F.lit("$"), _look(mapping, F.substring(p, F.lit(2), F.length(p))))), p
        ),
    )
    return F.array_join(renamed, "")


def template_to_param(text: Column) -> Column:
    """``{{ .name }}`` or ``{{name}}`` to ``$name``."""
    return F.regexp_replace(text, r"\{\{\s*\.?([A-Za-z_][A-Za-z0-9_]*)\s*\}\}", r"\$$1")


def clean_query_text(text: Column) -> Column:
    """Drop carriage returns, spaces at line ends and blank lines."""
    lines = F.split(F.replace(text, F.lit("\r"), F.lit("")), "\n")
    trimmed = F.transform(lines, lambda line: F.regexp_replace(line, r"[ \t]+\z", ""))
    return F.array_join(F.filter(trimmed, lambda line: line.rlike(r"(?U)\S")), "\n")


# ---- JSON text ---------------------------------------------------------------------

_JSON_PIECES = rf"{DOUBLE_QUOTED}:?|[^\"]+"
# A word next to an escape sequence must not swallow its letter.
_JSON_WORDS = r"\\u[0-9A-Fa-f]{4}|\\.|\w+|[^\w\\]+"


def _json_escape(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def rename_in_json(json: Column, exact: Column, words: Column) -> Column:
    """Rename throughout canonical JSON text, as ``to_json`` writes it: object
    keys where the whole key is in ``exact``, strings where the whole string is,
    and else word by word with ``words``."""

    def renamed(piece: Column) -> Column:
        key = F.endswith(piece, F.lit(":"))
        body = F.when(key, F.substring(piece, F.lit(2), F.length(piece) - 3)).otherwise(_inner(piece))

        def by_content(content: Column) -> Column:
            whole = _json_escape(_look(exact, content))
            by_word = F.array_join(
                F.transform(_all(content, _JSON_WORDS), lambda w: F.coalesce(_json_escape(_look(words, w)), w)), ""
            )
            inside = F.coalesce(whole, F.when(key, content).otherwise(by_word))
            return F.concat(F.lit('"'), inside, F.when(key, F.lit('":')).otherwise(F.lit('"')))

        return F.when(F.startswith(piece, F.lit('"')), let(body, by_content)).otherwise(piece)

    return F.array_join(F.transform(_all(json, _JSON_PIECES), renamed), "")


def rename_variant(value: Column, exact: Column, words: Column) -> Column:
    return F.coalesce(F.try_parse_json(rename_in_json(F.to_json(value), exact, words)), value)


# ---- SQL ---------------------------------------------------------------------------

SQL_PIECES = (
    r"(?s)--[^\n]*+|/\*(?:[^*]|\*(?!/))*+\*/|"
    + f"{SINGLE_QUOTED}|{BACK_QUOTED}|{DOUBLE_QUOTED}"
    + r"|\$\w+|\d[\w.]*+|[A-Za-z_]\w*+|\s++|."
)
SQL_STATEMENTS = ["select", "with", "explain", "show", "describe", "desc", "set", "use", "insert", "alter", "create", "drop"]
_IDENTIFIER = r"\A[A-Za-z_]\w*\z"


def _quoted(piece: Column, *marks: str) -> Column:
    starts = F.lit(False)
    for mark in marks:
        starts = starts | F.startswith(piece, F.lit(mark))
    return starts & (F.length(piece) > 1)


def sql_metric_names(text: Column) -> Column:
    """The pieces that can name a metric: identifiers and string literals."""
    named = F.transform(
        _all(text, SQL_PIECES), lambda p: F.when(p.rlike(_IDENTIFIER), p).when(_quoted(p, "'", "`", '"'), _inner(p))
    )
    return F.array_distinct(F.array_compact(named))


def _unbalanced(pieces: Column, pairs: list[tuple[str, str]]) -> Column:
    def count(mark: str) -> Column:
        return F.size(F.filter(pieces, lambda p: p == mark))

    bad = F.lit(False)
    for left, right in pairs:
        bad = bad | (count(left) != count(right))
    return bad


def sql_error(text: Column) -> Column:
    """Why an SQL text cannot be cut into tokens safely; NULL if it can."""

    def checked(pieces: Column) -> Column:
        words = F.filter(pieces, lambda p: ~p.rlike(r"\A(?:\s+|--.*|/\*(?s).*|\()\z"))
        return (
            F.when(F.exists(pieces, lambda p: p.isin("'", '"', "`")), F.lit("unclosed quote"))
            .when(_unbalanced(pieces, [("(", ")"), ("[", "]")]), F.lit("unbalanced brackets"))
            .when(~F.coalesce(F.lower(F.get(words, 0)).isin(SQL_STATEMENTS), F.lit(False)), F.lit("not a statement"))
        )

    return let(_all(text, SQL_PIECES), checked)


def rewrite_sql(text: Column, mapping: Column, everywhere: Column) -> Column:
    """Replace names in SQL text, first by ``mapping``, then by ``everywhere``.
    A replaced identifier is put in back-quotes, a parameter keeps its ``$``, a
    string literal its quotes."""

    def new_name(name: Column) -> Column:
        first = F.coalesce(_look(mapping, name), name)
        final = let(first, lambda n: F.coalesce(_look(everywhere, n), n))
        return F.when(_look(mapping, name).isNotNull() | _look(everywhere, name).isNotNull(), final)

    def backticked(name: Column) -> Column:
        return F.concat(F.lit("`"), new_name(name), F.lit("`"))

    def renamed(p: Column) -> Column:
        parameter = F.substring(p, F.lit(2), F.length(p))
        return F.coalesce(
            F.when(p.rlike(_IDENTIFIER), backticked(p))
            .when(_quoted(p, "'"), F.concat(F.lit("'"), new_name(_inner(p)), F.lit("'")))
            .when(_quoted(p, "`", '"'), backticked(_inner(p)))
            .when(_quoted(p, "$"), F.concat(F.lit("$"), F.coalesce(_look(everywhere, parameter), _look(mapping, parameter)))),
            p,
        )

    return F.array_join(F.transform(_all(text, SQL_PIECES), renamed), "")


# ---- PromQL ------------------------------------------------------------------------

PROM_OPERATORS = "and|or|unless|by|without|on|ignoring|group_left|group_right|offset|bool|atan2"
_ANY_QUOTED = f"(?:{DOUBLE_QUOTED}|'[^'\\\\]*+(?:\\\\.[^'\\\\]*+)*+'|{BACK_QUOTED})"
_BRACES = r"\{(?:[^{}\"'`]++|" + _ANY_QUOTED + r")*+\}"
_LABEL_LIST = r"(?i:\b(?:by|without|on|ignoring|group_left|group_right))\s*\([^()]*+\)"
_SELECTOR = rf"(?:(?!(?i:{PROM_OPERATORS})\b)[A-Za-z_:][\w:]*\s*)?{_BRACES}"
PROM_PIECES = (
    r"(?s)#[^\n]*+|" + f"{_LABEL_LIST}|{_SELECTOR}|{_ANY_QUOTED}"
    + r"|\[[^\]]*+\]|\$\w+|\d[\w.]*+"
    # A function, or an aggregation whose label list stands before its argument.
    + r"|[A-Za-z_]\w*+(?=\s*(?:\(|(?i:by|without)\b))"
    + r"|[A-Za-z_:][\w:]*+|\s++|."
)
_MATCHER = rf"(?:[A-Za-z_][\w.]*|\"[^\"]*\")\s*(?:=~|!~|!=|=)\s*{_ANY_QUOTED}|\"[^\"]*\""
_MATCHER_PARTS = r"(?s)\A\"?([^\"=!~\s]+)\"?\s*(=~|!~|!=|=)\s*(.)(.*).\z"
_BARE_METRIC = rf"\A(?!(?i:{PROM_OPERATORS}|inf|nan)\z)[A-Za-z_:][\w:]*\z"


def _prom_pieces(text: Column) -> Column:
    """Pieces with their kind: ``list``, ``selector``, ``metric`` or ``other``."""
    raw = _all(text, PROM_PIECES)

    def kind(p: Column, following: Column) -> Column:
        called = following.rlike(r"(?i)\A(?:\(|(?:by|without)\b)")
        return (
            F.when(p.rlike(rf"\A{_LABEL_LIST}\z"), F.lit("list"))
            .when(F.endswith(p, F.lit("}")) & p.rlike(r"\A(?:[A-Za-z_:]|\{)"), F.lit("selector"))
            .when(p.rlike(_BARE_METRIC) & ~F.coalesce(called, F.lit(False)), F.lit("metric"))
            .otherwise(F.lit("other"))
        )

    def tagged(pieces: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            after = F.get(pieces, i + 1)
            following = F.when(after.rlike(r"\A\s+\z"), F.get(pieces, i + 2)).otherwise(after)
            return F.struct(kind(p, following).alias("kind"), p.alias("text"))

        return F.transform(pieces, one)

    return let(raw, tagged)


def prom_metric_names(text: Column) -> Column:
    """Metric names a PromQL text selects."""
    named = F.transform(
        _prom_pieces(text),
        lambda p: F.when(p["kind"] == "metric", F.array(p["text"])).when(
            p["kind"] == "selector",
            F.array(
                F.nullif(F.regexp_extract(p["text"], r"\A([A-Za-z_:][\w:]*)", 1), F.lit("")),
                F.nullif(F.regexp_extract(p["text"], r"__name__\s*=\s*\"([^\"]*)\"", 1), F.lit("")),
            ),
        ),
    )
    return F.array_distinct(F.array_compact(F.flatten(F.filter(named, lambda a: a.isNotNull()))))


def prom_error(text: Column) -> Column:
    """Why a PromQL text cannot be cut into tokens safely; NULL if it can."""

    def checked(pieces: Column) -> Column:
        return (
            F.when(~F.exists(pieces, lambda p: p.rlike(r"\S")), F.lit("empty"))
            .when(F.exists(pieces, lambda p: p.isin("'", '"', "`")), F.lit("unclosed quote"))
            .when(F.exists(pieces, lambda p: p.isin("{", "}", "[", "]")), F.lit("unbalanced brackets"))
            .when(_unbalanced(pieces, [("(", ")")]), F.lit("unbalanced brackets"))
        )

    return let(_all(text, PROM_PIECES), checked)


def _label_text(name: Column) -> Column:
    """Label names beyond the classic form are written in quotes."""
    return F.when(name.rlike(_IDENTIFIER), name).otherwise(F.concat(F.lit('"'), name, F.lit('"')))


def rewrite_promql(text: Column, mapping: Column) -> Column:
    """Replace names in PromQL text. Every metric name moves into its selector as
    a quoted first entry; mapped labels of ``by``/``without`` and all labels of
    matching clauses are quoted."""

    def matcher(m: Column) -> Column:
        label, op = F.regexp_extract(m, _MATCHER_PARTS, 1), F.regexp_extract(m, _MATCHER_PARTS, 2)
        mark, value = F.regexp_extract(m, _MATCHER_PARTS, 3), F.regexp_extract(m, _MATCHER_PARTS, 4)
        parameter = F.when(
            F.startswith(value, F.lit("$")), F.concat(F.lit("$"), _look(mapping, F.substring(value, F.lit(2), F.length(value))))
        )
        new_value = F.coalesce(_look(mapping, value), parameter, value)
        rebuilt = F.concat(_label_text(F.coalesce(_look(mapping, label), label)), op, mark, new_value, mark)
        return F.when(op == "", m).otherwise(rebuilt)

    def selector(name: Column, braces: Column) -> Column:
        kept = F.filter(_all(braces, _MATCHER), lambda m: (name == "") | ~m.rlike(r"\A\"?__name__\"?\s*[=!]"))
        first = F.when(
            name != "", F.array(F.concat(F.lit('"'), F.coalesce(_look(mapping, name), name), F.lit('"')))
        )
        body = F.concat(no_items(first, "string"), F.transform(kept, matcher))
        return F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}"))

    def label_list(piece: Column) -> Column:
        head = F.regexp_extract(piece, r"\A(\w+)", 1)
        grouping = F.lower(head).isin("by", "without")
        labels = F.filter(
            F.transform(F.split(F.regexp_extract(piece, r"\(([^()]*)\)", 1), ","), lambda x: F.trim(x)), lambda x: x != ""
        )

        def one(label: Column) -> Column:
            new, quoted = _look(mapping, label), F.startswith(label, F.lit('"'))
            always = F.concat(F.lit('"'), F.coalesce(new, label), F.lit('"'))
            return F.when(quoted, label).when(grouping & new.isNull(), label).otherwise(always)

        return F.concat(head, F.lit(" ("), F.array_join(F.transform(labels, one), ", "), F.lit(")"))

    def renamed(p: Column) -> Column:
        whole = p["text"]
        return (
            F.when(p["kind"] == "list", label_list(whole))
            .when(p["kind"] == "metric", selector(whole, F.lit("")))
            .when(
                p["kind"] == "selector",
                selector(F.regexp_extract(whole, r"\A([A-Za-z_:][\w:]*)", 1), F.regexp_extract(whole, r"(?s)\A[^{]*(\{.*\})\z", 1)),
            )
            .otherwise(whole)
        )

    return F.array_join(F.transform(_prom_pieces(text), renamed), "")
