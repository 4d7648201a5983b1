"""Personal data, and terms that give away whom it belongs to.

Emails, network addresses, card and phone numbers are found by pattern. Their
values are the protected entities. Over the whole corpus the co-occurrence of
terms and entities tells how much a term reveals: the pointwise mutual
information of term and entity as a share of the entity's own information,

    disclosure = log(n(e, t) N / (n(e) n(t))) / log(N / n(e)),

1 if the term only occurs with the entity. In documents that hold the entity,
terms above one threshold are generalised and above another removed.

Patterns are written without backtracking into repetitions, so long runs cost no
stack and no quadratic time; they match what the plain patterns match.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.llm.shared import marked, stage

# Kinds in order, with pattern, cheap necessary condition and replacement.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
# Only runs of 16 to 19 digits, each whole: no other run of digits can pass.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
SHOWN = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "removed": ""}
#: Characters between terms, beside white space.
MARKS = "!\"#$%&()*+,/:;<=>?@[\\]^`{|}~."
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def located(text: Column, pattern: Column, kind: str) -> Column:
    """Spans of all matches, found by what lies between them; offsets in code points."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), none().alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["value"])
        one = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    number = F.reverse(digits(value))

    def term(i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(number)), term), F.lit(0), operator.add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")) <= 3) & F.forall(
            F.split(value, r"\."), lambda p: F.try_to_number(F.lpad(F.right(p, F.lit(3)), 3, "0"), F.lit("999")) <= 255
        )
    if kind == "card":
        return passes_luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    spans = F.when(F.rlike(text, F.lit(HINTS[kind])), located(text, F.lit(KINDS[kind]), kind)).otherwise(none())
    return spans if kind == "email" else F.filter(spans, lambda s: valid(kind, s["value"]))


def terms(text: Column) -> Column:
    """Distinct terms: words without marks around them, A to Z lower-cased, of
    three characters or more."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.translate(text, upper + MARKS, upper.lower() + " " * len(MARKS))
    return F.array_distinct(F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: F.length(w) >= 3))


def revealing(docs: DataFrame, found: DataFrame, least: float, support: int) -> DataFrame:
    """(key, terms): for every text with entities the terms that reveal one of
    them, with their disclosure. ``docs`` has key and text, ``found`` key, text
    and entities. Counts are over all documents; a pair of entity and term counts
    only if ``support`` different texts hold it."""
    total = F.lit(docs.count()).cast("double")
    entities = found.select("key", "text", F.explode("entities").alias("entity"))
    per_entity = entities.groupBy("entity").agg(F.count("*").alias("n_e"), F.countDistinct("key").alias("texts")).where(F.col("texts") >= support)
    known = stage(per_entity.where(F.col("n_e") < total).select("entity", "n_e"))
    held = entities.join(known.select("entity"), "entity", "left_semi").select("entity", "key", F.explode(terms(F.col("text"))).alias("term"))
    own = F.contains(F.col("entity"), F.col("term"))  # parts of the entity itself are covered by its span
    per_text = held.where(~own).groupBy("entity", "term", "key").agg(F.count("*").alias("n"))
    pairs = stage(per_text.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("texts")).where(F.col("texts") >= support).select("entity", "term", "n_et"))
    # How many documents hold each term that is left: only those leave the scan.
    candidates = pairs.select("term").distinct()
    spread = marked(docs.select(F.explode(terms(F.col("text"))).alias("term")), F.col("term"), candidates, "_maybe").where("_maybe")
    per_term = spread.groupBy("term").agg(F.count("*").alias("n_t"))
    share = F.log(F.col("n_et") * total / (F.col("n_e") * F.col("n_t"))) / F.log(total / F.col("n_e"))
    scored = pairs.join(per_term, "term").join(known, "entity").withColumn("disclosure", share).where(F.col("disclosure") >= least)
    # Back to the texts: each gets those of its own terms that reveal one of its entities.
    telling = stage(scored.select("entity", "term", "disclosure"))
    pair = F.xxhash64("entity", "term")
    own_terms = marked(held.where(~own), pair, telling.select(pair.alias("_pair")), "_maybe").where("_maybe").join(telling, ["entity", "term"])
    return own_terms.groupBy("key", "term").agg(F.max("disclosure").alias("disclosure")).groupBy("key").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("term", "disclosure")))).alias("revealed")
    )


def quoted(term: Column) -> Column:
    return F.regexp_replace(term, r"([^\p{L}\p{N}])", r"\\$1")


def term_spans(text: Column, revealed: Column, remove: float) -> Column:
    """Spans of revealed terms where they stand as terms; those to be removed are
    of kind ``removed`` while the text is rewritten."""
    edge = "\\x20\\x09-\\x0D" + "".join(f"\\{c}" for c in MARKS)
    words = F.array_join(F.transform(F.map_keys(revealed), quoted), "|")
    pattern = F.concat(F.lit(f"(?i)(?<![^{edge}])(?:"), words, F.lit(f")(?![^{edge}])"))
    return F.transform(
        located(text, pattern, "term"),
        lambda s: F.struct(
            F.when(F.element_at(revealed, F.translate(s["value"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) >= remove, "removed").otherwise("term").alias("kind"),
            s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        ),
    )


def detect(docs: DataFrame, least: float = 0.8, remove: float = 0.95, support: int = 3) -> DataFrame:
    """``docs`` (doc_id, text and any others) with ``spans``: array of kind,
    start, end (code points, end exclusive) and value, kinds in the order email,
    ip, card, phone and then terms (``term`` to be generalised, ``removed`` to be
    removed), each by start.

    Spans of different kinds may overlap. Null and empty texts have none. Equal
    rows get equal spans; rows without doc_id take part. A column named spans is
    replaced. ``least`` and ``remove`` are disclosures, ``support`` the number of
    different texts in which term and entity must meet.
    """
    rows = docs.drop("spans")
    hinted = functools.reduce(operator.or_, (F.rlike(F.col("text"), F.lit(h)) for h in HINTS.values()))
    keyed = rows.select(F.xxhash64("text").alias("key"), "text", hinted.alias("hinted")).where("hinted")
    spans = keyed.select("key", "text", *[base_spans(F.col("text"), kind).alias(f"_{kind}") for kind in KINDS])
    base = spans.select("key", "text", F.concat(*[F.col(f"_{kind}") for kind in KINDS]).alias("base")).where(F.size("base") > 0)
    # One text may be many documents: entities count documents, support counts texts.
    entity = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    found = stage(base.withColumn("entities", entity))
    shown = revealing(rows.select("text"), found, least, support)
    per_text = found.dropDuplicates(["key"]).join(shown, "key", "left")
    extra = F.when(F.col("revealed").isNotNull(), term_spans(F.col("text"), F.col("revealed"), remove)).otherwise(none())
    complete = stage(per_text.select(F.col("key").alias("_key"), F.concat("base", extra).alias("spans")))
    return attach(rows, complete)


def attach(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with the spans of their text; only texts that may have any are shuffled."""
    flagged = marked(rows.withColumn("_text_key", F.xxhash64("text")), F.col("_text_key"), spans.select("_key"), "_maybe")
    some = flagged.where("_maybe").join(spans, F.col("_text_key") == F.col("_key"), "left")
    few = some.withColumn("spans", F.coalesce("spans", none()))
    clean = flagged.where("not _maybe").withColumn("spans", none())
    columns = [*rows.columns, "spans"]
    return clean.select(*columns).unionByName(few.select(*columns))


def sanitise(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its class or nothing. Of spans that
    overlap the first one counts, the longer one if they begin together."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    names = F.create_map(*[F.lit(x) for pair in SHOWN.items() for x in pair])

    def step(state: Column, span: Column) -> Column:
        kept = F.concat(state["out"], F.substring(text, state["at"] + 1, span["start"] - state["at"]), names[span["kind"]])
        after = F.struct(kept.alias("out"), (-span["back"]).alias("at"))
        return F.when(span["start"] >= state["at"], after).otherwise(state)

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    whole = F.aggregate(ordered, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def sanitised(docs: DataFrame, least: float = 0.8, remove: float = 0.95, support: int = 3) -> DataFrame:
    """``docs`` with their texts rewritten, as :func:`detect` finds them."""
    return detect(docs, least, remove, support).withColumn("text", sanitise(F.col("text"), F.col("spans"))).drop("spans")


def _equals(kind: str):
    return lambda other: other == kind


def digest(found: DataFrame) -> DataFrame:
    """doc_id, number of spans of each base kind, their SHA-256, and all spans as text."""
    listed = F.transform("spans", lambda s: F.concat_ws(":", F.when(s["kind"] == "removed", "term").otherwise(s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    kinds = F.col("spans")["kind"]
    counts = [F.size(F.filter(kinds, _equals(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    plain = F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *counts, F.sha2(plain, 256).alias("base_sha256"), F.array_join(listed, ",").alias("spans"))
