"""Fill-in-the-middle: documents cut into prefix, middle and suffix.

A text is a run of units: a word with the white space before it, or the white
space at the end. One full match of ``(unit)*`` with the ``regex`` library, which
keeps every repetition of a group, cuts it: the ends of group 1 are the ends of
all units, so their number and both cut offsets are read off one list. Only this
match runs in Python, as an Arrow-batched function over the texts; drawing,
assembling and rebuilding are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# The marks of the three parts and the units of a text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<[PSM]>"
BLANK, SOLID = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: Possessive repeats match what the plain ones do, as neither class contains
#: the other's characters, and leave nothing to come back to: memory is one pair
#: of offsets a unit.
UNITS = regex.compile(f"({BLANK}*+{SOLID}++|{BLANK}++)*+")
CUTS = StructType([StructField(name, LongType()) for name in ("n", "first", "second")])


def cuts(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Number of units n, and the offsets at which the prefix and the middle end,
    after the smaller and the larger of ``first`` % (n + 1) and ``second`` % (n + 1) units."""
    ends = UNITS.fullmatch(text).ends(1)
    low, high = sorted((first % (len(ends) + 1), second % (len(ends) + 1)))
    return len(ends), ends[low - 1] if low else 0, ends[high - 1] if high else 0


@F.pandas_udf(CUTS)
def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, first, second in batches:
        found = [cuts(t, int(a), int(b)) for t, a, b in zip(texts, first, second, strict=True)]
        yield pd.DataFrame(found, columns=["n", "first", "second"], dtype="int64")


def _draw(key: Column, seed: int, nth: int) -> Column:
    """The nth group of eight hex digits of sha256(seed:key), as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * nth + 1, 8), 16, 10).cast("long")


def _between(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))


def transform(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n (units of the text),
    form, prefix_chars, middle_chars (code points) and output.

    ``percent`` of the texts are cut at two units drawn from the doc_id and
    ``seed``; of those ``spm_percent`` are written suffix first (``spm``), the
    others prefix first (``psm``). The rest is ``plain``: the text as it is, with
    null part lengths, as are empty texts and texts that hold one of the marks.
    A null text counts as empty, and a null doc_id draws as an empty key, so all
    rows without one draw alike. Repeated rows each come out; equal ids draw
    equal units. White space alone is one unit. Texts are taken whole, whatever
    their length. Other columns are ignored; an empty table gives no rows.
    """
    draws = [_draw(F.col("doc_id"), seed, i).alias(f"draw{i}") for i in range(4)]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *draws)
    cut = rows.withColumn("cut", _cuts("text", "draw0", "draw1"))
    plain = (F.col("text") == "") | F.col("text").rlike(MARKS) | (F.col("draw2") % 100 >= percent)
    form = F.when(plain, "plain").when(F.col("draw3") % 100 < spm_percent, "spm").otherwise("psm")
    first, second = F.col("cut.first"), F.col("cut.second")
    prefix, middle = _between(F.col("text"), F.lit(0), first), _between(F.col("text"), first, second)
    suffix = _between(F.col("text"), second, F.length("text"))
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    split = F.col("form") != "plain"
    return cut.withColumn("form", form).select(
        "doc_id",
        F.col("cut.n").alias("n"),
        "form",
        F.when(split, first).alias("prefix_chars"),
        F.when(split, second - first).alias("middle_chars"),
        output.alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text an output was made from. A split text holds none of the marks, and
    no end of a mark begins another, so its output splits at them into four."""
    part = F.split(output, MARKS)
    psm = F.concat(part[1], part[3], part[2])
    spm = F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(transformed: DataFrame) -> DataFrame:
    """The rows of :func:`transform` with sha256 digests of the output and of the
    text rebuilt from it instead of the output itself."""
    restored = F.sha2(restore(F.col("output"), F.col("form")), 256)
    return transformed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), restored.alias("restored_sha256"),
    )
