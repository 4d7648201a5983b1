"""Licence notices by Dice coefficient over word bigrams.

A document's lines are normalised (lower case, everything but letters and
digits becomes space). A line and a template of a and b distinct word bigrams
can only reach a Dice coefficient of t if t / (2 - t) <= a / b <= (2 - t) / t:
templates are indexed by all line sizes they can match, and a line only meets
the templates found under its own size. Reaching t also takes t / (2 - t) of the
template's bigrams, so each template has anchors, words without which too many
of its bigrams are missing; texts and lines without any anchor are left at once.
"""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Notices by which licences are recognised.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "bsd-2-or-3": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def normalised(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words of a normalised text."""
    words = F.split(text, " ")
    after = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), after, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def anchors(templates: dict[str, str], least: float) -> list[str]:
    """Words of which every line that reaches ``least`` with some template holds one."""
    chosen: set[str] = set()
    for wording in templates.values():
        words = re.sub(r"[\W_]+", " ", wording.lower()).split()
        pairs = set(zip(words, words[1:], strict=False))
        spare = len(pairs) - math.ceil(len(pairs) * least / (2 - least) - 1e-9)  # bigrams that may be missing, as template_index counts them
        for word in sorted(set(words), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(bool(chosen & set(pair)) for pair in pairs) > spare:
                break
            chosen.add(word)
    return sorted(chosen)


def template_index(spark: SparkSession, least: float, templates: dict[str, str]) -> DataFrame:
    """Templates, one row for every line size they can match."""
    rows = spark.createDataFrame(sorted(templates.items()), "licence string, wording string")
    sized = rows.select("licence", bigrams(normalised(F.col("wording"))).alias("own")).withColumn("b", F.size("own"))
    low = F.ceil(F.col("b") * least / (2 - least) - 1e-9).cast("int")
    high = F.floor(F.col("b") * (2 - least) / least + 1e-9).cast("int")
    return sized.where("b > 0").select("licence", "own", "b", F.explode(F.sequence(low, high)).alias("a"))


def scan(docs: DataFrame, least: float = 0.8, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_notices (lines that
    reach ``least`` with some template), licence and dice of the best line; equal
    coefficients go to the first licence by name.

    Documents without such a line, null and empty texts among them, have 0
    notices and null licence and dice. Equal rows get equal results; rows without
    doc_id are kept; other columns are ignored. Templates of fewer than two words
    match nothing. The template index is as long as the templates: it is
    broadcast by its own measured size, if Spark finds it small enough.
    """
    spark = docs.sparkSession
    wanted = TEMPLATES if templates is None else templates
    words = anchors(wanted, least)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_text"), "text")

    def anchored(text: Column) -> Column:
        # One pass lower-cases the text for all anchors.
        return F.exists(F.array(F.lower(text)), lambda low: functools.reduce(operator.or_, (F.contains(low, F.lit(w)) for w in words), F.lit(False)))

    lines = keyed.where(anchored(F.col("text"))).select("doc_id", "_text", F.posexplode(F.split("text", "\n")).alias("_line", "line")).where(anchored(F.col("line")))
    sized = lines.select("doc_id", "_text", "_line", bigrams(normalised(F.col("line"))).alias("grams")).withColumn("a", F.size("grams")).where("a > 0")
    index = template_index(spark, least, wanted)
    met = sized.join(index, "a").withColumn("both", F.size(F.array_intersect("grams", "own")))
    dice = 2 * F.col("both") / (F.col("a") + F.col("b"))
    best = met.withColumn("dice", dice).where(F.col("dice") >= least)
    per_text = best.groupBy(F.struct(F.col("doc_id"), F.col("_text")).alias("_key")).agg(
        F.countDistinct("_line").alias("n"), F.max("dice").alias("dice"), F.min(F.struct((-F.col("dice")).alias("d"), "licence")).alias("top")
    )
    out = keyed.select("doc_id", F.struct("doc_id", "_text").alias("_key")).join(per_text, "_key", "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), F.col("top.licence").alias("licence"), "dice")
