"""License scans: MinHash bands retrieve templates, shingle containment verifies.

Texts and templates are lower-cased runs of letters and digits, in shingles of
five (a template of fewer words never matches). The shingles of a text form
overlapping windows of ``WINDOW`` with a step of half of that, those of a
template consecutive segments of half a window, so every unbroken segment lies
in some window whole.

A window's sketch is a one-permutation MinHash: a shingle's hash names its bin
by its upper bits, and each bin keeps its least hash. A band is one bin with
its value; a segment keeps the ``KEEP`` least bands of its own. The bands of
all windows are joined with those of the segments, and that join alone
retrieves templates. Where at least 75 % of a template's shingles stand in a
text, one that a segment keeps is among them, since three of every eight (or
all of a shorter segment) are kept; it misses its band only if another of the
window's shingles has a smaller hash in the same bin: with 15 others and 4096
bins the chance is below 15 / 8192 = 0.19 %, and falls by that factor with
every further one (``miss_probability``).

A retrieved template of n shingles is verified on the words themselves around
the window: at least 75 % of it must stand within 2 n consecutive shingles of
the text (regions begin at every n-th shingle). Only DataFrame functions are
used. Bands and templates are broadcast, ``MOST`` shingles at a time; more of
them take further passes over the texts.

Defined results: null or short texts and texts without words match nothing;
repeated rows match each; null ids are kept; extra columns are ignored; equal
templates each match, and a null name is a name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import materialize

WIDTH = 5
WINDOW = 16
BIN_BITS = 12
BINS = 1 << BIN_BITS
KEEP = 3
MOST = 100_000
CONTAINMENT = 75  # per cent

#: Notices in common use (fixed values): name, text.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                          "compliance with the License. You may obtain a copy of the License at"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                 "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
                 "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
                 "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                 "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
                 "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
                 "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
                 "DEALINGS IN THE SOFTWARE."),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
                 "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
                 "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                 "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
                 "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
                 "PERFORMANCE OF THIS SOFTWARE."),
]


def miss_probability(shingles: int, window: int = WINDOW, bins: int = BINS) -> float:
    """Bound on the chance that no band of so many kept shingles collides."""
    return ((window - 1) / (2 * bins)) ** shingles


def builtin_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "template string, text string")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _hashes(words: Column) -> Column:
    """64-bit hash of every shingle, in order."""
    n = F.size(words) - WIDTH
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))),
                                      lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)])))


def _shingles(words: Column, first: Column, count: Column) -> Column:
    """The words of up to ``count`` shingles from the ``first``."""
    last = F.least(first + count, F.size(words) - (WIDTH - 1)) - 1
    return F.transform(F.sequence(first, last), lambda i: F.array_join(F.slice(words, i + 1, F.lit(WIDTH)), " "))


def _opens(x: Column, i: Column, up: Column) -> Column:
    """Whether x, at i of sorted hashes, is the least of its bin: these stand
    bin by bin, as their upper bits name the bin."""
    name = lambda y: F.shiftright(y, 64 - BIN_BITS)
    return (i == 0) | (name(x) != name(F.get(up, i - 1)))


def _bands(hashes: Column) -> Column:
    """The least hash of every bin."""
    # as the variable of a transform the sorted array is made once, not for every element
    return F.transform(F.array(F.sort_array(hashes)), lambda up: F.filter(up, lambda x, i: _opens(x, i, up)))[0]


def _starts(hashes: Column) -> Column:
    return F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(WINDOW // 2))


def template_table(templates: DataFrame, template: str = "template", text: str = "text") -> DataFrame:
    """tid, template, shingles (its distinct ones), size (their number), bands (what its segments keep)."""
    rows = templates.select(F.col(template).alias("template"), _words(F.col(text)).alias("w")).withColumn("h", _hashes(F.col("w")))
    kept = F.flatten(F.transform(_starts(F.col("h")), lambda s: F.slice(_bands(F.slice("h", s + 1, F.lit(WINDOW // 2))), 1, KEEP)))
    shingles = F.array_distinct(_shingles(F.col("w"), F.lit(0), F.size("h")))
    return (rows.where(F.size("h") > 0).select(F.monotonically_increasing_id().alias("tid"), "template", shingles.alias("shingles"),
                                               F.array_distinct(kept).alias("bands"))
            .withColumn("size", F.size("shingles")))


def license_matches(docs: DataFrame, templates: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
                    per_cent: int = CONTAINMENT) -> DataFrame:
    """One row per document and template found in it: doc_id, template,
    containment (best region's share), first_word (of that region's first match)."""
    spark = docs.sparkSession
    table = materialize(template_table(builtin_templates(spark) if templates is None else templates), "templates")
    passes = max(1, -(-(table.agg(F.sum("size")).first()[0] or 0) // MOST))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), _words(F.col(text)).alias("w"))
    rows = rows.withColumn("h", _hashes(F.col("w"))).where(F.size("h") > 0)
    # one row per window, then per band: no lambda runs for each of them
    windows = (rows.select("row", "doc_id", "w", "h", F.explode(_starts(F.col("h"))).alias("start"))
               .select("row", "doc_id", "w", "start", F.sort_array(F.slice("h", F.col("start") + 1, F.lit(WINDOW))).alias("up"))
               .select("row", "doc_id", "w", "start", "up", F.posexplode("up").alias("i", "band"))
               .where(_opens(F.col("band"), F.col("i"), F.col("up"))).drop("up", "i"))
    found = [_verified(windows, table.where(F.pmod(F.xxhash64("tid"), F.lit(passes)) == i), per_cent) for i in range(passes)]
    return reduce(DataFrame.unionByName, found)


def _verified(windows: DataFrame, table: DataFrame, per_cent: int) -> DataFrame:
    """What the bands of these templates (about ``MOST`` shingles) retrieve and their words confirm."""
    bands = table.select("tid", F.explode("bands").alias("band"))
    near = (windows.join(F.broadcast(bands), "band").select("row", "doc_id", "w", "start", "tid")
            .join(F.broadcast(table.select("tid", "template", "shingles", "size")), "tid"))
    n, last = F.col("size"), F.size("w") - WIDTH
    low = F.greatest(F.floor(F.col("start") / n) - 1, F.lit(0)).cast("int")
    high = F.floor(F.least(F.col("start") + WINDOW - 1, last) / n).cast("int")
    regions = near.withColumn("region", F.explode(F.sequence(low, high)))
    regions = regions.withColumn("here", _shingles(F.col("w"), F.col("region") * n, 2 * n)).drop("w")
    regions = regions.withColumn("both", F.array_intersect("here", "shingles"))  # distinct, in the order of the text
    first = F.col("region") * n + F.array_position("here", F.get("both", F.lit(0))) - 1
    best = (regions.where(F.size("both") * 100 >= n * per_cent)
            .select("row", "doc_id", "tid", "template", (F.size("both") / n).alias("containment"), (-first).alias("w"))
            .groupBy("row", "doc_id", "tid", "template").agg(F.max(F.struct("containment", "w")).alias("b")))
    return best.select("doc_id", "template", "b.containment", (-F.col("b.w")).cast("long").alias("first_word"))
