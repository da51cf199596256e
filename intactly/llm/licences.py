"""Licence scans by the Dice coefficient over word bigrams, in DataFrame operations only.

The units of a document are its lines, its paragraphs (between blank lines) and the whole text. A unit is normalised:
A-Z in lower case, everything but a-z and 0-9 a gap between words. Its bigrams are compared with those of each template,
repeats included: twice the shared bigrams over all bigrams of both. A unit of too few or too many words cannot reach the
threshold for a template, so sizes alone rule most pairs out; a unit without any bigram of any template is left next.

All of it is one projection: no row is shuffled, and a row's work is bounded by its own text. Null and empty texts match
nothing. Ties go to the licence first by name. Repeated rows get a row each.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
              "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
              "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
              "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
              "other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
            "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
            "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
            "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
            "DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.")
_ISC_END = (" THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
            "USE OR PERFORMANCE OF THIS SOFTWARE.")
# Common notices of public licences (licence, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
                "(at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                "(at your option) any later version."),
    ("ISC", _ISC),
    ("ISC", _ISC + _ISC_END),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                 "or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 3 of the License, or "
                 "(at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def template_bigrams(text: str) -> Counter:
    """Bigrams of a template and how often it has each."""
    words = re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Least and most bigrams of a unit that can reach the threshold with a template of n bigrams."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def units(text: Column) -> Column:
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"), F.array(text)))


def words(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.translate(unit, UPPER, LOWER), "[^a-z0-9]+", " ")), " ")


def licence_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and matches of every row: an array of (dice, licence, unit's normalised text), best first."""
    tables = [(name, grams, sum(grams.values())) for name, text in templates if (grams := template_bigrams(text))]
    bounds = [size_bounds(n, threshold) for *_, n in tables]
    known = sorted({g for _, grams, _ in tables for g in grams})
    listed = F.array(*[F.struct(
        F.lit(name).alias("licence"), F.lit(n).alias("n"), F.lit(low).alias("low"), F.lit(high).alias("high"),
        F.array(*[F.lit(g) for g in sorted(grams)]).alias("distinct"),
        F.array(*[F.struct(F.lit(g).alias("gram"), F.lit(k).alias("k")) for g, k in sorted(grams.items())]).alias("grams"))
        for (name, grams, n), (low, high) in zip(tables, bounds, strict=True)])
    least, most = min(low for low, _ in bounds), max(high for _, high in bounds)

    sized = F.filter(F.transform(units(F.col("text")), words),
                     lambda w: (F.size(w) - 1 >= least) & (F.size(w) - 1 <= most))
    paired = F.transform(sized, lambda w: F.struct(
        w.alias("words"), F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1),
                                     lambda a, b: F.concat(a, F.lit(" "), b)).alias("grams")))
    near = F.filter(paired, lambda u: F.exists(u["grams"], lambda g: g.isin(known)))

    def dice(u: Column, t: Column) -> Column:
        shared = F.aggregate(t["grams"], F.lit(0), lambda n, g: n + F.least(
            g["k"], F.size(F.filter(u["grams"], lambda x: x == g["gram"]))))
        return 2.0 * shared / (t["n"] + F.size(u["grams"]))

    def reachable(u: Column, t: Column) -> Column:
        """Whether enough of the template's bigrams are there, as each that is missing takes one repeat or more."""
        most = t["n"] - F.size(t["distinct"]) + F.size(F.array_intersect(u["grams"], t["distinct"]))
        return 2.0 * most / (t["n"] + F.size(u["grams"])) >= threshold

    matches = F.flatten(F.transform(near, lambda u: F.transform(
        F.filter(listed, lambda t: F.when(F.size(u["grams"]).between(t["low"], t["high"]), reachable(u, t))
                 .otherwise(False)),
        lambda t: F.struct(dice(u, t).alias("dice"), t["licence"].alias("licence"),
                           F.array_join(u["words"], " ").alias("unit")))))
    best_first = F.array_sort(
        F.filter(matches, lambda m: m["dice"] >= threshold),
        lambda x, y: F.when(x["dice"] != y["dice"], F.when(x["dice"] > y["dice"], -1).otherwise(1))
        .when(x["licence"] != y["licence"], F.when(x["licence"] < y["licence"], -1).otherwise(1))
        .when(x["unit"] != y["unit"], F.when(x["unit"] < y["unit"], -1).otherwise(1)).otherwise(0))
    return docs.select("doc_id", F.coalesce(best_first, F.array().cast(
        "array<struct<dice:double,licence:string,unit:string>>")).alias("matches"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    best = F.get("matches", F.lit(0))
    return found.select(
        "doc_id", F.array_join(names, ",").alias("licences"), best["licence"].alias("best_licence"),
        F.round(best["dice"], 6).alias("best_dice"),
        F.size(F.array_distinct(F.transform("matches", lambda m: m["unit"]))).cast("long").alias("n_units"))


def _sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    most = max(size_bounds(sum(template_bigrams(text).values()), threshold)[1] for _, text in templates)
    rows = ", ".join(f"({i}, '{name}', '{g}', {k}, {sum(grams.values())})" for i, (name, text) in enumerate(templates)
                     for grams in [template_bigrams(text)] for g, k in sorted(grams.items()))
    return rf"""
WITH t(template, licence, gram, k, n) AS (VALUES {rows}),
u AS (SELECT doc_id, unit, row_number() OVER () AS u FROM (SELECT DISTINCT doc_id, unit FROM (
    SELECT doc_id, trim(regexp_replace(translate(raw, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) AS unit FROM (
        SELECT doc_id, unnest(list_concat(string_split(text, chr(10)), list_concat(
            regexp_split_to_array(text, '\n[ \t\r]*\n'), [text]))) AS raw FROM documents WHERE text IS NOT NULL)))),
w AS (SELECT doc_id, u, unit, string_split(unit, ' ') AS w FROM u),
g AS (SELECT u, w[i] || ' ' || w[i + 1] AS gram, count(*) AS k
      FROM (SELECT u, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) - 1 <= {most}) GROUP BY 1, 2),
d AS (SELECT g.u, template, licence, 2.0::DOUBLE * sum(least(g.k, t.k)) / (any_value(t.n) + any_value(len(w.w)) - 1) AS dice
      FROM g JOIN t USING (gram) JOIN w ON w.u = g.u GROUP BY g.u, template, licence),
m AS (SELECT doc_id, unit, licence, dice FROM d JOIN w USING (u) WHERE dice >= {threshold})
SELECT doc_id, coalesce(licences, '') AS licences, best_licence, round(best_dice, 6) AS best_dice,
       coalesce(n_units, 0) AS n_units
FROM documents LEFT JOIN (
    SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(DISTINCT unit) AS n_units,
           first(licence ORDER BY dice DESC, licence) AS best_licence, max(dice) AS best_dice
    FROM m GROUP BY doc_id) USING (doc_id)"""


QUERIES = {"op10_licence_scan": op10_licence_scan}
SQL = {"op10_licence_scan": _sql()}
