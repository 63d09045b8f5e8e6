"""Operator 3: licence scans by Dice coefficient (DataFrame functions only).

Every line and every paragraph (text between blank lines) of a document is normalised to
lower-case words and compared with licence templates by the Dice coefficient of their sets
of word bigrams, 2 * common / (size + size).  A coefficient of at least t needs sizes within
t / (2 - t) of one another, so templates are joined by the sizes they can match, an equality
join; the few that remain are compared exactly.

A notice may also be a part of a paragraph, or go over several: ``passages`` compares every
run of consecutive sentences or lines that is about as long as a template, the whole text if
it is short enough.  A run that matches lacks few of a template's bigrams, so it holds one of
its few longest (rare ones, mostly); runs are made only around these, in texts that have one.

Templates are a parameter, a list of (licence id, text); the ones here are short notices
and permission texts that are public.  They are checked to be few before they are broadcast.

Defined results: a null, empty or wordless text has no units; a unit of a single word has no
bigram and matches nothing; texts of any length are read whole; repeated rows give repeated
rows; an empty table gives an empty table; ids may be null; only the named columns are read,
so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9
MAX_TEMPLATES = 5_000

# Wording of public licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]


def normal_words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def bigrams(words: str) -> Column:
    """The distinct word bigrams of an array column, hashed."""
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, F.col(words)[i + 1]))
    return F.array_distinct(pairs)


def _known(spark, templates, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The templates with their bigrams, and the same once for each size of a unit that can match."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError("more templates than the bound for a broadcast")
    fit = threshold / (2 - threshold)
    known = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, t string")
    known = (known.withColumn("words", normal_words(F.col("t"))).withColumn("want", bigrams("words"))
             .withColumn("n_want", F.size("want")))
    sizes = known.select("template", "license", "want", "n_want", F.explode_outer(F.sequence(
        F.ceil(F.col("n_want") * fit - 1e-9), F.floor(F.col("n_want") / fit + 1e-9)).cast("array<int>")).alias("n_have")).where("n_want > 0")
    return known, sizes


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, unit kind, unit number, licence id, template number, dice) of every match."""
    _, sizes = _known(docs.sparkSession, templates, threshold)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # the longest unit that a template can match, in words: a bound by size before anything is hashed
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.array(
        F.struct(F.lit("line").alias("kind"), F.split(text, "\n").alias("units")),
        F.struct(F.lit("paragraph").alias("kind"), F.split(text, r"\n[ \t]*\n").alias("units")))).alias("u"))
    units = rows.select("id", F.col("u.kind").alias("kind"), F.posexplode_outer("u.units").alias("unit", "unit_text"))
    units = units.where((F.col("kind") == "line") | F.col("unit_text").contains("\n"))
    worded = units.select("id", "kind", "unit", normal_words(F.col("unit_text")).alias("words"))
    found = _matches(worded, sizes, threshold)
    return found.select(F.col("id").alias(id_col), "kind", "unit", "license", "template", "dice")


def _matches(worded: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """Units of ``words`` with every template at the threshold or above, and the coefficient."""
    # Never null, so that the join infers no filter: Spark would move it below with a copy of
    # the whole expression, and make the words anew for each bigram.
    paired = worded.withColumn("have", bigrams("words")).withColumn("n_have", F.coalesce(F.size("have"), F.lit(0)))
    found = (paired.join(F.broadcast(sizes), "n_have")
             .withColumn("common", F.size(F.array_intersect("have", "want"))))
    dice = 2 * F.col("common") / (F.col("n_have") + F.col("n_want"))
    return found.where(dice >= threshold).withColumn("dice", F.round(dice, 6))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that Spark cannot copy into the expressions that use it, where it
    would be made anew for each element of an array."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _pairs(words, make) -> Column:
    words = F.col(words) if isinstance(words, str) else words
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: make(w, words[i + 1]))


def _sum(counts: str, first, last) -> Column:
    return F.aggregate(F.slice(counts, first + 1, last - first + 1), F.lit(0), lambda acc, n: acc + n)


def passages(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, first and last piece, licence id, template number, dice) of every run of
    consecutive pieces that matches.  Pieces are the sentences and lines with a word, numbered
    from 0; a run is as long at most, in word pairs, as what can match the longest template."""
    known, sizes = _known(docs.sparkSession, templates, threshold)
    fit = threshold / (2 - threshold)
    # A match lacks 1 - fit of the wanted bigrams at most: it has one of any set larger than that.
    ranked = F.array_sort(F.array_distinct(_pairs("words", lambda v, w: F.struct((-F.length(v) - F.length(w)).alias("rank"), F.xxhash64(v, w).alias("pair")))))
    rare = F.slice(ranked, 1, F.floor(F.col("n_want") * (1 - fit) + 1e-9).cast("int") + 1)
    bounds = known.where("n_want > 0").agg(
        F.array_distinct(F.flatten(F.collect_list(F.transform(rare, lambda p: p["pair"])))).alias("seeds"),
        (F.floor(F.max(F.size("words") - 1) / fit + 1e-9) + 1).cast("int").alias("longest")).where("longest is not null")

    # Texts with a seed, and which seeds; what follows are arrays of one row, so nothing is shuffled.
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = _once(docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")), "words", normal_words(F.col("text")))
    rows = rows.select("id", "text", _pairs("words", F.xxhash64).alias("every"))
    rows = rows.crossJoin(F.broadcast(bounds)).where(F.arrays_overlap("every", "seeds"))
    rows = _once(rows, "hit", F.array_intersect("every", "seeds")).select("id", "text", "longest", "hit")
    rows = _once(rows, "pieces", F.filter(F.transform(F.split("text", r"(?<=[.!?;:])\s+|\n"), normal_words), lambda p: F.size(p) > 0))
    rows = _once(rows, "counts", F.transform("pieces", F.size))
    # Pieces where a seed begins; it may end in the next one.
    begun = F.transform("pieces", lambda p, i: F.when(F.arrays_overlap("hit", _pairs(
        F.concat(p, F.slice(F.coalesce(F.get("pieces", i + 1), F.array().cast("array<string>")), 1, 1)), F.xxhash64)), i))
    rows = _once(rows, "flags", F.filter(begun, lambda i: i.isNotNull()))

    # Around each of them, the pieces of the runs in which it is the first such piece.
    longest = F.col("longest")
    def around(f, k):  # noqa: E306
        low = F.greatest(F.coalesce(F.get("flags", k - 1), F.lit(-1)) + 1, f - longest + 1)
        high = F.least(F.size("counts") - 1, f + longest - 1)
        low = F.array_min(F.filter(F.sequence(low, f), lambda i: _sum("counts", i, f) <= longest))
        high = F.array_max(F.filter(F.sequence(f, high), lambda j: _sum("counts", f, j) <= longest))
        return F.struct(f.alias("f"), low.alias("low"), high.alias("high"))
    spots = _once(rows, "spots", F.filter(F.transform("flags", around), lambda s: s["low"].isNotNull()))
    spots = spots.select("id", "longest", F.explode_outer(F.transform("spots", lambda s: F.struct(
        s["f"].alias("f"), s["low"].alias("low"), s["high"].alias("high"),
        F.slice("pieces", s["low"] + 1, s["high"] - s["low"] + 1).alias("pieces"),
        F.slice("counts", s["low"] + 1, s["high"] - s["low"] + 1).alias("counts")))).alias("s")).where("s is not null")
    spots = spots.select("id", "longest", "s.*")
    starts = spots.select("*", F.explode_outer(F.sequence("low", "f")).alias("first"))
    runs = starts.select("*", F.explode_outer(F.filter(F.sequence("f", "high"), lambda j: _sum(
        "counts", F.col("first") - F.col("low"), j - F.col("low")) <= longest)).alias("last")).where("last is not null")
    worded = _once(runs, "words", F.flatten(F.slice("pieces", F.col("first") - F.col("low") + 1, F.col("last") - F.col("first") + 1)))
    found = _matches(worded.select("id", "first", "last", "words"), sizes, threshold)
    return found.select(F.col("id").alias(id_col), "first", "last", "license", "template", "dice")
