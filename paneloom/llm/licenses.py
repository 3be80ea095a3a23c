"""License notices in texts, in SQL functions only: MinHash bands retrieve templates, containment verifies.

Texts and templates become words (letters and digits, lower case) and runs of five words, hashed. Templates of
similar length share windows of their own: overlapping stretches of the text, long enough that any
occurrence lies wholly inside one. Each band is one MinHash value of a window; the number of bands is computed so that a
window that holds enough of a template shares a band with it with the given probability.
Retrieved templates are verified by the share of their shingles that the window holds.

A window can only share a band with a template if it holds the template's shingle that
is smallest in that band, so bands are computed for windows with such a shingle alone; the others
could not be retrieved.

Defined cases: null and empty texts, and texts of fewer than five words, hold no notice; a template of fewer than five words is refused. Of several
windows with a template the one that holds most of it counts, then the first. A text may hold several
templates, also one inside another. Repeated rows each give their rows. No templates, no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.frames import text_of

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Probability that a window holding enough of a template is compared with it.
RETRIEVAL = 0.9999
WORD = r"[\p{L}\p{N}]+"

#: Public notices, word for word; fixed values.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
    'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
    "for more details.",
    "bsd-2": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.",
}


def shingles_of(text: Column) -> Column:
    """Hashes of all runs of five words, in text order."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))

    def hashed(all_words: Column) -> Column:
        count = F.greatest(F.size(all_words) - (SHINGLE_WORDS - 1), F.lit(0))
        following = [lambda i, n=n: F.get(all_words, i + n) for n in range(1, SHINGLE_WORDS)]
        return F.transform(F.slice(all_words, 1, count), lambda w, i: F.xxhash64(w, *[f(i) for f in following]))

    return F.element_at(F.transform(F.array(words), hashed), 1)


def layout(shingles: int, least: int, containment: float, retrieval: float) -> tuple[int, int, int]:
    """Window length, step and number of bands for templates of up to ``shingles`` shingles, ``least`` at least.

    A window of 3/2 the longest template, moved by half of it, holds every occurrence
    whole. Enough of the shortest template is the least likeness that has to be found.
    """
    step = max(1, math.ceil(shingles / 2))
    window = shingles + step
    found = containment * least
    likeness = found / (window + least - found)
    bands = math.ceil(math.log(1 - retrieval) / math.log(1 - min(likeness, 0.999)))
    return window, step, bands


def _minima(shingles: Column, bands: Column) -> Column:
    """The smallest hash of the shingles in each band."""
    return F.transform(
        F.sequence(F.lit(1), bands), lambda band: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, band)))
    )


def template_classes(spark, templates: dict[str, str], containment: float, retrieval: float) -> list[dict]:
    """The classes of templates of similar length, with their layout, shingles and smallest shingles.

    Holds some numbers for each word of the caller's templates, whatever the texts.
    """
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    shingled = rows.select("name", F.array_distinct(shingles_of(F.col("text"))).alias("shingles")).orderBy("name").collect()
    members: dict[int, list] = {}
    for row in shingled:
        if not row["shingles"]:
            raise ValueError(f"template {row['name']} has fewer than {SHINGLE_WORDS} words")
        members.setdefault((len(row["shingles"]) - 1).bit_length(), []).append(row)
    classes = []
    for number, rows_ in sorted(members.items()):
        sizes = [len(r["shingles"]) for r in rows_]
        width, step, bands = layout(max(sizes), min(sizes), containment, retrieval)
        own = spark.createDataFrame([(r["name"], r["shingles"]) for r in rows_], "license string, shingles array<bigint>")
        least = F.transform(
            F.sequence(F.lit(1), F.lit(bands)),
            lambda b: F.array_min(F.transform("shingles", lambda h: F.struct(F.xxhash64(h, b).alias("value"), h.alias("shingle")))),
        )
        found = own.select("license", "shingles", least["value"].alias("minima"), least["shingle"].alias("least")).collect()
        classes.append(
            {"class": number, "width": width, "step": step, "bands": bands, "keys": sorted({k for r in found for k in r["least"]}),
             "templates": [(r["license"], r["shingles"], r["minima"]) for r in found]}
        )
    return classes


def _literal(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")


def scan(
    df: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    retrieval: float = RETRIEVAL,
) -> DataFrame:
    """A row for each notice in a text: the id, license, containment, first_word and last_word (from 0, inclusive)."""
    templates = TEMPLATES if templates is None else templates
    spark = df.sparkSession
    named = df.select(F.col(f"`{row_id}`").alias("id"), shingles_of(text_of(text)).alias("shingles"))
    classes = template_classes(spark, templates, containment, retrieval) if templates else []
    kinds = "class int, width int, step int, bands int, keys array<bigint>, templates array<struct<license:string,own:array<bigint>,minima:array<bigint>>>"
    known = spark.createDataFrame([tuple(c.values()) for c in classes], kinds)
    # Texts with a smallest shingle of any template, then the classes whose shingle it is.
    candidates = named.filter(F.arrays_overlap("shingles", _literal(sorted({k for c in classes for k in c["keys"]}))))
    fitting = [F.when(F.arrays_overlap("shingles", _literal(c["keys"])), F.lit(c["class"])) for c in classes]
    fitting = F.array_compact(F.array(*fitting).cast("array<int>"))
    # The class table has a row for each length class of the templates.
    parts = (
        candidates.withColumn("class", F.explode(fitting))
        .join(F.broadcast(known), "class")
        .withColumn("start", F.explode(F.sequence(F.lit(0), F.size("shingles") - 1, F.col("step"))))
        .withColumn("part", F.slice("shingles", F.col("start") + 1, F.col("width")))
        .drop("shingles")
        .filter(F.arrays_overlap("part", "keys"))
        .withColumn("minima", _minima(F.col("part"), F.col("bands")))
    )
    retrieved = F.filter(
        "templates", lambda t: F.exists(F.zip_with("minima", t["minima"], lambda a, b: a == b), lambda same: same)
    )
    held = F.size(F.array_intersect("template.own", "part")) / F.size("template.own")
    hits = F.array_compact(F.transform("part", lambda h, i: F.when(F.array_contains("template.own", h), i)))
    found = (
        parts.withColumn("template", F.explode(retrieved))
        .withColumn("containment", held)
        .filter(F.col("containment") >= containment)
        .withColumn("hits", hits)
        .select(
            "id", "template.license", "containment", "start",
            (F.col("start") + F.array_min("hits")).cast("bigint").alias("first_word"),
            (F.col("start") + F.array_max("hits") + SHINGLE_WORDS - 1).cast("bigint").alias("last_word"),
        )
    )
    best = F.min_by(F.struct("containment", "first_word", "last_word"), F.struct(-F.col("containment"), "start"))
    found = found.groupBy("id", "license").agg(best.alias("best"))
    return found.select(F.col("id").alias(row_id), "license", "best.*")
