"""License scans in DataFrame expressions only: MinHash bands over windows, then exact containment.

Texts and templates are compared by words of lower-case letters and digits, in shingles of five
words (all words of a shorter text are one shingle). A template is reported for a document that
contains at least `CONTAINMENT` of its different shingles.

Retrieval: the shingle hashes of every text are cut into windows of `WINDOW` shingles, each
overlapping half of the next. A window's signature has `BANDS` bands of one MinHash each. Templates
are signed at every offset. A copy that keeps 0.8 of n shingles keeps an unbroken run of at least
0.8 n / (0.05 n + 1) of them, because one edited word breaks at least four: five or more from n = 6
on, and a run of five holds a whole window, whose bands all collide with those of the template's
window there. Templates of up to five shingles are signed with windows of a single shingle, where
the MinHash is the shingle itself and collides certainly. A window with similarity s to one of the
template's collides with probability 1 - (1 - s)^BANDS besides.

Null and empty texts contain nothing; empty templates are never reported. Repeated rows each have
their own result rows; texts of one template name count together. Empty tables give no rows. Columns are
read by name; others are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, small_side

WIDTH, CONTAINMENT = 5, 0.8
WINDOW, BANDS, SHORT = 4, 2, 5

# Notices by which texts state their license, and the conditions of short licenses.
TEMPLATES = {
    "AGPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "BSD-header": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": (
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
        "his or her rights to the work worldwide under copyright law, including all related and neighboring rights, "
        "to the extent allowed by law."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row, also where `body` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(text: Column) -> Column:
    """Hashes of all shingles of a text, in order."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return _let(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - WIDTH)),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WIDTH)]),
        ),
    )


def _has_words(text: Column) -> Column:
    return text.rlike(r"[\p{L}\p{N}]")


def signatures(hashes: Column, step: int) -> Column:
    """Bands of all windows that begin at every `step`-th shingle; the last ones may be shorter."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(hashes) - 1), F.lit(step))

    def of_band(band: int) -> Column:
        mixed = F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))
        # Elements by place: taking a slice would copy the whole array for each window.
        return _let(mixed, lambda m: F.transform(starts, lambda i: F.least(*[F.get(m, i + k) for k in range(WINDOW)])))

    return F.concat(*map(of_band, range(BANDS)))


def _marked(text: Column) -> Column:
    """What a text is looked up by: its shingles, then the bands of its windows."""
    return _let(shingles(text), lambda s: F.concat(s, signatures(s, WINDOW // 2)))


def scan(docs: DataFrame, notices: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, license, its number of shingles, how many the document has, and the containment.

    `notices` has a license name and a text; a name's texts count as one template.
    """
    listed = cut(
        notices.where(_has_words(F.col("text")))
        .select("license", shingles(F.col("text")).alias("all"))
        .groupBy("license")
        .agg(F.array_distinct(F.flatten(F.collect_list("all"))).alias("wanted"), F.collect_list("all").alias("texts"))
        .withColumn("n_shingles", F.size("wanted"))
    )
    whole = F.flatten(F.transform("texts", lambda s: signatures(s, 1)))
    mark = F.when(F.col("n_shingles") <= SHORT, F.col("wanted")).otherwise(whole)
    marks = small_side(cut(listed.select("license", F.explode(mark).alias("mark")).distinct()))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).where(_has_words(F.col("text")))
    found = rows.select("doc_id", F.explode(_marked(F.col("text"))).alias("mark")).join(marks, "mark")
    candidates = cut(found.select(F.col("doc_id").alias("found_id"), "license").distinct())
    had = F.size(F.array_intersect(F.col("wanted"), shingles(F.col("text"))))
    return (
        rows.join(candidates, F.col("doc_id").eqNullSafe(F.col("found_id")))
        .join(small_side(listed.select("license", "wanted", "n_shingles")), "license")
        .select("doc_id", "license", "n_shingles", had.alias("n_found"))
        .withColumn("containment", F.col("n_found") / F.col("n_shingles"))
        .where(F.col("containment") >= CONTAINMENT)
    )


def oracle_sql() -> str:
    """Exact containment of every template in every document, in DuckDB SQL."""
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in TEMPLATES.items())
    cut_up = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    grams = f"""list_distinct([array_to_string(w[i:i + {WIDTH - 1}], ' ')
                for i in range(1, greatest(1, len(w) - {WIDTH - 1}) + 1)])"""
    return f"""
    WITH t AS (SELECT license, {cut_up.format("text")} AS w FROM (VALUES {values}) v(license, text)),
    d AS (SELECT doc_id, {cut_up.format("text")} AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT license, {grams} AS g FROM t WHERE len(w) > 0),
    x AS (SELECT doc_id, unnest({grams}) AS g FROM d WHERE len(w) > 0),
    y AS (SELECT license, len(g) AS n_shingles, unnest(g) AS g FROM s),
    z AS (SELECT doc_id, license, n_shingles, COUNT(*) AS n_found FROM x JOIN y USING (g) GROUP BY ALL)
    SELECT doc_id, license, n_shingles::INTEGER AS n_shingles, n_found::INTEGER AS n_found,
           n_found / n_shingles AS containment
    FROM z WHERE n_found / n_shingles >= {CONTAINMENT}"""
