"""License scan by DataFrame functions only.

A template is a known notice; a document holds it where a window of the
document's words contains at least ``CONTAINMENT`` of the template's five-word
shingles.  Templates fall into classes by their number of shingles: class L has
those with more than L/2 and at most L.  For each class the document is cut
into overlapping windows of 2L shingles, one every L, so that L shingles in a
row always lie whole in one of them.

Windows and templates are compared by MinHash bands of one row.  A window that
contains a template to the wanted share has a Jaccard similarity of at least
``0.4 L / 2.1 L`` with it, and ``BANDS`` bands let such a pair collide with a
probability over 0.999998 (``collision_probability``).  What collides is
verified by the exact shingle containment.

A band can only collide on a shingle that is the least of some template, so
documents and windows without any of those are passed over before they are hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import table

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
#: More template shingles than this are an error: they stand in the query's plan.
MAX_SHINGLES = 20_000

#: Notices in common use.  Fixed values.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "MIT line": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}

_NOT_WORD = r"[^\p{L}\p{N}]+"


def least_similarity(containment: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a window of 2L shingles and a template of over L/2 contained to that share."""
    return 0.5 * containment / (2 + 0.5 * (1 - containment))


def collision_probability(bands: int = BANDS, containment: float = CONTAINMENT) -> float:
    return 1 - (1 - least_similarity(containment)) ** bands


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _shingles(text: Column) -> Column:
    """Hashes of the five-word shingles, in order: words are runs of letters and digits in lower case."""
    words = F.filter(F.split(F.lower(text), _NOT_WORD), lambda w: w != "")
    grams = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    return _let(F.transform(words, lambda w: F.xxhash64(w)),
                lambda w: F.when(F.size(w) < SHINGLE, F.array().cast("array<bigint>")).otherwise(grams(w)))


def _cuts(name: str, c: int) -> Column:
    """The windows of class c: one at every c-th shingle."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(name) - 1) / c).cast("int")), lambda i: F.struct(F.lit(c).alias("c"), (i * c).alias("start")))


def _signature(name: str, bands: int) -> Column:
    """For each band the least of its hashes over the shingles, with the band's number folded in."""
    least = lambda w, b: F.array_min(F.transform(w, lambda s: F.xxhash64(s, b)))
    return _let(F.col(name), lambda w: F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.xxhash64(b, least(w, b))))


def _least_shingles(name: str, bands: int) -> Column:
    """The shingles that are least in some band."""
    least = lambda b: F.array_min(F.transform(F.col(name), lambda s: F.struct(F.xxhash64(s, b).alias("h"), s.alias("s"))))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: least(b).getField("s")))


def prepared_templates(spark: SparkSession, templates: dict[str, str], bands: int = BANDS) -> DataFrame:
    """``(license, shingles, many, class, signature, least)`` of every template."""
    rows = spark.createDataFrame(list(templates.items()), "license string, body string")
    rows = rows.select("license", F.array_distinct(_shingles(F.col("body"))).alias("shingles")).withColumn("many", F.size("shingles"))
    size = F.pow(F.lit(2.0), F.ceil(F.log2("many"))).cast("int").alias("class")
    return rows.where("many > 0").select("*", size).withColumn("signature", _signature("shingles", bands)).withColumn("least", _least_shingles("shingles", bands))


def scan(df: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text",
         containment: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """``(key, license, containment, window_start, window_shingles)``: the best window of each row and template.

    ``window_start`` is the number of the window's first shingle (its first
    word); ties go to the first window.  Rows with null or empty text, or with
    fewer than five words, hold nothing.  Repeated rows give rows of their own,
    a null key stays null, other columns do not take part, and an empty input
    gives an empty result.  A template of fewer than five words is an error.
    """
    spark = df.sparkSession
    templates = TEMPLATES if templates is None else templates
    known = prepared_templates(spark, templates, bands)
    rows = known.select("license", "class", "shingles", "least").collect()  # the templates, given by the caller
    if len(rows) < len(templates):
        raise ValueError(f"a template has fewer than {SHINGLE} words")
    if sum(len(r["shingles"]) for r in rows) > MAX_SHINGLES:
        raise ValueError(f"the templates have more than {MAX_SHINGLES} shingles")
    literal = lambda xs: F.array(*[F.lit(x) for x in sorted(xs)]).cast("array<bigint>")
    least = {c: {x for r in rows if r["class"] == c for x in r["least"]} for c in sorted({r["class"] for r in rows})}
    # the row number stands beside the shingles, so that no filter on them is pushed below and computes them again
    docs = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.monotonically_increasing_id().alias("row"), _shingles(F.col(text)).alias("s"))
    docs = docs.where(F.arrays_overlap("s", literal(set().union(*least.values()))))
    cuts = F.flatten(F.array(*[_cuts("s", c) for c in least]))
    windows = docs.withColumn("cut", F.explode(cuts)).select("k", "row", "cut.c", "cut.start", F.expr("slice(s, cut.start + 1, 2 * cut.c)").alias("w"))
    of_class = F.lit(False)
    for c, shingles in least.items():
        of_class = F.when(F.col("c") == c, F.arrays_overlap("w", literal(shingles))).otherwise(of_class)
    signed = windows.where(of_class).withColumn("band", F.explode(_signature("w", bands)))
    bandwise = known.select("license", "shingles", "many", F.col("class").alias("c"), F.explode("signature").alias("band"))
    met = signed.join(F.broadcast(bandwise), ["c", "band"])  # bounded: BANDS rows of at most MAX_SHINGLES shingles in all
    share = F.size(F.array_intersect("w", "shingles")) / F.col("many")
    verified = met.select("k", "row", "license", "c", "start", share.alias("share")).where(F.col("share") >= containment)
    best = verified.groupBy("row", "k", "license").agg(F.max(F.struct("share", (-F.col("start")).alias("back"), "c")).alias("b"))
    return best.select(F.col("k").alias(key), "license", F.col("b.share").alias("containment"), (-F.col("b.back")).cast("long").alias("window_start"),
                       (F.col("b.c") * 2).cast("int").alias("window_shingles"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices in all documents."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def oracle_sql() -> str:
    """The same rows by counting every template's shingles in every window."""
    quoted = ", ".join("('{}', '{}')".format(n.replace("'", "''"), t.replace("'", "''")) for n, t in TEMPLATES.items())
    shingles = """SELECT id, pos, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS s, lead(w, 4) OVER o AS fifth
        FROM (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM {0}) WINDOW o AS (PARTITION BY id ORDER BY pos)"""
    words = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"
    return f"""
    WITH t AS (SELECT license AS id, {words.format('body')} AS ws FROM (VALUES {quoted}) v(license, body)),
    ts AS (SELECT DISTINCT id AS license, s FROM ({shingles.format('t')}) WHERE fifth IS NOT NULL),
    sized AS (SELECT license, count(*) AS many, CAST(pow(2, ceil(log2(count(*)))) AS INTEGER) AS c FROM ts GROUP BY 1),
    d AS (SELECT doc_id AS id, {words.format('text')} AS ws FROM documents WHERE text IS NOT NULL),
    ds AS (SELECT id, pos, s FROM ({shingles.format('d')}) WHERE fifth IS NOT NULL),
    hit AS (SELECT ds.id, ds.pos, ts.license, ts.s, many, c FROM ds JOIN ts USING (s) JOIN sized USING (license)),
    win AS (SELECT id, license, s, many, c, (pos // c) * c AS start FROM hit
            UNION ALL SELECT id, license, s, many, c, (pos // c) * c - c FROM hit WHERE pos >= c),
    share AS (SELECT id, license, c, start, count(DISTINCT s) / any_value(many) AS share FROM win GROUP BY 1, 2, 3, 4)
    SELECT id AS doc_id, license, share AS containment, CAST(start AS BIGINT) AS window_start, CAST(2 * c AS INTEGER) AS window_shingles
    FROM share WHERE share >= {CONTAINMENT}
    QUALIFY row_number() OVER (PARTITION BY id, license ORDER BY share DESC, start) = 1"""
