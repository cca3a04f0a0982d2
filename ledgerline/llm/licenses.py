"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Words are lower-case runs of letters and digits; a shingle is ``SHINGLE`` words in a row (a template with fewer words is one
shingle by itself, of that length). Documents and templates are cut into windows of ``WINDOW`` words, a new one every
``STEP`` words, so any ``WINDOW - STEP + 1`` words in a row lie whole in one window. A window's MinHash signature has one value for each
band; windows that agree in a band meet. Two windows that share one shingle have a Jaccard similarity of at least
``1 / (2 * (WINDOW - SHINGLE + 1) - 1)``; the number of bands is taken so that a template of one shingle, and any pair above
that similarity, is missed by a window with a probability of at most ``MISS``. The bands alone decide what is retrieved, whatever the size of the template table.
Retrieved templates are verified over the whole text: the share of the template's distinct shingles that the text holds must reach ``CONTAINMENT``.

A shingle of a template always holds the one of its words that fewest documents have (counted over all of them: one row a template word); a
window without any of these words shares no shingle with a template, so it is not hashed. A text's words are cut out once and handed on as rows. Template
tables are parameters of bounded size (checked: ``MAX_TEMPLATES``).
Defined results: null and empty texts, and templates without words, match nothing. Very long texts are scanned in full, in time that grows with their length.
Repeated rows each get their matches, null ids included; other columns are ignored. DataFrame functions only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import save

SHINGLE, WINDOW, STEP, CONTAINMENT, MISS = 5, 12, 4, 0.8, 1e-3
MAX_TEMPLATES = 10_000

#: Short notices, the sentences of standard headers that name a version, permission clauses and titles of license texts, under SPDX
#: identifiers and, if there are several of one, what they are; tags that name an identifier. Each begins and ends so that another version or license lacks more
#: than a fifth of its shingles. Those with fewer words than a shingle are found word for word.
TEMPLATES = [
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0 header", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0 header", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0 name", "the Apache License, Version 2.0"),
    ("Apache-2.0 title", "Apache License Version 2.0, January 2004"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause endorsement", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-4.0 short", "under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-NC-4.0 short", "under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-SA-4.0 short", "under CC BY-SA 4.0"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("CC0-1.0 title", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-2.0 header", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-3.0 header", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1 header", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0 header", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT licensed", "Licensed under the MIT License."),
    ("MIT text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("MPL-2.0 header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT short", "Released under MIT License"),
    ("reserved rights", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
] + [
    (f"{name} tag", f"SPDX-License-Identifier: {name}")
    for name in ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1), F.array().cast("array<string>"))


def _shingles(array: Column, size: int) -> Column:
    """Distinct hashes of the runs of ``size`` words; none if there are fewer."""
    starts = F.sequence(F.lit(1), F.size(array) - F.lit(size - 1))
    each = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(array, i, size), " ")))
    return F.when(F.size(array) >= size, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def bands(miss: float = MISS) -> int:
    """Bands of one row that miss the least similarity of windows with a shared shingle with probability ``miss``."""
    least = 1 / (2 * (WINDOW - SHINGLE + 1) - 1)
    return math.ceil(math.log(miss) / math.log(1 - least))


def _windows(array: Column, marks: Column) -> Column:
    """The windows that have one of the marks."""
    last = F.greatest(F.lit(0), F.size(array) - F.lit(WINDOW - STEP + 1))
    windows = F.transform(F.sequence(F.lit(0), last, F.lit(STEP)), lambda i: F.slice(array, i + 1, WINDOW))
    return F.filter(windows, lambda w: F.arrays_overlap(w, marks))


def _signatures(shingles: Column, n: int) -> Column:
    """One long for each band: its number hashed with the least hash of the window's shingles."""

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.xxhash64(k, F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, k)))))


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(templates, "license_id string, text string")


def _strings(found: list[str]) -> Column:
    return F.array(*map(F.lit, found)).cast("array<string>")


def rarest_words(docs: DataFrame, of: list[list[str]]) -> list[str]:
    """For each shingle of the templates its word that fewest documents have. What reaches the driver are the counts of the templates' own words."""
    known = sorted({x for w in of for x in w})
    held = docs.select(F.explode(F.array_intersect(words(F.col("text")), _strings(known))).alias("word"))
    counts = {r.word: r["count"] for r in held.groupBy("word").count().collect()}
    return sorted({min(w[i : i + SHINGLE], key=lambda x: (counts.get(x, 0), -len(x), x)) for w in of for i in range(max(1, len(w) - SHINGLE + 1))})


def scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """doc_id, license_id, n_found and n_template (distinct shingles) and containment of every match."""
    listed = templates.select("license_id", "text").filter(F.col("text").isNotNull()).limit(MAX_TEMPLATES + 1).collect()
    if len(listed) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    spark = docs.sparkSession
    of = [(r.license_id, w) for r in listed if (w := _WORDS(r.text.lower()))]
    sizes = sorted({min(SHINGLE, len(w)) for _, w in of})
    if not of:
        return docs.select("doc_id", F.lit("").alias("license_id"), F.lit(0).alias("n_found"), F.lit(0).alias("n_template"), F.lit(0.0).alias("containment")).filter(F.lit(False))
    marks = _strings(rarest_words(docs, [w for _, w in of]))
    table = spark.createDataFrame([(k, w) for k, (_, w) in enumerate(of)], "template int, words array<string>")

    # words come out of a generator, so no later expression cuts the text again; texts without a mark end there
    cut = F.filter(F.array(words(F.col("text"))), lambda w: F.arrays_overlap(w, marks))
    kept = save(docs.select("doc_id", F.struct("doc_id", F.sha2("text", 256).alias("h")).alias("row"), F.explode(cut).alias("words")), "license-texts")

    n = bands(miss)

    def keyed(df: DataFrame, by: str) -> DataFrame:
        """(by, size, signature) of all windows and shingle sizes."""
        each = df.select(by, F.explode(_windows(F.col("words"), marks)).alias("w"))
        sets = F.array(*(F.struct(F.lit(s).alias("size"), _shingles(F.col("w"), s).alias("set")) for s in sizes))
        each = each.select(by, F.explode(F.filter(sets, lambda x: F.size(x["set"]) > 0)).alias("s"))
        return each.select(by, "s.size", F.explode(_signatures(F.col("s.set"), n)).alias("signature"))

    # a template meets windows by the signatures of its own shingle size
    own = F.least(F.size("words"), F.lit(SHINGLE))
    sides = keyed(table, "template").distinct().join(table.select("template", own.alias("own")), "template").filter(F.col("size") == F.col("own")).drop("own")
    met = save(keyed(kept, "row").join(F.broadcast(sides), ["size", "signature"]).groupBy("row").agg(F.collect_set("template").alias("templates")), "license-pairs")

    # verification over whole texts: a text's shingles of each size are made once, by a generator again
    facts = table.select("template", F.element_at(_strings([t or "" for t, _ in of]), F.col("template") + 1).alias("license_id"), own.alias("own"), F.when(own == SHINGLE, _shingles(F.col("words"), SHINGLE)).otherwise(F.array(F.xxhash64(F.array_join("words", " ")))).alias("wanted"))
    sets = F.array(F.map_from_arrays(F.array(*map(F.lit, sizes)), F.array(*(_shingles(F.col("words"), s) for s in sizes))))
    pairs = kept.join(met, "row").select("doc_id", "templates", F.explode(sets).alias("sets")).select("doc_id", "sets", F.explode("templates").alias("template"))
    pairs = pairs.join(F.broadcast(facts), "template").withColumn("n_found", F.size(F.array_intersect(F.col("sets")[F.col("own")], F.col("wanted")))).withColumn("n_template", F.size("wanted"))
    share = F.col("n_found") / F.col("n_template")
    return pairs.withColumn("containment", share).filter(share >= containment).select("doc_id", "license_id", F.col("n_found").cast("long"), F.col("n_template").cast("long"), "containment")


_WORDS = re.compile(r"[^\W_]+").findall

def _sql_shingles(rows: str, group: str, size: int) -> str:
    """group, size and every run of ``size`` words of rows (group, i, x)."""
    run = " || ' ' || ".join(["x", *(f"lead(x, {k}) OVER words" for k in range(1, size))])
    return f"SELECT DISTINCT {group}, {size} AS size, {run} AS shingle FROM {rows} WINDOW words AS (PARTITION BY {group} ORDER BY i)"


_SIZES = sorted({min(SHINGLE, len(_WORDS(text.lower()))) for _, text in TEMPLATES})

#: The verified result in DuckDB SQL, for the production templates; those of fewer than five words have shingles of their own length.
SQL = f"""
WITH t AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES)}) AS v(license_id, text)),
w AS (SELECT license_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM t),
wx AS (SELECT license_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
s AS (SELECT a.* FROM ({" UNION ALL ".join(f"({_sql_shingles('wx', 'license_id', k)})" for k in _SIZES)}) AS a JOIN w USING (license_id)
  WHERE shingle IS NOT NULL AND size = least(len(w), {SHINGLE})),
n AS (SELECT license_id, count(*) AS n_template FROM s GROUP BY license_id),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
dx AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
h AS ({" UNION ALL ".join(f"({_sql_shingles('dx', 'r', k)})" for k in _SIZES)}),
f AS (SELECT r, license_id, count(*) AS n_found FROM h JOIN s USING (size, shingle) GROUP BY r, license_id)
SELECT doc_id, license_id, n_found, n_template, n_found / n_template AS containment FROM f JOIN n USING (license_id) JOIN d USING (r) WHERE n_found / n_template >= {CONTAINMENT}
"""
