"""License scan by MinHash bands over text windows (operator 9, JVM-side only).

A text becomes the sequence of its five-word shingle hashes. Templates of up to
``m`` shingles (``m`` a power of two) are sought in windows of ``2 m`` shingles
every ``m``, so each occurrence lies whole in some window. With ``BANDS``
permutations of one row each, a window that holds 3/4 of a template's shingles
has Jaccard similarity of at least 0.375 / 2.125 to it and meets it in a band
with probability 1 - (1 - 0.176) ** 64 > 0.99999. Windows that meet a template
are verified by exact containment of distinct shingles (3/4 or more).

A window can only meet a template in a band by holding the shingle that is the
template's minimum there. Texts and windows without any such shingle are
therefore passed over before signatures are computed, without loss.

The templates are a parameter: a short list, sent to all tasks with its bands
(at most ``MAX_TEMPLATES``).

Edge cases: null texts and texts of fewer than five words hold nothing; a
template found several times counts once; null and repeated ids are told apart
by text hash and equal rows get equal results; other columns are ignored;
templates of fewer than five words are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import table

BANDS = 64
MAX_TEMPLATES = 1000
PERCENT = 75
# License notices by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 "
                 "International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy "
                "of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
               "v. 2.0.",
}


def shingles(text: str):
    """Hashes of the five-word shingles in text order."""
    words = f"filter(split(lower({text}), '[^a-z0-9]+'), w -> w <> '')"
    return F.expr(f"""
      transform(array({words}), ws -> IF(size(ws) < 5, cast(array() AS array<bigint>),
        transform(sequence(0, size(ws) - 5),
                  i -> xxhash64(ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]))))[0]""")


def signature(array: str):
    """Least value under each permutation."""
    return F.expr(f"transform(sequence(1, {BANDS}), b -> array_min(transform({array}, "
                  "h -> xxhash64(h, b))))")


def template_rows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, grams, n, m, least): distinct shingles, size class and signature."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    rows = rows.withColumn("grams", F.array_distinct(shingles("text")))
    if rows.filter("size(grams) = 0").count():
        raise ValueError("a template needs at least five words")
    return (rows.withColumn("n", F.size("grams"))
            .withColumn("m", F.expr("cast(shiftleft(1, cast(ceil(log2(n)) AS int)) AS int)"))
            .withColumn("least", signature("grams")).drop("text"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, key, license, shared, n): templates held by each text, one row per pair."""
    spark = docs.sparkSession
    known = template_rows(spark, templates).collect()  # bounded by MAX_TEMPLATES
    minima = spark.createDataFrame(known).select(
        "m", F.explode(F.expr("filter(grams, g -> exists(sequence(1, size(least)), "
                              "b -> least[b - 1] = xxhash64(g, b)))")).alias("g"))
    by_class: dict[int, set[int]] = {}
    for m, g in minima.collect():
        by_class.setdefault(m, set()).add(g)
    every = sorted(set().union(*by_class.values()))

    def array(values):
        return "array(" + ", ".join(f"{v}L" if v > -(1 << 63) else f"{v + 1}L - 1L"
                                    for v in sorted(values)) + ")"

    rows = keyed(docs, id_col, text_col)
    texts = (rows.select("doc_id", "key", shingles("text").alias("h"))
             .filter(F.expr(f"arrays_overlap(h, {array(every)})")))
    windows = F.concat(*(F.expr(f"""
        transform(filter(array_distinct(flatten(transform(
            filter(sequence(0, size(h) - 1), p -> array_contains({array(gs)}, h[p])),
            p -> array(p div {m}, p div {m} - 1)))), k -> k >= 0),
          k -> struct({m} AS m, array_distinct(slice(h, cast(k * {m} + 1 AS int), {2 * m})) AS w))
        """) for m, gs in sorted(by_class.items())))
    cut = (texts.select("doc_id", "key", F.explode(windows).alias("x"))
           .select("doc_id", "key", "x.m", "x.w").withColumn("least", signature("w")))
    bands = spark.createDataFrame(known).select(
        "license", "m", "grams", "n", F.posexplode("least").alias("band", "value"))
    met = (cut.select("doc_id", "key", "m", "w", F.posexplode("least").alias("band", "value"))
           .join(F.broadcast(bands), ["m", "band", "value"]))
    held = met.withColumn("shared", F.size(F.array_intersect("w", "grams"))).filter(
        100 * F.col("shared") >= PERCENT * F.col("n"))
    return (held.groupBy("doc_id", "key", "license")
            .agg(F.max("shared").alias("shared"), F.max("n").alias("n")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"),
                       text.alias("text"))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_licenses, licenses (sorted, comma-joined) of every document."""
    found = (scan(docs, id_col, text_col, templates).groupBy("doc_id", "key")
             .agg(F.array_sort(F.collect_set("license")).alias("found"))
             .select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "found"))
    rows = keyed(docs, id_col, text_col).select("doc_id", "key")
    same = rows.doc_id.eqNullSafe(F.col("_d")) & (rows.key == F.col("_k"))
    return rows.join(found, same, "left").select(
        "doc_id", F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.concat_ws(",", "found"), F.lit("")).alias("licenses"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every row of ``documents``."""
    return licenses(table(spark, sf_dir, "documents"))


def oracle(templates: dict[str, str] = TEMPLATES) -> str:
    """DuckDB SQL of the same result by exact containment in all windows."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in templates.items())
    return f"""
WITH raw(license, text) AS (VALUES {rows}),
tw AS (SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM raw),
t AS (SELECT DISTINCT license, array_to_string(list_slice(w, k, k + 4), ' ') AS s
      FROM tw, unnest(range(1, len(w) - 3)) AS u(k)),
tn AS (SELECT license, count(*) AS n, pow(2, ceil(log2(count(*))))::BIGINT AS m
       FROM t GROUP BY license),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w
       FROM documents),
d AS (SELECT doc_id, k - 1 AS p, array_to_string(list_slice(w, k, k + 4), ' ') AS s
      FROM dw, unnest(range(1, len(w) - 3)) AS u(k) WHERE len(w) >= 5),
hit AS (SELECT doc_id, license, n, s, p // m AS k FROM d JOIN t USING (s) JOIN tn USING (license)
        UNION ALL
        SELECT doc_id, license, n, s, p // m - 1 FROM d JOIN t USING (s) JOIN tn USING (license)),
found AS (SELECT DISTINCT doc_id, license FROM (
            SELECT doc_id, license, n, k, count(DISTINCT s) AS c FROM hit WHERE k >= 0
            GROUP BY ALL) WHERE 100 * c >= {PERCENT} * n)
SELECT doc_id, count(license) AS n_licenses,
       coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses
FROM dw LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""
