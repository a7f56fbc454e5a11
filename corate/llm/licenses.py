"""Operator 8: license scan with MinHash bands over overlapping windows.

Texts and license templates become words (runs of letters and digits,
lower-cased) and 5-word shingles. Templates are put into classes by length:
a template of class L has more than L/2 and at most L shingle positions
(L a power of two). In class L a text has windows of 2L positions every L
positions, so each passage of up to L positions lies whole in some window.

Each window gets MinHash values, one row per band, and meets the templates
of its class that share a value in a band. The least similarity of a window
that holds ``MIN_CONTAINMENT`` of a template follows from the template's
distinct shingles and the 2L of a window without repeats (about 0.18 for a
template of L/2 + 1 shingles); each class gets as many bands as make all of
them miss with a probability of at most ``MISS`` for its worst template
(about 100 for long templates of that kind). Windows without
any shingle of a template can't contain one and are not signed: that is a
filter on exact grounds, not a sample. Retrieved pairs are verified by the
exact share of the template's shingles (as text) in the window.

Only the templates are broadcast (given by the caller as a Python table).
The texts stay in their rows up to the windows that hold a template's
shingle; verified windows are then grouped by document.

Defined results: a null or empty text, or one of fewer than five words, has
no license. Rows sharing a doc_id are scanned each and reported together;
null ids together too. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import let, lower_ascii, table, text_of
from corate.session import materialize

SHINGLE = 5
MIN_CONTAINMENT = 0.75
MISS = 1e-9

#: Public license notices (fixed values): (license, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                "the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
            "in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _template_rows(templates) -> list[tuple[int, str, int, list[str]]]:
    """(number, license, class, distinct shingles) of each template."""
    out = []
    for i, (name, text) in enumerate(templates):
        w = re.findall(r"[^\W_]+", text.lower())
        n = len(w) - SHINGLE + 1
        if n < 1:
            raise ValueError(f"template {i} has fewer than {SHINGLE} words")
        shingles = list(dict.fromkeys(" ".join(w[j:j + SHINGLE]) for j in range(n)))
        out.append((i, name, 1 << (n - 1).bit_length(), shingles))
    return out


def _words(text: Column) -> Column:
    clean = F.btrim(F.regexp_replace(lower_ascii(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def bands_of(rows) -> dict[int, int]:
    """The number of bands of each class of ``_template_rows``."""
    out: dict[int, int] = {}
    for _, _, size, shingles in rows:
        n = len(shingles)
        held = math.ceil(MIN_CONTAINMENT * n)
        similar = held / (n + 2 * size - held)
        out[size] = max(out.get(size, 1), math.ceil(math.log(MISS) / math.log1p(-similar)))
    return out


def _signature(shingles: Column, bands: Column) -> Column:
    """``bands`` MinHash values of an array of shingle hashes."""
    return F.transform(F.sequence(F.lit(0), bands - 1),
                       lambda b: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """``(doc_id, license, template, class, window, containment)``: every
    window that holds at least ``MIN_CONTAINMENT`` of a template."""
    spark = docs.sparkSession
    rows = _template_rows(templates)
    # as many rows as the caller's templates: broadcast by proven size
    table_ = spark.createDataFrame(rows, "template int, license string, class int, shingles array<string>")
    count = F.create_map(*[F.lit(x) for kv in bands_of(rows).items() for x in kv])[F.col("class")]
    hashed = F.transform("shingles", lambda s: F.xxhash64(s))
    bands = table_.select("template", "class", F.posexplode(_signature(hashed, count)).alias("band", "value"))
    known = sorted({h for (hs,) in table_.select(hashed).collect() for h in hs})  # the caller's templates only
    classes = sorted({r[2] for r in rows})

    def shingle(w: Column, i: Column) -> Column:
        return F.array_join(F.slice(w, i + 1, SHINGLE), " ")

    def hits(w: Column) -> Column:
        pos = F.sequence(F.lit(0), F.size(w) - SHINGLE)
        return F.when(F.size(w) >= SHINGLE, F.filter(
            pos, lambda i: F.xxhash64(shingle(w, i)).isin(known)))

    def windows(w: Column, h: Column, c: int) -> Column:
        """The windows of class ``c`` that hold one of the positions ``h``."""
        starts = F.array_distinct(F.flatten(F.transform(
            h, lambda p: F.array(F.floor(p / c), F.floor(p / c) - 1))))
        return F.transform(F.filter(starts, lambda k: k >= 0), lambda k: F.struct(
            F.lit(c).alias("class"), k.cast("bigint").alias("window"),
            F.slice(w, (k * c + 1).cast("int"), 2 * c + SHINGLE - 1).alias("w")))

    def of_text(w: Column) -> Column:
        return let(hits(w), lambda h: F.concat(*[windows(w, h, c) for c in classes]))

    found = (docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                         F.explode(let(_words(text_of(F.col(f"`{text_col}`"))), of_text)).alias("x"))
             .select("doc_id", "x.class", "x.window",
                     let(F.col("x.w"), lambda w: F.transform(
                         F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: shingle(w, i))).alias("s")))
    found = materialize(found.select(
        F.monotonically_increasing_id().alias("n"), "doc_id", "class", "window",
        F.array_distinct("s").alias("s")), "license-windows")
    signed = found.select("n", "class", F.posexplode(let(
        F.transform("s", lambda s: F.xxhash64(s)), lambda s: _signature(s, count))).alias("band", "value"))
    pairs = (signed.join(F.broadcast(bands), ["class", "band", "value"])
             .select("n", "template").distinct())
    share = F.size(F.array_intersect("s", "shingles")) / F.size("shingles")
    return (found.join(pairs, "n").join(F.broadcast(table_.drop("class")), "template")
            .withColumn("containment", share)
            .where(F.col("containment") >= MIN_CONTAINMENT)
            .select("doc_id", "license", "template", "class", "window", "containment"))


def query(spark, sf_dir) -> DataFrame:
    """Per document: its licenses and the number of windows that show them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = (scan(docs).groupBy("doc_id")
             .agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
                  F.count_distinct("license").alias("n_licenses"),
                  F.count(F.lit(1)).alias("n_windows"), F.max("containment").alias("containment")))
    found = materialize(found, "license-docs").withColumnRenamed("doc_id", "d")
    ids = docs.select("doc_id")
    return (ids.join(found, ids.doc_id.eqNullSafe(found.d), "left")
            .select("doc_id", F.coalesce("n_licenses", F.lit(0)).cast("bigint").alias("n_licenses"),
                    F.coalesce("licenses", F.lit("")).alias("licenses"),
                    F.coalesce("n_windows", F.lit(0)).cast("bigint").alias("n_windows"),
                    F.coalesce("containment", F.lit(0.0)).alias("containment")))


def _sql() -> str:
    rows = _template_rows(TEMPLATES)
    q = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(f"({i}, {q(name)}, {c}, {len(s)}, {q(x)})" for i, name, c, s in rows for x in s)
    return f"""
WITH tmpl(template, license, class, n, shingle) AS (VALUES
{values}),
d AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w
      FROM documents),
s AS (SELECT doc_id, unnest(range(0, len(w) - {SHINGLE - 1})) AS p, w FROM d),
h AS (SELECT doc_id, p, array_to_string(w[p + 1:p + {SHINGLE}], ' ') AS shingle FROM s),
m AS (SELECT doc_id, template, license, class, n, h.shingle, unnest([p // class, p // class - 1]) AS k
      FROM h JOIN tmpl USING (shingle)),
v AS (SELECT doc_id, template, license, k, count(DISTINCT shingle)::DOUBLE / n AS containment
      FROM m WHERE k >= 0 GROUP BY doc_id, template, license, k, n),
g AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
             count(DISTINCT license) AS n_licenses, count(*) AS n_windows, max(containment) AS containment
      FROM v WHERE containment >= {MIN_CONTAINMENT} GROUP BY doc_id)
SELECT doc_id, coalesce(n_licenses, 0) AS n_licenses, coalesce(licenses, '') AS licenses,
       coalesce(n_windows, 0) AS n_windows, coalesce(containment, 0.0::DOUBLE) AS containment
FROM documents LEFT JOIN g USING (doc_id)
"""


SQL = _sql()
