"""License scan: MinHash bands over overlapping windows, then exact containment.

Texts are words (lower case, parted by ``GAP``) and 3-word shingles.  Templates
are sorted into classes by length; a class has windows of a fixed number of
shingles at a fixed stride, chosen so that every place of a text as long as the
longest template of the class lies wholly in one window.  A window is compared
with the templates of its class:

* its MinHash value in each band is looked up in the (bounded, broadcast) table
  of the templates' values;
* a template found by any band is verified by exact containment: the share of
  its shingles that the window holds.

A window that contains at least ``CONTAINMENT`` of a template of its class has a
Jaccard similarity of 0.41 or more to it; with 16 bands of one value it shares a
band with a probability of at least 1 - (1 - 0.41)**16 = 0.9998.

The minimum of a window can equal a template's only if the shingle behind it is
one of the templates'.  So windows without any template shingle cannot share a
band, and texts without one are left before any window is made.  That changes no
result.  Only DataFrame functions are used, and no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import read

K = 3  # words of a shingle
# what parts words: ASCII other than letters and digits, and the usual marks and spaces beyond ASCII
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\u00A0\u00AB\u00BB\u2000-\u206F]+"
BANDS = 16
CONTAINMENT = 0.75
RATIO = 1.25  # between the longest templates of neighbouring classes
MAX_SHINGLES = 20_000  # of all templates together: 160 kB in the plan
# Public notices, as they stand at the head of files or the foot of pages.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"),
    "AGPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation"),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "All-rights-reserved": "All rights reserved.",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"),
    "ISC-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted"),
}


def shingle_hashes(text: Column) -> Column:
    """Hashes of the 3-word shingles of a text, in order, as one array; the
    expression evaluates the words once."""
    w = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), "")
    h = F.transform(w, lambda x: F.xxhash64(x))

    def join(h: Column) -> Column:
        n = F.size(h) - (K - 1)
        out = F.slice(h, F.lit(1), F.greatest(n, F.lit(0)))
        for i in range(1, K):
            out = F.zip_with(out, F.slice(h, F.lit(i + 1), F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        return out

    return F.element_at(F.transform(F.array(h), join), 1)


def classes(lengths) -> dict[int, tuple[int, int]]:
    """Class -> (shingles of a window, stride) for the classes in use."""
    out = {}
    for n in lengths:
        c = class_of(n)
        longest = math.floor(RATIO ** c + 1e-9)
        stride = max(1, longest // 4)
        out[c] = (longest + stride - 1, stride)
    return out


def class_of(n: int) -> int:
    c = 0
    while math.floor(RATIO ** c + 1e-9) < n:
        c += 1
    return c


def _minhash(shingles: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.struct(
        j.alias("band"), F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j))).alias("value")))


def scan(spark: SparkSession, docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and license found: ``doc_id, license, containment``
    (the best window's), ``first_word`` (where that window begins, the first such
    window; counted from 0) and ``windows`` (how many hold the template).

    Texts that are null, empty or shorter than three words match nothing.  Rows
    with the same id, repeated rows or null ids too, count as one document whose
    windows are taken together.  Templates need three words or more.  Other
    columns of the input are ignored; an empty table gives an empty result."""
    table = spark.createDataFrame(sorted(templates.items()), "license string, body string")
    found = table.select("license", F.array_distinct(shingle_hashes(F.col("body"))).alias("s"),
                         F.size(shingle_hashes(F.col("body"))).alias("n")).collect()
    if not found or any(r["n"] < 1 for r in found):
        raise ValueError(f"templates need at least {K} words, and there must be one")
    if sum(r["n"] for r in found) > MAX_SHINGLES:
        raise ValueError(f"the templates have more than {MAX_SHINGLES} shingles")
    sized = classes(r["n"] for r in found)
    bands = (spark.createDataFrame([(r["license"], class_of(r["n"]), r["s"]) for r in found],
                                   "license string, cls int, template array<bigint>")
             .select("license", "cls", "template", F.explode(_minhash(F.col("template"))).alias("m"))
             .select("license", "cls", "template", F.col("m.band").alias("band"), F.col("m.value").alias("value")))
    known = F.array(*[F.lit(x) for x in sorted({x for r in found for x in r["s"]})])
    # a generator, so that the filter below does not compute the shingles once more beneath the projection
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                    F.explode(F.array(shingle_hashes(F.col(f"`{text_col}`")))).alias("s"))
    # the common shingles are bound by a lambda: as a column they would be computed for every shingle again
    at = F.element_at(F.transform(F.array(F.array_intersect("s", known)), lambda hit: F.filter(
        F.transform("s", lambda x, i: F.when(F.array_contains(hit, x), i)), lambda i: i.isNotNull())), 1)
    d = d.filter(F.arrays_overlap("s", known)).select("doc_id", "s", at.alias("at"))

    def starts(cls: int, size: int, stride: int) -> Column:
        some = F.transform("at", lambda p: F.sequence(
            F.ceil(F.greatest(p - (size - 1), F.lit(0)) / stride).cast("int"), F.floor(p / stride).cast("int")))
        return F.transform(F.array_distinct(F.flatten(some)), lambda i: F.struct(
            F.lit(cls).alias("cls"), (i * stride).alias("start"), F.lit(size).alias("size")))

    every = F.concat(*[starts(c, size, stride) for c, (size, stride) in sorted(sized.items())])
    w = d.select("doc_id", "s", F.explode(every).alias("w"))
    w = w.select("doc_id", "w.cls", "w.start", F.array_distinct(
        F.slice("s", F.col("w.start") + 1, F.col("w.size"))).alias("ws"))
    w = w.select("doc_id", "cls", "start", "ws", F.explode(_minhash(F.col("ws"))).alias("m"))
    w = w.select("doc_id", "cls", "start", "ws", F.col("m.band").alias("band"), F.col("m.value").alias("value"))
    # at most MAX_SHINGLES * BANDS rows
    hit = w.join(F.broadcast(bands), ["cls", "band", "value"])
    share = F.size(F.array_intersect("ws", "template")) / F.size("template")
    hit = hit.select("doc_id", "license", "start", share.alias("share")).filter(F.col("share") >= containment)
    best = F.struct(F.col("share"), (-F.col("start")).alias("back"))
    return (hit.groupBy("doc_id", "license")
            .agg(F.max(best).alias("best"), F.count_distinct("start").alias("windows"))
            .select("doc_id", "license", F.col("best.share").alias("containment"),
                    (-F.col("best.back")).cast("long").alias("first_word"), "windows"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, read(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))
    gap = "[" + r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{00A0}\x{00AB}\x{00BB}\x{2000}-\x{206F}" + "]+"
    split = "list_filter(string_split_regex(lower({}), '" + gap.replace("{", "{{").replace("}", "}}") + "'), lambda x: x <> '')"
    cut = f"list_transform(range(1, len(w) - {K - 2}), lambda i: array_to_string(w[i:i + {K - 1}], ' '))"
    table = ", ".join(f"({n}, {c}, {classes([n])[c][0]}, {classes([n])[c][1]})"
                      for n in range(1, 200) for c in [class_of(n)])
    return f"""
WITH tw AS (SELECT license, {split.format('body')} AS w FROM (VALUES {rows}) AS t(license, body)),
t AS (SELECT license, list_distinct(s) AS s, cls, size, stride
      FROM (SELECT license, {cut} AS s FROM tw) JOIN (VALUES {table}) AS c(n, cls, size, stride) ON len(s) = n),
dw AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
d AS (SELECT doc_id, {cut} AS s FROM dw),
hits AS (SELECT d.doc_id, s, unnest(list_filter(range(0, len(s)), lambda i: list_contains(k.s2, s[i + 1]))) AS p
         FROM d, (SELECT list_distinct(flatten(list(s))) AS s2 FROM t) k WHERE list_has_any(s, k.s2)),
starts AS (
  SELECT DISTINCT doc_id, hits.s AS s, t.license, t.s AS ts, t.size,
         unnest(range(ceil(greatest(p - (t.size - 1), 0) / t.stride::DOUBLE)::BIGINT, p // t.stride + 1)) * t.stride AS start
  FROM hits, t),
shares AS (
  SELECT doc_id, license, start, len(list_intersect(list_distinct(s[start + 1:start + size]), ts)) / len(ts) AS share
  FROM starts)
SELECT doc_id, license, max(share) AS containment,
       (min(start) FILTER (share = top))::BIGINT AS first_word, count(DISTINCT start) AS windows
FROM (SELECT *, max(share) OVER (PARTITION BY doc_id, license) AS top FROM shares WHERE share >= {CONTAINMENT})
GROUP BY doc_id, license
"""


QUERIES = {"op10_license_scan": op10_license_scan}
ORACLES = {"op10_license_scan": _sql()}
