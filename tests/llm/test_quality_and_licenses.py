import random
import re
from collections import Counter

import duckdb

from tierflow.llm import license_scan as ls
from tierflow.llm import quality_rules as qr
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in qr.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered))


def test_measures_match_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(3)
    texts = [prose(rng, n) for n in (3, 4, 60)] + ["a b c a b c d", "x x x x", "# | a\na\n\n a\na", "😀 $$ é"]
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(500 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    want = sorted((str(r.doc_id), *measures(r.text)) for r in docs.collect())
    got = qr.measures(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert qr.apply_rules(no_docs).count() == 0
    assert qr.apply_rules(odd_docs, keep=("doc_id", "size", "node")).columns[:3] == ["doc_id", "size", "node"]
    clash = odd_docs.withColumnRenamed("size", "n_words").withColumnRenamed("node", "kept")
    got = qr.apply_rules(clash, keep=("doc_id", "n_words", "kept", "lang"))
    assert got.columns[:2] == ["doc_id", "lang"] and got.columns.count("n_words") == 1 and got.columns.count("kept") == 1
    assert sorted(r.n_words for r in got.collect()) == sorted(measures(r.text)[0] for r in odd_docs.collect())


def test_rules_name_what_is_broken(spark):
    good = " ".join(f"The word{i} of it{i}" for i in range(20)) + "."
    rows = [(1, good), (2, "short"), (3, good.replace("of", "###")), (4, "the same words " * 30)]
    got = {r.doc_id: r.broken_rules for r in qr.apply_rules(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [] and "too_short" in got[2] and "symbols" in got[3] and "repeated_words" in got[4]


def test_license_scan_matches_containment(spark, odd_docs, no_docs):
    rng, rows = random.Random(8), []
    for i in range(120):
        name = rng.choice(sorted(ls.TEMPLATES))
        body = ls.TEMPLATES[name].split()
        if rng.random() < 0.4:  # one word in a few is edited
            for _ in range(max(1, len(body) // 12)):
                body[rng.randrange(len(body))] = "edited"
        rows.append((i, f"{prose(rng, rng.randrange(60))} {' '.join(body).upper()}! {prose(rng, rng.randrange(60))}"))
    rows += [(200, prose(rng, 500)), (201, ""), (202, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = sorted(con.execute(ls.ORACLES["op10_license_scan"]).fetchall())
    out = ls.scan(spark, docs).select("doc_id", "license", "containment", "first_word", "windows")
    assert sorted(tuple(r) for r in out.collect()) == want
    assert len({r[0] for r in want}) > 90
    assert ls.scan(spark, odd_docs).count() == 0 and ls.scan(spark, no_docs).count() == 0


def test_bands_find_every_window_at_the_threshold():
    """The least similarity that the docstring states, for every class in use."""
    for n in range(1, 400):
        size, stride = ls.classes([n])[ls.class_of(n)]
        assert stride >= 1 and size >= n + stride - 1
        least = -(-3 * n // 4)
        assert n < 4 or least / (size + n - least) >= 0.4


def test_reserved_rights_and_further_notices_are_found(spark):
    notices = {
        "All-rights-reserved": "All rights reserved.",
        "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
                          "of the MPL was not distributed with this file, You can obtain one at the site.",
        "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                      "fee is hereby granted, provided that"}
    rng = random.Random(3)
    docs = [(i, f"{prose(rng, 40)}\n{n}\n{prose(rng, 40)}") for i, n in enumerate(notices.values())] + [
        (100, prose(rng, 80)), (102, "All rights are reserved")]
    rows = ls.scan(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in rows} == set(enumerate(notices))
