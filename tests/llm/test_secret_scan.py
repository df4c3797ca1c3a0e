import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tierflow.llm import secret_scan as ss

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)


def base_spans(text):
    t = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def corpus():
    rng, rows = random.Random(4), []
    bits = ["password=hunter2hunter2", "TOKEN : 'abcdefgh1'", "api_key=short", "apikey=\"ABC/def+123==\"", "token=secret=abcdefgh",
            "password=token:abcdefghij", "AKIA" + "Q" * 12, "AKIAAKIA" + "Z9" * 8, "AKIA" + "Q" * 11, "0123456789abcdef" * 2,
            "f" * 31, "secret_token=x.y-z_123456", "\x01token=aaaaaaaaa\x01", "😀é", "passwd\t=aaaaaaaaaa", "Secret=\nabcdefghij",
            "ſecret=abcdefghij", "toKen=abcdefghij", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18,
            "https://user:pa55word@host/x", "token==abcdefgh", "token=" * 50]
    for i in range(150):
        parts = [rng.choice(bits) if rng.random() < 0.4 else prose(rng, rng.randrange(4)) for _ in range(rng.randrange(12))]
        rows.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    return rows + [(200, bits[0]), (201, bits[0]), (None, bits[0]), (None, None), (200, bits[0])]


def test_base_matches_brute_force(spark, tmp, odd_docs, no_docs):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    ledger = ss.BlobLedger(spark, f"{tmp}/ledger")
    ledger.scan(docs, 0)
    got = ledger.findings_by_path(docs, "doc_id").withColumn(
        "base", F.filter("found", lambda s: s["rank"] <= 3)).select("path", "blob", ss.digest(F.col("base"))).collect()
    want = sorted((str(i), hashlib.sha256((t or "").encode()).hexdigest(), ",".join(base_spans(t)))
                  for i, t in docs.collect())
    assert sorted((str(a), b, c) for a, b, c in got) == want
    assert sum(c != "" for *_, c in want) > 60
    # every distinct text has one ledger row, with or without findings
    assert ledger.read().count() == docs.select(ss.address(F.col("text"))).distinct().count()
    clash = odd_docs.withColumnRenamed("size", "blob").withColumnRenamed("node", "found")
    assert ledger.findings_by_path(clash, "doc_id").count() == odd_docs.count()
    empty = ss.BlobLedger(spark, f"{tmp}/empty")
    empty.scan(no_docs, 0)
    assert empty.read().count() == 0 and empty.findings_by_path(no_docs, "doc_id").count() == 0


def test_spans_of_added_rules(spark, tmp):
    text = "x ghp_" + "Zq" * 18 + " https://u:pa55word@h -----BEGIN EC PRIVATE KEY----- " + "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9
    docs = spark.createDataFrame([(1, text), (2, "a clean text, with ghosts: eyJ and xox")], "doc_id long, text string")
    ledger = ss.BlobLedger(spark, f"{tmp}/ledger")
    ledger.scan(docs, 0)
    rows = {r.path: r.found for r in ledger.findings_by_path(docs, "doc_id").collect()}
    assert [s.rule for s in rows[1]] == ["github", "userinfo", "pem", "jwt"] and rows[2] == []
    assert text[rows[1][2].start:rows[1][2].end] == "-----BEGIN EC PRIVATE KEY-----"


def test_only_unseen_pairs_are_scanned(spark, tmp):
    make = lambda rows: spark.createDataFrame(rows, "path string, text string")
    old = make([("a@1", "token=abcdefgh1"), ("b@1", "token=abcdefgh1"), ("c@1", "nothing")])
    new = make([("a@2", "token=abcdefgh1"), ("c@2", "AKIA" + "B" * 12), ("d@1", "nothing")])
    ledger = ss.BlobLedger(spark, f"{tmp}/ledger")
    rules = ss.BASE
    ledger.scan(old, 0, rules)
    assert [r.todo for r in ledger.unseen(old, rules).collect()] == []
    todo = ledger.unseen(new, rules).collect()
    assert [(r.text, len(r.todo)) for r in todo] == [("AKIA" + "B" * 12, 3)]
    ledger.scan(new, 1, rules)
    ledger.scan(new, 1, rules)  # a replay replaces its own increment
    assert ledger.read().groupBy("increment").count().collect() and ledger.read().count() == 3
    every = old.unionByName(new)
    found = {r.path: [s.rule for s in r.found] for r in ledger.findings_by_path(every, "path", rules).collect()}
    assert found == {"a@1": ["assign"], "b@1": ["assign"], "c@1": [], "a@2": ["assign"], "c@2": ["access"], "d@1": []}
    # a new version of one rule: every blob again, with that rule alone; old spans of it no longer count
    changed = (ss.Rule("assign", ss.BASE[0].pattern, version=2, group=2, least=20), *ss.BASE[1:])
    assert {tuple(r.todo) for r in ledger.unseen(every, changed).collect()} == {("assign@2",)}
    ledger.scan(every, 2, changed)
    found = {r.path: [s.rule for s in r.found] for r in ledger.findings_by_path(every, "path", changed).collect()}
    assert found["a@1"] == [] and found["c@2"] == ["access"]
