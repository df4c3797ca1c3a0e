import random

import pytest

from tierflow.llm import decontamination as dc
from tierflow.llm import toxicity as tx
from tests.llm.conftest import prose

BAD = ["vilescum", "rotten", "foulmouth", "cretin"]


def labelled(seed, n=600):
    """A quarter toxic: three or more of the bad words among ordinary prose."""
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        w, toxic = prose(rng, rng.randint(30, 300)).split(), int(rng.random() < 0.25)
        for _ in range(rng.randint(3, 6) * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(BAD) + rng.choice(["", ",", "!"]))
        docs.append((i, " ".join(w)))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = labelled(1)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    train = spark.createDataFrame(labels[:400] + [(5, None), (None, 1), (9999, 1), labels[0]], "doc_id long, toxic int")
    model = tx.fit(d, train)
    got = {r.doc_id: r.score for r in tx.score(d, model).collect()}
    held = [(got[i] >= tx.THRESHOLD, bool(t)) for i, t in labels[400:]]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in got.values())
    again = {r.doc_id: r.score for r in tx.score(d.repartition(5), tx.fit(d.repartition(3), train)).collect()}
    assert again == got


def test_score_of_odd_rows(spark, odd_docs, no_docs):
    docs, labels = labelled(2, 400)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = tx.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = tx.score(odd_docs, model)
    assert out.columns == [c for c in odd_docs.columns if c != "score"] + ["gain", "score"]
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r.gain == 0 and 0 <= r.score <= tx.THRESHOLD for r in rows if not r.text)
    assert tx.score(no_docs, model).count() == 0


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_labels_of_one_class_or_none(spark, toxic):
    docs, _ = labelled(3, 20)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = [] if toxic is None else [(i, toxic) for i, _ in docs]
    model = tx.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model["toxic"] == b"" and {r.gain for r in tx.score(d, model).collect()} == {0}


def test_score_matches_a_plain_model(spark):
    """The model once more in plain loops: texts dealt to the pairs, dictionaries from
    zstandard's trainer, windows, gates, excess over ordinary windows, steps."""
    import math
    import re
    import zlib

    import zstandard
    docs, labels = labelled(7, 500)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tx.fit(d, lab)
    key = tx.F.col("doc_id").cast("string")
    aside = {r.doc_id for r in d.filter(tx.F.pmod(tx.F.xxhash64(key), tx.F.lit(tx.CALIBRATION)) == 0).collect()}
    dealt = d.select("doc_id", *[tx.F.pmod(tx.F.xxhash64(key, tx.F.lit(k)), tx.F.lit(1_000_003)).alias(f"p{k}")
                                 for k in range(tx.PAIRS)]).collect()
    marked = {i: re.sub(r"[^0-9a-z\x80-\U0010ffff]+", "\x01\x02", f" {t.lower()} ").encode() for i, t in docs}
    of = dict(labels)
    count = [sum(of[i] == c for i in of if i not in aside) for c in (0, 1)]
    each = max(1.0, min(480, min(count) / 2))

    def trained(c, k):
        texts = [marked[r.doc_id] for r in dealt if r.doc_id not in aside and of[r.doc_id] == c
                 and r[f"p{k}"] < each / count[c] * 1_000_003]
        pieces = [t[i:i + 512] for t in sorted(texts, key=lambda t: (zlib.crc32(t), t)) for i in range(0, len(t), 512)]
        return zstandard.train_dictionary(8192, [x for x in pieces if len(x) >= 8], k=8, d=6).as_bytes()

    assert model["toxic"] == [trained(1, k) for k in range(12)] and model["plain"] == [trained(0, k) for k in range(12)]
    ca, co = [[tx.compressor(x) for x in model[c]] for c in ("toxic", "plain")]

    def gain(m):
        at, total = range(0, max(1, len(m)), 40), 0
        for i in at:
            g = [len(o.compress(m[i:i + 40])) - len(a.compress(m[i:i + 40])) for a, o in zip(ca, co, strict=True)]
            if g[0] >= 2 and sum(g[:2]) >= 4 and sum(g[:4]) >= 8:
                total += max(0, sum(g) - 24)
        return total, len(at)

    gains = {i: gain(marked[i]) for i, _ in docs}
    clean = [gains[i] for i, t in labels if i in aside and not t]
    mean = sum(g for g, _ in clean) / sum(k for _, k in clean)
    var = sum((g - mean * k) ** 2 for g, k in clean) / sum(k for _, k in clean)
    assert math.isclose(mean, model["mean"]) and math.isclose(var, model["variance"])
    for r in tx.score(d, model).collect():
        g, k = gains[r.doc_id]
        e = round((g - mean * k) / math.sqrt(var * k + 1), 6)
        step = [s for least, s in model["steps"] if e >= least][-1]
        assert r.gain == g and r.score == pytest.approx(0.99 * step + 0.01 * (0.5 + e / (abs(e) + 10) / 2), abs=1e-9)


def test_dictionaries_are_trained_on_whole_texts(spark):
    """The classes differ by a phrase whose words stand apart in the other class: no
    choice of words tells them, the texts do."""
    rng, docs, labels = random.Random(11), [], []
    phrase = ["kalithe", "semoden", "puraga", "tigali", "nonethe"]
    for i in range(750):
        w, toxic = prose(rng, rng.randint(60, 200)).split(), int(rng.random() < 0.25)
        for _ in range(6):
            at = rng.randrange(len(w))
            w[at:at] = phrase if toxic else [f"{prose(rng, 1)} {x}" for x in rng.sample(phrase, len(phrase))]
        docs.append((i, " ".join(w)))
        labels.append((i, toxic))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = tx.fit(d, spark.createDataFrame(labels[:600], "doc_id long, toxic int"))
    assert len(model["toxic"]) == len(model["plain"]) == 12
    got = {r.doc_id: r.score for r in tx.score(d, model).collect()}
    toxic, clean = [[got[i] for i, t in labels[600:] if t == c] for c in (1, 0)]
    assert sum(a > b for a in toxic for b in clean) >= 0.75 * len(toxic) * len(clean)


def test_windows_match_a_plain_loop():
    a, b = (tx.compressor(b"\0" + tx.MARK + w) for w in (b"rottenfoulmouth", b"zzzzzz"))
    text = prose(random.Random(1), 5000) + " rottenfoulmouth end"
    m = tx.marked(text)
    starts = range(0, max(1, len(m) - tx.WINDOW + tx.STEP), tx.STEP)
    want = sum(max(0, len(b.compress(m[i:i + tx.WINDOW])) - len(a.compress(m[i:i + tx.WINDOW]))) for i in starts)
    assert tx.text_gain(text, a, b) == (want, len(starts)) and want > 0


def test_calibration_is_monotone():
    steps = tx.calibrate([(0, 1, 50), (1, 5, 10), (2, 1, 10), (9, 9, 9)], 0.1)
    assert [s for _, s in steps] == sorted(s for _, s in steps) and len(steps) == 3


ITEM = ("A train leaves the old town of Verona at 9:30 and travels 240 km to the coast, while Anna drives 90 km from "
        "the harbour to meet it there; how many minutes does Anna wait at the station")


def leaks(spark, texts, items=((7, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in dc.contaminated(docs, bench).collect()}


def test_exact_cased_and_reparameterised_leaks(spark):
    rng = random.Random(2)
    around = [prose(rng, 30) for _ in range(8)]
    other = ITEM.replace("Verona", "Lisbon").replace("Anna", "Maria").replace("240", "310").replace("90 km", "75 km")
    mixed = other.replace("to meet it there; how many minutes does Maria", "to meet it there; how many minutes does Peter")
    texts = [f"{around[0]} {ITEM} {around[1]}", f"{around[2]} {ITEM.upper()} {around[3]}", f"{around[4]} {other}. {around[5]}",
             " ".join(ITEM.split()[4:18]), prose(rng, 300), " ".join(ITEM.split()[:6]) + " " + around[6], mixed, "", None]
    got = leaks(spark, texts)
    assert {d for d, _ in got} >= {0, 1, 2, 3, 6} and not {4, 5, 7, 8} & {d for d, _ in got}
    assert not got[0, 7].reparameterised and got[2, 7].reparameterised and got[2, 7].dropped == 0
    assert got[6, 7].dropped > 0 and got[0, 7].covered >= got[0, 7].item_words - 2


def test_slots_must_agree():
    keep = dc._reading([[0, 5], [1, 5], [2, 6], [0, 8]], [[0, 1], [1, 1], [2, 1], [0, 2]])
    assert keep.tolist() == [True, True, False, True]


def test_windows_match_brute_force(spark):
    """Without placeholders a template window is eight equal words."""
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(3, 40))) for i in range(30)]
    texts = []
    for i in range(200):
        t = items[rng.randrange(30)][1].split()
        a = rng.randrange(len(t))
        texts.append(f"{prose(rng, rng.randrange(40))} {' '.join(t[a:a + rng.randrange(len(t) + 1)])} {prose(rng, 20)}")
    want = set()
    for d, t in enumerate(texts):
        w = t.split()
        for i, x in items:
            v = x.split()
            k = min(8, len(v))
            if len(v) < dc.SHORTEST and len(w) != len(v):
                continue  # a phrase of three words matches a text of just these words
            at = [p for p in range(len(v) - k + 1) if any(w[q:q + k] == v[p:p + k] for q in range(len(w) - k + 1))]
            covered = {p + j for p in at for j in range(k)}
            if at and (len(covered) >= dc.MIN_WORDS or len(covered) >= dc.MIN_COVERAGE * len(v)):
                want.add((d, i))
    assert set(leaks(spark, texts, items)) == want and len(want) > 40


def test_short_and_slot_rich_items_are_found_verbatim(spark):
    rng = random.Random(9)
    items = ["What is the capital of France", "How many legs does a spider have", "Who wrote it",
             "In 1998 Anna paid 30 euros to Bob , 12 euros to Carl and 8 euros to Dora", "Bob has 5 pears and Carol has 7",
             "1 2 3 4 5 6 7 8 9 10 11 12"]
    texts = [f"{prose(rng, 40)} {t} {prose(rng, 40)}" for t in items]
    other = [f"{prose(rng, 40)} {t} {prose(rng, 40)}" for t in (
        "What is the capital of Peru", "How many legs does a crab have", "Bob has 6 pears and Carol has 9", "1 2 3 4 9 6 7 8 9 11 11 12",
        "capital of France", "In 1998 Anna paid")]
    got = leaks(spark, texts + other, list(enumerate(items)))
    assert {(i, i) for i in (0, 1, 3, 4, 5)} <= set(got) and (2, 2) not in got
    # without enough literals other values are another text; with them (five of six words) a name may change
    assert {d for d, _ in got} - set(range(6)) <= {6}


def test_odd_rows_and_clean_documents(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "Two words"), (None, "one"), (3, "Two words")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(odd_docs, bench).collect()}
    assert got == {(4, 3), (3, None)}
    out = dc.clean_documents(odd_docs, bench)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count() - 2
    assert dc.contaminated(no_docs, bench).count() == 0
    assert dc.clean_documents(odd_docs, bench.limit(0)).count() == odd_docs.count()
