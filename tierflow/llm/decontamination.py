"""Benchmark decontamination by template canonicalisation.

Words lose outer punctuation and case (A-Z and Latin-1); numbers, names and units become typed
placeholders whose values are kept as slots.  Every 8-word window of the
templates is hashed; windows of documents are hash-joined with windows of the
benchmark.  So a question with other numbers or names in it still meets its
original.  Then the slots are checked: over all windows that a document shares
with an item, a slot value of the item must stand for one value of the document,
and the reverse.  Windows that contradict the commonest reading are dropped.  An
item is found in a document when the windows that are left cover at least
``MIN_WORDS`` of its words or ``MIN_COVERAGE`` of them.

Items shorter than a window are one window of their own size; documents get windows
of every such size that the benchmark has, from ``SHORTEST`` words on (still shorter
items are phrases that any text may hold: they match only texts of just these
words).  A window with fewer than ``MIN_LITERALS`` words outside its slots says too
little as a template: it is hashed with its slot values instead, so exact copies
always meet and only re-parameterised ones need enough literals.

A bitmap of the benchmark's window hashes (its size is fixed) lets tasks drop
most windows of the corpus before the join; the join itself decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import vec
from tierflow.llm.common import by_value, cut, read

by_value(__name__)

WINDOW = 8  # words
SHORTEST = 4  # words of an item that is looked for inside longer texts
MIN_LITERALS = 5  # of a window; with fewer, its slots count by value
MIN_WORDS = 10
MIN_COVERAGE = 0.5
FILTER_BITS = 1 << 24  # 2 MB
MAX_BROADCAST = 1_000_000  # ids: 16 MB
# Units that follow a number.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s ms min h hr hour hours minute minutes second seconds day days "
         "week weeks month months year years percent % usd eur gbp dollar dollars euro euros cent cents mph kmh km/h "
         "w kw mw v a hz khz mhz ghz kb mb gb tb c f k j kj cal kcal pa bar n mol").split()
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x11F4E1, 0x22A4E2, 0x330413))  # template values of the placeholders


def _kinds():
    """Classes of bytes: digit, inside a number, A-Z, a-z or not ASCII, end of a
    sentence, punctuation that is stripped."""
    k = {n: np.zeros(256, dtype=bool) for n in ("digit", "numeric", "upper", "lower", "stop", "outer")}
    k["digit"][48:58] = True
    k["numeric"][48:58] = True
    k["numeric"][[ord(c) for c in ".,:/-"]] = True
    k["upper"][65:91] = True
    k["lower"][97:123] = True
    k["lower"][128:] = True
    k["stop"][[ord(c) for c in ".!?:;"]] = True
    for lo, hi in ((33, 48), (58, 65), (91, 97), (123, 127)):
        k["outer"][lo:hi] = True
    k["outer"][ord("%")] = False  # a unit
    return k


def _unit_hashes():
    text = " ".join(UNITS).encode()
    raw = np.frombuffer(text, dtype=np.uint8)
    b, s, e, _ = vec.find_words(raw, np.array([0, len(raw)]))
    return np.sort(vec.hash_spans(b, s, e))


def templates(raw, off, quoted: bool = False):
    """(template value, is a slot, slot value, words per row) of the rows; ``quoted``:
    the first word of a row is read as one inside a sentence, where a capital makes a
    name."""
    kind = _kinds()
    b, s, e, counts = vec.find_words(raw, off)
    n = len(s)
    if not n:
        z = np.zeros(0, np.uint64)
        return z, np.zeros(0, bool), z, counts
    row = np.repeat(np.arange(len(counts)), counts)
    begins = np.ones(n, dtype=bool)  # of a sentence: first word, new line, or after a full stop
    lines = np.concatenate([[0], np.cumsum(b == 10)])
    begins[1:] = (row[1:] != row[:-1]) | kind["stop"][b[e[:-1] - 1]] | (lines[s[1:]] != lines[e[:-1]])
    if quoted:
        begins[np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))] = False
    s, e = s.copy(), e.copy()
    outer = kind["outer"]
    while True:
        move = (s < e) & outer[b[np.minimum(s, len(b) - 1)]]
        if not move.any():
            break
        s[move] += 1
    while True:
        move = (s < e) & outer[b[e - 1]]
        if not move.any():
            break
        e[move] -= 1
    keep = s < e  # words of punctuation alone are no words of a template
    s, e, row, begins = s[keep], e[keep], row[keep], begins[keep]
    counts = np.bincount(row, minlength=len(counts)).astype(np.int64)
    # capitals of Latin-1 (UTF-8 lead byte C3) besides A-Z
    after_c3 = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)) + 1
    lower, capital = b.copy(), kind["upper"][b]
    lower[after_c3] += 0x20
    capital[after_c3 - 1] = True
    value = vec.hash_spans(lower, s, e)
    token = value.copy()
    if not len(s):
        return token, np.zeros(0, bool), value, counts
    digits = np.concatenate([[0], np.cumsum(kind["digit"][b])])
    numeric = np.concatenate([[0], np.cumsum(kind["numeric"][b])])
    is_number = (digits[e] > digits[s]) & (numeric[e] - numeric[s] == e - s)
    second = np.minimum(s + 1 + (b[s] == 0xC3), len(b) - 1)
    small = kind["lower"][b[second]] & ~capital[second]
    is_name = ~begins & capital[s] & (second < e) & small & ~is_number
    is_unit = np.zeros(len(s), dtype=bool)
    after = np.flatnonzero(is_number[:-1] & (row[1:] == row[:-1])) + 1
    is_unit[after] = np.isin(value[after], _unit_hashes())
    is_name &= ~is_unit
    token[is_number], token[is_name], token[is_unit] = NUMBER, NAME, UNIT
    return token, is_number | is_name | is_unit, value, counts


def windows(token, value, slot, counts, k: int, only_longer: bool = False):
    """(hash, first word, size, row, first word of the row) of all windows of ``k``
    words.  A row of fewer words has one window; with ``only_longer`` it has none, and
    neither has a row of just ``k`` words."""
    n = len(token)
    end = np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    start_of = (end - counts)[row]
    at = np.arange(n)
    size = np.minimum(k, counts[row])
    fits = at + size <= end[row]
    short = counts[row] < k
    fits &= ~short | (at == start_of)
    if only_longer:
        fits &= counts[row] > k
    at, size = at[fits], size[fits]
    up, down = vec.powers(n + 1)
    slots = np.concatenate([[0], np.cumsum(slot)])
    literal = size - (slots[at + size] - slots[at])
    enough = literal >= np.minimum(MIN_LITERALS, size)

    def rolled(words, salt):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * up[:n], out=sums[1:])
        return vec.mix((sums[at + size] - sums[at]) * down[at] + size.astype(np.uint64) + np.uint64(salt))

    h = np.where(enough, rolled(token, 0), rolled(value, 1 << 32))
    return h, at, size, row[at], start_of[at]


def _found(column, ids, k: int, bits=None, sizes=()):
    """Arrow batches ``id, pos, hash, words, slots`` of the windows of a column (of ``k``
    words, and of ``sizes`` in longer rows), only those in ``bits`` if given (else they are
    an item's, and those that it would have inside a sentence come as well); ``slots`` are the slot values with their
    places in the window, ``words`` the row's words."""
    raw, off = vec.utf8(column)
    for lo, hi, quoted in ((lo, hi, q) for lo, hi in vec.chunks(off) for q in ((False, True) if bits is None else (False,))):
        token, slot, value, counts = templates(raw, off[lo:hi + 1], quoted)
        parts = [windows(token, value, slot, counts, k), *[windows(token, value, slot, counts, x, True) for x in sizes]]
        h, at, size, row, start = (np.concatenate(x) for x in zip(*parts, strict=True))
        if bits is not None:
            p = h & np.uint64(FILTER_BITS - 1)
            hit = (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
            h, at, size, row, start = h[hit], at[hit], size[hit], row[hit], start[hit]
        if not len(h):
            continue
        slots = []
        for i, n in zip(at, size):
            where = np.flatnonzero(slot[i:i + n])
            slots.append(np.stack([where.astype(np.int64), value[i + where].view(np.int64)], 1).ravel())
        yield pa.RecordBatch.from_arrays(
            [ids.slice(lo, hi - lo).take(pa.array(row)), pa.array(at - start), pa.array(h.view(np.int64)),
             pa.array(counts[row]), pa.array(slots, pa.list_(pa.int64()))], ["id", "pos", "hash", "words", "slots"])


FOUND = "id long, pos long, hash long, words long, slots array<bigint>"


def window_table(df: DataFrame, id_col: str, text_col: str, k: int = WINDOW, bits=None, sizes=()) -> DataFrame:
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    shared = None if bits is None else df.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            yield from _found(batch.column(1), batch.column(0), k, None if shared is None else shared.value, sizes)

    return src.mapInArrow(run, FOUND)


def _bits(items: DataFrame):
    """Bitmap of the window hashes: FILTER_BITS / 64 rows at most."""
    p = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = (items.select(F.shiftright(p, 6).alias("word"), p.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toArrow())
    bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    bits[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return bits


def _reading(d_slots, i_slots) -> np.ndarray:
    """Which windows agree with one reading of the slots.  Readings (item value,
    document value) are taken by how many windows hold them, and each value only
    once on either side."""
    pairs = []
    for d, i in zip(d_slots, i_slots):
        d, i = np.asarray(d).reshape(-1, 2), np.asarray(i).reshape(-1, 2)
        pairs.append(list(zip(i[:, 1].tolist(), d[:, 1].tolist())))
    votes: dict = {}
    for p in pairs:
        for x in set(p):
            votes[x] = votes.get(x, 0) + 1
    forward, back = {}, {}
    for (i, d), _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
        if i not in forward and d not in back:
            forward[i], back[d] = d, i
    return np.array([all(forward.get(i) == d for i, d in p) for p in pairs], dtype=bool)


def _check(table: pa.Table) -> pa.Table:
    """One document and one item: consistent windows and what they cover."""
    keep = _reading(table.column("d_slots").to_pylist(), table.column("i_slots").to_pylist())
    n = int(table.column("i_words")[0].as_py())
    d_pos, i_pos = (table.column(c).to_numpy()[keep] for c in ("d_pos", "i_pos"))
    size = min(WINDOW, n)
    covered = np.unique((i_pos[:, None] + np.arange(size)).ravel())
    slots = [len(s) for s, k in zip(table.column("d_slots").to_pylist(), keep) if k]
    same = [a == b for a, b, k in zip(table.column("d_slots").to_pylist(), table.column("i_slots").to_pylist(), keep) if k]
    return pa.table({
        "doc_id": table.column("doc_id").slice(0, 1).cast(pa.int64()),
        "item_id": table.column("item_id").slice(0, 1).cast(pa.int64()),
        "windows": pa.array([int(keep.sum())]), "dropped": pa.array([int((~keep).sum())]),
        "item_words": pa.array([n]), "covered": pa.array([len(covered)]),
        "first_word": pa.array([int(d_pos.min()) if len(d_pos) else None], pa.int64()),
        "last_word": pa.array([int(d_pos.max()) + size - 1 if len(d_pos) else None], pa.int64()),
        "reparameterised": pa.array([any(slots) and not all(same)])})


CHECKED = ("doc_id long, item_id long, windows long, dropped long, item_words long, covered long, first_word long, "
           "last_word long, reparameterised boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", min_words: int = MIN_WORDS,
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id,
    windows`` (that agree), ``dropped`` (that contradict them), ``item_words,
    covered`` (words of the item), ``first_word, last_word`` (in the document's
    template words), ``reparameterised`` (slots with other values).

    Null or empty texts, of either table, match nothing; items of fewer words
    than a window match as a whole, those under ``SHORTEST`` only whole texts.  Rows with the same id, repeated rows too,
    count as one document or item; null ids too.  Other columns are ignored."""
    items = cut(window_table(benchmark, item_col, item_text_col).distinct())
    short = items.filter(F.col("words").between(SHORTEST, WINDOW - 1)).select("words").distinct()
    sizes = sorted(int(r["words"]) for r in short.collect())  # WINDOW - SHORTEST values at most
    found = window_table(docs, id_col, text_col, bits=_bits(items), sizes=sizes)
    d = found.select(F.col("id").alias("doc_id"), F.col("pos").alias("d_pos"), "hash", F.col("slots").alias("d_slots"))
    i = items.select(F.col("id").alias("item_id"), F.col("pos").alias("i_pos"), "hash", F.col("words").alias("i_words"),
                     F.col("slots").alias("i_slots"))
    hits = d.join(i, "hash").filter(F.size("d_slots") == F.size("i_slots"))
    # the same words give the same row, however often the document repeats them
    hits = hits.groupBy("doc_id", "item_id", "i_pos", "i_words", "d_slots", "i_slots").agg(F.min("d_pos").alias("d_pos"))
    checked = hits.groupBy("doc_id", "item_id").applyInArrow(_check, CHECKED)
    return checked.filter((F.col("covered") >= min_words) | (F.col("covered") >= min_coverage * F.col("item_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found; rows with a null id are
    judged together."""
    bad = cut(contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("__bad")).distinct())
    if bad.count() <= MAX_BROADCAST:  # else a join of both sides by id
        bad = F.broadcast(bad)
    return docs.join(bad, F.col(f"`{id_col}`").eqNullSafe(F.col("__bad")), "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLES: dict[str, str] = {}
