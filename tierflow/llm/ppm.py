"""Language-model scoring: prediction by partial matching over bytes.

Text.  A text is its words in lower case (A-Z), each followed by a space, then
an end byte; that is the sequence of tokens "words, then one end" as bytes.

Model.  A trie of byte contexts of up to ``ORDER`` bytes, trained on the whole
training part of the corpus: tasks count the (ORDER + 1)-grams of their texts,
Spark sums them, shorter contexts are sums of longer ones.  A byte is predicted
from its longest known context; if it was never seen there, the context escapes
to the next shorter one with the probability d / (t + d) (t: bytes seen there, d:
distinct ones), and the symbols of the longer context are excluded below.  At the
bottom all bytes that were never seen are equally likely.  Symbols that follow a
context also follow its shorter ones, so each context's exclusion sums are known
in advance, and a byte that its longest context knows costs one table lookup.

The counts that tasks gather grow with the corpus, and no context is left out:

1. Counts of words and of (ORDER + 1)-grams are summed by key.
2. The grams are dealt by the last ``SPLIT`` bytes of their context.  All longer
   contexts that end alike meet there, at most 2**24 grams; the counts of shorter
   contexts, at most 2**(8 * SPLIT) of them, are broadcast.  So every gram of the
   corpus, seen in training or not, gets its exact log probability once.
3. The ``HOT_LEAVES`` most frequent grams are broadcast with theirs and summed up
   where the text is, as are the most frequent words with their counts (at most
   2**18).  All others are looked up in hash buckets, each once for each text.  A
   bucket is split by salts where a gram or word that is not broadcast may still
   fill it.

Base.  Unigram counts of words are exact over all training texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import vec
from tierflow.llm.common import by_value, cut, fold, read

by_value(__name__)

ORDER = 5  # bytes of the longest context, 7 at most
SPLIT = 3  # last context bytes by which grams are dealt
HOT_LEAVES = 1 << 20  # grams that are broadcast: 40 bytes each
LEAVES_EACH = 500_000  # grams in a bucket of contexts
END, SPACE = 10, 32
BUCKET_BYTES = 16_000_000  # of text for each bucket of words
WORD_BYTES = 6  # of a word's hash, besides its bucket
GROUP_BYTES = 256_000_000  # of one word's or gram's postings in a bucket; beyond that it is salted
FLUSH = 1 << 19  # entries that a task holds of each kind


def byte_stream(b, starts, ends, counts, order: int = ORDER):
    """(bytes, scored, scored bytes per row): the canonical text of every row,
    each after ``order`` end bytes as its first context."""
    lens = ends - starts
    row = np.repeat(np.arange(len(counts)), counts)
    rows = len(counts)
    per_row = np.bincount(row, weights=lens + 1, minlength=rows).astype(np.int64) + 1
    row_at = np.concatenate([[0], np.cumsum(per_row + order)])
    out = np.full(int(row_at[-1]), SPACE, dtype=np.uint8)
    if len(starts):
        before = np.concatenate([[0], np.cumsum(lens + 1)])[:-1]
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        base = np.append(before, 0)[np.minimum(first, len(before))]
        at = before - base[row] + row_at[:-1][row] + order
        src = np.repeat(starts - before + np.arange(len(lens)), lens) + np.arange(int(lens.sum()))
        dst = np.repeat(at - before + np.arange(len(lens)), lens) + np.arange(int(lens.sum()))
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        out[dst] = low[b[src]]
    scored = np.ones(len(out), dtype=bool)
    for i in range(order):
        out[row_at[:-1] + i] = END
        scored[row_at[:-1] + i] = False
    out[row_at[1:] - 1] = END
    return out, scored, per_row


def gram_keys(stream, scored, order: int = ORDER):
    """For every scored byte the last ``order`` bytes and itself as one number."""
    key = stream.astype(np.uint64)
    for j in range(1, order + 1):
        key[j:] |= stream[:-j].astype(np.uint64) << np.uint64(8 * j)
    return key[scored]


def merge_counts(keys, *counts):
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], *(np.add.reduceat(c[order], at) if len(at) else c for c in counts)


class Trie:
    """Counts of ``(context, byte)`` for contexts of ``order`` bytes down to none.
    ``below``: the levels of the shortest contexts, where they are known already."""

    def __init__(self, keys, counts, order: int = ORDER, below: list | None = None):
        self.order, below = order, below or []
        keys, counts = np.asarray(keys, np.uint64), np.asarray(counts, np.int64)
        self.levels = [*below, *[None] * (order + 1 - len(below))]
        for j in range(order, len(below) - 1, -1):
            keys, counts = merge_counts(keys & np.uint64((1 << 8 * (j + 1)) - 1), counts)
            ctx = keys >> np.uint64(8)
            at = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
            total = np.add.reduceat(counts, at) if len(at) else counts
            self.levels[j] = {"keys": keys, "n": counts, "ctx": ctx[at], "at": at, "t": total,
                              "d": np.diff(np.append(at, len(ctx)))}
        for j in range(max(1, len(below)), order + 1):  # what is left of the parent after the exclusion
            lv, up = self.levels[j], self.levels[j - 1]
            if not len(lv["ctx"]):
                lv["dx"], lv["den"] = lv["d"], lv["t"]
                continue
            same = np.searchsorted(up["keys"], lv["keys"] & np.uint64((1 << 8 * j) - 1))
            gone = np.add.reduceat(up["n"][same], lv["at"])
            parent = np.searchsorted(up["ctx"], lv["ctx"] & np.uint64((1 << 8 * (j - 1)) - 1))
            lv["dx"] = up["d"][parent] - lv["d"]
            lv["den"] = up["t"][parent] - gone + lv["dx"]

    @staticmethod
    def _lookup(table, keys):
        if not len(table):
            return np.full(len(keys), -1, dtype=np.int64)
        i = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[i] == keys, i, -1)

    def log10(self, keys):
        """log10 of the probability of every byte in its context."""
        out, left = np.zeros(len(keys)), np.arange(len(keys))
        below = np.full(len(left), -1, dtype=np.int64)  # the longer context that was left, if known
        for j in range(self.order, -1, -1):
            if not len(left):
                return out
            lv = self.levels[j]
            key = keys[left] & np.uint64((1 << 8 * (j + 1)) - 1)
            ci, ei = self._lookup(lv["ctx"], key >> np.uint64(8)), self._lookup(lv["keys"], key)
            have = ci >= 0
            t = np.where(have, lv["t"][ci] + lv["d"][ci], 0) if len(lv["ctx"]) else np.zeros(len(left), np.int64)
            d = np.where(have, lv["d"][ci], 0) if len(lv["ctx"]) else np.zeros(len(left), np.int64)
            ex = below >= 0
            if ex.any():
                up = self.levels[j + 1]
                t[ex], d[ex] = up["den"][below[ex]], up["dx"][below[ex]]
            found = ei >= 0
            out[left[found]] += np.log10(lv["n"][ei[found]] / t[found])
            escape = ~found & have & (d > 0)
            out[left[escape]] += np.log10(d[escape] / t[escape])
            left, below = left[~found], ci[~found]
        root = self.levels[0]["d"]
        out[left] -= math.log10(256 - (int(root[0]) if len(root) else 0))
        return out


class Table:
    """Open addressing from keys to their places in the given order."""

    def __init__(self, keys):
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.where = np.zeros(1 << bits, dtype=np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.slots[at] == np.iinfo(np.uint64).max
            place, first = np.unique(at[free], return_index=True)
            taken = left[free][first]
            self.slots[place], self.where[place] = keys[taken], taken
            rest = ~np.isin(left, taken)
            left, at = left[rest], (at[rest] + 1) & ((1 << bits) - 1)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys):
        """Place of each key, or -1."""
        at = self._slot(keys)
        got = self.slots[at]
        out = np.where(got == keys, self.where[at], -1)
        left = np.flatnonzero((got != keys) & (got != np.iinfo(np.uint64).max))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slots) - 1)
            got = self.slots[at]
            same = got == keys[left]
            out[left[same]] = self.where[at[same]]
            more = ~same & (got != np.iinfo(np.uint64).max)
            left, at = left[more], at[more]
        return out


def _tokens(column):
    """Chunks ``(first row, bytes, starts, ends, words per row, hash of each word)``."""
    raw, off = vec.utf8(column)
    for lo, hi in vec.chunks(off):
        b, s, e, counts = vec.find_words(raw, off[lo:hi + 1])
        yield lo, b, s, e, counts, vec.hash_spans(b, s, e)


def _by_bucket(bucket, *columns):
    """The columns in the order of buckets, and ``(bucket, from, to)`` of each."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return [c[order] for c in columns], list(zip(bucket[at].tolist(), at, np.append(at[1:], len(bucket))))


def _packed(rows: list):
    """``(kind, bucket, entries, payload)`` rows as a batch."""
    kind, bucket, entries, payload = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int64()), pa.array(bucket, pa.int64()),
                                       pa.array([int(n) for n in entries], pa.int64()), pa.array(payload, pa.binary())],
                                      ["kind", "bucket", "entries", "payload"])


PACKED = "kind long, bucket long, entries long, payload binary"


def _hash_bucket(kind: int, keys, buckets: int):
    """Words are hashes already, grams are not."""
    return vec.top_bucket(vec.mix(keys) if kind else keys, buckets).astype(np.int64)


def corpus_counts(docs: DataFrame, buckets: int, order: int = ORDER) -> DataFrame:
    """``docs(text, train)`` -> counts by bucket, summed: ``kind`` 0 the words of
    training rows, 1 the byte grams of all rows; ``counts`` in training rows, ``everywhere``
    in all."""
    def run(batches):
        held, sizes = {0: [], 1: []}, {0: 0, 1: 0}

        def merged(kind):
            return merge_counts(*(np.concatenate(x) for x in zip(*held[kind])))

        def pack(kind, keys, train, every):
            (keys, train, every), parts = _by_bucket(_hash_bucket(kind, keys, buckets), keys, train, every)
            return _packed([(kind, p, j - i, vec.planes(keys[i:j]) + vec.planes(train[i:j]) + vec.planes(every[i:j]))
                            for p, i, j in parts])

        for batch in batches:
            learn = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=bool)
            for lo, b, s, e, counts, h in _tokens(batch.column(0)):
                mine = learn[lo:lo + len(counts)]
                stream, scored, per_row = byte_stream(b, s, e, counts, order)
                grams, of_train = gram_keys(stream, scored, order), np.repeat(mine, per_row)
                for kind, train, keys in ((0, True, h[np.repeat(mine, counts)]), (1, True, grams[of_train]),
                                          (1, False, grams[~of_train])):
                    u, n = np.unique(keys, return_counts=True)
                    if not len(u):
                        continue
                    held[kind].append((u, n if train else np.zeros_like(n), n))
                    sizes[kind] += len(u)
                    if sizes[kind] > 2 * FLUSH:
                        held[kind] = [merged(kind)]
                        sizes[kind] = len(held[kind][0][0])
                        if sizes[kind] > FLUSH:
                            yield pack(kind, *held[kind][0])
                            held[kind], sizes[kind] = [], 0
        for kind in (0, 1):
            if held[kind]:
                yield pack(kind, *merged(kind))

    def add(table: pa.Table) -> pa.Table:
        parts = []
        for n, payload in zip(table.column("entries").to_pylist(), table.column("payload")):
            data = memoryview(payload.as_buffer())
            parts.append((vec.unplanes(data, np.uint64, n), vec.unplanes(data[8 * n:], np.int64, n),
                          vec.unplanes(data[16 * n:], np.int64, n)))
        keys, train, every = merge_counts(*(np.concatenate(x) for x in zip(*parts)))
        return pa.table({"kind": table.column("kind").slice(0, 1), "bucket": table.column("bucket").slice(0, 1),
                         "entries": pa.array([len(keys)]), "total": pa.array([int(train.sum())]),
                         "keys": pa.array([keys.tobytes()], pa.binary()),
                         "counts": pa.array([train.tobytes()], pa.binary()),
                         "everywhere": pa.array([every.tobytes()], pa.binary())})

    return docs.select("text", "train").mapInArrow(run, PACKED).groupBy("kind", "bucket").applyInArrow(
        add, "kind long, bucket long, entries long, total long, keys binary, counts binary, everywhere binary")


def _rows(packed: DataFrame, least: int, value: str = "counts", by: str = "counts") -> DataFrame:
    """``key, value`` (8 bytes each) of the entries that ``by`` counts ``least`` times or more."""
    def run(batches):
        for batch in batches:
            for k, v, c in zip(*batch.columns):
                keep = np.frombuffer(c.as_buffer(), np.int64) >= least
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), np.int64)[keep])
                                                  for x in (k, v)], ["key", "value"])

    return packed.select("keys", F.col(value).alias("v"), F.col(by).alias("c")).mapInArrow(
        run, "key long, value long")


def _least_count(packed: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` entries reach everywhere."""
    def run(batches):
        for batch in batches:
            for c in batch.column(0):
                power = np.frexp(np.frombuffer(c.as_buffer(), np.int64).astype(float))[1] - 1
                n = np.bincount(power)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], ["power", "n"])

    rows = packed.select("everywhere").mapInArrow(run, "power long, n long").groupBy("power").agg(F.sum("n")).collect()
    sizes, power = dict(map(tuple, rows)), 0  # 64 rows at most
    while sum(n for p, n in sizes.items() if p >= power) > most:
        power += 1
    return 1 << power


def short_contexts(grams: DataFrame, split: int) -> list:
    """Levels of the contexts under ``split`` bytes: 2**(8 * split) counts at most."""
    def run(batches):
        for batch in batches:
            for k, c in zip(*batch.columns):
                keys = np.frombuffer(k.as_buffer(), np.uint64) & np.uint64((1 << 8 * split) - 1)
                keys, n = merge_counts(keys, np.frombuffer(c.as_buffer(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)[n > 0]), pa.array(n[n > 0])], ["key", "n"])

    got = (grams.select("keys", "counts").mapInArrow(run, "key long, n long")
           .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    return Trie(got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy(), split - 1).levels


def gram_scores(grams: DataFrame, below: list, order: int = ORDER) -> DataFrame:
    """``keys, score, everywhere``: the log10 probability of every gram."""
    split = len(below)
    shared = grams.sparkSession.sparkContext.broadcast(below)
    buckets = max(8, -(-int(grams.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0]) // LEAVES_EACH))

    def deal(batches):
        for batch in batches:
            for columns in zip(*batch.columns):
                keys, train, every = (np.frombuffer(c.as_buffer(), np.int64) for c in columns)
                end = (keys.view(np.uint64) >> np.uint64(8)) & np.uint64((1 << 8 * split) - 1)
                (keys, train, every), parts = _by_bucket(
                    vec.top_bucket(vec.mix(end + np.uint64(1)), buckets).astype(np.int64), keys, train, every)
                yield _packed([(1, p, j - i, vec.planes(keys[i:j]) + vec.planes(train[i:j]) + vec.planes(every[i:j]))
                               for p, i, j in parts])

    def score(table: pa.Table) -> pa.Table:
        got = []
        for n, payload in zip(table.column("entries").to_pylist(), table.column("payload")):
            data = memoryview(payload.as_buffer())
            got.append((vec.unplanes(data, np.uint64, n), vec.unplanes(data[8 * n:], np.int64, n),
                        vec.unplanes(data[16 * n:], np.int64, n)))
        keys, train, every = (np.concatenate(x) for x in zip(*got))
        value = Trie(keys[train > 0], train[train > 0], order, shared.value).log10(keys)
        return pa.table({"keys": pa.array([keys.tobytes()], pa.binary()), "score": pa.array([value.tobytes()], pa.binary()),
                         "everywhere": pa.array([every.tobytes()], pa.binary())})

    return grams.select("keys", "counts", "everywhere").mapInArrow(deal, PACKED).groupBy("bucket").applyInArrow(
        score, "keys binary, score binary, everywhere binary")


class Model:
    """What scoring needs: frequent grams and words, the values of all others by
    bucket, and totals."""

    def __init__(self, leaves, leaf_scores, words, word_counts, values: DataFrame, salts: int, totals: tuple):
        self.leaves, self.leaf_scores, self.words, self.word_counts = leaves, leaf_scores, words, word_counts
        self.values, self.salts = values, salts
        self.tokens, self.distinct, self.texts = totals

    def broadcast(self, spark: SparkSession):
        """Plain arrays: tasks that cannot import this module could not load the classes."""
        table = vars(Table(self.leaves))
        return spark.sparkContext.broadcast((table, self.leaf_scores, self.words, self.word_counts, self.texts))


def _sorted_rows(rows: DataFrame, dtype):
    """Keys in order and their values; the caller bounds their number."""
    got = rows.toArrow()
    keys, value = got.column("key").to_numpy().view(np.uint64), got.column("value").to_numpy().view(dtype)
    order = np.argsort(keys)
    return keys[order], value[order]


def fit(docs: DataFrame, buckets: int, total_bytes: int, order: int = ORDER, hot_leaves: int = HOT_LEAVES) -> Model:
    """The model of the rows ``train`` of ``docs(text, train)``; null texts count as empty ones."""
    counts = cut(corpus_counts(docs, buckets, order))
    words, grams = counts.filter("kind = 0"), counts.filter("kind = 1")
    texts = docs.filter("train").count()
    got = words.agg(F.sum("total"), F.sum("entries")).first()
    often = max(2, total_bytes >> 19)  # 2**18 words at most
    scored = cut(gram_scores(grams, short_contexts(grams, min(SPLIT, order)), order))
    least = _least_count(scored, hot_leaves)
    salts = max(1, -(-24 * max(least, often) // GROUP_BYTES))
    values = _word_values(words, salts).unionAll(_gram_values(scored, least, buckets, salts))
    return Model(*_sorted_rows(_rows(scored, least, "score", "everywhere"), np.float64),
                 *_sorted_rows(_rows(words, often), np.int64), values, salts,
                 (int(got[0] or 0) + texts, int(got[1] or 0) + (texts > 0), texts))


VALUES = "kind long, bucket long, entries long, payload binary"


def _word_values(words: DataFrame, salts: int) -> DataFrame:
    """Payload: hashes, then log10(count + 0.1), by bucket and salt."""
    def run(batches):
        for batch in batches:
            for p, k, c in zip(*batch.columns):
                value = np.log10(np.frombuffer(c.as_buffer(), np.int64) + 0.1)
                keys = np.frombuffer(k.as_buffer(), np.uint64)
                yield _packed([(0, p.as_py() * salts + s, len(keys), keys.tobytes() + value.tobytes()) for s in range(salts)])

    return words.select("bucket", "keys", "counts").mapInArrow(run, VALUES)


def _gram_values(scored: DataFrame, least: int, buckets: int, salts: int) -> DataFrame:
    """Payload: grams that are not broadcast, then their scores, by bucket and salt."""
    def run(batches):
        for batch in batches:
            for k, v, c in zip(*batch.columns):
                cold = np.frombuffer(c.as_buffer(), np.int64) < least
                keys, value = np.frombuffer(k.as_buffer(), np.uint64)[cold], np.frombuffer(v.as_buffer(), np.float64)[cold]
                (keys, value), parts = _by_bucket(_hash_bucket(1, keys, buckets), keys, value)
                yield _packed([(1, p * salts + s, j - i, keys[i:j].tobytes() + value[i:j].tobytes())
                               for p, i, j in parts for s in range(salts)])

    return scored.select("keys", "score", "everywhere").mapInArrow(run, VALUES)


def _text_keys(h, counts):
    """A 64-bit number for the word sequence of each row."""
    row_start = np.repeat(np.cumsum(counts) - counts, counts)
    place = (np.arange(len(h)) - row_start).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(vec.mix(h + place * np.uint64(0x9E3779B97F4A7C15)))])
    end = np.cumsum(counts)
    return vec.mix(sums[end] - sums[end - counts] + counts.astype(np.uint64)).view(np.int64)


def _hot_index(hot, h):
    if not len(hot):
        return np.full(len(h), -1, dtype=np.int64)
    i = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
    return np.where(hot[i] == h, i, -1)


def text_scores(docs: DataFrame, model: Model, order: int = ORDER) -> DataFrame:
    """``docs(id, text, train)`` -> per row: ``id, train, text_key, n_tokens,
    hot_known, hot_sum`` (of the frequent words and the end) and ``hot_score`` (of
    the frequent grams)."""
    shared = model.broadcast(docs.sparkSession)

    def run(batches):
        slots, scores, words, word_counts, texts = shared.value
        table = Table.__new__(Table)
        table.__dict__ = slots
        logs, end_log = np.log10(word_counts + 0.1), math.log10(texts + 0.1)
        for batch in batches:
            out = [[] for _ in range(5)]
            for _, b, s, e, counts, h in _tokens(batch.column(1)):
                rows = len(counts)
                row = np.repeat(np.arange(rows), counts)
                i = _hot_index(words, h)
                hot = i >= 0
                stream, scored, per_row = byte_stream(b, s, e, counts, order)
                leaf = table.find(gram_keys(stream, scored, order))
                lp = np.zeros(len(leaf))
                lp[leaf >= 0] = scores[leaf[leaf >= 0]]
                out[0].append(_text_keys(h, counts))
                out[1].append(counts + 1)
                out[2].append(np.bincount(row[hot], minlength=rows) + (texts > 0))
                out[3].append(np.bincount(row[hot], weights=logs[i[hot]], minlength=rows) + end_log)
                out[4].append(np.add.reduceat(lp, np.cumsum(per_row) - per_row))
            cols = [pa.array(np.concatenate(x)) if x else pa.array([], pa.float64()) for x in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *cols],
                ["id", "train", "text_key", "n_tokens", "hot_known", "hot_sum", "hot_score"])

    return docs.select("id", "text", "train").mapInArrow(
        run, "id long, train boolean, text_key long, n_tokens long, hot_known long, hot_sum double, hot_score double")


def rare_sums(docs: DataFrame, model: Model, buckets: int, order: int = ORDER) -> DataFrame:
    """``text_key, known, log_sum, score`` of the words and grams that are not
    broadcast: packed by bucket, looked up there, and summed for each text."""
    shared, salts = model.broadcast(docs.sparkSession), model.salts
    width = max(WORD_BYTES, order + 1)

    def run(batches):
        slots, _, words, _, _ = shared.value
        table = Table.__new__(Table)
        table.__dict__ = slots
        have, held, sent = {0: [], 1: []}, 0, 0

        def flush():
            for kind in (0, 1):
                if have[kind]:
                    yield _pack_postings(kind, *(np.concatenate(c) for c in zip(*have[kind])), buckets, salts, width)

        for batch in batches:
            for _, b, s, e, counts, h in _tokens(batch.column(0)):
                key, row = _text_keys(h, counts), np.repeat(np.arange(len(counts)), counts)
                first = np.unique(key, return_index=True)[1]  # equal texts of a batch are sent once
                chosen = np.zeros(len(counts), dtype=bool)
                chosen[first] = True
                stream, scored, per_row = byte_stream(b, s, e, counts, order)
                grams, gram_row = gram_keys(stream, scored, order), np.repeat(np.arange(len(counts)), per_row)
                once = chosen[gram_row]
                grams, gram_row = grams[once], gram_row[once]
                cold = table.find(grams) < 0
                once = chosen[row] & (_hot_index(words, h) < 0)
                for kind, token, of in ((0, h[once], row[once]), (1, grams[cold], gram_row[cold])):
                    if not len(token):
                        continue
                    by = np.lexsort((token, of))
                    token, of = token[by], of[by]
                    at = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (of[1:] != of[:-1])]))
                    have[kind].append((token[at], of[at] + sent, np.diff(np.append(at, len(token))), key[of[at]]))
                    held += len(at)
                sent += len(counts)
                if held >= FLUSH:
                    yield from flush()
                    have, held, sent = {0: [], 1: []}, 0, 0
        yield from flush()

    postings = docs.select("text").mapInArrow(run, "kind long, bucket long, entries long, texts long, payload binary")
    sums = postings.groupBy("kind", "bucket").cogroup(model.values.groupBy("kind", "bucket")).applyInArrow(
        _bucket_sums(buckets, width), "bucket long, entries long, payload binary")
    return sums.groupBy("bucket").applyInArrow(_text_sums, "text_key long, known long, log_sum double, score double")


def _pack_postings(kind: int, token, of, tf, key, buckets: int, salts: int, width: int):
    """Payload: key and number of entries of each text, then the entries' frequencies
    and tokens.  The salt is that of the text, so its copies meet."""
    bucket = _hash_bucket(kind, token, buckets) * salts
    if salts > 1:
        bucket += vec.top_bucket(vec.mix(key.view(np.uint64) + np.uint64(7)), salts).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, of, tf, token, key = bucket[order], of[order], tf[order], token[order], key[order]
    new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    at = np.flatnonzero(new)
    first = np.flatnonzero(new | np.concatenate([[True], of[1:] != of[:-1]]))
    sizes = np.diff(np.append(first, len(of))).astype(np.uint32)
    lo, ends = np.searchsorted(first, at), np.append(at[1:], len(of))
    hi = np.append(lo[1:], len(first))
    rows = [vec.planes(key[first[a:b]]) + vec.planes(sizes[a:b]) + vec.planes(tf[x:y].astype(np.uint32))
            + vec.planes(token[x:y], width) for a, b, x, y in zip(lo, hi, at, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(at), kind)), pa.array(bucket[at]), pa.array(ends - at), pa.array(hi - lo),
         pa.array(rows, pa.binary())], ["kind", "bucket", "entries", "texts", "payload"])


def _bucket_sums(buckets: int, width: int):
    """Sums over a bucket's entries of each text.  A word without a value was never
    seen in training; every gram has one."""
    empty = pa.table({"bucket": pa.array([], pa.int64()), "entries": pa.array([], pa.int64()),
                      "payload": pa.array([], pa.binary())})

    def run(postings: pa.Table, values: pa.Table) -> pa.Table:
        if not postings.num_rows:
            return empty
        kind = postings.column("kind")[0].as_py()
        mask = np.uint64((1 << 8 * width) - 1)
        names, value = [np.zeros(0, np.uint64)], [np.zeros(0)]
        for n, payload in zip(values.column("entries").to_pylist(), values.column("payload")):
            data = memoryview(payload.as_buffer())
            names.append(np.frombuffer(data, np.uint64, n) & mask)
            value.append(np.frombuffer(data[8 * n:], np.float64, n))
        names, value = np.concatenate(names), np.concatenate(value)
        order = np.argsort(names, kind="stable")
        names, value = names[order], value[order]
        token, key, tf = [], [], []
        for entries, texts, payload in zip(*(postings.column(c).to_pylist() for c in ("entries", "texts")),
                                           postings.column("payload")):
            data = memoryview(payload.as_buffer())
            size = vec.unplanes(data[8 * texts:], np.uint32, texts)
            key.append(np.repeat(vec.unplanes(data, np.int64, texts), size))
            tf.append(vec.unplanes(data[12 * texts:], np.uint32, entries))
            token.append(vec.unplanes(data[12 * texts + 4 * entries:], np.uint64, entries, width))
        token, key, tf = np.concatenate(token), np.concatenate(key), np.concatenate(tf).astype(np.int64)
        order = np.lexsort((token, key))
        token, key, tf = token[order], key[order], tf[order]
        # a text that several batches sent is summed once
        once = np.concatenate([[True], (token[1:] != token[:-1]) | (key[1:] != key[:-1])])
        token, key, tf = token[once], key[once], tf[once]
        i = _hot_index(names, token)
        each = np.full(len(token), math.log10(0.1))
        each[i >= 0] = value[i[i >= 0]]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        known = np.add.reduceat(tf * (i >= 0), at) if kind == 0 else np.zeros(len(at), np.int64)
        total, none = np.add.reduceat(tf * each, at), np.zeros(len(at))
        words, grams = (total, none) if kind == 0 else (none, total)
        key = key[at]
        (key, known, words, grams), parts = _by_bucket(
            vec.top_bucket(key.view(np.uint64), buckets).astype(np.int64), key, known, words, grams)
        rows = [(p, j - i, vec.planes(key[i:j]) + vec.planes(known[i:j]) + words[i:j].tobytes() + grams[i:j].tobytes())
                for p, i, j in parts]
        bucket, entries, payload = zip(*rows)
        return pa.table({"bucket": pa.array(bucket, pa.int64()), "entries": pa.array([int(n) for n in entries]),
                         "payload": pa.array(payload, pa.binary())})

    return run


def _text_sums(table: pa.Table) -> pa.Table:
    parts = []
    for n, payload in zip(table.column("entries").to_pylist(), table.column("payload")):
        data = memoryview(payload.as_buffer())
        parts.append((vec.unplanes(data, np.int64, n), vec.unplanes(data[8 * n:], np.int64, n),
                      np.frombuffer(data[16 * n:], np.float64, n), np.frombuffer(data[24 * n:], np.float64, n)))
    key, known, total, score = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((score, total, key))  # the same order of sums in every rerun
    key, known, total, score = key[order], known[order], total[order], score[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return pa.table({"text_key": pa.array(key[at]), "known": pa.array(np.add.reduceat(known, at)),
                     "log_sum": pa.array(np.add.reduceat(total, at)), "score": pa.array(np.add.reduceat(score, at))})


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                    order: int = ORDER, hot_leaves: int = HOT_LEAVES) -> DataFrame:
    """One row per input row: ``doc_id, trained, n_tokens, n_known, train_tokens,
    base_score, score``; ``train`` says which rows the model learns from.

    A null text is an empty one: its only token is the end.  Repeated rows count
    as often as they stand there and get equal scores.  Without training rows
    every byte has the probability 1/256 and every token the base probability
    0.1 / 0.1.  Other columns of the input are ignored; an empty table gives an
    empty result."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                      F.coalesce(train, F.lit(False)).alias("train"))
    total = int(src.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = max(8, -(-total // BUCKET_BYTES))
    model = fit(src, buckets, total, order, hot_leaves)
    rare = rare_sums(src, model, buckets, order)
    rows = text_scores(src, model, order)
    norm = math.log10(model.tokens + 0.1 * (model.distinct + 1))
    out = rows.join(rare, "text_key", "left")
    zero = F.lit(0.0)
    return out.select(
        F.col("id").alias("doc_id"), F.col("train").alias("trained"), "n_tokens",
        (F.col("hot_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("log_sum", zero) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("hot_score") + F.coalesce("score", zero)).alias("score"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_documents(docs, fold(F.col("doc_id"), 10) != 0)
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


QUERIES = {"op4_lm_scoring": op4_lm_scoring}
ORACLES: dict[str, str] = {}
