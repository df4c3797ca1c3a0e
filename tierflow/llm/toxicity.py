"""Toxicity by compression distance.

``PAIRS`` pairs of zstandard dictionaries are trained, one of a pair on toxic and one
on ordinary texts.  A document's text is compressed window by window with both; what
the toxic dictionaries save over the ordinary ones, beyond ``FLOOR`` bytes of a pair,
is the text's gain.  The gain is set against the number of windows (mean and variance
of a window of ordinary text), and a monotone table turns it into a score from 0 to 1.
Both are calibrated on labelled rows that did not train the dictionaries.

Training.  zstandard's own trainer gets the whole texts, in pieces of ``PIECE`` bytes,
and chooses the content of a dictionary by what they repeat.  Much of it is ordinary
in both classes, and chance decides which ordinary strings a dictionary of a few
kilobytes holds; one pair's lengths differ by chance more than by class.  So each pair
trains on texts of its own, drawn by the hash of the id (as many of either class): what
most toxic dictionaries hold and few ordinary ones is what the classes differ in, and
chance evens out over the pairs.

A window that the first pairs do not compress better goes no further (``GATES``): its
gain is 0.  Windows are short, so that a word or two decide, and they are compressed
without checksum, size or literal coding, so that lengths differ by matches alone.
Words are compressed in lower case behind a mark of two bytes, which parts them alike
whatever stood between them.

Defined results: null and empty texts have gain 0 and a score like any text without
a match; repeated rows score alike, each with its row; texts of any length are
scored whole, window by window; an empty table gives an empty result; without
labels of both classes every row has the share of toxic labels (0 without any).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import by_value, cut, fold, read

by_value(__name__)

MAX_TRAIN = 2048  # labelled rows of each class that are used to train, at most
PAIRS = 12  # of dictionaries
BAG = 480  # texts of either class that train a dictionary, about; half of the smaller class at most
WORD_BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))  # ASCII letters and digits, other scripts
MARK = b"\x01\x02"  # stands before each word
MIN_MATCH = 5  # bytes
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"  # what zstandard trains begins so
PIECE = 512  # bytes of a sample of the trainer
DICTIONARY_BYTES, PIECE_BYTES, CORE_BYTES = 8192, 8, 6  # of the trainer
CALIBRATION = 4  # one in so many training rows calibrates
FLOOR = 2  # bytes of a pair that a window must gain before its gain counts
GATES = ((1, 2.0), (2, 2.0), (4, 2.0))  # after so many pairs a window must have gained so many bytes of each
WINDOW, STEP = 40, 40  # bytes
THRESHOLD = 0.3


def trained(texts: list) -> bytes:
    """A dictionary that zstandard trains on the pieces of whole texts; the texts
    themselves where they are too few for its trainer."""
    pieces = []
    # in an order that has nothing to do with their content: the trainer picks stretch by stretch
    for text in sorted((marked(t) for t in texts), key=lambda b: (zlib.crc32(b), b)):
        pieces += [text[i:i + PIECE] for i in range(0, len(text), PIECE) if len(text) - i >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, k=PIECE_BYTES, d=CORE_BYTES).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def dictionaries(train: DataFrame, pairs: int = PAIRS, bag: int = BAG) -> tuple[list, list]:
    """``train(_id, text, toxic)`` -> (toxic dictionaries, ordinary ones), one of each
    for a pair; none without texts of both classes.  Each is trained in a task of its
    own from the whole texts that the hash of their id deals to it."""
    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return [], []
    each = max(1.0, min(bag, min(n.values()) / 2))  # texts, about
    share = F.when(F.col("toxic") == 1, F.lit(each / n[1])).otherwise(F.lit(each / n[0]))
    dealt = F.filter(F.sequence(F.lit(0), F.lit(pairs - 1)), lambda k: F.pmod(
        F.xxhash64(F.col("_id").cast("string"), k), F.lit(1_000_003)) < share * 1_000_003)

    def run(table: pa.Table) -> pa.Table:
        raw = trained(table.column("text").to_pylist())
        return pa.table({"toxic": table.column("toxic")[:1], "pair": table.column("pair")[:1],
                         "raw": pa.array([raw], pa.binary())})

    got = (train.select("toxic", "text", F.explode(dealt).alias("pair")).groupBy("toxic", "pair")
           .applyInArrow(run, "toxic int, pair int, raw binary").collect())
    raw = {(r["toxic"], r["pair"]): bytes(r["raw"]) for r in got}
    return [raw.get((1, k), b"") for k in range(pairs)], [raw.get((0, k), b"") for k in range(pairs)]


def marked(text) -> bytes:
    """The words of a text in lower case, each after a mark."""
    return MARK.join([b"", *(text or "").lower().encode().translate(WORD_BYTES).split(), b""])


def compressor(raw: bytes):
    """A compressor with the given dictionary: a trained one, or content only."""
    params = zstandard.ZstdCompressionParameters(
        window_log=15, hash_log=13, chain_log=6, search_log=1, min_match=MIN_MATCH, target_length=1,
        strategy=zstandard.STRATEGY_FAST, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    if not raw.startswith(DICTIONARY_MAGIC):
        raw = raw.rjust(16, b"\0") + b"\0" * 8
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params)


def lengths(packer, text: bytes, spans) -> np.ndarray:
    """The compressed length of each span (start, size) of a text."""
    got = packer.multi_compress_to_buffer(zstandard.BufferWithSegments(text, spans.tobytes()), threads=1)
    return np.fromiter((len(got[i]) for i in range(len(spans))), np.int64, len(spans))


def text_gain(text, toxic, plain, window: int = WINDOW, step: int = STEP, floor: int = 0, gates=()) -> tuple[int, int]:
    """(bytes that the toxic dictionaries save over the ordinary ones, beyond ``floor``
    for each pair of a window; number of windows).  ``toxic``, ``plain``: a compressor
    or one for each pair.  Windows that miss a gate of ``gates`` (pairs, bytes of each)
    gain nothing.  The last window ends with the text."""
    pairs = list(zip(toxic, plain, strict=True)) if isinstance(toxic, list) else [(toxic, plain)]
    b, gates = marked(text), dict(gates)
    total, block, n = 0, step * 8192, max(1, len(b) - window + step)  # windows compressed in one call
    for lo in range(0, n, block):
        start = np.arange(lo, min(lo + block, n), step, dtype=np.uint64)
        spans = np.empty((len(start), 2), dtype=np.uint64)
        spans[:, 0] = start
        spans[:, 1] = np.minimum(window, len(b) - start)
        gain = np.zeros(len(start), dtype=np.int64)
        for k, (a, o) in enumerate(pairs, 1):
            gain += lengths(o, b, spans) - lengths(a, b, spans)
            if k in gates:
                keep = gain >= gates[k] * k
                spans, gain = np.ascontiguousarray(spans[keep]), gain[keep]
                if not len(gain):
                    break
        total += int(np.maximum(gain - floor * len(pairs), 0).sum())
    return total, -(-n // step)


def with_gain(docs: DataFrame, text_col: str, toxic_dicts: list, plain_dicts: list, gain: str = "__gain",
              windows: str = "__windows") -> DataFrame:
    """``docs`` with the gain and the number of windows of every text, computed in
    Arrow tasks."""
    def run(batches):
        toxic, plain = [compressor(d) for d in toxic_dicts], [compressor(d) for d in plain_dicts]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            got = [text_gain(t.as_py(), toxic, plain, floor=FLOOR, gates=GATES) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g for g, _ in got], pa.int64()), pa.array([n for _, n in got], pa.int64())],
                [*batch.schema.names, gain, windows])

    schema = T.StructType([*docs.schema.fields, T.StructField(gain, T.LongType()), T.StructField(windows, T.LongType())])
    return docs.mapInArrow(run, schema)


def excess(gain, windows, mean: float, variance: float, root):
    """The gain beyond that of as many windows of ordinary text, in its deviations."""
    return (gain - mean * windows) / root(variance * windows + 1.0)


def calibrate(rows: list, prior: float) -> list:
    """``rows`` of (excess, weighted toxic rows, weighted rows) -> steps
    ``(least excess, score)``, score not falling (pool adjacent violators), each
    rate smoothed by one row of the prior."""
    pools = []
    for least, a, n in sorted(rows):
        pools.append([least, a, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, a2, n2 = pools.pop()
            pools[-1][1] += a2
            pools[-1][2] += n2
    out, low = [], 0.0
    for least, a, n in pools:
        low = max(low, (a + prior) / (n + 1.0))
        out.append((float(least), float(low)))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_train: int = MAX_TRAIN) -> dict:
    """The model as a small dictionary.  Of the labelled rows it uses at most
    ``max_train`` of each class, those with the lowest hash of the id; one in
    ``CALIBRATION`` of them calibrates, the others train the dictionaries.  The
    shares of the classes in all labelled rows weigh them again.

    Null labels or ids, and ids without a document, are left out; an id that is
    labelled twice is toxic if one of its labels is."""
    lab = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_toxic"))
           .filter(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1))
           .groupBy("_id").agg(F.max("_toxic").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in lab.groupBy("toxic").count().collect()}
    order = F.md5(F.col("_id").cast("string").cast("binary"))
    pick = [lab.filter(F.col("toxic") == t).orderBy(order, "_id").limit(max_train) for t in (0, 1)]
    aside = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(CALIBRATION)) == 0
    chosen = cut(pick[0].unionByName(pick[1]).withColumn("aside", aside))  # at most 2 * max_train ids
    text = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    train = cut(text.join(F.broadcast(chosen), "_id").select("_id", "text", "toxic", "aside"))
    toxic, plain = dictionaries(train.filter(~F.col("aside")))
    n = sum(sizes.values())
    prior = sizes.get(1, 0) / n if n else 0.0
    model = {"toxic": toxic or b"", "plain": plain or b"", "prior": prior, "mean": 0.0, "variance": 0.0,
             "steps": [(float("-inf"), prior)]}
    if not toxic:
        return model
    got = [(r["__gain"], r["__windows"], r["toxic"]) for r in with_gain(
        train.filter("aside"), "text", model["toxic"], model["plain"]).select("__gain", "__windows", "toxic").collect()]
    clean = [(g, k) for g, k, t in got if not t]
    if clean and len(clean) < len(got):
        windows = sum(k for _, k in clean)
        model["mean"] = sum(g for g, _ in clean) / windows
        model["variance"] = sum((g - model["mean"] * k) ** 2 for g, k in clean) / windows
        weight = {1: sizes.get(1, 0) / (len(got) - len(clean)), 0: sizes.get(0, 0) / len(clean)}
        by_excess: dict = {}
        for g, k, t in sorted(got):  # rows of equal excess are one
            e = by_excess.setdefault(round(excess(g, k, model["mean"], model["variance"], math.sqrt), 6), [0.0, 0.0])
            e[0] += weight[t] * t
            e[1] += weight[t]
        model["steps"] = calibrate([(e, a, m) for e, (a, m) in by_excess.items()], prior)
        model["steps"][0] = (float("-inf"), model["steps"][0][1])
    return model


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score", gain: str = "gain") -> DataFrame:
    """``docs`` with ``gain`` (long, bytes) and ``score`` (double).  Columns of the
    input named like the new ones are replaced.  Between two steps of equal score, a
    larger excess still scores a little higher."""
    src = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (gain, out)])
    if model["toxic"]:
        scored = with_gain(src, text_col, model["toxic"], model["plain"], gain, "__windows")
    else:
        scored = src.withColumns({gain: F.lit(0).cast("long"), "__windows": F.lit(0).cast("long")})
    e = excess(F.col(gain), F.col("__windows"), model["mean"], model["variance"], F.sqrt)
    scored = scored.withColumn("__excess", F.round(e, 6))
    steps = F.lit(model["steps"][0][1])
    for least, value in model["steps"][1:]:
        steps = F.when(F.col("__excess") >= least, F.lit(value)).otherwise(steps)
    tie = F.lit(0.5) + F.col("__excess") / (F.abs("__excess") + 10.0) / 2
    return scored.withColumn(out, steps * 0.99 + tie * 0.01).drop("__windows", "__excess")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = fold(F.col("doc_id"), 4) == 2
    model = fit(docs, labels.filter(~held))
    scored = score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLES: dict[str, str] = {}
