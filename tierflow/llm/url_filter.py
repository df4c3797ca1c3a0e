"""URL filter: rules on host and path, then a Bloom filter cascade of listed keys.

A url's keys are its host and all parent domains.  The method blocks a url if
one of them is listed.  Membership is exact for every key that occurs in the
corpus (the universe): level 1 of the cascade holds the listed keys; level 2 the
unlisted keys of the universe that level 1 passes by mistake; level 3 the listed
keys that level 2 passes; and so on, until a level passes nothing by mistake.  A
key is listed if the first level that it fails is an even one (counted from 1).
Each level is a few bits for each key that it holds, so the cascade is small
beside the list, and urls are judged in place: no url is shuffled or joined.

A cascade is broadcast only if its levels sum to at most ``max_bytes``.  Beyond
that the keys are split by hash into parts, twice as many until each part's cascade
fits, and the urls pass one part's cascade after the other; between two parts they
are written in the shared folder, so neither the driver nor a worker holds more
than one part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm import vec
from tierflow.llm.common import ascii_lower, by_value, cut, read

by_value(__name__)

MAX_BYTES = 32 << 20
LEAST_BYTES = 1 << 7  # a bound below this could not hold the few levels of one key
RULES = (  # (host, path, verdict)
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Domains whose pages are not wanted: advertising, gambling, spam, adult.
LISTED = tuple(f"{name}.example.{top}" for name in
               ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
               for top in ("com", "net", "org"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple] = RULES) -> Column:
    """The longest rule that fits, as a struct ``rule, verdict``; null if none."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def keys_of(host: Column) -> Column:
    """The host without user and port, and its parent domains of two labels or
    more, each once; none for an empty host."""
    bare = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    every = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                        lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def hashed(key: Column) -> Column:
    """128 bits of a key, as two longs."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2"))


class Level:
    """A Bloom filter: ``bits`` as 64-bit words, ``m`` bits, ``k`` hashes."""

    def __init__(self, number: int, m: int, k: int, words):
        self.number, self.m, self.k, self.words = number, m, k, words

    @staticmethod
    def positions(number, m, k, h1, h2):
        a = vec.mix(h1.view(np.uint64) + np.uint64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        b = vec.mix(h2.view(np.uint64) ^ np.uint64(number * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) | np.uint64(1)
        return [(a + np.uint64(i) * b) % np.uint64(m) for i in range(k)]

    def holds(self, h1, h2):
        out = np.ones(len(h1), dtype=bool)
        for p in self.positions(self.number, self.m, self.k, h1, h2):
            out &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def listed(levels: list, h1, h2):
    """Membership of keys of the universe."""
    out, undecided = np.zeros(len(h1), dtype=bool), np.ones(len(h1), dtype=bool)
    for level in levels:
        inside = np.zeros(len(h1), dtype=bool)
        inside[undecided] = level.holds(h1[undecided], h2[undecided])
        # odd levels hold listed keys: failing one means unlisted, failing an even one listed
        if level.number % 2 == 0:
            out |= undecided & ~inside
        undecided &= inside
    if levels and levels[-1].number % 2:
        out |= undecided
    return out


def _size(n: int, rate: float) -> tuple[int, int]:
    m = max(64, math.ceil(n * -math.log(rate) / math.log(2) ** 2))
    return -(-m // 64) * 64, max(1, round(m / max(1, n) * math.log(2)))


def _fill(keys: DataFrame, number: int, m: int, k: int) -> Level:
    def run(batches):
        for batch in batches:
            h1, h2 = (np.asarray(batch.column(i)) for i in (0, 1))
            p = np.unique(np.concatenate(Level.positions(number, m, k, h1, h2)))
            word, first = np.unique(p >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), first) if len(p) else p
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))],
                                             ["word", "mask"])

    rows = (keys.select("h1", "h2").mapInArrow(run, "word long, mask long")
            .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())  # m / 64 rows at most
    words = np.zeros(m // 64, dtype=np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return Level(number, m, k, words)


def _passed(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(vars(level))  # plain arrays, as the tasks cannot import the class

    def run(batches):
        here = Level(**shared.value)
        for batch in batches:
            keep = here.holds(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
            yield batch.filter(pa.array(keep))

    return cut(keys.select("h1", "h2").mapInArrow(run, "h1 long, h2 long"))


def build_cascade(inside: DataFrame, outside: DataFrame, max_bytes: int = MAX_BYTES, later: float = 1 / 16):
    """Levels that tell the keys ``inside(h1, h2)`` from ``outside(h1, h2)``
    (distinct and disjoint), or None if they would exceed ``max_bytes``."""
    now, other = inside, outside
    n, n_other, levels, total = now.count(), other.count(), [], 0
    while n:
        rate = min(0.5, max(1e-4, n / max(1, n_other))) if not levels else later
        m, k = _size(n, rate)
        total += m // 8
        if total > max_bytes:
            return None
        level = _fill(now, len(levels) + 1, m, k)
        levels.append(level)
        now, other = _passed(other, level), now
        n, n_other = now.count(), n
    return levels


def _part(keys: DataFrame, part: int, parts: int) -> DataFrame:
    return keys if parts == 1 else keys.filter(F.pmod("h1", F.lit(parts)) == part)


def judge(spark: SparkSession, pages: DataFrame, listed_keys: DataFrame, rules: Sequence[tuple] = RULES,
          url_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` with ``host, path, rule, listed, verdict``.

    ``listed_keys(key)`` are domains in lower case; null and repeated keys are
    ignored.  ``verdict`` is the rule's, else ``block`` if a key of the url is
    listed, else ``allow``.  A url that is null or has no ``://`` has an empty
    host and path, fits no rule and is allowed.  Columns of the input with the
    names of the new ones are replaced.  An empty table gives an empty result,
    repeated rows get equal verdicts."""
    if max_bytes < LEAST_BYTES:
        raise ValueError(f"max_bytes must be {LEAST_BYTES} or more")
    new = ("host", "path", "rule", "listed", "verdict")
    src = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new],
                       host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    keys = F.transform(keys_of(F.col("host")), hashed)
    marks = listed_keys.filter("key IS NOT NULL").select(hashed(F.col("key")).alias("x")).select("x.*").distinct()
    universe = cut(src.select(F.explode(keys).alias("x")).select("x.*").distinct())
    inside = cut(universe.join(marks, ["h1", "h2"], "left_semi"))
    outside = cut(universe.join(marks, ["h1", "h2"], "left_anti"))
    src, parts, part = src.withColumn("listed", F.lit(False)), 1, 0
    out = src
    while part < parts:
        levels = build_cascade(_part(inside, part, parts), _part(outside, part, parts), max_bytes)
        if levels is None:  # the parts are too large: start again with smaller ones
            out, parts, part = src, 2 * parts, 0
            continue
        out = _judge_by_cascade(spark, out, keys, levels, part, parts)
        part += 1
        if part < parts:
            out = cut(out)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    out = out.withColumn("rule", rule)
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).withColumn("rule", F.col("rule.rule"))


def _judge_by_cascade(spark: SparkSession, src: DataFrame, keys: Column, levels: list, part: int,
                      parts: int) -> DataFrame:
    """``src`` with ``listed``, its last column, true also where a key of this part is listed."""
    shared = spark.sparkContext.broadcast([vars(level) for level in levels])  # max_bytes at most
    wide = src.withColumn("__keys", keys)

    def run(batches):
        cascade = [Level(**v) for v in shared.value]
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            flat, counts = col.flatten(), np.diff(np.asarray(col.offsets))
            h1, h2 = np.asarray(flat.field("h1")), np.asarray(flat.field("h2"))
            hit = listed(cascade, h1, h2) & (h1 % parts == part)
            row = np.repeat(np.arange(len(counts)), counts)
            any_hit = np.bincount(row, weights=hit, minlength=len(counts)) > 0
            any_hit |= batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(any_hit)], batch.schema.names[:-1])

    schema = T.StructType([*src.schema.fields[:-1], T.StructField("listed", T.BooleanType())])
    return wide.mapInArrow(run, schema)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.createDataFrame([(k,) for k in LISTED], "key string")
    out = judge(spark, read(spark, sf_dir, "pages").select("page_id", "url"), keys)
    return out.select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    when = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{}}".format(x)
                    for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1])) for x in ["{}"])
    pairs = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule, verdict = when.format(*[f"'{h}{p}'" for h, p, _ in pairs]), when.format(*[f"'{v}'" for _, _, v in pairs])
    keys = ", ".join(f"'{k}'" for k in LISTED)
    return f"""
WITH r AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
k AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM p)
SELECT page_id, host, path, CASE {rule} END AS rule,
       coalesce(CASE {verdict} END, CASE WHEN
         len(list_filter([{keys}], lambda x: bare = x OR ends_with(bare, '.' || x))) > 0
         THEN 'block' ELSE 'allow' END) AS verdict
FROM k
"""


QUERIES = {"op6_url_filter": op6_url_filter}
ORACLES = {"op6_url_filter": _sql()}
