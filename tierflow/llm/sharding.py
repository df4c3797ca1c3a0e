"""Shard placement by a permutation-filled lookup table.

Each shard has a permutation of the slots of a prime-sized table (offset and
skip from hashes of its name).  Shards take turns claiming their next free
slot in that order until the table is full.  Slots differ by at most one
between shards of equal weight, and adding or removing a shard moves few keys.
The table is bounded by its size parameter, so it is broadcast; a key is
placed with one hash and one lookup, without a shuffle of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import read

TABLE_SIZE = 65_537  # prime; over 100 slots for each shard
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
MAX_TABLE = 1_000_003  # largest table that is broadcast: 16 MB


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n ** 0.5) + 1))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of its shard.  Shards are taken in sorted order of their
    names, so the table does not depend on the order in which they are given."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if not _is_prime(size) or size < len(shards) or size > MAX_TABLE:
        raise ValueError(f"the table size must be a prime from the number of shards to {MAX_TABLE}")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [_hash(f"{s}/offset") % size for s in shards]
    skip = [_hash(f"{s}/skip") % (size - 1) + 1 for s in shards] if size > 2 else [1] * len(shards)
    table, filled = [-1] * size, 0
    while True:
        for i in order:
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            filled += 1
            if filled == size:
                return table


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key: md5 of its text, so that any engine finds the same slot.
    A null key has the slot of the empty text."""
    digest = F.md5(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size


def assign_shards(spark: SparkSession, docs: DataFrame, key_col: str = "doc_id", shards: Sequence[str] = SHARDS,
                  size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``docs`` with the columns ``slot`` (long) and ``shard`` (string).

    Rows with equal keys, repeated rows too, go to the same shard; null keys
    share one.  An empty table gives an empty result.  Columns of the input
    named like the new ones are replaced."""
    table = lookup_table(shards, size)
    place = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], f"`{slot}` long, `{shard}` string")
    keep = [c for c in docs.columns if c not in (slot, shard)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], slot_of(F.col(f"`{key_col}`"), size).alias(slot))
    # at most MAX_TABLE rows of two columns, whatever the input
    return src.join(F.broadcast(place), slot, "left").select(*[F.col(f"`{c}`") for c in keep], slot, shard)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return assign_shards(spark, docs)


QUERIES = {"op5_sharding": op5_sharding}
ORACLES: dict[str, str] = {}
