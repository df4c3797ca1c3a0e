"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size in words.  All sources share a budget of
words in proportion to their weights, but none gets more than ``max_epochs``
times its size; what a clamped source cannot take is dealt to the others by
weight until no source is above its cap.  The fixed point of that loop is found
in one pass: in order of cap per weight, the clamped sources are a prefix, so a
running sum over the (small) table of sources gives the level at which the
rest share.  Only DataFrame functions are used.

A source with target t and size s takes every document floor(t/s) times, and
part of the documents once more: documents are put in the order of a seeded
hash, and those whose running size stays within the rest are taken.  That order
is cut by hash ranges first: sums of ranges (map-side combined) show the one
range in which the cut falls, and only the rows of that range are put in order.
So a source with a third of all rows is never sorted by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import WORD, cut, read

WEIGHTS = (5, 2, 1)  # by order of the sources, repeating
BUDGET = 1.5  # words to take, in sizes of the whole input
MAX_EPOCHS = 2.0
SEED = 17
MAX_BROADCAST = 10_000  # sources: 16 rows of some 100 bytes each, 16 MB
RANGE_DIGITS = 3  # hex digits of a key that name its range: 4,096 ranges in a source


def _seeded(id_col: Column, seed: int) -> Column:
    return F.md5(F.encode(F.concat_ws("/", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit(""))), "UTF-8"))


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sized(source, size)`` -> ``source, source_size, weight, target``, one
    row per source.  Sources in order of code points (UTF-8 bytes), null last,
    take the weights in turn.  A source without words has target 0."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = Window.partitionBy(F.lit(0))  # one row per source, not per document
    ranked = per.withColumn("rank", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    caps = (ranked.withColumn("weight", w)
            .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
            .withColumn("all_words", F.sum("source_size").over(one) * F.lit(float(budget))))
    level = one.orderBy(F.col("cap") / F.col("weight"), "rank")
    below = level.rowsBetween(Window.unboundedPreceding, -1)
    caps = (caps.withColumn("cap_below", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
            .withColumn("weight_left", F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))))
    # the level if all sources before this one are clamped and none from here on
    caps = caps.withColumn("share", (F.col("all_words") - F.col("cap_below")) / F.col("weight_left"))
    caps = caps.withColumn("free", F.col("share") * F.col("weight") <= F.col("cap"))
    first = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("share")))).over(one)
    caps = caps.withColumn("water", first["share"])
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("water") * F.col("weight")))
    return caps.select("source", "source_size", "weight", target.alias("target"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       size.alias("size"), _seeded(F.col(f"`{id_col}`"), seed).alias("key"))


def mix_plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
             max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sized(source, size, key)`` -> one row per source: ``source, source_size,
    target, whole`` (copies of every document) and ``last_key``: documents with
    a key up to it are taken once more (null: none)."""
    ranged = sized.select("source", "size", "key", F.substring("key", 1, RANGE_DIGITS).alias("range"))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(sums.select("source", F.col("range_size").alias("size")), weights, budget, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = (targets.withColumn("whole", whole.cast("long"))
               .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
               .withColumnRenamed("source", "__mix_s"))
    # the range of keys in which the rest runs out
    upto = Window.partitionBy("source").orderBy("range")
    ends = sums.withColumn("range_end", F.sum("range_size").over(upto))
    ends = ends.join(targets.select("__mix_s", "rest"), F.col("source").eqNullSafe(F.col("__mix_s")))
    cuts = (ends.filter(F.col("range_end") > F.col("rest")).groupBy("__mix_s", "rest")
            .agg(F.min("range").alias("cut"),
                 F.min_by(F.col("range_end") - F.col("range_size"), "range").alias("before")))
    # only its rows are put in order
    rows = ranged.join(cuts, F.col("source").eqNullSafe(F.col("__mix_s")) & (F.col("range") == F.col("cut")))
    order = Window.partitionBy("__mix_s").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    taken = (rows.withColumn("running", F.col("before") + F.sum("size").over(order))
             .filter(F.col("running") <= F.col("rest")).groupBy("__mix_s").agg(F.max("key").alias("in_cut")))
    plan = (targets.alias("t").join(cuts.alias("c"), F.col("t.__mix_s").eqNullSafe(F.col("c.__mix_s")), "left")
            .join(taken.alias("k"), F.col("t.__mix_s").eqNullSafe(F.col("k.__mix_s")), "left"))
    # "g" is after every hex digit: no cut means that the rest takes everything
    last = F.coalesce(F.col("in_cut"), F.col("cut"), F.lit("g"))
    return plan.select(F.col("t.__mix_s").alias("source"), "source_size", "target", "whole", last.alias("last_key"))


def _salt(key: Column) -> Column:
    return F.substring(key, -1, 1)


def _salted(plan: DataFrame) -> DataFrame:
    """Each source once for each salt.  Up to ``MAX_BROADCAST`` sources are
    broadcast; beyond that, a join on source and salt deals a source with a third
    of all rows to several tasks."""
    plan = cut(plan)
    few = plan.count() <= MAX_BROADCAST
    plan = plan.withColumn("__mix_salt", F.explode(F.array(*[F.lit(x) for x in "0123456789abcdef"])))
    return F.broadcast(plan) if few else plan


def _copies() -> Column:
    more = (F.col("size") > 0) & (F.col("key") <= F.col("last_key"))
    return F.col("whole") + F.when(more, 1).otherwise(0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target,
    copies, taken``; ``copies`` is how often the mix takes the document and
    ``taken = copies * size``.

    Null texts have size 0 and are taken by no fractional copy; null sources
    are a source of their own.  Rows of a source with the same id have the same
    place in its order: they are taken together or not at all.  A source's taken
    words fall short of its target by less than its largest such group.  Reruns
    agree: the order depends on the ids and the seed alone.  An empty table
    gives an empty result; other columns of the input are ignored."""
    sized = cut(_sized(docs, id_col, text_col, source_col, seed))  # read three times, without the texts
    plan = _salted(mix_plan(sized, weights, budget, max_epochs).withColumnRenamed("source", "__mix_s"))
    on = F.col("source").eqNullSafe(F.col("__mix_s")) & (_salt(F.col("key")) == F.col("__mix_salt"))
    out = sized.join(plan, on, "left").withColumn("copies", _copies())
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS,
                    seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it.
    Texts meet only the table of sources; they are shuffled only if that is too
    large to broadcast."""
    sized = cut(_sized(docs, id_col, text_col, source_col, seed))
    plan = _salted(mix_plan(sized, weights, budget, max_epochs).select(
        F.col("source").alias("__mix_s"), F.col("whole").alias("__mix_whole"), F.col("last_key").alias("__mix_last")))
    source = F.col(f"`{source_col}`")
    has_word = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(WORD)
    more = has_word & (_seeded(F.col(f"`{id_col}`"), seed) <= F.col("__mix_last"))
    copies = (F.col("__mix_whole") + F.when(more, 1).otherwise(0)).cast("int")
    key = _seeded(F.col(f"`{id_col}`"), seed)
    out = docs.join(plan, source.eqNullSafe(F.col("__mix_s")) & (_salt(key) == F.col("__mix_salt")))
    return (out.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))))
            .filter(F.col("__mix_copy") <= copies).select(*[F.col(f"`{c}`") for c in docs.columns]))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).drop("source", "copies")


OP9_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}/' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM per),
caps AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN {WEIGHTS[0]}::DOUBLE WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight,
         source_size * {MAX_EPOCHS}::DOUBLE AS cap, sum(source_size) OVER () * {BUDGET}::DOUBLE AS all_words
  FROM ranked),
run AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS cap_below, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM caps WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (SELECT *, (all_words - cap_below) / weight_left AS share FROM run),
water AS (SELECT arg_min(share, (cap / weight, rank)) AS water FROM shares WHERE share * weight <= cap),
plan AS (
  SELECT source, source_size,
         CASE WHEN water IS NULL THEN cap ELSE least(cap, water * weight) END AS target
  FROM shares CROSS JOIN water),
plan2 AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM plan),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM sized s JOIN plan2 p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN size > 0 AND running <= rest THEN 1 ELSE 0 END) * size AS taken
FROM placed
"""

QUERIES = {"op9_mixing": op9_mixing}
ORACLES = {"op9_mixing": OP9_SQL}
