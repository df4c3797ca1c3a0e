"""Quality rules: a threshold table compiled into one projection.

Each rule names a measure of the text and the range it must lie in.  All
measures and all rules are one chain of Spark projections over the documents
(no user functions, no shuffle, no second scan); the verdict and the names of
the broken rules come out of the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import WORD, read, words


class Rule(NamedTuple):
    """``numerator / denominator`` must lie in [least, most]; null: no limit.
    A measure whose denominator is 0 breaks no rule."""

    name: str
    numerator: str
    denominator: str | None
    least: float | None
    most: float | None


SYMBOLS = "#*$%&|<>"
# Stop words of English, German, French and Spanish; also taken with a capital.
STOP_WORDS = (
    "the of and to in is that it for as with was on are by this be at or from not "
    "der die das und ist nicht ein eine zu den mit sich des auf für im dem von "
    "le la les et une est que qui dans pour pas sur du au avec "
    "el los las en por con no se su para es como más lo del y").split()
RULES = (
    Rule("too_short", "n_words", None, 50, None),
    Rule("too_long", "n_words", None, None, 1_000_000),
    Rule("word_length", "word_chars", "n_words", 2.5, 10.5),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations", "n_exclaims", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.06, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
)
BASE = ("too_short", "repeated_words")


def _chars_removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, "[" + chars + "]+", ""))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more: their positions in
    order; each adds the words that the one before did not cover."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        n = F.size(s) - 1
        both = F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n),
                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(both)))

    def covered(p: Column) -> Column:
        n = F.size(p)
        before = F.concat(F.array(F.lit(-3)), F.slice(p, F.lit(1), n - 1))
        return F.aggregate(F.zip_with(p, before, lambda a, b: F.least(a - b, F.lit(3))), F.lit(0), lambda acc, x: acc + x)

    def bind(value: Column, body) -> Column:  # evaluates value once
        return F.element_at(F.transform(F.array(value), body), 1)

    found = bind(bind(pairs, positions), covered)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(found)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the measures of each text (all long).

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_exclaims``, ``n_stop_words``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (lines equal to an earlier line), ``n_repeat_words`` (words
    in 3-word windows that occur at least twice).  A null text counts as empty;
    an empty text has 0 everywhere.  Every row is measured by itself: repeated rows
    and equal or null ids keep their rows, an empty table gives an empty result.
    A kept column named like a new one gives way to it."""
    keep = [c for c in keep if c not in (*MEASURES, "broken_rules", "kept")]
    kept = [F.col(f"`{c}`").alias(f"__keep_{i}") for i, c in enumerate(keep)]
    names = [f"__keep_{i}" for i in range(len(keep))]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.select(*kept, text.alias("t"))
    d = d.select(*names, "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    d = d.select("*", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    n = F.size("h") - 2
    two = F.zip_with(F.slice("h", F.lit(1), n), F.slice("h", F.lit(2), n), lambda a, b: F.xxhash64(a, b))
    three = F.zip_with(two, F.slice("h", F.lit(3), n), lambda a, b: F.xxhash64(a, b))
    d = d.select("*", F.when(n > 0, three).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    stop = sorted(set(STOP_WORDS) | {x.capitalize() for x in STOP_WORDS})
    columns = {
        "n_words": F.size("w"),
        "word_chars": F.length(F.array_join("w", "")),
        "n_symbols": _chars_removed(F.col("t"), SYMBOLS),
        "n_exclaims": _chars_removed(F.col("t"), "!"),
        "n_stop_words": F.size(F.filter("w", lambda x: x.isin(stop))),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(F.col("windows")),
    }
    return d.select(*[F.col(x).alias(c) for x, c in zip(names, keep)],
                    *[e.cast("long").alias(c) for c, e in columns.items()])


def broken(rules: Sequence[Rule] = RULES) -> Column:
    """The names of the rules that a row of ``measures`` breaks, in order."""
    def test(r: Rule) -> Column:
        top, bottom = F.col(r.numerator), F.lit(1) if r.denominator is None else F.col(r.denominator)
        out = F.lit(False)
        if r.least is not None:
            out = out | (top < F.lit(float(r.least)) * bottom)
        if r.most is not None:
            out = out | (top > F.lit(float(r.most)) * bottom)
        return F.when(out, F.lit(r.name))

    return F.array_compact(F.array(*[test(r) for r in rules]))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``measures`` with ``broken_rules`` (array of names) and ``kept``."""
    return measures(docs, text_col, keep).withColumn("broken_rules", broken(rules)).withColumn(
        "kept", F.size("broken_rules") == 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.arrays_overlap("broken_rules", F.array(*[F.lit(x) for x in BASE]))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept")


def _sql() -> str:
    test = []
    for r in RULES:
        bottom = r.denominator or "1"
        if r.least is not None:
            test.append(f"{r.numerator} < {float(r.least)}::DOUBLE * {bottom}")
        if r.most is not None:
            test.append(f"{r.numerator} > {float(r.most)}::DOUBLE * {bottom}")
    stop = ", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS) | {x.capitalize() for x in STOP_WORDS}))
    return f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
g AS (SELECT *, list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) AS g FROM w),
p AS (SELECT doc_id, unnest(g) AS x, unnest(range(1, len(w) - 1)) AS i FROM g),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM p) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM r) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_exclaims,
         len(list_filter(w.w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT ({' OR '.join(test)}) AS kept
FROM m
"""


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLES = {"op2_quality_rules": _sql()}
