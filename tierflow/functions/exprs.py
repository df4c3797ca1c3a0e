"""Scalar expressions shared by operators.  Everything here returns a Spark
``Column`` built from ``pyspark.sql.functions``; nothing runs in Python per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_column(rule) -> Column:
    """A quality rule given as SQL text or as a callable returning a Column."""
    if isinstance(rule, Column):
        return rule
    if callable(rule):
        return rule()
    return F.expr(rule)


def passes(rule) -> Column:
    """TRUE only when the rule is TRUE; NULL (e.g. a NULL price) is a failure."""
    return F.coalesce(rule_column(rule), F.lit(False))


def rule_columns(rules: Mapping[str, object]) -> list[tuple[str, Column]]:
    return [(name, passes(r)) for name, r in rules.items()]


def unit_hash(seed: int, *cols: Column | str, salt: str = "") -> Column:
    """Deterministic uniform double in [0, 1) from a row key.

    Independent of partitioning and re-execution (unlike ``rand()``), so a
    regenerated partition after an executor loss yields the same rows."""
    h = F.xxhash64(F.lit(seed), F.lit(salt), *[F.col(c) if isinstance(c, str) else c for c in cols])
    return F.pmod(h, F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def pick(values: Sequence[str], u: Column) -> Column:
    """Choose one of ``values`` by a uniform [0,1) column."""
    arr = F.array(*[F.lit(v) for v in values])
    idx = (F.floor(u * F.lit(len(values))).cast("int") + F.lit(1))
    return F.element_at(arr, idx)


def price_bucket(price: Column | str = "price") -> Column:
    """HIGH above 100, MEDIUM above 50, else LOW (documented CASE template)."""
    p = F.col(price) if isinstance(price, str) else price
    return F.when(p > 100, "HIGH").when(p > 50, "MEDIUM").otherwise("LOW")


def in_market_hours(ts: Column | str = "timestamp") -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.hour(t) >= 9) & (F.hour(t) < 16)


def as_of_column(as_of) -> Column:
    """``None`` -> ``current_timestamp()`` (one value per query / micro-batch);
    a Column or a SQL literal string is used as given, so tests can pin it."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.expr(str(as_of))



def exact_mean(total: Column, n: Column, scale: int = 4) -> Column:
    """``total / n`` rounded half toward +infinity to ``scale`` places, computed
    in exact integer arithmetic (``total`` is an exact decimal sum with at most
    ``scale`` places, ``n`` a positive count).  No binary floating point, so
    the result never depends on summation order or on how a half is rounded."""
    unit = 10 ** scale
    s = (total * F.lit(unit)).cast("decimal(38,0)")
    num = s * F.lit(2) + n.cast("decimal(38,0)")
    den = (n * F.lit(2)).cast("decimal(38,0)")
    q = ((num - F.pmod(num, den)) / den).cast("decimal(38,0)")
    # q is exact; shifting the decimal point back is exact too
    mean = q.cast(f"decimal(38,{scale})") / F.lit(unit).cast("decimal(38,0)")
    return F.when(n > 0, mean.cast(f"decimal(20,{scale})"))
