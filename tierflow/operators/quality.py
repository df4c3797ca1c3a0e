"""Data-quality expectations and quality monitoring tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.exprs import exact_mean, passes, rule_columns


class ExpectationError(RuntimeError):
    """Raised when a fail-on-violation rule set does not hold."""


def _ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def expect_all_or_fail(df: DataFrame, rules: Mapping[str, object], label: str = "expectations") -> DataFrame:
    """Fail-on-violation, evaluated lazily in the same pass that uses the rows.

    Every row must satisfy every rule (NULL counts as a violation).  The first
    violating row aborts the job that evaluates the DataFrame with an error
    naming the failed rules, so a write that consumes it commits nothing.  No
    extra scan, no shuffle, nothing collected."""
    if not rules:
        return df
    if all(isinstance(r, str) for r in rules.values()):
        return df.filter(_fail_filter_sql(rules, label))
    checks = rule_columns(rules)
    all_ok = checks[0][1]
    for _, ok in checks[1:]:
        all_ok = all_ok & ok
    failed = F.concat_ws(", ", *[F.when(~ok, F.lit(name)) for name, ok in checks])
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    message = F.concat(F.lit(f"EXPECTATION_FAILED {label}: rules ["), failed, F.lit("] violated by row "), row)
    return df.filter(F.when(all_ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fail_filter_sql(rules: Mapping[str, str], label: str) -> str:
    """The same check as one SQL predicate (parsed once by Spark)."""
    oks = {name: f"coalesce(({rule}), false)" for name, rule in rules.items()}
    failed = ", ".join(f"CASE WHEN NOT {ok} THEN {_sql_str(name)} END" for name, ok in oks.items())
    msg = (f"concat({_sql_str('EXPECTATION_FAILED ' + label + ': rules [')}, concat_ws(', ', {failed}), "
           f"'] violated by row ', to_json(struct(*)))")
    return f"CASE WHEN {' AND '.join(oks.values())} THEN true ELSE cast(raise_error({msg}) AS boolean) END"


def violation_counts(df: DataFrame, rules: Mapping[str, object]) -> dict[str, int]:
    """Eager form: one aggregate pass counting violations of every rule."""
    checks = rule_columns(rules)
    row = df.agg(*[F.count_if(~ok).alias(f"r{i}") for i, (_, ok) in enumerate(checks)]).first()
    return {name: int(row[f"r{i}"]) for i, (name, _) in enumerate(checks)}


def check_expectations(df: DataFrame, rules: Mapping[str, object], label: str = "expectations") -> None:
    bad = {k: v for k, v in violation_counts(df, rules).items() if v}
    if bad:
        raise ExpectationError(f"{label}: violated rules {bad}")


def quality_score(df: DataFrame, rule="price > 0", by: Sequence[str] = ()) -> DataFrame:
    """Total rows, rows satisfying ``rule`` and their ratio (NULL on no rows)."""
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.count_if(passes(rule)).alias("valid_rows")]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return out.withColumn("quality_score", _ratio(F.col("valid_rows"), F.col("total_rows")))


def rule_compliance(df: DataFrame, rules: Mapping[str, object], by: Sequence[str] = ("exchange",)) -> DataFrame:
    """Per group and rule: rows, passed, failed and pass rate.

    All rules are evaluated in one aggregate pass (partial aggregation on the
    map side, so a hot group costs one row per task before the shuffle); the
    wide result is turned long afterwards, on the already-aggregated rows."""
    checks = rule_columns(rules)
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               *[F.count_if(ok).alias(f"_p{i}") for i, (_, ok) in enumerate(checks)])
    return compliance_of(wide, [name for name, _ in checks], by)


def compliance_of(wide: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long form of ``rows, _p0, _p1 ...``: passed rows by rule."""
    entries = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_p{i}").alias("passed"))
                        for i, name in enumerate(names)])
    long = wide.select(*by, "rows", F.inline(entries))
    return long.select(*by, "rule", "rows", "passed",
                       (F.col("rows") - F.col("passed")).alias("failed"),
                       _ratio(F.col("passed"), F.col("rows")).alias("pass_rate"))


def completeness(df: DataFrame, by: Sequence[str] = ("exchange",), columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and null rate per group and column, in one aggregate pass."""
    cols = [c for c in (columns or df.columns) if c not in by]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(cols)])
    return completeness_of(wide, cols, by)


def completeness_of(wide: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long form of ``rows, _n0, _n1 ...``: values that are not null, by column."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null"))
                        for i, c in enumerate(columns)])
    long = wide.select(*by, "rows", F.inline(entries))
    nulls = F.col("rows") - F.col("non_null")
    return long.select(*by, "column_name", "rows", nulls.alias("nulls"), _ratio(nulls, F.col("rows")).alias("null_rate"))


def drift(df: DataFrame, by: Sequence[str] = ("exchange",), ts: str = "timestamp", value: str = "price",
          unit: str = "month") -> DataFrame:
    """Per group and time bucket: rows, null rate, mean and standard deviation of
    ``value``, and the change of the mean against the previous bucket.

    The aggregate is partial+final; ``lag`` runs over the (small) per-bucket
    result, partitioned by group."""
    bucket = F.date_trunc(unit, F.col(ts))
    if dict(df.dtypes).get(ts) == "timestamp_ntz":
        bucket = bucket.cast("timestamp_ntz")
    v = F.col(value)
    is_dec = dict(df.dtypes).get(value, "").startswith("decimal")
    # decimals: exact, order-independent sum and exact mean; else double
    total = F.sum(v) if is_dec else F.sum(v.cast("double"))
    agg = df.groupBy(*by, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("_nn"),
        total.alias("_sum"),
        F.stddev_samp(v.cast("double")).alias("_sd"),
    )
    mean = (exact_mean(F.col("_sum"), F.col("_nn"), 4) if is_dec else
            F.round(F.col("_sum") / F.nullif(F.col("_nn"), F.lit(0)), 4).cast("decimal(20,4)"))
    w = Window.partitionBy(*by).orderBy("bucket")
    per = agg.select(*by, "bucket", "rows",
                     _ratio(F.col("rows") - F.col("_nn"), F.col("rows")).alias("null_rate"),
                     mean.alias("mean_value"),
                     F.round(F.col("_sd"), 4).cast("decimal(20,4)").alias("stddev_value"))
    prev = F.lag("mean_value").over(w)
    return per.select("*", prev.alias("prev_mean_value"),
                      (F.col("mean_value") - prev).cast("decimal(20,4)").alias("mean_change"))


def alerts(compliance: DataFrame, threshold: float, by: Sequence[str] = ("exchange",),
           per_group: Mapping[str, float] | None = None) -> DataFrame:
    """(group, rule) pairs whose pass rate is below their threshold: that of
    their group (a value of the first ``by`` column) in ``per_group``, else
    ``threshold``."""
    limit = F.lit(float(threshold))
    for group, own in (per_group or {}).items():
        limit = F.when(F.col(by[0]) == group, F.lit(float(own))).otherwise(limit)
    return (compliance.withColumn("threshold", limit).filter(F.col("pass_rate") < F.col("threshold"))
            .select(*by, "rule", "rows", "failed", "pass_rate", "threshold"))
