"""Projections, SQL templating and tier unions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.exprs import as_of_column

TABLE_PLACEHOLDER = "__TABLE__"


def stamp(df: DataFrame, name: str, as_of=None) -> DataFrame:
    """Add (or replace in place) a processing-time column."""
    return df.withColumn(name, as_of_column(as_of))


def tag(df: DataFrame, **consts) -> DataFrame:
    """Add constant columns (strings, booleans, numbers)."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()}) if consts else df


def apply_sql_template(spark: SparkSession, df: DataFrame, sql: str, view_name: str,
                       placeholder: str = TABLE_PLACEHOLDER) -> DataFrame:
    """Bind ``df`` as a temporary view and run the template against it.

    The placeholder is replaced by the back-quoted view name, so the template
    is plain Spark SQL; Catalyst sees one plan (scan -> project), no shuffle."""
    df.createOrReplaceTempView(view_name)
    return spark.sql(sql.replace(placeholder, f"`{view_name}`"))


def union_tier(tables: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of one tier's tables, matched by column name.

    Duplicates are kept.  A source whose schema drifted contributes NULLs for
    columns it lacks instead of failing or silently mis-aligning."""
    if not tables:
        raise ValueError("union_tier needs at least one table")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


# Physical operators that handle each row by itself; a template with any other
# one is not row-wise.
ROW_WISE = {"AdaptiveSparkPlan", "Project", "Filter", "Generate", "ColumnarToRow", "FileScan", "Scan", "BatchScan",
            "LocalTableScan"}


def is_row_wise(spark: SparkSession, df: DataFrame, sql: str, view_name: str,
                placeholder: str = TABLE_PLACEHOLDER) -> bool:
    """True when the template maps each input row independently (projection /
    filter / generator only), so applying it per micro-batch and appending
    gives the same rows as applying it to the whole table.  Decided from the
    operators of the physical plan that Spark prints for the template (SQL
    ``EXPLAIN``): all must be on the list of row-wise ones.  A template with a
    non-deterministic expression (an id, a random number) is never row-wise."""
    df.createOrReplaceTempView(view_name)
    plan = spark.sql("EXPLAIN " + sql.replace(placeholder, f"`{view_name}`")).first()[0]
    body = plan.split("== Physical Plan ==")[-1].strip()
    nodes = re.findall(r"^[\s:+|-]*(?:\*\(\d+\)\s*)?(\w+)", body, re.M)
    query = spark.sql(sql.replace(placeholder, f"`{view_name}`"))
    return set(nodes) <= ROW_WISE and bool(query._jdf.queryExecution().analyzed().deterministic())
