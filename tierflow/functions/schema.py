"""Declared trade types and the typed projection of all-string landing rows."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column order of the landing CSV and the intended type of each column.
TRADE_TYPES_DECLARED: dict[str, str] = {
    "id": "bigint",
    "trade_id": "string",
    "symbol": "string",
    "exchange": "string",
    "price": "decimal(10,4)",
    "quantity": "bigint",
    "timestamp": "timestamp",
    "trade_type": "string",
    "market_center": "string",
    "ingestion_timestamp": "timestamp",
    "file_path": "string",
}

RESCUED = "_rescued_data"


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_json_sql(old: str, new: str) -> str:
    """SQL text concatenating two JSON object strings (either may be NULL);
    keys are disjoint by construction (rescued extras vs. declared columns)."""
    return (f"CASE WHEN {old} IS NULL OR trim({old}) = '{{}}' THEN {new} WHEN {new} IS NULL THEN {old} "
            f"ELSE concat(regexp_replace({old}, '\\\\}}\\\\s*$', ''), ',', "
            f"regexp_replace({new}, '^\\\\s*\\\\{{', '')) END")


def conform(df: DataFrame, types: Mapping[str, str] | None = None, rescued_col: str = RESCUED) -> DataFrame:
    """Cast each declared column with ``try_cast`` (never an implicit cast).

    Text that does not fit its declared type becomes NULL in the typed column
    and is kept verbatim in the rescued JSON column, merged with whatever was
    already rescued at ingest.  Text with more decimal places than its type is
    rounded (half up) in the typed column, and kept verbatim there too.  Column order is preserved; undeclared columns
    stay as they are.  Only plain expressions are used (no lambdas), so the
    projection stays inside whole-stage code generation, and the JSON is
    built only for rows that actually have a value that does not fit."""
    types = dict(types or TRADE_TYPES_DECLARED)
    present = [c for c in df.columns if c in types and types[c] != "string"]
    if not present:
        return df
    typed = {c: f"try_cast({_q(c)} AS {types[c]})" for c in present}
    bad = {c: f"({_q(c)} IS NOT NULL AND {typed[c]} IS NULL)" for c in present}
    for c, kind in df.dtypes:
        fine = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", types[c]) if c in present and kind == "string" else None
        if fine:  # a cast that rounds: compare with the most places that leave room for the whole digits
            wide = f"try_cast({_q(c)} AS decimal(38,{38 - int(fine[1]) + int(fine[2])}))"
            bad[c] = f"({bad[c]} OR {wide} <> {typed[c]})"
    any_bad = " OR ".join(f"coalesce({b}, false)" for b in bad.values())
    fields = ", ".join(f"CASE WHEN coalesce({bad[c]}, false) THEN cast({_q(c)} AS string) END AS {_q(c)}" for c in present)
    new_json = f"CASE WHEN {any_bad} THEN to_json(struct({fields})) END"
    old = _q(rescued_col) if rescued_col in df.columns else "cast(NULL AS string)"
    rescued = f"{merge_json_sql(old, f'({new_json})')} AS {_q(rescued_col)}"
    exprs = []
    for c in df.columns:
        if c == rescued_col:
            exprs.append(rescued)
        elif c in typed:
            exprs.append(f"{typed[c]} AS {_q(c)}")
        else:
            exprs.append(_q(c))
    if rescued_col not in df.columns:
        exprs.append(rescued)
    return df.selectExpr(*exprs)
