"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from tierflow.llm import (decontamination, hard_negatives, license_scan, mixing, ngram_join, passage_chains, ppm,
                           quality_rules, secret_scan, sharding, toxicity, url_filter, whitening)

MODULES = (ngram_join, quality_rules, decontamination, ppm, sharding, url_filter, toxicity, passage_chains, mixing,
           license_scan, secret_scan, whitening, hard_negatives)


def queries() -> dict[str, Callable]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
