import random

import pytest

from tests.conftest import spark  # noqa: F401  (one session for all tests)

VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti", "vu", "ze") for b in
              ("", "n", "r", "s", "the", "mo", "li", "den", "ga", "x")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


ODD = [None, "", " \n\t ", "one", "Two words", "A" * 30_000, "tab\there\x0bvt", "é\u00a0nbsp\u3000wide 😀"]


@pytest.fixture(scope="session")
def odd_docs(spark):  # noqa: F811
    """Null, empty, blank, short and very long texts, repeated rows, a null id,
    and columns whose names operators use themselves."""
    rng = random.Random(5)
    long = prose(rng, 40_000)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, long), (101, long), (100, long), (None, prose(rng, 80)), (None, None)]
    return spark.createDataFrame(
        [(i, t, "x", None if i == 1 else f"s{(i or 0) % 3}", 7, "clash", 1.5, "h", 3) for i, t in rows],
        "doc_id long, text string, lang string, source string, size long, shard string, score double, host string, node long")


@pytest.fixture(scope="session")
def no_docs(spark):  # noqa: F811
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
