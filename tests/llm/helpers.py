"""Small tables for the operators' tests."""

from __future__ import annotations

import random

import pytest

pytest.importorskip("xxhash")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def documents(spark, rows, extra=False):
    """rows of (doc_id, text, source); with extra columns that clash with names used inside."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = "shard string, depth int, bytes long, key long, block long, score double, size long, fp long, label string"
    return spark.createDataFrame(
        [(*r, "s", 1, 2, 3, 4, 0.5, 6, 7, "x") for r in rows], "doc_id long, text string, source string, " + clashing
    )


#: Null and empty texts, a null id, a repeated row, a long text, text beyond ASCII.
ODD = [
    (1, None, "a"),
    (2, "", None),
    (None, "no id here", "a"),
    (3, "same row", "b"),
    (3, "same row", "b"),
    (4, " \n\t ", "b"),
    (5, prose(5, 20_000), "c"),
    (6, "Größe naïve 日本語 \U0001f600", ""),
]
