"""Small tables with the odd cases every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, `set_id` string, `a.b` int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text, source); further columns clash with names the operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), 0.5, 1, "x", 3) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_rows() -> list[tuple]:
    base = prose(1, 60).split()
    near = [*base]
    near[30] = "changed"
    far = base[:30] + prose(2, 30).split()
    return [
        (1, " ".join(base), "b"),
        (2, " ".join(base), "a"),  # an exact copy
        (3, " ".join(near), None),  # a near copy
        (4, " ".join(far), "a"),
        (5, None, "a"),
        (6, "", None),
        (7, " \n\t ", "b"),
        (8, "three little words", "a"),
        (9, "Three LITTLE words", "c"),
        (9, "Three LITTLE words", "c"),  # a repeated row
        (None, "no id at all, but words enough for a set", "a"),
        (None, None, None),
        (10, prose(3, 30_000), "a"),
        (11, prose(3, 30_000).upper(), "a"),
        (12, "x" * 300_000, "b"),
        (13, "é中 \U0001f642 \x00 odd   signs", "é"),
    ]
