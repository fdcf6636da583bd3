from __future__ import annotations

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows, a hot text."""
    base, passage = prose(1, 80), prose(2, 60)
    near = base.split()
    near[7] = "changed"
    rows = [
        (1, base, "en", "a"),
        (2, base, None, "a"),
        (3, base.replace(" ", "\t\n", 3), "en", None),
        (4, " ".join(near), "en", "b"),
        (5, None, "en", "a"),
        (6, "", "en", "a"),
        (7, " \n\t ", None, None),
        (8, "one two three", "de", "b"),
        (9, "One TWO three", "de", "b"),
        (10, prose(3, 30) + " " + passage + " " + prose(4, 40), "en", "a"),
        (11, prose(5, 50) + "\n" + passage, "en", "c"),
        (12, "x" * 3000, "en", "a"),
        (13, prose(6, 4000), "en", "a"),
        (13, prose(6, 4000), "en", "a"),
        (None, base, "en", "a"),
        (None, prose(7, 40), "en", "a"),
        (14, "É ß 漢字 \U0001f600 naïve\r\nline\x0btab", "fr", "a"),
        (15, "abab" * 120, "en", "a"),
    ]
    return rows + [(k, base, "en", "hot") for k in range(100, 140)]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    """The edge rows in several partitions, with extra columns whose names operators use themselves."""
    frame = spark.createDataFrame(edge_rows(), SCHEMA).repartition(5)
    extra = "0 AS id, 'x' AS digest, 1 AS chunk, 2 AS copies, 3 AS run, 'y' AS form, 4 AS n, 5 AS line, 6 AS shard"
    return frame.selectExpr("*", *extra.split(", "))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
