"""Small tables for the corpus operators: nulls, blanks, ties, repeated rows,
and columns whose names the operators use themselves."""

from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "_id string, _text int, key string, sid int, n int, kept int, _gone int, _out int")


def frame(spark, rows):
    """``rows``: (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None,
             "x", 1, "k", 2, 3, 4, 5, 6) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng: random.Random, n: int) -> str:
    parts = "an be ca do en fi go hi in jo ka le mo ne or pa qu re st te".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that every operator has to survive."""
    rng = random.Random(3)
    text = prose(rng, 80) + ".\n" + prose(rng, 60) + "."
    return [(1, text), (1, text), (2, None), (3, ""), (4, " \t\n\x0b \r"), (None, text), (None, None),
            (5, "one two three"), (6, prose(rng, 30_000)), (7, "x" * 200_000), (8, text + " more"),
            (9, "\x00 ​ café \U0001f600 中文 ẞ")]
