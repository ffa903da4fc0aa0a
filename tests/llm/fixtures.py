"""Small tables for the operators: nulls, empty and long texts, repeated rows, clashing column names."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
CLASHES = "'x' AS row, 1 AS score, 2 AS kept, 3 AS h, 4 AS k, 5 AS _s, 6 AS spans, 7 AS base, 8 AS rep, 9 AS key, 10 AS length"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def documents(spark, rows, extra: bool = True):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS LONG) AS n_chars")
    return frame.selectExpr("*", *CLASHES.split(", ")) if extra else frame


def mixed_rows(seed: int = 3, n: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(k, sentence(rng, rng.randint(1, 120))) for k in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, sentence(rng, 9000)), (None, "no id here at all"), (None, None)]
    rows += [(n + 4, "same row twice")] * 2 + [(n + 5, rows[0][1]), (n + 6, rows[0][1] + " tail")]
    rows += [(n + 7, "Crème <|endoftext|> brûlée 日本語 we'll 😀  x"), (n + 8, "A\x0bB\x0cC\x85D\xa0E")]
    return rows
