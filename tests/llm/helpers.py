"""Odd inputs that every operator has to take: nulls, empty and very long texts, repeats, clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (1, None, "en", "s", None), (2, "", "en", None, 0), (None, "an id is missing here today", None, None, 5),
    (3, " \n\t ", "en", "s", 4), (4, "one", "en", "s", 3), (5, "x" * 30_000, "en", "s", 9), (6, "two words", "de", "s", 9),
    (7, "same text twice over", "en", "s", 20), (7, "same text twice over", "en", "s", 20),
    (8, "a<|endoftext|>b  <|endoftext|>\n c", "en", "s", 1), (9, "tabs\tand\r\nlines\x1c and é́ 　x", "fr", "s", 1),
]
CLASHES = ["id", "key", "row", "pos", "leaf", "line", "first", "tokens", "head", "family", "score", "label", "items"]


def odd_documents(spark):
    """The odd rows with further columns whose names the operators use inside."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    for name in CLASHES:
        rows = rows.selectExpr("*", f"'outside' AS {name}")
    return rows


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))
