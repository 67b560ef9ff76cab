"""Rows that any text operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0d]+")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("kept", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("key", T.LongType()), T.StructField("forms", T.StringType()),
])


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ke", "lo", "mi", "nu", "ta", "ri", "so"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def texts() -> list[tuple]:
    base = prose(1, 200)
    near = base.replace(base.split()[100], "changed", 1)
    long_ = "\n".join(prose(s, 40) for s in range(500))  # 20,000 words
    rows = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one"), (9, "a b c d"), (10, long_),
        (11, long_ + " tail"), (12, prose(2, 80)), (13, "é ß 日本 \U0001F600 " * 30), (None, prose(3, 60)), (None, None), (12, prose(2, 80)),
        (14, "LINE\nLINE\n\nline\n  \nLINE"), (15, "x" * 20_000), (16, prose(4, 60) + "  two  blanks ▁ own"), (17, "THE THE THE THE THE"),
    ]
    return [(i, t, "en" if k % 2 else None, "s" if k % 3 else None, k, "kept", "spans", k, None) for k, (i, t) in enumerate(rows)]


def tricky(spark):
    return spark.createDataFrame(texts(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t: str | None) -> str:
    return (t or "").translate({c: c + 32 for c in range(65, 91)})
