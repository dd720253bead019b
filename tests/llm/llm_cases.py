"""Inputs that every operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

EXTRA = "id long, t string, row string, kept string, size string, component long, n int, sig string, i int, key string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def documents(spark, schema: str = SCHEMA):
    """Two dozen rows; doc_id 30 and 31 are near copies, 40 appears twice."""
    base = words(1, 120)
    near = base.split(" ")
    near[60] = "other"
    rows = [
        (1, None, None, None, None), (None, words(2, 40), "en", "a", 1), (2, "", "en", "a", 0),
        (3, " \n\t ", "en", None, 4), (4, words(3, 9000), "de", "b", 1), (5, "x" * 30000, "en", "b", 30000),
        (6, "ab " * 4000, "en", "b", 12000), (7, "one", "en", "c", 3), (8, "one two", "en", "c", 7),
        (30, base, "en", "a", 1), (31, " ".join(near), "en", "a", 1), (32, base.upper(), "en", "b", 1),
        (40, words(4, 70), "fr", "c", 1), (40, words(4, 70), "fr", "c", 1), (41, "é漢🙂 ▁ \x00 </s>" * 30, "es", "d", 1),
        (42, words(5, 60) + " " + base[:300], "en", "d", 1), (None, None, None, None, None),
    ]
    return spark.createDataFrame([r + (1, "t", "row", "kept", "size", 5, 6, "sig", 7, "key") for r in rows], schema)


def empty(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)


def by_id(df, key: str = "doc_id") -> dict:
    return {r[key]: r for r in df.collect()}
