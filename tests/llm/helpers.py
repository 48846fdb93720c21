"""Small documents with the awkward cases every operator must define."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Extra columns whose names operators might use themselves.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("row", "link", "size", "fp", "root", "pass", "block", "score", "key")],
    ]
)


def passage(n: int, seed: int = 0) -> str:
    return " ".join(f"w{(i * 7919 + seed * 104729) % 100003}" for i in range(n))


AWKWARD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", "en", "a"),
    (4, "One two", "en", None),
    (5, passage(60, 1) + " tail " + passage(10, 2), "en", "a"),
    (6, "head " + passage(60, 1), None, "a"),
    (7, passage(60, 1) + " tail " + passage(10, 2), "de", "b"),
    (7, passage(60, 1) + " tail " + passage(10, 2), "de", "b"),
    (8, passage(40, 3) + " " + passage(40, 3), "fr", "b"),
    (None, passage(5000, 4), "fr", "c"),
    (9, "ÄÖ  éà x  y\n\n z <|endoftext|> 's", "de", "c"),
    (10, "x" * 3000, "en", "c"),
    (11, "12 34 !!", "en", "c"),
]


def docs(spark, rows=None):
    rows = AWKWARD if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, *["x"] * 9) for r in rows], SCHEMA)


def words(text):
    return WORDS.findall(text or "")
