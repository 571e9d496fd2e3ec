"""Rows and folders that several tests share."""

from __future__ import annotations

import os

from pyspark.sql import types as T

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
SMALL = "/root/testdata/sf0.001"

#: Nulls, blanks, repeated rows and ids, very long and repetitive texts.
ODD = [
    (None, "null id " * 20),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "the same words again and again " * 40),
    (5, "the same words again and again " * 40),
    (6, "the same words again and again " * 40),
    (7, "Ünïcödé – ß 漢字 🙂 " * 30),
    (8, "x" * 3000),
    (9, "x" * 3000),
    (10, " ".join(f"w{i}" for i in range(4000))),
    (11, " ".join(f"w{i}" for i in range(500, 3500))),
]
