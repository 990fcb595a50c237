"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

NOT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Columns that operators use names of inside.
EXTRA = ("row", "doc", "spans", "bits", "score", "value", "part", "length", "kept", "label", "block")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in EXTRA)])


def words(seed: int, n: int) -> list[str]:
    random_ = random.Random(seed)
    return ["".join(random_.choice("aeioulmnrst") for _ in range(random_.randint(2, 7))) for _ in range(n)]


def text(seed: int, n: int) -> str:
    return " ".join(words(seed, n))


def documents(spark, rows: list[tuple[int | None, str | None]]):
    made = [(i, t, "en", f"src{(i or 0) % 4}", None if t is None else len(t), *(["x"] * len(EXTRA))) for i, t in rows]
    return spark.createDataFrame(made, DOCS)


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    return [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (5, "one"), (5, "one"), (6, "Ünïcödé ẞtraße 日本語 text"),
            (7, text(7, 30_000)), (8, text(8, 300)), (9, text(8, 300)), (10, "\x01 control \x00 marks \x7f"), (11, "a " * 500), (12, "x" * 5000)]


def plain(text_: str | None) -> str:
    return (text_ or "").translate(ASCII_LOWER)
