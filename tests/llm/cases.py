"""Documents with the awkward cases that every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = ["fp", "h", "doc", "words", "first", "n", "kept", "score", "anchor", "run", "spans", "component", "host", "__part"]


def prose(seed: int, n: int, words: str = "the of house tree river stone light water and to") -> str:
    r = random.Random(seed)
    made = words.split() + ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(3, 9))) for _ in range(200)]
    return " ".join(r.choice(made) for _ in range(n))


def awkward() -> list[tuple]:
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " more", None, None), (4, None, "en", "a"), (5, "", "de", "a"),
        (6, "   \n\t ", "en", None), (7, "x" * 50_000, "en", "a"), (8, prose(2, 9000), "en", "b"), (None, prose(3, 60), "en", "b"),
        (None, None, None, None), (9, prose(4, 60), "fr", "b"), (9, prose(4, 60), "fr", "b"), (9, prose(5, 60), "fr", "b"),
        (10, "日本語 текст é́ 🙂 \x00 \x1c " * 20, "xx", "b"), (11, "ab" * 400, "en", "c"), (12, "12 34 !! ??", None, "c"),
        (13, base[:260], "en", "c"), (14, "a", "en", "c"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def frame(spark: SparkSession, rows: list[tuple] | None = None, clash: bool = False) -> DataFrame:
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def plain(df: DataFrame) -> list[tuple]:
    """Rows in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
