"""Small awkward tables: nulls in every column, empty and long texts, repeated rows, extra columns with clashing names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("score", "fp", "words", "hash", "size", "rank", "component_id", "copies", "w", "found", "key", "none")


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (doc_id, text, lang, source) with n_chars filled in."""
    full = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])


LONG = " ".join(f"word{i % 977}" for i in range(30_000))

AWKWARD = [
    (1, "a plain text of some words that is long enough to hold shingles", "en", "s1"),
    (1, "a plain text of some words that is long enough to hold shingles", "en", "s1"),
    (2, None, "en", "s1"),
    (3, "", None, "s2"),
    (None, "a row without any identity but with words", "de", None),
    (4, LONG, "en", None),
    (5, "   \t\n ", "fr", "s2"),
    (6, "one", None, "s1"),
    (7, "!!! ??? 123", "en", ""),
]
