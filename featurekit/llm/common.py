"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes that one Arrow batch may hold on its way to Python; texts vary from a word to megabytes.
BATCH_ROWS = 512
BATCH_BYTES = 16 * 1024 * 1024

# A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: whole texts travel in batches of limited rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def bucket_of(column: str, buckets: int) -> Column:
    """crc32 of an id as text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


def sampled(df: DataFrame, share: float, *keys: str | Column, seed: int = 0) -> DataFrame:
    """Rows whose hash falls under ``share``: the same rows in every run, without a shuffle."""
    if share >= 1.0:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) < int(share * (1 << 30)))
