"""Importance resampling towards a target distribution over hashed word n-grams.

Every text is scanned once: separators are collapsed to single spaces, and a regular expression with overlapping matches
that keep to word boundaries gives the spans of every n-gram. The crc32 of a span names its bucket.
The buckets of a text are stored, counted over all texts, and weighed by how much likelier they are in the target.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import small_batches
from featurekit.operators.lookup import attach
from featurekit.operators.ordering import counted_ordinals
from featurekit.session import scratch_path

BUCKETS = 10_000
MAX_WORDS = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SCALE = 1000

# Bytes of words stay (digits, small letters, all of other alphabets), capital letters become small, the rest are spaces.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def ngram_pattern(max_words: int) -> regex.Pattern:
    """One match per word, whose groups are the word and up to ``max_words`` - 1 words after it, each with its space.

    The space before and the look-ahead behind let words begin and end only at a space, and as matches overlap, every
    word begins one. The first k groups side by side are the n-gram of k words.
    """
    return regex.compile(rb" ([^ ]++)" + rb"( [^ ]++)?+" * (max_words - 1) + rb"(?= )")


_PATTERN = ngram_pattern(MAX_WORDS)


def _checksums(plain: bytes, pattern: regex.Pattern) -> Iterator[int]:
    for match in pattern.finditer(plain, overlapped=True):
        sum_ = 0
        for part in match.groups():
            if part is None:
                break
            sum_ = crc32(part, sum_)  # a longer n-gram goes on from the shorter one
            yield sum_


def ngram_buckets(text: bytes | None, buckets: int = BUCKETS, pattern: regex.Pattern = _PATTERN) -> tuple[int, np.ndarray]:
    """The number of words of a text and the bucket of every n-gram."""
    plain = b" " + b" ".join((text or b"").translate(_BYTES).split()) + b" "  # separators collapse to one space
    return plain.count(b" ") - 1 if len(plain) > 2 else 0, np.fromiter(_checksums(plain, pattern), np.uint32) % np.uint32(buckets)


def with_buckets(df: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """Add ``words`` and ``found``, the buckets of all n-grams as packed 32-bit numbers (16-bit where they fit)."""
    small_batches(df.sparkSession)
    pattern, kind = ngram_pattern(max_words), _packed(buckets)

    @F.pandas_udf("words long, found binary")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            scanned = [ngram_buckets(t, buckets, pattern) for t in batch]
            yield pd.DataFrame({"words": [n for n, _ in scanned], "found": [f.astype(kind).tobytes() for _, f in scanned]})

    return df.withColumn("__scan", scan(F.col("text").cast("string").cast("binary"))).select("*", "__scan.*").drop("__scan")


def _packed(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often every bucket occurs in all rows: added up per task, then by Spark; ``buckets`` numbers reach the driver."""
    kind = _packed(buckets)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch["found"]:
                total += np.bincount(np.frombuffer(found, kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    rows = scanned.select("found").mapInPandas(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets, np.int64)
    for r in rows:
        total[r["bucket"]] = r["n"]
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of target to source share), every bucket counted once more than it occurs."""
    s_all, t_all, size = int(source.sum()), int(target.sum()), len(source)
    ratios = ((float(t + 1) * float(s_all + size)) / (float(s + 1) * float(t_all + size)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


def _with_weight(scanned: DataFrame, gains: np.ndarray) -> DataFrame:
    """Add ``n_features`` and ``weight``, the floored mean gain; without features 0."""
    kind, shared = _packed(len(gains)), scanned.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    @F.pandas_udf("n_features long, weight long")
    def weigh(packed: pd.Series) -> pd.DataFrame:
        found = [np.frombuffer(p, kind) for p in packed]
        sums = [int(shared.value[f].sum()) // len(f) if len(f) else 0 for f in found]
        return pd.DataFrame({"n_features": [len(f) for f in found], "weight": sums}, dtype="int64")

    return scanned.withColumn("__w", weigh("found")).select("*", "__w.*").drop("__w", "found")


def gumbel(seed: int = SEED) -> Column:
    """A draw from the Gumbel distribution in thousandths, floored, from the sha256 of seed and doc_id (null: empty text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def importance_ranks(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_features, weight, score and rank, all long.

    The draw is without replacement: of the documents with at least ``min_words`` words the ``percent`` with the highest
    scores (weight plus a Gumbel draw) get ranks 1, 2, 3 ..., ties to the smaller doc_id, then to the larger weight;
    all others a null rank. Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased.
    Null or empty texts have no features and weight 0. A null doc_id comes last among ties. Repeated rows count and are
    ranked each. Other columns are ignored. Without target texts every bucket is weighed by the documents alone; no
    documents give no rows.
    """
    path = scratch_path(docs.sparkSession, "buckets")
    with_buckets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"), buckets, max_words).drop("text").write.parquet(path)
    scanned = docs.sparkSession.read.schema("doc_id long, text_hash long, words long, found binary").parquet(path)
    wanted = with_buckets(target.select("text"), buckets, max_words)
    gains = bucket_gains(bucket_counts(scanned, buckets), bucket_counts(wanted, buckets))
    scored = _with_weight(scanned, gains).withColumn("score", F.col("weight") + gumbel(seed))
    result = ["doc_id", "text_hash", "n_features", "weight", "score"]
    able = scored.where(F.col("words") >= min_words).select(
        *result, (-F.col("score")).alias("__score"), F.col("doc_id").isNull().alias("__none"), (-F.col("weight")).alias("__weight"))
    placed, total = counted_ordinals(able, ["__score", "__none", "doc_id", "__weight", "n_features", "text_hash"], name="__at")
    rank = F.when(F.col("__at") < total * percent // 100, F.col("__at") + 1).cast("long").alias("rank")
    others = scored.where(F.col("words") < min_words).select(*result, F.lit(None).cast("long").alias("rank"))
    return placed.select(*result, rank).unionByName(others)


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns; equal rows (doc_id and text) are drawn one by one like others."""
    units = importance_ranks(docs, target, **options).groupBy("doc_id", "text_hash").agg(
        F.count("rank").alias("drawn"), F.count(F.lit(1)).alias("held")).where("drawn > 0")
    names = units.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"), F.col("drawn").alias("__drawn"),
                         F.col("held").alias("__held"))
    keyed = docs.select("*", F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__text"))
    found = attach(keyed, names, ["__id", "__text"])
    whole = found.where(F.col("__drawn") == F.col("__held")).select(*docs.columns)
    partly = found.where(F.col("__drawn") < F.col("__held")).dropDuplicates(["__id", "__text"])  # the last rank cuts at most one
    return whole.unionByName(
        partly.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__drawn")))).select(*docs.columns))
