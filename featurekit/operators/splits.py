"""Validation splits as tables of keys with a fold or a role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.operators.lookup import attach
from featurekit.operators.ordering import counted_ordinals, ordinals


def shuffle_hash(key: str, seed: int) -> Column:
    """A repeatable pseudo-random integer of a key: the first 32 bits of the MD5 of ``key|seed``."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def kfold(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """``key, fold`` with folds 0..k-1 of nearly equal size; needs no shuffle."""
    return with_kfold(df.select(key), key, k, seed)


def with_kfold(df: DataFrame, key: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add the fold of :func:`kfold` to the rows themselves, which needs no join."""
    return df.withColumn(name, F.pmod(shuffle_hash(key, seed), F.lit(k)).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int, seed: int = 42) -> DataFrame:
    """``key, label, fold``; inside each label the fold sizes differ by at most one."""
    rows = df.select(key, label).withColumn("__h", shuffle_hash(key, seed))
    placed = ordinals(rows, ["__h", key], group=[label], name="__o")
    return placed.select(key, label, F.pmod("__o", F.lit(k)).cast("int").alias("fold"))


def time_series_folds(df: DataFrame, key: str, time: str, k: int) -> DataFrame:
    """``key, chunk``: k+1 consecutive chunks in time; fold i validates on chunk i and trains on all chunks before."""
    placed, n = counted_ordinals(df.select(key, time), [time, key], name="__o")
    size = n // (k + 1)
    first = n - k * size
    chunk = F.when(F.col("__o") < first, 0).otherwise(F.floor((F.col("__o") - first) / F.lit(max(size, 1))) + 1)
    return placed.select(key, chunk.cast("int").alias("chunk"))


def time_series_roles(chunks: DataFrame, k: int, last: int | None = None) -> DataFrame:
    """``key, fold, role`` of the last ``last`` folds (all by default) of a chunk table."""
    first = 1 if last is None else k - last + 1
    folds = F.explode(F.sequence(F.greatest(F.col("chunk"), F.lit(first)), F.lit(k)))
    role = F.when(F.col("fold") == F.col("chunk"), "valid").otherwise("train")
    return chunks.where(F.col("chunk") <= k).withColumn("fold", folds).withColumn("role", role).drop("chunk")


def ordered_kfold(df: DataFrame, key: str, time: str, k: int) -> DataFrame:
    """``key, fold``: k contiguous blocks in time order; the first ``n mod k`` blocks hold one row more."""
    placed, n = counted_ordinals(df.select(key, time), [time, key], name="__o")
    size, larger = divmod(n, k)
    edge = larger * (size + 1)
    fold = F.when(F.col("__o") < edge, F.floor(F.col("__o") / F.lit(size + 1))).otherwise(
        F.floor((F.col("__o") - edge) / F.lit(max(size, 1))) + larger
    )
    return placed.select(key, fold.cast("int").alias("fold"))


def period_holdout(df: DataFrame, key: str, period: str, valid_from: int, open_end: bool = False) -> DataFrame:
    """``key, role``: earlier periods train, ``valid_from`` (and later ones if ``open_end``) validate, the rest is left out."""
    valid = F.col(period) >= valid_from if open_end else F.col(period) == valid_from
    role = F.when(F.col(period) < valid_from, "train").when(valid, "valid")
    return df.select(key, role.alias("role")).where(F.col("role").isNotNull())


def holdout_with_kfold(df: DataFrame, key: str, period: str, valid_from: int, k: int, seed: int = 42) -> DataFrame:
    """``key, role, fold``: a period hold-out whose training part is also split into k folds."""
    rows = with_kfold(period_holdout(df, key, period, valid_from), key, k, seed)
    return rows.withColumn("fold", F.when(F.col("role") == "train", F.col("fold")))


def stratified_holdout(df: DataFrame, key: str, label: str, share: float = 0.33, seed: int = 42) -> DataFrame:
    """``key, label, role`` with the share of test rows equal in every label (rounded half up)."""
    rows = df.select(key, label).withColumn("__h", shuffle_hash(key, seed))
    placed = ordinals(rows, ["__h", key], group=[label], name="__o")
    sizes = placed.groupBy(label).agg(F.floor(F.count(F.lit(1)) * F.lit(share) + F.lit(0.5)).alias("__test"))
    sized = attach(placed, sizes, label)
    return sized.select(key, label, F.when(F.col("__o") < F.col("__test"), "test").otherwise("train").alias("role"))


def shuffled(df: DataFrame, key: str, seed: int = 42, name: str = "position") -> DataFrame:
    """All rows with their position in a repeatable random order."""
    return ordinals(df.withColumn("__h", shuffle_hash(key, seed)), ["__h", key], name=name).drop("__h")


def with_roles(df: DataFrame, roles: DataFrame, key: str) -> DataFrame:
    """Attach a split table to the rows it names; rows it does not name are left out."""
    return df.join(roles, key)
