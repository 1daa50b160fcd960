"""Left-preserving joins: keyed tables, dictionaries and aggregates joined back to rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.session import materialize


@dataclass(frozen=True)
class BroadcastLimit:
    """What may be sent to every executor; measured before a dictionary is broadcast."""

    rows: int = 1_000_000
    bytes: int = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int
    null_keys: int
    weight: int | None = None

    def fits(self, limit: BroadcastLimit) -> bool:
        return self.rows <= limit.rows and self.bytes <= limit.bytes


LIMIT = BroadcastLimit()

# A key is hot when it holds more than this share of all rows; there are fewer than 1/share such keys.
HOT_SHARE = 1e-4

# Hash bits that scatter settled rows, and those that the other rows carry beside their key; few bits are shuffled in fewer bytes.
_SPREAD = 0xFFFF
_TAG = 0xF

# Optional dictionary column: how many rows of the big table carry the key. It never reaches the result.
WEIGHT = "__weight"


def with_row_id(df: DataFrame, column: str) -> DataFrame:
    """Mark the column that tells rows apart, so that spreading rows needs no other column."""
    return df.withMetadata(column, {**df.schema[column].metadata, "row_id": True})


def _row_id(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("row_id")] or df.columns


def left_join(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Join on a key that is unique on both sides, so that no key can be hot; Spark picks the strategy."""
    return df.join(other, [on] if isinstance(on, str) else list(on), "left")


def lookup_join(df: DataFrame, stored: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Left join a stored table with one row per key to rows that repeat the key; a null key matches a null key.

    Files small enough for Spark to broadcast by itself are not measured; larger ones are, and then joined like any
    dictionary. Rows and columns are the same either way.
    """
    on = [on] if isinstance(on, str) else list(on)
    spark = df.sparkSession
    planned = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if planned <= int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()):
        return _join(df, stored, on, null_safe=True)
    return attach(df, stored, on, size=measure(stored, on))


def size_columns(df: DataFrame, on: Sequence[str]) -> list[Column]:
    """Aggregates that measure a dictionary: rows, estimated bytes, rows with a null key, rows it stands for."""
    width: Column = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 24
        else:
            width = width + 16
    any_null = F.lit(False)
    for key in on:
        any_null = any_null | F.col(key).isNull()
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"),
        F.count_if(any_null).alias("null_keys"),
        (F.sum(WEIGHT) if WEIGHT in df.columns else F.lit(None).cast("bigint")).alias("weight"),
    ]


def measure(df: DataFrame, on: Sequence[str]) -> Size:
    row = df.agg(*size_columns(df, on)).first()
    return Size(row["rows"], row["bytes"], row["null_keys"], row["weight"])


def store(df: DataFrame, on: Sequence[str]) -> tuple[DataFrame, Size]:
    """Compute a dictionary once and measure it in the same job."""
    seen = Observation()
    stored = materialize(df.observe(seen, *size_columns(df, on)))
    found = seen.get
    return stored, Size(found["rows"], found["bytes"], found["null_keys"], found["weight"])


def attach(
    df: DataFrame,
    dictionary: DataFrame,
    on: Sequence[str] | str,
    *,
    size: Size | None = None,
    limit: BroadcastLimit | None = None,
    hot_share: float | None = None,
) -> DataFrame:
    """Left join a dictionary with one row per key; a null key matches a null key in the dictionary.

    The dictionary is computed once and measured. A small one is broadcast, so ``df`` is not shuffled.
    A large one is split: the few hot keys are broadcast, all others are joined by a shuffle in which
    rows of hot keys are spread evenly, so that no task receives a hot key's rows.
    Pass ``size`` when the dictionary is already stored and measured.
    """
    on = [on] if isinstance(on, str) else list(on)
    if size is None:
        dictionary, size = store(dictionary, on)
    if size.fits(limit or LIMIT):
        return _join(df, F.broadcast(dictionary.drop(WEIGHT)), on, size.null_keys > 0)
    return _attach_large(df, dictionary, on, size, hot_share or HOT_SHARE)


def _same_keys(on: list[str], alias: str, null_safe: bool) -> Column:
    pairs = [(F.col(k), F.col(f"{alias}{i}")) for i, k in enumerate(on)]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _join(df: DataFrame, dictionary: DataFrame, on: list[str], null_safe: bool) -> DataFrame:
    values = [c for c in dictionary.columns if c not in on]
    right = dictionary.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(on)], *values)
    return df.join(right, _same_keys(on, "__k", null_safe), "left").select(*df.columns, *values)


def _hot_keys(df: DataFrame, dictionary: DataFrame, on: list[str], size: Size, hot_share: float) -> DataFrame:
    if size.weight is not None:
        hot = dictionary.where(F.col(WEIGHT) > size.weight * hot_share)
    else:
        counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias(WEIGHT))
        hot = materialize(counts.where(F.col(WEIGHT) > df.count() * hot_share))
    return hot.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(on)])


def _attach_large(df: DataFrame, dictionary: DataFrame, on: list[str], size: Size, hot_share: float) -> DataFrame:
    null_safe = size.null_keys > 0
    values = [c for c in dictionary.columns if c not in on and c != WEIGHT]

    # Fewer than 1/hot_share keys can hold more than hot_share of the rows each, which bounds the broadcasts.
    hot_keys = _hot_keys(df, dictionary, on, size, hot_share)
    is_listed = _same_keys(on, "__h", null_safe)
    indexes = range(len(on))
    matched = dictionary.join(F.broadcast(hot_keys), is_listed).select(
        *[F.col(f"__h{i}").alias(f"__m{i}") for i in indexes], *[F.col(v).alias(f"__hot_{v}") for v in values]
    )
    found = reduce(and_, [F.col(f"__h{i}").eqNullSafe(F.col(f"__m{i}")) for i in indexes])
    hot = hot_keys.join(F.broadcast(matched), found, "left").select(
        *[f"__h{i}" for i in indexes], *[f"__hot_{v}" for v in values], F.lit(True).alias("__hot")
    )
    cold = dictionary.join(F.broadcast(hot_keys), is_listed, "left_anti")
    tagged = df.join(F.broadcast(hot), _same_keys(on, "__h", null_safe), "left")

    # Both sides are shuffled by key and by some bits of its hash. A row that needs no partner any more - its key is hot, or
    # null while the dictionary knows no null - is hashed by its own identity instead, which scatters such rows
    # over all tasks.
    types = [df.schema[k].dataType for k in on]
    settled = F.col("__hot").isNotNull()
    if not null_safe:
        settled = reduce(or_, [F.col(k).isNull() for k in on], settled)
    left = tagged.withColumn("__settled", settled).withColumn(
        "__spread", F.when(F.col("__settled"), F.xxhash64(*_row_id(df)).bitwiseAND(_SPREAD)).otherwise(F.xxhash64(*on).bitwiseAND(_TAG))
    )
    right = cold.select(
        *[F.col(k).cast(t).alias(f"__c{i}") for i, (k, t) in enumerate(zip(on, types))],
        F.xxhash64(*[F.col(k).cast(t) for k, t in zip(on, types)]).bitwiseAND(_TAG).alias("__c_spread"),
        *[F.col(v).alias(f"__cold_{v}") for v in values],
    )
    condition = _same_keys(on, "__c", null_safe) & (F.col("__spread") == F.col("__c_spread")) & ~F.col("__settled")
    joined = left.join(right, condition, "left")
    return joined.select(*df.columns, *[F.coalesce(f"__hot_{v}", f"__cold_{v}").alias(v) for v in values])


def attach_all(df: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Join many one-row-per-key tables; every join uses the same key, so ``df`` is shuffled at most once."""
    for table in tables:
        df = left_join(df, table, key)
    return df


def membership(df: DataFrame, values: DataFrame, on: str, negate: bool = False) -> DataFrame:
    """Keep rows whose key is (or is not) listed in ``values``; a null key counts as not listed."""
    listed = values.where(F.col(on).isNotNull()).select(on).distinct().withColumn("__listed", F.lit(True))
    found = F.col("__listed").isNull() if negate else F.col("__listed")
    return attach(df, listed, on).where(found).drop("__listed")
