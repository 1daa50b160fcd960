"""Choosing, renaming, filling and narrowing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_FEATURES = ("TransactionID", "TransactionDT", "isFraud")


def keep(df: DataFrame, wanted: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """Select the listed columns that exist, in table order, plus those always kept."""
    names = set(wanted) | set(always)
    return df.select(*[c for c in df.columns if c in names])


def drop_matching(df: DataFrame, *fragments: str) -> DataFrame:
    """Drop every column whose name contains one of the fragments."""
    return df.drop(*[c for c in df.columns if any(f in c for f in fragments)])


def rename(df: DataFrame, prefix: str = "", suffix: str = "", key: Sequence[str] = ()) -> DataFrame:
    """Put a prefix and a suffix on every column but the key columns."""
    return df.select(*[F.col(c) if c in key else F.col(c).alias(f"{prefix}{c}{suffix}") for c in df.columns])


def only_new(df: DataFrame, raw: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Keep the key and the columns that were not part of the raw table."""
    return df.select(*key, *[c for c in df.columns if c not in raw and c not in key])


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``text`` or ``numeric`` columns."""
    types = T.StringType if kind == "text" else T.NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def feature_columns(df: DataFrame, removed: Sequence[str] = (), excluded: Sequence[str] = NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in excluded and c not in removed]


def overwrite_where(df: DataFrame, column: str, mask: Column, value: Column) -> DataFrame:
    """Replace a value where the mask is true; a null mask counts as false."""
    return df.withColumn(column, F.when(mask, value).otherwise(F.col(column)))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column with a value of the column's own type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items()})


def fill_sentinels(df: DataFrame, text: str = "__NA__", number: float = -9999, skip: Sequence[str] = ()) -> DataFrame:
    """Fill all text columns with one sentinel and all numeric columns with another, in every dataset alike."""
    texts = {c: text for c in columns_of(df, "text") if c not in skip}
    numbers = {c: number for c in columns_of(df, "numeric") if c not in skip}
    return fill(df, {**texts, **numbers})


def as_categories(df: DataFrame, columns: Sequence[str], sentinel: str = "__NA__") -> DataFrame:
    """Turn columns into text categories with a sentinel for null and mark them so in the column metadata."""
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit(sentinel)).alias(c, metadata={"categorical": True}) for c in columns
    })


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("categorical")]


# Exclusive limits a column must stay inside to get the type, and the bytes of a value.
INTEGER_TYPES = [("tinyint", 2**7, 1), ("smallint", 2**15, 2), ("int", 2**31, 4)]
FLOAT_LIMIT = 3.4028234663852886e38
WIDTHS = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}


def narrowed_types(df: DataFrame) -> dict[str, tuple[str, str]]:
    """Old and smallest fitting type of every numeric column, from one pass over the table."""
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, (T.IntegralType, T.FloatType, T.DoubleType))]
    if not numeric:
        return {}
    limits = df.agg(*[x for f in numeric for x in (F.min(f.name).alias(f"min_{f.name}"), F.max(f.name).alias(f"max_{f.name}"))]).first()
    plan = {}
    for field in numeric:
        low, high, old = limits[f"min_{field.name}"], limits[f"max_{field.name}"], field.dataType.simpleString()
        if low is None:
            new = old
        elif isinstance(field.dataType, T.IntegralType):
            fitting = [name for name, bound, _ in INTEGER_TYPES if low > -bound and high < bound - 1]
            new = fitting[0] if fitting else "bigint"
        else:
            new = "float" if low > -FLOAT_LIMIT and high < FLOAT_LIMIT else "double"
        plan[field.name] = (old, new)
    return plan


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the smallest type that holds its values."""
    plan = narrowed_types(df)
    return df.select(*[F.col(c).cast(plan[c][1]).alias(c) if c in plan else F.col(c) for c in df.columns])


def narrowing_report(df: DataFrame) -> DataFrame:
    """One row per numeric column: old and new type and the bytes of a value in each."""
    def width(name: str) -> int:
        return WIDTHS[name]

    rows = [(c, old, new, width(old), width(new)) for c, (old, new) in narrowed_types(df).items()]
    return df.sparkSession.createDataFrame(rows, "column string, old_type string, new_type string, old_bytes int, new_bytes int")
