"""Encoders that are fitted once, stored, added up over fits, and applied to rows that were not in the fit.

A fit is a table of counts and label sums per (column, value), which add up: a new day's rows are fitted alone and merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators.encoders import _plain_expression
from featurekit.operators.lookup import attach

# What an encoding makes of the sums of a value, and of a value that was in no fit.
KINDS = ("count", "frequency", "target_mean")
_SUMS = ("n", "labelled", "label_sum")


def _key(df: DataFrame, column: str) -> Column:
    return F.expr(_plain_expression(column, df.schema[column].dataType))


def fit_values(df: DataFrame, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """``column, value, n, labelled, label_sum`` from one shuffle; values are text and null is a value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _key(df, c).alias("value")) for c in columns])
    y = F.col(label).cast("double") if label else F.lit(None).cast("double")
    return df.select(F.explode(cells).alias("x"), y.alias("y")).groupBy("x.column", "x.value").agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("label_sum"))


def merge(*fits: DataFrame) -> DataFrame:
    """One fit of the rows of all."""
    return reduce(DataFrame.unionByName, fits).groupBy("column", "value").agg(*[F.sum(c).alias(c) for c in _SUMS])


def save(fit: DataFrame, path: str, version: str) -> None:
    """Store a fit under a new version; versions are never changed."""
    fit.write.mode("error").partitionBy("column").parquet(f"{path}/version={version}")


def load(spark: SparkSession, path: str, version: str) -> DataFrame:
    schema = "value string, n bigint, labelled bigint, label_sum double, column string"
    return spark.read.schema(schema).parquet(f"{path}/version={version}").select("column", "value", *_SUMS)


def encode(df: DataFrame, fit: DataFrame, columns: Sequence[str], kinds: Sequence[str] = ("count",)) -> DataFrame:
    """Add ``{column}_{kind}`` per column and kind.

    ``count`` are the fitted rows with the value and ``frequency`` their share of all fitted rows, 0 for a value that was in no
    fit; ``target_mean`` is the mean label of the value, null without a labelled row. Null is a value like any other.
    """
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"no encoder {', '.join(sorted(unknown))}")
    totals = {r["column"]: r["n"] for r in fit.where(F.col("column").isin(list(columns))).groupBy("column").agg(F.sum("n").alias("n")).collect()}
    result = df
    for c in columns:
        if c not in totals:
            raise LookupError(f"{c} is not in the fit")
        part = fit.where(F.col("column") == c).select(F.col("value").alias("__value"), *[F.col(s).alias(f"__{s}") for s in _SUMS])
        found = attach(result.withColumn("__value", _key(df, c)), part, "__value")
        made = {
            "count": F.coalesce("__n", F.lit(0)),
            "frequency": F.coalesce(F.col("__n") / F.lit(totals[c]), F.lit(0.0)),
            "target_mean": F.try_divide("__label_sum", "__labelled"),
        }
        result = found.select(*result.columns, *[made[k].alias(f"{c}_{k}") for k in kinds])
    return result
