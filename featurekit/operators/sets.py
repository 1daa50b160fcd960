"""Unions, category differences and grids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurekit.operators.encoders import value_table

# Parts into which the values of a column are dealt before they are ranked.
RANK_PARTS = 64


def stack_datasets(train: DataFrame, test: DataFrame, name: str = "dataset") -> DataFrame:
    """One table from two, with a column that tells them apart; a column missing in one side is null there."""
    return train.withColumn(name, F.lit("train")).unionByName(test.withColumn(name, F.lit("test")), allowMissingColumns=True)


def take_dataset(df: DataFrame, value: str, name: str = "dataset") -> DataFrame:
    return df.where(F.col(name) == value).drop(name)


def stack_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def category_difference(df: DataFrame, columns: Sequence[str], is_train: Column) -> DataFrame:
    """``column, value, only_in``: values (null among them) that occur in just one of the two datasets."""
    marked = df.withColumn("__train", is_train)
    sides = value_table(marked, columns, ["__train"]).groupBy("column", "value").agg(
        F.bool_or("__train").alias("in_train"), F.bool_or(~F.col("__train")).alias("in_test")
    )
    return sides.where(F.col("in_train") != F.col("in_test")).select(
        "column", "value", F.when(F.col("in_train"), "train").otherwise("test").alias("only_in")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], nulls: bool = False) -> DataFrame:
    """Exact number of distinct values per column, from one pass over all columns."""
    values = value_table(df, columns)
    if not nulls:
        values = values.where(F.col("value").isNotNull())
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def top_values(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """``column, rank, value, n``: the most frequent non-null values of every column.

    A first ranking inside parts of a column leaves at most ``n`` values per part, for any ``n``, so the second one
    never sees all values of a column.
    """
    return ranked_values(value_table(df, columns), n)


def ranked_values(values: DataFrame, n: int) -> DataFrame:
    """:func:`top_values` of a table of counted values."""
    values = values.where(F.col("value").isNotNull())
    order = [F.desc("n"), F.asc("value")]
    part = F.pmod(F.xxhash64("value"), F.lit(RANK_PARTS))
    inside = Window.partitionBy("column", "__part").orderBy(*order)
    best = Window.partitionBy("column").orderBy(*order)
    ahead = values.withColumn("__part", part).withColumn("__rank", F.row_number().over(inside)).where(F.col("__rank") <= n)
    return ahead.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n).select("column", "rank", "value", "n")


def interaction_table(df: DataFrame, column: str, label: str, is_train: Column) -> DataFrame:
    """``value, value_count, n, label_rate``: each value with its count over all rows and its label mean in train."""
    known = df.where(F.col(column).isNotNull())
    return known.groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("value_count"),
        F.count_if(is_train).alias("n"),
        F.avg(F.when(is_train, F.col(label))).alias("label_rate"),
    )


def value_count_grid(spark: SparkSession, values: Sequence, counts: Sequence[int], limit: int = 1_000_000) -> DataFrame:
    """Every listed value beside every listed count, as (value, value_count); at most ``limit`` points.

    The axes come from the caller, such as explicit numbers or quantile edges, so the grid does not grow with the data.
    """
    if len(values) * len(counts) > limit:
        raise ValueError(f"{len(values)} x {len(counts)} points are more than {limit}")
    axis = F.array(*[F.lit(int(c)).cast("bigint") for c in counts])
    points = spark.createDataFrame([(float(v),) for v in values], "value double")
    return points.select("value", F.explode(axis).alias("value_count"))
