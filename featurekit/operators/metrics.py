"""Exact ranking metrics and two-sample statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.operators.ordering import running_sums


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, per group; null when a group has one label only.

    Rows without a score are left out. Counts per distinct score are ranked, not the rows.
    """
    by = list(by)
    scored = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = scored.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum(1 - F.col(label).cast("bigint")).alias("neg")
    )
    ranked = running_sums(counts, [score], ["neg"], by)
    # A positive beats every negative with a lower score and half of those with the same score.
    won = F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * F.lit(0.5).cast("double"))
    totals = ranked.groupBy(*by).agg(
        F.sum(won).alias("won"), F.sum("pos").alias("n_pos"), F.first("total_neg").alias("n_neg")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return totals.select(*by, "n_pos", "n_neg", F.try_divide(F.col("won"), pairs).alias("auc"))


def metric_summary(df: DataFrame, metric: str) -> DataFrame:
    """Mean and population standard deviation of a metric over folds."""
    return df.agg(F.avg(metric).alias(f"mean_{metric}"), F.stddev_pop(metric).alias(f"std_{metric}"), F.count(metric).alias("folds"))


def kolmogorov_tail(x: Column, terms: int = 20) -> Column:
    """Probability that the limiting Kolmogorov statistic exceeds ``x``; two series that converge on either side of 1."""
    large = F.lit(0.0)
    small = F.lit(0.0)
    for i in range(1, terms + 1):
        large = large + F.lit(2.0 * (-1) ** (i - 1)) * F.exp(F.lit(-2.0 * i * i) * x * x)
        small = small + F.exp(F.try_divide(F.lit(-((2 * i - 1) ** 2) * math.pi**2 / 8), x * x))
    small = F.lit(1.0) - F.try_divide(F.lit(math.sqrt(2 * math.pi)), x) * small
    return F.when(x <= 0, F.lit(1.0)).when(x < 1, small).otherwise(large)


def ks_two_sample(df: DataFrame, columns: Sequence[str], second: Column) -> DataFrame:
    """``column, n_first, n_second, statistic, p_value``: two-sample Kolmogorov-Smirnov test of numeric columns.

    ``second`` tells which rows form the second sample. Nulls are left out. The p-value is the asymptotic one.
    All columns share one pass over distinct (column, value) counts.
    """
    cells = F.array(*[F.col(c).cast("double") for c in columns])
    counts = (
        df.select(second.alias("__second"), F.posexplode(cells).alias("__at", "value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("__second").isNotNull())
        .groupBy("__at", "value")
        .agg(F.count_if(~F.col("__second")).alias("first"), F.count_if(F.col("__second")).alias("second"))
    )
    ranked = running_sums(counts, ["value"], ["first", "second"], ["__at"])
    gap = F.abs(F.try_divide("cum_first", "total_first") - F.try_divide("cum_second", "total_second"))
    largest = ranked.groupBy("__at").agg(
        F.first("total_first").alias("n_first"), F.first("total_second").alias("n_second"), F.max(gap).alias("statistic")
    )
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("__at") + 1)
    result = largest.select(name.alias("column"), "n_first", "n_second", "statistic")
    scale = F.sqrt(F.try_divide(F.col("n_first").cast("double") * F.col("n_second"), F.col("n_first") + F.col("n_second")))
    return result.withColumn("p_value", kolmogorov_tail(scale * F.col("statistic")))
