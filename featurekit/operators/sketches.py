"""Sketches that are stored per period and merged over any range: quantiles and distinct counts without the rows.

The exact forms are :func:`featurekit.operators.profile.quantile_edges` and :func:`featurekit.operators.sets.distinct_counts`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.operators.encoders import _plain_expression

# With k = 1000 a quantile's rank is within 0.4 % at 99 % confidence; 2^14 registers count within about 1.6 % at two deviations.
QUANTILE_K = 1000
DISTINCT_LG = 14
SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


def column_sketches(df: DataFrame, numbers: Sequence[str], distinct: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """``within, column, n, quantiles, distinct``: one row per period and column, from one shuffle.

    ``quantiles`` is null for columns that are only counted, ``distinct`` for those that are only ranked. Null and NaN are
    left out; a column without a value in a period has no row.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")).alias("number"),
            F.expr(_plain_expression(c, kinds[c])).alias("text"), F.lit(c in distinct).alias("counted"))
        for c in dict.fromkeys([*numbers, *distinct])
    ]
    rows = df.select(*within, F.explode(F.array(*cells)).alias("x")).select(*within, "x.*").where("text IS NOT NULL AND text <> 'NaN'")
    return rows.groupBy(*within, "column").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("number", QUANTILE_K).alias("__q"),
        F.hll_sketch_agg(F.when(F.col("counted"), F.col("text")), DISTINCT_LG).alias("__d"),
        F.count("number").alias("__numbers"), F.count_if("counted").alias("__counted"),
    ).select(*within, "column", "n", F.when(F.col("__numbers") > 0, F.col("__q")).alias("quantiles"),
             F.when(F.col("__counted") > 0, F.col("__d")).alias("distinct"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of whatever rows are given, merged per column (and ``by``)."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles", QUANTILE_K).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
        F.count("quantiles").alias("__q"), F.count("distinct").alias("__d"),
    ).select(*by, "column", "n", F.when(F.col("__q") > 0, F.col("quantiles")).alias("quantiles"), F.when(F.col("__d") > 0, F.col("distinct")).alias("distinct"))


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Add ``values``, the approximate quantiles at ``shares``; null where nothing was ranked."""
    found = F.array(*[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(s))) for s in shares])
    return sketches.withColumn("values", F.when(F.col("quantiles").isNotNull(), found))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """Add ``uniques``, the approximate number of different values; null where nothing was counted."""
    return sketches.withColumn("uniques", F.when(F.col("distinct").isNotNull(), F.hll_sketch_estimate("distinct")))
