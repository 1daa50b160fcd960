"""Column profiles, histograms, quantile bins, densities and drift tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.functions.numeric import deviation
from featurekit.operators.columns import columns_of
from featurekit.operators.encoders import value_table
from featurekit.operators.groups import crosstab_share, known_keys, sort_categories
from featurekit.operators.lookup import attach
from featurekit.operators.moments import column_moments
from featurekit.operators.ordering import running_sums
from featurekit.operators.sets import ranked_values
from featurekit.session import materialize


# Slices of a column's range that are counted before any of its values are put in order.
CELLS = 4096


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, nulls`` from one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(columns)])
    return wide.select(F.explode(cells).alias("x")).select("x.column", "x.nulls")


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: type, nulls, distinct values, zeros, minimum, mean, maximum and standard deviation.

    Percentages are of all rows. The number statistics are null for text columns.
    """
    numeric = set(columns_of(df, "numeric"))
    listed = [(c, df.schema[c].dataType.simpleString(), c in numeric) for c in columns]
    # Written as text: for hundreds of columns that is much faster to plan than column objects.
    moments = column_moments(df.selectExpr(*[
        f"CAST(`{c}` AS DOUBLE) AS c{i}" if c in numeric else f"IF(`{c}` IS NULL, NULL, 1.0D) AS c{i}" for i, c in enumerate(columns)]))
    names = df.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(listed)], "at int, column string, type string, numeric boolean")
    number = lambda c: F.when(F.col("numeric"), F.col(c)).alias(c)
    stats = moments.join(F.broadcast(names), "at").select("column", "type", "n", "nulls", *map(number, ("zeros", "min", "mean", "max", "std")))
    uniques = value_table(df, columns).where(F.col("value").isNotNull()).groupBy("column").agg(
        F.count(F.lit(1)).alias("uniques")
    )
    # One row per profiled column on both sides.
    joined = stats.join(F.broadcast(uniques), "column", "left").withColumn("uniques", F.coalesce("uniques", F.lit(0)))
    percent = {f"{p}_pct": F.try_divide(F.col(p), F.col("n")) * 100 for p in ("nulls", "uniques", "zeros")}
    return joined.withColumns(percent)


def top_value_report(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """``column, rank, value, n, ratio``: most frequent values with their share of rows rounded to two digits."""
    # Null is a value in this table, so the rows of any one column add up to all rows.
    values = materialize(value_table(df, columns))
    total = values.where(F.col("column") == columns[0]).agg(F.sum("n")).first()[0] or 1
    return ranked_values(values, n).withColumn("ratio", F.round(F.col("n") / F.lit(total), 2))


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def target_mix(df: DataFrame, category: str, label: str) -> DataFrame:
    """``category, label, n, share``: label shares inside every category."""
    return crosstab_share(df, category, label, within=category)


def category_frequencies(
    df: DataFrame, column: str, is_train: Column, missing: str = "__NA__", top: int | None = None, sort: str | None = None
) -> DataFrame:
    """``value, n_train, n_test`` with null shown as ``missing``.

    ``top`` keeps the values most frequent in train; ``sort`` orders by ``alphabetic`` value or by falling ``freq``.
    """
    counted = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("value")).agg(
        F.count_if(is_train).alias("n_train"), F.count_if(~is_train).alias("n_test")
    )
    kept = sort_categories(counted, "freq", "value", "n_train").limit(top) if top else counted
    return sort_categories(kept, sort, "value", "n_train")


def _number(column: str) -> Column:
    """The column as a double; NaN is a missing value like null."""
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """``by, bin, n`` over equal-width bins between the smallest and largest value; the last bin is closed."""
    x = _number(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    known = df.where(x.isNotNull())
    if low is None:
        number = F.lit(0)
    else:
        if low == high:  # one value sits in the middle of a bin range of width 1
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        number = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    return known.groupBy(*by, number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Exact, linearly interpolated quantile edges without repeats.

    Distinct values are counted first, then the counts of ``CELLS`` equal slices of their range. Only the few slices
    that hold a wanted order statistic are put in order; only those statistics come back.
    """
    x = F.col(column).cast("double")
    known = df.where(x.isNotNull() & ~F.isnan(x))
    counts = materialize(known.groupBy(x.alias("value")).agg(F.count(F.lit(1)).alias("n")))
    finite = F.when(F.abs("value") < float("inf"), F.col("value"))
    total, low, high = counts.agg(F.sum("n"), F.min(finite), F.max(finite)).first()
    if not total:
        return []
    cell = F.lit(0)
    if low is not None and low < high:
        inside = F.floor((F.col("value") - F.lit(low)) / F.lit(high - low) * CELLS).cast("int")
        cell = F.when(F.col("value") <= low, 0).when(F.col("value") >= high, CELLS - 1).otherwise(F.least(inside, F.lit(CELLS - 1)))
    placed = counts.withColumn("cell", cell)
    positions = [i * (total - 1) / bins for i in range(bins + 1)]
    wanted = sorted({math.floor(p) for p in positions} | {math.ceil(p) for p in positions})
    starts, before = {}, 0
    for row in placed.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect():  # at most CELLS rows
        if any(before <= w < before + row["n"] for w in wanted):
            starts[row["cell"]] = before
        before += row["n"]
    ranked = running_sums(placed.where(F.col("cell").isin(list(starts))), ["value"], ["n"], ["cell"])
    first = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("cell"))
    low_rank, high_rank = first + F.col("cum_n") - F.col("n"), first + F.col("cum_n")
    hits = F.filter(F.array(*[F.lit(w).cast("bigint") for w in wanted]), lambda w: (w >= low_rank) & (w < high_rank))
    found = {r["rank"]: r["value"] for r in ranked.select("value", F.explode(hits).alias("rank")).collect()}
    edges = []
    for p in positions:
        low, high = found[math.floor(p)], found[math.ceil(p)]
        edges.append(low + (high - low) * (p - math.floor(p)))
    return sorted(set(edges))


def quantile_bins(df: DataFrame, column: str, bins: int, name: str = "bin") -> DataFrame:
    """Add the number of the right-closed quantile bin; the smallest value belongs to bin 0."""
    edges = quantile_edges(df, column, bins)
    inner = F.array(*[F.lit(e) for e in edges[1:-1]]) if len(edges) > 2 else F.array().cast("array<double>")
    x = _number(column)
    return df.withColumn(name, F.when(x.isNotNull(), F.size(F.filter(inner, lambda e: x > e))))


def density(df: DataFrame, column: str, by: str, points: int = 100, cut: float = 3.0) -> DataFrame:
    """``by, point, x, density``: Gaussian kernel density of a column per group on a shared grid.

    The bandwidth is the group's standard deviation times n^(-1/5). The grid reaches ``cut`` bandwidths beyond the
    data. Kernels are summed over distinct values, weighted by their counts.
    """
    x = _number(column)
    known = known_keys(df, [by]).where(x.isNotNull())
    spread = known.groupBy(by).agg(
        F.count(F.lit(1)).alias("__n"), (deviation(x) * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("__h"),
        F.min(x).alias("__low"), F.max(x).alias("__high"),
    )
    groups = materialize(spread)
    ends = groups.agg(F.min(F.col("__low") - F.col("__h") * cut), F.max(F.col("__high") + F.col("__h") * cut)).first()
    if ends[0] is None:
        return groups.select(by, F.lit(0).alias("point"), F.lit(0.0).alias("x"), F.lit(0.0).alias("density")).limit(0)
    low, step = ends[0], (ends[1] - ends[0]) / (points - 1)
    weights = known.groupBy(by, x.alias("__v")).agg(F.count(F.lit(1)).alias("__w"))
    spreads = groups.select(by, "__n", "__h")
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    kernels = attach(weights, spreads, by).select(by, "__n", "__h", "__v", "__w", grid.alias("point"))
    at = F.lit(low) + F.col("point") * F.lit(step)
    z = F.try_divide(at - F.col("__v"), F.col("__h"))
    summed = kernels.groupBy(by, "point", "__n", "__h").agg(F.sum(F.col("__w") * F.exp(F.lit(-0.5) * z * z)).alias("__sum"))
    scale = F.col("__n") * F.col("__h") * F.lit(math.sqrt(2 * math.pi))
    return summed.select(by, "point", at.alias("x"), F.try_divide(F.col("__sum"), scale).alias("density"))


def count_density(df: DataFrame, column: str, by: str, points: int = 100, cut: float = 3.0) -> DataFrame:
    """Density of the value counts of a column: how many rows its values have, per group."""
    counts = known_keys(df, [column, by]).groupBy(by, column).agg(F.count(F.lit(1)).alias("value_count"))
    return density(counts, "value_count", by, points, cut)


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def require_same_rows(before: int, df: DataFrame) -> DataFrame:
    """Return ``df`` unless its row count differs from ``before``."""
    after = df.count()
    if after != before:
        raise ValueError(f"row count changed from {before} to {after}")
    return df
