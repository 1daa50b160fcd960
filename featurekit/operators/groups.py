"""Group statistics, cross-tabs and calendar aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions.numeric import deviation, nan_to_null
from featurekit.operators.lookup import WEIGHT, Size, attach, measure, store
from featurekit.operators.moments import column_moments
from featurekit.session import materialize, materialize_by

FUNCTIONS = {
    "min": F.min,
    "mean": F.avg,
    "max": F.max,
    "std": deviation,
    "sum": F.sum,
    "count": F.count,
}


def _listed(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _known(df: DataFrame, column: str) -> Column:
    """The column, with NaN read as null where there can be any."""
    floating = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    return nan_to_null(column) if floating else F.col(column)


def known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all present; a null key belongs to no group."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def group_stats(
    df: DataFrame,
    group: Sequence[str] | str,
    columns: Sequence[str] | str,
    functions: Sequence[str] | str,
    prefix: str = "",
    suffix: str = "",
) -> DataFrame:
    """One row per group with ``{prefix}{column}_{function}{suffix}`` for every pair."""
    group, columns, functions = _listed(group), _listed(columns), _listed(functions)
    stats = [FUNCTIONS[f](_known(df, c)).alias(f"{prefix}{c}_{f}{suffix}") for c in columns for f in functions]
    return known_keys(df, group).groupBy(*group).agg(*stats)


def join_back(df: DataFrame, stats: DataFrame, group: Sequence[str] | str, how: str = "left", drop: bool = False) -> DataFrame:
    """Attach group statistics to rows; ``how='inner'`` drops rows without a group, ``drop`` the group columns."""
    group = _listed(group)
    joined = attach(df, stats.withColumn("__found", F.lit(True)), group)
    if how == "inner":
        joined = joined.where(F.col("__found"))
    return joined.drop("__found", *(group if drop else ()))


def key_statistics(
    df: DataFrame, keys: Sequence[str], stats: Sequence[Column], within: Sequence[str] = ()
) -> Iterator[tuple[str, list[str], DataFrame, Size]]:
    """Per key: its name, its group columns, a stored dictionary of ``stats`` by them, and that dictionary's size.

    One pass over ``df`` serves all keys. A null key belongs to no group.
    """
    if len(keys) == 1:
        group = [*within, keys[0]]
        counted = known_keys(df, [keys[0]]).groupBy(*group).agg(*stats, F.count(F.lit(1)).alias(WEIGHT))
        yield keys[0], group, *store(counted, group)
        return
    # Every row takes part once per key, as the copy in which all other keys are null.
    sets = [[*within, k] for k in keys]
    marks = [F.grouping(k).alias(f"__off_{i}") for i, k in enumerate(keys)]
    counted = df.groupingSets(sets, *within, *keys).agg(*stats, F.count(F.lit(1)).alias(WEIGHT), *marks)
    number = F.coalesce(*[F.when(F.col(f"__off_{i}") == 0, i) for i in range(len(keys))])
    stored = materialize_by(counted.withColumn("__set", number).drop(*[f"__off_{i}" for i in range(len(keys))]), "__set")
    for i, key in enumerate(keys):
        part = known_keys(stored.where(F.col("__set") == i), [key]).drop("__set", *[k for k in keys if k != key])
        yield key, sets[i], part, measure(part, sets[i])


def group_ratios(
    df: DataFrame, values: Sequence[str], keys: Sequence[str], within: Sequence[str] = (), functions: Sequence[str] = ("mean", "std")
) -> DataFrame:
    """Add ``{value}_to_{function}_{key}`` = value over the group's statistic; null for a null key or a zero statistic."""
    stats = [FUNCTIONS[f](_known(df, v)).alias(f"__{v}_{f}") for v in values for f in functions]
    for key, group, stats, size in key_statistics(df, keys, stats, within):
        df = attach(df, stats, group, size=size)
        df = df.withColumns(
            {f"{v}_to_{f}_{key}": F.try_divide(F.col(v), F.col(f"__{v}_{f}")) for v in values for f in functions}
        ).drop(*[f"__{v}_{f}" for v in values for f in functions])
    return df


def group_row_counts(df: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Add the number of rows that share the group; nulls form a group of their own."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias(name)).withColumn(WEIGHT, F.col(name))
    return attach(df, counts, list(group))


def counts_and_ratios_long(df: DataFrame, group: Sequence[str] | str, targets: Sequence[str] | str) -> DataFrame:
    """``group, target, value, n, ratio`` for any number of values: rows of the group with the value, and their share.

    Null values are left out and the ratios of a target add up to 1 in every group.
    """
    group, targets = _listed(group), _listed(targets)
    cells = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("string").alias("value")) for t in targets])
    rows = known_keys(df, group).select(*group, F.explode(cells).alias("__cell")).select(*group, "__cell.*")
    counts = materialize(rows.where(F.col("value").isNotNull()).groupBy(*group, "target", "value").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy(*group, "target").agg(F.sum("n").alias("__total"), F.count(F.lit(1)).alias(WEIGHT))
    joined = attach(counts, totals, [*group, "target"])
    return joined.withColumn("ratio", F.col("n") / F.col("__total")).drop("__total")


def counts_and_ratios(
    df: DataFrame,
    group: Sequence[str] | str,
    targets: Sequence[str] | str,
    values: Mapping[str, Sequence],
    prefix: str = "",
    suffix: str = "",
) -> DataFrame:
    """One row per group with ``{target}Cnt_{value}`` and ``{target}Ratio_{value}`` for the listed values.

    Ratios are shares of all non-null values, so those of a target add up to 1 where all its values are listed. For
    unknown or many values there is :func:`counts_and_ratios_long`.
    """
    group, targets = _listed(group), _listed(targets)
    sums = [
        F.count_if(F.col(t) == F.lit(v)).alias(f"{prefix}{t}Cnt_{v}{suffix}") for t in targets for v in values[t]
    ] + [F.count(t).alias(f"__{t}") for t in targets]
    counted = known_keys(df, group).groupBy(*group).agg(*sums)
    ratios = [
        F.try_divide(F.col(f"{prefix}{t}Cnt_{v}{suffix}"), F.col(f"__{t}")).alias(f"{prefix}{t}Ratio_{v}{suffix}")
        for t in targets for v in values[t]
    ]
    return counted.select(*[c for c in counted.columns if not c.startswith("__")], *ratios)


def crosstab(df: DataFrame, row: str, column: str, name: str = "n") -> DataFrame:
    """Counts in long form; rows with a null in either column are left out."""
    return known_keys(df, [row, column]).groupBy(row, column).agg(F.count(F.lit(1)).alias(name))


def crosstab_share(df: DataFrame, row: str, column: str, within: str, name: str = "share") -> DataFrame:
    """Cross-tab counts and their share of the total of ``within`` (the row or the column variable)."""
    counts = materialize(crosstab(df, row, column))
    totals = counts.groupBy(within).agg(F.sum("n").alias("__total"))
    return attach(counts, totals, within).withColumn(name, F.col("n") / F.col("__total")).drop("__total")


def crosstab_wide(df: DataFrame, row: str, column: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Counts with one output column per listed value; absent cells are 0."""
    counted = known_keys(df, [row]).groupBy(row).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"{prefix}{v}") for v in values],
        F.count(column).alias("__any"),
    )
    return counted.where(F.col("__any") > 0).drop("__any")


def value_counts(df: DataFrame, column: str, top: int | None = None, nulls: bool = False, share: bool = False) -> DataFrame:
    """Values by falling count (ties by value), optionally with nulls, the share of rows and only the first ``top``."""
    source = df if nulls else known_keys(df, [column])
    counts = source.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if share:
        counts = materialize(counts)
        total = counts.agg(F.sum("n")).first()[0] or 1
        counts = counts.withColumn("share", F.col("n") / F.lit(total))
    counts = counts.orderBy(F.desc("n"), F.asc(column))
    return counts.limit(top) if top else counts


def key_history(df: DataFrame, key: str, period: Sequence[str], label: str, top: int) -> DataFrame:
    """Label sums per (period, key) of the ``top`` keys that hold the largest single sums."""
    sums = materialize(known_keys(df, [*period, key]).groupBy(*period, key).agg(F.sum(label).alias("label_sum")))
    ranked = sums.orderBy(F.desc("label_sum"), *[F.asc(p) for p in period], F.asc(key)).limit(top)
    # At most ``top`` keys; attach measures them before it sends them anywhere.
    listed = ranked.select(key).distinct().withColumn("__listed", F.lit(True))
    return attach(sums, listed, key).where(F.col("__listed")).drop("__listed")


def resample_days(df: DataFrame, moment: str, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Daily mean, sum and row count on a gap-free calendar; an empty day has null means, zero sums and zero counts."""
    days = df.withColumn("__day", F.col(moment).cast("date"))
    daily = days.groupBy(*within, "__day").agg(
        *[F.avg(_known(df, c)).alias(f"{c}_mean") for c in columns],
        *[F.sum(_known(df, c)).alias(f"{c}_sum") for c in columns],
        F.count(F.lit(1)).alias("n"),
    )
    daily = materialize(daily)
    spans = daily.groupBy(*within).agg(F.min("__day").alias("__from"), F.max("__day").alias("__to"))
    calendar = spans.select(*within, F.explode(F.sequence("__from", "__to", F.expr("interval 1 day"))).alias("__day"))
    filled = calendar.join(daily, [*within, "__day"], "left")
    return filled.select(
        *within, F.col("__day").cast("string").alias("day"),
        *[F.col(f"{c}_mean") for c in columns],
        *[F.coalesce(f"{c}_sum", F.lit(0)).alias(f"{c}_sum") for c in columns],
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def resample_months(df: DataFrame, moment: str, columns: Sequence[str]) -> DataFrame:
    """Monthly means on a gap-free calendar, keyed by ``yyyy-MM``."""
    months = df.withColumn("__month", F.trunc(F.col(moment).cast("date"), "month"))
    monthly = materialize(months.groupBy("__month").agg(*[F.avg(_known(df, c)).alias(f"{c}_mean") for c in columns]))
    span = monthly.agg(F.min("__month").alias("__from"), F.max("__month").alias("__to"))
    calendar = span.select(F.explode(F.sequence("__from", "__to", F.expr("interval 1 month"))).alias("__month"))
    return calendar.join(monthly, "__month", "left").select(
        F.date_format("__month", "yyyy-MM").alias("month"), *[f"{c}_mean" for c in columns]
    )


# Numbers that one pass may hold per task for the products of column pairs; wider tables take several passes.
PAIR_CELLS = 8_000_000


def correlations(df: DataFrame, columns: Sequence[str], against: str | None = None) -> DataFrame:
    """Pearson correlation ``a, b, r`` of column pairs (or of all columns with one), over rows where both are present.

    Tasks add up counts, sums and products of all pairs at once, as blocks of a matrix; Spark deals the blocks out by their
    first column and adds them. Columns are shifted and scaled first, so large numbers lose no digits. ``r`` is null
    where fewer than two rows have both or one of the two does not vary there.
    """
    firsts, seconds = ([c for c in columns if c != against], [against]) if against else (list(columns[:-1]), list(columns))
    names = list(dict.fromkeys([*firsts, *seconds]))
    numbers = df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS c{i}" for i, c in enumerate(names)])
    moments = {r["at"]: (r["mean"] or 0.0, r["std"] or 1.0) for r in column_moments(numbers).collect()}  # one row per column
    shift, scale = (np.array([moments[i][k] for i in range(len(names))]) for k in (0, 1))
    right = [names.index(c) for c in seconds]
    step = max(1, PAIR_CELLS // (6 * len(right)))
    parts = [_pair_products(numbers, shift, scale, names, [names.index(c) for c in firsts[i : i + step]], right, not against) for i in range(0, len(firsts), step)]
    return reduce(DataFrame.unionByName, parts)


def _pair_products(
    numbers: DataFrame, shift: np.ndarray, scale: np.ndarray, names: list[str], left: list[int], right: list[int], upward: bool
) -> DataFrame:
    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(left), len(right)))
        for batch in batches:
            x = (batch.to_numpy(np.float64, na_value=np.nan) - shift) / scale
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(np.float64)
            a, b, ha, hb = x[:, left], x[:, right], there[:, left], there[:, right]
            total += np.stack([ha.T @ hb, a.T @ hb, ha.T @ b, (a * a).T @ hb, ha.T @ (b * b), a.T @ b])
        yield pd.DataFrame({"a": left, "sums": [np.ascontiguousarray(total[:, i]).tobytes() for i in range(len(left))]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for a, packed in zip(batch["a"], batch["sums"]):
                found = np.frombuffer(packed, np.float64).reshape(6, len(right)) if packed is not None else np.zeros((6, len(right)))
                sums[a] = sums[a] + found if a in sums else found
        for a, (n, sa, sb, qa, qb, p) in sums.items():
            va, vb = n * qa - sa * sa, n * qb - sb * sb
            known = (n > 1) & (va > 1e-12 * n * qa) & (vb > 1e-12 * n * qb)
            r = np.full(len(right), np.nan)
            r[known] = ((n * p - sa * sb)[known] / np.sqrt(va[known] * vb[known])).clip(-1.0, 1.0)
            keep = [i for i, b in enumerate(right) if not upward or b > a]
            yield pd.DataFrame({"a": names[a], "b": [names[right[i]] for i in keep], "r": r[keep]})

    # A table without any task still has all its pairs.
    least = numbers.sparkSession.createDataFrame([(a, None) for a in left], "a int, sums binary")
    products = numbers.mapInPandas(multiplied, "a int, sums binary").union(least).repartition("a")
    return products.mapInPandas(added, "a string, b string, r double").withColumn("r", nan_to_null("r"))


def category_target_table(
    train: DataFrame, test: DataFrame, category: str, label: str, sort: str | None = None, missing: str | None = None
) -> DataFrame:
    """Per category: label mean, labelled rows and train frequency, with the test frequency beside them.

    Frequencies are shares of all train rows and of the test rows with a category. ``missing`` shows the null category
    under that name; without it null is left out. ``sort`` orders the table by ``alphabetic`` category or by falling
    ``freq``. Either table is read once.
    """
    shown = F.coalesce(F.col(category).cast("string"), F.lit(missing)) if missing is not None else F.col(category)
    sides = train.select(shown.alias(category), F.col(label).alias("__y"), F.lit(True).alias("__train")).unionByName(
        test.select(shown.alias(category), F.lit(None).cast(train.schema[label].dataType).alias("__y"), F.lit(False).alias("__train")))
    counts = materialize(sides.groupBy(category).agg(
        F.avg("__y").alias("target_mean"), F.count("__y").alias("n_train"),
        F.count_if("__train").alias("__all"), F.count_if(~F.col("__train")).alias("__test"),
    ))
    totals = counts.agg(F.sum("__all"), F.sum(F.when(F.col(category).isNotNull(), F.col("__test")))).first()
    known = counts.where(F.col(category).isNotNull())
    table = known.select(
        category, "target_mean", F.when(F.col("__all") > 0, F.col("n_train")).alias("n_train"),
        F.when(F.col("__all") > 0, F.col("n_train") / F.lit(totals[0] or 1)).alias("freq_train"),
        F.when(F.col("__test") > 0, F.col("__test") / F.lit(totals[1] or 1)).alias("freq_test"),
    )
    return sort_categories(table, sort, category, "freq_train")


def sort_categories(df: DataFrame, sort: str | None, category: str, frequency: str) -> DataFrame:
    """Order a table of categories by name, by falling frequency, or not at all."""
    if sort is None:
        return df
    orders = {"alphabetic": [F.asc(category)], "freq": [F.desc_nulls_last(frequency), F.asc(category)]}
    return df.orderBy(*orders[sort])
