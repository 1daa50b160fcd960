"""Statistics of earlier periods attached to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurekit.operators.groups import FUNCTIONS, group_stats, known_keys
from featurekit.operators.lookup import WEIGHT, attach, store
from featurekit.operators.ordering import ordinals
from featurekit.session import materialize


def key_lags(
    df: DataFrame, key: str, period: str, lags: Sequence[int], share: bool = False, prefix: str | None = None
) -> DataFrame:
    """Add ``{prefix}__lag{n}``: rows (or share of the period's rows) that the key had ``n`` periods earlier.

    0 when the key had none although the period has data; null when the period has no data or the key is null.
    All lags are computed on the counts, so the rows are joined once.
    """
    prefix = prefix or f"{key}_counts"
    names = [f"{prefix}__lag{n}" for n in lags]
    counts = materialize(known_keys(df, [key, period]).groupBy(key, period).agg(F.count(F.lit(1)).alias("__n")))
    periods, size = store(counts.groupBy(period).agg(F.sum("__n").alias("__total")), [period])
    if share:
        measured = attach(counts, periods, period, size=size).withColumn("__value", F.col("__n") / F.col("__total"))
        zero = F.lit(0.0)
    else:
        measured = counts.withColumn("__value", F.col("__n"))
        zero = F.lit(0).cast("bigint")

    # A key has at most one row per period here, and a frame of one offset picks the row of that period.
    along = Window.partitionBy(key).orderBy(period)
    lagged = measured.select(
        key, period, F.col("__n").alias(WEIGHT), *[F.sum("__value").over(along.rangeBetween(-n, -n)).alias(c) for n, c in zip(lags, names)]
    )
    reached = (
        periods.select(F.explode(F.array(*[F.lit(n) for n in lags])).alias("__lag"), period)
        .select("__lag", (F.col(period) + F.col("__lag")).cast(df.schema[period].dataType).alias(period))
        .groupBy(period)
        .agg(*[F.max(F.col("__lag") == n).alias(f"__has{n}") for n in lags])
    )
    marked = attach(lagged, reached, period)
    filled = marked.select(
        key, period, WEIGHT, *[F.when(F.col(f"__has{n}"), F.coalesce(F.col(c), zero)).alias(c) for n, c in zip(lags, names)]
    )
    return attach(df, filled, [key, period])


def period_lags(
    df: DataFrame,
    period: str,
    columns: Sequence[str],
    functions: Sequence[str],
    lags: Sequence[int],
    fit: Column | None = None,
    extra: int = 0,
) -> DataFrame:
    """Add ``{column}_{function}__lag{n}``: the statistic ``n`` rows up in the list of periods.

    ``fit`` limits the rows the statistics are learnt from; periods outside that list get null.
    ``extra`` moves every lag but 0 that many periods further down.
    """
    source = df if fit is None else df.where(fit)
    stats = group_stats(source, period, columns, functions)
    names = [c for c in stats.columns if c != period]
    numbered = ordinals(stats, [period], name="__row")
    later = [n for n in lags if n > 0]

    # Every row of the list is sent to the places further down that look back at it.
    moved = numbered.select(F.explode(F.array(*[F.lit(n) for n in later])).alias("__lag"), "__row", *names)
    shifted = moved.groupBy((F.col("__row") + F.col("__lag")).alias("__row")).agg(
        *[F.max(F.when(F.col("__lag") == n, F.col(c))).alias(f"{c}__lag{n}") for n in later for c in names]
    )
    here = numbered.select(period, "__row", *[F.col(c).alias(f"{c}__lag0") for c in names if 0 in lags])
    if not extra:
        return attach(df, here.join(shifted, "__row", "left").drop("__row"), period)
    later_period = (F.col(period) + extra).cast(df.schema[period].dataType).alias(period)
    later_stats = numbered.select("__row", later_period).join(shifted, "__row", "left").drop("__row")
    df = attach(df, here.drop("__row"), period) if 0 in lags else df
    return attach(df, later_stats, period)


def target_lags(
    df: DataFrame,
    period: str,
    keys: Sequence[str],
    label: str,
    lags: Sequence[int],
    functions: Sequence[str] = ("mean", "std"),
    fit: Column | None = None,
    include_label: bool = False,
) -> DataFrame:
    """Add ``{label}_{function}__lag{n}``: label statistics of the same key values exactly ``n`` periods earlier.

    ``include_label`` also puts the label itself among the key columns.
    """
    keys = [*keys, label] if include_label else list(keys)
    source = df if fit is None else df.where(fit)
    stats = known_keys(source, [period, *keys]).groupBy(period, *keys).agg(
        *[FUNCTIONS[f](label).alias(f"__{f}") for f in functions]
    )
    # Every statistic is sent to the periods that look back at it, so one join serves all lags.
    moved = stats.select(
        F.explode(F.array(*[F.lit(n) for n in lags])).alias("__lag"), *keys, *[f"__{f}" for f in functions], period
    ).withColumn(period, (F.col(period) + F.col("__lag")).cast(df.schema[period].dataType))
    dictionary = moved.groupBy(period, *keys).agg(
        *[F.max(F.when(F.col("__lag") == n, F.col(f"__{f}"))).alias(f"{label}_{f}__lag{n}") for n in lags for f in functions]
    )
    return attach(df, dictionary, [period, *keys])
