"""Global order on distributed data: row ordinals, running sums and dense codes without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurekit.operators.lookup import Size, attach, store

_ROW_BITS = 33  # monotonically_increasing_id keeps the position inside a partition in the low 33 bits


def _ranged(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, Size]:
    """Rows split into ordered ranges; ``__part`` numbers the range, ``__pos`` the row inside it.

    The result is stored, because range bounds come from a sample and a second run could place rows differently.
    """
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id())
    stored, size = store(ordered, by)
    placed = stored.withColumn("__part", F.shiftright("__id", _ROW_BITS)).withColumn(
        "__pos", F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    return placed.drop("__id"), size


def _numbered(df: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, Size]:
    ranged, size = _ranged(df, order)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so this window and the broadcast are bounded by the number of shuffle partitions.
    starts = (
        ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    placed = ranged.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__pos"))
    return placed.drop("__part", "__pos", "__start"), size


def ordinals(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "ordinal") -> DataFrame:
    """Add the position (from 0) of every row in the total order ``order``, counted inside ``group``.

    ``order`` must end in a unique column for a repeatable result.
    """
    return counted_ordinals(df, order, group, name)[0]


def counted_ordinals(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "ordinal"
) -> tuple[DataFrame, int]:
    """:func:`ordinals` and the number of all rows, which are counted on the way."""
    placed, size = _numbered(df, [*group, *order], name)
    if not group:
        return placed, size.rows
    firsts = placed.groupBy(*group).agg(F.min(name).alias("__first"))
    located = attach(placed, firsts, list(group))
    return located.withColumn(name, F.col(name) - F.col("__first")).drop("__first"), size.rows


def running_sums(
    df: DataFrame, order: Sequence[str], measures: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_{measure}``, the inclusive running sum along ``order`` inside ``group``, and ``total_{measure}``.

    There must be one row per (group, order).
    """
    group = list(group)
    ranged, _ = _ranged(df, [*group, *order])
    inside = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(*group) if group else Window.partitionBy()
    before = everything.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range plus one per group.
    parts = ranged.groupBy(*group, "__part").agg(*[F.sum(m).alias(f"__t_{m}") for m in measures])
    starts = parts.select(
        *group, "__part",
        *[F.coalesce(F.sum(f"__t_{m}").over(before), F.lit(0)).alias(f"__s_{m}") for m in measures],
        *[F.sum(f"__t_{m}").over(everything).alias(f"total_{m}") for m in measures],
    )
    local = ranged.select(*df.columns, "__part", *[F.sum(m).over(inside).alias(f"__l_{m}") for m in measures])
    joined = attach(local, starts, [*group, "__part"]) if group else local.join(F.broadcast(starts), "__part")
    sums = [(F.col(f"__l_{m}") + F.col(f"__s_{m}")).alias(f"cum_{m}") for m in measures]
    return joined.select(*df.columns, *sums, *[f"total_{m}" for m in measures])


def dense_codes(values: DataFrame, column: str, name: str = "code") -> tuple[DataFrame, Size]:
    """Distinct values of a column with their position (from 0) in sorted order, and the size of that dictionary."""
    return _numbered(values.select(column).distinct(), [column], name)
