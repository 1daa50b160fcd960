"""Connected components of a distributed list of links, by repeated random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Give every node that occurs in ``links`` (a, b: long) the root of its component, as (node, root).

    Every round each node hooks on to the neighbour of lowest random priority, if that is lower than its own, and
    the links are renamed and made distinct. A constant share of the nodes goes away per round, so the number of
    rounds is logarithmic even for long chains. Hubs are no trouble: the minimum is combined before the shuffle and
    the renaming joins are plain equi-joins that adaptive execution splits. Rounds are cut by reliable checkpoints.
    An empty list gives no rows.
    """
    current = materialize(
        links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    found: DataFrame | None = None
    salt = 0
    while not current.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(salt), c).alias("p"), F.col(c).alias("n"))  # noqa: B023, E731
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(
            both.groupBy("a").agg(F.min(rank("b")).alias("low"))
            .select(F.col("a").alias("node"), F.least(F.col("low"), rank("a"))["n"].alias("root"))
        )
        names = [hooks.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
        renamed = current.join(names[0], "a").join(names[1], "b").where(F.col("a_root") != F.col("b_root"))
        current = materialize(
            renamed.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
        )
        if found is None:
            found = hooks
        else:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = materialize(found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        salt += 1
    if found is None:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
