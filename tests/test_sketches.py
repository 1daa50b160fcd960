"""Mergeable sketches: error bounds, merging, missing values."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from featurekit.operators import sketches as k


def test_errors_stay_below_their_bounds_after_merging(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 20).alias("day"), F.pow(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000, F.lit(2.0)).alias("x"),
        F.when(F.col("id") % 3 != 0, F.pmod(F.xxhash64(F.col("id") + 1), F.lit(9000))).alias("key"))
    daily = k.column_sketches(rows, ["x"], ["key", "x"], ["day"])
    assert daily.count() == 40
    both = {r["column"]: r for r in k.distinct_counts(k.quantiles(k.merged(daily.where("day < 15")), k.SHARES)).collect()}
    pdf = rows.where("day < 15").toPandas()
    x = np.sort(pdf["x"])
    for share, value in zip(k.SHARES, both["x"]["values"]):
        assert abs(np.searchsorted(x, value, "right") / len(x) - share) < 0.01
    assert both["x"].n == len(x) and both["key"]["values"] is None and both["key"].n == pdf["key"].count()
    assert abs(both["key"].uniques / pdf["key"].nunique() - 1) < 0.05 and abs(both["x"].uniques / pdf["x"].nunique() - 1) < 0.05


def test_missing_values_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, None), (1, float("nan"), None), (2, 5.0, "a"), (2, 5.0, "b")], "p int, x double, s string")
    made = {(r.p, r["column"]): r for r in k.distinct_counts(k.quantiles(k.column_sketches(rows, ["x"], ["s"], ["p"]), [0.5])).collect()}
    assert set(made) == {(2, "x"), (2, "s")}
    assert (made[2, "x"]["values"], made[2, "x"].uniques, made[2, "s"].uniques) == ([5.0], None, 2)
    assert k.merged(k.column_sketches(rows.limit(0), ["x"], ["s"])).count() == 0
