"""Stored encoders: fits add up, unseen values, versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from featurekit.operators import stored
from featurekit.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(300).select(
        "id", F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("k"), F.when(F.col("id") % 11 != 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("s"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 2).alias("y")).cache()


def test_fits_of_parts_add_up_to_the_fit_of_all(spark, rows):
    whole = stored.fit_values(rows, ["k", "s"], "y")
    parts = stored.merge(*[stored.fit_values(rows.where(F.col("id") % 3 == i), ["k", "s"], "y") for i in range(3)])
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    path = scratch_path(spark, "fits")
    stored.save(parts, path, "a")
    assert sorted(map(str, stored.load(spark, path, "a").collect())) == sorted(map(str, whole.collect()))
    with pytest.raises(Exception, match="(?i)exists"):
        stored.save(parts, path, "a")


def test_values_that_were_not_fitted(spark, rows):
    fit = stored.fit_values(rows.where("s <> 'v2' OR s IS NULL"), ["k", "s"], "y")
    made = {r.s: r for r in stored.encode(spark.createDataFrame([("v1",), ("v2",), (None,)], "s string"), fit, ["s"], stored.KINDS).collect()}
    pdf = rows.where("s <> 'v2' OR s IS NULL").toPandas()
    for value, part in (("v1", pdf[pdf.s == "v1"]), (None, pdf[pdf.s.isna()])):
        r = made[value]
        assert (r.s_count, r.s_frequency, r.s_target_mean) == pytest.approx((len(part), len(part) / len(pdf), part.y.mean()))
    assert (made["v2"].s_count, made["v2"].s_frequency, made["v2"].s_target_mean) == (0, 0.0, None)
    with pytest.raises(LookupError):
        stored.encode(rows, fit.where("column = 'k'"), ["s"])
    with pytest.raises(ValueError):
        stored.encode(rows, fit, ["k"], ["ordinal"])
