"""Global order over several range partitions, compared with sorting in memory."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from featurekit.operators.ordering import dense_codes, ordinals, running_sums


@pytest.fixture
def many_ranges(spark):
    """Keep all shuffle partitions, so that the order really crosses task borders."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(100)).alias("t"), F.pmod(F.xxhash64(F.col("id") + 1), F.lit(3)).alias("g")
    ).withColumn("g", F.nullif("g", F.lit(2)))


def test_ordinals(many_ranges, rows):
    expected = {r["id"]: i for i, r in enumerate(sorted(rows.collect(), key=lambda r: (r["t"], r["id"])))}
    assert {r["id"]: r["ordinal"] for r in ordinals(rows, ["t", "id"]).collect()} == expected


def test_ordinals_inside_groups_with_a_null_group(many_ranges, rows):
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r["g"]].append((r["t"], r["id"]))
    expected = {i: n for members in groups.values() for n, (_, i) in enumerate(sorted(members))}
    assert {r["id"]: r["ordinal"] for r in ordinals(rows, ["t", "id"], ["g"]).collect()} == expected


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_sums(many_ranges, rows, group):
    keyed = rows.where("g is not null").groupBy(*group, "t").agg(F.count(F.lit(1)).alias("n"))
    seen, totals, expected = defaultdict(int), defaultdict(int), {}
    for r in sorted(keyed.collect(), key=lambda r: r["t"]):
        key = tuple(r[g] for g in group)
        seen[key] += r["n"]
        totals[key] += r["n"]
        expected[(*key, r["t"])] = seen[key]
    result = running_sums(keyed, ["t"], ["n"], group).collect()
    assert {(*(r[g] for g in group), r["t"]): r["cum_n"] for r in result} == expected
    assert all(r["total_n"] == totals[tuple(r[g] for g in group)] for r in result)


def test_one_value_and_no_value(spark):
    one = spark.createDataFrame([(1, 5)], "id bigint, t bigint")
    assert [r["ordinal"] for r in ordinals(one, ["t", "id"]).collect()] == [0]
    assert ordinals(one.where("id > 1"), ["t", "id"]).collect() == []


def test_dense_codes_follow_text_order(many_ranges, spark):
    words = spark.createDataFrame([(w,) for w in ["b", "a", "a", "Z", "é", "10", "9", ""]], "w string")
    codes, size = dense_codes(words, "w")
    found = {r["w"]: r["code"] for r in codes.collect()}
    assert found == {w: i for i, w in enumerate(sorted({"b", "a", "Z", "é", "10", "9", ""}))}
    assert size.rows == 7
