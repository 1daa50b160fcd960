"""Dictionary joins: broadcast and shuffled ways give the same rows, and hot keys do not fill one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from featurekit.operators.lookup import (
    WEIGHT,
    BroadcastLimit,
    attach,
    left_join,
    lookup_join,
    measure,
    membership,
    store,
    with_row_id,
)
from featurekit.session import scratch_path

NEVER = BroadcastLimit(0, 0)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 7, a third have a null key, the rest spread over 50 keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 50 + 100)
    return with_row_id(spark.range(3000).withColumn("key", key.cast("bigint")), "id")


def _rows(df):
    return sorted(df.collect(), key=lambda r: r["id"])


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("null_in_dictionary", [False, True])
def test_shuffled_join_equals_broadcast_join(skewed, weighted, null_in_dictionary):
    source = skewed if null_in_dictionary else skewed.where("key is not null")
    dictionary = source.where("key is null or key != 120").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
    if weighted:
        dictionary = dictionary.withColumn(WEIGHT, F.col("n"))
    small = _rows(attach(skewed, dictionary, "key"))
    large = _rows(attach(skewed, dictionary, "key", limit=NEVER, hot_share=0.1))
    assert small == large
    assert len(small) == 3000
    assert all((r["n"] is None) == (r["key"] == 120 or (r["key"] is None and not null_in_dictionary)) for r in small)


def test_value_that_is_null_in_the_dictionary_stays_null(skewed):
    dictionary = skewed.where("key is not null").groupBy("key").agg(F.max(F.when(F.col("key") != 7, F.col("id"))).alias("v"))
    rows = _rows(attach(skewed, dictionary, "key", limit=NEVER, hot_share=0.1))
    assert rows == _rows(attach(skewed, dictionary, "key"))
    assert all(r["v"] is None for r in rows if r["key"] == 7)


def test_hot_and_null_keys_are_spread_over_tasks(spark, skewed):
    dictionary = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("key is not null")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = attach(skewed, dictionary, "key", limit=NEVER, hot_share=0.1)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 3000
    assert len(sizes) == 8
    assert max(sizes) < 2 * 3000 / 8


def test_several_key_columns_of_other_types(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", -0.0), (3, None, 0.0), (4, "b", None)], "id bigint, s string, x double")
    dictionary = spark.createDataFrame([("a", 0.0, 10), (None, 0.0, 20), ("b", None, 30)], "s string, x double, v int")
    expected = {1: None, 2: 10, 3: 20, 4: 30}
    for limit in (None, NEVER):
        assert {r["id"]: r["v"] for r in attach(df, dictionary, ["s", "x"], limit=limit).collect()} == expected


def test_stored_size_equals_measured_size(skewed):
    dictionary = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn(WEIGHT, F.col("n"))
    stored, size = store(dictionary, ["key"])
    assert size == measure(stored, ["key"])
    assert (size.rows, size.null_keys, size.weight) == (stored.count(), 1, 3000)


def test_small_dictionary_is_broadcast(skewed):
    dictionary = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    plan = attach(skewed, dictionary, "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_lookup_join_with_a_stored_table(spark, skewed, tmp_path):
    path = str(tmp_path / "names")
    skewed.select("key").where("key is not null").distinct().withColumn("name", F.concat(F.lit("k"), "key")).write.parquet(path)
    small = _rows(lookup_join(skewed, spark.read.parquet(path), "key").select("id", "key", "name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        measured = _rows(lookup_join(skewed, spark.read.parquet(path), "key").select("id", "key", "name"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert small == measured
    assert small[0]["name"] == "k7"


def test_left_join_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, v string")
    right = spark.createDataFrame([(1, 1)], "id bigint, had_id int")
    assert {r["id"]: r["had_id"] for r in left_join(left, right, "id").collect()} == {1: 1, 2: None}


def test_membership(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, k string")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r["id"] for r in membership(df, listed, "k").collect()] == [1]
    assert sorted(r["id"] for r in membership(df, listed, "k", negate=True).collect()) == [2, 3]


def test_empty_dictionary_and_empty_rows(spark, skewed, tmp_path):
    path = str(tmp_path / "rows")
    skewed.write.parquet(path)
    rows = spark.read.parquet(path)
    nothing = rows.where("id < 0").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    for limit in (None, NEVER):
        assert attach(rows, nothing, "key", limit=limit).where("n is null").count() == 3000
        dictionary = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        assert attach(rows.where("id < 0"), dictionary, "key", limit=limit).count() == 0
    assert store(nothing, ["key"])[1].rows == 0


def test_stored_table_joins_alike_at_every_size(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, None)], "id int, k string")
    path = scratch_path(spark, "stored")
    spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", 3.0)], "k string, v double").write.parquet(path)
    found = []
    for limit in ("10485760", "-1"):
        kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            joined = lookup_join(left, spark.read.parquet(path), "k")
            found.append((joined.columns, sorted(joined.collect())))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert found[0] == found[1] and found[0][0] == ["id", "k", "v"]
    assert {r["id"]: r["v"] for r in found[0][1]} == {1: 1.0, 2: 2.0, 3: None, 4: 2.0}
