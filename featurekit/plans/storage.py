"""Queries that write a table and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import columns, encoders, groups, splits
from featurekit.operators.lookup import left_join
from featurekit.plans.registry import TX, query, rounded, table, transactions
from featurekit.session import scratch_path
from featurekit.sources import files
from featurekit.sources.catalog import FeatureCatalog


@query("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns through CSV; the moment is shown as text, which every engine writes alike."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders.csv")
    files.write_csv(orders, path)
    back = files.read_csv(spark, path, orders.schema)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query(f"""WITH {TX}, s AS (SELECT dataset, o_custkey, avg(o_totalprice) AS m FROM tx GROUP BY ALL)
  SELECT o_orderkey, y, count(*) OVER (PARTITION BY card) AS "f103__card_count_full",
    round(o_totalprice / s.m, 6) AS "f101__o_totalprice_to_mean_o_custkey"
  FROM tx JOIN s ON s.dataset = tx.dataset AND s.o_custkey = tx.o_custkey""")
def feature_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = FeatureCatalog(spark, scratch_path(spark, "features"), key="o_orderkey")
    tx = transactions(spark, sf_dir)

    @catalog.feature("f101", "amount_ratio")
    def amount_ratio(df: DataFrame) -> DataFrame:
        ratios = groups.group_ratios(df, ["o_totalprice"], ["o_custkey"], ["dataset"], ["mean"])
        return ratios.select("o_orderkey", "dataset", rounded("o_totalprice_to_mean_o_custkey"))

    @catalog.feature("f103", "counts")
    def counts(df: DataFrame) -> DataFrame:
        return encoders.count_encode(df, ["card"]).select("o_orderkey", "dataset", "card_count_full")

    amount_ratio(tx)
    counts(tx)
    return catalog.attach(tx.select("o_orderkey", "y"), ["f101", "f103"])


@query(f"""WITH {TX} SELECT o_orderkey, o_totalprice, CASE WHEN period < 60 THEN 'train' ELSE 'valid' END AS role FROM tx WHERE period <= 60""")
def split_membership_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, path = transactions(spark, sf_dir), scratch_path(spark, "split")
    files.write_split(splits.period_holdout(tx, "o_orderkey", "period", 60), path)
    return files.read_split(spark, path, tx.select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(f"""WITH {TX} SELECT o_orderkey, dataset, ('0x' || substr(md5(o_orderkey || '|' || CASE dataset WHEN 'train' THEN 1 ELSE 2 END), 1, 8))::BIGINT
    / 4294967296.0::DOUBLE AS pseudo_label FROM tx""")
def oof_join_pseudo_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored out-of-fold scores for train rows and a stored submission for test rows become one column."""
    tx = transactions(spark, sf_dir)
    scale = F.lit(4294967296.0).cast("double")
    train = tx.where(F.col("dataset") == "train").select("o_orderkey", "y", (splits.shuffle_hash("o_orderkey", 1) / scale).alias("score"))
    test = tx.where(F.col("dataset") == "test").select("o_orderkey", (splits.shuffle_hash("o_orderkey", 2) / scale).alias("score"))
    oof_path, submission_path = scratch_path(spark, "oof"), scratch_path(spark, "submission.csv")
    files.write_predictions(train, oof_path)
    files.write_submission(test, submission_path, key="o_orderkey")
    submission = files.read_csv(spark, submission_path, "TransactionID bigint, isFraud double")
    scores = files.read_table(spark, oof_path).select("o_orderkey", F.col("score").alias("pseudo_label")).unionByName(
        submission.select(F.col("TransactionID").alias("o_orderkey"), F.col("isFraud").alias("pseudo_label"))
    )
    return left_join(tx.select("o_orderkey", "dataset"), scores, "o_orderkey")


@query(f"""WITH {TX} SELECT o_orderkey, o_totalprice, y, card FROM tx WHERE (SELECT count(*) FROM orders) = (SELECT count(*) FROM tx)""")
def remove_list_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored list names the columns to drop; those containing "card" are kept all the same."""
    tx, path = transactions(spark, sf_dir), scratch_path(spark, "removed")
    listed = [c for c in tx.columns if c not in ("o_orderkey", "o_totalprice", "y")]
    files.write_table(spark.createDataFrame([(c,) for c in listed], "features_to_remove string"), path)
    removed = files.removed_columns(files.read_table(spark, path), keep_with="card")
    return tx.select(*columns.feature_columns(tx, removed, excluded=()))
