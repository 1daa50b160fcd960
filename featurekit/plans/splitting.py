"""Queries on validation splits and repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featurekit.operators import splits
from featurekit.plans.registry import TX, query, table, transactions


def _hash(seed: int = 42) -> str:
    return f"('0x' || substr(md5(o_orderkey || '|{seed}'), 1, 8))::BIGINT"


@query(f"SELECT o_orderkey, CAST({_hash()} % 5 AS INTEGER) AS fold FROM orders")
def kfold_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.kfold(table(spark, sf_dir, "orders"), "o_orderkey", 5)


@query(f"""WITH {TX} SELECT o_orderkey, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {_hash()}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM tx""")
def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_kfold(transactions(spark, sf_dir), "o_orderkey", "y", 5)


CHUNKS = """n AS (SELECT count(*) AS n, count(*) // 6 AS size FROM orders),
  c AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS o FROM orders),
  chunks AS (SELECT o_orderkey, CAST(CASE WHEN o < n - 5 * size THEN 0 ELSE (o - (n - 5 * size)) // size + 1 END AS INTEGER) AS chunk
    FROM c CROSS JOIN n)"""


@query(f"WITH {CHUNKS} SELECT o_orderkey, chunk FROM chunks")
def ts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.time_series_folds(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate", 5)


@query(f"""WITH {CHUNKS}, f AS (SELECT unnest([4, 5]) AS fold)
  SELECT o_orderkey, fold, CASE WHEN chunk = fold THEN 'valid' ELSE 'train' END AS role FROM chunks JOIN f ON chunk <= fold""")
def ts_split_last_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = splits.time_series_folds(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate", 5)
    return splits.time_series_roles(chunks, 5, last=2)


@query("""WITH c AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS o FROM orders),
  n AS (SELECT count(*) // 7 AS size, count(*) % 7 AS larger FROM orders)
  SELECT o_orderkey, CAST(CASE WHEN o < larger * (size + 1) THEN o // (size + 1) ELSE (o - larger * (size + 1)) // size + larger END AS INTEGER) AS fold
  FROM c CROSS JOIN n""")
def ordered_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.ordered_kfold(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate", 7)


@query(f"""WITH {TX} SELECT o_orderkey, CASE WHEN period < 60 THEN 'train' ELSE 'valid' END AS role FROM tx WHERE period <= 60""")
def period_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.period_holdout(transactions(spark, sf_dir), "o_orderkey", "period", 60)


@query(f"""WITH {TX} SELECT o_orderkey, CASE WHEN period < 60 THEN 'train' ELSE 'valid' END AS role FROM tx""")
def period_holdout_open_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.period_holdout(transactions(spark, sf_dir), "o_orderkey", "period", 60, open_end=True)


@query(f"""WITH {TX} SELECT o_orderkey, CASE WHEN period < 60 THEN 'train' ELSE 'valid' END AS role,
    CASE WHEN period < 60 THEN CAST({_hash()} % 5 AS INTEGER) END AS fold FROM tx WHERE period <= 60""")
def holdout_plus_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.holdout_with_kfold(transactions(spark, sf_dir), "o_orderkey", "period", 60, 5)


@query(f"""WITH {TX}, r AS (SELECT o_orderkey, y, row_number() OVER (PARTITION BY y ORDER BY {_hash()}, o_orderkey) AS o,
    count(*) OVER (PARTITION BY y) AS n FROM tx)
  SELECT o_orderkey, y, CASE WHEN o <= floor(n * 0.33::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS role FROM r""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_holdout(transactions(spark, sf_dir), "o_orderkey", "y", 0.33)


@query(f"""SELECT o_orderkey, row_number() OVER (ORDER BY {_hash()}, o_orderkey) - 1 AS position FROM orders""")
def shuffle_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.shuffled(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
