"""Queries on encoders that learn a dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import encoders, stored
from featurekit.plans.registry import TX, query, rounded, table, transactions
from featurekit.session import scratch_path

MANY = [
    "card", "priority", "o_orderstatus", "c_nationkey", "c_mktsegment", "c_acctbal", "period", "dataset", "o_totalprice", "y",
]


@query(f"""WITH {TX} SELECT o_orderkey, count(*) OVER (PARTITION BY card) AS card_count_full,
    count(*) OVER (PARTITION BY priority) AS priority_count_full FROM tx""")
def count_enc_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoders.count_encode(transactions(spark, sf_dir), ["card", "priority"])
    return encoded.select("o_orderkey", "card_count_full", "priority_count_full")


@query(f"""WITH {TX} SELECT o_orderkey, count(*) OVER (PARTITION BY dataset, card) AS card_count_dist,
    count(*) OVER (PARTITION BY dataset, priority) AS priority_count_dist FROM tx""")
def count_enc_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoders.count_encode(transactions(spark, sf_dir), ["card", "priority"], ["dataset"], "_count_dist")
    return encoded.select("o_orderkey", "card_count_dist", "priority_count_dist")


@query(f"""WITH {TX} SELECT o_orderkey, {', '.join(f'count(*) OVER (PARTITION BY {c}) AS "{c}_CE"' for c in MANY)} FROM tx""")
def count_enc_nullfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoders.count_encode(transactions(spark, sf_dir, customer=True), MANY, suffix="_CE")
    return encoded.select("o_orderkey", *[f"{c}_CE" for c in MANY])


@query(f"""WITH {TX} SELECT o_orderkey, CASE WHEN card IS NOT NULL THEN count(*) OVER (PARTITION BY card) END AS card__fq_enc,
    CASE WHEN priority IS NOT NULL THEN count(*) OVER (PARTITION BY priority) END AS priority__fq_enc FROM tx""")
def freq_enc_nullkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoders.count_encode(transactions(spark, sf_dir), ["card", "priority"], suffix="__fq_enc", nulls=False)
    return encoded.select("o_orderkey", "card__fq_enc", "priority__fq_enc")


@query(f"""WITH {TX}, frequent AS (SELECT o_custkey FROM tx WHERE dataset = 'train' GROUP BY o_custkey HAVING count(*) > 10)
  SELECT o_orderkey, dataset, CASE WHEN o_custkey IN (SELECT o_custkey FROM frequent) THEN o_custkey END AS o_custkey FROM tx""")
def rare_value_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = encoders.null_rare(transactions(spark, sf_dir), "o_custkey", F.col("dataset") == "train", above=10)
    return kept.select("o_orderkey", "dataset", "o_custkey")


@query("""WITH p AS (SELECT p_partkey, p_type, NULLIF(p_name, 'red ring') AS name FROM part),
  c AS (SELECT *, count(*) OVER (PARTITION BY p_type, name) AS n FROM p)
  SELECT p_partkey, p_type, CASE WHEN name IS NULL THEN NULL WHEN n < 6 THEN 'Others' ELSE name END AS name FROM c""")
def rare_value_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.nullif(F.col("p_name"), F.lit("red ring")).alias("name")
    )
    return encoders.bucket_rare(part, "name", below=6, within=["p_type"])


@query(f"""WITH {TX} SELECT o_orderkey, dense_rank() OVER (ORDER BY coalesce(priority, 'nan')) - 1 AS priority_code,
    dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS c_mktsegment_code,
    dense_rank() OVER (ORDER BY coalesce(CAST(card AS VARCHAR), 'nan')) - 1 AS card_code FROM tx""")
def label_encode_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoders.label_encode(transactions(spark, sf_dir, customer=True), ["priority", "c_mktsegment", "card"])
    return encoded.select("o_orderkey", "priority_code", "c_mktsegment_code", "card_code")


@query(f"""WITH {TX} SELECT o_orderkey,
    dense_rank() OVER (ORDER BY coalesce(CAST(card AS VARCHAR), 'nan') || '_' || coalesce(priority, 'nan')) - 1 AS card__priority,
    dense_rank() OVER (ORDER BY CAST(c_nationkey AS VARCHAR) || '_' || CAST(o_custkey AS VARCHAR)) - 1 AS c_nationkey__o_custkey
  FROM tx""")
def pair_interaction_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, customer=True)
    encoded = encoders.pair_codes(tx, [("card", "priority"), ("c_nationkey", "o_custkey")])
    return encoded.select("o_orderkey", "card__priority", "c_nationkey__o_custkey")


@query(f"""WITH {TX}, a AS (SELECT card, avg(y) AS m FROM tx WHERE dataset = 'train' AND card IS NOT NULL GROUP BY card),
  b AS (SELECT priority, avg(y) AS m FROM tx WHERE dataset = 'train' AND priority IS NOT NULL GROUP BY priority)
  SELECT o_orderkey, round(a.m, 9) AS card__target_mean, round(b.m, 9) AS priority__target_mean
  FROM tx LEFT JOIN a ON a.card = tx.card LEFT JOIN b ON b.priority = tx.priority""")
def target_mean_enc(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoders.target_mean_encode(
        transactions(spark, sf_dir), ["card", "priority"], "y", F.col("dataset") == "train"
    )
    return encoded.select("o_orderkey", rounded("card__target_mean", 9), rounded("priority__target_mean", 9))


_STORED = ["o_custkey", "priority", "c_nationkey"]


def _stored_sql() -> str:
    fits = ", ".join(
        f"f_{c} AS (SELECT {c} AS v, count(*) AS n, avg(y) AS m FROM tx WHERE dataset = 'train' GROUP BY ALL)" for c in _STORED)
    cells = ", ".join(
        f"coalesce(f_{c}.n, 0) AS {c}_count, round(coalesce(f_{c}.n / (SELECT count(*) FROM tx WHERE dataset = 'train')::DOUBLE, 0), 9) AS {c}_frequency,"
        f" round(f_{c}.m, 9) AS {c}_target_mean" for c in _STORED)
    joins = " ".join(f"LEFT JOIN f_{c} ON f_{c}.v IS NOT DISTINCT FROM tx.{c}" for c in _STORED)
    return f"WITH {TX}, {fits} SELECT o_orderkey, {cells} FROM tx {joins} WHERE dataset = 'test'"


@query(_stored_sql())
def stored_encoders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoders fitted on two halves of the train rows, merged, stored, loaded again and applied to the test rows."""
    rows, path = transactions(spark, sf_dir, customer=True), scratch_path(spark, "encoders")
    halves = [rows.where((F.col("dataset") == "train") & (F.col("o_orderkey") % 2 == i)) for i in (0, 1)]
    stored.save(stored.merge(*[stored.fit_values(h, _STORED, "y") for h in halves]), path, "1")
    test = rows.where(F.col("dataset") == "test")
    made = stored.encode(test, stored.load(spark, path, "1"), _STORED, stored.KINDS)
    names = [f"{c}_{k}" for c in _STORED for k in stored.KINDS]
    return made.select("o_orderkey", *[n if n.endswith("_count") else rounded(n, 9) for n in names])
