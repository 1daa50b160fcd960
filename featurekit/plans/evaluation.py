"""Queries on exact metrics and two-sample tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import metrics
from featurekit.operators.splits import shuffle_hash
from featurekit.plans.registry import TX, query, rounded, table, transactions

# AUC as the share of (positive, negative) pairs ranked rightly, from midranks.
_MIDRANK = """rank() OVER ({p} ORDER BY {s}) + (count(*) OVER (PARTITION BY {k}{s}) - 1) / 2.0::DOUBLE"""


def _auc_sql(source: str, score: str, by: str = "") -> str:
    midrank = _MIDRANK.format(p=f"PARTITION BY {by}" if by else "", s=score, k=f"{by}, " if by else "")
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""r AS (SELECT {keys}y, {midrank} AS rk FROM {source} WHERE {score} IS NOT NULL),
      t AS (SELECT {keys}sum(y)::DOUBLE AS p, count(*)::DOUBLE - sum(y) AS q, sum(CASE WHEN y = 1 THEN rk END) AS rs FROM r {group}),
      auc AS (SELECT {keys}CAST(p AS BIGINT) AS n_pos, CAST(q AS BIGINT) AS n_neg, round((rs - p * (p + 1) / 2) / NULLIF(p * q, 0), 9) AS auc FROM t)"""


ITEMS = """items AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity, l_linestatus,
  CASE WHEN l_tax > 0 THEN l_extendedprice END AS price FROM lineitem)"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity", "l_linestatus",
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("price"),
    )


@query(f"WITH {TX}, {_auc_sql('tx', 'o_totalprice')} SELECT * FROM auc")
def roc_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(transactions(spark, sf_dir), "y", "o_totalprice").withColumn("auc", rounded("auc", 9))


@query(f"WITH {ITEMS}, {_auc_sql('items', 'l_quantity', 'l_linestatus')} SELECT * FROM auc")
def roc_auc_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    aucs = metrics.roc_auc(_items(spark, sf_dir), "y", "l_quantity", ["l_linestatus"])
    return aucs.withColumn("auc", rounded("auc", 9))


@query(f"WITH {ITEMS}, {_auc_sql('items', 'price')} SELECT * FROM auc")
def roc_auc_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(_items(spark, sf_dir), "y", "price").withColumn("auc", rounded("auc", 9))


@query(f"""WITH {TX}, folds AS (SELECT y, o_totalprice, ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT % 5 AS fold FROM tx),
  {_auc_sql('folds', 'o_totalprice', 'fold')}
  SELECT round(avg(auc), 8) AS mean_auc, round(stddev_pop(auc), 8) AS std_auc, count(auc) AS folds FROM auc""")
def fold_metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = transactions(spark, sf_dir).withColumn("fold", F.pmod(shuffle_hash("o_orderkey", 42), F.lit(5)))
    summary = metrics.metric_summary(metrics.roc_auc(folds, "y", "o_totalprice", ["fold"]), "auc")
    return summary.select(rounded("mean_auc", 8), rounded("std_auc", 8), "folds")


def _ks_sql(cells: str) -> str:
    """``cells`` yields "column", value, second; the p-value is the same limit law summed in SQL."""
    return f"""cells AS ({cells}),
      c AS (SELECT "column", value, count(*) FILTER (NOT second) AS a, count(*) FILTER (second) AS b FROM cells WHERE value IS NOT NULL GROUP BY ALL),
      w AS (SELECT "column", sum(a) OVER o AS ca, sum(b) OVER o AS cb, sum(a) OVER (PARTITION BY "column") AS na,
        sum(b) OVER (PARTITION BY "column") AS nb FROM c WINDOW o AS (PARTITION BY "column" ORDER BY value)),
      d AS (SELECT "column", CAST(any_value(na) AS BIGINT) AS n_first, CAST(any_value(nb) AS BIGINT) AS n_second,
        max(abs(ca::DOUBLE / na - cb::DOUBLE / nb)) AS statistic FROM w GROUP BY "column"),
      x AS (SELECT *, sqrt(n_first::DOUBLE * n_second / (n_first + n_second)) * statistic AS x FROM d),
      k AS (SELECT unnest(generate_series(1, 20))::DOUBLE AS k),
      p AS (SELECT "column", sum(2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * x * x)) AS large,
        1 - sqrt(2 * pi()) / any_value(x) * sum(exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * x * x))) AS small FROM x, k GROUP BY "column")
      SELECT x."column" AS "column", n_first, n_second, round(statistic, 9) AS statistic,
        round(CASE WHEN x < 1 THEN small ELSE large END, 6) AS p_value FROM x JOIN p ON x."column" = p."column" """


def _ks(result: DataFrame) -> DataFrame:
    return result.withColumns({"statistic": rounded("statistic", 9), "p_value": rounded("p_value")})


@query("WITH " + _ks_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS value, l_returnflag = 'R' AS second FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey")
)))
def ks_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]
    return _ks(metrics.ks_two_sample(table(spark, sf_dir, "lineitem"), numbers, F.col("l_returnflag") == "R"))


@query(f"WITH {TX}, " + _ks_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS value, dataset = 'test' AS second FROM tx"
    for c in ("o_totalprice", "c_acctbal", "card", "period")
)))
def ks_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = ["o_totalprice", "c_acctbal", "card", "period"]
    return _ks(metrics.ks_two_sample(transactions(spark, sf_dir, customer=True), numbers, F.col("dataset") == "test"))
