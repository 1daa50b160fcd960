"""Queries on statistics of earlier periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import lags
from featurekit.operators.splits import shuffle_hash
from featurekit.plans.registry import TX, query, rounded, transactions

COUNT_LAGS = [0, 1, 2, 3, 6]
SHARE_LAGS = [0, 1, 2, 3, 4, 5, 6]
TARGET_LAGS = [1, 2, 3, 6]

# Months 30 and 31 are unknown here, so their rows have no period and lags that reach them find no data.
WITH_GAP = f"""WITH {TX}, p AS (SELECT * REPLACE (CASE WHEN period NOT IN (30, 31) THEN period END AS period) FROM tx)"""


def _with_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).withColumn("period", F.when(~F.col("period").isin(30, 31), F.col("period")))


def _lookup_sql(lags_wanted: list[int], value: str, digits: int | None) -> str:
    """Rows of ``p`` with one looked-up value per lag."""
    def cell(n: int) -> str:
        x = f"CASE WHEN p.card IS NOT NULL AND p.period - {n} IN (SELECT period FROM cells) THEN coalesce(c{n}.{value}, 0) END"
        return f"round({x}, {digits}) AS card_counts__lag{n}" if digits else f"{x} AS card_counts__lag{n}"

    joins = " ".join(f"LEFT JOIN cells c{n} ON c{n}.card = p.card AND c{n}.period = p.period - {n}" for n in lags_wanted)
    return f"SELECT o_orderkey, dataset, {', '.join(cell(n) for n in lags_wanted)} FROM p {joins}"


@query(f"""{WITH_GAP}, cells AS (SELECT card, period, count(*) AS n FROM p WHERE card IS NOT NULL AND period IS NOT NULL GROUP BY card, period)
  {_lookup_sql(COUNT_LAGS, 'n', None)}""")
def key_count_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lags.key_lags(_with_gap(spark, sf_dir), "card", "period", COUNT_LAGS)
    return result.select("o_orderkey", "dataset", *[f"card_counts__lag{n}" for n in COUNT_LAGS])


@query(f"""{WITH_GAP}, counts AS (SELECT card, period, count(*) AS n FROM p WHERE card IS NOT NULL AND period IS NOT NULL GROUP BY card, period),
  cells AS (SELECT card, period, n / sum(n) OVER (PARTITION BY period)::DOUBLE AS share FROM counts)
  {_lookup_sql(SHARE_LAGS, 'share', 9)}""")
def key_share_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lags.key_lags(_with_gap(spark, sf_dir), "card", "period", SHARE_LAGS, share=True)
    return result.select("o_orderkey", "dataset", *[rounded(f"card_counts__lag{n}", 9) for n in SHARE_LAGS])


def _stat_lags_sql(source: str, extra: int = 0) -> str:
    stats = ["min", "mean", "max", "std"]
    here = ", ".join(f"cents_{s} AS cents_{s}__lag0" for s in stats)
    shifted = ", ".join(f"lag(cents_{s}, {n}) OVER (ORDER BY period) AS cents_{s}__lag{n}" for n in TARGET_LAGS for s in stats)
    names = ", ".join(f"cents_{s}__lag{n}" for n in COUNT_LAGS for s in stats)
    return f"""s AS (SELECT period, min(cents) AS cents_min, avg(cents) AS cents_mean,
        max(cents) AS cents_max, round(stddev_samp(cents), 2) AS cents_std FROM p WHERE {source} AND period IS NOT NULL GROUP BY period),
      l AS (SELECT period, {here}, {shifted} FROM s)
      SELECT o_orderkey, {names} FROM p LEFT JOIN l ON p.period = l.period"""


def _stat_lags(df: DataFrame, fit: F.Column | None) -> DataFrame:
    stats = ["min", "mean", "max", "std"]
    result = lags.period_lags(df, "period", ["cents"], stats, COUNT_LAGS, fit=fit)
    names = [f"cents_{s}__lag{n}" for n in COUNT_LAGS for s in stats]
    return result.select("o_orderkey", *[rounded(c, 2) if "_std" in c else F.col(c) for c in names])


@query(f"{WITH_GAP}, {_stat_lags_sql('TRUE')}")
def period_stat_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stat_lags(_with_gap(spark, sf_dir), None)


@query(f"""{WITH_GAP}, {_stat_lags_sql("dataset = 'train'")}""")
def train_stat_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stat_lags(_with_gap(spark, sf_dir), F.col("dataset") == "train")


@query(f"""WITH {TX}, scored AS (SELECT *, ('0x' || substr(md5(o_orderkey || '|7'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS score FROM tx),
  s AS (SELECT period, avg(score) AS m FROM scored GROUP BY period),
  l AS (SELECT period + 1 AS period, lag(m, 1) OVER w AS l1, lag(m, 2) OVER w AS l2, lag(m, 3) OVER w AS l3, lag(m, 6) OVER w AS l6
    FROM s WINDOW w AS (ORDER BY period))
  SELECT o_orderkey, round(m, 9) AS score_mean__lag0, round(l1, 9) AS score_mean__lag1, round(l2, 9) AS score_mean__lag2,
    round(l3, 9) AS score_mean__lag3, round(l6, 9) AS score_mean__lag6
  FROM scored LEFT JOIN s ON s.period = scored.period LEFT JOIN l ON l.period = scored.period""")
def pseudo_mean_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = transactions(spark, sf_dir).withColumn("score", shuffle_hash("o_orderkey", 7) / F.lit(4294967296.0).cast("double"))
    result = lags.period_lags(scored, "period", ["score"], ["mean"], COUNT_LAGS, extra=1)
    return result.select("o_orderkey", *[rounded(f"score_mean__lag{n}", 9) for n in COUNT_LAGS])


def _target_sql(keys: list[str]) -> str:
    joins, cells = [], []
    for n in TARGET_LAGS:
        same = " AND ".join([f"a{n}.period = tx.period - {n}"] + [f"a{n}.{k} = tx.{k}" for k in keys])
        joins.append(f"LEFT JOIN a a{n} ON {same}")
        cells.append(f"round(a{n}.m, 9) AS y_mean__lag{n}, round(a{n}.s, 9) AS y_std__lag{n}")
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""WITH {TX}, a AS (SELECT period, {', '.join(keys)}, avg(y) AS m, stddev_samp(y) AS s FROM tx
      WHERE dataset = 'train' AND {known} GROUP BY ALL) SELECT o_orderkey, {', '.join(cells)} FROM tx {' '.join(joins)}"""


def _target_lags(spark: SparkSession, sf_dir: str, include_label: bool) -> DataFrame:
    result = lags.target_lags(
        transactions(spark, sf_dir, customer=True), "period", ["c_nationkey", "priority"], "y", TARGET_LAGS,
        fit=F.col("dataset") == "train", include_label=include_label,
    )
    return result.select("o_orderkey", *[rounded(f"y_{s}__lag{n}", 9) for n in TARGET_LAGS for s in ("mean", "std")])


@query(_target_sql(["c_nationkey", "priority"]))
def target_lag_enc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_lags(spark, sf_dir, include_label=False)


@query(_target_sql(["c_nationkey", "priority", "y"]))
def target_lag_enc_with_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_lags(spark, sf_dir, include_label=True)


@query(f"""WITH {TX}, cells AS (SELECT o_custkey, period, count(*) AS n FROM tx GROUP BY ALL), periods AS (SELECT DISTINCT period FROM tx)
  SELECT o_orderkey, coalesce(c.n, 0) AS before_3 FROM tx JOIN periods q ON q.period = tx.period - 3
  LEFT JOIN cells c ON c.o_custkey = tx.o_custkey AND c.period = tx.period - 3""")
def rows_with_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lags.key_lags(transactions(spark, sf_dir), "o_custkey", "period", [3], prefix="before")
    return result.where(F.col("before__lag3").isNotNull()).select("o_orderkey", F.col("before__lag3").alias("before_3"))
