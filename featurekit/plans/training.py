"""Queries that train boosted trees.

Scores depend on the engine. What the statements compare is all that SQL can fix: rows, labels and folds behind every
figure, whether scores are probabilities, and one booster of a single split that SQL finds by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.models import boosting
from featurekit.operators import metrics, splits
from featurekit.plans.registry import TX, query, rounded, table, transactions
from featurekit.plans.splitting import _hash
from featurekit.session import materialize, scratch_path

FEATURES = ["o_totalprice", "c_acctbal", "card", "c_nationkey", "period"]

# Rounds and folds of all training queries; production jobs use 300 rounds and more, and call the same functions.
ROUNDS, FOLDS = 6, 5
PARAMS = boosting.spark_parameters(
    {"n_estimators": ROUNDS, "learning_rate": 0.3, "num_leaves": 8, "bagging_fraction": 0.7, "feature_fraction": 0.7, "seed": 42}
)
_FOLD = f"CAST({_hash()} % {FOLDS} AS INTEGER)"


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "train")
    return splits.with_kfold(train, "o_orderkey", FOLDS)


def _test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "test")


@query(f"""WITH {TX} SELECT {_FOLD} AS fold, CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg, TRUE AS scored
  FROM tx WHERE dataset = 'train' GROUP BY 1""")
def gbt_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold scores and the labels behind their AUC; ``scored``: all are probabilities and the AUC exists."""
    folds = _folds(spark, sf_dir)
    models = boosting.train_folds(folds, FEATURES, "y", PARAMS, FOLDS)
    # The AUC and the check of the range read the same stored scores.
    scores = materialize(boosting.out_of_fold(models, folds).select("fold", "y", "score"))
    ranges = scores.groupBy("fold").agg(F.every(boosting.in_range()).alias("ok"))
    aucs = metrics.roc_auc(scores, "y", "score", ["fold"]).join(ranges, "fold")
    return aucs.select("fold", "n_pos", "n_neg", (F.col("ok") & boosting.in_range("auc")).alias("scored"))


@query(f"SELECT unnest({boosting.checkpoints(ROUNDS)}) AS round, {FOLDS}::BIGINT AS folds, TRUE AS measured")
def gbt_cv_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of the AUC after several rounds of a stratified cross-validation without early stopping."""
    tx = transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "train")
    folds = tx.join(splits.stratified_kfold(tx, "o_orderkey", "y", FOLDS).drop("y"), "o_orderkey")
    _, rounds = boosting.fit_folds(folds, FEATURES, "y", PARAMS, FOLDS, early=False)
    measured = boosting.in_range("mean_auc") & (F.col("std_auc") >= 0)
    return boosting.cv_summary(rounds).select("round", "folds", measured.alias("measured"))


@query(f"SELECT unnest({FEATURES}) AS feature, {FOLDS}::BIGINT AS folds, TRUE AS shares")
def gbt_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of every feature in every fold; ``shares``: gains are shares and splits are counted."""
    models = boosting.train_folds(_folds(spark, sf_dir), FEATURES, "y", PARAMS, FOLDS)
    found = boosting.importances(models, table(spark, sf_dir, "orders"))
    sums = found.groupBy("fold").agg((F.abs(F.sum("gain") - 1) < 1e-9).alias("whole"))
    checked = found.join(sums, "fold").withColumn("ok", F.col("whole") & boosting.in_range("gain") & (F.col("splits") >= 0))
    return checked.groupBy("feature").agg(F.count(F.lit(1)).alias("folds"), F.every("ok").alias("shares"))


@query("""SELECT p_brand AS feature, round(avg(p_size), 9) AS gain FROM part GROUP BY p_brand ORDER BY avg(p_size) DESC, p_brand LIMIT 10""")
def importance_table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of an importance table with known numbers."""
    known = table(spark, sf_dir, "part").select(F.col("p_brand").alias("feature"), F.col("p_size").alias("gain"))
    return boosting.importance_summary(known, top=10).withColumn("gain", rounded("gain", 9))


@query(f"""WITH {TX}, t AS (SELECT c_nationkey AS v, 2.0::DOUBLE * y - 1 AS z FROM tx WHERE dataset = 'train'),
  c AS (SELECT DISTINCT v FROM t),
  g AS (SELECT c.v AS cut, count(*) FILTER (t.v <= c.v) * pow(avg(z) FILTER (t.v <= c.v), 2)
      + count(*) FILTER (t.v > c.v) * pow(avg(z) FILTER (t.v > c.v), 2) AS gain FROM c CROSS JOIN t GROUP BY c.v HAVING count(*) FILTER (t.v > c.v) > 0),
  b AS (SELECT cut FROM g ORDER BY gain DESC, cut LIMIT 1)
  SELECT c.v AS c_nationkey, round(1 / (1 + exp(-2 * (SELECT avg(z) FROM t WHERE (t.v <= b.cut) = (c.v <= b.cut)))), 9) AS score
  FROM c CROSS JOIN b""")
def gbt_single_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of depth one on a column of few values: SQL finds the same split and the same two scores."""
    train = transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "train")
    model = boosting.fit(train, ["c_nationkey"], "y", {"maxIter": 1, "maxDepth": 1, "maxBins": 64, "seed": 1})
    return model.score(train.select("c_nationkey").distinct()).withColumn("score", rounded("score", 9))


@query(f"WITH {TX} SELECT o_orderkey, TRUE AS is_mean FROM tx WHERE dataset = 'test'")
def fold_ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored with the mean of all fold models; ``is_mean``: it equals the mean of the single scores."""
    models = boosting.train_folds(_folds(spark, sf_dir), FEATURES, "y", PARAMS, FOLDS)
    rows = boosting.ensemble_mean(models, _test(spark, sf_dir))
    for m in models:
        rows = m.score(rows, f"s{m.fold}")
    mean = sum((F.col(f"s{m.fold}") for m in models), F.lit(0.0)) / FOLDS
    return rows.select("o_orderkey", (boosting.in_range() & (F.abs(F.col("score") - mean) < 1e-9)).alias("is_mean"))


@query(f"""WITH {TX} SELECT CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg, TRUE AS scored FROM tx WHERE period = 60""")
def holdout_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold models stopped and checked on one fixed later period: AUC of the mean of their scores there."""
    tx = transactions(spark, sf_dir, customer=True)
    roles = tx.join(splits.holdout_with_kfold(tx, "o_orderkey", "period", 60, FOLDS), "o_orderkey")
    train, valid = roles.where(F.col("role") == "train"), roles.where(F.col("role") == "valid")
    models = boosting.train_folds(train, FEATURES, "y", PARAMS, FOLDS, valid=valid)
    found = metrics.roc_auc(boosting.ensemble_mean(models, valid), "y", "score")
    return found.select("n_pos", "n_neg", (boosting.in_range("auc") | F.col("auc").isNull()).alias("scored"))


@query(f"""WITH {TX} SELECT period, count(*) AS score_count, TRUE AS scored FROM tx WHERE dataset = 'test' GROUP BY period""")
def period_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows per test period; all periods are scored in one pass."""
    models = boosting.train_folds(_folds(spark, sf_dir), FEATURES, "y", PARAMS, FOLDS)
    scored = boosting.ensemble_mean(models, _test(spark, sf_dir))
    return scored.groupBy("period").agg(F.count("score").alias("score_count"), F.every(boosting.in_range()).alias("scored"))


@query(f"""WITH {TX} SELECT {_FOLD} AS fold, count(*) AS n, TRUE AS same FROM tx WHERE dataset = 'train' GROUP BY 1""")
def gbt_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models with a category feature, stored and loaded again: ``same``: every score, and the rounds, are as before."""
    folds = _folds(spark, sf_dir)
    features, path = ["o_totalprice", "c_mktsegment", "priority"], scratch_path(spark, "models")
    models = boosting.train_folds(folds, features, "y", PARAMS, FOLDS, categories=["c_mktsegment", "priority"])
    for m in models:
        m.save(path)
    loaded = [boosting.FoldModel.load(spark, path, m.fold) for m in models]
    kept = all(a.rounds == b.rounds and a.levels == b.levels for a, b in zip(models, loaded))
    # A row takes both scores where it stands, so no join brings them together.
    before = boosting.out_of_fold(models, folds.select("fold", *features)).withColumnRenamed("score", "before")
    both = boosting.out_of_fold(loaded, before).select("fold", "score", F.col("before").alias("again"))
    same = F.every(boosting.in_range() & (F.col("score") == F.col("again"))) & F.lit(kept)
    return both.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), same.alias("same"))


@query(f"""WITH {TX}, r AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY {_hash()}, o_orderkey) AS o, count(*) OVER (PARTITION BY y) AS n
    FROM tx WHERE dataset = 'train'),
  t AS (SELECT CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg FROM r WHERE o <= floor(n * 0.33::DOUBLE + 0.5::DOUBLE))
  SELECT c AS "column", f AS features, n_pos, n_neg, TRUE AS scored FROM t, (SELECT unnest(['o_custkey', 'c_nationkey']) AS c),
    (SELECT unnest(['value', 'value+count']) AS f)""")
def feature_vs_count_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "train")
    found = boosting.compare_with_count(train, "o_orderkey", ["o_custkey", "c_nationkey"], "y", PARAMS)
    return found.select("column", "features", "n_pos", "n_neg", boosting.in_range("auc").alias("scored"))


@query("""SELECT CAST(v AS DOUBLE) AS value, c AS value_count, TRUE AS scored FROM (SELECT unnest(generate_series(0, 1400, 100)) AS v),
  (SELECT unnest(generate_series(1, 20)) AS c)""")
def grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "train")
    found = boosting.grid_scores(train, "o_custkey", "y", PARAMS, range(0, 1500, 100), range(1, 21))
    return found.select("value", "value_count", boosting.in_range().alias("scored"))
