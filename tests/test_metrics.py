"""Ranking metrics and two-sample tests against direct computation."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from featurekit.operators import metrics


def _auc(pairs):
    pos, neg = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scores(spark):
    random.seed(3)
    rows = [(i, random.randint(0, 1), random.choice([None, 0.1, 0.2, 0.2, 0.5, random.random()]), i % 3) for i in range(400)]
    rows += [(1000, 1, 0.3, 9), (1001, 1, 0.4, 9)]
    return spark.createDataFrame(rows, "id bigint, y int, score double, fold int")


def test_auc_with_ties_and_unscored_rows(scores):
    rows = [(r["y"], r["score"]) for r in scores.collect() if r["score"] is not None]
    assert metrics.roc_auc(scores, "y", "score").first()["auc"] == pytest.approx(_auc(rows), abs=1e-12)


def test_auc_per_fold_and_single_class_fold(scores):
    result = {r["fold"]: r["auc"] for r in metrics.roc_auc(scores, "y", "score", ["fold"]).collect()}
    assert result[9] is None
    for fold in range(3):
        rows = [(r["y"], r["score"]) for r in scores.collect() if r["score"] is not None and r["fold"] == fold]
        assert result[fold] == pytest.approx(_auc(rows), abs=1e-12)
    summary = metrics.metric_summary(metrics.roc_auc(scores, "y", "score", ["fold"]), "auc").first()
    mean = sum(result[f] for f in range(3)) / 3
    assert summary["mean_auc"] == pytest.approx(mean) and summary["folds"] == 3
    assert summary["std_auc"] == pytest.approx(math.sqrt(sum((result[f] - mean) ** 2 for f in range(3)) / 3))


def test_ks_statistic(spark):
    random.seed(5)
    a, b = [round(random.gauss(0, 1), 2) for _ in range(300)], [round(random.gauss(0.4, 1), 2) for _ in range(200)]
    rows = [(0, v) for v in a] + [(1, v) for v in b] + [(0, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "g int, x double").withColumn("same", F.lit(1.0))
    result = {r["column"]: r for r in metrics.ks_two_sample(df, ["x", "same"], F.col("g") == 1).collect()}
    gaps = [abs(sum(v <= t for v in a) / 300 - sum(v <= t for v in b) / 200) for t in a + b]
    assert result["x"]["statistic"] == pytest.approx(max(gaps)) and (result["x"]["n_first"], result["x"]["n_second"]) == (300, 200)
    assert result["same"]["statistic"] == 0.0 and result["same"]["p_value"] == 1.0
    assert result["x"]["p_value"] < 0.01


# Published quantiles of the Kolmogorov distribution.
@pytest.mark.parametrize(("x", "tail"), [(1.2238478702170836, 0.10), (1.3580986393225507, 0.05), (1.6276236115189503, 0.01)])
def test_kolmogorov_quantiles(spark, x, tail):
    assert spark.range(1).select(metrics.kolmogorov_tail(F.lit(x))).first()[0] == pytest.approx(tail, abs=1e-9)


def test_kolmogorov_series_meet(spark):
    below, above = spark.range(1).select(
        metrics.kolmogorov_tail(F.lit(0.9999999)), metrics.kolmogorov_tail(F.lit(1.0000001))
    ).first()
    assert below == pytest.approx(above, abs=1e-6)
    assert spark.range(1).select(metrics.kolmogorov_tail(F.lit(0.05))).first()[0] == pytest.approx(1.0)
