"""Histogram boosters: growth, missing values, penalties, sampling, rounds, stopping, storage."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurekit.models import boosting, histogram
from featurekit.models.histogram import Model, Settings, train
from featurekit.operators import metrics, splits
from featurekit.session import scratch_path


@pytest.fixture(scope="module")
def data(spark):
    draw = lambda n, m: F.pmod(F.xxhash64(F.col("id") + n), F.lit(m))
    rows = spark.range(4000).select("id", (draw(0, 1000) / 1000).alias("x"), F.when(F.col("id") % 5 != 0, draw(7, 10)).alias("z"), draw(9, 50).alias("noise"))
    y = (F.col("x") * F.coalesce(F.col("z"), F.lit(9)) + draw(3, 100) / 40 > 4).cast("int")
    rows = rows.withColumn("y", F.when(F.col("id") % 50 != 1, y))
    return rows.join(splits.kfold(rows, "id", 3), "id").cache()


FEATURES = ["x", "z", "noise"]


def test_settings():
    made = Settings.of({"n_estimators": 5, "objective": "binary", "metric": "auc", "num_leaves": 256, "min_child_weight": 3, "subsample_freq": 1,
                        "bagging_fraction": 0.7, "lambda_l1": 0.1, "early_stopping_round": 100, "verbosity": -1})
    assert (made.rounds, made.num_leaves, made.min_child_weight, made.bagging_freq, made.lambda_l1, made.patience) == (5, 256, 3, 1, 0.1, 100)
    for wrong in ({"metric": "rmse"}, {"dart_rate": 1}):
        with pytest.raises(ValueError, match="no counterpart"):
            Settings.of(wrong)


def test_leaves_and_depth_are_bounded_and_every_round_is_measured(data):
    settings = Settings(rounds=20, num_leaves=6, max_depth=3, learning_rate=0.3)
    boosters, history = histogram.fit_folds(data, FEATURES, "y", settings, 3, key="id")
    for b in boosters:
        assert len(b.trees) == 20 and all(t.feature.count(-1) <= 6 for t in b.trees)
        assert any(t.feature.count(-1) == 6 for t in b.trees)
    found = {(r.fold, r["round"]): r.auc for r in history.collect()}
    assert sorted(found) == [(k, r) for k in range(3) for r in range(1, 21)]
    # The stored history is the exact AUC of the scores, up to the step in which margins are told apart.
    scored = histogram.out_of_fold(boosters, data.where("y IS NOT NULL"))
    for r in metrics.roc_auc(scored, "y", "score", ["fold"]).collect():
        assert found[r.fold, 20] == pytest.approx(r.auc, abs=2e-3) and r.auc > 0.9


def test_not_worse_than_the_other_trees(data):
    params = boosting.spark_parameters({"n_estimators": 6, "learning_rate": 0.3, "num_leaves": 8, "seed": 1})
    others, _ = boosting.fit_folds(data, FEATURES, "y", params, 3, early=False)
    ours, _ = histogram.fit_folds(data, FEATURES, "y", Settings(rounds=6, learning_rate=0.3, num_leaves=8), 3)
    known = data.where("y IS NOT NULL")
    a = metrics.roc_auc(histogram.out_of_fold(ours, known), "y", "score").first().auc
    b = metrics.roc_auc(boosting.out_of_fold(others, known), "y", "score").first().auc
    assert a > b - 0.005


def test_a_model_does_not_depend_on_how_rows_are_dealt(data):
    settings = Settings(rounds=18, num_leaves=5, bagging_fraction=0.6, bagging_freq=2, feature_fraction=0.7, seed=3)
    one, h1 = histogram.fit_folds(data, FEATURES, "y", settings, 3, key="id")
    two, h2 = histogram.fit_folds(data.repartition(11), FEATURES, "y", settings, 3, key="id")
    assert one == two and h1.collect() == h2.collect()
    other, _ = histogram.fit_folds(data, FEATURES, "y", Settings(**{**settings.__dict__, "seed": 4}), 3, key="id")
    assert one != other


@pytest.mark.parametrize("left", [True, False])
def test_missing_values_go_where_they_belong(spark, left):
    rows = spark.range(600).select((F.col("id") % 20).alias("v"), "id").select(
        F.when(F.col("id") % 4 != 0, F.col("v")).alias("v"),
        F.when(F.col("id") % 4 == 0, F.lit(left)).otherwise(F.col("v") < 10).cast("int").alias("y"))
    (booster,), _ = train(rows, "y", [Model("m", ("v",))], Settings(rounds=1, num_leaves=2, learning_rate=1.0))
    assert booster.trees[0].null_left[0] is left
    nan = histogram.score(spark.createDataFrame([(None,), (float("nan"),), (3.0,), (15.0,)], "v double"), [booster], ["p"]).collect()
    assert nan[0].p == nan[1].p == nan[2 if left else 3].p
    only, _ = train(rows.withColumn("v", F.when(F.col("v") < 99, 1)), "y", [Model("m", ("v",))], Settings(rounds=1, num_leaves=2))
    assert only[0].trees[0].feature[0] == 0  # nulls against all others


def test_penalties_and_weights(data):
    free, _ = train(data, "y", [Model("m", ("x",))], Settings(rounds=1, num_leaves=2, learning_rate=1.0))
    l2, _ = train(data, "y", [Model("m", ("x",))], Settings(rounds=1, num_leaves=2, learning_rate=1.0, lambda_l2=1000.0))
    l1, _ = train(data, "y", [Model("m", ("x",))], Settings(rounds=1, num_leaves=2, learning_rate=1.0, lambda_l1=1e9))
    assert max(map(abs, l2[0].trees[0].value)) < max(map(abs, free[0].trees[0].value))
    assert l1[0].trees[0].value == [0.0] or l1[0].trees[0].value == [-0.0]
    heavy, _ = train(data, "y", [Model("m", ("x",))], Settings(rounds=1, min_child_weight=1e9))
    assert heavy[0].trees[0].feature == [-1]
    few, _ = train(data, "y", [Model("m", ("x",))], Settings(rounds=1, min_data_in_leaf=1500, num_leaves=9))
    assert few[0].trees[0].feature.count(-1) <= 2
    cut, _ = train(data, "y", [Model("m", ("x",))], Settings(rounds=1, min_gain_to_split=1e9))
    assert cut[0].trees[0].feature == [-1]


def scripted(monkeypatch, curves):
    monkeypatch.setattr(histogram._Training, "auc", lambda self, active, fresh, done: [
        (k, done + i + 1, curves[k][done + i]) for k in active for i in range(len(fresh[k]))])


def test_patience_outlasts_a_dip_and_keeps_the_best_round(data, monkeypatch):
    dips = [0.6, 0.5, 0.5, 0.7, 0.8] + [0.75] * 30
    falls = [0.9] + [0.5] * 34
    scripted(monkeypatch, [dips, falls])
    models = [Model("dips", ("x",), 0, 0), Model("falls", ("x",), 1, 1)]
    boosters, history = train(data, "y", models, Settings(rounds=35, num_leaves=2, patience=4), "fold")
    assert [len(b.trees) for b in boosters] == [5, 1]
    seen = {m: max(r["round"] for r in history.collect() if r.model == m) for m in ("dips", "falls")}
    assert 9 <= seen["dips"] < 35 and 5 <= seen["falls"] <= 8
    every, _ = train(data, "y", models, Settings(rounds=7, num_leaves=2), "fold")
    assert [len(b.trees) for b in every] == [7, 7]


def test_chunks_change_nothing(data, monkeypatch):
    settings = Settings(rounds=5, num_leaves=4)
    whole, h1 = histogram.fit_folds(data, FEATURES, "y", settings, 3)
    monkeypatch.setattr(histogram, "CHUNK", 2)
    monkeypatch.setattr(histogram, "MAX_CELLS", 100)
    parts, h2 = histogram.fit_folds(data, FEATURES, "y", settings, 3)
    for a, b in zip(whole, parts):
        assert [t.feature for t in a.trees] == [t.feature for t in b.trees]
        assert np.allclose([v for t in a.trees for v in t.value], [v for t in b.trees for v in t.value])
    assert [r.auc for r in h1.collect()] == pytest.approx([r.auc for r in h2.collect()])


def test_storage_and_ensembles(spark, data):
    boosters, _ = histogram.fit_folds(data, FEATURES, "y", Settings(rounds=3, num_leaves=4), 3)
    path = scratch_path(spark, "kept")
    histogram.save(boosters, spark, path)
    assert histogram.load(spark, path) == boosters
    rows = histogram.score(histogram.ensemble_mean(boosters, data.select("id", *FEATURES)), boosters, ["a", "b", "c"]).limit(50).collect()
    assert all(r.score == pytest.approx((r.a + r.b + r.c) / 3) and 0 < r.score < 1 for r in rows)
    table = histogram.importances(spark, boosters)
    assert table.count() == 9 and table.where("gain < 0 OR (splits = 0) != (gain = 0)").count() == 0


def test_many_feature_sets_share_their_passes(data, monkeypatch):
    passes = []
    plain = histogram._Training._split_pass
    monkeypatch.setattr(histogram._Training, "_split_pass", lambda self, *a: (passes.append(1), plain(self, *a))[1])
    wide = data.select("*", *[(F.col("x") * (i + 1) + F.col("noise") * i).alias(f"c{i}") for i in range(40)])
    sets = {f"c{i}": [f"c{i}"] for i in range(40)} | {"both": ["x", "z"]}
    found = {r.model: r.auc for r in histogram.compare_features(wide, sets, "y", Settings(rounds=2, num_leaves=4, max_depth=2), "fold", key="id").collect()}
    assert len(found) == 41 and len(passes) == 4 and found["both"] > found["c39"] and found["c0"] > 0.6


def test_labels_of_one_kind_and_empty_tables(data):
    same, history = histogram.fit_folds(data.withColumn("y", F.lit(1)), FEATURES, "y", Settings(rounds=2), 3)
    assert all(t.feature == [-1] for b in same for t in b.trees) and {r.auc for r in history.collect()} == {None}
    none, history = histogram.fit_folds(data.limit(0), FEATURES, "y", Settings(rounds=2), 3)
    assert len(none) == 3 and history.count() == 0
