"""Boosted trees: parameter translation, choice of rounds, scoring, importances, storage."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featurekit.models import boosting
from featurekit.operators import metrics, splits
from featurekit.plans.registry import QUERIES
from featurekit.session import scratch_path

PARAMS = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3, "seed": 1}


@pytest.fixture(scope="module")
def data(spark):
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    rows = spark.range(600).select("id", x.alias("x"), F.when(F.col("id") % 5 != 0, F.pmod(F.xxhash64(F.col("id") + 7), F.lit(10))).alias("z"))
    rows = rows.withColumn("y", (F.col("x") + F.pmod(F.xxhash64(F.col("id") + 3), F.lit(100)) / 200 > 0.8).cast("int"))
    return rows.join(splits.kfold(rows, "id", 2), "id").cache()


@pytest.fixture(scope="module")
def trained(data):
    return boosting.fit_folds(data, ["x", "z"], "y", PARAMS, 2, early=False)


def test_parameters():
    translated = boosting.spark_parameters({"n_estimators": 10, "num_leaves": 256, "max_depth": -1, "feature_fraction": 0.7, "bagging_fraction": 0.5})
    assert translated == {"maxIter": 10, "maxDepth": 8, "featureSubsetStrategy": "0.7", "subsamplingRate": 0.5}
    assert boosting.spark_parameters({"num_leaves": 5})["maxDepth"] == 3
    with pytest.raises(ValueError, match="lambda_l1"):
        boosting.spark_parameters({"lambda_l1": 1.0, "n_estimators": 3})


def test_checkpoints():
    assert boosting.checkpoints(1) == [1] and boosting.checkpoints(4) == [1, 2, 3, 4]
    many = boosting.checkpoints(300)
    assert many[0] == 1 and many[-1] == 300 and len(many) <= 9


def test_score_is_the_model_probability(data):
    model = boosting.fit(data, ["x", "z"], "y", PARAMS)
    ours = {r["id"]: r["score"] for r in model.score(data).collect()}
    rows = model.model.transform(boosting.assemble(data, ["x", "z"]))
    theirs = {r["id"]: r["p"] for r in rows.select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_plan_does_not_grow_with_rounds(data):
    few, many = (boosting.fit(data, ["x"], "y", {"maxIter": n, "maxDepth": 1, "seed": 1}) for n in (2, 40))
    sizes = [len(m.score(data)._jdf.queryExecution().optimizedPlan().toString()) for m in (few, many)]
    assert abs(sizes[0] - sizes[1]) < 100


def test_auc_of_cut_ensembles(data):
    model = boosting.fit(data, ["x", "z"], "y", PARAMS)
    rounds = {r["round"]: r["auc"] for r in boosting.auc_by_round(model, data, "y").collect()}
    assert sorted(rounds) == [1, 2, 3, 4]
    assert rounds[4] == pytest.approx(metrics.roc_auc(model.score(data), "y", "score").first()["auc"], abs=1e-12)
    cut = model.first_rounds(2)
    assert cut.model.getNumTrees == 2
    assert rounds[2] == pytest.approx(metrics.roc_auc(cut.score(data), "y", "score").first()["auc"], abs=1e-12)
    assert rounds[4] > 0.85


def test_training_stops_early(data):
    noise = data.withColumn("y", F.pmod(F.xxhash64(F.col("id") + 99), F.lit(2)).cast("int"))
    model = boosting.fit(noise.where("fold = 0"), ["x", "z"], "y", {**PARAMS, "maxIter": 30}, valid=noise.where("fold = 1"))
    assert model.rounds == model.model.getNumTrees < 30


def test_categories_are_nominal(data):
    letters = data.withColumn("c", F.when(F.col("z").isNotNull(), F.concat(F.lit("k"), F.pmod(F.col("z") * 7, F.lit(10)).cast("string"))))
    letters = letters.withColumn("y", F.col("c").isin("k0", "k3", "k8").cast("int"))
    model = boosting.fit(letters.where("y IS NOT NULL"), ["c"], "y", {"maxIter": 1, "maxDepth": 1, "seed": 1}, categories=["c"])
    scores = {r["c"]: r["score"] for r in model.score(letters.select("c").distinct()).collect()}
    high = {c for c, s in scores.items() if c and s > 0.5}
    assert high == {"k0", "k3", "k8"}  # one split on sets of levels tells them apart
    assert 0 < model.score(letters.select(F.lit("never seen").alias("c")).limit(1)).first()["score"] < 1
    many = letters.selectExpr("y", "concat('v', id * 3) AS c").union(letters.selectExpr("y", "concat('w', id * 3) AS c"))
    with pytest.raises(ValueError):
        boosting.category_levels(many, ["c"])


def test_folds_and_cv_table(data, trained):
    models, rounds = trained
    assert [m.fold for m in models] == [0, 1] and rounds.count() == 8
    summary = boosting.cv_summary(rounds).collect()
    assert len(summary) == 4 and all(0.5 < r["mean_auc"] <= 1 and r["folds"] == 2 for r in summary)
    scored = boosting.out_of_fold(models, data)
    assert scored.count() == 600 and scored.select("id").distinct().count() == 600


def test_ensemble_is_the_mean_of_the_folds(data, trained):
    models, _ = trained
    mean = {r["id"]: r["score"] for r in boosting.ensemble_mean(models, data).collect()}
    single = [{r["id"]: r["score"] for r in m.score(data).collect()} for m in models]
    assert mean == pytest.approx({i: (single[0][i] + single[1][i]) / 2 for i in mean})


def test_importances(data, trained):
    models, _ = trained
    table = boosting.importances(models, data)
    rows = table.collect()
    assert {(r["feature"], r["fold"]) for r in rows} == {(f, k) for f in ("x", "z") for k in (0, 1)}
    for fold in (0, 1):
        assert sum(r["gain"] for r in rows if r["fold"] == fold) == pytest.approx(1.0)
    nodes = sum((t.numNodes - 1) // 2 for t in models[0].model.trees)
    assert sum(r["splits"] for r in rows if r["fold"] == 0) == nodes
    summary = boosting.importance_summary(table).collect()
    assert summary[0]["feature"] == "x" and len(boosting.importance_summary(table, top=1).collect()) == 1


def test_stored_model_scores_alike(spark, data, trained):
    models, _ = trained
    path, cut = scratch_path(spark, "models"), models[1].first_rounds(3)
    cut.save(path)
    loaded = boosting.FoldModel.load(spark, path, 1)
    assert (loaded.rounds, loaded.features, loaded.fold) == (3, ["x", "z"], 1)
    assert {r["id"]: r["score"] for r in loaded.score(data).collect()} == {r["id"]: r["score"] for r in cut.score(data).collect()}


def _counting(monkeypatch):
    calls, store = [], boosting.materialize
    monkeypatch.setattr(boosting, "materialize", lambda df: calls.append(df.columns) or store(df))
    return calls


def test_folds_share_stored_vectors(data, trained, monkeypatch):
    calls = _counting(monkeypatch)
    models = boosting.train_folds(data, ["x", "z"], "y", PARAMS, 2)
    assert calls == [["fold", "__y", "__features"]]
    assert [m.fold for m in models] == [0, 1]
    calls.clear()
    held = boosting.train_folds(data.where("id % 3 != 0"), ["x", "z"], "y", PARAMS, 2, valid=data.where("id % 3 = 0"))
    assert calls == [["fold", "__y", "__features"], ["__y", "__features"]]
    assert all(1 <= m.rounds <= 4 for m in held)


def test_fold_levels_are_those_outside_of_the_fold(data):
    letters = data.withColumn("c", F.when(F.col("z").isNotNull(), F.concat(F.lit("k"), "z"))).withColumn(
        "d", F.when(F.col("fold") == 1, "only here").otherwise("common"))
    found = boosting.fold_levels(letters, ["c", "d"], 2)
    for fold in (0, 1):
        alone = boosting.category_levels(letters.where(F.col("fold") != fold), ["c", "d"])
        assert found[fold] == {c: sorted(levels) for c, levels in alone.items()}
    assert [levels["d"] for levels in found] == [["only here"], ["common"]]
    assert boosting.category_levels(letters.selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id > 0 THEN 'b' END AS c"), ["c"])["c"] == ["b", "a"]
    assert boosting.category_levels(letters.where("id < 0"), ["c"]) == {"c": []}
    models = boosting.train_folds(letters, ["c", "d", "x"], "y", PARAMS, 2, categories=["c", "d"])
    assert [m.levels for m in models] == found
    assert boosting.out_of_fold(models, letters).where(boosting.in_range()).count() == 600


def test_out_of_fold_reads_the_rows_once(data, trained):
    models, _ = trained
    scored = boosting.out_of_fold(models, data)
    assert "Union" not in scored._jdf.queryExecution().optimizedPlan().toString()
    own = {r["id"]: r["score"] for m in models for r in m.score(data.where(F.col("fold") == m.fold)).collect()}
    assert {r["id"]: r["score"] for r in scored.collect()} == own
    assert boosting.out_of_fold(models[:1], data).count() == data.where("fold = 0").count()


@pytest.mark.parametrize("name", ["gbt_fold_scores", "period_scoring", "holdout_fold_scores"])
def test_auc_by_round_is_made_only_where_it_is_returned(spark, sf_dir, monkeypatch, name):
    def unwanted(*args):
        raise AssertionError("an AUC by round that the query does not return")

    monkeypatch.setattr(boosting, "roc_auc", unwanted)
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows and all(r["scored"] for r in rows)
