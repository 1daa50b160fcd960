"""Boosted trees per fold on Spark ML: training that stops early, scoring, storage and importances."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from featurekit.operators.encoders import count_encode, value_table
from featurekit.operators.metrics import roc_auc
from featurekit.operators.sets import stack_all, value_count_grid
from featurekit.operators.splits import stratified_holdout
from featurekit.session import materialize, scratch_path

MISSING = -999.0

# A category with more levels than a split can tell apart has to be encoded before it is a feature.
MAX_LEVELS = 1000

# Booster parameter names and the Spark ML parameters that play their part.
PARAMETERS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "bagging_fraction": "subsamplingRate",
    "min_data_in_leaf": "minInstancesPerNode",
    "max_bin": "maxBins",
    "seed": "seed",
}


def spark_parameters(params: Mapping[str, float]) -> dict:
    """Translate booster parameters; ``num_leaves`` becomes a depth and ``feature_fraction`` a subset strategy.

    Parameters without a counterpart, such as L1 and L2 penalties or a minimum child weight, are an error.
    """
    unknown = set(params) - set(PARAMETERS) - {"num_leaves", "feature_fraction"}
    if unknown:
        raise ValueError(f"no counterpart for {', '.join(sorted(unknown))}")
    translated = {PARAMETERS[k]: v for k, v in params.items() if k in PARAMETERS and not (k == "max_depth" and v < 0)}
    if "num_leaves" in params and "maxDepth" not in translated:
        translated["maxDepth"] = min(30, max(1, int(params["num_leaves"] - 1).bit_length()))
    if "feature_fraction" in params:
        translated["featureSubsetStrategy"] = str(float(params["feature_fraction"]))
    return translated


def category_levels(df: DataFrame, categories: Sequence[str]) -> dict[str, list[str]]:
    """The levels of category columns, most frequent first; a column of more than ``MAX_LEVELS`` is an error."""
    counts = _level_counts(df, categories).select(F.lit(0).alias("__i"), "column", "value", "n")
    return _levels(counts, categories, 1, lambda r: (-r["n"], r["value"]))[0]


def fold_levels(df: DataFrame, categories: Sequence[str], k: int, fold: str = "fold") -> list[dict[str, list[str]]]:
    """:func:`category_levels` of the rows outside of each of ``k`` folds, from one pass over all rows.

    Levels are in text order, so that folds which know the same levels have the same vectors.
    """
    if not categories:
        return [{} for _ in range(k)]
    outside = F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(k - 1)), F.col("__fold"))).alias("__i")
    counts = _level_counts(df.withColumnRenamed(fold, "__fold"), categories, ["__fold"]).where(F.col("__fold").isNotNull())
    return _levels(counts.select(outside, "column", "value", "n"), categories, k, lambda r: r["value"])


def _level_counts(df: DataFrame, categories: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    texts = df.select(*within, *[F.col(c).cast("string").alias(c) for c in categories])
    return value_table(texts, categories, within).where(F.col("value").isNotNull())


def _levels(counts: DataFrame, categories: Sequence[str], k: int, order: Callable[[Row], object]) -> list[dict[str, list[str]]]:
    stored = materialize(counts.groupBy("__i", "column", "value").agg(F.sum("n").alias("n")))
    for row in stored.groupBy("__i", "column").count().where(F.col("count") > MAX_LEVELS).collect():
        raise ValueError(f"{row['column']} has {row['count']} levels; count or target encode it first")
    found = sorted(stored.collect(), key=order)
    return [{c: [r["value"] for r in found if (r["__i"], r["column"]) == (i, c)] for c in categories} for i in range(k)]


def assemble(df: DataFrame, features: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Add the feature vector ``__features``.

    Null numbers take a fixed sentinel, because tree nodes cannot split on a missing value. Columns in ``levels`` are
    categories: the vector marks them as nominal, and null and unknown values share one more level.
    """
    levels = levels or {}
    numbers = [c for c in features if c not in levels]
    filled = df.withColumns({f"__f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in numbers})
    for c, found in levels.items():
        named = filled.withColumn(f"__s_{c}", F.col(c).cast("string"))
        indexer = StringIndexerModel.from_labels(list(found) or [""], f"__s_{c}", f"__f_{c}", handleInvalid="keep")
        filled = indexer.transform(named).drop(f"__s_{c}")
    vector = VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol="__features")
    return vector.transform(filled).drop(*[f"__f_{c}" for c in features])


@dataclass
class FoldModel:
    """A trained booster, the rounds it kept, the fold it left out and the levels of its category features."""

    model: GBTClassificationModel
    features: list[str]
    rounds: int
    fold: int
    levels: dict[str, list[str]] = field(default_factory=dict)

    def first_rounds(self, rounds: int) -> FoldModel:
        """The same booster cut after some rounds."""
        if rounds >= self.rounds:
            return self
        context, java = SparkSession.active().sparkContext, self.model._java_obj
        packages = context._jvm.org.apache.spark.ml
        trees = context._gateway.new_array(packages.regression.DecisionTreeRegressionModel, rounds)
        weights = context._gateway.new_array(context._gateway.jvm.double, rounds)
        for i in range(rounds):
            trees[i], weights[i] = java.trees()[i], float(java.treeWeights()[i])
        cut = packages.classification.GBTClassificationModel(f"{java.uid()}_{rounds}", trees, weights)
        return FoldModel(GBTClassificationModel(cut), self.features, rounds, self.fold, self.levels)

    def probability(self, rows: DataFrame, name: str) -> DataFrame:
        """Add the probability of a positive label to rows that hold the feature vector; one expression for all rounds."""
        model = self.model.copy().setFeaturesCol("__features").setProbabilityCol("__p").setRawPredictionCol("").setPredictionCol("")
        return model.transform(rows).withColumn(name, vector_to_array("__p")[1]).drop("__p")

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Add the probability of a positive label."""
        return self.probability(assemble(df, self.features, self.levels), name).select(*df.columns, name)

    def save(self, path: str) -> None:
        """Store the booster and all that scoring needs under ``{path}/fold={fold}``."""
        folder = f"{path}/fold={self.fold}"
        self.model.write().overwrite().save(f"{folder}/model")
        row = [(self.features, self.rounds, list(self.levels.items()))]
        kind = "features array<string>, rounds int, levels array<struct<name: string, labels: array<string>>>"
        SparkSession.active().createDataFrame(row, kind).coalesce(1).write.mode("overwrite").json(f"{folder}/about")

    @staticmethod
    def load(spark: SparkSession, path: str, fold: int) -> FoldModel:
        folder = f"{path}/fold={fold}"
        kind = "features array<string>, rounds int, levels array<struct<name: string, labels: array<string>>>"
        about = spark.read.schema(kind).json(f"{folder}/about").first()
        levels = {x["name"]: list(x["labels"]) for x in about["levels"]}
        return FoldModel(GBTClassificationModel.load(f"{folder}/model"), list(about["features"]), about["rounds"], fold, levels)


def fit(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping[str, object], fold: int = 0,
    valid: DataFrame | None = None, categories: Sequence[str] = (),
) -> FoldModel:
    """Train on the labelled rows of ``df`` with Spark ML parameters.

    With ``valid``, training ends in the round after which the loss there no longer falls (by Spark ML's
    ``validationTol``), and the booster keeps the rounds up to its lowest loss.
    """
    levels = category_levels(df, categories) if categories else {}
    rows = _vectors(df, features, label, levels).withColumn("__valid", F.lit(False))
    if valid is not None:
        rows = rows.union(_vectors(valid, features, label, levels).withColumn("__valid", F.lit(True)))
    return _trained(materialize(rows), features, params, fold, levels, valid is not None)


def _vectors(df: DataFrame, features: Sequence[str], label: str, levels: Mapping[str, Sequence[str]], *more: str) -> DataFrame:
    """Label ``__y`` and feature vector of the labelled rows, and the columns ``more``."""
    rows = df.where(F.col(label).isNotNull()).select(*dict.fromkeys([*features, *more]), F.col(label).cast("double").alias("__y"))
    return assemble(rows, features, levels).select(*more, "__y", "__features")


def _trained(
    rows: DataFrame, features: Sequence[str], params: Mapping[str, object], fold: int, levels: dict[str, list[str]], early: bool
) -> FoldModel:
    """A booster of stored vectors; with ``early``, those marked ``__valid`` only end the training."""
    settings = {**params, "validationIndicatorCol": "__valid"} if early else dict(params)
    if levels:
        settings["maxBins"] = max(settings.get("maxBins", 32), 2 + max(map(len, levels.values())))
    model = GBTClassifier(featuresCol="__features", labelCol="__y", **settings).fit(rows)
    return FoldModel(model, list(features), model.getNumTrees, fold, levels)


def checkpoints(rounds: int, most: int = 8) -> list[int]:
    """At most ``most`` numbers of rounds at which an ensemble is looked at: 1, the last one and even steps on a log scale."""
    steps = {round(rounds ** (i / max(1, most - 1))) for i in range(most)}
    return sorted({1, rounds} | {s for s in steps if 1 <= s <= rounds})


def auc_by_round(model: FoldModel, df: DataFrame, label: str, at: Sequence[int] | None = None) -> DataFrame:
    """``round, n_pos, n_neg, auc`` of the ensemble cut after the rounds ``at`` (:func:`checkpoints` by default)."""
    return _auc_of_vectors(model, assemble(df, model.features, model.levels), label, at)


def _auc_of_vectors(model: FoldModel, rows: DataFrame, label: str, at: Sequence[int] | None) -> DataFrame:
    at = [r for r in (at or checkpoints(model.rounds)) if r <= model.rounds]
    for r in at:
        rows = model.first_rounds(r).probability(rows, f"__at{r}")
    staged = F.explode(F.array(*[F.struct(F.lit(r).alias("round"), F.col(f"__at{r}").alias("score")) for r in at])).alias("x")
    return roc_auc(rows.select(F.col(label).alias("y"), staged).select("y", "x.*"), "y", "score", ["round"])


def _each_fold(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping[str, object], k: int,
    fold: str, valid: DataFrame | None, early: bool, categories: Sequence[str],
) -> Iterator[tuple[FoldModel, DataFrame]]:
    """The model of every left-out fold and the stored vectors it is checked on.

    Vectors are made and stored once for all folds whose categories have the same levels.
    """
    rows = df.where(F.col(fold).isNotNull()).select(*dict.fromkeys([*features, label, fold]))
    rows = rows if not categories else materialize(rows)
    shared, stored, hold_out = None, rows, None
    for i, levels in enumerate(fold_levels(rows, categories, k, fold)):
        if shared != levels:
            stored, shared = materialize(_vectors(rows, features, label, levels, fold)), levels
            hold_out = materialize(_vectors(valid, features, label, levels)) if valid is not None else None
        left_out = F.col(fold) == i
        if hold_out is not None and early:
            training = stored.where(~left_out).select("__y", "__features", F.lit(False).alias("__valid"))
            training = training.union(hold_out.withColumn("__valid", F.lit(True)))
        else:
            training = (stored if early else stored.where(~left_out)).select("__y", "__features", left_out.alias("__valid"))
        check = hold_out if hold_out is not None else stored.where(left_out)
        yield _trained(training, features, params, i, levels, early), check


def train_folds(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping[str, object], k: int,
    fold: str = "fold", valid: DataFrame | None = None, early: bool = True, categories: Sequence[str] = (),
) -> list[FoldModel]:
    """The models of :func:`fit_folds`, without their AUC by round."""
    return [model for model, _ in _each_fold(df, features, label, params, k, fold, valid, early, categories)]


def fit_folds(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping[str, object], k: int,
    fold: str = "fold", valid: DataFrame | None = None, early: bool = True, categories: Sequence[str] = (),
    at: Sequence[int] | None = None,
) -> tuple[list[FoldModel], DataFrame]:
    """Train one model per left-out fold.

    With ``early`` each one stops by its loss on ``valid`` (a fixed hold-out) or, without one, on the left-out fold.
    Returns the models and ``fold, round, auc`` there at the :func:`checkpoints` of the rounds. The vectors are computed
    once and stored, so no fold repeats the joins and encodings behind ``df``.
    """
    models, tables = [], []
    for model, check in _each_fold(df, features, label, params, k, fold, valid, early, categories):
        models.append(model)
        found = _auc_of_vectors(model, check, "__y", at).select("round", "auc").collect()
        tables += [(model.fold, r["round"], r["auc"]) for r in found]
    return models, df.sparkSession.createDataFrame(tables, "fold int, round int, auc double")


def cv_summary(rounds: DataFrame) -> DataFrame:
    """Mean and population standard deviation of the fold AUCs, and their number, for every round looked at."""
    return rounds.groupBy("round").agg(
        F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"), F.count("auc").alias("folds"))


def _scored(models: Sequence[FoldModel], df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add the scores of all models in one pass over the rows."""
    rows, shared = df, None
    for column, m in zip(names, models):
        if shared != (m.features, m.levels):  # models of one feature set share the vector
            rows, shared = assemble(rows.drop("__features"), m.features, m.levels), (m.features, m.levels)
        rows = m.probability(rows, column)
    return rows


def out_of_fold(models: Sequence[FoldModel], df: DataFrame, fold: str = "fold") -> DataFrame:
    """Score every row with the model that did not see it, in one pass and without a shuffle."""
    names = [f"__p{i}" for i in range(len(models))]
    rows = _scored(models, df.where(F.col(fold).isin([m.fold for m in models])), names)
    own = F.coalesce(*[F.when(F.col(fold) == m.fold, F.col(n)) for n, m in zip(names, models)])
    return rows.select(*df.columns, own.alias("score"))


def ensemble_mean(models: Sequence[FoldModel], df: DataFrame, name: str = "score") -> DataFrame:
    """Score rows with the mean of all fold models, in one pass and without a shuffle."""
    names = [f"__p{i}" for i in range(len(models))]
    mean = reduce(add, map(F.col, names)) / len(models)
    return _scored(models, df, names).select(*df.columns, mean.alias(name))


def importances(models: Sequence[FoldModel], df: DataFrame) -> DataFrame:
    """``feature, gain, splits, fold``: share of impurity gain and number of splits per feature and fold."""
    spark, rows = df.sparkSession, []
    for m in models:
        path = scratch_path(spark, "importance")
        m.model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").where("nodeData.leftChild >= 0")
        splits = {r["f"]: r["count"] for r in nodes.groupBy(F.col("nodeData.split.featureIndex").alias("f")).count().collect()}
        gains = m.model.featureImportances
        rows += [(f, float(gains[i]), splits.get(i, 0), m.fold) for i, f in enumerate(m.features)]
    return spark.createDataFrame(rows, "feature string, gain double, splits int, fold int")


def importance_summary(table: DataFrame, measure: str = "gain", top: int = 300) -> DataFrame:
    """Mean importance by feature, highest first."""
    return table.groupBy("feature").agg(F.avg(measure).alias(measure)).orderBy(F.desc(measure), "feature").limit(top)


def compare_with_count(
    df: DataFrame, key: str, columns: Sequence[str], label: str, params: Mapping[str, object], seed: int = 42
) -> DataFrame:
    """``column, features, n_pos, n_neg, auc`` on a stratified hold-out: each column alone and with its value count.

    Values are counted over all rows; only rows with a label train and test.
    """
    labelled = df.where(F.col(label).isNotNull())
    roles = stratified_holdout(labelled, key, label, 0.33, seed).select(key, "role")
    wide = count_encode(df.select(key, label, *columns), columns, suffix="_count").join(roles, key)
    counted = materialize(wide)
    results = []
    for column in columns:
        for names, chosen in (("value", [column]), ("value+count", [column, f"{column}_count"])):
            model = fit(counted.where(F.col("role") == "train"), chosen, label, params)
            scored = model.score(counted.where(F.col("role") == "test"))
            results.append(roc_auc(scored, label, "score").select(
                F.lit(column).alias("column"), F.lit(names).alias("features"), "n_pos", "n_neg", "auc"
            ))
    return stack_all(results)


def grid_scores(
    df: DataFrame, column: str, label: str, params: Mapping[str, object], values: Sequence[float], counts: Sequence[int]
) -> DataFrame:
    """``value, value_count, score``: a model on a column and its count, scored on a grid of given values and counts."""
    counted = count_encode(df, [column], suffix="_count").select(
        F.col(column).alias("value"), F.col(f"{column}_count").alias("value_count"), label
    )
    model = fit(counted, ["value", "value_count"], label, params)
    return model.score(value_count_grid(df.sparkSession, values, counts))


def in_range(score: str | Column = "score") -> Column:
    """Whether a score is a probability; null scores are not."""
    s = F.col(score) if isinstance(score, str) else score
    return F.coalesce(s.between(0.0, 1.0), F.lit(False))
