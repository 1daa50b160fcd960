"""Queries that train histogram boosters small enough for SQL to grow the same trees: splits, scores, AUC and gains are compared.

The columns have fewer values than bins, so every value is a bin of its own on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.models import histogram
from featurekit.operators import splits
from featurekit.operators.encoders import count_encode
from featurekit.plans.registry import TX, query, rounded, transactions
from featurekit.plans.splitting import _hash
from featurekit.session import scratch_path

FOLDS, ROUNDS = 5, 3
_UNIT = histogram.UNIT
_FOLD = f"CAST({_hash()} % {FOLDS} AS INTEGER)"
_SPARSE = "CASE WHEN o_orderkey % 5 <> 0 THEN period END"


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = transactions(spark, sf_dir, customer=True).where(F.col("dataset") == "train")
    sparse = train.withColumn("sparse", F.when(F.col("o_orderkey") % 5 != 0, F.col("period")))
    return splits.with_kfold(sparse, "o_orderkey", FOLDS)


def _gradients(margin: str, y: str) -> str:
    p = f"(1 / (1 + exp(-({margin}))))"
    return f"CAST(round(({p} - {y}) * {_UNIT}) AS BIGINT) AS g, CAST(round({p} * (1 - {p}) * {_UNIT}) AS BIGINT) AS h"


def _score(g: str, h: str, l1: float, l2: float) -> str:
    return f"(pow(greatest(abs(({g}) / {_UNIT}.0::DOUBLE) - {l1}::DOUBLE, 0), 2) / (({h}) / {_UNIT}.0::DOUBLE + {l2}::DOUBLE))"


def _best(name: str, cells: str, by: str, l1: float = 0, l2: float = 0, least: int = 20) -> str:
    """CTEs up to ``{name}``: per ``by`` the best (f, v, nl) of ``cells`` (by, f, v, g, h, n), with its gain and the sums of both sides."""
    over, sums = f"PARTITION BY {by}, f", ("g", "h", "n")
    low = ", ".join(f"sum(CASE WHEN v IS NOT NULL THEN {c} ELSE 0 END) OVER ({over} ORDER BY v NULLS FIRST) AS l{c}" for c in sums)
    null = ", ".join(f"sum(CASE WHEN v IS NULL THEN {c} ELSE 0 END) OVER ({over}) AS n{c}, sum({c}) OVER ({over}) AS a{c}" for c in sums)
    gain = f"{_score('lg', 'lh', l1, l2)} + {_score('ag - lg', 'ah - lh', l1, l2)} - {_score('ag', 'ah', l1, l2)}"
    return f"""{name}_s AS (SELECT {by}, f, v, sum(g) AS g, sum(h) AS h, sum(n) AS n FROM {cells} GROUP BY ALL),
      {name}_w AS (SELECT {by}, f, v, {low}, {null} FROM {name}_s),
      {name}_o AS (SELECT {by}, f, v, nl, ag, ah, an, {', '.join(f'l{c} + CASE WHEN nl THEN n{c} ELSE 0 END AS l{c}' for c in sums)}
        FROM {name}_w, (SELECT unnest([TRUE, FALSE]) AS nl) WHERE v IS NOT NULL),
      {name}_g AS (SELECT *, {gain} AS gain FROM {name}_o WHERE ln >= {least} AND an - ln >= {least} AND least(lh, ah - lh) >= {_UNIT} * 0.001::DOUBLE),
      {name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY gain DESC, f, v, NOT nl) AS place FROM {name}_g) WHERE place = 1 AND gain > 0)"""


def _goes_left(split: str, value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN {split}.nl ELSE {value} <= {split}.v END"


_L1, _L2 = 0.5, 1.0


def _tree_sql() -> str:
    both = "SELECT {by}, 0 AS f, a AS v, g, h, 1 AS n FROM {t} UNION ALL SELECT {by}, 1, b, g, h, 1 FROM {t}"
    value = f"-sign(sum(g)) * greatest(abs(sum(g) / {_UNIT}.0::DOUBLE) - {_L1}::DOUBLE, 0) / (sum(h) / {_UNIT}.0::DOUBLE + {_L2}::DOUBLE)"
    own = "CASE WHEN {s}.f = 0 THEN t.a ELSE t.b END"
    return f"""WITH {TX}, rows AS (SELECT c_nationkey AS a, {_SPARSE} AS b, y FROM tx WHERE dataset = 'train'),
      start AS (SELECT ln(avg(y) / (1 - avg(y))) AS m FROM rows),
      gh AS (SELECT 0 AS node, a, b, m, {_gradients('m', 'y')} FROM rows, start),
      c1 AS ({both.format(by='node', t='gh')}), {_best('s1', 'c1', 'node', _L1, _L2)},
      half AS (SELECT t.* REPLACE (CASE WHEN {_goes_left('s1', own.format(s='s1'))} THEN 2 ELSE 3 END AS node) FROM gh t, s1),
      c2 AS ({both.format(by='node', t='half')}), {_best('s2', 'c2', 'node', _L1, _L2)},
      top AS (SELECT * FROM s2 ORDER BY gain DESC, node LIMIT 1),
      leaf AS (SELECT t.* REPLACE (CASE WHEN top.node IS NULL THEN t.node ELSE 2 * t.node + CASE WHEN {_goes_left('top', own.format(s='top'))} THEN 0 ELSE 1 END END AS node)
        FROM half t LEFT JOIN top ON top.node = t.node),
      value AS (SELECT node, {value} AS value FROM leaf GROUP BY node)
      SELECT DISTINCT leaf.a AS c_nationkey, leaf.b AS sparse, round(1 / (1 + exp(-(m + value))), 9) AS score FROM leaf JOIN value USING (node)"""


@query(_tree_sql())
def booster_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of three leaves over two columns, one with nulls, under both penalties: the score of every combination."""
    train = _train(spark, sf_dir)
    settings = histogram.Settings(rounds=1, learning_rate=1.0, num_leaves=3, lambda_l1=_L1, lambda_l2=_L2)
    boosters, _ = histogram.train(train, "y", [histogram.Model("all", ("c_nationkey", "sparse"))], settings)
    scored = histogram.score(train.select("c_nationkey", "sparse").distinct(), boosters, ["score"])
    return scored.withColumn("score", rounded("score", 9))


def _rounds_sql() -> str:
    """CTEs of a cross-validation of stumps on c_nationkey: ``m{r}``, margins after round r, and ``s{r}``, its splits, per left-out fold k."""
    value = f"-{{g}} / ({{h}}) * 0.5::DOUBLE"
    parts = [f"""{TX}, rows AS (SELECT {_FOLD} AS fold, c_nationkey AS v, y, count(*) AS n FROM tx WHERE dataset = 'train' GROUP BY ALL),
      models AS (SELECT unnest(range({FOLDS})) AS k), nations AS (SELECT DISTINCT v FROM rows),
      start AS (SELECT k, ln(sum(y * n) / (sum(n) - sum(y * n))::DOUBLE) AS m FROM models JOIN rows ON fold <> k GROUP BY k),
      m0 AS (SELECT k, v, m FROM start, nations)"""]
    for r in range(1, ROUNDS + 1):
        parts.append(f"""c{r} AS (SELECT k, 0 AS f, v, g * n AS g, h * n AS h, n FROM (SELECT m{r - 1}.k, rows.v, n, {_gradients('m', 'y')}
          FROM rows JOIN m{r - 1} ON m{r - 1}.v = rows.v AND fold <> k)), {_best(f's{r}', f'c{r}', 'k')},
          m{r} AS (SELECT p.k, p.v, m + CASE WHEN s.v IS NULL THEN 0 WHEN p.v <= s.v THEN {value.format(g='lg', h='lh')}
            ELSE {value.format(g='(ag - lg)', h='(ah - lh)')} END AS m FROM m{r - 1} p LEFT JOIN s{r} s ON s.k = p.k)""")
    return ", ".join(parts)


def _auc_sql() -> str:
    margins = " UNION ALL ".join(f"SELECT {r} AS round, * FROM m{r}" for r in range(1, ROUNDS + 1))
    return f"""WITH {_rounds_sql()}, cells AS (SELECT k, round, floor((m + 32) * 1024) AS cell, sum(y * n) AS pos, sum((1 - y) * n) AS neg
        FROM ({margins}) a JOIN rows ON rows.v = a.v AND fold = k GROUP BY ALL),
      won AS (SELECT *, pos * (sum(neg) OVER (PARTITION BY k, round ORDER BY cell) - neg / 2.0::DOUBLE) AS won FROM cells)
      SELECT CAST(k AS INTEGER) AS fold, round, round(sum(won) / (sum(pos) * sum(neg))::DOUBLE, 9) AS auc FROM won GROUP BY k, round"""


_STUMPS = histogram.Settings(rounds=ROUNDS, learning_rate=0.5, num_leaves=2)


@query(_auc_sql())
def booster_cv_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The AUC of every round on every left-out fold; all folds are trained in the same passes."""
    _, history = histogram.fit_folds(_train(spark, sf_dir), ["c_nationkey"], "y", _STUMPS, FOLDS)
    return history.withColumn("auc", rounded("auc", 9))


@query(f"""WITH {_rounds_sql()}, taken AS ({' UNION ALL '.join(f'SELECT k, gain FROM s{r}' for r in range(1, ROUNDS + 1))})
  SELECT CAST(k AS INTEGER) AS fold, 'c_nationkey' AS feature, round(sum(gain), 6) AS gain, CAST(count(*) AS INTEGER) AS splits FROM taken GROUP BY k""")
def booster_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total gain and number of splits per fold."""
    boosters, _ = histogram.fit_folds(_train(spark, sf_dir), ["c_nationkey"], "y", _STUMPS, FOLDS)
    table = histogram.importances(spark, boosters)
    return table.select(F.col("model").cast("int").alias("fold"), "feature", rounded("gain", 6), "splits")


@query(f"""WITH {_rounds_sql()} SELECT fold, rows.v AS c_nationkey, y, n, round(1 / (1 + exp(-m)), 9) AS score
  FROM rows JOIN m{ROUNDS} a ON a.k = fold AND a.v = rows.v""")
def booster_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold scores, counted by fold, value and label, of boosters that were stored and loaded again."""
    train, path = _train(spark, sf_dir), scratch_path(spark, "boosters")
    boosters, _ = histogram.fit_folds(train, ["c_nationkey"], "y", _STUMPS, FOLDS)
    histogram.save(boosters, spark, path)
    scored = histogram.out_of_fold(histogram.load(spark, path), train).withColumn("score", rounded("score", 9))
    return scored.groupBy("fold", "c_nationkey", "y", "score").agg(F.count(F.lit(1)).alias("n"))


_COMPARED = ["c_nationkey", "period", "sparse"]


def _compared_sql() -> str:
    columns = {c: _SPARSE if c == "sparse" else c for c in _COMPARED}
    counts = ", ".join(f"{e} AS {c}, count(*) OVER (PARTITION BY {e}) AS {c}_count" for c, e in columns.items())
    cells = " UNION ALL ".join(
        f"SELECT '{c}{more}' AS model, {f} AS f, {name} AS v, part, y, rn FROM rows"
        for c in _COMPARED for more, names in (("", [c]), ("+count", [c, f"{c}_count"])) for f, name in enumerate(names))
    left = _goes_left("s", "x.v")
    value = "-{g} / ({h}) * 0.1::DOUBLE"
    return f"""WITH {TX}, rows AS (SELECT {counts}, y, {_FOLD} AS part, row_number() OVER () AS rn FROM tx WHERE dataset = 'train'),
      start AS (SELECT ln(avg(y) / (1 - avg(y))) AS m FROM rows WHERE part <> 0), wide AS ({cells}),
      c AS (SELECT model, f, v, {_gradients('m', 'y')}, 1 AS n FROM wide, start WHERE part <> 0), {_best('s', 'c', 'model')},
      scored AS (SELECT x.model, y, m + CASE WHEN {left} THEN {value.format(g='lg', h='lh')} ELSE {value.format(g='(ag - lg)', h='(ah - lh)')} END AS m
        FROM wide x JOIN s ON s.model = x.model AND s.f = x.f, start WHERE part = 0),
      cells AS (SELECT model, floor((m + 32) * 1024) AS cell, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY ALL),
      won AS (SELECT *, pos * (sum(neg) OVER (PARTITION BY model ORDER BY cell) - neg / 2.0::DOUBLE) AS won FROM cells)
      SELECT model, round(sum(won) / (sum(pos) * sum(neg))::DOUBLE, 9) AS auc FROM won GROUP BY model"""


@query(_compared_sql())
def booster_feature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out AUC of a booster on each column alone and with its value count; all of them share every pass."""
    counted = count_encode(_train(spark, sf_dir), _COMPARED, suffix="_count")
    sets = {c + more: [c, *extra] for c in _COMPARED for more, extra in (("", []), ("+count", [f"{c}_count"]))}
    settings = histogram.Settings(rounds=1, num_leaves=2)
    return histogram.compare_features(counted, sets, "y", settings, "fold").withColumn("auc", rounded("auc", 9))
