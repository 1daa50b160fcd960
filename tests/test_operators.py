"""Operators on small frames with null keys, single-row groups, constant groups and missing periods."""

from __future__ import annotations

import math
from statistics import stdev

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featurekit.operators import columns, encoders, groups, lags, profile, sets, splits
from featurekit.operators.lookup import BroadcastLimit
from featurekit.sources.files import clean_numbers


@pytest.fixture(scope="module")
def tx(spark):
    rows = [
        (1, "train", 10, 5.0, 1), (2, "train", 10, 15.0, 0), (3, "train", None, 7.0, 1), (4, "train", 20, 3.0, 0),
        (5, "train", 30, 4.0, 0), (6, "train", 30, 4.0, 1), (7, "test", 10, 8.0, None), (8, "test", 40, 9.0, None),
        (9, "test", None, 2.0, None),
    ]
    return spark.createDataFrame(rows, "id bigint, ds string, card bigint, amt double, y int")


def _by_id(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_ratio_of_null_single_and_constant_groups(tx):
    result = groups.group_ratios(tx, ["amt"], ["card"], ["ds"])
    means, deviations = _by_id(result, "amt_to_mean_card"), _by_id(result, "amt_to_std_card")
    assert means[1] == 0.5 and means[4] == 1.0 and means[3] is None and means[8] == 1.0
    assert deviations[1] == pytest.approx(5.0 / stdev([5.0, 15.0]))
    assert deviations[4] is None and deviations[5] is None and deviations[3] is None


def test_equal_values_of_many_tasks_have_no_deviation(spark):
    # A task holds thirteen rows of a card, and 8128.17 / 13 * 13 is not 8128.17.
    rows = spark.range(0, 104, numPartitions=4).selectExpr("id", "'train' AS ds", "id % 2 AS card", "8128.17D AS amt", "0.1D * (id % 3) AS other")
    result = groups.group_ratios(rows, ["amt", "other"], ["card"], ["ds"]).collect()
    assert {r["amt_to_std_card"] for r in result} == {None}
    assert all(r["other_to_std_card"] is not None for r in result)
    stats = groups.group_stats(rows, "card", ["amt"], ["std"]).collect()
    assert [r["amt_std"] for r in stats] == [0.0, 0.0]


def test_count_encodings_and_nulls(tx):
    assert _by_id(encoders.count_encode(tx, ["card"]), "card_count_full") == {1: 3, 2: 3, 3: 2, 4: 1, 5: 2, 6: 2, 7: 3, 8: 1, 9: 2}
    separate = _by_id(encoders.count_encode(tx, ["card"], ["ds"], "_d"), "card_d")
    assert (separate[1], separate[3], separate[7], separate[9]) == (2, 1, 1, 1)
    kept = _by_id(encoders.count_encode(tx, ["card"], suffix="_f", nulls=False), "card_f")
    assert kept[3] is None and kept[9] is None and kept[1] == 3


def test_count_encoding_merges_negative_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, None)], "id bigint, x double")
    assert _by_id(encoders.count_encode(df, ["x"]), "x_count_full") == {1: 2, 2: 2, 3: 1}


def test_target_mean_of_unseen_value_is_null(tx):
    result = _by_id(encoders.target_mean_encode(tx, ["card"], "y", F.col("ds") == "train"), "card__target_mean")
    assert result == {1: 0.5, 2: 0.5, 3: None, 4: 0.0, 5: 0.5, 6: 0.5, 7: 0.5, 8: None, 9: None}


def test_rare_values(tx):
    kept = _by_id(encoders.null_rare(tx, "card", F.col("ds") == "train", above=1), "card")
    assert kept == {1: 10, 2: 10, 3: None, 4: None, 5: 30, 6: 30, 7: 10, 8: None, 9: None}
    named = tx.withColumn("card", F.col("card").cast("string"))
    assert _by_id(encoders.bucket_rare(named, "card", 2, ["ds"]), "card") == {
        1: "10", 2: "10", 3: None, 4: "Others", 5: "30", 6: "30", 7: "Others", 8: "Others", 9: None
    }


def test_label_codes(tx):
    codes = _by_id(encoders.label_encode(tx, ["card", "amt"]), "card_code")
    assert codes == {1: 0, 2: 0, 3: 4, 4: 1, 5: 2, 6: 2, 7: 0, 8: 3, 9: 4}
    assert _by_id(encoders.label_encode(tx, ["ds"], missing=None), "ds_code")[7] == 0
    pairs = _by_id(encoders.pair_codes(tx, [("card", "ds")]), "card__ds")
    texts = {r["id"]: f"{r['card'] if r['card'] is not None else 'nan'}_{r['ds']}" for r in tx.collect()}
    order = {t: i for i, t in enumerate(sorted(set(texts.values())))}
    assert pairs == {i: order[t] for i, t in texts.items()}


def test_group_stats_names_and_null_groups(tx):
    stats = groups.group_stats(tx, ["ds", "card"], "amt", ["min", "mean", "max", "std"], "p_", "_s")
    assert stats.columns == ["ds", "card", "p_amt_min_s", "p_amt_mean_s", "p_amt_max_s", "p_amt_std_s"]
    rows = {(r["ds"], r["card"]): r for r in stats.collect()}
    assert ("train", None) not in rows and rows[("train", 20)]["p_amt_std_s"] is None
    assert groups.join_back(tx, groups.group_stats(tx, "card", "amt", "mean"), "card").count() == 9
    assert groups.join_back(tx, groups.group_stats(tx, "card", "amt", "mean"), "card", "inner").count() == 7


def test_wide_counts(tx):
    wide = {r["card"]: r for r in groups.counts_and_ratios(tx, "card", ["y"], {"y": [0, 1]}).collect()}
    assert (wide[10]["yCnt_0"], wide[10]["yRatio_1"], wide[40]["yCnt_0"], wide[40]["yRatio_0"]) == (1, 0.5, 0, None)
    long = {(r["card"], r["value"]): (r["n"], r["ratio"]) for r in groups.counts_and_ratios_long(tx, "card", ["y"]).collect()}
    assert long[10, "0"] == (1, 0.5) and not any(card in (None, 40) for card, _ in long)
    many = tx.sparkSession.range(5000).selectExpr("1 AS g", "id AS v")
    assert groups.counts_and_ratios_long(many, "g", ["v"]).count() == 5000


@pytest.fixture(scope="module")
def periods(spark):
    rows = [(12, "a"), (12, "a"), (12, "b"), (13, "b"), (14, "a"), (15, None), (16, "b"), (17, "a"), (19, "a"), (20, "c"), (20, "a")]
    return spark.createDataFrame([(i, p, k) for i, (p, k) in enumerate(rows)], "id bigint, period int, key string")


@pytest.mark.parametrize("share", [False, True])
def test_key_lags_zero_and_null(periods, share):
    rows = [(r["period"], r["key"]) for r in periods.orderBy("id").collect()]
    present = {p for p, k in rows if k is not None}

    def expected(p, k, n):
        if k is None or p - n not in present:
            return None
        hits = rows.count((p - n, k))
        return hits / sum(1 for q, j in rows if q == p - n and j is not None) if share else hits

    result = lags.key_lags(periods, "key", "period", [0, 1, 2, 6], share=share).orderBy("id").collect()
    for (p, k), r in zip(rows, result):
        assert [r[f"key_counts__lag{n}"] for n in (0, 1, 2, 6)] == [expected(p, k, n) for n in (0, 1, 2, 6)]


def test_period_lags_shift_rows_not_values(periods):
    rows = periods.withColumn("x", F.col("id").cast("double"))
    result = {r["period"]: r for r in lags.period_lags(rows, "period", ["x"], ["max"], [0, 1]).collect()}
    assert result[19]["x_max__lag1"] == result[17]["x_max__lag0"]
    assert result[12]["x_max__lag1"] is None


def test_train_only_lags_are_null_for_later_periods(periods):
    rows = periods.withColumn("x", F.col("id").cast("double"))
    result = {r["period"]: r for r in lags.period_lags(rows, "period", ["x"], ["mean"], [0, 1], fit=F.col("period") < 18).collect()}
    assert result[19]["x_mean__lag0"] is None and result[20]["x_mean__lag1"] is None
    assert result[17]["x_mean__lag1"] == 6.0


def test_extra_offset_moves_lags(periods):
    rows = periods.withColumn("x", F.col("id").cast("double"))
    plain = {r["period"]: r for r in lags.period_lags(rows, "period", ["x"], ["mean"], [0, 1]).collect()}
    moved = {r["period"]: r for r in lags.period_lags(rows, "period", ["x"], ["mean"], [0, 1], extra=1).collect()}
    assert moved[15]["x_mean__lag1"] == plain[14]["x_mean__lag1"] == plain[13]["x_mean__lag0"]
    assert moved[19]["x_mean__lag1"] is None and moved[15]["x_mean__lag0"] == plain[15]["x_mean__lag0"]


def test_target_lags_with_label_in_the_key(periods):
    rows = periods.withColumn("y", (F.col("id") % 2).cast("int"))
    free = {r["id"]: r["y_mean__lag1"] for r in lags.target_lags(rows, "period", ["key"], "y", [1]).collect()}
    tied = {r["id"]: r["y_mean__lag1"] for r in lags.target_lags(rows, "period", ["key"], "y", [1], include_label=True).collect()}
    assert free[3] == 0.0 and tied[3] is None
    assert free[9] is None and free[5] is None and free[10] == 0.0 and tied[10] == 0.0


def test_narrow_types(spark):
    df = spark.createDataFrame(
        [(1, 126, 127, 40000, 2**40, 1.5, 1e300, None), (2, -127, 0, 0, 0, 2.5, 0.0, None)],
        "id bigint, a bigint, b bigint, c bigint, d bigint, e double, f double, g int",
    )
    narrow = {f.name: f.dataType.simpleString() for f in columns.narrow_types(df).schema.fields}
    assert narrow == {"id": "tinyint", "a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float", "f": "double", "g": "int"}
    report = {r["column"]: (r["old_bytes"], r["new_bytes"]) for r in columns.narrowing_report(df).collect()}
    assert report["a"] == (8, 1) and report["e"] == (8, 4)


def test_fill_and_categories(spark):
    df = spark.createDataFrame([(1, None, None, 2.5)], "id bigint, s string, n int, x double")
    filled = columns.fill_sentinels(df, number=-9999, skip=["id"]).first()
    assert (filled["s"], filled["n"], filled["x"]) == ("__NA__", -9999, 2.5)
    typed = columns.as_categories(df, ["s", "n"])
    assert columns.categorical_columns(typed) == ["s", "n"] and typed.first()["n"] == "__NA__"
    assert columns.columns_of(df, "text") == ["s"] and columns.columns_of(df, "numeric") == ["id", "n", "x"]
    assert columns.drop_matching(df, "s").columns == ["id", "n", "x"]
    assert columns.overwrite_where(df, "x", F.col("n") > 0, F.lit(0.0)).first()["x"] == 2.5


def test_union_fills_the_missing_label(spark):
    train, test = spark.createDataFrame([(1, 1)], "id int, y int"), spark.createDataFrame([(2,)], "id int")
    both = sets.stack_datasets(train, test)
    assert {r["id"]: (r["y"], r["dataset"]) for r in both.collect()} == {1: (1, "train"), 2: (None, "test")}
    assert sets.take_dataset(both, "test").count() == 1


def test_category_difference_counts_null_as_value(tx):
    found = {(r["value"], r["only_in"]) for r in sets.category_difference(tx, ["card"], F.col("ds") == "train").collect()}
    assert found == {("20", "train"), ("30", "train"), ("40", "test")}


def test_value_count_grid(tx):
    grid = {(r["value"], r["value_count"]) for r in sets.value_count_grid(tx.sparkSession, [10, 20.5], (1, 2, 3)).collect()}
    assert grid == {(v, n) for v in (10.0, 20.5) for n in (1, 2, 3)}
    with pytest.raises(ValueError):
        sets.value_count_grid(tx.sparkSession, range(10), range(10), limit=99)


def test_top_values_rank_in_parts_first(spark):
    df = spark.range(3000).selectExpr("id % 1500 AS v")
    top = sets.top_values(df, ["v"], 1200)
    assert top.count() == 1200 and top._jdf.queryExecution().executedPlan().toString().count("Window") >= 2


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(i, "g", float(i) if i != 4 else nan) for i in range(10)], "id int, g string, x double")
    assert {r["bin"]: r["n"] for r in profile.histogram(df, "x", 3).collect()} == {0: 3, 1: 2, 2: 4}
    bins = {r["id"]: r["bin"] for r in profile.quantile_bins(df, "x", 3).collect()}
    assert bins[4] is None and bins[9] == 2
    assert all(r["density"] == r["density"] for r in profile.density(df, "x", "g", points=5).collect())
    stats = groups.group_stats(df, "g", "x", ["mean", "max", "count"]).first()
    assert (stats["x_max"], stats["x_count"]) == (9.0, 9) and abs(stats["x_mean"] - 41 / 9) < 1e-12
    pairs = groups.correlations(df.selectExpr("x", "CAST(id AS double) AS y"), ["x", "y"]).first()
    assert abs(pairs["r"] - 1) < 1e-12
    row = profile.column_profile(df, ["x"]).first()
    assert (row["nulls"], row["max"]) == (1, 9.0)


def test_quantile_bins_drop_repeated_edges(spark):
    data = [1.0] * 60 + [2.0] * 20 + [3.0] * 10 + [float(v) for v in range(4, 14)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, x double")
    edges = profile.quantile_edges(df, "x", 10)
    assert edges == sorted(set(edges)) and edges[0] == 1.0 and edges[-1] == 13.0 and len(edges) < 11
    bins = {r["x"]: r["bin"] for r in profile.quantile_bins(df, "x", 10).collect()}
    assert bins[1.0] == 0 and bins[13.0] == len(edges) - 2
    assert profile.quantile_edges(df.where("x is null"), "x", 4) == []


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(df, "x", 10).collect()] == [(5, 2)]


def test_density_sums_to_one(spark):
    df = spark.range(500).select((F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 2).alias("g"))
    rows = profile.density(df, "x", "g", points=200).collect()
    xs = sorted({r["x"] for r in rows})
    for g in (0, 1):
        assert math.isclose(sum(r["density"] for r in rows if r["g"] == g) * (xs[1] - xs[0]), 1.0, abs_tol=0.01)


def test_row_count_guard(tx):
    assert profile.shape(tx) == (9, 5)
    with pytest.raises(ValueError):
        profile.require_same_rows(8, tx)


def test_folds_cover_every_row_once(spark):
    df = spark.range(1003).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"), (F.col("id") / 10).cast("int").alias("t"))
    folds = splits.stratified_kfold(df, "id", "y", 5)
    sizes = {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        counts = [sizes[(y, f)] for f in range(5)]
        assert max(counts) - min(counts) <= 1
    assert splits.kfold(df, "id", 5).distinct().count() == 1003
    chunks = {r["chunk"]: r["count"] for r in splits.time_series_folds(df, "id", "t", 5).groupBy("chunk").count().collect()}
    assert chunks == {0: 168, 1: 167, 2: 167, 3: 167, 4: 167, 5: 167}
    blocks = [r["count"] for r in splits.ordered_kfold(df, "id", "t", 5).groupBy("fold").count().orderBy("fold").collect()]
    assert blocks == [201, 201, 201, 200, 200]
    assert sorted(r["position"] for r in splits.shuffled(df, "id").collect()) == list(range(1003))


def test_time_series_roles_train_on_everything_before(spark):
    df = spark.range(60).select("id", F.col("id").alias("t"))
    roles = splits.time_series_roles(splits.time_series_folds(df, "id", "t", 5), 5, last=2).collect()
    for fold, border in ((4, 40), (5, 50)):
        train = [r["id"] for r in roles if r["fold"] == fold and r["role"] == "train"]
        valid = [r["id"] for r in roles if r["fold"] == fold and r["role"] == "valid"]
        assert sorted(train) == list(range(border)) and sorted(valid) == list(range(border, border + 10))


def test_category_tables_can_be_sorted(tx):
    is_train = F.col("ds") == "train"
    by_name = [r["value"] for r in profile.category_frequencies(tx, "card", is_train, sort="alphabetic").collect()]
    assert by_name == ["10", "20", "30", "40", "__NA__"]
    top = profile.category_frequencies(tx, "card", is_train, top=2, sort="freq").collect()
    assert [(r["value"], r["n_train"], r["n_test"]) for r in top] == [("10", 2, 1), ("30", 2, 0)]
    train, test = tx.where("ds = 'train'"), tx.where("ds = 'test'")
    table = groups.category_target_table(train, test, "card", "y", sort="freq").collect()
    assert [r["card"] for r in table] == [10, 30, 20, 40]
    assert (table[0]["target_mean"], table[0]["freq_train"], table[3]["freq_test"]) == (0.5, 2 / 6, 0.5)


def test_correlations_and_profile_of_a_wide_table(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(400, 120)) * 50 + 1e6, columns=[f"k{i}" for i in range(120)]).mask(rng.random((400, 120)) < 0.2)
    pdf["same"], pdf["none"] = 3.0, np.nan
    df = clean_numbers(spark.createDataFrame(pdf).repartition(3))
    found = {(r.a, r.b): r.r for r in groups.correlations(df, list(pdf.columns)).collect()}
    expected = pdf.corr(min_periods=2)
    assert len(found) == 122 * 121 // 2
    for (a, b), r in found.items():
        assert r == pytest.approx(expected.loc[a, b], abs=1e-9) if a[0] == b[0] == "k" else r is None
    one = {(r.a, r.b): r.r for r in groups.correlations(df, list(pdf.columns), against="k5").collect()}
    assert len(one) == 121 and one["k7", "k5"] == pytest.approx(found["k5", "k7"])
    profiled = {r["column"]: r for r in profile.column_profile(df, list(pdf.columns)).collect()}
    for c in ("k0", "k77"):
        r = profiled[c]
        assert (r.n, r.nulls, r.uniques) == (400, pdf[c].isna().sum(), pdf[c].nunique())
        assert (r["mean"], r["std"], r["min"], r["max"]) == pytest.approx((pdf[c].mean(), pdf[c].std(), pdf[c].min(), pdf[c].max()))
    assert profiled["none"]["mean"] is None and profiled["same"]["std"] == 0 and profiled["none"].nulls == 400
    assert profile.column_profile(df.limit(0), ["k0"]).first().n == 0
    assert [tuple(r) for r in groups.correlations(df.limit(0), ["k0", "k1"]).collect()] == [("k0", "k1", None)]


def test_correlations_in_blocks(spark, monkeypatch):
    df = spark.range(60).selectExpr("id AS a", "id * id AS b", "hash(id) AS c", "hash(id, 2) AS d")
    whole = groups.correlations(df, ["a", "b", "c", "d"]).collect()
    monkeypatch.setattr(groups, "PAIR_CELLS", 24)
    parts = groups.correlations(df, ["a", "b", "c", "d"]).collect()
    assert [r.r for r in sorted(parts)] == pytest.approx([r.r for r in sorted(whole)])


def test_small_dictionaries_need_no_join(spark, monkeypatch):
    texts = ["a", None, 'say "hi"', "back\\slash", "it's", "Ünï ", "", "nan"]
    rows = [(i, texts[i % 8], [0.0, -0.0, 1.5, None, float("nan")][i % 5], i % 3, None) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, s string, x double, k bigint, e string")
    names = ["s", "x", "k", "e"]

    def made():
        counted = encoders.count_encode(encoders.count_encode(df, names), names, suffix="_f", nulls=False)
        return encoders.label_encode(encoders.label_encode(counted, names), ["s", "e"], suffix="_l", missing=None)

    inline = made()
    assert "Join" not in inline._jdf.queryExecution().executedPlan().toString()
    # The look-ups are constants that are parsed once, not for every row.
    assert "from_json" not in inline._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(encoders, "INLINE", BroadcastLimit(0, -1))
    joined = made()
    assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
    assert inline.dtypes == joined.dtypes
    plain = [[tuple(map(str, r)) for r in sorted(t.collect(), key=lambda r: r["id"])] for t in (inline, joined)]
    assert plain[0] == plain[1]


def test_kept_values_come_with_their_count(spark):
    rows = [(i, c, ds) for i, (c, ds) in enumerate([("a", "train")] * 3 + [("a", "test")] + [("b", "train")] + [("b", "test")] * 4 + [(None, "train")] * 3)]
    df = spark.createDataFrame(rows, "id int, card string, ds string")
    kept = encoders.null_rare(df, "card", F.col("ds") == "train", above=1, count="n")
    assert kept.columns == ["id", "card", "ds", "n"]
    assert {(r["card"], r["n"]) for r in kept.collect()} == {("a", 4), (None, None)}
