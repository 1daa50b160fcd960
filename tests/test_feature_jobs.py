"""The numbered jobs on a small transaction table, checked against direct computation in pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.operators import encoders, lookup
from featurekit.operators.lookup import with_row_id
from featurekit.plans import feature_jobs as jobs
from featurekit.session import scratch_path
from featurekit.sources import files
from featurekit.sources.catalog import FeatureCatalog

DAY = 86400
# Levels of the text columns of the test table.
LEVELS = {
    "card4": ["visa", "mastercard"], "card6": ["debit", "credit"], "ProductCD": ["W", "C", "H"], "M4": ["M0", "M1", "M2"],
    "P_emaildomain": ["gmail.com", "yahoo.com.mx", "att.net"], "R_emaildomain": ["gmail", "icloud.com"],
    "id_23": ["IP_PROXY:ANONYMOUS", "TRANSPARENT"], "id_30": ["Windows 10", "iOS 11.2.1", "func"],
    "id_31": ["chrome 65.0", "edge 17.0", "safari generic"], "id_33": ["1920x1080", "2220x1080"],
    "id_34": ["match_status:2", "match_status:0"], "DeviceInfo": ["SM-G610M Build/MMB29K", "Windows", "rv:57.0"],
    "DeviceType": ["desktop", "mobile"],
}


def _draw(number: int):
    return F.pmod(F.xxhash64(F.col("TransactionID"), F.lit(number)), F.lit(1000))


def _fill(base, schema: T.StructType):
    """Every column of the schema, with values drawn from a hash of the key and about one null in five."""
    known, out = set(base.columns), []
    for i, field in enumerate(f for f in schema.fields if not f.name.startswith("V")):
        draw = _draw(i)
        if field.name in known:
            out.append(F.col(field.name))
            continue
        if isinstance(field.dataType, T.StringType):
            levels = LEVELS.get(field.name, ["T", "F"])
            value = F.element_at(F.array(*[F.lit(x) for x in levels]), (draw % len(levels) + 1).cast("int"))
        else:
            value = (draw % 7).cast(field.dataType)
        out.append(F.when(draw % 5 != 0, value).alias(field.name))
    return base.select(*out)


def _transactions(spark, first: int, last: int, start: int, span: int, labelled: bool):
    """Keys first..last spread over ``span`` days from day ``start``."""
    base = spark.range(first, last).select(
        F.col("id").alias("TransactionID"),
        (F.lit(start * DAY) + F.floor((F.col("id") - first) * span * DAY / (last - first))).cast("bigint").alias("TransactionDT"),
    )
    base = base.withColumns({"card1": (_draw(901) % 12).cast("int"), "TransactionAmt": (_draw(902) / 8 + 1).cast("double")})
    if labelled:
        base = base.withColumn("isFraud", (_draw(903) % 4 == 0).cast("int"))
    return _fill(base, files.transaction_schema(labelled))


def _identities(spark, first: int, last: int):
    keys = spark.range(first, last).select(F.col("id").alias("TransactionID")).where(_draw(904) < 600)
    return _fill(keys, files.identity_schema())


@pytest.fixture(scope="module")
def raw(spark):
    tables = [
        _transactions(spark, 0, 360, 1, 180, True), _identities(spark, 0, 360),
        _transactions(spark, 360, 600, 214, 150, False), _identities(spark, 360, 600),
    ]
    paths = [scratch_path(spark, n) for n in ("train_t", "train_i", "test_t", "test_i")]
    for table, path in zip(tables, paths):
        files.write_table(table, path)
    return [files.read_table(spark, p) for p in paths]


@pytest.fixture(scope="module")
def df(spark, raw):
    path = scratch_path(spark, "joined")
    files.write_table(jobs.joined_table(*raw), path)
    return with_row_id(files.read_table(spark, path), "TransactionID")


@pytest.fixture(scope="module")
def pdf(df):
    frame = df.toPandas().sort_values("TransactionID").reset_index(drop=True)
    moment = pd.Timestamp("2017-12-01") + pd.to_timedelta(frame["TransactionDT"], unit="s")
    return frame.assign(month=(moment.dt.year - 2017) * 12 + moment.dt.month, day=moment.dt.strftime("%Y%m%d"))


def _result(frame, count):
    assert len(frame.columns) == count + 2
    result = frame.toPandas().sort_values("TransactionID").reset_index(drop=True)
    assert len(result) == 600
    return result


def _same(actual, expected):
    np.testing.assert_allclose(actual.astype(float), expected.astype(float), rtol=1e-6, atol=1e-12)


def test_joined_table(df):
    assert df.count() == 600
    assert df.where("dataset = 'test' and isFraud is not null").count() == 0
    assert 0 < df.where("DeviceType is null").count() < 600


def test_amount_ratios(df, pdf):
    result = _result(jobs.amount_ratios(df), 16)
    _same(result["D15_to_mean_addr1"], pdf["D15"] / pdf.groupby(["dataset", "addr1"])["D15"].transform("mean").replace(0, np.nan))
    _same(result["TransactionAmt_to_std_card4"], pdf["TransactionAmt"] / pdf.groupby(["dataset", "card4"])["TransactionAmt"].transform("std"))


def test_latest_browser(df, pdf):
    result = _result(jobs.latest_browser(df), 1)
    assert (result["latest_browser"] == pdf["id_31"].isin(["chrome 65.0", "edge 17.0"]).astype(int)).all()
    assert result["latest_browser"].sum() > 0


def test_interactions_and_counts(df, pdf):
    result = _result(jobs.interactions_and_counts(df), 21)
    joined = pdf["card1"].map(str) + "_" + pdf["card5"].map(str)
    codes = {text: i for i, text in enumerate(sorted(joined.unique()))}
    assert (result["card1__card5"] == joined.map(codes)).all()
    per_dataset = pdf.assign(v=pdf["id_01"].fillna(-1)).groupby(["dataset", "v"])["v"].transform("size")
    assert (result["id_01_count_dist"] == per_dataset).all()
    assert (result["card1_count_full"] == pdf.groupby("card1")["card1"].transform("size")).all()
    limited = jobs.interactions_and_counts(df, useful=["id_36", "id_01"])
    assert len(limited.columns) == 19 and "id_34_count_full" not in limited.columns


def test_only_wanted_codes_are_joined_and_texts_are_not_shuffled(df, monkeypatch):
    all_codes = {c: list(jobs.interactions(df).toPandas().sort_values("TransactionID")[c]) for c in ("card1__card5", "addr1__card1")}
    monkeypatch.setattr(lookup, "LIMIT", lookup.BroadcastLimit(0, 0))
    monkeypatch.setattr(encoders, "LIMIT", lookup.LIMIT)
    shuffled = jobs.interactions(df, [("card1", "card5"), ("addr1", "card1")])
    plan = shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert "__text_" not in plan and "Expand" not in plan
    result = shuffled.toPandas().sort_values("TransactionID")
    assert all(list(result[c]) == codes for c, codes in all_codes.items())
    counts = jobs.interactions_and_counts(df, ["id_36"], pairs=[])
    assert "position" not in counts._jdf.queryExecution().optimizedPlan().toString() and len(counts.columns) == 8


def test_count_encodings(df, pdf):
    result = _result(jobs.count_encodings(df), 46)
    for column in ("card4", "addr1", "id_38"):
        values = pdf[column].astype(object).where(pdf[column].notna(), "missing")
        assert (result[f"{column}_CE"] == values.map(values.value_counts())).all()


def test_time_features(df, pdf):
    measured = ["TransactionAmt", "card1", "dist1", "C1", "M4"]
    result = _result(jobs.time_features(df, measured), 13)
    moment = pd.Timestamp("2017-12-01") + pd.to_timedelta(pdf["TransactionDT"], unit="s")
    assert (result["dow"] == moment.dt.dayofweek).all() and (result["hour"] == moment.dt.hour).all()
    assert (result["date_block"] == moment.dt.year * 100 + moment.dt.month).all()
    _same(result["all_group_nan_sum"], pdf[measured].isna().mean(axis=1))
    _same(result["all_group_0_count"], (pdf[measured] == 0).sum(axis=1) / pdf[measured].notna().sum(axis=1))


def _monthly(pdf, column, function, rows=None):
    source = pdf if rows is None else pdf[rows]
    return source.groupby("month")[column].agg(function)


def test_numeric_lags(df, pdf):
    result = _result(jobs.numeric_lags(df), 61)
    monthly = _monthly(pdf, "dist1", "mean")
    _same(result["dist1_mean__lag2"], pdf["month"].map(monthly.shift(2)))
    _same(result["date_block_num"], pdf["month"].map({m: i for i, m in enumerate(monthly.index)}))


def test_card_count_lags(df, pdf):
    result = _result(jobs.card_count_lags(df), 5)
    months = sorted(pdf["month"].unique())
    counts = pd.crosstab(pdf["card1"], pdf["month"])
    for lag in (0, 3):
        expected = []
        for card, month in zip(pdf["card1"], pdf["month"]):
            at = months.index(month) - lag
            expected.append(np.nan if at < 0 else counts.loc[card, months[at]])
        _same(result[f"card1_counts__lag{lag}"], pd.Series(expected))


def test_record_counts(df, pdf):
    result = _result(jobs.record_counts(df), 2)
    assert (result["daily_count"] == pdf.groupby(["dataset", "day"])["day"].transform("size")).all()


def test_share_lags_have_no_data_in_the_gap(df, pdf):
    result = _result(jobs.share_lags(df, "C13"), 7)
    known = pdf[pdf["C13"].notna()]
    shares = known.groupby(["month", "C13"]).size() / known.groupby("month").size()
    present = set(known["month"])
    for lag in (0, 1, 6):
        expected = [
            np.nan if pd.isna(v) or m - lag not in present else shares.get((m - lag, v), 0.0) for v, m in zip(pdf["C13"], pdf["month"])
        ]
        _same(result[f"C13_counts__lag{lag}"], pd.Series(expected))
    assert 18 not in present and result.loc[pdf["month"] == 19, "C13_counts__lag1"].isna().all()


def test_pseudo_label_lags(df, pdf):
    scores = df.select("TransactionID", (F.col("TransactionAmt") / 200).alias("pseudo_label"))
    result = _result(jobs.pseudo_label_lags(df, scores), 5)
    monthly = (pdf["TransactionAmt"] / 200).groupby(pdf["month"]).mean()
    _same(result["pseudo_label__lag0"], pdf["month"].map(monthly))
    moved = monthly.shift(2)
    moved.index = moved.index + 1
    _same(result["pseudo_label__lag2"], pdf["month"].map(moved))


def test_train_lags(df, pdf):
    result = _result(jobs.train_lags(df), 20)
    monthly = _monthly(pdf, "D9", "max", pdf["dataset"] == "train")
    _same(result["D9_max__lag1"], pdf["month"].map(monthly.shift(1)))
    assert result.loc[pdf["dataset"] == "test", "D9_mean__lag0"].isna().all()


def test_target_lags(df, pdf):
    frame = jobs.target_lags(df, ["D9", "card4"])
    assert frame.schema["isFraud_mean__lag1"].dataType == T.FloatType()
    result = _result(frame, 8)
    train = pdf[pdf["dataset"] == "train"]
    means = train.groupby(["month", "D9", "card4"])["isFraud"].mean()
    expected = [means.get((m - 2, d, c), np.nan) for m, d, c in zip(pdf["month"], pdf["D9"], pdf["card4"])]
    _same(result["isFraud_mean__lag2"], pd.Series(expected))
    assert result["isFraud_mean__lag2"].notna().sum() > 0
    tied = _result(jobs.target_lags(df, ["D9", "card4"], include_label=True), 8)
    assert set(tied["isFraud_mean__lag1"].dropna()) <= {0.0, 1.0}


def test_job_through_the_catalogue(spark, df):
    catalog = FeatureCatalog(spark, scratch_path(spark, "features"))
    stored = catalog.feature("f205", "date_count")(jobs.record_counts)(df)
    assert "f205__daily_count" in stored.columns
    assert catalog.attach(df.select("TransactionID", "isFraud"), "f205").count() == 600


# A short list of columns for the two whole-table jobs.
USEFUL = [
    "TransactionAmt", "ProductCD", "card1", "card2", "card3", "card4", "card5", "card6", "addr1", "dist1", "P_emaildomain", "R_emaildomain",
    "C2", "D8", "D11", "D15", "M4", "id_01", "id_02", "id_20", "id_31", "id_33", "id_36", "DeviceInfo", "device_name", "screen_width", "had_id",
]


def test_prepared_table(raw):
    prepared = jobs.prepared_table(*raw, useful=USEFUL)
    assert [c for c, t in prepared.dtypes if t == "string"] == ["dataset"]
    rows = prepared.toPandas()
    assert len(rows) == 600
    assert set(rows["device_name"]) == {0, 1}  # every device is rarer than 200 rows, so it is "Others" or missing
    assert {"P_emaildomain_bin", "R_emaildomain_suffix", "TransactionAmt_Log", "card1_count_full", "addr1__card1"} <= set(rows)
    assert dict(prepared.dtypes)["TransactionAmt"] == "float" and dict(prepared.dtypes)["isFraud"] == "tinyint"


def test_encoded_table(df, pdf):
    wanted = sorted({*jobs.FREQUENCY_ENCODED, *jobs.REPLACED_BY_FREQUENCY, *[f"M{i}" for i in range(1, 10)], "id_12", "id_15", "id_16",
                     "id_23", "id_27", "id_28", "id_29", "id_31", "id_33", "id_34", "id_35", "id_36", "id_37", "id_38", "DeviceType",
                     "TransactionID", "dataset", "isFraud"})
    encoded = jobs.encoded_table(df.select(*wanted))
    assert [c for c, t in encoded.dtypes if t == "string"] == ["dataset"]
    rows = encoded.toPandas().sort_values("TransactionID").reset_index(drop=True)
    assert len(rows) == 600
    _same(rows["M1"], pdf["M1"].map({"T": 1, "F": 0}))
    _same(rows["ProductCD"], pdf["ProductCD"].map(pdf["ProductCD"].value_counts()))
    _same(rows["f000__addr1__fq_enc"], pdf["addr1"].map(pdf["addr1"].value_counts()))
    frequent = pdf.loc[pdf["dataset"] == "train", "card1"].value_counts()
    _same(rows["card1"], pdf["card1"].where(pdf["card1"].isin(frequent[frequent > 10].index)))
