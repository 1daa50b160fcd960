"""Files, the feature catalogue and control tables."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.session import checkpoint_root, scratch_path
from featurekit.sources import files
from featurekit.sources.catalog import FeatureCatalog


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "train", 2.0), (2, "train", 3.0), (3, "test", 4.0)], "TransactionID bigint, dataset string, x double")


@pytest.fixture
def catalog(spark):
    return FeatureCatalog(spark, scratch_path(spark, "catalog"))


def test_checkpoint_root_is_the_configured_folder(spark):
    assert checkpoint_root(spark) == spark.sparkContext.getCheckpointDir()


def test_save_prefixes_and_attach_joins(catalog, base):
    catalog.save(base.select("TransactionID", "dataset", (F.col("x") * 2).alias("twice")), "f101", "double")
    catalog.save(base.select("TransactionID", "dataset", (F.col("x") * 3).alias("f102__thrice")), "f102", "triple")
    assert catalog.ids() == ["f101", "f102"]
    for ids in ([], ["f101", "f102"]):
        rows = catalog.attach(base, ids).orderBy("TransactionID").collect()
        assert [(r["f101__twice"], r["f102__thrice"]) for r in rows] == [(4.0, 6.0), (6.0, 9.0), (8.0, 12.0)]
    assert catalog.attach(base, "f101").columns == ["TransactionID", "dataset", "x", "f101__twice"]


def test_ids_are_unique_and_must_exist(catalog, base):
    catalog.save(base, "f206", "one")
    catalog.save(base, "f206", "one")
    with pytest.raises(ValueError):
        catalog.save(base, "f206", "other")
    with pytest.raises(LookupError):
        catalog.load("f217")
    with pytest.raises(LookupError):
        catalog.attach(base, ["f206", "f217"])


def test_dataset_name_inside_table_name_is_harmless(catalog, base):
    catalog.save(base, "f300", "extra_train_stats")
    assert {r["dataset"] for r in catalog.load("f300").select("dataset").distinct().collect()} == {"train", "test"}


def test_decorated_job_is_stored(catalog, base):
    @catalog.feature("f400", "square")
    def square(df):
        return df.select("TransactionID", "dataset", (F.col("x") ** 2).alias("square"))

    assert "f400__square" in square(base).columns
    assert catalog.names("f400") == ["square"]


def test_repeated_key_is_refused(catalog, base):
    with pytest.raises(ValueError):
        catalog.save(base.unionByName(base), "f500", "twice")
    assert "twice" not in catalog.names("f500")


def test_csv_turns_nan_into_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,x,s\n1,NaN,a\n2,1.5,\n")
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), "id bigint, x double, s string").orderBy("id").collect()
    assert [(r["x"], r["s"]) for r in rows] == [(None, "a"), (1.5, None)]
    inferred = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(inferred.dtypes) == {"id": "int", "x": "double", "s": "string"}
    with pytest.raises(ValueError):
        files.read_csv(spark, "t.csv.zip")


def test_zip_archives_equal_the_plain_files(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
    (tmp_path / "plain").mkdir()
    parts = ["id,x,s\n" + "".join(f"{i},{'NaN' if i % 7 == 0 else i / 4},\"a,{i}\"\n" for i in range(at, at + 15_000)) for at in (0, 20_000)]
    with zipfile.ZipFile(tmp_path / "t.csv.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for i, text in enumerate(parts):
            (tmp_path / "plain" / f"{i}.csv").write_text(text)
            archive.writestr(f"{i}.csv", text)
        archive.writestr("notes.txt", "id,x,s\n99,1,no")
    plain = files.read_csv(spark, str(tmp_path / "plain"), schema)
    zipped = files.read_csv(spark, str(tmp_path / "t.csv.zip"), schema)
    assert zipped.schema == plain.schema and zipped.count() == 30_000
    assert zipped.exceptAll(plain).isEmpty() and plain.exceptAll(zipped).isEmpty()
    broken = bytearray((tmp_path / "t.csv.zip").read_bytes())
    broken[200:260] = bytes(60)
    (tmp_path / "broken.zip").write_bytes(broken)
    with pytest.raises(Exception, match="BadZipFile|zlib|CRC"):
        files.read_csv(spark, str(tmp_path / "broken.zip"), schema).count()


def test_bucketed_tables_join_without_moving_rows(spark, tmp_path):
    base = spark.range(500).select(F.col("id").alias("TransactionID"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("dataset"))
    plain, store = FeatureCatalog(spark, str(tmp_path / "p")), FeatureCatalog(spark, str(tmp_path / "b"), buckets=4)
    for i in range(10):
        made = base.where(F.col("TransactionID") % (i + 2) != 0).withColumn("v", F.col("TransactionID") * i)
        for catalog in (plain, store):
            catalog.save(made, f"f{i:03d}", "job")
    kept = store.save_base(base)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table, moved in ((kept, 0), (base, 1)):
            joined = store.attach(table)
            assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == moved
            assert joined.exceptAll(plain.attach(base).select(joined.columns)).isEmpty() and joined.count() == 500
        # A session that did not write the tables reads them by the catalogue's settings.
        for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("features_")]:
            spark.sql(f"DROP TABLE {name}")
        again = FeatureCatalog(spark, str(tmp_path / "b"), buckets=4).attach(base)
        assert again._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert again.exceptAll(plain.attach(base).select(again.columns)).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_schemas():
    transaction = files.transaction_schema()
    assert transaction["card1"].dataType.simpleString() == "int" and transaction["V339"].dataType.simpleString() == "double"
    assert "isFraud" not in files.transaction_schema(labelled=False).names
    identity = files.identity_schema()
    assert identity["id_31"].dataType.simpleString() == "string" and identity["id_02"].dataType.simpleString() == "double"
    assert len(identity.names) == 41


def test_split_round_trip_and_removed_columns(spark, base, tmp_path):
    files.write_split(base.select("TransactionID", F.lit("valid").alias("role")).where("TransactionID < 3"), str(tmp_path / "s"))
    assert files.read_split(spark, str(tmp_path / "s"), base, "TransactionID").count() == 2
    control = spark.createDataFrame([("a",), ("uid2",), ("b",)], "features_to_remove string")
    assert files.removed_columns(control) == ["a", "b", "uid2"]
    assert files.removed_columns(control, keep_with="uid") == ["a", "b"]


def test_dataset_pair_and_submission(spark, base, tmp_path):
    files.write_table(base.drop("dataset"), str(tmp_path / "train"))
    files.write_table(base.drop("dataset", "x"), str(tmp_path / "test"))
    assert files.read_dataset_pair(spark, str(tmp_path / "train"), str(tmp_path / "test")).count() == 6
    files.write_submission(base.withColumn("score", F.lit(0.25)), str(tmp_path / "sub"))
    assert files.read_csv(spark, str(tmp_path / "sub")).columns == ["TransactionID", "isFraud"]


def test_bucketed_tables_join_without_a_shuffle(spark, base):
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        files.write_bucketed(base, name, "TransactionID", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b").select("TransactionID"), "TransactionID", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE {name}")
