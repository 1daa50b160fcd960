"""Reading and writing tables as Parquet and CSV."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions.numeric import nan_to_null


def _fields(names: Sequence[str], data_type: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, data_type) for n in names]


def _numbered(stem: str, last: int, pad: int = 0) -> list[str]:
    return [f"{stem}{i:0{pad}d}" for i in range(1, last + 1)]


def transaction_schema(labelled: bool = True) -> T.StructType:
    """Columns of a transaction file in file order."""
    label = _fields(["isFraud"], T.IntegerType()) if labelled else []
    return T.StructType([
        *_fields(["TransactionID"], T.LongType()), *label, *_fields(["TransactionDT"], T.LongType()),
        *_fields(["TransactionAmt"], T.DoubleType()), *_fields(["ProductCD"], T.StringType()),
        *_fields(["card1"], T.IntegerType()), *_fields(["card2", "card3"], T.DoubleType()),
        *_fields(["card4"], T.StringType()), *_fields(["card5"], T.DoubleType()), *_fields(["card6"], T.StringType()),
        *_fields(["addr1", "addr2", "dist1", "dist2"], T.DoubleType()),
        *_fields(["P_emaildomain", "R_emaildomain"], T.StringType()),
        *_fields(_numbered("C", 14) + _numbered("D", 15), T.DoubleType()),
        *_fields(_numbered("M", 9), T.StringType()), *_fields(_numbered("V", 339), T.DoubleType()),
    ])


# Identity columns that hold text; all other identity columns hold numbers.
IDENTITY_TEXT = [12, 15, 16, 23, 27, 28, 29, 30, 31, 33, 34, 35, 36, 37, 38]


def identity_schema() -> T.StructType:
    """Columns of an identity file in file order."""
    columns = [
        T.StructField(f"id_{i:02d}", T.StringType() if i in IDENTITY_TEXT else T.DoubleType()) for i in range(1, 39)
    ]
    return T.StructType([
        *_fields(["TransactionID"], T.LongType()), *columns, *_fields(["DeviceType", "DeviceInfo"], T.StringType())
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV file with a header, or a zip archive of such files; types are inferred only when no schema is given."""
    if path.endswith(".zip"):
        if schema is None:
            raise ValueError("a zip archive needs a schema")
        return read_zipped_csv(spark, path, schema)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return clean_numbers(reader.csv(path))


# Lines that leave an archive in one batch.
_ZIP_LINES = 10_000


def read_zipped_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All CSV members of one or many zip archives (a path or pattern), each with a header that is left out.

    Spark has no codec for archives, so a task takes a whole archive, unpacks it line by line and hands the lines on to be
    parsed like those of a plain file. An archive has to be below 2 GB; a damaged member is an error.
    """
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    for member in sorted(n for n in archive.namelist() if n.endswith(".csv")):
                        with archive.open(member) as file:
                            text = io.TextIOWrapper(file, "utf-8", newline=None)
                            next(text, None)
                            while held := [x.rstrip("\n") for x in islice(text, _ZIP_LINES)]:
                                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    archives = spark.read.format("binaryFile").load(path).select("content")
    parsed = archives.mapInArrow(lines, "value string").where("value <> ''").select(F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " ")).alias("row"))
    return clean_numbers(parsed.select("row.*"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; NaN becomes null, as in CSV files."""
    return clean_numbers(spark.read.parquet(path))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a table hashed and sorted by its key; tables with equal buckets join on the key without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def clean_numbers(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating-point column, so that null is the only missing value."""
    return df.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def read_dataset_pair(spark: SparkSession, train_path: str, test_path: str) -> DataFrame:
    """Two Parquet tables stacked under a ``dataset`` column."""
    from featurekit.operators.sets import stack_datasets

    return stack_datasets(read_table(spark, train_path), read_table(spark, test_path))


def write_split(roles: DataFrame, path: str) -> None:
    """Store which role (or fold) every key has."""
    write_table(roles, path)


def read_split(spark: SparkSession, path: str, df: DataFrame, key: str) -> DataFrame:
    """Attach a stored split to the rows it names."""
    return df.join(read_table(spark, path), key)


def removed_columns(control: DataFrame, column: str = "features_to_remove", keep_with: str | None = None) -> list[str]:
    """Names listed in a one-column control table, minus those that contain ``keep_with``."""
    names = [r[0] for r in control.select(column).distinct().orderBy(column).collect()]
    return [n for n in names if keep_with is None or keep_with not in n]


def write_submission(scores: DataFrame, path: str, key: str = "TransactionID", score: str = "score") -> None:
    """CSV with ``TransactionID,isFraud``."""
    write_csv(scores.select(F.col(key).alias("TransactionID"), F.col(score).alias("isFraud")), path)


def write_predictions(scores: DataFrame, path: str) -> None:
    """Out-of-fold predictions: key, label, score and fold."""
    write_table(scores, path)
