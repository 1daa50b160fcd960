"""The list of queries, each with the SQL statement that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators.lookup import lookup_join, with_row_id

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; without ``sql`` only its rows are checked."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = " ".join(sql.split())
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(column: str | Column, digits: int = 6) -> Column:
    """Sums of doubles depend on the order of addition; the compared results are rounded on both sides."""
    name = column if isinstance(column, str) else None
    result = F.round(F.col(column) if name else column, digits)
    return result.alias(name) if name else result


def transactions(spark: SparkSession, sf_dir: str, customer: bool = False) -> DataFrame:
    """Orders with a dataset name, a label, a month number, two columns that hold nulls and, on demand, customer attributes.

    ``cents`` and ``balance`` are whole numbers, so their sums and means are exact in any order of addition.
    """
    orders, moment = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    orders = with_row_id(orders, "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus",
        F.when(moment < F.lit("2000-01-01").cast("timestamp_ntz"), "train").otherwise("test").alias("dataset"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        ((F.year(moment) - 1995) * 12 + F.month(moment)).alias("period"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_custkey")).alias("card"),
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    if not customer:
        return orders
    attributes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment",
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("balance"),
    )
    return lookup_join(orders, attributes, "o_custkey")


# The same table in SQL, as the first common table expression of a statement.
TX = """tx AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus,
    c_nationkey, c_acctbal, c_mktsegment,
    CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS dataset,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
    CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS period,
    CASE WHEN o_totalprice >= 50000 THEN o_custkey END AS card,
    NULLIF(o_orderpriority, '3-MEDIUM') AS priority,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(round(c_acctbal * 100) AS BIGINT) AS balance
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""
