"""Queries on column profiles, value tables, histograms, densities and grids."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import groups, profile, sets, sketches
from featurekit.plans.registry import TX, query, rounded, table, transactions
from featurekit.session import scratch_path

PROFILED = ["card", "priority", "o_totalprice", "c_nationkey", "y"]
NUMBERS = ["card", "o_totalprice", "c_nationkey", "y"]


def _profile_sql(column: str) -> str:
    number = f"{column}::DOUBLE" if column in NUMBERS else "NULL::DOUBLE"
    kind = {"card": "bigint", "priority": "string", "o_totalprice": "double"}.get(column, "int")
    zeros = f"count(*) FILTER ({column} = 0)" if column in NUMBERS else "NULL::BIGINT"
    return f"""SELECT '{column}' AS "column", '{kind}' AS type, count(*) AS n, count(*) FILTER ({column} IS NULL) AS nulls, {zeros} AS zeros,
      min({number}) AS "min", round(avg({number}), 4) AS mean, max({number}) AS "max", round(stddev_samp({number}), 4) AS std,
      count(DISTINCT {column}) AS uniques, round(count(*) FILTER ({column} IS NULL) / count(*)::DOUBLE * 100, 6) AS nulls_pct,
      round(count(DISTINCT {column}) / count(*)::DOUBLE * 100, 6) AS uniques_pct, round({zeros} / count(*)::DOUBLE * 100, 6) AS zeros_pct FROM tx"""


@query(f"WITH {TX} " + " UNION ALL ".join(_profile_sql(c) for c in PROFILED))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = profile.column_profile(transactions(spark, sf_dir, customer=True), PROFILED)
    return result.withColumns({
        "mean": rounded("mean", 4), "std": rounded("std", 4), **{c: rounded(c) for c in ("nulls_pct", "uniques_pct", "zeros_pct")}
    })


def _top_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank, value, n,
      round(n / (SELECT count(*) FROM tx)::DOUBLE, 2) AS ratio
      FROM (SELECT {column}::VARCHAR AS value, count(*) AS n FROM tx WHERE {column} IS NOT NULL GROUP BY 1)
      QUALIFY row_number() OVER (ORDER BY n DESC, value) <= 10"""


@query(f"WITH {TX} " + " UNION ALL ".join(_top_sql(c) for c in ("card", "priority", "c_nationkey", "period")))
def top_value_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_value_report(transactions(spark, sf_dir, customer=True), ["card", "priority", "c_nationkey", "period"], 10)


@query(f"WITH {TX} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM tx" for c in ("card", "priority", "o_custkey")
))
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(transactions(spark, sf_dir), ["card", "priority", "o_custkey"])


@query(f"WITH {TX} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique FROM tx"
    for c in ("card", "priority", "o_totalprice")
))
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.distinct_counts(transactions(spark, sf_dir), ["card", "priority", "o_totalprice"], nulls=True)


@query(f"WITH {TX} SELECT DISTINCT period FROM tx WHERE dataset = 'test'")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.unique_values(sets.take_dataset(transactions(spark, sf_dir), "test"), "period")


@query(f"""WITH {TX} SELECT coalesce(priority, '__NA__') AS value, count(*) FILTER (dataset = 'train') AS n_train,
    count(*) FILTER (dataset <> 'train') AS n_test FROM tx GROUP BY 1""")
def category_freq_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_frequencies(transactions(spark, sf_dir), "priority", F.col("dataset") == "train")


@query(f"""WITH {TX}, c AS (SELECT coalesce(c_nationkey::VARCHAR, '__NA__') AS value, count(*) FILTER (dataset = 'train') AS n_train,
    count(*) FILTER (dataset <> 'train') AS n_test FROM tx GROUP BY 1 ORDER BY n_train DESC, value LIMIT 7)
  SELECT *, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS place FROM c""")
def category_freq_top_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven values most frequent in train, in alphabetic order; ``place`` is the row's position."""
    found = profile.category_frequencies(
        transactions(spark, sf_dir, customer=True), "c_nationkey", F.col("dataset") == "train", top=7, sort="alphabetic")
    places = [(r["value"], i) for i, r in enumerate(found.collect(), 1)]
    return found.join(spark.createDataFrame(places, "value string, place int"), "value")


@query(f"""WITH {TX}, c AS (SELECT priority, y, count(*) AS n FROM tx WHERE priority IS NOT NULL GROUP BY ALL)
  SELECT priority, y, n, round(n / sum(n) OVER (PARTITION BY priority)::DOUBLE, 9) AS share FROM c""")
def target_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.target_mix(transactions(spark, sf_dir), "priority", "y").withColumn("share", rounded("share", 9))


def _difference_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", {column}::VARCHAR AS value,
      CASE WHEN bool_or(dataset = 'train') THEN 'train' ELSE 'test' END AS only_in FROM tx GROUP BY {column}
      HAVING bool_or(dataset = 'train') <> bool_or(dataset = 'test')"""


@query(f"WITH {TX} " + " UNION ALL ".join(_difference_sql(c) for c in ("card", "priority", "period")))
def category_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.category_difference(transactions(spark, sf_dir), ["card", "priority", "period"], F.col("dataset") == "train")


@query("""WITH b AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 100 AS width FROM lineitem)
  SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) / width), 99) AS INTEGER) AS bin, count(*) AS n
  FROM lineitem CROSS JOIN b GROUP BY 1, 2""")
def histogram_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 100, ["l_returnflag"])


def _quantile_bins_sql(bins: int) -> str:
    inner = [f"quantile_cont(l_extendedprice, {i}/{bins}.0::DOUBLE)" for i in range(1, bins)]
    return f"""WITH e AS (SELECT [{', '.join(inner)}] AS edges FROM lineitem)
      SELECT CAST(len(list_filter(list_distinct(edges), lambda e: l_extendedprice > e)) AS INTEGER) AS bin, count(*) AS n,
        min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem CROSS JOIN e GROUP BY 1"""


@query(_quantile_bins_sql(10))
def quantile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = profile.quantile_bins(table(spark, sf_dir, "lineitem"), "l_extendedprice", 10)
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    )


def _density_sql(source: str, column: str, by: str, points: int) -> str:
    return f"""s AS (SELECT {by}, count(*)::DOUBLE AS n, stddev_samp({column}) * pow(count(*)::DOUBLE, -0.2) AS h,
        min({column}) AS lo, max({column}) AS hi FROM {source} GROUP BY {by}),
      g AS (SELECT min(lo - h * 3) AS lo, max(hi + h * 3) AS hi FROM s),
      grid AS (SELECT CAST(i AS INTEGER) AS point, lo + i * ((hi - lo) / {points - 1}) AS x FROM g, (SELECT unnest(generate_series(0, {points - 1})) AS i)),
      v AS (SELECT {by}, {column} AS v, count(*) AS w FROM {source} GROUP BY ALL)
      SELECT v.{by} AS {by}, point, round(any_value(x), 4) AS x,
        round(sum(w * exp(-0.5::DOUBLE * pow((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
      FROM v JOIN s ON s.{by} = v.{by} CROSS JOIN grid GROUP BY v.{by}, point"""


def _density(result: DataFrame) -> DataFrame:
    return result.withColumns({"x": rounded("x", 4), "density": rounded("density", 9)})


@query("WITH " + _density_sql("lineitem", "l_quantity", "l_returnflag", 40))
def kde_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _density(profile.density(table(spark, sf_dir, "lineitem"), "l_quantity", "l_returnflag", 40))


@query("WITH c AS (SELECT l_returnflag, l_partkey, count(*)::DOUBLE AS k FROM lineitem GROUP BY ALL), "
       + _density_sql("c", "k", "l_returnflag", 40))
def kde_of_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _density(profile.count_density(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", 40))


@query(f"""WITH {TX}, d AS (SELECT dataset, CAST(o_orderdate AS DATE) AS day, avg(cents) AS m, CAST(sum(cents) AS BIGINT) AS s, count(*) AS n FROM tx GROUP BY ALL),
  span AS (SELECT dataset, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM d GROUP BY dataset)
  SELECT span.dataset AS dataset, strftime(span.day, '%Y-%m-%d') AS day, m AS cents_mean, coalesce(s, 0) AS cents_sum,
    coalesce(n, 0) AS n FROM span LEFT JOIN d ON d.dataset = span.dataset AND d.day = CAST(span.day AS DATE)""")
def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.resample_days(transactions(spark, sf_dir), "o_orderdate", ["cents"], ["dataset"])


@query(f"""WITH e AS (SELECT [{', '.join(f"quantile_cont(p_retailprice, {i}/20.0::DOUBLE)" for i in range(21))}] AS edges FROM part)
  SELECT DISTINCT round(unnest(edges), 6) AS value, value_count FROM e CROSS JOIN (SELECT unnest(generate_series(1, 10)) AS value_count)""")
def grid_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of the price's quantile edges and ten counts."""
    edges = profile.quantile_edges(table(spark, sf_dir, "part"), "p_retailprice", 20)
    return sets.value_count_grid(spark, edges, range(1, 11)).withColumn("value", rounded("value"))


@query(f"""WITH {TX} SELECT card AS value, count(*) AS value_count, count(*) FILTER (dataset = 'train') AS n,
    round(avg(y) FILTER (dataset = 'train'), 9) AS label_rate FROM tx WHERE card IS NOT NULL GROUP BY card""")
def interaction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = sets.interaction_table(transactions(spark, sf_dir), "card", "y", F.col("dataset") == "train")
    return rates.withColumn("label_rate", rounded("label_rate", 9))


_SKETCHED = ["o_totalprice", "cents", "o_custkey"]


@query(f"""WITH {TX} {' UNION ALL '.join(f"""SELECT '{c}' AS "column", count({c}) AS n, TRUE AS ranks_near, TRUE AS uniques_near FROM tx WHERE period <= 60""" for c in _SKETCHED)}""")
def merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per month, stored and merged over the first sixty: their quantiles and distinct counts beside the exact ones."""
    rows, path = transactions(spark, sf_dir), scratch_path(spark, "sketches")
    names = _SKETCHED
    sketches.column_sketches(rows, names, names, ["period"]).write.parquet(path)
    range_ = F.col("period") <= 60
    found = sketches.distinct_counts(sketches.quantiles(sketches.merged(spark.read.parquet(path).where(range_)), sketches.SHARES))
    held = rows.where(range_).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in names])).alias("v")).select("v.*")
    # The share of rows up to each approximate quantile; one row per column is joined.
    ranks = held.join(F.broadcast(found), "column").groupBy("column", "n", "uniques").agg(
        *[F.avg((F.col("x") <= F.col("values")[i]).cast("double")).alias(f"r{i}") for i in range(len(sketches.SHARES))],
        F.count_distinct("x").alias("exact"))
    near = [F.abs(F.col(f"r{i}") - s) < 0.01 for i, s in enumerate(sketches.SHARES)]
    return ranks.select("column", "n", reduce(and_, near).alias("ranks_near"), (F.abs(F.col("uniques") / F.col("exact") - 1) < 0.05).alias("uniques_near"))
