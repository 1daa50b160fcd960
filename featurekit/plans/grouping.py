"""Queries on group statistics, cross-tabs, counts and calendar aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.functions import calendar
from featurekit.operators import groups, profile, sets
from featurekit.plans.registry import TX, query, rounded, table, transactions
from featurekit.session import scratch_path
from featurekit.sources import files


@query(f"""WITH {TX} SELECT c_nationkey, priority, min(cents) AS "t_cents_min_s", avg(cents) AS "t_cents_mean_s",
    max(cents) AS "t_cents_max_s", round(stddev_samp(cents), 2) AS "t_cents_std_s",
    min(balance) AS "t_balance_min_s", avg(balance) AS "t_balance_mean_s",
    max(balance) AS "t_balance_max_s", round(stddev_samp(balance), 2) AS "t_balance_std_s"
  FROM tx WHERE c_nationkey IS NOT NULL AND priority IS NOT NULL GROUP BY c_nationkey, priority""")
def auto_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = groups.group_stats(
        transactions(spark, sf_dir, customer=True), ["c_nationkey", "priority"], ["cents", "balance"],
        ["min", "mean", "max", "std"], prefix="t_", suffix="_s",
    )
    return stats.select(*[rounded(c, 2) if "_std" in c else F.col(c) for c in stats.columns])


@query(f"""WITH {TX}, s AS (SELECT priority, avg(cents) AS cents_mean, count(y) AS y_count FROM tx WHERE priority IS NOT NULL GROUP BY priority)
  SELECT o_orderkey, cents_mean, y_count, 'left' AS kind FROM tx LEFT JOIN s ON tx.priority = s.priority
  UNION ALL SELECT o_orderkey, cents_mean, y_count, 'inner' FROM tx JOIN s ON tx.priority = s.priority""")
def aggregate_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).select("o_orderkey", "priority", "cents", "y")
    means = groups.group_stats(tx, "priority", "cents", "mean")
    counts = groups.group_stats(tx, "priority", ["y"], ["count"])
    rows = tx.select("o_orderkey", "priority")
    both = [
        groups.join_back(groups.join_back(rows, means, "priority", how), counts, "priority", how, drop=True)
        .withColumn("kind", F.lit(how))
        for how in ("left", "inner")
    ]
    return sets.stack_all(both)


@query("""SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS "l_returnflagCnt_A", count(*) FILTER (l_returnflag = 'N') AS "l_returnflagCnt_N",
    count(*) FILTER (l_returnflag = 'R') AS "l_returnflagCnt_R", count(*) FILTER (l_linestatus = 'F') AS "l_linestatusCnt_F",
    count(*) FILTER (l_linestatus = 'O') AS "l_linestatusCnt_O",
    round(count(*) FILTER (l_returnflag = 'A') / count(l_returnflag)::DOUBLE, 6) AS "l_returnflagRatio_A",
    round(count(*) FILTER (l_returnflag = 'N') / count(l_returnflag)::DOUBLE, 6) AS "l_returnflagRatio_N",
    round(count(*) FILTER (l_returnflag = 'R') / count(l_returnflag)::DOUBLE, 6) AS "l_returnflagRatio_R",
    round(count(*) FILTER (l_linestatus = 'F') / count(l_linestatus)::DOUBLE, 6) AS "l_linestatusRatio_F",
    round(count(*) FILTER (l_linestatus = 'O') / count(l_linestatus)::DOUBLE, 6) AS "l_linestatusRatio_O"
  FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey""")
def cnt_ratio_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]}
    wide = groups.counts_and_ratios(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_returnflag", "l_linestatus"], values)
    return wide.select(*[rounded(c) if "Ratio_" in c else F.col(c) for c in wide.columns])


@query("""WITH c AS (SELECT l_suppkey, 'l_partkey' AS target, l_partkey::VARCHAR AS value, count(*) AS n FROM lineitem
      WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY ALL
    UNION ALL SELECT l_suppkey, 'l_returnflag', l_returnflag, count(*) FROM lineitem
      WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY ALL)
  SELECT l_suppkey, target, value, n, round(n / sum(n) OVER (PARTITION BY l_suppkey, target)::DOUBLE, 9) AS ratio FROM c""")
def cnt_ratio_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and ratios of thousands of values."""
    counts = groups.counts_and_ratios_long(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_partkey", "l_returnflag"])
    return counts.withColumn("ratio", rounded("ratio", 9))


@query("""WITH e AS (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS q, CASE WHEN l_linenumber = 5 THEN NULL
      ELSE l_discount END AS d, l_returnflag FROM lineitem)
  SELECT l_returnflag, min(q) AS q_min, max(q) AS q_max, round(avg(q), 9) AS q_mean, count(q) AS q_count,
    (SELECT round(corr(q, d), 6) FROM e) AS r, (SELECT count(*) FROM e WHERE q IS NULL) AS missing FROM e GROUP BY l_returnflag""")
def nan_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN cells, written to a table and read again, count as missing in every statistic."""
    nan = F.lit(float("nan"))
    dirty = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 3, nan).otherwise(F.col("l_quantity")).alias("q"),
        F.when(F.col("l_linenumber") == 5, nan).otherwise(F.col("l_discount")).alias("d"), "l_returnflag",
    )
    stats = groups.group_stats(dirty, "l_returnflag", "q", ["min", "max", "mean", "count"])
    path = scratch_path(spark, "dirty")
    files.write_table(dirty, path)
    stored = files.read_table(spark, path)
    r = groups.correlations(dirty, ["q", "d"]).first()["r"]
    missing = profile.null_counts(stored, ["q"]).first()["nulls"]
    return stats.select("l_returnflag", "q_min", "q_max", rounded("q_mean", 9), "q_count",
                        F.round(F.lit(r), 6).alias("r"), F.lit(missing).cast("bigint").alias("missing"))


@query(f"""WITH {TX} SELECT card, period, count(*) AS n FROM tx WHERE card IS NOT NULL AND period IS NOT NULL GROUP BY card, period""")
def crosstab_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.crosstab(transactions(spark, sf_dir), "card", "period")


@query(f"""WITH {TX}, c AS (SELECT card, period, count(*) AS n FROM tx WHERE card IS NOT NULL GROUP BY card, period)
  SELECT card, period, n, round(n / sum(n) OVER (PARTITION BY period)::DOUBLE, 9) AS share FROM c""")
def crosstab_col_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = groups.crosstab_share(transactions(spark, sf_dir), "card", "period", within="period")
    return shares.withColumn("share", rounded("share", 9))


@query(f"""WITH {TX}, c AS (SELECT c_nationkey, priority, count(*) AS n FROM tx WHERE c_nationkey IS NOT NULL AND priority IS NOT NULL
    GROUP BY c_nationkey, priority)
  SELECT c_nationkey, priority, n, round(n / sum(n) OVER (PARTITION BY c_nationkey)::DOUBLE, 9) AS share FROM c""")
def crosstab_row_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = groups.crosstab_share(transactions(spark, sf_dir, customer=True), "c_nationkey", "priority", within="c_nationkey")
    return shares.withColumn("share", rounded("share", 9))


@query("""SELECT p_brand, count(*) FILTER (p_type = 'ECONOMY') AS "type_ECONOMY", count(*) FILTER (p_type = 'SMALL') AS "type_SMALL",
    count(*) FILTER (p_type = 'MEDIUM') AS "type_MEDIUM" FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL GROUP BY p_brand""")
def crosstab_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.crosstab_wide(table(spark, sf_dir, "part"), "p_brand", "p_type", ["ECONOMY", "SMALL", "MEDIUM"], "type_")


@query("""WITH e AS (SELECT event_id, event_type, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS m,
    CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS d FROM events)
  SELECT event_id, count(*) OVER (PARTITION BY event_type, m) AS monthly_count,
    count(*) OVER (PARTITION BY event_type, d) AS daily_count FROM e""")
def date_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", calendar.month_code(F.col("ts")).alias("m"), calendar.day_code(F.col("ts")).alias("d")
    )
    events = groups.group_row_counts(events, ["event_type", "m"], "monthly_count")
    events = groups.group_row_counts(events, ["event_type", "d"], "daily_count")
    return events.select("event_id", "monthly_count", "daily_count")


@query("""SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey
  ORDER BY n DESC, l_partkey LIMIT 30""")
def value_counts_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.value_counts(table(spark, sf_dir, "lineitem"), "l_partkey", top=30)


@query(f"""WITH {TX} SELECT priority, count(*) AS n, round(count(*) / (SELECT count(*) FROM tx)::DOUBLE, 9) AS share FROM tx GROUP BY priority""")
def value_counts_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = groups.value_counts(transactions(spark, sf_dir), "priority", nulls=True, share=True)
    return counts.withColumn("share", rounded("share", 9))


@query(f"""WITH {TX} SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST((dayofweek(o_orderdate) + 6) % 7 AS INTEGER) AS dow, round(avg(y), 9) AS y_mean, CAST(sum(y) AS BIGINT) AS y_sum, count(y) AS y_count,
    round(sum(o_totalprice), 2) AS o_totalprice_sum FROM tx GROUP BY ALL""")
def calendar_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, parts = transactions(spark, sf_dir), calendar.parts(F.col("o_orderdate"))
    keys = ["year", "month", "dow"]
    tx = tx.select("y", "o_totalprice", *[parts[k].alias(k) for k in keys])
    stats = groups.group_stats(tx, keys, ["y", "o_totalprice"], ["mean", "sum", "count"])
    return stats.drop("o_totalprice_mean", "o_totalprice_count").withColumns({
        "y_mean": rounded("y_mean", 9), "o_totalprice_sum": rounded("o_totalprice_sum", 2)
    })


@query("""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS m, sum(value) AS s, count(*) AS n FROM events GROUP BY ALL),
  span AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM e GROUP BY user_id)
  SELECT span.user_id AS user_id, strftime(span.day, '%Y-%m-%d') AS day, round(m, 8) AS value_mean, round(coalesce(s, 0), 4) AS value_sum,
    coalesce(n, 0) AS n FROM span LEFT JOIN e ON e.user_id = span.user_id AND e.day = CAST(span.day AS DATE)""")
def resample_daily_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = groups.resample_days(table(spark, sf_dir, "events"), "ts", ["value"], ["user_id"])
    return daily.withColumns({"value_mean": rounded("value_mean", 8), "value_sum": rounded("value_sum", 4)})


@query(f"""WITH {TX} SELECT strftime(o_orderdate, '%Y-%m') AS month, avg(cents) AS cents_mean FROM tx GROUP BY 1""")
def resample_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.resample_months(transactions(spark, sf_dir), "o_orderdate", ["cents"])


@query("""WITH e AS (SELECT NULLIF(l_tax, 0.05) AS tax, l_discount, l_quantity, l_extendedprice FROM lineitem)
  SELECT 'tax' AS a, 'l_discount' AS b, round(corr(tax, l_discount), 6) AS r FROM e
  UNION ALL SELECT 'tax', 'l_quantity', round(corr(tax, l_quantity), 6) FROM e
  UNION ALL SELECT 'tax', 'l_extendedprice', round(corr(tax, l_extendedprice), 6) FROM e
  UNION ALL SELECT 'l_discount', 'l_quantity', round(corr(l_discount, l_quantity), 6) FROM e
  UNION ALL SELECT 'l_discount', 'l_extendedprice', round(corr(l_discount, l_extendedprice), 6) FROM e
  UNION ALL SELECT 'l_quantity', 'l_extendedprice', round(corr(l_quantity, l_extendedprice), 6) FROM e""")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("tax", F.nullif(F.col("l_tax"), F.lit(0.05).cast("double")))
    pairs = groups.correlations(items, ["tax", "l_discount", "l_quantity", "l_extendedprice"])
    return pairs.withColumn("r", rounded("r"))


@query(f"""WITH {TX}, d AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(y) AS y_mean, sum(y) AS y_sum, avg(o_totalprice) AS p_mean,
    sum(o_totalprice) AS p_sum FROM tx GROUP BY 1)
  SELECT 'y_mean' AS a, 'o_totalprice_mean' AS b, round(corr(y_mean, p_mean), 6) AS r FROM d
  UNION ALL SELECT 'y_sum', 'o_totalprice_mean', round(corr(y_sum, p_mean), 6) FROM d
  UNION ALL SELECT 'o_totalprice_sum', 'o_totalprice_mean', round(corr(p_sum, p_mean), 6) FROM d""")
def corr_of_daily_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = groups.resample_days(transactions(spark, sf_dir), "o_orderdate", ["y", "o_totalprice"]).where(F.col("n") > 0)
    pairs = groups.correlations(daily, ["y_mean", "y_sum", "o_totalprice_sum"], against="o_totalprice_mean")
    return pairs.withColumn("r", rounded("r"))


@query(f"""WITH {TX}, s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_custkey,
    CAST(sum(y) AS BIGINT) AS label_sum FROM tx GROUP BY ALL),
  top AS (SELECT o_custkey FROM s ORDER BY label_sum DESC, year, month, o_custkey LIMIT 5)
  SELECT o_custkey, year, month, label_sum FROM s WHERE o_custkey IN (SELECT o_custkey FROM top)""")
def key_month_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = calendar.parts(F.col("o_orderdate"))
    tx = transactions(spark, sf_dir).select("o_custkey", "y", *[parts[k].alias(k) for k in ("year", "month")])
    return groups.key_history(tx, "o_custkey", ["year", "month"], "y", top=5)


@query(f"""WITH {TX},
  a AS (SELECT priority, avg(y) AS m, count(y) AS n, count(y) / (SELECT count(*) FROM tx WHERE dataset = 'train')::DOUBLE AS f FROM tx
    WHERE dataset = 'train' AND priority IS NOT NULL GROUP BY priority),
  b AS (SELECT priority, count(*) / (SELECT count(*) FROM tx WHERE dataset = 'test' AND priority IS NOT NULL)::DOUBLE AS f FROM tx
    WHERE dataset = 'test' AND priority IS NOT NULL GROUP BY priority)
  SELECT coalesce(a.priority, b.priority) AS priority, round(m, 9) AS target_mean, n AS n_train, round(a.f, 9) AS freq_train,
    round(b.f, 9) AS freq_test FROM a FULL JOIN b ON a.priority = b.priority""")
def category_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    result = groups.category_target_table(sets.take_dataset(tx, "train"), sets.take_dataset(tx, "test"), "priority", "y")
    return result.withColumns({c: rounded(c, 9) for c in ("target_mean", "freq_train", "freq_test")})


@query(f"""WITH {TX},
  a AS (SELECT coalesce(priority, '__NA__') AS p, avg(y) AS m, count(y) AS n FROM tx WHERE dataset = 'train' GROUP BY 1),
  b AS (SELECT coalesce(priority, '__NA__') AS p, count(*) AS n FROM tx WHERE dataset = 'test' GROUP BY 1)
  SELECT coalesce(a.p, b.p) AS priority, round(m, 9) AS target_mean, a.n AS n_train, round(a.n / (SELECT sum(n) FROM a)::DOUBLE, 9) AS freq_train,
    round(b.n / (SELECT sum(n) FROM b)::DOUBLE, 9) AS freq_test,
    CAST(row_number() OVER (ORDER BY a.n DESC NULLS LAST, coalesce(a.p, b.p)) AS INTEGER) AS place
  FROM a FULL JOIN b ON a.p = b.p""")
def category_vs_target_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The null category shown, most frequent first; ``place`` is the row's position in the sorted table."""
    tx = transactions(spark, sf_dir)
    result = groups.category_target_table(
        sets.take_dataset(tx, "train"), sets.take_dataset(tx, "test"), "priority", "y", sort="freq", missing="__NA__")
    # A handful of categories: their order is read off the sorted rows.
    places = [(r["priority"], i) for i, r in enumerate(result.collect(), 1)]
    numbered = result.join(spark.createDataFrame(places, "priority string, place int"), "priority")
    return numbered.withColumns({c: rounded(c, 9) for c in ("target_mean", "freq_train", "freq_test")})


@query(f"""WITH {TX} SELECT max(o_totalprice) AS max_price, min(o_totalprice) AS min_price, avg(cents) AS mean_cents,
    round(stddev_samp(o_totalprice), 4) AS std_price, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM tx""")
def scalar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return transactions(spark, sf_dir).agg(
        F.max(price).alias("max_price"), F.min(price).alias("min_price"), F.avg("cents").alias("mean_cents"),
        rounded(F.stddev_samp(price), 4).alias("std_price"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_day"),
    )
