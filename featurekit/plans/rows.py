"""Queries on single rows: projections, filters, scalar functions, keyed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.functions import calendar, numeric, text, values
from featurekit.operators import columns, encoders, groups, sets
from featurekit.operators.lookup import left_join, membership
from featurekit.plans.registry import TX, query, rounded, table, transactions

# Name rules of the part table, tried in order.
PART_RULES = [("small", "Compact"), ("ring", "Jewel"), ("red", "Warm"), ("hot", "Warm"), ("bolt", "Fastener")]
PART_CODES = {"ECONOMY": 1, "SMALL": 2, "MEDIUM": 3}


@query(f"""WITH {TX},
  by_card AS (SELECT dataset, card, avg(o_totalprice) AS m FROM tx WHERE card IS NOT NULL GROUP BY ALL),
  by_priority AS (SELECT dataset, priority, avg(o_totalprice) AS m FROM tx WHERE priority IS NOT NULL GROUP BY ALL)
  SELECT o_orderkey, tx.dataset AS dataset, round(o_totalprice / NULLIF(a.m, 0), 6) AS o_totalprice_to_mean_card,
    round(o_totalprice / NULLIF(b.m, 0), 6) AS o_totalprice_to_mean_priority
  FROM tx LEFT JOIN by_card a ON a.dataset = tx.dataset AND a.card = tx.card
  LEFT JOIN by_priority b ON b.dataset = tx.dataset AND b.priority = tx.priority""")
def amount_to_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = groups.group_ratios(
        transactions(spark, sf_dir), ["o_totalprice"], ["card", "priority"], ["dataset"], ["mean"]
    )
    return ratios.select(
        "o_orderkey", "dataset", rounded("o_totalprice_to_mean_card"), rounded("o_totalprice_to_mean_priority")
    )


@query(f"""WITH {TX},
  by_card AS (SELECT dataset, card, stddev_samp(o_totalprice) AS s FROM tx WHERE card IS NOT NULL GROUP BY ALL),
  by_segment AS (SELECT dataset, c_mktsegment, stddev_samp(o_totalprice) AS s, stddev_samp(c_acctbal) AS t FROM tx
    WHERE c_mktsegment IS NOT NULL GROUP BY ALL)
  SELECT o_orderkey, round(o_totalprice / NULLIF(a.s, 0), 4) AS o_totalprice_to_std_card,
    round(o_totalprice / NULLIF(b.s, 0), 4) AS o_totalprice_to_std_c_mktsegment,
    round(c_acctbal / NULLIF(b.t, 0), 4) AS c_acctbal_to_std_c_mktsegment
  FROM tx LEFT JOIN by_card a ON a.dataset = tx.dataset AND a.card = tx.card
  LEFT JOIN by_segment b ON b.dataset = tx.dataset AND b.c_mktsegment = tx.c_mktsegment""")
def amount_to_group_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = groups.group_ratios(transactions(spark, sf_dir, customer=True), ["o_totalprice"], ["card"], ["dataset"], ["std"])
    tx = groups.group_ratios(tx, ["o_totalprice", "c_acctbal"], ["c_mktsegment"], ["dataset"], ["std"])
    return tx.select("o_orderkey", *[rounded(c, 4) for c in tx.columns if "_to_std_" in c])


@query("""SELECT d.doc_id AS doc_id, text, lang, source, n_chars, quality, toxic,
    CASE WHEN l.doc_id IS NOT NULL THEN 1 END AS had_label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def identity_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("had_label", F.lit(1))
    return left_join(table(spark, sf_dir, "documents"), labels, "doc_id")


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST((dayofweek(o_orderdate) + 6) % 7 AS INTEGER) AS dow, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
    CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(day(o_orderdate) AS INTEGER) AS day,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS date_block,
    CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS day_block,
    CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS period
  FROM orders""")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in calendar.parts(moment).items()],
        calendar.month_code(moment).alias("date_block"), calendar.day_code(moment).alias("day_block"),
        calendar.month_number(moment, 1995).alias("period"),
    )


@query("""WITH e AS (SELECT event_id, datediff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS s FROM events)
  SELECT event_id, s AS seconds,
    CAST(floor(((s / 86400.0::DOUBLE - 1) % 7 + 7) % 7) AS BIGINT) AS weekday,
    CAST(floor(s / 3600.0::DOUBLE) AS BIGINT) % 24 AS hour,
    strftime(TIMESTAMP '2017-12-01' + to_seconds(s), '%Y-%m-%d %H:%M:%S') AS moment
  FROM e""")
def offset_dow_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", calendar.seconds_since(F.col("ts"), "2024-01-01").alias("seconds")
    )
    seconds = F.col("seconds")
    return events.select(
        "event_id", "seconds", calendar.offset_weekday(seconds).alias("weekday"), calendar.offset_hour(seconds).alias("hour"),
        F.date_format(calendar.offset_timestamp(seconds), "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query("""SELECT o_orderkey, CAST(trunc((o_totalprice - trunc(o_totalprice)) * 1000) AS BIGINT) AS decimals,
    round(ln(o_totalprice), 9) AS log_price FROM orders""")
def amount_decimals_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", numeric.amount_decimals("o_totalprice").alias("decimals"),
        rounded(numeric.natural_log("o_totalprice"), 9).alias("log_price"),
    )


@query("""WITH p AS (SELECT page_id, url, string_split(url, '/') AS s FROM pages)
  SELECT page_id, s[3] AS host, s[4] AS lang, s[5] AS item, s[8] AS missing_part, s[-1] AS last_part,
    string_split(s[3], '.')[1] AS subdomain,
    COALESCE(TRY_CAST(string_split(replace(s[5], '.', 'x'), 'x')[1] AS INTEGER), 0) AS width,
    COALESCE(TRY_CAST(string_split(replace(s[5], '.', 'x'), 'x')[2] AS INTEGER), 0) AS height,
    NULLIF(TRY_CAST(string_split(url, '=')[2] AS INTEGER), 0) AS number
  FROM p""")
def string_split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    item = text.part(url, "/", 4)
    width, height = text.screen_size(F.replace(item, F.lit("."), F.lit("x")))
    return table(spark, sf_dir, "pages").select(
        "page_id", text.part(url, "/", 2).alias("host"), text.part(url, "/", 3).alias("lang"), item.alias("item"),
        text.part(url, "/", 7).alias("missing_part"), text.part(url, "/", -1).alias("last_part"),
        text.part(text.part(url, "/", 2), ".", 0).alias("subdomain"), width.alias("width"), height.alias("height"),
        text.trailing_number(url, "=").alias("number"),
    )


@query("""SELECT p_partkey, CASE WHEN p_name LIKE '%small%' THEN 'Compact' WHEN p_name LIKE '%ring%' THEN 'Jewel'
    WHEN p_name LIKE '%red%' THEN 'Warm' WHEN p_name LIKE '%hot%' THEN 'Warm' WHEN p_name LIKE '%bolt%' THEN 'Fastener'
    ELSE p_name END AS class FROM part""")
def brand_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.classify(F.col("p_name"), PART_RULES).alias("class"))


@query("""WITH h AS (SELECT page_id, NULLIF(string_split(url, '/')[4], 'fr') AS lang, string_split(url, '/')[3] AS host FROM pages)
  SELECT page_id, CASE WHEN string_split(host, '.')[-1] IN ('gmail', 'net', 'edu') THEN 'us'
      ELSE string_split(host, '.')[-1] END AS host_suffix,
    COALESCE(lang, 'nan') AS lang_suffix FROM h""")
def suffix_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.nullif(text.part(F.col("url"), "/", 3), F.lit("fr"))
    return table(spark, sf_dir, "pages").select(
        "page_id", text.suffix_group(text.part(F.col("url"), "/", 2)).alias("host_suffix"),
        text.suffix_group(lang).alias("lang_suffix"),
    )


@query("""SELECT p_partkey, CASE WHEN NULLIF(p_brand, 'Brand#2') IN ('Brand#2', 'Brand#7', 'Brand#25') THEN 1 ELSE 0 END AS known_brand
  FROM part""")
def known_value_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#2"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", values.known_value_flag(brand, ["Brand#2", "Brand#7", "Brand#25"]).alias("known_brand")
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    round(((CASE WHEN NULLIF(l_returnflag, 'N') IS NULL THEN 1 ELSE 0 END) + (CASE WHEN NULLIF(l_tax, 0.05) IS NULL THEN 1 ELSE 0 END))
      / 4.0::DOUBLE, 6) AS null_share,
    round(((CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) + (CASE WHEN l_tax = 0 THEN 1 ELSE 0 END))::DOUBLE
      / (2 + (CASE WHEN NULLIF(l_returnflag, 'N') IS NULL THEN 0 ELSE 1 END) + (CASE WHEN NULLIF(l_tax, 0.05) IS NULL THEN 0 ELSE 1 END)), 6)
      AS zero_share FROM lineitem""")
def row_null_zero_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumns({
        "flag": F.nullif(F.col("l_returnflag"), F.lit("N")),
        "tax": F.nullif(F.col("l_tax"), F.lit(0.05).cast("double")),
    })
    cells = ["l_quantity", "l_discount", "flag", "tax"]
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        rounded(numeric.null_share(cells)).alias("null_share"),
        rounded(numeric.zero_share(cells, ["l_quantity", "l_discount", "tax"])).alias("zero_share"),
    )


@query("""WITH c AS (
    SELECT 'l_orderkey' AS "column", 'bigint' AS old_type, 8 AS old_bytes, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem
    UNION ALL SELECT 'l_partkey', 'bigint', 8, min(l_partkey), max(l_partkey) FROM lineitem
    UNION ALL SELECT 'l_suppkey', 'bigint', 8, min(l_suppkey), max(l_suppkey) FROM lineitem
    UNION ALL SELECT 'l_linenumber', 'int', 4, min(l_linenumber), max(l_linenumber) FROM lineitem),
  n AS (SELECT "column", old_type, CASE WHEN lo > -128 AND hi < 127 THEN 'tinyint' WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
      WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS new_type, old_bytes FROM c
    UNION ALL SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']), 'double', 'float', 8)
  SELECT "column", old_type, new_type, CAST(old_bytes AS INTEGER) AS old_bytes,
    CASE new_type WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 WHEN 'float' THEN 4 ELSE 8 END AS new_bytes FROM n""")
def narrow_types_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.narrowing_report(table(spark, sf_dir, "lineitem"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS TINYINT) AS l_linenumber,
    CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount,
    CAST(l_tax AS FLOAT) AS l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped FROM lineitem""")
def narrow_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrowed floats and bytes as they are; the three keys are widened again, for their width depends on the table."""
    narrow = columns.narrow_types(table(spark, sf_dir, "lineitem"))
    return narrow.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")],
        "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
    )


@query(f"""WITH {TX} SELECT o_orderkey, dataset,
    CASE WHEN o_totalprice < 10000 THEN 0.0::DOUBLE ELSE o_totalprice END AS "f900__price__raw",
    COALESCE(priority, '__NA__') AS "f900__priority__raw", COALESCE(card, -999) AS "f900__card__raw", 0 AS "f900__constant__raw",
    CAST(o_custkey AS VARCHAR) AS "f900__card_text__raw"
  FROM tx WHERE period < 79""")
def column_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = columns.keep(
        transactions(spark, sf_dir, customer=True).where(F.col("period") < 79),
        ["o_orderkey", "dataset", "o_custkey", "o_totalprice", "priority", "card", "c_acctbal"],
    )
    raw = [c for c in tx.columns if c not in ("o_orderkey", "dataset")]
    tx = columns.overwrite_where(tx, "o_totalprice", F.col("o_totalprice") < 10000, F.lit(0.0).cast("double"))
    tx = columns.fill(tx, {"priority": "__NA__", "card": -999})
    tx = tx.select(
        "*", F.col("o_totalprice").alias("price"), F.lit(0).alias("constant"), F.col("o_custkey").cast("string").alias("card_text"),
        F.col("c_acctbal").alias("f202_balance"),
    )
    tx = columns.drop_matching(tx, "f202").withColumnsRenamed({"priority": "kept_priority", "card": "kept_card"})
    new = columns.only_new(tx, raw, ["o_orderkey", "dataset"]).withColumnsRenamed({"kept_priority": "priority", "kept_card": "card"})
    return columns.rename(new, prefix="f900__", suffix="__raw", key=["o_orderkey", "dataset"])


@query("""SELECT p_partkey, CAST(p_size AS VARCHAR) || p_brand || p_type AS full_key,
    NULLIF(regexp_extract(p_brand, '#([0-9]+)', 1), '') AS brand_number,
    CASE WHEN p_name LIKE '%widget%' THEN 1 ELSE 0 END AS is_widget,
    COALESCE(NULLIF(p_type, 'SMALL'), '__NA__') AS type_category, CAST(p_size AS VARCHAR) AS size_category
  FROM part""")
def text_and_category_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    part = part.select(
        "p_partkey", text.joined_text(part.schema, ["p_size", "p_brand", "p_type"], "").alias("full_key"),
        F.nullif(F.regexp_extract("p_brand", "#([0-9]+)", 1), F.lit("")).alias("brand_number"),
        F.col("p_name").contains("widget").cast("int").alias("is_widget"),
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("type_category"), F.col("p_size").alias("size_category"),
    )
    return columns.as_categories(part, ["type_category", "size_category"])


@query("""SELECT p_partkey, CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 3 END AS INTEGER) AS type_code
  FROM part""")
def const_map_enc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", values.constant_map(F.col("p_type"), PART_CODES).alias("type_code"))


@query("""WITH h AS (SELECT page_id, array_to_string(string_split(string_split(url, '/')[3], '.')[-2:], '.') AS domain FROM pages)
  SELECT page_id, domain, CASE domain WHEN 'example.com' THEN 'commercial' WHEN 'example.org' THEN 'nonprofit' END AS domain_bin FROM h""")
def domain_group_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = text.part(F.col("url"), "/", 2)
    pages = table(spark, sf_dir, "pages").select("page_id", F.substring_index(host, ".", -2).alias("domain"))
    return encoders.group_map(pages, "domain", {"example.com": "commercial", "example.org": "nonprofit"}, "domain_bin")


@query(f"""WITH {TX} SELECT o_orderkey, 'train' AS dataset, o_totalprice FROM tx WHERE dataset = 'train'
  UNION ALL SELECT o_orderkey, 'test', NULL FROM tx WHERE dataset = 'test'""")
def union_and_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).select("o_orderkey", "o_totalprice", "dataset")
    train = sets.take_dataset(tx, "train")
    test = sets.take_dataset(tx, "test").drop("o_totalprice")
    return sets.stack_datasets(train, test)


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(f"""WITH {TX}, seen AS (SELECT DISTINCT o_custkey FROM tx WHERE dataset = 'train')
  SELECT o_orderkey, o_custkey, 'known' AS kind FROM tx WHERE dataset = 'test' AND o_custkey IN (SELECT o_custkey FROM seen)
  UNION ALL SELECT o_orderkey, o_custkey, 'new' FROM tx WHERE dataset = 'test' AND o_custkey NOT IN (SELECT o_custkey FROM seen)""")
def membership_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).select("o_orderkey", "o_custkey", "dataset")
    train, test = sets.take_dataset(tx, "train"), sets.take_dataset(tx, "test")
    known = membership(test, train, "o_custkey").withColumn("kind", F.lit("known"))
    new = membership(test, train, "o_custkey", negate=True).withColumn("kind", F.lit("new"))
    return sets.stack_all([known, new]).select("o_orderkey", "o_custkey", "kind")
