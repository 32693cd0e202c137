"""Dirty views derived from the driver tables (FIXTURES 3).

The driver tables hold no nulls and no malformed text, so the cleaning, gate and
fact-load operators get their inputs from these views. Every view is a row-wise
projection of a whole table (no rows dropped except where the view is defined
as a subset), so its work grows with the table. Each has a DuckDB twin as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.sources.tables import load_table


def _fmt(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def membership_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership term log built from ``orders`` (key = o_orderkey)."""
    o = load_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    f = _fmt(F.col("o_orderdate"))
    eff = (F.when(k % 7 == 0, F.lit(None).cast("string"))
           .when(k % 17 == 0, F.lit("n/a"))
           .when(k % 19 == 0, F.lit("2024-13-45 00:00:00"))
           .when(k % 23 == 0, F.concat(F.lit(" "), f))
           .otherwise(f))
    return o.select(
        k.alias("id"),
        F.col("o_custkey").alias("customerid"),
        eff.alias("effectivedate"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(f).alias("joindate"),
        _fmt(F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias("expiredate"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .otherwise(_fmt(F.col("o_orderdate") + F.expr("INTERVAL 395 DAYS"))).alias("terminatedate"),
        (k % 2500).alias("membershipproductid"),
        F.when(k % 13 == 0, F.lit(None).cast("boolean")).otherwise(k % 11 == 0).alias("isdeleted"),
        F.when(k % 13 == 0, F.lit("I")).when(k % 13 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("A")).alias("meta_record_status"),
    )


def membership_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    chapter = F.when(k % 4 == 0, F.lit(None).cast("boolean")).otherwise(k % 3 == 0)
    return load_table(spark, sf_dir, "part").select(k.alias("id"), chapter.alias("ischapter"))


def numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_linenumber") % 5 == 0, F.lit("x"))
                     .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("amount_txt"))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    m = F.col("l_partkey") % 6
    flag = (F.when(m == 0, F.lit("Y")).when(m == 1, F.lit("true")).when(m == 2, F.lit("1"))
            .when(m == 3, F.lit("yes")).when(m == 4, F.lit("N")).otherwise(F.lit(None).cast("string")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", flag.alias("flag_txt"))


def bent_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; the keys of one segment are bent, so that their orders are orphans."""
    k = F.col("c_custkey")
    return load_table(spark, sf_dir, "customer").withColumn(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", -k - 1).otherwise(k))


def repeated_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load_table(spark, sf_dir, "customer")
    return c.unionByName(c.where(F.col("c_custkey") % 10 == 0))


def orders_with_null_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders").withColumn("o_comment", F.lit(None).cast("string"))


def empty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders").where(F.lit(False))


# DuckDB twins, used inside WITH clauses of the oracle SQL.
FMT = "strftime({c}, '%Y-%m-%d %H:%M:%S')"

MEMBERSHIP_LOG_SQL = """membership_log AS (
  SELECT o_orderkey AS id, o_custkey AS customerid,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         WHEN o_orderkey % 17 = 0 THEN 'n/a'
         WHEN o_orderkey % 19 = 0 THEN '2024-13-45 00:00:00'
         WHEN o_orderkey % 23 = 0 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS effectivedate,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS joindate,
    strftime(o_orderdate + INTERVAL 365 DAY, '%Y-%m-%d %H:%M:%S') AS expiredate,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL
         ELSE strftime(o_orderdate + INTERVAL 395 DAY, '%Y-%m-%d %H:%M:%S') END AS terminatedate,
    o_orderkey % 2500 AS membershipproductid,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 11 = 0 END AS isdeleted,
    CASE WHEN o_orderkey % 13 = 0 THEN 'I' WHEN o_orderkey % 13 = 1 THEN NULL ELSE 'A' END
      AS meta_record_status
  FROM orders)"""

MEMBERSHIP_PRODUCT_SQL = """membership_product AS (SELECT p_partkey AS id,
    CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 3 = 0 END AS ischapter FROM part)"""

NUMERIC_TEXT_SQL = """numeric_text AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber % 5 = 0 THEN 'x' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS amount_txt
  FROM lineitem)"""

FLAGS_SQL = """flags AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE l_partkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'yes'
                       WHEN 4 THEN 'N' ELSE NULL END AS flag_txt
  FROM lineitem)"""

BENT_CUSTOMER_SQL = """bent_customer AS (SELECT * REPLACE (
  CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey - 1 ELSE c_custkey END AS c_custkey) FROM customer)"""

REPEATED_CUSTOMER_SQL = """repeated_customer AS (
  SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 10 = 0)"""

ORDERS_NULL_COL_SQL = "orders_nc AS (SELECT *, CAST(NULL AS VARCHAR) AS o_comment FROM orders)"

EMPTY_ORDERS_SQL = "empty_orders AS (SELECT * FROM orders WHERE 1 = 0)"
