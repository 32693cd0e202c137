"""Registered metric and time-intelligence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.operators import metrics as A
from stellate.operators.levels import distinct_over_levels
from stellate.plans.registry import register
from stellate.plans.schemas import SCHEMAS
from stellate.plans.sqlgen import _fam, _role
from stellate.sources.tables import load_table


def _t(spark, sf, name):
    return load_table(spark, sf, name)


@register("baseline_metrics_orders", """SELECT 'fact_orders' AS fact_name, metric, ROUND(value, 4) AS value FROM (
  SELECT 'row_count' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM orders UNION ALL
  SELECT 'distinct_o_orderkey', CAST(COUNT(DISTINCT o_orderkey) AS DOUBLE) FROM orders UNION ALL
  SELECT 'total_o_totalprice', CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) FROM orders UNION ALL
  SELECT 'avg_o_totalprice', CAST(AVG(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) FROM orders)""")
def baseline_metrics_orders(spark, sf):
    """A1-A5 generated from the measure list: count, distinct key, sum, average."""
    return A.baseline_metrics(_t(spark, sf, "orders"), "fact_orders", ["o_totalprice"], "o_orderkey",
                              averages=["o_totalprice"])


_MEASURES = [c for c, ty in SCHEMAS["lineitem"] if _role(c, _fam(ty)) == "measure"]


@register("generated_metrics_lineitem", "SELECT 'fact_lines' AS fact_name, metric, ROUND(value, 4) AS value FROM ("
          "SELECT 'row_count' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM lineitem UNION ALL "
          "SELECT 'distinct_l_orderkey', CAST(COUNT(DISTINCT l_orderkey) AS DOUBLE) FROM lineitem UNION ALL " + " UNION ALL ".join(
              f"SELECT 'total_{c}', CAST(SUM(CAST({c} AS DECIMAL(38,4))) AS DOUBLE) FROM lineitem" for c in _MEASURES) + ")")
def generated_metrics_lineitem(spark, sf):
    """A5: one SUM per measure the metadata names."""
    return A.generated_metrics(_t(spark, sf, "lineitem"), "fact_lines", "l_orderkey")


@register("distinct_keys_over_levels", """SELECT ship_year, l_returnflag, l_linestatus,
  3 - CAST(GROUPING(ship_year) + GROUPING(l_returnflag) + GROUPING(l_linestatus) AS INTEGER) AS depth, COUNT(*) AS row_count,
  COUNT(DISTINCT l_orderkey) AS distinct_l_orderkey, SUM(CAST(l_quantity AS DECIMAL(38,4))) AS total_l_quantity
FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem) GROUP BY ROLLUP (ship_year, l_returnflag, l_linestatus)""")
def distinct_keys_over_levels(spark, sf):
    """A2 + A9: distinct orders per level from bitmaps combined up the rollup."""
    li = _t(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return distinct_over_levels(li, ["ship_year", "l_returnflag", "l_linestatus"], "l_orderkey", ["l_quantity"])


@register("distinct_customers_by_geography", """SELECT r_name, n_name, c_mktsegment,
  3 - CAST(GROUPING(r_name) + GROUPING(n_name) + GROUPING(c_mktsegment) AS INTEGER) AS depth, COUNT(*) AS row_count,
  COUNT(DISTINCT o_custkey) AS distinct_o_custkey
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""")
def distinct_customers_by_geography(spark, sf):
    """A2 + A9: buying customers per region, nation and segment."""
    o, c, n, r = (_t(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    x = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return distinct_over_levels(x, ["r_name", "n_name", "c_mktsegment"], "o_custkey")


@register("revenue_per_customer", """SELECT ROUND(CAST(AVG(v) AS DOUBLE), 4) AS revenue_per_o_custkey,
  COUNT(*) AS o_custkey_count FROM (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS v
  FROM orders GROUP BY o_custkey)""")
def revenue_per_customer(spark, sf):
    """A6."""
    return A.per_entity_kpi(_t(spark, sf, "orders"), "o_custkey", "o_totalprice", "revenue")


@register("avg_order_value_by_segment", """SELECT c_mktsegment,
  ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) / COUNT(DISTINCT o_orderkey) AS DOUBLE), 4) AS avg_order_value,
  COUNT(DISTINCT o_orderkey) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def avg_order_value_by_segment(spark, sf):
    """Average order value per market segment."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    return A.average_order_value(x, "o_totalprice", "o_orderkey", by=["c_mktsegment"])


@register("purchase_conversion", """SELECT user_id,
  COUNT(*) FILTER (WHERE event_type = 'purchase') AS conversion_num,
  COUNT(*) FILTER (WHERE event_type = 'view') AS conversion_den,
  ROUND(COUNT(*) FILTER (WHERE event_type = 'purchase') / NULLIF(COUNT(*) FILTER (WHERE event_type = 'view'), 0), 6)
    AS conversion
FROM events GROUP BY user_id""")
def purchase_conversion(spark, sf):
    """Purchases per view per user; zero views -> NULL."""
    e = _t(spark, sf, "events")
    return A.ratio_kpi(e, F.col("event_type") == "purchase", F.col("event_type") == "view", "conversion",
                       by=["user_id"])


@register("rollup_lines", """SELECT l_returnflag, l_linestatus, COUNT(*) AS row_count,
  SUM(CAST(l_quantity AS DECIMAL(38,4))) AS total_l_quantity,
  SUM(CAST(l_extendedprice AS DECIMAL(38,4))) AS total_l_extendedprice
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_lines(spark, sf):
    """Pre-aggregation with subtotals along the level hierarchy."""
    return A.pre_aggregate(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                           ["l_quantity", "l_extendedprice"], rollup=True)


@register("revenue_by_region", """SELECT r_name, n_name, SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS revenue,
  COUNT(*) AS row_count
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
def revenue_by_region(spark, sf):
    """A10: a base metric sliced by dimension attributes through the FK chain."""
    c, n, r = _t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select("c_custkey", "n_name", "r_name")
    return A.metric_by_dimension(_t(spark, sf, "orders"), [(cust, "o_custkey", "c_custkey")],
                                 ["r_name", "n_name"], "o_totalprice", "revenue")


_LAYERED = [A.Metric("aov", "round(try_divide(revenue, orders), 4)", ("revenue", "orders")),
            A.Metric("revenue_per_customer", "round(try_divide(revenue, customers), 4)", ("revenue", "customers")),
            A.Metric("aov_thousands", "round(aov / 1000, 4)", ("aov",)),
            A.Metric("return_rate", "returns / orders", ("returns", "orders"))]


@register("layered_metrics_segment", """SELECT c_mktsegment, revenue, orders, customers,
  ROUND(CAST(revenue / orders AS DOUBLE), 4) AS aov, ROUND(CAST(revenue / customers AS DOUBLE), 4)
    AS revenue_per_customer, ROUND(ROUND(CAST(revenue / orders AS DOUBLE), 4) / 1000, 4) AS aov_thousands
FROM (SELECT c_mktsegment, CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS revenue,
             COUNT(DISTINCT o_orderkey) AS orders, COUNT(DISTINCT o_custkey) AS customers
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)""")
def layered_metrics_segment(spark, sf):
    """Metrics on metrics; ``return_rate`` lacks its base and is skipped."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    base = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment")
            .agg(F.sum(F.col("o_totalprice").cast("decimal(38,4)")).cast("double").alias("revenue"),
                 F.count_distinct("o_orderkey").alias("orders"), F.count_distinct("o_custkey").alias("customers")))
    out, _skipped = A.layered_metrics(base, _LAYERED)
    return out


_DAILY_SQL = """d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS amount
  FROM orders GROUP BY 1)"""


@register("rolling_7d_revenue", f"""WITH {_DAILY_SQL}
SELECT day, amount, SUM(amount) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
  AS rolling_7d FROM d""")
def rolling_7d_revenue(spark, sf):
    """W4."""
    return A.rolling(A.daily(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice"), 7)


@register("to_date_revenue", f"""WITH {_DAILY_SQL}
SELECT day, amount,
  SUM(amount) OVER (PARTITION BY date_trunc('month', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS mtd,
  SUM(amount) OVER (PARTITION BY date_trunc('quarter', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS qtd,
  SUM(amount) OVER (PARTITION BY date_trunc('year', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS ytd FROM d""")
def to_date_revenue(spark, sf):
    """MTD / QTD / YTD."""
    return A.to_date_totals(A.daily(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice"))


@register("prior_month_growth", """WITH p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
  SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS amount FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series((SELECT MIN(period) FROM p), (SELECT MAX(period) FROM p),
  INTERVAL 1 MONTH)) AS DATE) AS period),
s AS (SELECT spine.period, p.amount FROM spine LEFT JOIN p ON spine.period = p.period)
SELECT period, amount, LAG(amount) OVER (ORDER BY period) AS prior_amount,
  CAST(ROUND((amount - LAG(amount) OVER (ORDER BY period)) / NULLIF(LAG(amount) OVER (ORDER BY period), 0) * 100, 4)
    AS DOUBLE) AS growth_pct FROM s""")
def prior_month_growth(spark, sf):
    """W6 + W7 on a complete month spine."""
    return A.prior_period(A.period_totals(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice", "month"))


@register("segment_revenue_share", """WITH s AS (SELECT c_mktsegment, SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)
SELECT c_mktsegment, revenue, CAST(ROUND(revenue / (SELECT SUM(revenue) FROM s) * 100, 4) AS DOUBLE) AS share_pct FROM s""")
def segment_revenue_share(spark, sf):
    """Part / whole."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    s = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment")
         .agg(F.sum(F.col("o_totalprice").cast("decimal(38,4)")).alias("revenue")))
    return A.share_of_total(s, "revenue")


@register("shared_column_names", """SELECT column_name FROM (
  SELECT lower(column_name) AS column_name FROM information_schema.columns WHERE table_name = 'documents'
  INTERSECT SELECT lower(column_name) FROM information_schema.columns WHERE table_name = 'labels')""")
def shared_column_names(spark, sf):
    """Intersection of two tables' column-name sets."""
    a = spark.createDataFrame([(c.lower(),) for c in _t(spark, sf, "documents").columns], "column_name string")
    b = spark.createDataFrame([(c.lower(),) for c in _t(spark, sf, "labels").columns], "column_name string")
    return a.intersect(b)
