"""End-to-end star build over the driver tables, in the rules' dependency order:
dimensions -> bridges -> facts -> gates -> audit (SURVEY 3.3).

Each target is written once as a parquet table (S9, overwrite: a re-run replaces the
load); its gates and its audit row are observed by the job that writes it. Later steps
read the written dimension instead of recomputing its lineage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators import dims as Dm
from stellate.operators import facts as Fa
from stellate.operators import loading as L
from stellate.operators import quality as Q
from stellate.sources import files as S
from stellate.sources.tables import load_table


def build_star(spark: SparkSession, sf_dir: str, out_dir: str | None = None, audit_path: str | None = None):
    """Build dims, bridge and facts; return (targets, audit, gates).

    The audit rows are also appended (S11: an append-only record of loads) to
    ``audit_path``, by default ``<out_dir>/_load_audit``; each run adds its rows with
    the run's timestamp and output folder.
    """
    out_dir = out_dir or S.scratch_path(spark, "star")
    loads: dict[str, L.Loaded] = {}

    def write(df: DataFrame, name: str, checks: L.Checks | None = None, columns=None) -> DataFrame:
        loads[name] = L.load(df, os.path.join(out_dir, name), name, checks, columns)
        return loads[name].target()

    t = {n: load_table(spark, sf_dir, n) for n in ("customer", "nation", "region", "part", "supplier",
                                                   "orders", "lineitem")}
    # dimensions
    geo = write(Dm.dim_geography(t["nation"], t["region"]), "dim_geography")
    cust = Dm.build_dimension(t["customer"], Dm.DimensionSpec(
        name="dim_customer", natural_key=("c_custkey",), key_name="customer_key",
        attributes={"customer_name": "c_name", "market_segment": "c_mktsegment", "c_nationkey": "c_nationkey"},
        foreign_keys=("c_nationkey",)))
    cust = Fa.lookup_key(cust, geo, "c_nationkey", "n_nationkey", "geography_key")
    cust = write(cust.select("customer_key", "c_custkey", "customer_name", "market_segment", F.col("geography_key").alias("customer_geography_key")),
                 "dim_customer", L.Checks(keys=("customer_geography_key",)))
    prod = write(Dm.build_dimension(t["part"], Dm.DimensionSpec(
        name="dim_product", natural_key=("p_partkey",), key_name="product_key",
        attributes={"product_name": "p_name", "product_brand": "p_brand", "product_type": "p_type"})),
        "dim_product")
    comp = write(Dm.build_dimension(t["supplier"], Dm.DimensionSpec(
        name="dim_company", natural_key=("s_suppkey",), key_name="company_key",
        attributes={"company_name": "s_name"})), "dim_company")
    cal = write(Dm.dim_date_for(t["orders"], "o_orderdate"), "dim_date")
    status = write(Dm.status_dimension(t["orders"], ["o_orderstatus", "o_orderpriority"], "order_status_key"), "dim_order_status")
    # bridge
    pairs = t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey",
                                                                                              "l_partkey")
    bridge = write(Dm.build_bridge(
        pairs, cust.select(F.col("c_custkey").alias("o_custkey"), "customer_key"), "o_custkey", "customer_key",
        prod.select(F.col("p_partkey").alias("l_partkey"), "product_key"), "l_partkey", "product_key"),
        "bridge_customer_product", L.Checks(keys=("customer_key", "product_key")))
    # facts
    o = t["orders"].withColumn("_od", F.to_date("o_orderdate"))
    orders_fact = Fa.load_fact(o, Fa.FactSpec(
        name="fact_sales_orders",
        columns={"o_orderkey": "o_orderkey", "order_amount": F.col("o_totalprice").cast("decimal(18,4)"),
                 "order_date_key": "order_date_key", "customer_key": "customer_key",
                 "order_status_key": "order_status_key", "o_custkey": "o_custkey"},
        lookups=((cal.select("full_date", F.col("date_key").alias("order_date_key")), "_od", "full_date",
                  "order_date_key"),
                 (cust, "o_custkey", "c_custkey", "customer_key"),
                 (status, ["o_orderstatus", "o_orderpriority"], ["o_orderstatus", "o_orderpriority"],
                  "order_status_key")),
        required_key=("o_orderkey",)))
    keys = ("order_date_key", "customer_key", "order_status_key")
    # the natural keys tell orphans and are not written
    orders_fact = write(orders_fact, "fact_sales_orders", L.Checks(
        required={"o_orderkey": 0.0}, looked_up={"customer_key": "o_custkey"}, coverage=dict.fromkeys(keys, 0.95), keys=keys),
        [c for c in orders_fact.columns if c != "o_custkey"])
    li = t["lineitem"].withColumn("_sd", F.to_date("l_shipdate"))
    lines_fact = Fa.load_fact(li, Fa.FactSpec(
        name="fact_sales_lines",
        columns={"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
                 "sales_quantity": F.col("l_quantity").cast("decimal(18,4)"),
                 "sales_amount": (F.col("l_extendedprice").cast("decimal(18,4)")
                                  * (F.lit(1) - F.col("l_discount").cast("decimal(18,4)"))).cast("decimal(18,4)"),
                 "ship_date_key": "ship_date_key", "product_key": "product_key", "company_key": "company_key",
                 "l_partkey": "l_partkey", "l_suppkey": "l_suppkey"},
        lookups=((cal.select("full_date", F.col("date_key").alias("ship_date_key")), "_sd", "full_date",
                  "ship_date_key"),
                 (prod, "l_partkey", "p_partkey", "product_key"),
                 (comp, "l_suppkey", "s_suppkey", "company_key"))))
    keys = ("ship_date_key", "product_key", "company_key")
    lines_fact = write(lines_fact, "fact_sales_lines", L.Checks(
        looked_up={"product_key": "l_partkey", "company_key": "l_suppkey"}, coverage=dict.fromkeys(keys, 0.95), keys=keys),
        [c for c in lines_fact.columns if c not in ("l_partkey", "l_suppkey")])
    targets = {"dim_geography": geo, "dim_customer": cust, "dim_product": prod, "dim_company": comp,
               "dim_date": cal, "dim_order_status": status, "bridge_customer_product": bridge,
               "fact_sales_orders": orders_fact, "fact_sales_lines": lines_fact}
    audit = Q.gate_report(*[x.audit(i + 1) for i, x in enumerate(loads.values())])
    Q.write_audit(audit.select("*", F.current_timestamp().alias("run_at"), F.lit(out_dir).alias("run_dir")),
                  audit_path or os.path.join(out_dir, "_load_audit"))
    gates = Q.gate_report(loads["fact_sales_orders"].gates(), loads["fact_sales_lines"].gates())
    return targets, audit, gates
