"""Registered quality-gate and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.operators import dims as Dm
from stellate.operators import facts as Fa
from stellate.operators import loading as L
from stellate.operators import profile as P
from stellate.operators import quality as Q
from stellate.plans.registry import register
from stellate.plans.sqlgen import profile_sql
from stellate.sources import derived as D
from stellate.sources import files as S
from stellate.sources.tables import TABLES, load_table


def _t(spark, sf, name):
    return load_table(spark, sf, name)


@register("load_tables_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES))
def load_tables_counts(spark, sf):
    """Every source table read; row counts come from parquet metadata where possible."""
    parts = [_t(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(t).alias("table_name"), "row_count") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


PD_SQL = f"""{D.BENT_CUSTOMER_SQL},
pd AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey FROM bent_customer),
fo AS (SELECT o_orderkey, o_custkey, customer_key FROM orders LEFT JOIN pd ON o_custkey = c_custkey)"""


def _fact_orders(spark, sf):
    pd = Dm.surrogate_key(D.bent_customer(spark, sf).select("c_custkey"), "c_custkey", "customer_key")
    return Fa.lookup_key(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), pd, "o_custkey", "c_custkey",
                         "customer_key")


def _gate_sql(gate, table, column, observed, threshold, higher_is_bad=True):
    op = "<=" if higher_is_bad else ">="
    return (f"SELECT '{gate}' AS gate, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST({observed} AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold, "
            f"COALESCE(CAST({observed} AS DOUBLE) {op} {threshold}, FALSE) AS passed")


Q1_SQL = (_gate_sql("null_rate", "fact_orders", "o_orderkey",
                    "(SELECT ROUND(AVG(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM fo)", 0.0)
          + " UNION ALL " +
          _gate_sql("null_rate", "fact_orders", "customer_key",
                    "(SELECT ROUND(AVG(CASE WHEN customer_key IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM fo)", 0.0))


@register("null_rate_gate", f"WITH {PD_SQL} {Q1_SQL}")
def null_rate_gate(spark, sf):
    """Q1."""
    return Q.null_rate(_fact_orders(spark, sf), "fact_orders", ["o_orderkey", "customer_key"], 0.0)


@register("orphans_summary", f"""WITH {PD_SQL}
SELECT COUNT(*) AS checked, COUNT(*) FILTER (WHERE c_custkey IS NULL) AS orphan_rows,
       ROUND(COUNT(*) FILTER (WHERE c_custkey IS NULL) / COUNT(*), 6) AS orphan_rate
FROM orders LEFT JOIN pd ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL""")
def orphans_summary(spark, sf):
    """Q2 (summary): orders whose customer is missing from the dimension."""
    s, _ = Q.orphans(_t(spark, sf, "orders"), D.bent_customer(spark, sf), "o_custkey", "c_custkey")
    return s


@register("orphan_rows", f"""WITH {D.BENT_CUSTOMER_SQL}
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM bent_customer)""")
def orphan_rows(spark, sf):
    """Q2 (rows)."""
    _, bad = Q.orphans(_t(spark, sf, "orders"), D.bent_customer(spark, sf), "o_custkey", "c_custkey")
    return bad.select("o_orderkey", "o_custkey")


DATE_RE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
Q3_SQL = _gate_sql("format_rate", "membership_log", "effectivedate",
                   f"(SELECT ROUND(COUNT(*) FILTER (WHERE regexp_matches(effectivedate, '{DATE_RE}')) / COUNT(*), 6) "
                   "FROM membership_log WHERE effectivedate IS NOT NULL)", 1.0, higher_is_bad=False)


@register("format_gate", f"WITH {D.MEMBERSHIP_LOG_SQL} {Q3_SQL}")
def format_gate(spark, sf):
    """Q3."""
    return Q.format_gate(D.membership_log(spark, sf), "membership_log", "effectivedate", DATE_RE, 1.0)


_QUAR_SQL = """q AS (SELECT l_orderkey, l_linenumber, list_filter([
    CASE WHEN l_shipdate < o_orderdate THEN 'ship_before_order' END,
    CASE WHEN l_quantity <= 0 THEN 'non_positive_quantity' END,
    CASE WHEN l_discount > 0.1 THEN 'discount_out_of_range' END], lambda x: x IS NOT NULL) AS reasons
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""


def _quarantine_rules():
    return {"ship_before_order": F.col("l_shipdate") < F.col("o_orderdate"), "non_positive_quantity": F.col("l_quantity") <= 0,
            "discount_out_of_range": F.col("l_discount") > 0.1}


def _quarantine(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_discount")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    x = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    return Q.quarantine(x, _quarantine_rules())


@register("quarantine_bad_rows", f"""WITH {_QUAR_SQL}
SELECT l_orderkey, l_linenumber, array_to_string(reasons, ',') AS reasons FROM q WHERE len(reasons) > 0""")
def quarantine_bad_rows(spark, sf):
    """Q4 (bad side, with reasons)."""
    _, bad = _quarantine(spark, sf)
    return bad.select("l_orderkey", "l_linenumber", F.array_join("quarantine_reasons", ",").alias("reasons"))


@register("quarantine_clean_rows", f"""WITH {_QUAR_SQL}
SELECT l_orderkey, l_linenumber FROM q WHERE len(reasons) = 0""")
def quarantine_clean_rows(spark, sf):
    """Q4 (clean side): clean + bad = input."""
    clean, _ = _quarantine(spark, sf)
    return clean.select("l_orderkey", "l_linenumber")


@register("duplicate_keys_lineitem", """SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def duplicate_keys_lineitem(spark, sf):
    """Q5."""
    return Q.duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_Q6_TABLES = ("orders", "events")


@register("empty_or_low_flags", "WITH prof AS (" + " UNION ALL ".join(
    [profile_sql(t) for t in _Q6_TABLES]
    + [profile_sql("orders").replace("FROM orders", "FROM (SELECT * FROM orders WHERE 1 = 0)")
       .replace("'orders' AS table_name", "'orders_empty' AS table_name")]) + """),
pk(table_name, column_name) AS (VALUES ('orders', 'o_orderkey')),
s AS (SELECT p.table_name, MAX(total_rows) AS row_count, ROUND(AVG(null_pct), 2) AS a,
             BOOL_OR(pk.column_name IS NOT NULL) AS has_pk
      FROM prof p LEFT JOIN pk ON p.table_name = pk.table_name AND p.column_name = pk.column_name
      GROUP BY p.table_name)
SELECT table_name, CASE WHEN row_count = 0 THEN 'source empty: load guarded with WHERE 1 = 0'
  ELSE 'readiness low: review keys and nulls' END AS warning
FROM s WHERE row_count = 0 OR NOT (has_pk AND a < 30)""")
def empty_or_low_flags(spark, sf):
    """Q6: empty sources and low readiness."""
    tabs = {t: _t(spark, sf, t) for t in _Q6_TABLES}
    tabs["orders_empty"] = D.empty_orders(spark, sf)
    prof, _, _ = P.profile_many(tabs, percentiles=None)
    pk = spark.createDataFrame([("orders", "o_orderkey")], "table_name string, column_name string")
    return Q.empty_or_low_flags(P.table_summary(prof, pk))


_LENGTHS = {"text": 4000, "lang": 10, "source": 50}


@register("length_gate_documents", " UNION ALL ".join(
    _gate_sql("too_long", "documents", c, f"(SELECT COUNT(*) FILTER (WHERE length({c}) > {n}) FROM documents)", 0)
    for c, n in _LENGTHS.items()))
def length_gate_documents(spark, sf):
    """Q7: values longer than the declared VARCHAR(n) (whole texts measured)."""
    return Q.length_gate(_t(spark, sf, "documents"), "documents", _LENGTHS)


Q8_SQL = _gate_sql("fk_coverage", "fact_orders", "customer_key",
                   "(SELECT ROUND(AVG(CASE WHEN customer_key IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) FROM fo)",
                   0.95, higher_is_bad=False)


@register("fk_coverage_gate", f"WITH {PD_SQL} {Q8_SQL}")
def fk_coverage_gate(spark, sf):
    """Q8."""
    return Q.fk_coverage(_fact_orders(spark, sf), "fact_orders", ["customer_key"], 0.95)


Q2G_SQL = _gate_sql("orphan_rate", "fact_orders", "o_custkey",
                    "(SELECT ROUND(COUNT(*) FILTER (WHERE c_custkey IS NULL) / COUNT(*), 6) FROM orders "
                    "LEFT JOIN pd ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL)", 0.0)
Q7_SQL = " UNION ALL ".join(
    _gate_sql("too_long", "documents", c, f"(SELECT COUNT(*) FILTER (WHERE length({c}) > {n}) FROM documents)", 0)
    for c, n in _LENGTHS.items())


@register("gate_report", f"""WITH {PD_SQL}, {D.MEMBERSHIP_LOG_SQL}
{Q1_SQL} UNION ALL {Q2G_SQL} UNION ALL {Q3_SQL} UNION ALL {Q7_SQL} UNION ALL {Q8_SQL}""")
def gate_report(spark, sf):
    """Q9: one table of every gate."""
    fo = _fact_orders(spark, sf)
    pd = Dm.surrogate_key(D.bent_customer(spark, sf).select("c_custkey"), "c_custkey", "customer_key")
    return Q.gate_report(
        Q.null_rate(fo, "fact_orders", ["o_orderkey", "customer_key"], 0.0),
        Q.orphan_gate(_t(spark, sf, "orders"), pd, "o_custkey", "c_custkey", "fact_orders", 0.0),
        Q.format_gate(D.membership_log(spark, sf), "membership_log", "effectivedate", DATE_RE, 1.0),
        Q.length_gate(_t(spark, sf, "documents"), "documents", _LENGTHS),
        Q.fk_coverage(fo, "fact_orders", ["customer_key"], 0.95))


_EMPTY_GATES = (("null_rate", "o_orderkey", "ROUND(AVG(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END), 6)", 0.0, True),
                ("orphan_rate", "o_custkey", "ROUND(COUNT(*) FILTER (WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer))"
                 " / NULLIF(COUNT(o_custkey), 0), 6)", 0.0, True),
                ("format_rate", "o_orderpriority", r"ROUND(COUNT(*) FILTER (WHERE regexp_matches(o_orderpriority, '^\d')) / NULLIF(COUNT(o_orderpriority), 0), 6)", 1.0, False),
                ("too_long", "o_orderstatus", "CASE WHEN COUNT(*) > 0 THEN COUNT(*) FILTER (WHERE length(o_orderstatus) > 1) END", 0.0, True),
                ("fk_coverage", "o_custkey", "ROUND(AVG(CASE WHEN o_custkey IS NULL THEN 0.0 ELSE 1.0 END), 6)", 0.95, False))


@register("gates_on_empty_load", " UNION ALL ".join(
    _gate_sql(gate, table, col, f"(SELECT {sql} FROM orders{where})", thr, bad)
    for table, where in (("orders", ""), ("empty_orders", " WHERE 1 = 0")) for gate, col, sql, thr, bad in _EMPTY_GATES))
def gates_on_empty_load(spark, sf):
    """Q1-Q3, Q7, Q8 on the filled source and on an empty load of it: nothing observed, nothing passed."""
    found = []
    for name, o in (("orders", _t(spark, sf, "orders")), ("empty_orders", D.empty_orders(spark, sf))):
        found += [Q.null_rate(o, name, ["o_orderkey"], 0.0),
                  Q.orphan_gate(o, _t(spark, sf, "customer"), "o_custkey", "c_custkey", name),
                  Q.format_gate(o, name, "o_orderpriority", r"^\d", 1.0), Q.length_gate(o, name, {"o_orderstatus": 1}),
                  Q.fk_coverage(o, name, ["o_custkey"], 0.95)]
    return Q.gate_report(*found)


def _checked_load(spark, sf):
    """Order lines loaded with the quarantine rules and every gate, in one job."""
    li = _t(spark, sf, "lineitem")
    x = li.join(_t(spark, sf, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    checks = L.Checks(required={"l_orderkey": 0.0}, looked_up={"o_orderkey": "l_orderkey"}, formats={"l_returnflag": ("^[AR]$", 0.9)},
                      lengths={"l_linestatus": 1}, coverage={"o_orderkey": 0.95}, rules=_quarantine_rules(), keys=("o_orderkey",))
    return L.load(x, S.scratch_path(spark, "checked-load"), "order_lines", checks, li.columns)


@register("checked_load_rows", f"""WITH {_QUAR_SQL} SELECT CASE WHEN len(reasons) = 0 THEN 'clean' ELSE 'bad' END AS sink,
  l_orderkey, l_linenumber, array_to_string(reasons, ',') AS reasons FROM q""")
def checked_load_rows(spark, sf):
    """Q4 while loading: both sinks of one write, read back."""
    done = _checked_load(spark, sf)
    keys = ["l_orderkey", "l_linenumber"]
    return (done.target().select(F.lit("clean").alias("sink"), *keys, F.lit("").alias("reasons"))
            .unionByName(done.bad().select(F.lit("bad").alias("sink"), *keys, F.array_join(L.REASONS, ",").alias("reasons"))))


_CLEAN_SQL = """cl AS (SELECT l.*, o_orderkey FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey
  WHERE NOT COALESCE(l_shipdate < o_orderdate, FALSE) AND NOT COALESCE(l_quantity <= 0, FALSE) AND NOT COALESCE(l_discount > 0.1, FALSE))"""


@register("checked_load_gates", f"WITH {_CLEAN_SQL} " + " UNION ALL ".join([
    _gate_sql("null_rate", "order_lines", "l_orderkey", "(SELECT ROUND(AVG(CASE WHEN l_orderkey IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM cl)", 0.0),
    _gate_sql("orphan_rate", "order_lines", "o_orderkey", "(SELECT ROUND(AVG(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM cl WHERE l_orderkey IS NOT NULL)", 0.0),
    _gate_sql("format_rate", "order_lines", "l_returnflag", "(SELECT ROUND(AVG(CASE WHEN regexp_matches(l_returnflag, '^[AR]$') THEN 1.0 ELSE 0.0 END), 6) FROM cl WHERE l_returnflag IS NOT NULL)", 0.9, False),
    _gate_sql("too_long", "order_lines", "l_linestatus", "(SELECT COUNT(*) FILTER (WHERE length(l_linestatus) > 1) FROM cl)", 0.0),
    _gate_sql("fk_coverage", "order_lines", "o_orderkey", "(SELECT ROUND(AVG(CASE WHEN o_orderkey IS NULL THEN 0.0 ELSE 1.0 END), 6) FROM cl)", 0.95, False)]))
def checked_load_gates(spark, sf):
    """Q1-Q3, Q7-Q9 as observed by the job that wrote the clean rows."""
    return _checked_load(spark, sf).gates()


@register("load_audit", f"""WITH {PD_SQL}
SELECT 1 AS step, 'dim_customer' AS target, (SELECT COUNT(*) FROM pd) AS row_count, CAST(NULL AS DOUBLE) AS null_fk_rate,
  CASE WHEN (SELECT COUNT(*) FROM pd) = 0 THEN 'empty load' END AS warning
UNION ALL
SELECT 2, 'fact_orders', (SELECT COUNT(*) FROM fo),
  (SELECT ROUND(AVG(CASE WHEN customer_key IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM fo),
  CASE WHEN (SELECT COUNT(*) FROM fo) = 0 THEN 'empty load'
       WHEN (SELECT AVG(CASE WHEN customer_key IS NULL THEN 1.0 ELSE 0.0 END) FROM fo) > 0
       THEN 'unresolved foreign keys' END""")
def load_audit(spark, sf):
    """Ordered audit rows for the loads (appended to the audit table by the caller)."""
    pd = Dm.surrogate_key(D.bent_customer(spark, sf).select("c_custkey"), "c_custkey", "customer_key")
    return Q.audit_rows(spark, [(1, "dim_customer", pd, []), (2, "fact_orders", _fact_orders(spark, sf),
                                                              ["customer_key"])])
