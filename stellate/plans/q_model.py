"""Registered model-validation and file round-trip queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.operators import catalog as M
from stellate.operators import discovery as K
from stellate.operators import model as V
from stellate.operators import profile as P
from stellate.plans import q_catalog as QC
from stellate.plans import q_star as QS
from stellate.plans.registry import register
from stellate.plans.sqlgen import profile_sql
from stellate.sources import files as S
from stellate.sources.tables import TABLES, load_tables

REL = ["from_table", "from_column", "to_table", "to_column"]


def _tables(spark, sf):
    return load_tables(spark, sf, TABLES)


def _inferred(spark, sf):
    tabs, kp, pks, fks = QC._relations(spark, sf)
    return tabs, kp, pks, fks.select(*REL)


def _declared(spark):
    return spark.createDataFrame(QC.DECLARED_FK, "from_table string, from_column string, to_table string, "
                                                 "to_column string")


DECL_SQL = f"decl(from_table, from_column, to_table, to_column) AS (VALUES {QC.FK_VALUES})"


@register("missing_relation_columns", f"""WITH {QC.CAT_SQL}, {DECL_SQL}
SELECT d.*, 'from' AS missing_end FROM decl d WHERE NOT EXISTS (SELECT 1 FROM cat c
  WHERE c.table_name = d.from_table AND c.column_name = d.from_column)
UNION ALL
SELECT d.*, 'to' FROM decl d WHERE NOT EXISTS (SELECT 1 FROM cat c
  WHERE c.table_name = d.to_table AND c.column_name = d.to_column)""")
def missing_relation_columns(spark, sf):
    """V1: planned relation ends checked against the catalog of the tables."""
    return V.missing_columns(_declared(spark), QC._catalog(spark, sf))


_PATHS_SQL = f"""{DECL_SQL},
e AS (SELECT DISTINCT from_table AS a, to_table AS b FROM decl WHERE from_table <> to_table),
paths AS (SELECT * FROM (
  WITH RECURSIVE p(src, dst, path) AS (
    SELECT a, b, [a, b] FROM e
    UNION ALL
    SELECT p.src, e.b, list_append(p.path, e.b) FROM p JOIN e ON p.dst = e.a
    WHERE NOT list_contains(p.path, e.b))
  SELECT * FROM p))"""


_INF_PATHS_SQL = f"""{QC.FKS_SQL},
fk AS (SELECT from_table, to_table FROM rates WHERE distinct_values > 0 AND found_values = distinct_values),
e AS (SELECT DISTINCT from_table AS a, to_table AS b FROM fk WHERE from_table <> to_table),
paths AS (SELECT * FROM (
  WITH RECURSIVE p(src, dst, path) AS (
    SELECT a, b, [a, b] FROM e
    UNION ALL
    SELECT p.src, e.b, list_append(p.path, e.b) FROM p JOIN e ON p.dst = e.a
    WHERE NOT list_contains(p.path, e.b))
  SELECT * FROM p))"""


@register("ambiguous_paths", f"""WITH {_INF_PATHS_SQL}
SELECT src, dst FROM paths GROUP BY src, dst HAVING COUNT(*) > 1""")
def ambiguous_paths(spark, sf):
    """V2 on the relations discovered from the data (lineitem reaches nation via orders and
    via supplier)."""
    _, _, _, fks = _inferred(spark, sf)
    return V.ambiguous_paths(fks).select("src", "dst")


@register("relation_cycles", f"""WITH {QC.JOINS_SQL},
e AS (SELECT DISTINCT from_table AS a, to_table AS b FROM k8 WHERE from_table <> to_table),
r AS (SELECT * FROM (
  WITH RECURSIVE p(src, dst) AS (SELECT a, b FROM e UNION SELECT p.src, e.b FROM p JOIN e ON p.dst = e.a)
  SELECT * FROM p)),
g AS (SELECT x.src, x.dst FROM r x JOIN r y ON x.src = y.dst AND x.dst = y.src)
SELECT src AS start, string_agg(dst, ',' ORDER BY dst) AS tables FROM g GROUP BY src HAVING src = MIN(dst)""")
def relation_cycles(spark, sf):
    """V3: circular relationships among the discovered joins (shared keys run both ways)."""
    _, joins = QC._joins(spark, sf)
    rel = joins.select("from_table", F.lit("").alias("from_column"), "to_table", F.lit("").alias("to_column"))
    return V.cycles(rel).select("start", "tables")


@register("unused_tables", f"""WITH {QC.FKS_SQL},
fk AS (SELECT from_table, to_table FROM rates WHERE distinct_values > 0 AND found_values = distinct_values)
SELECT DISTINCT table_name FROM cat WHERE table_name NOT IN (SELECT from_table FROM fk)
  AND table_name NOT IN (SELECT to_table FROM fk) AND table_name NOT IN ('orders', 'events')""")
def unused_tables(spark, sf):
    """V4: tables in no discovered relation and no metric (metrics exist on orders and events)."""
    tabs, _, _, fks = _inferred(spark, sf)
    metric_tables = spark.createDataFrame([("orders",), ("events",)], "table_name string")
    return V.unused_tables(M.table_list(M.catalog_columns(spark, tabs)), fks, metric_tables)


def _built_tables(spark, sf):
    return {"fact_sales_lines": QS.fact_sales_lines(spark, sf),
            "fact_sales_orders": QS.fact_sales_orders(spark, sf),
            "fact_memberships": QS.fact_memberships(spark, sf),
            "dim_date": QS.dim_date(spark, sf),
            "dim_customer": QS.build_dimension_customer(spark, sf)}


_BUILT_COLS = {
    "fact_sales_lines": [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("sales_quantity", "decimal(18,4)"),
                         ("sales_amount", "decimal(18,4)"), ("ship_date", "date"), ("ship_date_key", "int"),
                         ("product_key", "bigint"), ("company_key", "bigint"), ("order_key", "bigint")],
    "fact_sales_orders": [("o_orderkey", "bigint"), ("order_amount", "decimal(18,4)"), ("order_date", "date"),
                          ("order_date_key", "int"), ("customer_key", "bigint"), ("geography_key", "bigint")],
    "fact_memberships": [("membership_quantity", "decimal(18,4)"), ("membership_amount", "decimal(18,4)"),
                         ("membership_start_date", "date"), ("membership_end_date", "date"),
                         ("membership_grace_date", "date"), ("individual_key", "bigint"), ("company_key", "bigint"),
                         ("geography_key", "bigint")],
}
_STAR_REL = [("fact_sales_orders", "order_date_key", "dim_date", "date_key"),
             ("fact_sales_orders", "customer_key", "dim_customer", "customer_key"),
             ("fact_sales_lines", "ship_date_key", "dim_date", "date_key")]
_STAR_PK = [("dim_date", "date_key"), ("dim_customer", "customer_key")]


def _naming_sql():
    vals = ", ".join(f"('{t}', '{c}', '{ty}')" for t, cols in _BUILT_COLS.items() for c, ty in cols)
    rel = ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in _STAR_REL)
    pk = ", ".join(f"('{a}', '{b}')" for a, b in _STAR_PK)
    return f"""WITH cols(table_name, column_name, data_type) AS (VALUES {vals}),
rel(from_table, from_column, to_table, to_column) AS (VALUES {rel}),
pk(table_name, column_name) AS (VALUES {pk}),
c AS (SELECT *, lower(column_name) AS low,
  regexp_matches(lower(column_name), '(^|_)date(_|$)') AS has_date,
  regexp_matches(lower(column_name), '_(key|id|sk)$') AS is_key,
  array_to_string(list_filter(string_split(lower(column_name), '_'),
    lambda x: NOT regexp_matches(x, '^(date|key|id|sk)$') AND x <> ''), '_') AS middle FROM cols),
v AS (SELECT table_name, column_name,
  CASE WHEN has_date AND is_key AND NOT (starts_with(low, 'date') AND ends_with(low, 'key'))
         THEN 'date key must start with date and end with key'
       WHEN (has_date OR regexp_matches(lower(data_type), '^(date|timestamp)')) AND NOT is_key
            AND NOT starts_with(low, 'date') THEN 'date column must start with date' END AS rule,
  CASE WHEN has_date AND is_key AND NOT (starts_with(low, 'date') AND ends_with(low, 'key'))
         THEN CASE WHEN middle = '' THEN 'date_key' ELSE 'date_' || middle || '_key' END
       WHEN (has_date OR regexp_matches(lower(data_type), '^(date|timestamp)')) AND NOT is_key
            AND NOT starts_with(low, 'date') THEN CASE WHEN middle = '' THEN 'date' ELSE 'date_' || middle END
  END AS suggestion FROM c)
SELECT * FROM v WHERE rule IS NOT NULL
UNION ALL
SELECT r.from_table, r.from_column, 'foreign key must equal the primary key name', p.column_name
FROM rel r JOIN pk p ON r.to_table = p.table_name WHERE r.from_column <> p.column_name"""


@register("naming_check_star", _naming_sql())
def naming_check_star(spark, sf):
    """V5 on the built star tables' schemas (e.g. ``ship_date`` -> ``date_ship``)."""
    built = {k: v for k, v in _built_tables(spark, sf).items() if k in _BUILT_COLS}
    cols = M.catalog_columns(spark, built)
    rel = spark.createDataFrame(_STAR_REL, "from_table string, from_column string, to_table string, to_column string")
    pk = spark.createDataFrame(_STAR_PK, "table_name string, column_name string")
    return V.naming_check(cols, rel, pk)


_DECLARED_TARGET = [("dim_customer", c) for c in ("customer_key", "c_custkey", "customer_name", "market_segment",
                                                   "account_balance", "customer_status")] + \
                   [("dim_date", c) for c in ("date_key", "full_date", "year", "quarter", "month")]


@register("schema_coverage", "WITH built(table_name, column_name) AS (VALUES " + ", ".join(
    f"('dim_customer', '{c}')" for c in ("customer_key", "c_custkey", "customer_name", "market_segment",
                                         "account_balance", "c_nationkey")) + ", " + ", ".join(
    f"('dim_date', '{c}')" for c in ("date_key", "full_date", "year", "quarter", "month", "month_name",
                                     "day_of_month", "day_of_week", "day_name", "week_of_year", "is_weekend",
                                     "month_key")) + "), declared(table_name, column_name) AS (VALUES " + ", ".join(
    f"('{t}', '{c}')" for t, c in _DECLARED_TARGET) + """)
SELECT *, 'declared, not built' AS issue FROM (SELECT * FROM declared EXCEPT SELECT * FROM built)
UNION ALL SELECT *, 'built, not declared' FROM (SELECT * FROM built EXCEPT SELECT * FROM declared)""")
def schema_coverage(spark, sf):
    """V6: declared target columns vs the columns the builders produced."""
    built = _built_tables(spark, sf)
    cols = M.catalog_columns(spark, {k: built[k] for k in ("dim_customer", "dim_date")})
    declared = spark.createDataFrame(_DECLARED_TARGET, "table_name string, column_name string")
    return V.schema_coverage(declared, cols)


@register("modelling_flags", f"""WITH {QC.ROLES_SQL},
u AS (SELECT table_name, column_name, nn > 0 AND nd = nn AS u FROM uniq),
card AS (SELECT f.from_table, f.from_column, f.to_table, f.to_column,
  CASE WHEN fu.u AND tu.u THEN 'one-to-one' WHEN tu.u THEN 'many-to-one' WHEN fu.u THEN 'one-to-many'
       ELSE 'many-to-many' END AS cardinality
  FROM fks f LEFT JOIN u fu ON fu.table_name = f.from_table AND fu.column_name = f.from_column
  LEFT JOIN u tu ON tu.table_name = f.to_table AND tu.column_name = f.to_column),
x AS (SELECT c.*, rf.role AS from_role, rt.role AS to_role FROM card c
      LEFT JOIN roles rf ON rf.table_name = c.from_table LEFT JOIN roles rt ON rt.table_name = c.to_table)
SELECT from_table, from_column, to_table, to_column, 'many-to-many' AS flag FROM x WHERE cardinality = 'many-to-many'
UNION ALL
SELECT from_table, from_column, to_table, to_column, 'snowflake' FROM x
WHERE from_role = 'dimension' AND to_role = 'dimension'""")
def modelling_flags(spark, sf):
    """V7: many-to-many relations and dimension -> dimension relations."""
    tabs, kp, pks, fks = _inferred(spark, sf)
    prof = P.profile_light(tabs)
    summary = P.table_summary(prof, pks.select("table_name", "column_name"))
    roles = K.infer_role(summary, fks, prof)
    return V.modelling_flags(K.relation_cardinality(fks, kp), roles)


@register("relations_match", f"""WITH {QC.FKS_SQL}, {DECL_SQL},
fk AS (SELECT from_table, from_column, to_table, to_column FROM rates
       WHERE distinct_values > 0 AND found_values = distinct_values)
SELECT *, 'planned, not built' AS issue FROM (SELECT * FROM decl EXCEPT ALL SELECT * FROM fk)
UNION ALL SELECT *, 'built, not planned' FROM (SELECT * FROM fk EXCEPT ALL SELECT * FROM decl)""")
def relations_match(spark, sf):
    """V8: planned (declared) relations vs relations discovered from the data."""
    _, _, _, fks = _inferred(spark, sf)
    return V.relations_match(_declared(spark), fks)


# ------------------------------------------------------------------ sinks round trips
@register("target_schema_roundtrip", f"""WITH {QC.CAT_SQL}
SELECT table_name, column_name, ordinal_position AS column_position, 'other' AS kind FROM cat""")
def target_schema_roundtrip(spark, sf):
    """S6 then S4: the catalog written as a Table,Column CSV and read back as a target schema."""
    path = S.scratch_path(spark, "columns-csv")
    S.write_columns(QC._catalog(spark, sf), path)
    return S.read_target_schema(spark, path)


@register("matrix_roundtrip", f"""WITH {QC.AXES_SQL}
SELECT from_table AS fact, to_table AS dim FROM k8
WHERE from_table IN (SELECT table_name FROM axes WHERE axis = 'row')
  AND to_table IN (SELECT table_name FROM axes WHERE axis = 'col')""")
def matrix_roundtrip(spark, sf):
    """S7 then S5: the relation matrix written wide and read back long."""
    cat, joins = QC._joins(spark, sf)
    axes = K.matrix_axes(K.join_role_score(joins, M.table_list(cat)))
    rows = sorted(r[0] for r in axes.where(F.col("axis") == "row").select("table_name").collect())
    cols = sorted(r[0] for r in axes.where(F.col("axis") == "col").select("table_name").collect())
    path = S.scratch_path(spark, "matrix-csv")
    S.write_matrix(K.relation_matrix_long(axes, joins), rows, cols, path)
    return S.read_matrix(spark, path)


@register("profile_json_roundtrip", "SELECT table_name, column_name, ordinal, data_type, total_rows, null_count, "
          "distinct_count, min_val, max_val, median, column_role FROM (" + " UNION ALL ".join(profile_sql(t) for t in TABLES) + ")")
def profile_json_roundtrip(spark, sf):
    """The nested profile document of all tables written as JSON lines, read back and flattened to one
    row per column."""
    tabs = load_tables(spark, sf, TABLES)
    prof, top, _ = P.profile_many(tabs, digits=6)
    doc = S.profile_document(prof, top, P.table_summary(prof), "sf")
    path = S.scratch_path(spark, "profile-json")
    S.write_profile_json(doc, path)
    c = spark.read.schema(doc.schema).json(path).select("name", F.explode("columns").alias("c"))
    return c.select(F.col("name").alias("table_name"), *[F.col(f"c.{x}") for x in (
        "column_name", "ordinal", "data_type", "total_rows", "null_count", "distinct_count", "min_val", "max_val", "median",
        "column_role")])


@register("write_table_roundtrip", f"""WITH {QS.DIM_CUSTOMER_SQL}, {QS.DIM_GEO_SQL}, {QS.DIM_DATE_SQL}
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) AS order_amount, CAST(o_orderdate AS DATE) AS order_date,
  od.date_key AS order_date_key, c.customer_key, g.geography_key
FROM orders LEFT JOIN dim_customer c ON o_custkey = c.c_custkey
LEFT JOIN dim_geography g ON c.c_nationkey = g.n_nationkey
LEFT JOIN dim_date od ON CAST(o_orderdate AS DATE) = od.full_date""")
def write_table_roundtrip(spark, sf):
    """The order fact written as a typed parquet table (overwrite = idempotent) and read back."""
    path = S.scratch_path(spark, "fact-sales-orders")
    S.write_table(QS.fact_sales_orders(spark, sf), path)
    S.write_table(QS.fact_sales_orders(spark, sf), path)  # a re-run replaces, never duplicates
    return spark.read.parquet(path)


# ------------------------------------------------------------------ end-to-end star build
_AUDIT_SQL = """WITH cal AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS a, MAX(CAST(o_orderdate AS DATE)) AS b FROM orders),
steps AS (
  SELECT 1 AS step, 'dim_geography' AS target, (SELECT COUNT(*) FROM nation) AS row_count,
         CAST(NULL AS DOUBLE) AS null_fk_rate
  UNION ALL SELECT 2, 'dim_customer', (SELECT COUNT(DISTINCT c_custkey) FROM customer),
         (SELECT ROUND(AVG(CASE WHEN n_nationkey IS NULL THEN 1.0 ELSE 0.0 END), 6)
          FROM (SELECT DISTINCT ON (c_custkey) * FROM customer WHERE c_custkey IS NOT NULL) c
          LEFT JOIN nation ON c_nationkey = n_nationkey)
  UNION ALL SELECT 3, 'dim_product', (SELECT COUNT(DISTINCT p_partkey) FROM part), NULL
  UNION ALL SELECT 4, 'dim_company', (SELECT COUNT(DISTINCT s_suppkey) FROM supplier), NULL
  UNION ALL SELECT 5, 'dim_date', (SELECT date_diff('day', a, b) + 1 FROM cal), NULL
  UNION ALL SELECT 6, 'dim_order_status',
         (SELECT COUNT(*) FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)), NULL
  UNION ALL SELECT 7, 'bridge_customer_product',
         (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)),
         0.0
  UNION ALL SELECT 8, 'fact_sales_orders', (SELECT COUNT(*) FROM orders WHERE o_orderkey IS NOT NULL),
         (SELECT ROUND(AVG(CASE WHEN c.c_custkey IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM orders
          LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) c ON o_custkey = c.c_custkey WHERE o_orderkey IS NOT NULL)
  UNION ALL SELECT 9, 'fact_sales_lines', (SELECT COUNT(*) FROM lineitem),
         (SELECT ROUND(AVG(CASE WHEN CAST(l_shipdate AS DATE) NOT BETWEEN (SELECT a FROM cal) AND (SELECT b FROM cal)
                                  OR p.p_partkey IS NULL OR s.s_suppkey IS NULL THEN 1.0 ELSE 0.0 END), 6)
          FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON l_partkey = p.p_partkey
          LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON l_suppkey = s.s_suppkey))
SELECT step, target, row_count, null_fk_rate,
  CASE WHEN row_count = 0 THEN 'empty load' WHEN null_fk_rate > 0 THEN 'unresolved foreign keys' END AS warning
FROM steps"""


@register("star_build_audit", _AUDIT_SQL)
def star_build_audit(spark, sf):
    """Entry flow: dims -> bridge -> facts written as typed tables, then the load audit."""
    from stellate.plans.star import build_star
    _, audit, _ = build_star(spark, sf)
    return audit


def _cov_sql(table, column, observed):
    return (f"SELECT 'fk_coverage' AS gate, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(ROUND({observed}, 6) AS DOUBLE) AS observed, CAST(0.95 AS DOUBLE) AS threshold, "
            f"COALESCE(ROUND({observed}, 6) >= 0.95, TRUE) AS passed")


def _star_gate(gate, table, column, observed):
    """A gate whose observed share may be 0 at most."""
    return (f"SELECT '{gate}', '{table}', '{column}', CAST(ROUND({observed}, 6) AS DOUBLE), CAST(0.0 AS DOUBLE), "
            f"COALESCE(ROUND({observed}, 6) <= 0.0, FALSE)")


_STAR_GATES_SQL = """WITH cal AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS a, MAX(CAST(o_orderdate AS DATE)) AS b FROM orders),
fo AS (SELECT o.o_orderkey, o.o_custkey, c.c_custkey FROM orders o
       LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey IS NOT NULL),
fl AS (SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) BETWEEN (SELECT a FROM cal) AND (SELECT b FROM cal) AS ship_ok,
              p.p_partkey IS NOT NULL AS part_ok, s.s_suppkey IS NOT NULL AS supp_ok
       FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON l_partkey = p.p_partkey
       LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON l_suppkey = s.s_suppkey)
""" + " UNION ALL ".join([
    _cov_sql("fact_sales_orders", "order_date_key", "(SELECT AVG(1.0) FROM fo)"),
    _cov_sql("fact_sales_orders", "customer_key",
             "(SELECT AVG(CASE WHEN c_custkey IS NOT NULL THEN 1.0 ELSE 0.0 END) FROM fo)"),
    _cov_sql("fact_sales_orders", "order_status_key", "(SELECT AVG(1.0) FROM fo)"),
    _cov_sql("fact_sales_lines", "ship_date_key", "(SELECT AVG(CASE WHEN ship_ok THEN 1.0 ELSE 0.0 END) FROM fl)"),
    _cov_sql("fact_sales_lines", "product_key", "(SELECT AVG(CASE WHEN part_ok THEN 1.0 ELSE 0.0 END) FROM fl)"),
    _cov_sql("fact_sales_lines", "company_key", "(SELECT AVG(CASE WHEN supp_ok THEN 1.0 ELSE 0.0 END) FROM fl)"),
    # natural keys that the lookups did not resolve
    _star_gate("orphan_rate", "fact_sales_orders", "customer_key", "(SELECT AVG(CASE WHEN c_custkey IS NULL THEN 1.0 ELSE 0.0 END) FROM fo WHERE o_custkey IS NOT NULL)"),
    _star_gate("orphan_rate", "fact_sales_lines", "product_key", "(SELECT AVG(CASE WHEN part_ok THEN 0.0 ELSE 1.0 END) FROM fl WHERE l_partkey IS NOT NULL)"),
    _star_gate("orphan_rate", "fact_sales_lines", "company_key", "(SELECT AVG(CASE WHEN supp_ok THEN 0.0 ELSE 1.0 END) FROM fl WHERE l_suppkey IS NOT NULL)"),
    _star_gate("null_rate", "fact_sales_orders", "o_orderkey", "(SELECT AVG(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END) FROM fo)")])


@register("star_build_gates", _STAR_GATES_SQL)
def star_build_gates(spark, sf):
    """Gate report of the star build: coverage, orphans and required keys, observed by the jobs that write the facts."""
    from stellate.plans.star import build_star
    _, _, gates = build_star(spark, sf)
    return gates


@register("target_schema_lists", f"""WITH {QC.CAT_SQL}
SELECT table_name, 'other' AS kind, string_agg(column_name, ', ' ORDER BY ordinal_position) AS columns
FROM cat GROUP BY table_name""")
def target_schema_lists(spark, sf):
    """S4 grouped: the Table,Column CSV read back as one ordered column list per target table."""
    path = S.scratch_path(spark, "columns-csv")
    S.write_columns(QC._catalog(spark, sf), path)
    lists = S.target_schema_lists(S.read_target_schema(spark, path))
    return lists.select("table_name", "kind", F.array_join("columns", ", ").alias("columns"))
