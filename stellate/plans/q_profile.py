"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.operators import profile as P
from stellate.operators import sketches as K
from stellate.plans.registry import register
from stellate.plans.schemas import SCHEMAS, TPCH
from stellate.plans.sqlgen import _fam, frequencies_sql, profile_sql, top_values_sql
from stellate.sources import derived as D
from stellate.sources import files as S
from stellate.sources.tables import load_table

PROFILED = tuple(SCHEMAS)
DIGITS = 6  # presentation rounding of floating statistics, same on both sides


def _profile(table):
    def q(spark, sf):
        prof, _ = P.profile_columns(load_table(spark, sf, table), table, digits=DIGITS)
        return prof
    return q


def _top(table):
    def q(spark, sf):
        return P.table_top_values(load_table(spark, sf, table), table)
    return q


for _t in PROFILED:
    register(f"profile_{_t}", profile_sql(_t))(_profile(_t))
    register(f"top_values_{_t}", top_values_sql(_t))(_top(_t))


@register("value_frequencies_lineitem", frequencies_sql("lineitem"))
def value_frequencies_lineitem(spark, sf):
    return P.value_frequencies(load_table(spark, sf, "lineitem"))


# Declared keys of the TPC-H-like tables (the catalog fixture for M4/P14/P15).
DECLARED_PK = [("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"),
               ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
               ("lineitem", "l_orderkey"), ("lineitem", "l_linenumber")]


def _pk_values_sql():
    return ", ".join(f"('{t}', '{c}')" for t, c in DECLARED_PK)


def _profile_all_tpch(spark, sf):
    prof, _, _ = P.profile_many({t: load_table(spark, sf, t) for t in TPCH}, digits=DIGITS)
    return prof


@register("profile_many_tpch", "\nUNION ALL\n".join(profile_sql(t) for t in TPCH))
def profile_many_tpch(spark, sf):
    return _profile_all_tpch(spark, sf)


_SUMMARY_SQL = f"""WITH prof AS ({' UNION ALL '.join(profile_sql(t) for t in TPCH)}),
pk(table_name, column_name) AS (VALUES {_pk_values_sql()}),
pkl AS (SELECT p.table_name, string_agg(p.column_name, ', ' ORDER BY pr.ordinal) AS pks
        FROM pk p JOIN prof pr ON p.table_name = pr.table_name AND p.column_name = pr.column_name
        GROUP BY p.table_name),
q AS (SELECT table_name, ROUND(AVG(null_pct), 2) AS avg_null_pct, MAX(null_pct) AS max_null_pct,
             COALESCE(string_agg(CASE WHEN null_pct > 50 THEN column_name END, ', ' ORDER BY column_name), '')
               AS high_null_columns,
             COUNT(*) AS column_count, MAX(total_rows) AS row_count,
             COALESCE(string_agg(CASE WHEN column_role = 'measure' THEN column_name END, ', ' ORDER BY ordinal), '')
               AS measures,
             COALESCE(string_agg(CASE WHEN column_role = 'dimension' THEN column_name END, ', ' ORDER BY ordinal), '')
               AS dimensions
      FROM prof GROUP BY table_name)
SELECT q.table_name, row_count, column_count, avg_null_pct, max_null_pct, high_null_columns,
       COALESCE(pkl.pks, '') AS primary_keys,
       CASE WHEN pkl.pks IS NOT NULL THEN 'unique by primary key columns ' || pkl.pks
            ELSE 'no explicit primary key; grain unclear' END AS grain,
       measures, dimensions,
       CASE WHEN pkl.pks IS NOT NULL AND avg_null_pct < 10 THEN 'high'
            WHEN pkl.pks IS NOT NULL AND avg_null_pct < 30 THEN 'medium' ELSE 'low' END AS modeling_readiness
FROM q LEFT JOIN pkl ON q.table_name = pkl.table_name"""


@register("table_summary_tpch", _SUMMARY_SQL)
def table_summary_tpch(spark, sf):
    prof = _profile_all_tpch(spark, sf)
    pk = spark.createDataFrame(DECLARED_PK, "table_name string, column_name string")
    s = P.table_summary(prof, pk)
    return s.select("table_name", "row_count", "column_count", "avg_null_pct", "max_null_pct",
                    F.concat_ws(", ", "high_null_columns").alias("high_null_columns"),
                    F.concat_ws(", ", "primary_keys").alias("primary_keys"), "grain",
                    F.concat_ws(", ", "measures").alias("measures"),
                    F.concat_ws(", ", "dimensions").alias("dimensions"), "modeling_readiness")


@register("profile_orders_with_null_column",
          f"WITH {D.ORDERS_NULL_COL_SQL} " + profile_sql("orders").replace("FROM orders", "FROM orders_nc")
          + """ UNION ALL SELECT 'orders' AS table_name, 'o_comment' AS column_name, 7 AS ordinal,
  'STRING' AS data_type, COUNT(*) AS total_rows, COUNT(o_comment) AS non_null_count,
  COUNT(*) - COUNT(o_comment) AS null_count,
  ROUND((COUNT(*) - COUNT(o_comment)) / GREATEST(COUNT(*), 1) * 100.0, 2) AS null_pct,
  COUNT(DISTINCT o_comment) AS distinct_count, NULL::DOUBLE AS min_val, NULL::DOUBLE AS max_val,
  NULL::DOUBLE AS mean_val, NULL::DOUBLE AS stddev_val, NULL::DOUBLE AS p25, NULL::DOUBLE AS median,
  NULL::DOUBLE AS p75, NULL::VARCHAR AS min_date, NULL::VARCHAR AS max_date, NULL::INTEGER AS date_range_days,
  CAST(MIN(length(o_comment)) AS INTEGER) AS min_length, CAST(MAX(length(o_comment)) AS INTEGER) AS max_length,
  round(AVG(length(o_comment)::DOUBLE) * 1e6 + 1e-4) / 1e6 AS avg_length, 'dimension' AS column_role FROM orders_nc""")
def profile_orders_with_null_column(spark, sf):
    prof, _ = P.profile_columns(D.orders_with_null_column(spark, sf), "orders", digits=DIGITS)
    return prof


@register("profile_empty_orders",
          f"WITH {D.EMPTY_ORDERS_SQL} " + profile_sql("orders").replace("FROM orders", "FROM empty_orders"))
def profile_empty_orders(spark, sf):
    prof, _ = P.profile_columns(D.empty_orders(spark, sf), "orders", digits=DIGITS)
    return prof


def _heavy(table):
    def q(spark, sf):
        """P9 for columns of any number of values: candidates from one scan, recounted exactly."""
        return P.heavy_hitters(load_table(spark, sf, table), table)
    return q


for _t in ("lineitem", "events", "documents"):
    register(f"heavy_hitters_{_t}", top_values_sql(_t, threshold=1 << 62))(_heavy(_t))


_QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}
_CLOSE_SQL = ", ".join(f"TRUE AS {q}_close" for q in _QUARTILES)


def _rank_checks(df, quartiles):
    """column_name and, for each quartile of it, whether the shares of values below and up to it enclose its probability
    within 1 %; ``quartiles`` has one row a column."""
    found = [(r["column_name"], q, r[q]) for r in quartiles.select("column_name", *_QUARTILES).collect() for q in _QUARTILES]
    checks = []
    for c, q, v in found:
        if v is not None:
            x = F.col(c).cast("double")
            checks.append(F.struct(F.lit(c).alias("column_name"), F.lit(q).alias("quartile"), F.lit(_QUARTILES[q]).alias("p"),
                                   (x < v).cast("int").alias("below"), (x <= v).cast("int").alias("upto")))
    shares = df.select(F.inline(F.array(*checks))).groupBy("column_name", "quartile", "p").agg(
        F.avg("below").alias("below"), F.avg("upto").alias("upto"))
    close = (F.col("below") <= F.col("p") + 0.01) & (F.col("upto") >= F.col("p") - 0.01)
    return shares.groupBy("column_name").agg(*[F.bool_and(F.when(F.col("quartile") == q, close)).alias(f"{q}_close") for q in _QUARTILES])


def _close_columns():
    return [F.coalesce(F.col(f"{q}_close"), F.lit(True)).alias(f"{q}_close") for q in _QUARTILES]


_APPROX_SQL = "\nUNION ALL\n".join(f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT("{c}") AS non_null_count,
  TRUE AS distinct_close, {_CLOSE_SQL} FROM lineitem""" for c, _ in SCHEMAS["lineitem"])


@register("profile_approx_lineitem", _APPROX_SQL)
def profile_approx_lineitem(spark, sf):
    """P6 + P7: sketch-based distinct counts and quartiles against their bounds: distinct counts within five
    standard deviations of the sketch (25 %), quartiles by rank within 1 %."""
    li = load_table(spark, sf, "lineitem")
    approx, _ = P.profile_columns(li, "lineitem", percentiles="approx", distinct="approx")
    exact = P.distinct_by_digest(li).withColumnRenamed("distinct_count", "exact")
    x = approx.join(exact, "column_name").join(_rank_checks(li, approx), "column_name", "left")
    return x.select("column_name", "total_rows", "non_null_count",
                    (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.25 * F.col("exact")).alias("distinct_close"), *_close_columns())


_INCREMENT_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT("{c}") AS non_null_count, COUNT(*) - COUNT("{c}") AS null_count,
  {f'MIN("{c}"::DOUBLE + 0.0)' if _fam(ty) == "numeric" else 'NULL::DOUBLE'} AS min_val, {f'MAX("{c}"::DOUBLE + 0.0)' if _fam(ty) == "numeric" else 'NULL::DOUBLE'} AS max_val,
  TRUE AS distinct_close, {_CLOSE_SQL} FROM lineitem""" for c, ty in SCHEMAS["lineitem"])


@register("profile_increment_lineitem", _INCREMENT_SQL)
def profile_increment_lineitem(spark, sf):
    """P6 + P7 kept: sketches of the first load (all ship years but the last) and of the last year, stored, the second load
    run twice, then merged; distinct counts within 8 % (five standard errors), quartiles by rank within 1 %."""
    li = load_table(spark, sf, "lineitem")
    year = F.year("l_shipdate")
    last = li.agg(F.max(year)).first()[0]  # one scalar
    root = S.scratch_path(spark, "sketches")
    new = F.coalesce(year == last, F.lit(False))
    K.store_load(root, "base", li.where(~new))
    for _ in range(2):
        K.store_load(root, "increment", li.where(new))
    merged = K.profile_from_sketches(K.merge_sketches(K.stored_sketches(spark, root)))
    exact = P.distinct_by_digest(li).withColumnRenamed("distinct_count", "exact")
    x = merged.join(exact, "column_name").join(_rank_checks(li, merged), "column_name", "left")
    return x.select("column_name", "total_rows", "non_null_count", "null_count", "min_val", "max_val",
                    (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.08 * F.col("exact")).alias("distinct_close"), *_close_columns())


@register("bounded_sample_customer_name",
          "SELECT c_name FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL) "
          "ORDER BY c_name LIMIT 50")
def bounded_sample_customer_name(spark, sf):
    return P.bounded_sample(load_table(spark, sf, "customer"), "c_name", 50)


@register("format_match_effectivedate", f"""WITH {D.MEMBERSHIP_LOG_SQL}
SELECT COUNT(*) AS checked,
       COUNT(*) FILTER (WHERE regexp_full_match(effectivedate, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}')
                        AND try_strptime(effectivedate, '%Y-%m-%d %H:%M:%S') IS NOT NULL) AS matched,
       ROUND(COUNT(*) FILTER (WHERE regexp_full_match(effectivedate, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}')
                        AND try_strptime(effectivedate, '%Y-%m-%d %H:%M:%S') IS NOT NULL) / COUNT(*), 4) AS match_rate
FROM membership_log WHERE effectivedate IS NOT NULL""")
def format_match_effectivedate(spark, sf):
    return P.format_match_rate(D.membership_log(spark, sf), "effectivedate",
                               pattern=r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", fmt="yyyy-MM-dd HH:mm:ss")


_ENRICHED_SQL = """enriched AS (
  SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@register("null_band_enriched_documents", f"""WITH {_ENRICHED_SQL},
prof AS (
  SELECT column_name, ROUND(SUM(CASE WHEN v THEN 0 ELSE 1 END) / GREATEST(COUNT(*), 1) * 100.0, 2) AS null_pct
  FROM (
    SELECT 'doc_id' AS column_name, doc_id IS NOT NULL AS v FROM enriched UNION ALL
    SELECT 'lang', lang IS NOT NULL FROM enriched UNION ALL
    SELECT 'n_chars', n_chars IS NOT NULL FROM enriched UNION ALL
    SELECT 'quality', quality IS NOT NULL FROM enriched UNION ALL
    SELECT 'toxic', toxic IS NOT NULL FROM enriched) x
  GROUP BY column_name)
SELECT 'enriched' AS table_name, column_name, null_pct,
  CASE WHEN null_pct = 0 THEN 'none' WHEN null_pct >= 100 THEN 'all' WHEN null_pct > 50 THEN 'high' ELSE 'some' END
    AS null_band,
  CASE WHEN null_pct = 0 THEN 'keep' WHEN null_pct >= 100 THEN 'constant default'
       WHEN null_pct > 50 THEN 'default and warn' ELSE 'default by type' END AS null_action
FROM prof""")
def null_band_enriched_documents(spark, sf):
    from stellate.operators.facts import enrich
    d = load_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    lab = load_table(spark, sf, "labels")
    e = enrich(d, lab, "doc_id")
    prof, _ = P.profile_columns(e, "enriched", percentiles=None)
    return P.null_band(prof)
