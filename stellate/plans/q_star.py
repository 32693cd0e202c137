"""Registered cleaning, dimension and fact-load queries (F, C, D, J, L, S9, S10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import clean as C
from stellate.operators import dims as Dm
from stellate.operators import facts as Fa
from stellate.operators import key_registry as R
from stellate.plans.registry import register
from stellate.sources import derived as D
from stellate.sources import files as S
from stellate.sources.tables import load_table

ML = D.MEMBERSHIP_LOG_SQL


def _t(spark, sf, name):
    return load_table(spark, sf, name)


# ------------------------------------------------------------------ F
@register("membership_filters", f"""WITH {ML}
SELECT id, customerid FROM membership_log
WHERE COALESCE(isdeleted, FALSE) = FALSE AND id IS NOT NULL
  AND (meta_record_status IS NULL OR meta_record_status = 'A')""")
def membership_filters(spark, sf):
    """F3 + F4 (NULL status kept) + F5."""
    x = D.membership_log(spark, sf)
    x = C.active_filter(C.require_key(C.soft_delete_filter(x), "id"))
    return x.select("id", "customerid")


@register("membership_filters_strict", f"""WITH {ML}
SELECT id FROM membership_log
WHERE COALESCE(isdeleted, FALSE) = FALSE AND id IS NOT NULL AND meta_record_status = 'A'""")
def membership_filters_strict(spark, sf):
    """F4 with keep_null=False (the written rule)."""
    x = D.membership_log(spark, sf)
    return C.active_filter(C.require_key(C.soft_delete_filter(x), "id"), keep_null=False).select("id")


@register("filter_in_segments", """SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')""")
def filter_in_segments(spark, sf):
    """F6 with a literal list (pushed into the parquet scan)."""
    return C.filter_in(_t(spark, sf, "customer"), "c_mktsegment", ["AUTOMOBILE", "MACHINERY"]).select(
        "c_custkey", "c_mktsegment")


@register("filter_in_semi_join", """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def filter_in_semi_join(spark, sf):
    """F6 with a DataFrame of values (left-semi join)."""
    keys = _t(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return C.filter_in(_t(spark, sf, "orders"), "o_custkey", keys).select("o_orderkey", "o_custkey")


_EMPTY_TARGET = T.StructType([T.StructField("membership_type_key", T.LongType()),
                              T.StructField("membership_amount", T.DecimalType(18, 4)),
                              T.StructField("membership_start_date", T.DateType()),
                              T.StructField("membership_status", T.StringType())])


@register("empty_target_guard", """SELECT CAST(NULL AS BIGINT) AS membership_type_key,
  CAST(NULL AS DECIMAL(18,4)) AS membership_amount, CAST(NULL AS DATE) AS membership_start_date,
  CAST(NULL AS VARCHAR) AS membership_status FROM orders WHERE 1 = 0""")
def empty_target_guard(spark, sf):
    """F7 + S10: unmapped target = typed all-NULL projection of the source, zero rows."""
    src = C.false_guard(_t(spark, sf, "orders"))
    return src.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _EMPTY_TARGET.fields])


@register("rename_hide_customer", """SELECT c_name AS customer_name, c_mktsegment AS market_segment,
  c_acctbal AS account_balance FROM customer""")
def rename_hide_customer(spark, sf):
    """friendly names, technical keys hidden."""
    return C.rename_hide(_t(spark, sf, "customer"),
                         {"c_name": "customer_name", "c_mktsegment": "market_segment", "c_acctbal": "account_balance"},
                         hide=("c_custkey", "c_nationkey"))


# ------------------------------------------------------------------ C
@register("guarded_dates", f"""WITH {ML}
SELECT id,
  CASE WHEN length(trim(effectivedate)) >= 10 THEN TRY_CAST(substring(trim(effectivedate), 1, 10) AS DATE)
       WHEN length(trim(joindate)) >= 10 THEN TRY_CAST(substring(trim(joindate), 1, 10) AS DATE) END AS start_date,
  CASE WHEN length(trim(terminatedate)) >= 10 THEN TRY_CAST(substring(trim(terminatedate), 1, 10) AS DATE) END
    AS grace_date
FROM membership_log""")
def guarded_dates(spark, sf):
    """C7 over every log row."""
    x = D.membership_log(spark, sf)
    return x.select("id", C.guarded_date("effectivedate", "joindate").alias("start_date"),
                    C.guarded_date("terminatedate").alias("grace_date"))


@register("text_to_dates", f"""WITH {ML}
SELECT id, try_strptime(substring(trim(joindate), 1, 10), '%Y-%m-%d')::DATE AS join_date,
       try_strptime(trim(effectivedate), '%Y-%m-%d %H:%M:%S') AS effective_ts
FROM membership_log""")
def text_to_dates(spark, sf):
    """C1 (date format) and C2 (timestamp format); malformed text -> NULL."""
    x = D.membership_log(spark, sf)
    return x.select("id", C.to_date(F.substring(F.trim("joindate"), 1, 10)).alias("join_date"),
                    F.to_timestamp_ntz(C.to_timestamp(F.trim("effectivedate"))).alias("effective_ts"))


@register("numeric_casts", f"""WITH {D.NUMERIC_TEXT_SQL}
SELECT l_orderkey, l_linenumber, TRY_CAST(amount_txt AS DECIMAL(18,4)) AS amount,
       TRY_CAST(amount_txt AS INTEGER) AS amount_int FROM numeric_text""")
def numeric_casts(spark, sf):
    """C3 + C4."""
    x = D.numeric_text(spark, sf)
    return x.select("l_orderkey", "l_linenumber", C.to_money("amount_txt").alias("amount"),
                    C.to_int("amount_txt").alias("amount_int"))


@register("flags_to_bool", f"""WITH {D.FLAGS_SQL}
SELECT l_orderkey, l_linenumber, COALESCE(flag_txt IN ('Y', 'true', '1', 'yes'), FALSE) AS flag FROM flags""")
def flags_to_bool(spark, sf):
    """C5."""
    x = D.flags(spark, sf)
    return x.select("l_orderkey", "l_linenumber", C.flag_to_bool("flag_txt").alias("flag"))


@register("id_to_text", """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, length(CAST(o_orderkey AS VARCHAR)) <= 50
  AS fits FROM orders""")
def id_to_text(spark, sf):
    """Ids as VARCHAR(50) text with the fit check."""
    o = _t(spark, sf, "orders")
    t = C.id_to_text("o_orderkey")
    return o.select(t.alias("order_id"), (F.length(t) <= 50).alias("fits"))


_ENR = """enriched AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@register("null_defaults", f"""WITH {_ENR}
SELECT doc_id, COALESCE(lang, 'Unknown') AS lang, COALESCE(quality, 0) AS quality, COALESCE(toxic, 0) AS toxic
FROM enriched""")
def null_defaults(spark, sf):
    """Defaults by type after a sparse enrichment (about 60 % NULL)."""
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    e = Fa.enrich(d, _t(spark, sf, "labels"), "doc_id")
    return C.fill_defaults(e, ["lang", "quality", "toxic"])


@register("backfill_enriched_labels", f"""WITH {_ENR}
SELECT doc_id, lang, COALESCE(quality, 0) AS quality, COALESCE(toxic, 0) AS toxic FROM enriched""")
def backfill_enriched_labels(spark, sf):
    """NULLs of an existing (written) table replaced by a new version of it."""
    e = Fa.enrich(_t(spark, sf, "documents").select("doc_id", "lang"), _t(spark, sf, "labels"), "doc_id")
    path = S.scratch_path(spark, "enriched")
    S.replace_table(e, path)
    return S.backfill_table(spark, path, ["quality", "toxic"])


@register("all_null_default", f"""WITH {D.ORDERS_NULL_COL_SQL}
SELECT o_orderkey, 'Unknown' AS o_comment, o_orderstatus FROM orders_nc""")
def all_null_default(spark, sf):
    """The profile's null % drives the default (100 % null -> constant)."""
    from stellate.operators.profile import profile_stats
    x = D.orders_with_null_column(spark, sf).select("o_orderkey", "o_comment", "o_orderstatus")
    st = profile_stats(x, percentiles=None).select(
        "column_name", ((F.col("total_rows") - F.col("non_null_count")) * 100.0
                        / F.greatest(F.col("total_rows"), F.lit(1))).alias("p"))
    pcts = {r[0]: r[1] for r in st.collect()}  # one row per column
    out, _ = C.defaults_by_null_band(x, {k: v for k, v in pcts.items() if k != "o_orderkey"})
    return out


@register("code_mapping", """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' ELSE 'other' END
    AS status_label,
  CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank,
  length(o_orderpriority) AS priority_len, lower(replace(o_orderpriority, '-', ' ')) AS priority_text
FROM orders""")
def code_mapping(spark, sf):
    """C11 (CASE over codes), C12 (derived columns), C13 (text ops)."""
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey",
                    C.map_codes("o_orderstatus", {"F": "fulfilled", "O": "open", "P": "partial"}, "other")
                    .alias("status_label"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_rank"),
                    F.length("o_orderpriority").alias("priority_len"),
                    F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit(" "))).alias("priority_text"))


_DIM_PRODUCT = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("product_name", T.StringType()),
                             T.StructField("product_brand", T.StringType()),
                             T.StructField("product_size", T.IntegerType()),
                             T.StructField("product_price", T.DecimalType(18, 4)),
                             T.StructField("product_category", T.StringType())])


@register("cast_to_schema_product", """SELECT p_partkey, p_name AS product_name, p_brand AS product_brand,
  p_size AS product_size, TRY_CAST(p_retailprice AS DECIMAL(18,4)) AS product_price,
  CAST(NULL AS VARCHAR) AS product_category FROM part""")
def cast_to_schema_product(spark, sf):
    """Projection cast to a declared schema; a missing column becomes a typed NULL."""
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_name").alias("product_name"),
                                     F.col("p_brand").alias("product_brand"), F.col("p_size").alias("product_size"),
                                     F.col("p_retailprice").alias("product_price"))
    return C.cast_to_schema(p, _DIM_PRODUCT)


def _path_sql(i):
    return (f"NULLIF(string_split(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '^/', ''),"
            f" '/')[{i}], '') AS page_location_{i}")


@register("web_page_dim", f"""SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) AS page_host,
  {', '.join(_path_sql(i) for i in range(1, 6))} FROM pages""")
def web_page_dim(spark, sf):
    """C17 + C18: host and path levels of each page URL."""
    p = _t(spark, sf, "pages")
    return p.select("page_id", C.url_host("url").alias("page_host"), *C.url_path_levels("url"))


@register("datetime_split", """SELECT event_id, CAST(ts AS DATE) AS event_date, strftime(ts, '%H:%M:%S') AS event_time,
  ts AS event_datetime FROM events""")
def datetime_split(spark, sf):
    """C19 + C15 basis: date, time text and datetime of each event."""
    return _t(spark, sf, "events").select("event_id", *C.split_datetime("ts", "event"))


# ------------------------------------------------------------------ D
_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedupe_latest_lineitem", f"""SELECT {', '.join(_LI_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) x
WHERE rn = 1""")
def dedupe_latest_lineitem(spark, sf):
    """Newest row per (l_orderkey, l_linenumber)."""
    li = _t(spark, sf, "lineitem").select(*_LI_COLS)
    return Dm.dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                            ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                             "l_returnflag", "l_linestatus"])


@register("surrogate_key_orders", """SELECT o_orderkey,
  ROW_NUMBER() OVER (ORDER BY o_orderkey) AS order_key FROM orders""")
def surrogate_key_orders(spark, sf):
    """Dense keys in natural-key order without a single-partition window."""
    return Dm.surrogate_key(_t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "order_key")


@register("stable_surrogate_customer", """WITH old AS (
  SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key FROM customer WHERE c_custkey % 3 <> 0),
new AS (SELECT c_custkey, (SELECT COALESCE(MAX(customer_key), 0) FROM old)
                          + ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key
        FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM old))
SELECT * FROM old UNION ALL SELECT * FROM new""")
def stable_surrogate_customer(spark, sf):
    """D3: keys of the first load stay; the second load appends max + 1, + 2, ..."""
    c = _t(spark, sf, "customer").select("c_custkey")
    first = Dm.surrogate_key(c.where(F.col("c_custkey") % 3 != 0), "c_custkey", "customer_key")
    return Dm.stable_surrogate_key(first.select("c_custkey", "customer_key"), c, "c_custkey", "customer_key")


_YEAR_LOADS = """seen AS (SELECT o_custkey, MIN(year(o_orderdate)) AS y FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)"""


def _year_loads(spark, sf):
    """A registry loaded once for each order year, the first year twice, and its folder."""
    orders = _t(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    years = sorted(r["y"] for r in orders.select("y").distinct().collect())  # one row a load
    root = S.scratch_path(spark, "customer-keys")
    for y in [*years, *years[:1]]:
        keys = R.register_load(root, str(y), orders.where(F.col("y") == y), "o_custkey", "customer_key")
    return root, keys


@register("key_registry_customer", f"""WITH {_YEAR_LOADS}
SELECT o_custkey, ROW_NUMBER() OVER (ORDER BY y, o_custkey) AS customer_key, CAST(y AS VARCHAR) AS load FROM seen""")
def key_registry_customer(spark, sf):
    """D3: customers get keys in the load (order year) that brings them first; the first load is run twice."""
    return _year_loads(spark, sf)[1]


@register("key_registry_checks", f"""WITH {_YEAR_LOADS}
SELECT 'keys' AS "check", COUNT(*) AS found FROM seen UNION ALL SELECT 'blocks', COUNT(DISTINCT y) FROM seen
UNION ALL SELECT 'repeated_naturals', 0 UNION ALL SELECT 'repeated_keys', 0 UNION ALL SELECT 'outside', 0""")
def key_registry_checks(spark, sf):
    """D3: the committed registry has each customer and each key once, every key in the range of its load."""
    return R.verify_registry(spark, _year_loads(spark, sf)[0], "o_custkey", "customer_key")


@register("reuse_surrogate_orders", "SELECT o_orderkey, CAST(o_orderkey AS BIGINT) AS order_key FROM orders")
def reuse_surrogate_orders(spark, sf):
    """A source key already usable as the surrogate is cast to BIGINT."""
    return Dm.reuse_surrogate(_t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "order_key")


def dim_customer_spec():
    return Dm.DimensionSpec(
        name="dim_customer", natural_key=("c_custkey",), key_name="customer_key",
        attributes={"customer_name": "c_name", "market_segment": "c_mktsegment",
                    "account_balance": F.col("c_acctbal").cast("decimal(18,4)"), "c_nationkey": "c_nationkey"},
        foreign_keys=("c_nationkey",))


DIM_CUSTOMER_SQL = """dim_customer AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey,
  COALESCE(c_name, 'Unknown') AS customer_name, COALESCE(c_mktsegment, 'Unknown') AS market_segment,
  COALESCE(CAST(c_acctbal AS DECIMAL(18,4)), 0) AS account_balance, c_nationkey
  FROM (SELECT DISTINCT ON (c_custkey) * FROM customer WHERE c_custkey IS NOT NULL))"""


@register("build_dimension_customer", f"WITH {DIM_CUSTOMER_SQL} SELECT * FROM dim_customer")
def build_dimension_customer(spark, sf):
    """Filters, dedup, defaults, surrogate key, typed projection."""
    return Dm.build_dimension(_t(spark, sf, "customer"), dim_customer_spec())


@register("unknown_member_customer", f"""WITH {D.BENT_CUSTOMER_SQL},
d AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name FROM bent_customer)
SELECT * FROM d UNION ALL SELECT -1, NULL, 'Unknown'""")
def unknown_member_customer(spark, sf):
    """The dimension plus the 'Unknown' member."""
    d = Dm.surrogate_key(D.bent_customer(spark, sf).select("c_custkey", "c_name"), "c_custkey", "customer_key")
    return Dm.unknown_member(d.select("customer_key", "c_custkey", "c_name"), "customer_key", natural_key="c_custkey")


DIM_DATE_SQL = """cal AS (SELECT CAST(d AS DATE) AS full_date FROM (
    SELECT unnest(generate_series((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders),
                                  (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS d)),
dim_date AS (SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
  full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
  CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
  dayname(full_date) AS day_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
  dayofweek(full_date) IN (0, 6) AS is_weekend,
  CAST(year(full_date) * 100 + month(full_date) AS INTEGER) AS month_key FROM cal)"""


def _dim_date(spark, sf):
    return Dm.dim_date_for(_t(spark, sf, "orders"), "o_orderdate")


@register("dim_date", f"WITH {DIM_DATE_SQL} SELECT * FROM dim_date")
def dim_date(spark, sf):
    """Calendar over the order-date range."""
    return _dim_date(spark, sf)


@register("dim_month", f"""WITH {DIM_DATE_SQL}
SELECT month_key, year, quarter, month, month_name, MIN(full_date) AS first_day, MAX(full_date) AS last_day,
       COUNT(*) AS days FROM dim_date GROUP BY ALL""")
def dim_month(spark, sf):
    """D8 (months)."""
    return Dm.dim_month(_dim_date(spark, sf))


@register("dim_year", f"""WITH {DIM_DATE_SQL}
SELECT year, MIN(full_date) AS first_day, MAX(full_date) AS last_day, COUNT(*) AS days FROM dim_date GROUP BY year""")
def dim_year(spark, sf):
    """D8 (years)."""
    return Dm.dim_year(_dim_date(spark, sf))


@register("dim_time", """WITH ev AS (SELECT CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS time_key,
  COUNT(*) AS event_count FROM events GROUP BY 1)
SELECT CAST(range AS INTEGER) AS time_key, CAST(range // 3600 AS INTEGER) AS hour,
  CAST((range % 3600) // 60 AS INTEGER) AS minute, CAST(range % 60 AS INTEGER) AS second,
  lpad(CAST(range // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((range % 3600) // 60 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST(range % 60 AS VARCHAR), 2, '0') AS time_text,
  COALESCE(ev.event_count, 0) AS event_count
FROM range(86400) LEFT JOIN ev ON CAST(range AS INTEGER) = ev.time_key""")
def dim_time(spark, sf):
    """One row per second of the day (a spine built in parallel), with the events
    that fall on each second - the time dimension as the event facts use it."""
    ev = _t(spark, sf, "events")
    per_second = (ev.groupBy((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("int")
                             .alias("time_key")).agg(F.count(F.lit(1)).alias("event_count")))
    return (Dm.dim_time(spark).join(per_second, "time_key", "left")
            .withColumn("event_count", F.coalesce("event_count", F.lit(0)).cast("bigint")))


DIM_GEO_SQL = """dim_geography AS (SELECT ROW_NUMBER() OVER (ORDER BY n_nationkey) AS geography_key, n_nationkey,
  n_name AS country, r_name AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""


@register("dim_geography", f"WITH {DIM_GEO_SQL} SELECT * FROM dim_geography")
def dim_geography(spark, sf):
    """D10."""
    return Dm.dim_geography(_t(spark, sf, "nation"), _t(spark, sf, "region"))


@register("status_dimension_orders", """SELECT ROW_NUMBER() OVER (ORDER BY o_orderstatus, o_orderpriority)
  AS order_status_key, o_orderstatus, o_orderpriority
FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)""")
def status_dimension_orders(spark, sf):
    """Junk dimension of status x priority."""
    return Dm.status_dimension(_t(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "order_status_key")


@register("outrigger_customer_geography", f"""WITH {DIM_CUSTOMER_SQL}, {DIM_GEO_SQL}
SELECT c.customer_key, c.c_custkey, g.geography_key AS customer_geography_key
FROM dim_customer c LEFT JOIN dim_geography g ON c.c_nationkey = g.n_nationkey""")
def outrigger_customer_geography(spark, sf):
    """The customer dimension carries the geography key (dim -> dim lookup)."""
    dc = Dm.build_dimension(_t(spark, sf, "customer"), dim_customer_spec())
    g = Dm.dim_geography(_t(spark, sf, "nation"), _t(spark, sf, "region"))
    x = Fa.lookup_key(dc, g, "c_nationkey", "n_nationkey", "geography_key")
    return x.select("customer_key", "c_custkey", F.col("geography_key").alias("customer_geography_key"))


@register("bridge_customer_product", """WITH c AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey)
  AS customer_key FROM customer),
p AS (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_key FROM part),
pairs AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT c.customer_key, p.product_key FROM pairs LEFT JOIN c ON pairs.o_custkey = c.c_custkey
LEFT JOIN p ON pairs.l_partkey = p.p_partkey""")
def bridge_customer_product(spark, sf):
    """Customer x product bridge through orders and lines."""
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    pairs = o.join(li, o.o_orderkey == li.l_orderkey).select("o_custkey", "l_partkey")
    c = Dm.surrogate_key(_t(spark, sf, "customer").select("c_custkey"), "c_custkey", "customer_key")
    p = Dm.surrogate_key(_t(spark, sf, "part").select("p_partkey"), "p_partkey", "product_key")
    return Dm.build_bridge(pairs, c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "customer_key",
                           p.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "product_key")


@register("role_playing_dates", f"""WITH {DIM_DATE_SQL}
SELECT l_orderkey, l_linenumber, od.date_key AS order_date_key, sd.date_key AS ship_date_key
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN dim_date od ON CAST(o_orderdate AS DATE) = od.full_date
LEFT JOIN dim_date sd ON CAST(l_shipdate AS DATE) = sd.full_date""")
def role_playing_dates(spark, sf):
    """One calendar joined twice, as order date and as ship date."""
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    cal = _dim_date(spark, sf).select("full_date", "date_key")
    x = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("_od"), F.to_date("l_shipdate").alias("_sd"))
    x = Fa.lookup_key(x, cal.withColumnRenamed("date_key", "order_date_key"), "_od", "full_date", "order_date_key")
    x = Fa.lookup_key(x, cal.withColumnRenamed("date_key", "ship_date_key"), "_sd", "full_date", "ship_date_key")
    return x.select("l_orderkey", "l_linenumber", "order_date_key", "ship_date_key")


@register("first_event_flag", """SELECT event_id, user_id,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS is_first FROM events""")
def first_event_flag(spark, sf):
    """First event per user."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    return Dm.first_flag(e, "user_id", "ts", "event_id").select("event_id", "user_id", "is_first")


_CATEGORY = {"click": "engagement", "view": "engagement", "purchase": "commerce", "signup": "commerce",
             "error": "system"}
_CAT_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _CATEGORY.items()) + " ELSE 'other' END"
_BAND_SQL = "CASE WHEN value < 10 THEN 'low' WHEN value < 30 THEN 'mid' ELSE 'high' END"


def _levels(e):
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 30, "mid").otherwise("high")
    return e.select(C.map_codes("event_type", _CATEGORY, "other").alias("activity_level_1"),
                    F.col("event_type").alias("activity_level_2"), band.alias("activity_level_3"))


@register("activity_levels", f"""SELECT ROW_NUMBER() OVER (ORDER BY activity_level_1, activity_level_2,
  activity_level_3) AS activity_key, * FROM (SELECT DISTINCT {_CAT_SQL} AS activity_level_1,
  event_type AS activity_level_2, {_BAND_SQL} AS activity_level_3 FROM events)""")
def activity_levels(spark, sf):
    """Three-level activity hierarchy."""
    return Dm.activity_levels(_levels(_t(spark, sf, "events")),
                              ["activity_level_1", "activity_level_2", "activity_level_3"])


# ------------------------------------------------------------------ J
def _dim_cust_bent(spark, sf):
    return Dm.surrogate_key(D.bent_customer(spark, sf).select("c_custkey", "c_name", "c_mktsegment"),
                            "c_custkey", "customer_key")


BENT_DIM_SQL = f"""{D.BENT_CUSTOMER_SQL},
pd AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name, c_mktsegment
  FROM bent_customer)"""


@register("lookup_key_orders", f"""WITH {BENT_DIM_SQL}
SELECT o_orderkey, customer_key FROM orders LEFT JOIN pd ON o_custkey = c_custkey""")
def lookup_key_orders(spark, sf):
    """LEFT lookup; orders of missing customers keep a NULL key."""
    x = Fa.lookup_key(_t(spark, sf, "orders"), _dim_cust_bent(spark, sf), "o_custkey", "c_custkey", "customer_key")
    return x.select("o_orderkey", "customer_key")


@register("required_lookup_orders", f"""WITH {BENT_DIM_SQL}
SELECT o_orderkey, customer_key FROM orders JOIN pd ON o_custkey = c_custkey""")
def required_lookup_orders(spark, sf):
    """INNER lookup where a missing dimension row makes the fact invalid."""
    x = Fa.lookup_key(_t(spark, sf, "orders"), _dim_cust_bent(spark, sf), "o_custkey", "c_custkey",
                      "customer_key", required=True)
    return x.select("o_orderkey", "customer_key")


@register("attribute_lookup_orders", f"""WITH {BENT_DIM_SQL}
SELECT o_orderkey, customer_key, c_name, c_mktsegment FROM orders LEFT JOIN pd ON o_custkey = c_custkey""")
def attribute_lookup_orders(spark, sf):
    """Raw id -> descriptive attributes."""
    x = Fa.lookup_key(_t(spark, sf, "orders"), _dim_cust_bent(spark, sf), "o_custkey", "c_custkey",
                      "customer_key", attributes=("c_name", "c_mktsegment"))
    return x.select("o_orderkey", "customer_key", "c_name", "c_mktsegment")


@register("enrich_documents_labels", """SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def enrich_documents_labels(spark, sf):
    """Sparse secondary source LEFT joined."""
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    return Fa.enrich(d, _t(spark, sf, "labels"), "doc_id")


@register("fan_out_guard_customer", f"""WITH {D.REPEATED_CUSTOMER_SQL},
j AS (SELECT o.o_orderkey FROM orders o LEFT JOIN repeated_customer c ON o.o_custkey = c.c_custkey)
SELECT (SELECT COUNT(*) FROM orders) AS rows_before, (SELECT COUNT(*) FROM j) AS rows_after,
  (SELECT COUNT(*) FROM (SELECT c_custkey FROM repeated_customer GROUP BY c_custkey HAVING COUNT(*) > 1))
    AS duplicate_keys,
  (SELECT COUNT(*) FROM orders) = (SELECT COUNT(*) FROM j) AS ok""")
def fan_out_guard_customer(spark, sf):
    """A repeated lookup key multiplies fact rows; the guard reports it."""
    return Fa.fan_out_guard(_t(spark, sf, "orders"), D.repeated_customer(spark, sf), "o_custkey", "c_custkey")


def _dim_product(spark, sf):
    return Dm.surrogate_key(_t(spark, sf, "part").select("p_partkey"), "p_partkey", "product_key")


def _dim_company(spark, sf):
    return Dm.surrogate_key(_t(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", "company_key")


def _dim_order(spark, sf):
    return Dm.surrogate_key(_t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "order_key")


KEYS_SQL = """dp AS (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_key FROM part),
dco AS (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS company_key FROM supplier),
dor AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS order_key FROM orders)"""


@register("lookup_all_lines", f"""WITH {KEYS_SQL}
SELECT l_orderkey, l_linenumber, product_key, company_key, order_key FROM lineitem
LEFT JOIN dp ON l_partkey = p_partkey LEFT JOIN dco ON l_suppkey = s_suppkey LEFT JOIN dor ON l_orderkey = o_orderkey""")
def lookup_all_lines(spark, sf):
    """Every relation of the line fact resolved in turn."""
    li = _t(spark, sf, "lineitem")
    x = Fa.lookup_all(li, [(_dim_product(spark, sf), "l_partkey", "p_partkey", "product_key"),
                           (_dim_company(spark, sf), "l_suppkey", "s_suppkey", "company_key"),
                           (_dim_order(spark, sf), "l_orderkey", "o_orderkey", "order_key")])
    return x.select("l_orderkey", "l_linenumber", "product_key", "company_key", "order_key")


# ------------------------------------------------------------------ L
def _membership_sql(prefix, first_keys, last_key, extra=""):
    return f"""WITH {ML}, {D.MEMBERSHIP_PRODUCT_SQL}
SELECT CAST(1 AS DECIMAL(18,4)) AS {prefix}_quantity, CAST(0 AS DECIMAL(18,4)) AS {prefix}_amount,
  CASE WHEN length(trim(s1.effectivedate)) >= 10 THEN TRY_CAST(substring(trim(s1.effectivedate), 1, 10) AS DATE)
       WHEN length(trim(s1.joindate)) >= 10 THEN TRY_CAST(substring(trim(s1.joindate), 1, 10) AS DATE)
  END AS {prefix}_start_date,
  CASE WHEN length(trim(s1.expiredate)) >= 10 THEN TRY_CAST(substring(trim(s1.expiredate), 1, 10) AS DATE)
  END AS {prefix}_end_date,
  CASE WHEN length(trim(s1.terminatedate)) >= 10 THEN TRY_CAST(substring(trim(s1.terminatedate), 1, 10) AS DATE)
  END AS {prefix}_grace_date,
  {", ".join(f"CAST(NULL AS BIGINT) AS {k}" for k in (*first_keys, "individual_key", "company_key", "geography_key", last_key))}
FROM membership_log s1 LEFT JOIN membership_product s2 ON s1.membershipproductid = s2.id
WHERE COALESCE(s1.isdeleted, FALSE) = FALSE AND s1.id IS NOT NULL
  AND (s1.meta_record_status IS NULL OR s1.meta_record_status = 'A') {extra}"""


@register("fact_memberships", _membership_sql("membership", ("membership_type_key", "product_key"), "memberships_key"))
def fact_memberships(spark, sf):
    """L2 (+ L1, C7, F2-F5, J3): the membership-term fact load."""
    return Fa.membership_term_fact(D.membership_log(spark, sf), D.membership_product(spark, sf))


@register("fact_chapter_memberships", _membership_sql(
    "chapter_membership", ("chapter_key",), "chapter_memberships_key", "AND COALESCE(s2.ischapter, FALSE) = TRUE"))
def fact_chapter_memberships(spark, sf):
    """L3: same load with its own predicate: only terms whose product is a chapter product."""
    return Fa.chapter_membership_fact(D.membership_log(spark, sf), D.membership_product(spark, sf))


@register("fact_sales_lines", f"""WITH {KEYS_SQL}, {DIM_DATE_SQL}
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,4)) AS sales_quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))) AS DECIMAL(18,4))
    AS sales_amount,
  CAST(l_shipdate AS DATE) AS ship_date, sd.date_key AS ship_date_key, product_key, company_key, order_key
FROM lineitem LEFT JOIN dp ON l_partkey = p_partkey LEFT JOIN dco ON l_suppkey = s_suppkey
LEFT JOIN dor ON l_orderkey = o_orderkey LEFT JOIN dim_date sd ON CAST(l_shipdate AS DATE) = sd.full_date""")
def fact_sales_lines(spark, sf):
    """L4 (lines): quantity, net amount, ship date and product/company/order/date keys."""
    li = _t(spark, sf, "lineitem").withColumn("_sd", F.to_date("l_shipdate"))
    cal = _dim_date(spark, sf).select("full_date", F.col("date_key").alias("ship_date_key"))
    spec = Fa.FactSpec(
        name="fact_sales_lines",
        columns={"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
                 "sales_quantity": F.col("l_quantity").cast("decimal(18,4)"),
                 "sales_amount": (F.col("l_extendedprice").cast("decimal(18,4)")
                                  * (F.lit(1) - F.col("l_discount").cast("decimal(18,4)"))).cast("decimal(18,4)"),
                 "ship_date": F.col("_sd"), "ship_date_key": "ship_date_key",
                 "product_key": "product_key", "company_key": "company_key", "order_key": "order_key"},
        lookups=((_dim_product(spark, sf), "l_partkey", "p_partkey", "product_key"),
                 (_dim_company(spark, sf), "l_suppkey", "s_suppkey", "company_key"),
                 (_dim_order(spark, sf), "l_orderkey", "o_orderkey", "order_key"),
                 (cal, "_sd", "full_date", "ship_date_key")))
    return Fa.load_fact(li, spec)


@register("fact_sales_orders", f"""WITH {DIM_CUSTOMER_SQL}, {DIM_GEO_SQL}, {DIM_DATE_SQL}
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) AS order_amount, CAST(o_orderdate AS DATE) AS order_date,
  od.date_key AS order_date_key, c.customer_key, g.geography_key
FROM orders LEFT JOIN dim_customer c ON o_custkey = c.c_custkey
LEFT JOIN dim_geography g ON c.c_nationkey = g.n_nationkey
LEFT JOIN dim_date od ON CAST(o_orderdate AS DATE) = od.full_date""")
def fact_sales_orders(spark, sf):
    """L4 (orders): amount, order date and customer/geography/date keys."""
    o = _t(spark, sf, "orders").withColumn("_od", F.to_date("o_orderdate"))
    dc = Dm.build_dimension(_t(spark, sf, "customer"), dim_customer_spec())
    g = Dm.dim_geography(_t(spark, sf, "nation"), _t(spark, sf, "region"))
    dcg = Fa.lookup_key(dc, g, "c_nationkey", "n_nationkey", "geography_key").select(
        "c_custkey", "customer_key", "geography_key")
    cal = _dim_date(spark, sf).select("full_date", F.col("date_key").alias("order_date_key"))
    x = Fa.lookup_key(o, dcg, "o_custkey", "c_custkey", "customer_key", attributes=("geography_key",))
    x = Fa.lookup_key(x, cal, "_od", "full_date", "order_date_key")
    return x.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,4)").alias("order_amount"),
                    F.col("_od").alias("order_date"), "order_date_key", "customer_key", "geography_key")


_CUST_KEY_SQL = "dcu AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS individual_key FROM customer)"


def _dim_individual(spark, sf):
    return Dm.surrogate_key(_t(spark, sf, "customer").select("c_custkey"), "c_custkey", "individual_key")


@register("fact_activities", f"""WITH {_CUST_KEY_SQL}
SELECT event_id, event_type, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS event_date_key,
  CAST(ts AS DATE) AS event_date, strftime(ts, '%H:%M:%S') AS event_time, individual_key
FROM events LEFT JOIN dcu ON user_id = c_custkey WHERE event_type IN ('click', 'view', 'error')""")
def fact_activities(spark, sf):
    """One row per activity event with date, time and individual keys."""
    e = _t(spark, sf, "events").where(F.col("event_type").isin("click", "view", "error"))
    x = Fa.lookup_key(e, _dim_individual(spark, sf), "user_id", "c_custkey", "individual_key")
    return x.select("event_id", "event_type", C.date_key("ts").alias("event_date_key"), F.to_date("ts").alias("event_date"),
                    F.date_format("ts", "HH:mm:ss").alias("event_time"), "individual_key")


# Keys of the event facts come from the customer: the individual and, through the nation, the geography.
_EVENT_KEYS_SQL = f"""{_CUST_KEY_SQL}, {DIM_GEO_SQL},
dig AS (SELECT c.c_custkey, d.individual_key, g.geography_key FROM customer c JOIN dcu d ON c.c_custkey = d.c_custkey
  LEFT JOIN dim_geography g ON c.c_nationkey = g.n_nationkey),
reg AS (SELECT user_id, MIN(CAST(ts AS DATE)) AS first_registration, MIN(event_id) AS registration_key
  FROM events WHERE event_type = 'signup' GROUP BY user_id)"""


def _event_keys(spark, sf):
    c = Dm.surrogate_key(_t(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey", "individual_key")
    g = Dm.dim_geography(_t(spark, sf, "nation"), _t(spark, sf, "region"))
    return Fa.lookup_key(c, g, "c_nationkey", "n_nationkey", "geography_key").select(
        "c_custkey", "individual_key", "geography_key")


@register("fact_registrations", f"""WITH {_EVENT_KEYS_SQL}
SELECT CAST(1 AS DECIMAL(18,4)) AS registration_quantity, CAST(value AS DECIMAL(18,4)) AS registration_amount,
  CAST(NULL AS DECIMAL(18,4)) AS event_distance, CAST(ts AS DATE) AS event_registration_date,
  CAST(NULL AS DATE) AS event_start_date, CAST(NULL AS BIGINT) AS event_key, CAST(NULL AS BIGINT) AS product_key,
  individual_key, CAST(NULL AS BIGINT) AS company_key, geography_key, CAST(NULL AS BIGINT) AS event_geography_key,
  CAST(event_id AS BIGINT) AS event_registrations_key
FROM events LEFT JOIN dig ON user_id = c_custkey WHERE event_type = 'signup'""")
def fact_registrations(spark, sf):
    """L11 (registrations): signup events in the declared target's columns; what no source resolves is a
    typed NULL."""
    e = _t(spark, sf, "events").where(F.col("event_type") == "signup")
    return Fa.load_fact(e, Fa.FactSpec(
        name="fact_event_registrations",
        columns={"registration_quantity": C.typed_const(1, "decimal(18,4)"),
                 "registration_amount": F.col("value").cast("decimal(18,4)"),
                 "event_distance": C.typed_null("decimal(18,4)"),
                 "event_registration_date": F.to_date("ts"), "event_start_date": C.typed_null("date"),
                 "event_key": C.typed_null("bigint"), "product_key": C.typed_null("bigint"),
                 "individual_key": "individual_key", "company_key": C.typed_null("bigint"),
                 "geography_key": "geography_key", "event_geography_key": C.typed_null("bigint"),
                 "event_registrations_key": F.col("event_id").cast("bigint")},
        enrich=((_event_keys(spark, sf), F.col("user_id") == F.col("c_custkey")),)))


@register("fact_purchases", f"""WITH {_EVENT_KEYS_SQL}
SELECT CAST(1 AS DECIMAL(18,4)) AS purchase_quantity, CAST(value AS DECIMAL(18,4)) AS purchase_amount,
  CAST(ts AS DATE) AS purchase_date, first_registration AS event_registration_date,
  CAST(NULL AS DECIMAL(18,4)) AS event_distance, CAST(NULL AS BIGINT) AS event_key, CAST(NULL AS BIGINT) AS product_key,
  individual_key, CAST(NULL AS BIGINT) AS company_key, geography_key, CAST(NULL AS BIGINT) AS event_geography_key,
  CAST(registration_key AS BIGINT) AS event_registration_key, CAST(NULL AS BIGINT) AS event_sessions_key
FROM events e LEFT JOIN dig ON e.user_id = c_custkey LEFT JOIN reg r ON e.user_id = r.user_id WHERE event_type = 'purchase'""")
def fact_purchases(spark, sf):
    """L11 (purchases): purchase events with the user's first registration, in the declared target's columns."""
    e = _t(spark, sf, "events")
    reg = (e.where(F.col("event_type") == "signup").groupBy(F.col("user_id").alias("_user"))
           .agg(F.min(F.to_date("ts")).alias("first_registration"), F.min("event_id").alias("registration_key")))
    return Fa.load_fact(e, Fa.FactSpec(
        name="fact_event_purchases", predicate=F.col("event_type") == "purchase",
        columns={"purchase_quantity": C.typed_const(1, "decimal(18,4)"),
                 "purchase_amount": F.col("value").cast("decimal(18,4)"), "purchase_date": F.to_date("ts"),
                 "event_registration_date": "first_registration", "event_distance": C.typed_null("decimal(18,4)"),
                 "event_key": C.typed_null("bigint"), "product_key": C.typed_null("bigint"),
                 "individual_key": "individual_key", "company_key": C.typed_null("bigint"),
                 "geography_key": "geography_key", "event_geography_key": C.typed_null("bigint"),
                 "event_registration_key": F.col("registration_key").cast("bigint"),
                 "event_sessions_key": C.typed_null("bigint")},
        enrich=((_event_keys(spark, sf), F.col("user_id") == F.col("c_custkey")), (reg, F.col("user_id") == F.col("_user")))))


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@register("event_summary_by_user", "SELECT user_id, " + ", ".join(
    f"COUNT(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in EVENT_TYPES) + " FROM events GROUP BY user_id")
def event_summary_by_user(spark, sf):
    """Per-entity counts of each event type (pivot)."""
    return Fa.pivot_counts(_t(spark, sf, "events"), "user_id", "event_type", EVENT_TYPES)


@register("discussion_rollup", """SELECT conv_id, COUNT(*) AS post_count, MIN(turn) AS first_turn,
  MAX(turn) AS last_turn, COUNT(DISTINCT role) AS participant_roles FROM conversations GROUP BY conv_id""")
def discussion_rollup(spark, sf):
    """L7."""
    return Fa.discussion_rollup(_t(spark, sf, "conversations"))


@register("discussion_posts", """SELECT conv_id, turn, role, length(text) AS post_length,
  ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS is_opening_post FROM conversations""")
def discussion_posts(spark, sf):
    """L8 (posts): one row per post, with the opening-post flag (D15 by turn)."""
    c = _t(spark, sf, "conversations")
    x = Dm.first_flag(c, "conv_id", "turn", "turn", "is_opening_post")
    return x.select("conv_id", "turn", "role", F.length("text").alias("post_length"), "is_opening_post")


@register("discussion_memberships", "SELECT DISTINCT conv_id, role FROM conversations")
def discussion_memberships(spark, sf):
    """L8 (memberships): one row per member role x discussion."""
    return _t(spark, sf, "conversations").select("conv_id", "role").distinct()


_SESS_SQL = """ev AS (SELECT event_id, user_id, ts, event_type,
  LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts,
  LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events),
s AS (SELECT *, SUM(CASE WHEN prev_ts IS NULL OR epoch(ts) - epoch(prev_ts) > 1800 THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
  FROM ev)"""


@register("fact_web_sessions", f"""WITH {_SESS_SQL}
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, CAST(MIN(ts) AS DATE) AS session_start_date,
  strftime(MIN(ts), '%H:%M:%S') AS session_start_time, MIN(ts) AS session_start,
  ROUND(epoch(MAX(ts)) - epoch(MIN(ts)), 3) AS session_duration_seconds, COUNT(*) AS event_count
FROM s GROUP BY user_id, session_no""")
def fact_web_sessions(spark, sf):
    """30-minute-gap sessions per user."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return Fa.web_sessions(e)


@register("fact_web_pageviews", f"""WITH {_SESS_SQL}
SELECT event_id, user_id, CAST(session_no AS BIGINT) AS session_no, ts,
  CAST(ROW_NUMBER() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS BIGINT) AS sequence_in_session,
  CASE WHEN next_ts IS NOT NULL AND epoch(next_ts) - epoch(ts) <= 1800 THEN ROUND(epoch(next_ts) - epoch(ts), 3)
  END AS view_duration_seconds, event_type
FROM s""")
def fact_web_pageviews(spark, sf):
    """Position in session and time to the next view."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return Fa.page_views(e)


_LINE_KEYS_SQL = """dp AS (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_key FROM part),
dco AS (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS company_key FROM supplier)"""


@register("fact_event_sessions", f"""WITH {_EVENT_KEYS_SQL}, {_SESS_SQL.replace("event_type,", "event_type, value,", 1)},
de AS (SELECT event_type, ROW_NUMBER() OVER (ORDER BY event_type) AS event_key FROM (SELECT DISTINCT event_type FROM events)),
se AS (SELECT user_id, session_no, MIN(ts) AS session_start, MAX(ts) AS session_end, arg_min(event_id, (ts, event_id)) AS session_key,
  arg_min(event_type, (ts, event_id)) AS opening, SUM(CAST(value AS DECIMAL(18,4))) AS session_amount,
  MIN(CASE WHEN event_type = 'signup' THEN ts END) AS session_registration FROM s GROUP BY user_id, session_no),
made AS (SELECT user_id, ts AS registered_at, MAX(event_id) AS registration_event FROM events WHERE event_type = 'signup' GROUP BY user_id, ts)
SELECT CAST(session_amount AS DECIMAL(18,4)) AS session_amount, CAST(NULL AS DECIMAL(18,4)) AS event_distance,
  CAST(registered_at AS DATE) AS event_registration_date, CAST(session_registration AS DATE) AS session_registration_date,
  CAST(session_start AS DATE) AS session_start_date, CAST(session_end AS DATE) AS session_end_date,
  strftime(session_start, '%H:%M:%S') AS session_start_time, strftime(session_end, '%H:%M:%S') AS session_end_time,
  CAST(session_key AS BIGINT) AS session_key, event_key, CAST(NULL AS BIGINT) AS product_key, CAST(NULL AS BIGINT) AS location_key,
  individual_key, CAST(NULL AS BIGINT) AS company_key, geography_key, CAST(NULL AS BIGINT) AS event_geography_key,
  CAST(registration_event AS BIGINT) AS event_registration_key, ROW_NUMBER() OVER (ORDER BY session_key) AS event_sessions_key
FROM se ASOF LEFT JOIN made ON se.user_id = made.user_id AND se.session_start >= made.registered_at
LEFT JOIN dig ON se.user_id = c_custkey LEFT JOIN de ON opening = event_type""")
def fact_event_sessions(spark, sf):
    """L11 (sessions): one row per session in the 18 columns of the declared target, under the user's latest
    registration at or before its start; the event key is that of the opening event's kind, the sessions key dense."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    found = Dm.surrogate_key(Fa.event_sessions(e, "signup"), "opening_event", "event_sessions_key")
    return Fa.load_fact(found, Fa.FactSpec(
        name="fact_event_sessions",
        columns={"session_amount": F.col("session_amount").cast("decimal(18,4)"), "event_distance": C.typed_null("decimal(18,4)"),
                 "event_registration_date": F.to_date("registered_at"), "session_registration_date": F.to_date("session_registration"),
                 "session_start_date": F.to_date("session_start"), "session_end_date": F.to_date("session_end"),
                 "session_start_time": F.date_format("session_start", "HH:mm:ss"), "session_end_time": F.date_format("session_end", "HH:mm:ss"),
                 "session_key": F.col("opening_event").cast("bigint"), "event_key": "event_key", "product_key": C.typed_null("bigint"),
                 "location_key": C.typed_null("bigint"), "individual_key": "individual_key", "company_key": C.typed_null("bigint"),
                 "geography_key": "geography_key", "event_geography_key": C.typed_null("bigint"),
                 "event_registration_key": F.col("registration_event").cast("bigint"), "event_sessions_key": "event_sessions_key"},
        enrich=((_event_keys(spark, sf), F.col("session_user") == F.col("c_custkey")),),
        lookups=((Dm.status_dimension(e, ["event_type"], "event_key"), "opening_kind", "event_type", "event_key"),)))


@register("fact_sponsorships", f"""WITH {_LINE_KEYS_SQL}
SELECT CAST(l_quantity AS DECIMAL(18,4)) AS sponsorship_quanity, CAST(l_extendedprice AS DECIMAL(18,4)) AS sponsorship_amount,
  CAST(l_shipdate AS DATE) AS sponsorship_purchase_date, CAST(l_shipdate AS DATE) AS sponsorship_start_date,
  CAST(CAST(l_shipdate AS DATE) + INTERVAL 365 DAY AS DATE) AS sponsorship_end_date, product_key,
  company_key AS sponsor_key, CAST(NULL AS BIGINT) AS sponsorships_key
FROM lineitem LEFT JOIN dp ON l_partkey = p_partkey LEFT JOIN dco ON l_suppkey = s_suppkey""")
def fact_sponsorships(spark, sf):
    """Quantity, amount, dates and keys in the declared target's columns (names kept verbatim)."""
    start = F.to_date("l_shipdate")
    return Fa.load_fact(_t(spark, sf, "lineitem"), Fa.FactSpec(
        name="fact_sponsorships",
        columns={"sponsorship_quanity": F.col("l_quantity").cast("decimal(18,4)"),
                 "sponsorship_amount": F.col("l_extendedprice").cast("decimal(18,4)"),
                 "sponsorship_purchase_date": F.to_date("l_shipdate"), "sponsorship_start_date": start,
                 "sponsorship_end_date": F.date_add(start, 365), "product_key": "product_key",
                 "sponsor_key": "company_key", "sponsorships_key": C.typed_null("bigint")},
        lookups=((_dim_product(spark, sf), "l_partkey", "p_partkey", "product_key"),
                 (_dim_company(spark, sf), "l_suppkey", "s_suppkey", "company_key"))))


@register("fact_event_exhibits", f"""WITH {_LINE_KEYS_SQL}
SELECT CAST(l_quantity AS DECIMAL(18,4)) AS event_exhibit_quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS event_exhibit_amount,
  CAST(l_shipdate AS DATE) AS event_exhibit_date, CAST(l_shipdate AS DATE) AS event_start_date,
  CAST(NULL AS BIGINT) AS event_key, product_key, CAST(l_orderkey AS BIGINT) AS event_exhibit_key,
  company_key AS exhibitor_key, CAST(NULL AS BIGINT) AS event_exhibits_key
FROM lineitem LEFT JOIN dp ON l_partkey = p_partkey LEFT JOIN dco ON l_suppkey = s_suppkey""")
def fact_event_exhibits(spark, sf):
    """L12 (exhibits): the exhibit fact with its exhibitor and product keys."""
    return Fa.load_fact(_t(spark, sf, "lineitem"), Fa.FactSpec(
        name="fact_event_exhibits",
        columns={"event_exhibit_quantity": F.col("l_quantity").cast("decimal(18,4)"),
                 "event_exhibit_amount": F.col("l_extendedprice").cast("decimal(18,4)"),
                 "event_exhibit_date": F.to_date("l_shipdate"), "event_start_date": F.to_date("l_shipdate"),
                 "event_key": C.typed_null("bigint"), "product_key": "product_key",
                 "event_exhibit_key": F.col("l_orderkey").cast("bigint"), "exhibitor_key": "company_key",
                 "event_exhibits_key": C.typed_null("bigint")},
        lookups=((_dim_product(spark, sf), "l_partkey", "p_partkey", "product_key"),
                 (_dim_company(spark, sf), "l_suppkey", "s_suppkey", "company_key"))))


@register("customer_geography_null_nation", f"""WITH {DIM_GEO_SQL},
c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer)
SELECT c_custkey, c.c_nationkey, geography_key FROM c LEFT JOIN dim_geography g ON c.c_nationkey = g.n_nationkey""")
def customer_geography_null_nation(spark, sf):
    """D5 + D12: a missing nation stays NULL and resolves to no geography."""
    c = _t(spark, sf, "customer").withColumn("c_nationkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")))
    dim = Dm.build_dimension(c, dim_customer_spec())
    g = Dm.dim_geography(_t(spark, sf, "nation"), _t(spark, sf, "region"))
    return Fa.lookup_key(dim, g, "c_nationkey", "n_nationkey", "geography_key").select(
        "c_custkey", "c_nationkey", "geography_key")
