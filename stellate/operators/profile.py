"""Column profiling.

Plan shape (all tables of a call together):

* one wide, distinct-free aggregate per table over every column (counts, min/max/mean/
  stddev, date range, string lengths) - partial + final ``HashAggregate`` with a
  single-row exchange;
* numeric columns: one value-frequency shuffle, range-partitioned by (column, value) and
  checkpointed; distinct counts and exact percentiles (by rank) are read from it;
* other columns: exact distinct counts over 96-bit digests of the values, so whole texts
  are never shuffled;
* top values: only columns with few enough distinct values are stacked again with their
  values; the aggregate combines map-side to at most ``threshold`` rows a column and task.

``distinct="approx"`` replaces the distinct count by HyperLogLog
(``approx_count_distinct``) inside the wide aggregate, with exact counts for the columns
that can qualify for top values; ``percentiles="approx"`` uses ``percentile_approx``
(a bounded sketch per column) instead of the exact ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.types import DATE, NUMERIC, OTHER, STRING, type_family
from stellate.operators.heavy import digest, summaries
from stellate.session import checkpoint_dir

# Fixed values (must equal the reference's profiler defaults).
TOP_LIMIT = 10            # values kept per column
TOP_THRESHOLD = 1000      # only columns with at most this many distinct values
HIGH_NULL_PCT = 50        # a column is "high null" above this percentage
READINESS_HIGH = 10       # PK and avg null % below this -> high
READINESS_MEDIUM = 30     # PK and avg null % below this -> medium
KEY_GRAIN, NO_KEY_GRAIN = "unique by primary key columns ", "no explicit primary key; grain unclear"
# Numeric columns whose lower-cased name is "id" or ends with one of these are dimensions.
DIMENSION_SUFFIXES = ("_id", "_code", "_flag", "_seq", "_order", "_year", "_month", "_day",
                      "_num", "_no")

PROFILE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("non_null_count", T.LongType()),
    T.StructField("null_count", T.LongType()),
    T.StructField("null_pct", T.DoubleType()),
    T.StructField("distinct_count", T.LongType()),
    T.StructField("min_val", T.DoubleType()),
    T.StructField("max_val", T.DoubleType()),
    T.StructField("mean_val", T.DoubleType()),
    T.StructField("stddev_val", T.DoubleType()),
    T.StructField("p25", T.DoubleType()),
    T.StructField("median", T.DoubleType()),
    T.StructField("p75", T.DoubleType()),
    T.StructField("min_date", T.StringType()),
    T.StructField("max_date", T.StringType()),
    T.StructField("date_range_days", T.IntegerType()),
    T.StructField("min_length", T.IntegerType()),
    T.StructField("max_length", T.IntegerType()),
    T.StructField("avg_length", T.DoubleType()),
    T.StructField("column_role", T.StringType()),
])


def finite(c: Column) -> Column:
    """NaN and +-Inf are reported as null."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None)).otherwise(d)


def column_role(name: Column, family: Column) -> Column:
    """Numeric and not id-like -> measure, else dimension."""
    low = F.lower(name)
    id_like = low == F.lit("id")
    for s in DIMENSION_SUFFIXES:
        id_like = id_like | low.endswith(s)
    return F.when((family == F.lit(NUMERIC)) & ~id_like, F.lit("measure")).otherwise(F.lit("dimension"))


def null_pct(null_count: Column, total_rows: Column) -> Column:
    """round(nulls / max(rows, 1) * 100, 2)."""
    return F.round(null_count / F.greatest(total_rows, F.lit(1)) * F.lit(100.0), 2)


def value_text(c: Column, dt: T.DataType) -> Column:
    """C14: value as text; boolean as 'true'/'false'."""
    if isinstance(dt, T.BooleanType):
        return F.when(c, F.lit("true")).otherwise(F.lit("false"))
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(dt, T.BinaryType):
        return F.base64(c)
    return c.cast("string")


def _profilable(df: DataFrame, columns=None):
    cols = columns or df.columns
    return [(i + 1, f.name, f.dataType) for i, f in enumerate(df.schema.fields) if f.name in cols]


_TEXT, _INTEGRAL, _DOUBLE, _FLOAT = 0, 1, 2, 3


def _value_kind(dt: T.DataType) -> int:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return _INTEGRAL
    if isinstance(dt, T.DoubleType):
        return _DOUBLE
    if isinstance(dt, T.FloatType):
        return _FLOAT
    return _TEXT


def value_frequencies(df: DataFrame, columns=None, with_number: bool = False) -> DataFrame:
    """Non-null value counts for all columns at once: (column_name, value, frequency).

    Integral and floating columns are grouped on their typed value (a long or a
    double) and turned into text only after the aggregation, so the shuffle hashes
    numbers instead of formatting every row as a string. Other types are grouped on
    their text; arrays, maps and structs on their JSON text. ``with_number`` keeps
    the numeric value (``num``) for exact percentiles.
    """
    fields = _profilable(df, columns)
    if not fields:
        schema = "column_name string, value string" + (", num double" if with_number else "") + ", frequency bigint"
        return df.sparkSession.createDataFrame([], schema)
    entries = []
    for _, name, dt in fields:
        c = _q(name)
        kind = _value_kind(dt)
        ival = f"CAST({c} AS BIGINT)" if kind == _INTEGRAL else "CAST(NULL AS BIGINT)"
        dval = f"CAST({c} AS DOUBLE)" if kind in (_DOUBLE, _FLOAT) else "CAST(NULL AS DOUBLE)"
        sval = _text_sql(c, dt) if kind == _TEXT else "CAST(NULL AS STRING)"
        entries.append(f"named_struct('column_name', {_s(name)}, '_k', {kind}, '_i', {ival}, '_d', {dval}, "
                       f"'_s', {sval}, '_nn', {c} IS NOT NULL)")
    stacked = df.selectExpr(f"inline(array({', '.join(entries)}))").where(F.col("_nn"))
    g = stacked.groupBy("column_name", "_k", "_i", "_d", "_s").agg(F.count(F.lit(1)).alias("frequency"))
    value = (F.when(F.col("_k") == _INTEGRAL, F.col("_i").cast("string"))
             .when(F.col("_k") == _DOUBLE, F.col("_d").cast("string"))
             .when(F.col("_k") == _FLOAT, F.col("_d").cast("float").cast("string"))
             .otherwise(F.col("_s")))
    out = [F.col("column_name"), value.alias("value")]
    if with_number:
        num = (F.when(F.col("_k") == _INTEGRAL, F.col("_i").cast("double"))
               .when(F.col("_k").isin(_DOUBLE, _FLOAT), F.col("_d"))
               .otherwise(F.col("_s").try_cast("double")))
        numeric_cols = [n for _, n, dt in fields if type_family(dt) == NUMERIC]
        out.append(F.when(F.col("column_name").isin(numeric_cols), num).alias("num"))
    out.append(F.col("frequency"))
    return g.select(*out)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fin(x: str) -> str:
    return f"CASE WHEN isnan({x}) OR abs({x}) = CAST('Infinity' AS DOUBLE) THEN NULL ELSE {x} END"


def _text_sql(c: str, dt: T.DataType) -> str:
    """C14 as SQL text (same rules as ``value_text``)."""
    if isinstance(dt, T.BooleanType):
        return f"CASE WHEN {c} THEN 'true' ELSE 'false' END"
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({c})"
    if isinstance(dt, T.BinaryType):
        return f"base64({c})"
    return f"CAST({c} AS STRING)"


def _stat_sql(name, dt, i, percentiles, approx_distinct):
    """(aggregate SQL list, row SQL) for one column.

    Expressions are SQL text: the whole wide aggregate is one ``selectExpr`` call, so
    building the plan costs one parse on the JVM instead of thousands of small calls.
    """
    c = _q(name)
    fam = type_family(dt)
    aggs = [f"count({c}) AS nn{i}"]
    if approx_distinct:
        aggs.append(f"approx_count_distinct({_text_sql(c, dt)}) AS ad{i}")
    have = set()
    if fam == NUMERIC:
        d = f"CAST({c} AS DOUBLE)"
        aggs += [f"CAST(min({c}) AS DOUBLE) AS mn{i}", f"CAST(max({c}) AS DOUBLE) AS mx{i}",
                 f"avg({d}) AS av{i}", f"stddev_samp({d}) AS sd{i}"]
        have |= {"mn", "mx", "av", "sd"}
        if percentiles == "approx":
            aggs.append(f"CAST(percentile_approx({d}, array(0.25, 0.5, 0.75), 10000) AS ARRAY<DOUBLE>) AS pq{i}")
            have.add("pq")
    elif fam == DATE:
        aggs += [f"min({c}) AS dmn{i}", f"max({c}) AS dmx{i}"]
        have |= {"dmn", "dmx"}
    elif fam == STRING:
        aggs += [f"min(length({c})) AS lmn{i}", f"max(length({c})) AS lmx{i}",
                 f"avg(CAST(length({c}) AS DOUBLE)) AS lav{i}"]
        have |= {"lmn", "lmx", "lav"}

    def g(key, typ, wrap=None):
        if key not in have:
            return f"CAST(NULL AS {typ})"
        return wrap(f"{key}{i}") if wrap else f"{key}{i}"

    def pq(k):
        return _fin(f"pq{i}[{k}]") if "pq" in have else "CAST(NULL AS DOUBLE)"

    fields = [
        ("column_name", _s(name)), ("ordinal", str(i)), ("data_type", _s(dt.simpleString().upper())),
        ("family", _s(fam)), ("non_null_count", f"nn{i}"),
        ("approx_distinct", f"ad{i}" if approx_distinct else "CAST(NULL AS BIGINT)"),
        ("min_val", g("mn", "DOUBLE", _fin)), ("max_val", g("mx", "DOUBLE", _fin)),
        ("mean_val", g("av", "DOUBLE", _fin)), ("stddev_val", g("sd", "DOUBLE", _fin)),
        ("p25", pq(0)), ("median", pq(1)), ("p75", pq(2)),
        ("min_date", g("dmn", "STRING", lambda x: f"CAST({x} AS STRING)")),
        ("max_date", g("dmx", "STRING", lambda x: f"CAST({x} AS STRING)")),
        ("date_range_days", f"datediff(dmx{i}, dmn{i})" if "dmn" in have else "CAST(NULL AS INT)"),
        ("min_length", g("lmn", "INT")), ("max_length", g("lmx", "INT")), ("avg_length", g("lav", "DOUBLE")),
    ]
    row = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields) + ")"
    return aggs, row


def profile_stats(df: DataFrame, percentiles: str | None = "exact", distinct: str = "exact",
                  columns=None) -> DataFrame:
    """One row per column, from a single wide aggregate (one scan)."""
    cols = _profilable(df, columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string")
    aggs, rows = [], []
    for i, n, dt in cols:
        a, r = _stat_sql(n, dt, i, percentiles, distinct == "approx")
        aggs += a
        rows.append(r)
    wide = df.selectExpr("count(1) AS total_rows", *aggs)
    return wide.selectExpr("total_rows", f"inline(array({', '.join(rows)}))")


def distinct_counts(freqs: DataFrame) -> DataFrame:
    """Exact COUNT(DISTINCT) per column from the P8 frequencies (map-side combined)."""
    return freqs.groupBy("column_name").agg(F.count("frequency").alias("distinct_count"))


def distinct_by_digest(df: DataFrame, columns=None) -> DataFrame:
    """Exact distinct counts of columns of any type, (column_name, distinct_count): values are shuffled
    as a 64-bit hash and a CRC of their text, never as text."""
    fields = _profilable(df, columns)
    if not fields:
        return df.sparkSession.createDataFrame([], "column_name string, distinct_count bigint")
    entries = []
    for _, name, dt in fields:
        text = _text_sql(_q(name), dt)
        entries.append(f"named_struct('column_name', {_s(name)}, 'h', xxhash64({text}), "
                       f"'c', crc32(CAST({text} AS BINARY)), '_nn', {_q(name)} IS NOT NULL)")
    stacked = df.selectExpr(f"inline(array({', '.join(entries)}))").where(F.col("_nn"))
    return (stacked.groupBy("column_name", "h", "c").agg(F.lit(1).alias("one"))
            .groupBy("column_name").agg(F.count("one").alias("distinct_count")))


def rank_statistics(freqs: DataFrame, probs=(0.25, 0.5, 0.75), partitions: int | None = None) -> DataFrame:
    """Distinct counts and exact interpolated percentiles (``percentile_cont``) by distributed rank
    selection.

    ``freqs`` is (column_name, value, num, frequency) of numeric columns. Its rows are range-partitioned
    on (column, number) and checkpointed (range bounds come from sampling). Per partition and column the
    frequency total is one small row; cumulative offsets over those rows give every partition's first
    rank. Each wanted rank (lower and upper neighbour of p * (n - 1)) is located in its partition, only
    those partitions are scanned in value order, and the two neighbours are interpolated. No task ever
    holds a whole column. Output: (column_name, distinct_count, p25, median, p75) for the default
    ``probs``.
    """
    spark = freqs.sparkSession
    names = ["p25", "median", "p75"] if tuple(probs) == (0.25, 0.5, 0.75) else [f"p{i}" for i in range(len(probs))]
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = (F.col("num").isNotNull() & ~F.isnan("num")).alias("_ok")
    kept = (freqs.select("column_name", "num", "frequency", ranked).repartitionByRange(n, "column_name", "num")
            .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    r = kept.where("_ok")
    per = r.groupBy("_pid", "column_name").agg(F.sum("frequency").alias("_s"))
    wc = Window.partitionBy("column_name")
    per = per.select("_pid", "column_name", "_s",
                     F.coalesce(F.sum("_s").over(wc.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("_before"),
                     F.sum("_s").over(wc).alias("_n"))
    # wanted ranks (0-based): for each p the lower and upper neighbour of p * (n - 1)
    targets = (per.select("column_name", "_n").distinct()
               .select("column_name", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_k", "_p"),
                       "_n")
               .withColumn("_pos", F.col("_p") * (F.col("_n") - 1))
               .select("column_name", "_k", "_pos",
                       F.explode(F.array(F.floor("_pos").alias("x"), F.ceil("_pos").alias("x"))).alias("_rank"))
               .distinct())
    located = (targets.join(per, "column_name")
               .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_s")))
               .select("column_name", "_k", "_pos", "_rank", "_pid", "_before"))
    wanted = located.select("_pid", "column_name").distinct()
    wl = Window.partitionBy("_pid", "column_name").orderBy("num").rowsBetween(Window.unboundedPreceding, 0)
    scanned = (r.join(F.broadcast(wanted), ["_pid", "column_name"], "left_semi")
               .withColumn("_cum", F.sum("frequency").over(wl)))
    hit = (scanned.join(F.broadcast(located), ["_pid", "column_name"])
           .where((F.col("_rank") >= F.col("_before") + F.col("_cum") - F.col("frequency"))
                  & (F.col("_rank") < F.col("_before") + F.col("_cum")))
           .select("column_name", "_k", "_pos", "_rank", "num"))
    lo_rank, hi_rank = F.floor("_pos"), F.ceil("_pos")
    per_k = (hit.groupBy("column_name", "_k", "_pos")
             .agg(F.max(F.when(F.col("_rank") == lo_rank, F.col("num"))).alias("_lo"),
                  F.max(F.when(F.col("_rank") == hi_rank, F.col("num"))).alias("_hi"))
             .withColumn("_v", F.when(lo_rank == hi_rank, F.col("_lo"))
                         .otherwise((hi_rank - F.col("_pos")) * F.col("_lo") + (F.col("_pos") - lo_rank) * F.col("_hi"))))
    out = per_k.groupBy("column_name").pivot("_k", list(range(len(probs)))).agg(F.first("_v"))
    out = out.select("column_name", *[finite(F.col(str(i))).alias(nm) for i, nm in enumerate(names)])
    return distinct_counts(kept).join(out, "column_name", "left")


def is_dimension_name(name: str) -> bool:
    """Whether a numeric column's name makes it a dimension."""
    low = name.lower()
    return low == "id" or any(low.endswith(s) for s in DIMENSION_SUFFIXES)


def presented(c: Column, digits: int) -> Column:
    """Round for presentation. Exact halves (a mean of few-digit numbers often is one) go up even where the
    last bits of a floating sum fall just short of the half."""
    return F.rint(c * F.lit(10.0 ** digits) + F.lit(1e-4)) / F.lit(10.0 ** digits)


_NO_TOP = "table_name string, column_name string, rank int, value string, frequency bigint"


def _tagged(parts) -> DataFrame | None:
    """Union of (position of the table, DataFrame with column_name): the position leads the name, so that
    one job serves all tables."""
    out = None
    for i, df in parts:
        x = df.withColumn("column_name", F.concat(F.lit(f"{i}:"), F.col("column_name")))
        out = x if out is None else out.unionByName(x)
    return out


def _profile_tables(tables: dict, percentiles, distinct, threshold, limit, digits):
    """(profile, top values) of all tables, with one job for the wide aggregates, one for the numeric
    value frequencies and one for the other distinct counts. What is collected is one row per column."""
    spark = next(iter(tables.values())).sparkSession
    items = [(name, df) for name, df in tables.items() if _profilable(df, None)]
    if not items:
        return spark.createDataFrame([], PROFILE_SCHEMA), spark.createDataFrame([], _NO_TOP)
    wide = _tagged((i, profile_stats(df, percentiles=percentiles, distinct=distinct)) for i, (_, df) in enumerate(items))
    rows = wide.collect()
    stats = spark.createDataFrame(rows, wide.schema)
    family: dict[int, dict[str, str]] = {}
    approx: dict[int, dict[str, int]] = {}
    for r in rows:
        i, name = r["column_name"].split(":", 1)
        family.setdefault(int(i), {})[name] = r["family"]
        approx.setdefault(int(i), {})[name] = r["approx_distinct"]
    ranked = percentiles == "exact" and distinct != "approx"
    counts = []
    if distinct == "approx":
        # the sketch is off by a few percent (5 % standard deviation): columns within twice the limit
        # are counted exactly, so the limit itself is applied to exact counts
        near = {i: [c for c, n in cols.items() if n <= 2 * threshold] for i, cols in approx.items()}
        far = [(f"{i}:{c}", int(n)) for i, cols in approx.items() for c, n in cols.items() if c not in near[i]]
        counts.append(spark.createDataFrame(far, "column_name string, distinct_count bigint"))
    else:
        near = {i: [c for c in cols if not (ranked and family[i][c] == NUMERIC)] for i, cols in family.items()}
    by_digest = _tagged((i, distinct_by_digest(df, near[i])) for i, (_, df) in enumerate(items) if near.get(i))
    if by_digest is not None:
        counts.append(by_digest)
    dc = _union([c.select("column_name", "distinct_count", *[F.lit(None).cast("double").alias(p) for p in ("p25", "median", "p75")])
                 for c in counts]) if counts else None
    if ranked:
        numeric = {i: [c for c, f in cols.items() if f == NUMERIC] for i, cols in family.items()}
        freqs = _tagged((i, value_frequencies(df, numeric[i], with_number=True)) for i, (_, df) in enumerate(items) if numeric.get(i))
        if freqs is not None:
            numbers = rank_statistics(freqs)
            dc = numbers if dc is None else dc.unionByName(numbers)
        stats = stats.drop("p25", "median", "p75")
    else:
        dc = dc.drop("p25", "median", "p75")
    found = dc.collect()  # one row per column
    dc = spark.createDataFrame(found, dc.schema)

    def r(name):
        return presented(F.col(name), digits).alias(name) if digits is not None else F.col(name)
    place, column = F.substring_index("column_name", ":", 1), F.expr("substring(column_name, instr(column_name, ':') + 1)")
    names = F.array(*[F.lit(n) for n, _ in items])
    nulls = F.col("total_rows") - F.col("non_null_count")
    prof = (stats.join(F.broadcast(dc), "column_name", "left")
            .withColumns({"table_name": F.get(names, place.cast("int")), "column_name": column})
            .select(
                "table_name", "column_name", "ordinal", "data_type", "total_rows", "non_null_count",
                nulls.alias("null_count"), null_pct(nulls, F.col("total_rows")).alias("null_pct"),
                F.coalesce(F.col("distinct_count"), F.lit(0)).cast("bigint").alias("distinct_count"),
                "min_val", "max_val", r("mean_val"), r("stddev_val"), r("p25"), r("median"), r("p75"),
                "min_date", "max_date", "date_range_days", "min_length", "max_length", r("avg_length"),
                column_role(F.col("column_name"), F.col("family")).alias("column_role")))
    few: dict[int, list[str]] = {}
    for row in found:
        i, name = row["column_name"].split(":", 1)
        if 0 < row["distinct_count"] <= threshold and family[int(i)][name] != OTHER:
            few.setdefault(int(i), []).append(name)
    tops = [top_values(df, name, few[i], limit) for i, (name, df) in enumerate(items) if i in few]
    return prof, _union(tops) if tops else spark.createDataFrame([], _NO_TOP)


def top_values(df: DataFrame, table_name: str, columns, limit: int) -> DataFrame:
    """P9 + W1: the most frequent values of columns known to have few; ties by value ascending."""
    freqs = value_frequencies(df, columns)
    w = Window.partitionBy("column_name").orderBy(F.col("frequency").desc(), F.col("value").asc())
    return (freqs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
            .select(F.lit(table_name).alias("table_name"), "column_name", "rank", "value", "frequency"))


def profile_columns(df: DataFrame, table_name: str, percentiles: str | None = "exact",
                    distinct: str = "exact", threshold: int = TOP_THRESHOLD,
                    limit: int = TOP_LIMIT, digits: int | None = None):
    """P16 core: (per-column profile, top values).

    ``digits`` rounds the floating statistics (means, deviations, percentiles) for
    presentation; counts, minima and maxima are never rounded.
    """
    return _profile_tables({table_name: df}, percentiles, distinct, threshold, limit, digits)


def profile_light(tables: dict) -> DataFrame:
    """Counts, ranges, lengths and roles of every column of every table, without the
    value-frequency shuffle (no distinct counts, percentiles or top values): one wide
    aggregate per table, all tables in one job. For consumers that need no value-level
    statistics (role inference, table specs)."""
    parts = []
    for name, df in tables.items():
        st = profile_stats(df, percentiles=None)
        if "family" not in st.columns:
            continue
        nulls = F.col("total_rows") - F.col("non_null_count")
        parts.append(st.select(
            F.lit(name).alias("table_name"), "column_name", "ordinal", "data_type", "total_rows", "non_null_count",
            nulls.alias("null_count"), null_pct(nulls, F.col("total_rows")).alias("null_pct"),
            "min_val", "max_val", "min_date", "max_date", "min_length", "max_length",
            column_role(F.col("column_name"), F.col("family")).alias("column_role")))
    return _union(parts)


def table_top_values(df: DataFrame, table_name: str, threshold: int = TOP_THRESHOLD,
                     limit: int = TOP_LIMIT) -> DataFrame:
    """P8-P10 + W1 alone: the top values of a table without the other statistics, in two scans. Summaries of the first scan
    (``heavy``) list all values of a column that has few; those columns are counted exactly in the second, and the
    threshold applies to the values counted there."""
    columns = [f.name for f in df.schema.fields if type_family(f.dataType) != OTHER]
    found = summaries(df, columns, threshold + 1)
    few = [c for c in columns if found[c].whole and found[c].non_null]
    if not few:
        return df.sparkSession.createDataFrame([], _NO_TOP)
    freqs = value_frequencies(df, few)
    values = F.count(F.lit(1)).over(Window.partitionBy("column_name"))
    w = Window.partitionBy("column_name").orderBy(F.col("frequency").desc(), F.col("value").asc())
    return (freqs.withColumns({"values": values, "rank": F.row_number().over(w)})
            .where((F.col("values") <= threshold) & (F.col("rank") <= limit))
            .select(F.lit(table_name).alias("table_name"), "column_name", "rank", "value", "frequency"))


def _leading(freqs: DataFrame, limit: int, slices: int) -> DataFrame:
    """The ``limit`` most frequent values per column, ranked in slices of the values first, so that a column with very many
    values is no single task."""
    order = [F.col("frequency").desc(), F.col("value").asc()]
    part = freqs.withColumn("_s", F.pmod(F.xxhash64("value"), F.lit(slices)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("column_name", "_s").orderBy(*order)))
    return (part.where(F.col("rank") <= limit).withColumn("rank", F.row_number().over(Window.partitionBy("column_name").orderBy(*order)))
            .where(F.col("rank") <= limit).drop("_s"))


def heavy_hitters(df: DataFrame, table_name: str, columns=None, limit: int = TOP_LIMIT, listed: int = 1024, slices: int = 256) -> DataFrame:
    """P9 without a limit on the number of different values: the exact ``limit`` most frequent values of each column, ties by
    value ascending. The first scan lists candidates, the second recounts them. Where the last one's count is above what
    any value outside the list may have, the recount is the answer; the other columns (nearly flat ones) are counted in full.
    The driver holds ``listed`` digests and ``limit`` values a column."""
    columns = [f.name for f in df.schema.fields if type_family(f.dataType) != OTHER and (columns is None or f.name in columns)]
    spark = df.sparkSession
    found = {c: s for c, s in summaries(df, columns, listed).items() if s.non_null}
    if not found:
        return spark.createDataFrame([], _NO_TOP)
    likely = [c for c, s in found.items() if s.digests]
    shown = df.select(*[F.when(digest(c).isin(list(found[c].digests)), F.col(_q(c))).alias(c) for c in likely])
    top = _leading(value_frequencies(shown, likely), limit, slices).collect() if likely else []
    settled = []
    for c in likely:
        mine = [r for r in top if r["column_name"] == c]
        if found[c].whole or (len(mine) == limit and min(r["frequency"] for r in mine) > found[c].bound):
            settled.append(c)
    rows = [(table_name, r["column_name"], r["rank"], r["value"], r["frequency"]) for r in top if r["column_name"] in settled]
    out = spark.createDataFrame(rows, _NO_TOP)
    open_ = [c for c in found if c not in settled]
    if open_:
        rest = _leading(value_frequencies(df, open_), limit, slices)
        out = out.unionByName(rest.select(F.lit(table_name).alias("table_name"), "column_name", "rank", "value", "frequency"))
    return out


def table_quality(profile: DataFrame) -> DataFrame:
    """Avg / max null % per table and the list of columns above 50 %."""
    return (profile.groupBy("table_name").agg(
        F.round(F.avg("null_pct"), 2).alias("avg_null_pct"),
        F.max("null_pct").alias("max_null_pct"),
        F.sort_array(F.collect_list(F.when(F.col("null_pct") > HIGH_NULL_PCT, F.col("column_name"))))
        .alias("high_null_columns"),
        F.count(F.lit(1)).alias("column_count"),
        F.max("total_rows").alias("row_count")))


def table_summary(profile: DataFrame, primary_keys: DataFrame | None = None) -> DataFrame:
    """P12 + P14 + P15 + P13 lists: one row per table.

    ``primary_keys`` holds (table_name, column_name) rows (declared or inferred).
    """
    q = table_quality(profile)
    if primary_keys is None:
        primary_keys = profile.sparkSession.createDataFrame([], "table_name string, column_name string")
    pks = (primary_keys.join(profile.select("table_name", "column_name", "ordinal"),
                             ["table_name", "column_name"], "left")
           .groupBy("table_name")
           .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("ordinal", F.lit(0)), "column_name")))
                .alias("_pk")))
    roles = (profile.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.when(F.col("column_role") == "measure",
                                           F.struct("ordinal", "column_name")))).alias("_m"),
        F.array_sort(F.collect_list(F.when(F.col("column_role") == "dimension",
                                           F.struct("ordinal", "column_name")))).alias("_d")))
    out = q.join(pks, "table_name", "left").join(roles, "table_name", "left")
    pk_list = F.coalesce(F.transform("_pk", lambda s: s["column_name"]), F.array().cast("array<string>"))
    has_pk = F.size(pk_list) > 0
    return out.select(
        "table_name", "row_count", "column_count", "avg_null_pct", "max_null_pct", "high_null_columns",
        pk_list.alias("primary_keys"),
        F.when(has_pk, F.concat(F.lit(KEY_GRAIN), F.concat_ws(", ", pk_list)))
        .otherwise(F.lit(NO_KEY_GRAIN)).alias("grain"),
        F.transform("_m", lambda s: s["column_name"]).alias("measures"),
        F.transform("_d", lambda s: s["column_name"]).alias("dimensions"),
        modeling_readiness(has_pk, F.col("avg_null_pct")).alias("modeling_readiness"))


def modeling_readiness(has_pk: Column, avg_null: Column) -> Column:
    """P14."""
    return (F.when(has_pk & avg_null.isNotNull() & (avg_null < READINESS_HIGH), F.lit("high"))
            .when(has_pk & avg_null.isNotNull() & (avg_null < READINESS_MEDIUM), F.lit("medium"))
            .otherwise(F.lit("low")))


def profile_many(tables: dict, percentiles: str | None = "exact", distinct: str = "exact",
                 digits: int | None = None):
    """Profile every table; a table that fails is reported with its error.

    Returns (profile, top_values, errors). All tables share their jobs; only if a joint job fails is each
    table profiled by itself (its rows computed and kept, one per column), so that a table whose plan or
    rows raise leaves the others profiled.
    """
    spark = next(iter(tables.values())).sparkSession if tables else None
    errs, prof, top = [], None, None
    try:
        if tables:
            prof, top = _profile_tables(tables, percentiles, distinct, TOP_THRESHOLD, TOP_LIMIT, digits)
    except Exception:  # noqa: BLE001 - each table is tried by itself below
        profs, tops = [], []
        for name, df in tables.items():
            try:
                p, t = _profile_tables({name: df}, percentiles, distinct, TOP_THRESHOLD, TOP_LIMIT, digits)
                profs.append(spark.createDataFrame(p.collect(), p.schema))
                tops.append(spark.createDataFrame(t.collect(), t.schema))
            except Exception as e:  # noqa: BLE001 - reported with the table
                errs.append((name, str(e).splitlines()[0][:500]))
        if profs:
            prof, top = _union(profs), _union(tops)
    errors = spark.createDataFrame(errs, "table_name string, error string")
    if prof is None:
        prof, top = spark.createDataFrame([], PROFILE_SCHEMA), spark.createDataFrame([], _NO_TOP)
    return prof, top, errors


def _union(dfs):
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def bounded_sample(df: DataFrame, column: str, n: int = 50) -> DataFrame:
    """First ``n`` distinct values of a column, ordered (a bounded probe; LIMIT is the feature)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(n)


def format_match_rate(df: DataFrame, column: str, pattern: str | None = None,
                      fmt: str | None = None) -> DataFrame:
    """Share of non-null string values matching a regex and/or parsing with a format."""
    c = F.col(column)
    checks = []
    if pattern is not None:
        checks.append(c.rlike(pattern))
    if fmt is not None:
        checks.append(F.try_to_timestamp(c, F.lit(fmt)).isNotNull())
    ok = checks[0]
    for x in checks[1:]:
        ok = ok & x
    return df.where(c.isNotNull()).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(ok).alias("matched"),
        F.round(F.try_divide(F.count_if(ok), F.count(F.lit(1))), 4).alias("match_rate"))


def null_band(profile: DataFrame) -> DataFrame:
    """P20: null band per column and the default action the rules ask for."""
    p = F.col("null_pct")
    band = (F.when(p == 0, F.lit("none")).when(p >= 100, F.lit("all"))
            .when(p > HIGH_NULL_PCT, F.lit("high")).otherwise(F.lit("some")))
    action = (F.when(p == 0, F.lit("keep"))
              .when(p >= 100, F.lit("constant default"))
              .when(p > HIGH_NULL_PCT, F.lit("default and warn"))
              .otherwise(F.lit("default by type")))
    return profile.select("table_name", "column_name", "null_pct", band.alias("null_band"),
                          action.alias("null_action"))
