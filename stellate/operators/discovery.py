"""Key, role and relationship discovery.

Name-based rules (K5-K11) run on the catalog DataFrame. Data evidence (K1-K4, K15)
runs on the tables: every table is scanned once, its candidate columns stacked as
``(column, value)`` and de-duplicated with a map-side partial aggregate; grouping by
value then tells which sets of columns share how many values (``value_sets``), and all
key and inclusion questions are sums over that catalog-sized result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.functions.types import DATE, STRING, type_family
from stellate.operators.catalog import name_stem
from stellate.session import checkpoint_dir

# Column-name endings that mark a shared join key.
KEY_SUFFIXES = ("_id", "_key", "_code", "_num")
_MASK = 62  # columns a bit mask holds
LONG_TEXT = 64  # longer texts are compared by a 128-bit digest instead of being shuffled


def local_copy(df: DataFrame) -> DataFrame:
    """Materialise a catalog-sized result (keys, relations: one row per table or column
    pair) as a local table, so reusing it does not re-run the discovery behind it."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


# ---------------------------------------------------------------- K1 uniqueness
def uniqueness(df: DataFrame, cols) -> DataFrame:
    """K1: rows, distinct key values, duplicate keys and a uniqueness flag for a key (set).

    Grouping on the key gets a map-side partial count, so a hot key value is
    combined before the shuffle.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"), F.max(any_null.cast("int")).alias("has_null"))
    return g.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.max("has_null"), F.lit(0)).alias("_null")
    ).select("row_count", "distinct_keys", "duplicate_keys",
             F.round(F.try_divide(F.col("distinct_keys"), F.col("row_count")), 6).alias("uniqueness_ratio"),
             ((F.col("duplicate_keys") == 0) & (F.col("_null") == 0) & (F.col("row_count") > 0))
             .alias("is_unique"))


# ---------------------------------------------------------------- stacked values
KEY_FAMILIES = ("number", STRING, DATE)


def key_family(dt) -> str | None:
    from pyspark.sql import types as T
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return "number"
    fam = type_family(dt)
    if fam in (STRING, DATE):
        return fam
    return None


def key_columns(tables: dict) -> list[tuple[str, str, str]]:
    """(table, column, family) for every column that can carry a key (catalog-sized)."""
    out = []
    for t in sorted(tables):
        for f in tables[t].schema.fields:
            fam = key_family(f.dataType)
            if fam is not None:
                out.append((t, f.name, fam))
    return out


def _key_value(name: str, dt):
    """(ival, sval) of a column: whole numbers of any numeric type, and texts that read as one, are a
    long; other numbers their shortest decimal text; long texts a digest. Equal values of different types
    meet on the same pair."""
    from pyspark.sql import types as T
    c = F.col(f"`{name}`")
    none_i, none_s = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if isinstance(dt, T.DecimalType):
        text = c.cast("string")
        short = F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
        whole = F.when(short.rlike(r"^-?\d{1,18}$"), short).try_cast("bigint")
        return whole, F.when(whole.isNull(), short)
    if key_family(dt) == "number":
        return c.cast("bigint"), none_s
    text = c.cast("string")
    if type_family(dt) == DATE:
        return none_i, text
    whole = F.when(text.rlike(r"^(0|-?[1-9]\d{0,17})$"), text).try_cast("bigint")
    long_ = F.concat(F.lit("#"), F.md5(text.cast("binary")))
    return whole, F.when(whole.isNull(), F.when(F.length(text) > LONG_TEXT, long_).otherwise(text))


def value_sets(tables: dict, columns) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Which columns share how many values: (cols, n): ``n`` different values occur in exactly the columns
    ``cols`` (sorted positions in the returned list).

    One scan per table and one shuffle of the different values, whatever the number of column pairs; the
    result has one row per different set of columns and is checkpointed, so key, foreign-key and inclusion
    questions read it instead of the tables.
    """
    listed = sorted(set(columns))
    place = {c: i for i, c in enumerate(listed)}
    by_table: dict[str, list[str]] = {}
    for t, c in listed:
        by_table.setdefault(t, []).append(c)
    parts = []
    for t, cols in sorted(by_table.items()):
        types = {f.name: f.dataType for f in tables[t].schema.fields}
        entries = []
        for c in cols:
            ival, sval = _key_value(c, types[c])
            entries.append(F.struct(F.lit(place[(t, c)]).alias("c"), ival.alias("ival"), sval.alias("sval")))
        parts.append(tables[t].select(F.inline(F.array(*entries))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    checkpoint_dir(out.sparkSession)
    # a value's columns are bits, so that tasks combine them and each different value crosses the network once
    words = range(-(-len(listed) // _MASK))
    bits = [F.when(F.floor(F.col("c") / _MASK) == w, F.expr(f"shiftleft(1L, c % {_MASK})")).otherwise(F.lit(0).cast("long")) for w in words]
    held = (out.where(F.col("ival").isNotNull() | F.col("sval").isNotNull())
            .groupBy("ival", "sval").agg(*[F.bit_or(b).alias(f"m{w}") for w, b in zip(words, bits)]))
    masks = [f"m{w}" for w in words]
    cols = F.array_compact(F.array(*[F.when(F.expr(f"m{i // _MASK} & shiftleft(1L, {i % _MASK})") != 0, F.lit(i)) for i in range(len(listed))]))
    sets = held.groupBy(*masks).agg(F.count(F.lit(1)).alias("n")).select(cols.alias("cols"), "n").checkpoint(eager=True)
    return sets, listed


def _names(spark, listed) -> DataFrame:
    return spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(listed)], "c int, table_name string, column_name string")


def distinct_by_sets(sets: DataFrame, listed) -> DataFrame:
    """Distinct non-null values of every column: (table_name, column_name, distinct_count)."""
    counts = sets.select(F.explode("cols").alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n"))
    return _names(sets.sparkSession, listed).join(counts, "c", "left").select(
        "table_name", "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_count"))


def shared_by_sets(sets: DataFrame, listed) -> DataFrame:
    """Column pairs that share values, with how many: catalog-sized."""
    pairs = (sets.select(F.explode("cols").alias("a"), "cols", "n").select("a", F.explode("cols").alias("b"), "n")
             .where("a <> b").groupBy("a", "b").agg(F.sum("n").alias("found_values")))
    names = _names(sets.sparkSession, listed)
    f = names.toDF("a", "from_table", "from_column")
    t = names.toDF("b", "to_table", "to_column")
    return pairs.join(f, "a").join(t, "b").select("from_table", "from_column", "to_table", "to_column", "found_values")


_PAIR = ["from_table", "from_column", "to_table", "to_column"]


def inclusion_rates(tables: dict, pairs: DataFrame, found=None) -> DataFrame:
    """K4: share of distinct from-values found among the to-values, per pair.

    ``pairs``: (from_table, from_column, to_table, to_column), catalog-sized. Values of different types are
    equal if they are the same number or have the same text. ``found`` reuses ``value_sets`` of at least
    these columns.
    """
    prs = local_copy(pairs.select(*_PAIR).distinct())
    if found is None:
        ends = (prs.select(F.col("from_table").alias("t"), F.col("from_column").alias("c"))
                .unionByName(prs.select(F.col("to_table").alias("t"), F.col("to_column").alias("c"))).distinct().collect())
        if not ends:
            return prs.select("*", F.lit(0).cast("bigint").alias("distinct_values"), F.lit(0).cast("bigint").alias("found_values"),
                              F.lit(None).cast("double").alias("inclusion_rate"))
        found = value_sets(tables, [(r.t, r.c) for r in ends])
    sets, listed = found
    counts = distinct_by_sets(sets, listed).toDF("from_table", "from_column", "distinct_values")
    x = prs.join(counts, ["from_table", "from_column"], "left").join(shared_by_sets(sets, listed), _PAIR, "left")
    n, k = F.coalesce("distinct_values", F.lit(0)), F.coalesce("found_values", F.lit(0))
    k = F.when((F.col("from_table") == F.col("to_table")) & (F.col("from_column") == F.col("to_column")), n).otherwise(k)
    return x.select(*_PAIR, n.cast("bigint").alias("distinct_values"), k.cast("bigint").alias("found_values"),
                    F.round(F.try_divide(k, n), 6).alias("inclusion_rate"))


def inclusion_dependencies(tables: dict, min_rate: float = 1.0) -> DataFrame:
    """Column pairs of one key family in different tables where the values of A occur in B.

    Every number, date and text column takes part, texts of any length. Pairs come from the sets of
    columns that share values (``value_sets``), so no value is copied per pair.
    """
    kcols = key_columns(tables)
    spark = next(iter(tables.values())).sparkSession
    sets, listed = value_sets(tables, [(t, c) for t, c, _ in kcols])
    counts = distinct_by_sets(sets, listed).toDF("from_table", "from_column", "distinct_values")
    fam = spark.createDataFrame(kcols, "from_table string, from_column string, family string")
    x = (shared_by_sets(sets, listed).where(F.col("from_table") != F.col("to_table"))
         .join(counts, ["from_table", "from_column"]).join(fam, ["from_table", "from_column"])
         .join(fam.toDF("to_table", "to_column", "family"), ["to_table", "to_column", "family"]))
    return (x.select(*_PAIR, "distinct_values", "found_values",
                     F.round(F.col("found_values") / F.col("distinct_values"), 6).alias("inclusion_rate"))
            .where(F.col("inclusion_rate") >= min_rate))


# ---------------------------------------------------------------- K2, K3
def key_profile(tables: dict, found=None) -> DataFrame:
    """Counts that key inference needs, for every column that can carry a key: (table_name, column_name,
    ordinal, total_rows, non_null_count, null_count, distinct_count).

    One aggregate per table without a shuffle, and the distinct counts of ``value_sets``.
    """
    spark = next(iter(tables.values())).sparkSession
    cols = key_columns(tables)
    first = []
    for t in sorted(tables):
        df = tables[t]
        mine = [c for tt, c, _ in cols if tt == t]
        if not mine:
            continue
        wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(mine)])
        order = {f.name: i + 1 for i, f in enumerate(df.schema.fields)}
        first.append(wide.select(F.inline(F.array(*[
            F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(order[c]).alias("ordinal"),
                     F.col("_rows").alias("total_rows"), F.col(f"_nn{i}").alias("non_null_count"))
            for i, c in enumerate(mine)]))))
    stats = first[0]
    for x in first[1:]:
        stats = stats.unionByName(x)
    # one row per column (catalog-sized): kept as a local table so later jobs do not
    # scan the tables again for these counts
    stats = spark.createDataFrame(stats.collect(), stats.schema)
    dc = distinct_by_sets(*(found or value_sets(tables, [(t, c) for t, c, _ in cols])))
    return (stats.join(dc, ["table_name", "column_name"], "left")
            .select("table_name", "column_name", "ordinal", "total_rows", "non_null_count",
                    (F.col("total_rows") - F.col("non_null_count")).alias("null_count"),
                    F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias("distinct_count")))


def infer_primary_keys(profile: DataFrame) -> DataFrame:
    """K2: one single-column key per table: unique and null-free, key-like name first.

    Rank: key-like name (ends in id/key), then column position. Tables without a
    unique column get none here; keys of several columns are in ``keys``.
    """
    keyish = F.lower("column_name").rlike("(id|key)$")
    cand = profile.where((F.col("total_rows") > 0) & (F.col("null_count") == 0)
                         & (F.col("distinct_count") == F.col("total_rows")))
    w = Window.partitionBy("table_name").orderBy(keyish.desc(), F.col("ordinal").asc())
    return (cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("table_name", "column_name", keyish.alias("key_like_name")))


def infer_foreign_keys(tables: dict, columns: DataFrame, pks: DataFrame, found=None) -> DataFrame:
    """K3: FK = name match to another table's key + full inclusion of values + unique target.

    Name match: same lower-cased name, or same stem after a short alias prefix
    (``o_custkey`` ~ ``c_custkey``). Only confirmed pairs are returned, with the rate.
    """
    cols = columns.select("table_name", "column_name", "data_type",
                          name_stem(F.col("table_name"), F.col("column_name")).alias("stem"))
    keys = pks.join(cols, ["table_name", "column_name"]).select(
        F.col("table_name").alias("to_table"), F.col("column_name").alias("to_column"),
        F.col("stem").alias("to_stem"))
    cand = (cols.join(keys, cols.stem == keys.to_stem)
            .where(F.col("table_name") != F.col("to_table"))
            .select(F.col("table_name").alias("from_table"), F.col("column_name").alias("from_column"),
                    "to_table", "to_column"))
    rates = inclusion_rates(tables, cand, found)
    return rates.where(F.col("inclusion_rate") >= 1.0)


# ---------------------------------------------------------------- K5-K11 name joins
def shared_key_joins(columns: DataFrame) -> DataFrame:
    """K5: table pairs sharing a key-like column name (case-insensitive), both directions."""
    low = F.lower("column_name")
    is_key = F.lit(False)
    for s in KEY_SUFFIXES:
        is_key = is_key | low.endswith(s)
    k = columns.where(is_key).select("table_name", low.alias("_c")).distinct()
    a, b = k.alias("a"), k.alias("b")
    return (a.join(b, F.col("a._c") == F.col("b._c"))
            .where(F.col("a.table_name") != F.col("b.table_name"))
            .select(F.col("a.table_name").alias("from_table"), F.col("b.table_name").alias("to_table"))
            .distinct())


def suffix_joins(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """K6: t1 -> t2 when a column of t1 starts with ``<suffix of t2>_``.

    (``<sfx>_id`` and ``<sfx>_key`` are special cases of that prefix.) The prefix
    test becomes an equi-join: each column name is exploded into its prefixes that
    end before an underscore.
    """
    low = F.lower("column_name")
    parts = F.split(low, "_")
    pref = (columns.select("table_name", parts.alias("_p"))
            .select("table_name", F.posexplode(F.slice("_p", 1, F.size("_p") - 1)).alias("i", "_x"), "_p")
            .select("table_name", F.array_join(F.slice("_p", 1, F.col("i") + 1), "_").alias("_prefix"))
            .distinct())
    tgt = groups.where(F.col("suffix") != "").select(F.col("table_name").alias("to_table"),
                                                     F.col("suffix").alias("_prefix"))
    return (pref.join(tgt, "_prefix").where(F.col("table_name") != F.col("to_table"))
            .select(F.col("table_name").alias("from_table"), "to_table").distinct())


def fk_joins(fk: DataFrame, columns: DataFrame) -> DataFrame:
    """K7: declared FK pairs whose two tables are in the catalog."""
    known = columns.select("table_name").distinct()
    return (fk.join(known, "table_name", "left_semi")
            .join(known.withColumnRenamed("table_name", "referenced_table"), "referenced_table", "left_semi")
            .select(F.col("table_name").alias("from_table"), F.col("referenced_table").alias("to_table"))
            .distinct())


def all_joins(*joins: DataFrame) -> DataFrame:
    """K8: union of join sets without duplicates."""
    out = joins[0]
    for j in joins[1:]:
        out = out.unionByName(j)
    return out.distinct()


def join_role_score(joins: DataFrame, tables: DataFrame) -> DataFrame:
    """K9: out-degree minus in-degree per table, and the upper median of all scores."""
    out_d = joins.groupBy(F.col("from_table").alias("table_name")).agg(F.count(F.lit(1)).alias("out_degree"))
    in_d = joins.groupBy(F.col("to_table").alias("table_name")).agg(F.count(F.lit(1)).alias("in_degree"))
    s = (tables.select("table_name").join(out_d, "table_name", "left").join(in_d, "table_name", "left")
         .fillna(0, ["out_degree", "in_degree"])
         .withColumn("score", F.col("out_degree") - F.col("in_degree")))
    # Upper median = element n//2 (0-based) of the sorted scores. The catalog is small:
    # the scores are ranked in one window and a single number comes back.
    w = Window.orderBy("score", "table_name")
    n = s.count()
    med = (s.withColumn("_i", F.row_number().over(w) - 1).where(F.col("_i") == n // 2)
           .select("score").first())
    median = med[0] if med is not None else 0
    return s.select("table_name", "out_degree", "in_degree", "score",
                    F.lit(median).cast("bigint").alias("median_score"))


def matrix_axes(scores: DataFrame) -> DataFrame:
    """Row and column tables of the matrix: (axis, table_name).

    With fact/dim prefixes: rows = fact* (else score >= median), columns = dim*
    (else score < median). Without: rows = score >= median, columns = all tables.
    An empty axis falls back to all tables.
    """
    low = F.lower("table_name")
    flags = scores.agg(F.max(low.startswith("fact").cast("int")).alias("hf"),
                       F.max(low.startswith("dim").cast("int")).alias("hd")).first()
    has_fact, has_dim = bool(flags["hf"]), bool(flags["hd"])
    hi = F.col("score") >= F.col("median_score")
    if has_fact or has_dim:
        rows = scores.where(low.startswith("fact")) if has_fact else scores.where(hi)
        cols = scores.where(low.startswith("dim")) if has_dim else scores.where(~hi)
    else:
        rows = scores.where(hi)
        cols = scores
    rows = rows.select(F.lit("row").alias("axis"), "table_name")
    cols = cols.select(F.lit("col").alias("axis"), "table_name")
    all_t = scores.select("table_name")
    n_rows, n_cols = rows.count(), cols.count()  # catalog-sized
    if n_rows == 0:
        rows = all_t.select(F.lit("row").alias("axis"), "table_name")
    if n_cols == 0:
        cols = all_t.select(F.lit("col").alias("axis"), "table_name")
    return rows.unionByName(cols)


def relation_matrix_long(axes: DataFrame, joins: DataFrame) -> DataFrame:
    """K11 (long form): one row per (row table, column table) present as a join."""
    r = axes.where(F.col("axis") == "row").select(F.col("table_name").alias("row_table"))
    c = axes.where(F.col("axis") == "col").select(F.col("table_name").alias("col_table"))
    j = joins.select(F.col("from_table").alias("row_table"), F.col("to_table").alias("col_table"))
    return (j.join(r, "row_table", "left_semi").join(c, "col_table", "left_semi")
            .select("row_table", "col_table", F.lit(1).alias("cell")))


def relation_matrix_wide(axes: DataFrame, joins: DataFrame) -> DataFrame:
    """K11 (wide form): rows x columns, 1 or null, column order = sorted column tables."""
    col_names = sorted(r[0] for r in axes.where(F.col("axis") == "col").select("table_name").collect())
    rows = axes.where(F.col("axis") == "row").select(F.col("table_name").alias("Table"))
    long = relation_matrix_long(axes, joins)
    wide = long.groupBy(F.col("row_table").alias("Table")).pivot("col_table", col_names).agg(F.first("cell"))
    return rows.join(wide, "Table", "left").select("Table", *col_names)


# ---------------------------------------------------------------- K12-K14 roles
def infer_role(summary: DataFrame, fks: DataFrame, profile: DataFrame) -> DataFrame:
    """Fact or dimension from weighted evidence.

    fact points: rows >= median rows, 2+ outgoing FKs, a numeric measure, a date column.
    dim points: referenced by an FK, more text than numeric columns, rows < median.
    """
    out_fk = fks.groupBy(F.col("from_table").alias("table_name")).agg(F.count(F.lit(1)).alias("n_fk_out"))
    in_fk = fks.groupBy(F.col("to_table").alias("table_name")).agg(F.count(F.lit(1)).alias("n_fk_in"))
    kinds = profile.groupBy("table_name").agg(
        F.count_if(F.col("column_role") == "measure").alias("n_measures"),
        F.count_if(F.col("data_type").startswith("TIMESTAMP") | (F.col("data_type") == "DATE")).alias("n_dates"),
        F.count_if(F.col("data_type") == "STRING").alias("n_text"),
        F.count_if(F.col("min_val").isNotNull()).alias("n_numeric"))
    med = summary.select(F.percentile("row_count", 0.5).over(Window.partitionBy()).alias("_med"), "table_name")
    t = (summary.select("table_name", "row_count").join(med, "table_name")
         .join(out_fk, "table_name", "left").join(in_fk, "table_name", "left").join(kinds, "table_name", "left")
         .fillna(0, ["n_fk_out", "n_fk_in", "n_measures", "n_dates", "n_text", "n_numeric"]))
    fact_pts = ((F.col("row_count") >= F.col("_med")).cast("int") + (F.col("n_fk_out") >= 2).cast("int")
                + (F.col("n_measures") >= 1).cast("int") + (F.col("n_dates") >= 1).cast("int"))
    dim_pts = ((F.col("n_fk_in") >= 1).cast("int") + (F.col("n_text") > F.col("n_numeric")).cast("int")
               + (F.col("row_count") < F.col("_med")).cast("int"))
    return t.select("table_name", "row_count", "n_fk_out", "n_fk_in", fact_pts.alias("fact_points"),
                    dim_pts.alias("dim_points"),
                    F.when(fact_pts > dim_pts, F.lit("fact")).otherwise(F.lit("dimension")).alias("role"))


def relation_cardinality(relations: DataFrame, profile: DataFrame) -> DataFrame:
    """Cardinality from key uniqueness at both ends; filter direction dim -> fact.

    ``relations``: (from_table, from_column, to_table, to_column).
    """
    u = profile.select("table_name", "column_name",
                       ((F.col("distinct_count") == F.col("non_null_count")) & (F.col("non_null_count") > 0))
                       .alias("u"))
    fu = u.select(F.col("table_name").alias("from_table"), F.col("column_name").alias("from_column"),
                  F.col("u").alias("from_unique"))
    tu = u.select(F.col("table_name").alias("to_table"), F.col("column_name").alias("to_column"),
                  F.col("u").alias("to_unique"))
    r = (relations.select("from_table", "from_column", "to_table", "to_column")
         .join(fu, ["from_table", "from_column"], "left").join(tu, ["to_table", "to_column"], "left"))
    card = (F.when(F.col("from_unique") & F.col("to_unique"), F.lit("one-to-one"))
            .when(F.col("to_unique"), F.lit("many-to-one"))
            .when(F.col("from_unique"), F.lit("one-to-many"))
            .otherwise(F.lit("many-to-many")))
    direction = F.when(card == "one-to-one", F.lit("both")).otherwise(F.lit("single"))
    return r.select("from_table", "from_column", "to_table", "to_column", card.alias("cardinality"),
                    direction.alias("filter_direction"))


def logical_table_spec(roles: DataFrame, pks: DataFrame, fks: DataFrame, profile: DataFrame, keys: DataFrame) -> DataFrame:
    """Per table: role, pk, business keys, fks, measures, attributes (ordered lists).

    ``keys``: (table_name, columns), the minimal unique column combinations; those that are not the pk are the
    business keys, fewest columns first.
    """
    pk = pks.groupBy("table_name").agg(F.sort_array(F.collect_list("column_name")).alias("pk"))
    fk = (fks.groupBy(F.col("from_table").alias("table_name"))
          .agg(F.sort_array(F.collect_list(F.struct(F.col("from_column").alias("from"),
                                                    F.col("to_table").alias("toTable"),
                                                    F.col("to_column").alias("toColumn")))).alias("fks")))
    fk_cols = fks.select(F.col("from_table").alias("table_name"), F.col("from_column").alias("column_name"),
                         F.lit(True).alias("_is_fk")).distinct()
    pk_cols = pks.select("table_name", "column_name", F.lit(True).alias("_is_pk"))
    p = (profile.join(fk_cols, ["table_name", "column_name"], "left")
         .join(pk_cols, ["table_name", "column_name"], "left"))
    plain = F.col("_is_fk").isNull() & F.col("_is_pk").isNull()
    own = pk.select("table_name", F.col("pk").alias("_pk"))
    business = (keys.join(own, "table_name", "left").where(F.col("_pk").isNull() | (F.array_sort("columns") != F.col("_pk")))
                .groupBy("table_name").agg(F.array_sort(F.collect_list(F.struct(F.size("columns").alias("k"), "columns"))).alias("_keys")))
    lists = p.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.when(plain & (F.col("column_role") == "measure"),
                                           F.struct("ordinal", "column_name")))).alias("_m"),
        F.array_sort(F.collect_list(F.when(plain & (F.col("column_role") == "dimension"),
                                           F.struct("ordinal", "column_name")))).alias("_a"))
    return (roles.select("table_name", "role").join(pk, "table_name", "left").join(fk, "table_name", "left")
            .join(lists, "table_name", "left").join(business, "table_name", "left")
            .select("table_name", "role",
                    F.coalesce("pk", F.array().cast("array<string>")).alias("pk"),
                    F.coalesce(F.transform("_keys", lambda k: k["columns"]), F.array().cast("array<array<string>>")).alias("business_keys"),
                    F.coalesce("fks", F.array().cast(fk.schema["fks"].dataType)).alias("fks"),
                    F.transform("_m", lambda s: s["column_name"]).alias("measures"),
                    F.transform("_a", lambda s: s["column_name"]).alias("attributes")))
