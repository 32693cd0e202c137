from pyspark.sql import functions as F

from stellate.operators import catalog as M
from stellate.operators import discovery as K


def _tables(spark, names):
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def test_versioned_names_dropped(spark):
    t = _tables(spark, ["t_1", "t_v2", "t_old", "t_20240101", "x_deleted", "t", "v2"])
    assert sorted(r[0] for r in M.drop_versioned_tables(t).collect()) == ["t", "v2"]


def test_dedupe_keeps_first_per_canonical_name(spark):
    t = _tables(spark, ["Sales", "sales", "orders"])
    assert sorted(r[0] for r in M.dedupe_table_names(t).collect()) == ["Sales", "orders"]


def test_prefix_groups(spark):
    names = ["acme_crm_contact", "acme_crm_account", "acme_shop_cart", "acme_ai_model", "acme_crm_lead_note"]
    g = {r["table_name"]: (r["prefix"], r["domain"], r["suffix"]) for r in
         M.name_prefix_groups(_tables(spark, names)).collect()}
    assert g["acme_crm_lead_note"] == ("acme", "crm", "crm_lead_note")
    counts = {}
    for _, d, _ in g.values():
        counts[d] = counts.get(d, 0) + 1
    assert counts == {"crm": 3, "shop": 1, "ai": 1}


def test_composite_fk_paired_by_position(spark):
    pk = spark.createDataFrame([("p", "pk", "a", 1), ("p", "pk", "b", 2)],
                               "table_name string, constraint_name string, column_name string, position int")
    fk = spark.createDataFrame([("c", "fk", "x", 1, "p", "a", 1), ("c", "fk", "x", 1, "p", "b", 2),
                                ("c", "fk", "y", 2, "p", "a", 1), ("c", "fk", "y", 2, "p", "b", 2)],
                               "table_name string, constraint_name string, column_name string, position int, "
                               "referenced_table string, referenced_column string, referenced_position int")
    _, pairs = M.declared_keys(pk, fk)
    got = sorted((r.column_name, r.referenced_column) for r in pairs.collect())
    assert got == [("x", "a"), ("y", "b")]


def test_role_score_upper_median(spark):
    joins = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "from_table string, to_table string")
    s = K.join_role_score(joins, _tables(spark, ["a", "b", "c"]))
    scores = {r.table_name: r.score for r in s.collect()}
    assert scores == {"a": 1, "b": 0, "c": -1}
    assert s.first().median_score == 0  # sorted [-1, 0, 1][3 // 2]


def test_matrix_axes_with_and_without_prefixes(spark):
    joins = spark.createDataFrame([("fact_s", "dim_a"), ("fact_s", "dim_b")], "from_table string, to_table string")
    s = K.join_role_score(joins, _tables(spark, ["fact_s", "dim_a", "dim_b"]))
    axes = {(r.axis, r.table_name) for r in K.matrix_axes(s).collect()}
    assert axes == {("row", "fact_s"), ("col", "dim_a"), ("col", "dim_b")}
    joins2 = spark.createDataFrame([("x", "y")], "from_table string, to_table string")
    s2 = K.join_role_score(joins2, _tables(spark, ["x", "y", "z"]))
    axes2 = {(r.axis, r.table_name) for r in K.matrix_axes(s2).collect()}
    assert ("row", "x") in axes2 and {t for a, t in axes2 if a == "col"} == {"x", "y", "z"}


def test_shared_key_joins_are_symmetric(spark):
    cols = spark.createDataFrame([("a", "cust_id"), ("b", "CUST_ID"), ("c", "name")],
                                 "table_name string, column_name string")
    got = {(r.from_table, r.to_table) for r in K.shared_key_joins(cols).collect()}
    assert got == {("a", "b"), ("b", "a")}


def test_suffix_joins(spark):
    cols = spark.createDataFrame([("app_orders", "customer_id"), ("app_customer", "id")],
                                 "table_name string, column_name string")
    groups = M.name_prefix_groups(M.table_list(cols))
    got = {(r.from_table, r.to_table) for r in K.suffix_joins(cols, groups).collect()}
    assert got == {("app_orders", "app_customer")}


def test_inclusion_needs_values(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    b = spark.createDataFrame([(1,), (2,)], "k bigint")
    pairs = spark.createDataFrame([("a", "k", "b", "k")], "from_table string, from_column string, "
                                                          "to_table string, to_column string")
    r = K.inclusion_rates({"a": a, "b": b}, pairs).first()
    assert (r.distinct_values, r.found_values) == (3, 2)


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    r = K.uniqueness(df, ["a", "b"]).first()
    assert (r.row_count, r.distinct_keys, r.duplicate_keys, r.is_unique) == (3, 2, 1, False)


def test_catalog_from_metastore(spark, tmp_path):
    db = "stellate_test_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/db'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.t_a (id BIGINT, name STRING) USING parquet")
    spark.sql(f"CREATE OR REPLACE VIEW {db}.v_a AS SELECT id FROM {db}.t_a")
    cat = M.catalog_from_metastore(spark, db)
    got = [(r.table_name, r.column_name, r.data_type, r.ordinal_position) for r in cat.collect()]
    assert got == [("t_a", "id", "bigint", 1), ("t_a", "name", "string", 2)]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_numbers_of_different_types_and_long_texts_meet(spark):
    from decimal import Decimal
    a = spark.createDataFrame([(Decimal("1.0000"), "t" * 300, "7"), (Decimal("2.5000"), "u" * 300, "07")],
                              "d decimal(18,4), long_text string, n string")
    b = spark.createDataFrame([(1, "t" * 300, 2.5), (7, "u" * 300, 3.5)], "id bigint, long_text string, x double")
    pairs = spark.createDataFrame([("b", "id", "a", "d"), ("a", "long_text", "b", "long_text"), ("a", "n", "b", "id"),
                                   ("a", "d", "b", "id")],
                                  "from_table string, from_column string, to_table string, to_column string")
    got = {(r.from_table, r.from_column, r.to_column): (r.distinct_values, r.found_values)
           for r in K.inclusion_rates({"a": a, "b": b}, pairs).collect()}
    assert got == {("b", "id", "d"): (2, 1), ("a", "long_text", "long_text"): (2, 2), ("a", "n", "id"): (2, 1),
                   ("a", "d", "id"): (2, 1)}
    same = spark.createDataFrame([(Decimal("1.0000"),), (Decimal("7.0000"),)], "d decimal(18,4)")
    one = spark.createDataFrame([("a", "d", "b", "id")], pairs.schema)
    assert K.inclusion_rates({"a": same, "b": b}, one).first().inclusion_rate == 1.0
    assert ("a", "d", "number") in K.key_columns({"a": a})


def test_inclusion_dependencies_of_any_text_length(spark):
    a = spark.createDataFrame([("t" * 999,)], "x string")
    b = spark.createDataFrame([("t" * 999,), ("u",)], "y string")
    assert [(r.from_column, r.to_column) for r in K.inclusion_dependencies({"a": a, "b": b}).collect()] == [("x", "y")]
