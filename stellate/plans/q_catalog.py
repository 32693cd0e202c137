"""Registered catalog and discovery queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from stellate.operators import catalog as M
from stellate.operators import discovery as K
from stellate.operators import keys as Keys
from stellate.operators import profile as P
from stellate.plans.registry import register
from stellate.plans.schemas import SCHEMAS
from stellate.plans.sqlgen import _fam, _role
from stellate.sources.tables import TABLES, load_tables

# Declared keys of the driver tables: the constraint catalog a warehouse would hold.
DECLARED_PK = [("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"),
               ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
               ("lineitem", "l_orderkey"), ("lineitem", "l_linenumber")]
DECLARED_FK = [("lineitem", "l_orderkey", "orders", "o_orderkey"),
               ("lineitem", "l_partkey", "part", "p_partkey"),
               ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
               ("orders", "o_custkey", "customer", "c_custkey"),
               ("customer", "c_nationkey", "nation", "n_nationkey"),
               ("supplier", "s_nationkey", "nation", "n_nationkey"),
               ("nation", "n_regionkey", "region", "r_regionkey"),
               ("labels", "doc_id", "documents", "doc_id")]


def _pk_df(spark):
    return spark.createDataFrame([(t, f"pk_{t}", c, i + 1) for i, (t, c) in enumerate(DECLARED_PK)],
                                 "table_name string, constraint_name string, column_name string, position int")


def _fk_df(spark):
    return spark.createDataFrame([(t, f"fk_{t}_{c}", c, 1, rt, rc, 1) for t, c, rt, rc in DECLARED_FK],
                                 "table_name string, constraint_name string, column_name string, position int, "
                                 "referenced_table string, referenced_column string, referenced_position int")


def _tables(spark, sf):
    return load_tables(spark, sf, TABLES)


def _catalog(spark, sf):
    return M.catalog_columns(spark, _tables(spark, sf))


PK_VALUES = ", ".join(f"('{t}', '{c}')" for t, c in DECLARED_PK)
FK_VALUES = ", ".join(f"('{t}', '{c}', '{rt}', '{rc}')" for t, c, rt, rc in DECLARED_FK)
TABLE_IN = ", ".join(f"'{t}'" for t in TABLES)

CAT_SQL = f"""cat AS (
  SELECT table_name, column_name,
    CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
      WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
      WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date' WHEN 'FLOAT' THEN 'float'
      WHEN 'SMALLINT' THEN 'smallint' ELSE lower(data_type) END AS data_type,
    CAST(NULL AS INTEGER) AS character_maximum_length,
    CAST(CASE WHEN data_type LIKE 'DECIMAL%' THEN numeric_precision END AS INTEGER) AS numeric_precision,
    CAST(CASE WHEN data_type LIKE 'DECIMAL%' THEN numeric_scale END AS INTEGER) AS numeric_scale,
    is_nullable, CAST(ordinal_position AS INTEGER) AS ordinal_position
  FROM information_schema.columns WHERE table_name IN ({TABLE_IN}))"""


@register("catalog_columns", f"WITH {CAT_SQL} SELECT * FROM cat")
def catalog_columns(spark, sf):
    return _catalog(spark, sf)


_VERSIONED_SQL = " OR ".join(f"regexp_matches(lower(table_name), '{p}')" for p in M.VERSIONED_TABLE_PATTERNS)


@register("clean_table_list", f"""WITH {CAT_SQL}
SELECT min(table_name) AS table_name FROM (SELECT DISTINCT table_name FROM cat WHERE NOT ({_VERSIONED_SQL}))
GROUP BY regexp_replace(lower(table_name), '_\\d+$', '')""")
def clean_table_list(spark, sf):
    return M.clean_table_list(M.table_list(_catalog(spark, sf)))


@register("erd_columns", f"""WITH {CAT_SQL},
pk(table_name, column_name) AS (VALUES {PK_VALUES}),
fk(table_name, column_name, referenced_table, referenced_column) AS (VALUES {FK_VALUES})
SELECT c.table_name, c.column_name AS name, c.data_type AS type, c.is_nullable = 'YES' AS nullable,
       pk.column_name IS NOT NULL AS primary_key,
       CASE WHEN fk.referenced_table IS NOT NULL THEN fk.referenced_table || '.' || fk.referenced_column END
         AS foreign_key
FROM cat c LEFT JOIN pk ON c.table_name = pk.table_name AND c.column_name = pk.column_name
LEFT JOIN fk ON c.table_name = fk.table_name AND c.column_name = fk.column_name""")
def erd_columns(spark, sf):
    pk, fk = M.declared_keys(_pk_df(spark), _fk_df(spark))
    erd = M.build_erd(_catalog(spark, sf), pk, fk)
    return erd.select("table_name", F.explode("columns").alias("c")).select(
        "table_name", "c.name", "c.type", "c.nullable", "c.primary_key", "c.foreign_key")


@register("erd_relationships", f"""WITH {CAT_SQL},
fk(table_name, column_name, referenced_table, referenced_column) AS (VALUES {FK_VALUES}),
t AS (SELECT DISTINCT table_name FROM cat)
SELECT t.table_name, COUNT(fk.table_name) AS relationship_count,
       COALESCE(string_agg(fk.referenced_table || '(' || fk.column_name || '=' || fk.referenced_column || ')', ', '
                           ORDER BY fk.referenced_table, fk.column_name), '') AS relationships
FROM t LEFT JOIN fk ON t.table_name = fk.table_name GROUP BY t.table_name""")
def erd_relationships(spark, sf):
    pk, fk = M.declared_keys(_pk_df(spark), _fk_df(spark))
    erd = M.build_erd(_catalog(spark, sf), pk, fk)
    rels = F.array_sort(F.transform("relationships", lambda r: F.struct(r["to_table"], r["on_column"],
                                                                        r["references"])))
    return erd.select(
        "table_name", F.size("relationships").cast("bigint").alias("relationship_count"),
        F.array_join(F.transform(rels, lambda r: F.concat(r["to_table"], F.lit("("), r["on_column"], F.lit("="),
                                                          r["references"], F.lit(")"))), ", ")
        .alias("relationships"))


@register("pk_fk_candidates", f"""WITH {CAT_SQL},
t AS (SELECT DISTINCT table_name FROM cat),
names AS (SELECT DISTINCT lower(table_name) AS base, table_name AS other FROM t
          UNION SELECT regexp_replace(lower(table_name), 's$', '') AS base, table_name AS other FROM t),
c AS (SELECT *, lower(column_name) AS low, regexp_extract(lower(column_name), '^(.*)_(id|key)$', 1) AS base FROM cat),
hits AS (SELECT c.table_name, c.column_name, string_agg(DISTINCT n.other, ', ' ORDER BY n.other) AS targets
         FROM c JOIN names n ON c.base = n.base WHERE c.base <> '' AND n.other <> c.table_name
         GROUP BY c.table_name, c.column_name)
SELECT c.table_name, c.column_name,
  c.low = 'id' OR c.low IN (lower(c.table_name) || '_id', lower(c.table_name) || '_key',
    regexp_replace(lower(c.table_name), 's$', '') || '_id', regexp_replace(lower(c.table_name), 's$', '') || '_key')
    AS is_pk_candidate,
  hits.targets IS NOT NULL AS is_fk_candidate, COALESCE(hits.targets, '') AS fk_targets
FROM c LEFT JOIN hits ON c.table_name = hits.table_name AND c.column_name = hits.column_name""")
def pk_fk_candidates(spark, sf):
    c = M.pk_fk_candidates(_catalog(spark, sf))
    return c.select("table_name", "column_name", "is_pk_candidate", "is_fk_candidate",
                    F.array_join("fk_targets", ", ").alias("fk_targets"))


@register("name_prefix_groups", f"""WITH {CAT_SQL},
t AS (SELECT DISTINCT table_name, string_split(table_name, '_') AS parts FROM cat),
pos AS (SELECT i, COUNT(DISTINCT parts[i]) AS nd FROM t, range(1, 50) r(i) WHERE i <= len(parts) GROUP BY i),
pl AS (SELECT LEAST((SELECT MIN(len(parts)) FROM t),
                    COALESCE((SELECT MIN(i) - 1 FROM pos WHERE nd > 1), 1000)) AS n)
SELECT table_name, array_to_string(parts[1:(SELECT n FROM pl)], '_') AS prefix,
       lower(parts[(SELECT n FROM pl) + 1]) AS domain,
       lower(array_to_string(parts[(SELECT n FROM pl) + 1:], '_')) AS suffix
FROM t""")
def name_prefix_groups(spark, sf):
    return M.name_prefix_groups(M.table_list(_catalog(spark, sf)))


@register("uniqueness_lineitem_key", """SELECT CAST(SUM(n) AS BIGINT) AS row_count, COUNT(*) AS distinct_keys,
  COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, ROUND(COUNT(*) / SUM(n), 6) AS uniqueness_ratio,
  COUNT(*) FILTER (WHERE n > 1) = 0 AND MAX(has_null) = 0 AS is_unique
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n,
             MAX(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 1 ELSE 0 END) AS has_null
      FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def uniqueness_lineitem_key(spark, sf):
    return K.uniqueness(load_tables(spark, sf, ["lineitem"])["lineitem"], ["l_orderkey", "l_linenumber"])


def _minimal_sql(tables=TABLES, only=None):
    """The minimal unique combinations of up to MAX_SIZE of the columns that can carry a key."""
    def one(t, order, mask, cols):
        names = ", ".join(cols)
        null = " OR ".join(f"{c} IS NULL" for c in cols)
        return (f"SELECT '{t}' AS table_name, '{names}' AS columns, {len(cols)} AS size, {order} AS i, {mask} AS mask, "
                f"(SELECT COUNT(*) > 0 AND COUNT(*) = COUNT(DISTINCT ({names})) AND COUNT(*) FILTER (WHERE {null}) = 0 FROM {t}) AS u")
    tried = []
    for t in tables:
        cols = [c for tt, c, _ in _key_cols() if tt == t and (only is None or c in only)]
        for n in range(1, Keys.MAX_SIZE + 1):
            tried += [one(t, len(tried) + i, sum(1 << j for j in k), [cols[j] for j in k]) for i, k in enumerate(combinations(range(len(cols)), n))]
    return f"""tried AS MATERIALIZED ({" UNION ALL ".join(tried)}),
minimal AS (SELECT table_name, columns, size, i FROM tried x WHERE u AND NOT EXISTS (SELECT 1 FROM tried y WHERE y.u
  AND y.table_name = x.table_name AND y.mask <> x.mask AND (y.mask & x.mask) = y.mask))"""


def _key_cols():
    out = []
    for t in TABLES:
        for c, ty in SCHEMAS[t]:
            if ty in ("int", "bigint", "smallint", "tinyint"):
                out.append((t, c, "number"))
            elif ty in ("string",):
                out.append((t, c, "string"))
            elif ty in ("date", "timestamp_ntz", "timestamp"):
                out.append((t, c, "date"))
    return out


VALS_SQL = "vals AS (SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(\"{c}\" AS VARCHAR) AS value FROM {t} "
    f"WHERE \"{c}\" IS NOT NULL" for t, c, _ in _key_cols()) + "))"

KC_SQL = "kc(table_name, column_name, family) AS (VALUES " + ", ".join(
    f"('{t}', '{c}', '{f}')" for t, c, f in _key_cols()) + ")"

# Key profile of every table: number, date and text columns.
def _uniq_part(t, i, c, ty):
    return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal, "
            f"COUNT(*) AS n, COUNT(\"{c}\") AS nn, COUNT(DISTINCT \"{c}\") AS nd FROM {t}")


UNIQ_SQL = "uniq AS (" + " UNION ALL ".join(
    _uniq_part(t, i, c, ty) for t in TABLES for i, (c, ty) in enumerate(SCHEMAS[t], start=1)
    if ty in ("int", "bigint", "smallint", "tinyint", "string", "date", "timestamp_ntz", "timestamp")) + ")"

PKS_SQL = f"""{UNIQ_SQL},
pks AS (SELECT table_name, column_name, key_like_name FROM (
  SELECT table_name, column_name, regexp_matches(lower(column_name), '(id|key)$') AS key_like_name,
         ROW_NUMBER() OVER (PARTITION BY table_name
                            ORDER BY regexp_matches(lower(column_name), '(id|key)$') DESC, ordinal) AS r
  FROM uniq WHERE n > 0 AND nn = n AND nd = n) x WHERE r = 1)"""


def _keys(spark, sf):
    """(tables, shared value sets of all key columns, key profile)."""
    tabs = _tables(spark, sf)
    found = K.value_sets(tabs, [(t, c) for t, c, _ in K.key_columns(tabs)])
    return tabs, found, K.key_profile(tabs, found)


def _relations(spark, sf):
    """(tables, key profile, primary keys, foreign keys); the last three kept as local tables."""
    tabs, found, kp = _keys(spark, sf)
    kp = K.local_copy(kp)
    pks = K.local_copy(K.infer_primary_keys(kp))
    return tabs, kp, pks, K.local_copy(K.infer_foreign_keys(tabs, M.catalog_columns(spark, tabs), pks, found))


@register("primary_keys_inferred", f"WITH {PKS_SQL} SELECT * FROM pks")
def primary_keys_inferred(spark, sf):
    """K2 over the key profile (number, date and text columns)."""
    return K.infer_primary_keys(_keys(spark, sf)[2])


# Values of the columns that are an end of a candidate relation.
_CAND_VALS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(\"{c}\" AS VARCHAR) AS value FROM {t} "
    f"WHERE \"{c}\" IS NOT NULL AND EXISTS (SELECT 1 FROM ends WHERE t = '{t}' AND c = '{c}')" for t, c, _ in _key_cols())

FKS_SQL = f"""{PKS_SQL}, {CAT_SQL},
stems AS (SELECT table_name, column_name, regexp_replace(lower(column_name), '^[a-z]{{1,2}}_', '') AS stem FROM cat),
cand AS (SELECT s.table_name AS from_table, s.column_name AS from_column, k.table_name AS to_table,
                k.column_name AS to_column
         FROM stems s JOIN (SELECT p.table_name, p.column_name, st.stem FROM pks p JOIN stems st
                            ON p.table_name = st.table_name AND p.column_name = st.column_name) k
           ON s.stem = k.stem WHERE s.table_name <> k.table_name),
ends AS (SELECT from_table AS t, from_column AS c FROM cand UNION SELECT to_table, to_column FROM cand),
vals AS (SELECT DISTINCT * FROM ({_CAND_VALS_SQL})),
rates AS (SELECT c.from_table, c.from_column, c.to_table, c.to_column, COUNT(a.value) AS distinct_values,
                 COUNT(b.value) AS found_values
          FROM cand c LEFT JOIN vals a ON a.table_name = c.from_table AND a.column_name = c.from_column
          LEFT JOIN vals b ON b.table_name = c.to_table AND b.column_name = c.to_column AND b.value = a.value
          GROUP BY ALL)"""


@register("foreign_keys_inferred", f"""WITH {FKS_SQL}
SELECT from_table, from_column, to_table, to_column, distinct_values, found_values,
       ROUND(found_values / distinct_values, 6) AS inclusion_rate
FROM rates WHERE distinct_values > 0 AND found_values = distinct_values""")
def foreign_keys_inferred(spark, sf):
    """K3: name match + full inclusion + unique target."""
    return _relations(spark, sf)[3]


_K4_PAIRS = [("events", "user_id", "customer", "c_custkey"),
             ("orders", "o_custkey", "customer", "c_custkey"),
             ("documents", "doc_id", "labels", "doc_id"),
             ("lineitem", "l_orderkey", "orders", "o_orderkey")]


@register("inclusion_rates", f"""WITH {VALS_SQL},
pairs(from_table, from_column, to_table, to_column) AS (VALUES {", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in _K4_PAIRS)})
SELECT p.from_table, p.from_column, p.to_table, p.to_column, COUNT(a.value) AS distinct_values,
       COUNT(b.value) AS found_values, ROUND(COUNT(b.value) / COUNT(a.value), 6) AS inclusion_rate
FROM pairs p LEFT JOIN vals a ON a.table_name = p.from_table AND a.column_name = p.from_column
LEFT JOIN vals b ON b.table_name = p.to_table AND b.column_name = p.to_column AND b.value = a.value
GROUP BY ALL""")
def inclusion_rates(spark, sf):
    pairs = spark.createDataFrame(_K4_PAIRS, "from_table string, from_column string, to_table string, to_column string")
    return K.inclusion_rates(_tables(spark, sf), pairs)


@register("inclusion_dependencies", f"""WITH {VALS_SQL}, {KC_SQL},
nd AS (SELECT table_name, column_name, COUNT(*) AS nd FROM vals GROUP BY ALL),
cols AS (SELECT kc.table_name, kc.column_name, kc.family, COALESCE(nd.nd, 0) AS nd
         FROM kc LEFT JOIN nd USING (table_name, column_name)),
j AS (SELECT a.table_name AS from_table, a.column_name AS from_column, b.table_name AS to_table,
             b.column_name AS to_column, ca.nd AS distinct_values, COUNT(*) AS found_values
      FROM vals a JOIN vals b ON a.value = b.value AND a.table_name <> b.table_name
      JOIN cols ca ON ca.table_name = a.table_name AND ca.column_name = a.column_name
      JOIN cols cb ON cb.table_name = b.table_name AND cb.column_name = b.column_name AND ca.family = cb.family
      GROUP BY ALL)
SELECT *, ROUND(found_values / distinct_values, 6) AS inclusion_rate FROM j WHERE found_values = distinct_values""")
def inclusion_dependencies(spark, sf):
    return K.inclusion_dependencies(_tables(spark, sf), 1.0)


# ------------------------------------------------------------------ name-based joins
_KEYSFX_SQL = " OR ".join(f"lower(column_name) LIKE '%{s}'" for s in K.KEY_SUFFIXES)
K5_SQL = f"""k5 AS (SELECT DISTINCT a.table_name AS from_table, b.table_name AS to_table
  FROM (SELECT DISTINCT table_name, lower(column_name) AS c FROM cat WHERE {_KEYSFX_SQL}) a
  JOIN (SELECT DISTINCT table_name, lower(column_name) AS c FROM cat WHERE {_KEYSFX_SQL}) b
  ON a.c = b.c WHERE a.table_name <> b.table_name)"""

GROUPS_SQL = """t AS (SELECT DISTINCT table_name, string_split(table_name, '_') AS parts FROM cat),
pos AS (SELECT i, COUNT(DISTINCT parts[i]) AS nd FROM t, range(1, 50) r(i) WHERE i <= len(parts) GROUP BY i),
pl AS (SELECT LEAST((SELECT MIN(len(parts)) FROM t),
                    COALESCE((SELECT MIN(i) - 1 FROM pos WHERE nd > 1), 1000)) AS n),
grp AS (SELECT table_name, lower(array_to_string(parts[(SELECT n FROM pl) + 1:], '_')) AS suffix FROM t)"""

K6_SQL = """k6 AS (SELECT DISTINCT c.table_name AS from_table, g.table_name AS to_table
  FROM cat c JOIN grp g ON starts_with(lower(c.column_name), g.suffix || '_')
  WHERE g.suffix <> '' AND c.table_name <> g.table_name)"""

K7_SQL = f"""fk(table_name, column_name, referenced_table, referenced_column) AS (VALUES {FK_VALUES}),
k7 AS (SELECT DISTINCT table_name AS from_table, referenced_table AS to_table FROM fk
       WHERE table_name IN (SELECT table_name FROM cat) AND referenced_table IN (SELECT table_name FROM cat))"""

JOINS_SQL = f"""{CAT_SQL}, {K5_SQL}, {GROUPS_SQL}, {K6_SQL}, {K7_SQL},
k8 AS (SELECT * FROM k5 UNION SELECT * FROM k6 UNION SELECT * FROM k7)"""


def _joins(spark, sf):
    cat = _catalog(spark, sf)
    groups = M.name_prefix_groups(M.table_list(cat))
    _, fk = M.declared_keys(_pk_df(spark), _fk_df(spark))
    return cat, K.all_joins(K.shared_key_joins(cat), K.suffix_joins(cat, groups), K.fk_joins(fk, cat))


@register("shared_key_joins", f"WITH {CAT_SQL}, {K5_SQL} SELECT * FROM k5")
def shared_key_joins(spark, sf):
    return K.shared_key_joins(_catalog(spark, sf))


@register("suffix_joins", f"WITH {CAT_SQL}, {GROUPS_SQL}, {K6_SQL} SELECT * FROM k6")
def suffix_joins(spark, sf):
    cat = _catalog(spark, sf)
    return K.suffix_joins(cat, M.name_prefix_groups(M.table_list(cat)))


@register("fk_joins", f"WITH {CAT_SQL}, {K7_SQL} SELECT * FROM k7")
def fk_joins(spark, sf):
    _, fk = M.declared_keys(_pk_df(spark), _fk_df(spark))
    return K.fk_joins(fk, _catalog(spark, sf))


@register("all_joins", f"WITH {JOINS_SQL} SELECT * FROM k8")
def all_joins(spark, sf):
    return _joins(spark, sf)[1]


SCORE_SQL = f"""{JOINS_SQL},
tl AS (SELECT DISTINCT table_name FROM cat),
sc AS (SELECT tl.table_name,
              (SELECT COUNT(*) FROM k8 WHERE from_table = tl.table_name) AS out_degree,
              (SELECT COUNT(*) FROM k8 WHERE to_table = tl.table_name) AS in_degree FROM tl),
sc2 AS (SELECT *, out_degree - in_degree AS score,
               ROW_NUMBER() OVER (ORDER BY out_degree - in_degree, table_name) - 1 AS i FROM sc),
med AS (SELECT score AS median_score FROM sc2 WHERE i = (SELECT COUNT(*) FROM sc2) // 2),
scores AS (SELECT table_name, out_degree, in_degree, score, (SELECT median_score FROM med) AS median_score FROM sc2)"""


@register("join_role_score", f"WITH {SCORE_SQL} SELECT * FROM scores")
def join_role_score(spark, sf):
    cat, joins = _joins(spark, sf)
    return K.join_role_score(joins, M.table_list(cat))


AXES_SQL = f"""{SCORE_SQL},
axes AS (SELECT 'row' AS axis, table_name FROM scores WHERE score >= median_score
         UNION ALL SELECT 'col' AS axis, table_name FROM scores)"""


@register("matrix_axes", f"WITH {AXES_SQL} SELECT * FROM axes")
def matrix_axes(spark, sf):
    cat, joins = _joins(spark, sf)
    return K.matrix_axes(K.join_role_score(joins, M.table_list(cat)))


@register("relation_matrix", f"""WITH {AXES_SQL}
SELECT from_table AS row_table, to_table AS col_table, 1 AS cell FROM k8
WHERE from_table IN (SELECT table_name FROM axes WHERE axis = 'row')
  AND to_table IN (SELECT table_name FROM axes WHERE axis = 'col')""")
def relation_matrix(spark, sf):
    cat, joins = _joins(spark, sf)
    axes = K.matrix_axes(K.join_role_score(joins, M.table_list(cat)))
    return K.relation_matrix_long(axes, joins)


def _roles(spark, sf):
    tabs, _, pks, fks = _relations(spark, sf)
    prof = P.profile_light(tabs)
    summary = P.table_summary(prof, pks.select("table_name", "column_name"))
    return prof, pks, fks, K.infer_role(summary, fks, prof)


def _kinds_row(t):
    cols = SCHEMAS[t]
    n_meas = sum(1 for c, ty in cols if _role(c, _fam(ty)) == "measure")
    n_dates = sum(1 for _, ty in cols if ty.startswith("timestamp") or ty == "date")
    n_text = sum(1 for _, ty in cols if ty == "string")
    nums = [c for c, ty in cols if _fam(ty) == "numeric"]
    n_num = " + ".join(f"CAST(COUNT(*) FILTER (WHERE isfinite(CAST(\"{c}\" AS DOUBLE))) > 0 AS INTEGER)"
                       for c in nums) or "0"
    return f"SELECT '{t}', COUNT(*), {n_meas}, {n_dates}, {n_text}, {n_num} FROM {t}"


ROLES_SQL = f"""{FKS_SQL},
fks AS (SELECT * FROM rates WHERE distinct_values > 0 AND found_values = distinct_values),
kinds(table_name, row_count, n_measures, n_dates, n_text, n_numeric) AS (
  {" UNION ALL ".join(_kinds_row(t) for t in TABLES)}),
med AS (SELECT quantile_cont(row_count, 0.5) AS m FROM kinds),
tr AS (SELECT k.*, CAST(COALESCE(o.n, 0) AS BIGINT) AS n_fk_out, CAST(COALESCE(i.n, 0) AS BIGINT) AS n_fk_in,
              (SELECT m FROM med) AS med
       FROM kinds k LEFT JOIN (SELECT from_table, COUNT(*) AS n FROM fks GROUP BY 1) o ON o.from_table = k.table_name
       LEFT JOIN (SELECT to_table, COUNT(*) AS n FROM fks GROUP BY 1) i ON i.to_table = k.table_name),
pts AS (SELECT table_name, row_count, n_fk_out, n_fk_in,
  CAST(CAST(row_count >= med AS INTEGER) + CAST(n_fk_out >= 2 AS INTEGER) + CAST(n_measures >= 1 AS INTEGER)
       + CAST(n_dates >= 1 AS INTEGER) AS INTEGER) AS fact_points,
  CAST(CAST(n_fk_in >= 1 AS INTEGER) + CAST(n_text > n_numeric AS INTEGER) + CAST(row_count < med AS INTEGER)
       AS INTEGER) AS dim_points FROM tr),
roles AS (SELECT *, CASE WHEN fact_points > dim_points THEN 'fact' ELSE 'dimension' END AS role FROM pts)"""


@register("infer_roles", f"WITH {ROLES_SQL} SELECT * FROM roles")
def infer_roles(spark, sf):
    """A weighted rule over profile and FK evidence."""
    return _roles(spark, sf)[3]


@register("relation_cardinality", f"""WITH {FKS_SQL},
fks AS (SELECT * FROM rates WHERE distinct_values > 0 AND found_values = distinct_values),
u AS (SELECT table_name, column_name, nn > 0 AND nd = nn AS u FROM uniq)
SELECT f.from_table, f.from_column, f.to_table, f.to_column,
  CASE WHEN fu.u AND tu.u THEN 'one-to-one' WHEN tu.u THEN 'many-to-one' WHEN fu.u THEN 'one-to-many'
       ELSE 'many-to-many' END AS cardinality,
  CASE WHEN fu.u AND tu.u THEN 'both' ELSE 'single' END AS filter_direction
FROM fks f LEFT JOIN u fu ON fu.table_name = f.from_table AND fu.column_name = f.from_column
LEFT JOIN u tu ON tu.table_name = f.to_table AND tu.column_name = f.to_column""")
def relation_cardinality(spark, sf):
    _, kp, _, fks = _relations(spark, sf)
    return K.relation_cardinality(fks, kp)


@register("composite_key_lineitem", f"""WITH {_minimal_sql(["lineitem"], ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))}
SELECT table_name, columns FROM minimal WHERE size > 1 ORDER BY i LIMIT 1""")
def composite_key_lineitem(spark, sf):
    """K2: a key of several columns where names indicate one (LIMIT: the first, with the fewest columns)."""
    return Keys.composite_key(load_tables(spark, sf, ["lineitem"])["lineitem"], "lineitem")


@register("unique_combinations", f"WITH {_minimal_sql()} SELECT table_name, columns FROM minimal")
def unique_combinations(spark, sf):
    """K2: every minimal key of up to four columns of every table."""
    found = Keys.minimal_keys(load_tables(spark, sf))
    return found.select("table_name", F.array_join("columns", ", ").alias("columns"))


def _kind_list(kind):
    return f"""COALESCE((SELECT string_agg(column_name, ',' ORDER BY ordinal) FROM kinds2 k WHERE k.table_name = r.table_name AND kind = '{kind}'
     AND (table_name, column_name) NOT IN (SELECT table_name, column_name FROM pks)
     AND (table_name, column_name) NOT IN (SELECT from_table, from_column FROM fks)), '')"""


@register("logical_table_spec", f"""WITH {ROLES_SQL}, {_minimal_sql()},
kinds2(table_name, column_name, ordinal, kind) AS (VALUES {", ".join(f"('{t}', '{c}', {i}, '{_role(c, _fam(ty))}')" for t in TABLES for i, (c, ty) in enumerate(SCHEMAS[t]))})
SELECT r.table_name, r.role,
  COALESCE((SELECT string_agg(column_name, ',' ORDER BY column_name) FROM pks p WHERE p.table_name = r.table_name), '') AS pk,
  COALESCE((SELECT string_agg(columns, '; ' ORDER BY size, columns) FROM minimal m WHERE m.table_name = r.table_name
            AND (table_name, columns) NOT IN (SELECT table_name, column_name FROM pks)), '') AS business_keys,
  COALESCE((SELECT string_agg(from_column || '>' || to_table || '.' || to_column, ',' ORDER BY from_column, to_table, to_column)
            FROM fks f WHERE f.from_table = r.table_name), '') AS fks,
  {_kind_list("measure")} AS measures, {_kind_list("dimension")} AS attributes
FROM roles r""")
def logical_table_spec(spark, sf):
    """K14, the nested spec with its lists joined as text: one row per table."""
    prof, pks, fks, roles = _roles(spark, sf)
    spec = K.logical_table_spec(roles, pks, fks, prof, Keys.minimal_keys(load_tables(spark, sf)))
    ends = F.transform("fks", lambda f: F.concat(f["from"], F.lit(">"), f["toTable"], F.lit("."), f["toColumn"]))
    return spec.select("table_name", "role", F.array_join("pk", ",").alias("pk"),
                       F.array_join(F.transform("business_keys", lambda k: F.array_join(k, ", ")), "; ").alias("business_keys"),
                       F.array_join(ends, ",").alias("fks"), F.array_join("measures", ",").alias("measures"),
                       F.array_join("attributes", ",").alias("attributes"))
