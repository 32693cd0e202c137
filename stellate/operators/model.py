"""Model validation on relation and column catalogs.

Inputs are catalog-sized DataFrames: relations (from_table, from_column, to_table,
to_column) and columns (table_name, column_name, data_type, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REL = ["from_table", "from_column", "to_table", "to_column"]


def missing_columns(relations: DataFrame, columns: DataFrame) -> DataFrame:
    """V1: relation ends whose table.column does not exist."""
    cols = columns.select("table_name", "column_name")
    f = (relations.join(cols.withColumnsRenamed({"table_name": "from_table", "column_name": "from_column"}),
                        ["from_table", "from_column"], "left_anti")
         .select(*REL, F.lit("from").alias("missing_end")))
    t = (relations.join(cols.withColumnsRenamed({"table_name": "to_table", "column_name": "to_column"}),
                        ["to_table", "to_column"], "left_anti")
         .select(*REL, F.lit("to").alias("missing_end")))
    return f.unionByName(t)


def _table_edges(relations: DataFrame) -> list[tuple[str, str]]:
    """Different directed table pairs (catalog-sized: at most one row per relation)."""
    rows = relations.where(F.col("from_table") != F.col("to_table")).select("from_table", "to_table").distinct().collect()
    return sorted((r[0], r[1]) for r in rows)


def _has_other_route(edges: dict, src: str, dst: str) -> tuple[list, list] | None:
    """Two different simple routes src -> dst, or None.

    The shortest route is found first. A second one exists if, without some edge of the first, dst is
    still reachable; one search per edge of the route, so no route is ever enumerated.
    """
    first = _shortest(edges, src, dst, None)
    if first is None:
        return None
    for cut in zip(first, first[1:]):
        second = _shortest(edges, src, dst, cut)
        if second is not None:
            return first, second
    return None


def _shortest(edges: dict, src: str, dst: str, without) -> list | None:
    came, frontier = {src: None}, [src]
    while frontier and dst not in came:
        step = []
        for a in frontier:
            for b in edges.get(a, ()):
                if b not in came and (a, b) != without:
                    came[b] = a
                    step.append(b)
        frontier = step
    if dst not in came or src == dst:
        return None
    path = [dst]
    while path[-1] != src:
        path.append(came[path[-1]])
    return path[::-1]


def ambiguous_paths(relations: DataFrame) -> DataFrame:
    """V2: table pairs joined by more than one route, with two of their routes.

    Works on the table graph of the catalog (one row per pair of related tables); routes are counted
    up to two, never enumerated.
    """
    pairs = _table_edges(relations)
    edges: dict[str, list[str]] = {}
    for a, b in pairs:
        edges.setdefault(a, []).append(b)
    rows = []
    for src in sorted(edges):
        for dst in sorted({b for _, b in pairs} - {src}):
            two = _has_other_route(edges, src, dst)
            if two:
                rows.append((src, dst, *sorted(">".join(p) for p in two)))
    return relations.sparkSession.createDataFrame(rows, "src string, dst string, via string, other_via string")


def cycles(relations: DataFrame) -> DataFrame:
    """V3: circular relationships: each strongly connected group of tables with one witness cycle through
    its smallest table (tables of a group all reach each other)."""
    pairs = _table_edges(relations)
    edges: dict[str, list[str]] = {}
    back: dict[str, list[str]] = {}
    for a, b in pairs:
        edges.setdefault(a, []).append(b)
        back.setdefault(b, []).append(a)

    def reach(graph, start):
        seen, stack = set(), [start]
        while stack:
            for b in graph.get(stack.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    stack.append(b)
        return seen

    rows, done = [], set()
    for t in sorted(edges):
        if t in done:
            continue
        group = reach(edges, t) & reach(back, t)
        if t not in group:
            continue
        done |= group
        inside = {a: [b for b in bs if b in group] for a, bs in edges.items() if a in group}
        ways = [_shortest(inside, b, t, None) for b in inside[t]]
        best = min((w for w in ways if w), key=lambda w: (len(w), w))
        rows.append((t, ",".join(sorted(group)), ">".join([t, *best])))
    return relations.sparkSession.createDataFrame(rows, "start string, tables string, cycle string")


def unused_tables(tables: DataFrame, relations: DataFrame, metric_tables: DataFrame | None = None) -> DataFrame:
    """V4: tables with no relation at either end and no metric."""
    used = (relations.select(F.col("from_table").alias("table_name"))
            .unionByName(relations.select(F.col("to_table").alias("table_name"))))
    if metric_tables is not None:
        used = used.unionByName(metric_tables.select("table_name"))
    return tables.select("table_name").distinct().join(used.distinct(), "table_name", "left_anti")


def _tokens_without(name, drop_regex: str):
    parts = F.split(F.lower(name), "_")
    return F.array_join(F.filter(parts, lambda p: ~p.rlike(drop_regex) & (p != F.lit(""))), "_")


def naming_check(columns: DataFrame, relations: DataFrame | None = None,
                 pk: DataFrame | None = None) -> DataFrame:
    """V5: date columns start with ``date``; date keys start with ``date`` and end with
    ``key``; a fact FK has exactly the PK name of its dimension. Each violation comes
    with the suggested name."""
    low = F.lower("column_name")
    has_date = low.rlike("(^|_)date(_|$)")
    is_key = low.rlike("_(key|id|sk)$")
    date_type = F.lower("data_type").rlike("^(date|timestamp)")
    date_key = has_date & is_key
    date_col = (has_date | date_type) & ~is_key
    middle = _tokens_without(F.col("column_name"), "^(date|key|id|sk)$")
    date_col_bad = date_col & ~low.startswith("date")
    date_key_bad = date_key & ~(low.startswith("date") & low.endswith("key"))
    sugg_col = F.when(middle == "", F.lit("date")).otherwise(F.concat(F.lit("date_"), middle))
    sugg_key = F.when(middle == "", F.lit("date_key")).otherwise(F.concat(F.lit("date_"), middle, F.lit("_key")))
    v = columns.select(
        "table_name", "column_name",
        F.when(date_key_bad, F.lit("date key must start with date and end with key"))
        .when(date_col_bad, F.lit("date column must start with date")).alias("rule"),
        F.when(date_key_bad, sugg_key).when(date_col_bad, sugg_col).alias("suggestion")).where(F.col("rule").isNotNull())
    if relations is not None and pk is not None:
        p = pk.select(F.col("table_name").alias("to_table"), F.col("column_name").alias("pk_name"))
        fk = (relations.join(p, "to_table").where(F.col("from_column") != F.col("pk_name"))
              .select(F.col("from_table").alias("table_name"), F.col("from_column").alias("column_name"),
                      F.lit("foreign key must equal the primary key name").alias("rule"),
                      F.col("pk_name").alias("suggestion")))
        v = v.unionByName(fk)
    return v


def schema_coverage(declared: DataFrame, built: DataFrame) -> DataFrame:
    """V6: declared (table_name, column_name) not built, and built but not declared."""
    d = declared.select("table_name", "column_name").distinct()
    b = built.select("table_name", "column_name").distinct()
    return (d.join(b, ["table_name", "column_name"], "left_anti").withColumn("issue", F.lit("declared, not built"))
            .unionByName(b.join(d, ["table_name", "column_name"], "left_anti")
                         .withColumn("issue", F.lit("built, not declared"))))


def modelling_flags(cardinality: DataFrame, roles: DataFrame) -> DataFrame:
    """V7: many-to-many relations and dimension -> dimension (snowflake) relations."""
    r = roles.select("table_name", "role")
    x = (cardinality.join(r.withColumnsRenamed({"table_name": "from_table", "role": "from_role"}), "from_table", "left")
         .join(r.withColumnsRenamed({"table_name": "to_table", "role": "to_role"}), "to_table", "left"))
    m2m = x.where(F.col("cardinality") == "many-to-many").select(*REL, F.lit("many-to-many").alias("flag"))
    snow = (x.where((F.col("from_role") == "dimension") & (F.col("to_role") == "dimension"))
            .select(*REL, F.lit("snowflake").alias("flag")))
    return m2m.unionByName(snow)


def relations_match(plan: DataFrame, model: DataFrame) -> DataFrame:
    """V8: relations planned but not built and built but not planned (with multiplicity)."""
    p, m = plan.select(*REL), model.select(*REL)
    return (p.exceptAll(m).withColumn("issue", F.lit("planned, not built"))
            .unionByName(m.exceptAll(p).withColumn("issue", F.lit("built, not planned"))))
