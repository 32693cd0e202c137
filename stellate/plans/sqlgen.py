"""Oracle SQL text for the profiling queries, written from the static table schemas.

This writes plain SQL strings for the DuckDB comparison only; no Spark plan is built here.
"""

from __future__ import annotations

from stellate.functions.types import DATE, NUMERIC, STRING, family_of_name
from stellate.operators.profile import DIMENSION_SUFFIXES
from stellate.plans.schemas import SCHEMAS


def _role(name: str, fam: str) -> str:
    low = name.lower()
    id_like = low == "id" or any(low.endswith(s) for s in DIMENSION_SUFFIXES)
    return "measure" if fam == NUMERIC and not id_like else "dimension"


def _fam(t: str) -> str:
    if t.startswith("array"):
        return "other"
    return family_of_name(t)


def _text(c: str, t: str) -> str:
    if t == "boolean":
        return f"CASE WHEN {c} THEN 'true' ELSE 'false' END"
    if t.startswith("array"):
        return f"to_json({c})::VARCHAR"
    return f"CAST({c} AS VARCHAR)"


def profile_sql(table: str, digits: int | None = 6) -> str:
    def r(x):
        return f"round({x} * 1e{digits} + 1e-4) / 1e{digits}" if digits is not None else x

    parts = []
    for i, (c, t) in enumerate(SCHEMAS[table], start=1):
        fam = _fam(t)
        q = f'"{c}"'
        nd, ns, ni = "NULL::DOUBLE", "NULL::VARCHAR", "NULL::INTEGER"
        mn = mx = mean = sd = p25 = med = p75 = nd
        mind = maxd = ns
        rng = ni
        minl = maxl = ni
        avgl = nd
        if fam == NUMERIC:
            mn, mx = f"MIN({q})::DOUBLE", f"MAX({q})::DOUBLE"
            mean, sd = r(f"AVG({q}::DOUBLE)"), r(f"STDDEV_SAMP({q}::DOUBLE)")
            p25 = r(f"quantile_cont({q}::DOUBLE, 0.25)")
            med = r(f"quantile_cont({q}::DOUBLE, 0.5)")
            p75 = r(f"quantile_cont({q}::DOUBLE, 0.75)")
        elif fam == DATE:
            mind, maxd = f"CAST(MIN({q}) AS VARCHAR)", f"CAST(MAX({q}) AS VARCHAR)"
            rng = f"CAST(date_diff('day', MIN({q}), MAX({q})) AS INTEGER)"
        elif fam == STRING:
            minl, maxl = f"CAST(MIN(length({q})) AS INTEGER)", f"CAST(MAX(length({q})) AS INTEGER)"
            avgl = r(f"AVG(length({q})::DOUBLE)")
        dc = f"COUNT(DISTINCT {_text(q, t)})"
        parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name, {i} AS ordinal,
  '{t.upper()}' AS data_type, COUNT(*) AS total_rows, COUNT({q}) AS non_null_count,
  COUNT(*) - COUNT({q}) AS null_count,
  ROUND((COUNT(*) - COUNT({q})) / GREATEST(COUNT(*), 1) * 100.0, 2) AS null_pct,
  {dc} AS distinct_count,
  {mn} AS min_val, {mx} AS max_val, {mean} AS mean_val, {sd} AS stddev_val,
  {p25} AS p25, {med} AS median, {p75} AS p75,
  {mind} AS min_date, {maxd} AS max_date, {rng} AS date_range_days,
  {minl} AS min_length, {maxl} AS max_length, {avgl} AS avg_length,
  '{_role(c, fam)}' AS column_role
FROM {table}""")
    return "\nUNION ALL\n".join(parts)


def frequencies_sql(table: str, include_nested: bool = True) -> str:
    parts = []
    for c, t in SCHEMAS[table]:
        if not include_nested and _fam(t) == "other":
            continue
        q = f'"{c}"'
        parts.append(f"SELECT '{c}' AS column_name, {_text(q, t)} AS value, COUNT(*) AS frequency "
                     f"FROM {table} WHERE {q} IS NOT NULL GROUP BY 1, 2")
    return "\nUNION ALL\n".join(parts)


def top_values_sql(table: str, limit: int = 10, threshold: int = 1000) -> str:
    return f"""WITH f AS ({frequencies_sql(table, include_nested=False)}),
d AS (SELECT column_name, COUNT(*) AS dc FROM f GROUP BY column_name)
SELECT '{table}' AS table_name, column_name, rank, value, frequency FROM (
  SELECT f.column_name, f.value, f.frequency,
         CAST(ROW_NUMBER() OVER (PARTITION BY f.column_name ORDER BY f.frequency DESC, f.value ASC) AS INTEGER) AS rank
  FROM f JOIN d ON f.column_name = d.column_name WHERE d.dc <= {threshold}) x
WHERE rank <= {limit}"""
