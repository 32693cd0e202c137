"""Metrics layer.

Time-intelligence metrics aggregate to the period grain first (one row per day or
month per slice), so every window afterwards runs over a small, bounded table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ------------------------------------------------------------------ A1-A5
def baseline_metrics(fact: DataFrame, fact_name: str, measures, business_key: str | None = None,
                     averages=(), digits: int = 4) -> DataFrame:
    """A1-A5: row count, distinct business keys, SUM of each measure and AVG where asked,
    from one wide aggregate, unpivoted to (fact_name, metric, value). No metric twice."""
    aggs = {"row_count": F.count(F.lit(1)).cast("double")}
    if business_key:
        aggs[f"distinct_{business_key}"] = F.count_distinct(business_key).cast("double")
    for m in measures:
        aggs[f"total_{m}"] = F.sum(F.col(m).cast("decimal(38,4)")).cast("double")
    for m in averages:
        aggs[f"avg_{m}"] = F.avg(F.col(m).cast("decimal(38,4)")).cast("double")
    wide = fact.agg(*[v.alias(k) for k, v in aggs.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(fact_name).alias("fact_name"), F.lit(k).alias("metric"),
                 F.round(F.col(k), digits).alias("value")) for k in aggs])))


def measure_columns(df: DataFrame) -> list[str]:
    """A5: the columns that metrics are generated for: measures by type and name."""
    from stellate.functions.types import NUMERIC, type_family
    from stellate.operators.profile import is_dimension_name
    return [f.name for f in df.schema.fields if type_family(f.dataType) == NUMERIC and not is_dimension_name(f.name)]


def generated_metrics(fact: DataFrame, fact_name: str, business_key: str | None = None, digits: int = 4) -> DataFrame:
    """A5: the baseline metrics with their measures taken from the table's metadata."""
    return baseline_metrics(fact, fact_name, measure_columns(fact), business_key, digits=digits)


def per_entity_kpi(fact: DataFrame, entity: str, measure: str | None = None, name: str = "value") -> DataFrame:
    """Per-entity total (or row count), then the average over entities."""
    v = F.sum(F.col(measure).cast("decimal(38,4)")) if measure else F.count(F.lit(1))
    per = fact.groupBy(entity).agg(v.alias("_v"))
    return per.agg(F.round(F.avg("_v").cast("double"), 4).alias(f"{name}_per_{entity}"),
                   F.count(F.lit(1)).alias(f"{entity}_count"))


def average_order_value(fact: DataFrame, amount: str, order_key: str, by=()) -> DataFrame:
    """DIVIDE(total amount, distinct orders); NULL when there are no orders."""
    g = fact.groupBy(*by) if by else fact
    return g.agg(F.round(F.try_divide(F.sum(F.col(amount).cast("decimal(38,4)")),
                                      F.count_distinct(order_key)).cast("double"), 4).alias("avg_order_value"),
                 F.count_distinct(order_key).alias("orders"))


def ratio_kpi(fact: DataFrame, numerator: Column, denominator: Column, name: str, by=()) -> DataFrame:
    """count_if(numerator) / count_if(denominator); zero denominator -> NULL."""
    g = fact.groupBy(*by) if by else fact
    return g.agg(F.count_if(numerator).alias(f"{name}_num"), F.count_if(denominator).alias(f"{name}_den"),
                 F.round(F.try_divide(F.count_if(numerator), F.count_if(denominator)), 6).alias(name))


def pre_aggregate(fact: DataFrame, levels, measures, rollup: bool = False) -> DataFrame:
    """Aggregate to a coarser grain before loading; ``rollup`` adds subtotals along
    the level hierarchy (and a grand total)."""
    levels = list(levels)
    g = fact.rollup(*levels) if rollup else fact.groupBy(*levels)
    return g.agg(F.count(F.lit(1)).alias("row_count"),
                 *[F.sum(F.col(m).cast("decimal(38,4)")).alias(f"total_{m}") for m in measures])


def metric_by_dimension(fact: DataFrame, dims, attrs, measure: str, name: str = "total") -> DataFrame:
    """A10: a base metric sliced by dimension attributes (filter flows dim -> fact).

    ``dims``: iterable of (dim_df, fact_fk, dim_key). Dimensions are joined (AQE picks the
    strategy from measured sizes), then grouped by ``attrs``.
    """
    x = fact
    for dim, fk, dk in dims:
        extra = [a for a in attrs if a in dim.columns and a != dk]
        x = x.join(dim.select(F.col(dk).alias(fk), *extra), fk, "left")
    return x.groupBy(*attrs).agg(F.sum(F.col(measure).cast("decimal(38,4)")).alias(name),
                                 F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------------ A11
@dataclass(frozen=True)
class Metric:
    name: str
    expr: str                 # SQL expression over base metric columns or other metrics
    needs: tuple = ()         # names it depends on


def layered_metrics(base: DataFrame, registry) -> tuple[DataFrame, list]:
    """Metrics defined on other metrics, added in dependency order as columns of
    the (already aggregated) base table. A metric whose inputs are missing is skipped
    and reported with the reason."""
    have = set(base.columns)
    out, skipped = base, []
    pending = list(registry)
    progressed = True
    while pending and progressed:
        progressed = False
        for m in list(pending):
            missing = [n for n in m.needs if n not in have]
            if not missing:
                out = out.withColumn(m.name, F.expr(m.expr))
                have.add(m.name)
                pending.remove(m)
                progressed = True
    for m in pending:
        skipped.append((m.name, "missing " + ", ".join(n for n in m.needs if n not in have)))
    return out, skipped


# ------------------------------------------------------------------ W4-W8
def daily(fact: DataFrame, date_col: str, measure: str, by=()) -> DataFrame:
    """Aggregate to one row per day (and slice): the grain every time window runs on."""
    return (fact.groupBy(*by, F.to_date(date_col).alias("day"))
            .agg(F.sum(F.col(measure).cast("decimal(38,4)")).alias("amount")))


def rolling(daily_df: DataFrame, days: int = 7, by=()) -> DataFrame:
    """Rolling sum over the last ``days`` calendar days (range frame on day number)."""
    dn = F.datediff(F.col("day"), F.lit("1970-01-01"))
    w = Window.partitionBy(*by).orderBy(dn).rangeBetween(-(days - 1), 0)
    return daily_df.withColumn(f"rolling_{days}d", F.sum("amount").over(w))


def to_date_totals(daily_df: DataFrame, by=()) -> DataFrame:
    """MTD, QTD and YTD running totals restarting at each period start."""
    def run(unit):
        return (Window.partitionBy(*by, F.trunc("day", unit)).orderBy("day")
                .rowsBetween(Window.unboundedPreceding, 0))
    return (daily_df.withColumn("mtd", F.sum("amount").over(run("month")))
            .withColumn("qtd", F.sum("amount").over(run("quarter")))
            .withColumn("ytd", F.sum("amount").over(run("year"))))


def period_totals(fact: DataFrame, date_col: str, measure: str, unit: str = "month") -> DataFrame:
    """Per-period totals on a complete calendar spine (gaps become zero-row periods)."""
    p = fact.groupBy(F.trunc(F.to_date(date_col), unit).alias("period")).agg(
        F.sum(F.col(measure).cast("decimal(38,4)")).alias("amount"))
    bounds = p.agg(F.min("period").alias("a"), F.max("period").alias("b")).first()  # two scalars
    if bounds["a"] is None:
        return p
    step = {"month": "1 month", "quarter": "3 months", "year": "1 year"}[unit]
    spine = fact.sparkSession.sql(
        f"SELECT explode(sequence(DATE'{bounds['a']}', DATE'{bounds['b']}', INTERVAL {step})) AS period")
    return spine.join(p, "period", "left")


def prior_period(periods: DataFrame) -> DataFrame:
    """W6 + W7: previous calendar period's value (NULL when that period has no data)
    and growth = (current - previous) / previous (NULL when previous is NULL or 0)."""
    w = Window.orderBy("period")
    prev = F.lag("amount").over(w)
    return (periods.withColumn("prior_amount", prev)
            .withColumn("growth_pct", F.round(F.try_divide(F.col("amount") - F.col("prior_amount"),
                                                           F.col("prior_amount")) * 100, 4).cast("double")))


def share_of_total(agg: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Part / whole. The whole is one scalar aggregate, so no window over all rows."""
    total = agg.agg(F.sum(value)).first()[0]
    return agg.withColumn(name, F.round(F.try_divide(F.col(value), F.lit(total)) * 100, 4).cast("double"))
