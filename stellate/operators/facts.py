"""Dimension lookups and fact loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.functions import clean as C
from stellate.operators.asof import as_of_join, hourly
from stellate.operators.discovery import uniqueness

def _keys(x):
    return [x] if isinstance(x, str) else list(x)


def enrich(df: DataFrame, secondary: DataFrame, on, how: str = "left") -> DataFrame:
    """LEFT join a secondary source; no row of ``df`` is dropped."""
    return df.join(secondary, on, how)


def lookup_key(fact: DataFrame, dim: DataFrame, fact_on, dim_on, key_name: str,
               required: bool = False, attributes=()) -> DataFrame:
    """J1 (J4 when ``required``, J6 with ``attributes``): bring a dimension's surrogate
    key (and attributes) onto fact rows by natural key.

    LEFT by default: unresolved rows keep a NULL key and are never dropped. The join
    strategy is left to AQE: it broadcasts a dimension whose measured bytes are under
    ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed fact keys otherwise.
    """
    fk, dk = _keys(fact_on), _keys(dim_on)
    d = dim.select(*[F.col(c).alias(f"_lk{i}") for i, c in enumerate(dk)], F.col(key_name),
                   *[F.col(a) for a in attributes])
    cond = None
    for i, c in enumerate(fk):
        e = fact[c] == d[f"_lk{i}"]
        cond = e if cond is None else cond & e
    return fact.join(d, cond, "inner" if required else "left").drop(*[f"_lk{i}" for i in range(len(dk))])


def lookup_all(fact: DataFrame, relations) -> DataFrame:
    """Every relation joined in turn: ``relations`` = iterable of
    (dim_df, fact_on, dim_on, key_name)."""
    out = fact
    for dim, fon, don, key in relations:
        out = lookup_key(out, dim, fon, don, key)
    return out


def fan_out_guard(fact: DataFrame, dim: DataFrame, fact_on, dim_on) -> DataFrame:
    """Row counts before and after a LEFT lookup and the duplicate keys on the right.

    One row: rows_before, rows_after, duplicate_keys, ok. rows_after is computed
    without running the join: sum over fact keys of max(1, matches of that key).
    """
    fk, dk = _keys(fact_on), _keys(dim_on)
    right = dim.groupBy(*[F.col(a).alias(b) for a, b in zip(dk, fk)]).agg(F.count(F.lit(1)).alias("_m"))
    per_key = fact.groupBy(*fk).agg(F.count(F.lit(1)).alias("_f"))
    j = per_key.join(right, fk, "left")
    u = uniqueness(dim, dk).select("duplicate_keys")
    counts = j.agg(F.sum("_f").cast("bigint").alias("rows_before"),
                   F.sum(F.col("_f") * F.greatest(F.coalesce("_m", F.lit(1)), F.lit(1))).cast("bigint")
                   .alias("rows_after"))
    dup = u.first()[0]  # one scalar
    return counts.select("rows_before", "rows_after", F.lit(dup).cast("bigint").alias("duplicate_keys"),
                         (F.col("rows_before") == F.col("rows_after")).alias("ok"))


# ------------------------------------------------------------------ L1
@dataclass(frozen=True)
class FactSpec:
    name: str
    columns: dict                        # target column -> Column (in target order)
    lookups: tuple = ()                  # (dim_df, fact_on, dim_on, key_name)
    soft_delete: str | None = None
    status: str | None = None
    keep_null_status: bool = True
    required_key: tuple = ()
    predicate: Column | None = None      # own filter (e.g. chapter vs membership)
    enrich: tuple = ()                   # (df, on) LEFT joined before the projection
    schema: object = None                # C16 target StructType


def load_fact(src: DataFrame, spec: FactSpec) -> DataFrame:
    """L1: F3-F5 -> J3 -> own predicate (Catalyst pushes what it can below the join) -> J2 ->
    C* expressions -> F1 -> C16."""
    x = src
    if spec.soft_delete:
        x = C.soft_delete_filter(x, spec.soft_delete)
    if spec.required_key:
        x = C.require_key(x, list(spec.required_key))
    if spec.status:
        x = C.active_filter(x, spec.status, keep_null=spec.keep_null_status)
    for df, on in spec.enrich:
        x = enrich(x, df, on)
    if spec.predicate is not None:
        x = x.where(spec.predicate)
    x = lookup_all(x, spec.lookups)
    x = x.select(*[C.col(v).alias(k) for k, v in spec.columns.items()])
    if spec.schema is not None:
        x = C.cast_to_schema(x, spec.schema)
    return x


def membership_term_fact(log: DataFrame, product: DataFrame, prefix: str = "membership",
                         first_keys=("membership_type_key", "product_key"), last_key: str = "memberships_key",
                         predicate: Column | None = None) -> DataFrame:
    """L2: one row per membership term log entry, in the target's columns and order. Start =
    effective date else join date (C7); end, grace; quantity 1, amount 0; keys not resolvable
    from the source stay NULL."""
    p = product.select(F.col("id").alias("_pid"), *[c for c in product.columns if c != "id"])
    spec = FactSpec(
        name=f"fact_{prefix}s",
        columns={
            f"{prefix}_quantity": C.typed_const(1, "decimal(18,4)"),
            f"{prefix}_amount": C.typed_const(0, "decimal(18,4)"),
            f"{prefix}_start_date": C.guarded_date("effectivedate", "joindate"),
            f"{prefix}_end_date": C.guarded_date("expiredate"),
            f"{prefix}_grace_date": C.guarded_date("terminatedate"),
            **{k: C.typed_null("bigint")
               for k in (*first_keys, "individual_key", "company_key", "geography_key", last_key)},
        },
        soft_delete="isdeleted", status="meta_record_status", required_key=("id",),
        predicate=predicate,
        enrich=((p, F.col("membershipproductid") == F.col("_pid")),),
    )
    return load_fact(log, spec)


def chapter_membership_fact(log: DataFrame, product: DataFrame) -> DataFrame:
    """L3: the same load for terms of chapter products (``ischapter``), with its own keys."""
    return membership_term_fact(log, product, "chapter_membership", ("chapter_key",), "chapter_memberships_key",
                                F.coalesce(F.col("ischapter"), F.lit(False)))


# ------------------------------------------------------------------ L6-L8
def pivot_counts(df: DataFrame, by, pivot_col: str, values, prefix: str = "n_") -> DataFrame:
    """Per-entity counts of each type, one column per listed value (fixed list, so
    no extra job to find the values)."""
    by = _keys(by)
    p = df.groupBy(*by).pivot(pivot_col, list(values)).agg(F.count(F.lit(1)))
    return p.select(*by, *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(f"{prefix}{v}") for v in values])


def discussion_rollup(posts: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """Posts per discussion, first and last position."""
    return posts.groupBy(conv).agg(F.count(F.lit(1)).alias("post_count"),
                                   F.min(order).alias("first_turn"), F.max(order).alias("last_turn"),
                                   F.count_distinct("role").alias("participant_roles"))


# ------------------------------------------------------------------ L9, L10
def ordered_neighbours(df: DataFrame, entity: str, ts: str, tiebreak: str, bucket: Column) -> DataFrame:
    """Previous and next row per entity in (ts, tiebreak) order, plus the row's position.

    Skew-safe: windows run per (entity, bucket) - ``bucket`` is a coarse time slice -
    so one entity holding a third of all rows is still spread over many tasks. Rows
    at a bucket edge take their neighbour from a small per-(entity, bucket) summary
    (first/last row and row count), whose per-entity windows see one row per bucket.
    Adds: _prev_ts, _next_ts, _seq (1-based position within the entity).
    """
    x = df.withColumn("_b", bucket)
    w = Window.partitionBy(entity, "_b").orderBy(ts, tiebreak)
    x = (x.withColumn("_lp", F.lag(ts).over(w)).withColumn("_ln", F.lead(ts).over(w))
         .withColumn("_li", F.row_number().over(w)))
    summ = x.groupBy(entity, "_b").agg(F.min(F.struct(ts, tiebreak)).alias("_first"),
                                       F.max(F.struct(ts, tiebreak)).alias("_last"),
                                       F.count(F.lit(1)).alias("_cnt"))
    wb = Window.partitionBy(entity).orderBy("_b")
    summ = summ.select(entity, "_b",
                       F.lag("_last").over(wb)[ts].alias("_bp"),
                       F.lead("_first").over(wb)[ts].alias("_bn"),
                       F.coalesce(F.sum("_cnt").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                       .alias("_before"))
    x = x.join(summ, [entity, "_b"])
    return (x.withColumn("_prev_ts", F.coalesce("_lp", "_bp")).withColumn("_next_ts", F.coalesce("_ln", "_bn"))
            .withColumn("_seq", F.col("_before") + F.col("_li"))
            .drop("_lp", "_ln", "_li", "_bp", "_bn", "_before"))


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts", tiebreak: str = "event_id",
               gap_minutes: int = 30, bucket: Column | None = None, keep_bucket: bool = False) -> DataFrame:
    """L9 building block: session number per user; a new session starts when the gap to
    the previous event exceeds ``gap_minutes``. Adds session_no (1-based) and seq; with
    ``keep_bucket`` also the time bucket ``_b`` and ``_new`` (1 at a session's first row).

    The session number is a running count of session starts; it is computed per
    (user, bucket) and offset by the starts of earlier buckets (small summary).
    """
    # hour slices: a user with a third of all events still spreads over thousands of tasks
    bucket = bucket if bucket is not None else F.date_trunc("hour", F.col(ts))
    x = ordered_neighbours(events, user, ts, tiebreak, bucket)
    gap = C.seconds_between("_prev_ts", ts)
    x = x.withColumn("_new", (F.col("_prev_ts").isNull() | (gap > gap_minutes * 60)).cast("int"))
    w = Window.partitionBy(user, "_b").orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_local", F.sum("_new").over(w))
    starts = x.groupBy(user, "_b").agg(F.sum("_new").alias("_s"))
    wb = Window.partitionBy(user).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(user, "_b", F.coalesce(F.sum("_s").over(wb), F.lit(0)).alias("_sb"))
    return (x.join(starts, [user, "_b"])
            .withColumn("session_no", (F.col("_sb") + F.col("_local")).cast("bigint"))
            .drop("_local", "_sb", *([] if keep_bucket else ["_b"])))


def web_sessions(events: DataFrame, gap_minutes: int = 30, **kw) -> DataFrame:
    """One row per session: start date/time/datetime, duration seconds, events."""
    s = sessionize(events, gap_minutes=gap_minutes, **kw)
    g = s.groupBy("user_id", "session_no").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"))
    dur = C.seconds_between("session_start", "session_end")
    return g.select("user_id", "session_no", F.to_date("session_start").alias("session_start_date"),
                    F.date_format("session_start", "HH:mm:ss").alias("session_start_time"),
                    "session_start", F.round(dur, 3).alias("session_duration_seconds"), "event_count")


def page_views(events: DataFrame, gap_minutes: int = 30, **kw) -> DataFrame:
    """Each view with its session, position in the session and seconds to the next
    event of the same session (NULL for the last one).

    The position of a session's first row is a running maximum over the session starts, taken
    per (user, bucket) and carried over from the user's earlier buckets, so a session that never
    pauses is spread over its buckets like any other rows.
    """
    s = sessionize(events, gap_minutes=gap_minutes, keep_bucket=True, **kw)
    start = F.when(F.col("_new") == 1, F.col("_seq"))
    w = Window.partitionBy("user_id", "_b").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_own", F.max(start).over(w))
    wb = Window.partitionBy("user_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (s.groupBy("user_id", "_b").agg(F.max(start).alias("_last"))
               .select("user_id", "_b", F.max("_last").over(wb).alias("_carried")))
    s = s.join(carried, ["user_id", "_b"])
    nxt = C.seconds_between("ts", "_next_ts")
    same = F.col("_next_ts").isNotNull() & (nxt <= gap_minutes * 60)
    return s.select("event_id", "user_id", "session_no", "ts",
                    (F.col("_seq") - F.coalesce("_own", "_carried") + 1).cast("bigint").alias("sequence_in_session"),
                    F.when(same, F.round(nxt, 3)).alias("view_duration_seconds"),
                    "event_type")


# ------------------------------------------------------------------ L11
def event_sessions(events: DataFrame, registration_type: str, gap_minutes: int = 30, user: str = "user_id", ts: str = "ts",
                   event: str = "event_id", kind: str = "event_type", value: str = "value", bucket=hourly) -> DataFrame:
    """L11 (sessions): one row per session with its amount, its opening event and the registration it runs under.

    That registration is the user's latest one at or before the session's start (``asof.as_of_join``, so a user with
    a third of all rows is spread over time buckets); ``session_registration`` is the first one made within the
    session. Events with a NULL user form no session.
    """
    s = sessionize(events, user=user, ts=ts, tiebreak=event, gap_minutes=gap_minutes, bucket=bucket(F.col(ts)))
    opening = F.min(F.struct(F.col(ts).alias("ts"), F.col(event).alias("event"), F.col(kind).alias("kind")))
    sessions = s.groupBy(F.col(user).alias("session_user"), "session_no").agg(
        opening.alias("_o"), F.max(ts).alias("session_end"), F.sum(F.col(value).cast("decimal(18,4)")).alias("session_amount"),
        F.min(F.when(F.col(kind) == registration_type, F.col(ts))).alias("session_registration"))
    sessions = sessions.select("session_user", "session_no", F.col("_o.ts").alias("session_start"), "session_end", F.col("_o.event").alias("opening_event"),
                               F.col("_o.kind").alias("opening_kind"), "session_amount", "session_registration")
    made = events.where(F.col(kind) == registration_type).select(
        F.col(user).alias("registered_user"), F.col(ts).alias("registered_at"), F.col(event).alias("registration_event"))
    return as_of_join(sessions, made, "session_user", "session_start", "registered_at", ["registered_at", "registration_event"],
                      "registration_event", bucket, "registered_user")
