"""O10 converting events, O11 conversion scoring, O12 roll-up per session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..functions.columns import non_null_key, nulls_last_key
from ..plans import chunked as ck
from .identity import blend_users

CONVERTING_COLUMNS = (
    "blended_user_id", "session_id", "event_type", "order_id", "first_order_revenue", "repeat_order_revenue",
    "count_conversions", "count_first_order_conversions", "count_repeat_order_conversions",
    "count_order_conversions", "count_registration_conversions", "converted_ts",
)

CONVERTING_SESSION_COLUMNS = (
    "session_id", "blended_user_id", "first_order_revenue", "repeat_order_revenue",
    "count_first_order_conversions", "count_repeat_order_conversions", "count_order_conversions",
    "count_registration_conversions", "count_conversions", "converted_ts", "min_converted_ts",
)


# Event columns that scoring and roll-up read.
CANDIDATE_COLUMNS = ("event_ts", "event_id", "user_pseudo_id", "event_type", "session_id", "order_value", "order_id")


def conversion_candidates(events: DataFrame, ids: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                          logins: DataFrame | None = None, columns: tuple[str, ...] | None = None,
                          heavy: ck.Heavy | None = None) -> DataFrame:
    """Order and registration events with ``blended_user_id`` (all event columns, or ``columns``).

    The first-registration / first-order lookups only ever read these two
    event types, and only these survive the conversion filter, so filtering
    before the id join keeps every other event out of the shuffles.
    """
    relevant = events.filter(F.col("event_type").isin(cfg.order_event, cfg.registration_event))
    return blend_users(relevant.select(*columns) if columns else relevant, ids, logins, heavy)


def select_converting_events(blended_events: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                             heavy: ck.Heavy | None = None) -> DataFrame:
    """Every order, plus each blended user's first registration.

    Adds ``first_registration_event_id`` and ``first_order_event_id``: the
    first non-NULL event id of that type per blended user, ordered by
    ``event_ts ASC NULLS LAST`` then ``event_id``.  Computed as a grouped min
    of an ordering struct (partial aggregation, so a hot user costs one row
    per task) and joined back on a NULL-safe user key (NULL users are one
    group, as in a window); ``heavy`` users (keys of ``ck.heavy_keys``) take theirs
    from a small broadcast.
    """
    ev = blended_events.withColumn("_uk", non_null_key(F.col("blended_user_id")))

    def first_id(event_type: str):
        cond = (F.col("event_type") == event_type) & F.col("event_id").isNotNull()
        return F.min(F.when(cond, nulls_last_key(F.col("event_ts"), F.col("event_id"))))["_v1"]

    firsts = ev.groupBy("_uk").agg(first_id(cfg.registration_event).alias("first_registration_event_id"),
                                   first_id(cfg.order_event).alias("first_order_event_id"))
    joined = ck.join_unique(ev, firsts.withColumnRenamed("_uk", "_first_of"), F.col("_uk"), F.col("_first_of"),
                            heavy).drop("_uk", "_first_of")
    keep = (F.col("event_type") == cfg.order_event) | (
        (F.col("event_type") == cfg.registration_event)
        & (F.col("event_id") == F.col("first_registration_event_id")))
    return joined.filter(keep)


def score_conversions(converting: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Revenue and count columns per converting event (12 columns)."""
    is_order = F.col("event_type") == cfg.order_event
    is_first_order = is_order & (F.col("event_id") == F.col("first_order_event_id"))
    is_repeat_order = is_order & (F.col("event_id") != F.col("first_order_event_id"))
    is_registration = (F.col("event_type") == cfg.registration_event) & (
        F.col("event_id") == F.col("first_registration_event_id"))

    def flag(c):
        return F.when(c, F.lit(1)).otherwise(F.lit(0))

    return converting.select(
        "blended_user_id", "session_id", "event_type", "order_id",
        F.when(is_first_order, F.col("order_value")).otherwise(F.lit(0.0)).alias("first_order_revenue"),
        F.when(is_repeat_order, F.col("order_value")).otherwise(F.lit(0.0)).alias("repeat_order_revenue"),
        flag(is_order).alias("count_conversions"),
        flag(is_first_order).alias("count_first_order_conversions"),
        flag(is_repeat_order).alias("count_repeat_order_conversions"),
        flag(is_order).alias("count_order_conversions"),
        flag(is_registration).alias("count_registration_conversions"),
        F.col("event_ts").alias("converted_ts"),
    )


def rollup_conversions(scored: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per converting ``session_id`` (NULL id is one group).

    Default key is ``session_id`` alone, so equal ids of two users merge and
    the user is the greater one.  ``cfg.session_key == "user_session"`` keys
    by (blended user, session id) instead.  Partially aggregated.
    """
    keys = ["session_id"] if cfg.session_key == "session" else ["blended_user_id", "session_id"]
    aggs = [
        F.sum("first_order_revenue").alias("first_order_revenue"),
        F.sum("repeat_order_revenue").alias("repeat_order_revenue"),
        F.sum("count_first_order_conversions").alias("count_first_order_conversions"),
        F.sum("count_repeat_order_conversions").alias("count_repeat_order_conversions"),
        F.sum("count_order_conversions").alias("count_order_conversions"),
        F.sum("count_registration_conversions").alias("count_registration_conversions"),
        (F.sum("count_registration_conversions") + F.sum("count_first_order_conversions")
         + F.sum("count_repeat_order_conversions")).alias("count_conversions"),
        F.max("converted_ts").alias("converted_ts"),
        F.min("converted_ts").alias("min_converted_ts"),
    ]
    if cfg.session_key == "session":
        aggs.insert(0, F.max("blended_user_id").alias("blended_user_id"))
    return scored.groupBy(*keys).agg(*aggs).select(*CONVERTING_SESSION_COLUMNS)


def lost_conversions(conv_sessions: DataFrame, session_ids: DataFrame) -> DataFrame:
    """Data-quality report: converting sessions with no ``session_start`` row.

    Their conversions never reach a touchpoint (the join starts from
    sessions).  One row: count of such sessions, their conversions and
    revenue.  ``session_ids``: a ``session_id`` column of session starts.
    A left anti join (NULL ids never match, so they count as lost).
    """
    lost = conv_sessions.join(session_ids.select("session_id").distinct(), "session_id", "left_anti")
    revenue = F.coalesce(F.col("first_order_revenue"), F.lit(0.0)) + F.coalesce(F.col("repeat_order_revenue"),
                                                                                  F.lit(0.0))
    return lost.agg(F.count(F.lit(1)).alias("lost_converting_sessions"),
                    F.coalesce(F.sum("count_conversions"), F.lit(0).cast("long")).alias("lost_conversions"),
                    F.coalesce(F.sum(revenue), F.lit(0.0)).alias("lost_revenue"))
