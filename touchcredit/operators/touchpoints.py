"""O13 channel flags and O14 touchpoint labelling.

Sessions are joined to converting sessions, collapsed over the labelling
columns, then scanned per blended user in start order for the next
conversion time and the session sequence; sessions without a conversion at
or after their start are dropped (open cycles).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..functions.columns import is_non_direct, is_paid, non_null_key, null_str
from ..plans import chunked as ck
from .sessions import MULT, attach_event_count, session_counts

# Session-side labelling columns.  The reference groups the joined rows by 27
# columns; the converting-session columns among them depend on session_id
# alone, so grouping the session side by these 13 is the same grouping.
SESSION_KEYS = (
    "blended_user_id", "session_id", "session_start_ts", "session_end_ts", "utm_source", "utm_medium",
    "utm_campaign", "referrer_host", "channel", "city", "continent", "country", "region",
)

TOUCH_ORDER = ck.Order(("session_start_ts", "session_id", "utm_source", "session_end_ts"))

TOUCHPOINT_COLUMNS = (
    "blended_user_id", "session_id", "session_start_ts", "session_end_ts", "converted_ts", "min_converted_ts",
    "count_conversions", "count_order_conversions", "count_first_order_conversions",
    "count_repeat_order_conversions", "count_registration_conversions", "conversion_session", "conversion_event",
    "order_conversion_event", "registration_conversion_event", "first_order_conversion_event",
    "repeat_order_conversion_event", "utm_source", "utm_content", "utm_medium", "utm_campaign", "referrer_host",
    "channel", "is_non_direct_channel", "is_paid_channel", "events", "first_order_revenue", "repeat_order_revenue",
    "city", "continent", "country", "region", "conversion_cycle_conversion_ts", "session_seq",
)

_C_COLS = ("converted_ts", "min_converted_ts", "count_conversions", "count_order_conversions",
           "count_first_order_conversions", "count_repeat_order_conversions", "count_registration_conversions",
           "first_order_revenue", "repeat_order_revenue")


def channel_flags(df: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                  source: str = "utm_source", medium: str = "utm_medium") -> DataFrame:
    """``is_non_direct_channel`` and ``is_paid_channel``."""
    return df.withColumns({"is_non_direct_channel": is_non_direct(F.col(source), cfg),
                           "is_paid_channel": is_paid(F.col(medium), cfg)})


def _join_conversions(s: DataFrame, conv: DataFrame, cfg: AttributionConfig, heavy: ck.Heavy | None) -> DataFrame:
    """Sessions with the conversions of their session id (of the user's session id, if so configured)."""
    keys = ["session_id"] if cfg.session_key == "session" else ["blended_user_id", "session_id"]
    known = conv.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(x).alias(f"c_{x}") for x in _C_COLS])

    def key(prefix: str) -> Column:
        """Text of the key; the id is a number, so the parts cannot run into each other.  NULL if a part is."""
        return F.concat(F.lit("1"), F.col(f"{prefix}session_id").cast("string"),
                        *[F.concat(F.lit(" "), F.col(f"{prefix}{k}")) for k in keys[:-1]])

    # NULL ids never match.  They get a hash of their row as key, which no
    # conversion has, instead of all hashing to one task.
    nowhere = F.concat(F.lit("0"), F.xxhash64(*SESSION_KEYS).cast("string"))
    names = [f"_{k}" for k in keys]
    known = known.filter(key("_").isNotNull())
    return ck.join_unique(s, known, F.coalesce(key(""), nowhere), key("_"), heavy, distinct=True).drop(*names)


def label_touchpoints_chunked(sessions: DataFrame, conv: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                              heavy: dict[str, ck.Heavy | None] | None = None) -> ck.Ordered:
    """O14 on the skew-safe plan; keeps the ``_ck_`` columns for later passes.

    ``sessions``: blended sessions with ends and multiplicity ``_mult``
    (sessions.with_session_end + identity.blend_ordered).  ``heavy``: the ``user`` and ``session``
    keys with more than ``cfg.chunk_rows`` rows; counted from ``sessions`` if not given.
    """
    key = non_null_key(F.col("blended_user_id"))
    if heavy is None:
        heavy = ck.heavy_by_kind({"user": ck.key_counts(sessions, key), "session": session_counts(sessions)},
                                 cfg.chunk_rows)
    by_session = heavy["session"] if cfg.session_key == "session" else None
    # Rows are collapsed behind the join, inside the exchange by user: what it
    # adds depends on the session alone, so the groups are those of SESSION_KEYS.
    j = ck.arrange(_join_conversions(sessions.select(*SESSION_KEYS, MULT), conv, cfg, by_session), key,
                   TOUCH_ORDER, list(SESSION_KEYS), MULT, heavy["user"], cfg.chunk_rows)

    def times_mult(x):
        return F.coalesce(F.col(MULT) * F.col(f"c_{x}"), F.lit(0).cast("long"))

    def event_flag(x):
        return F.when(F.col(f"c_{x}") > 0, F.lit(1)).otherwise(F.lit(0))

    labelled = j.each(lambda d: d.select(
        *ck.internal(d), *SESSION_KEYS,
        F.col("c_converted_ts").alias("converted_ts"),
        F.col("c_min_converted_ts").alias("min_converted_ts"),
        times_mult("count_conversions").alias("count_conversions"),
        times_mult("count_order_conversions").alias("count_order_conversions"),
        times_mult("count_first_order_conversions").alias("count_first_order_conversions"),
        times_mult("count_repeat_order_conversions").alias("count_repeat_order_conversions"),
        times_mult("count_registration_conversions").alias("count_registration_conversions"),
        F.coalesce(F.col("c_count_conversions") > 0, F.lit(False)).alias("conversion_session"),
        event_flag("count_conversions").alias("conversion_event"),
        event_flag("count_order_conversions").alias("order_conversion_event"),
        event_flag("count_registration_conversions").alias("registration_conversion_event"),
        event_flag("count_first_order_conversions").alias("first_order_conversion_event"),
        event_flag("count_repeat_order_conversions").alias("repeat_order_conversion_event"),
        null_str().alias("utm_content"),
        is_non_direct(F.col("utm_source"), cfg).alias("is_non_direct_channel"),
        is_paid(F.col("utm_medium"), cfg).alias("is_paid_channel"),
        F.col("c_first_order_revenue").alias("first_order_revenue"),
        F.col("c_repeat_order_revenue").alias("repeat_order_revenue"),
    ))
    scanned = ck.ordered_scan(labelled, TOUCH_ORDER, row_number="session_seq",
                              next_non_null={"conversion_cycle_conversion_ts": "converted_ts"})
    return scanned.filter(F.col("conversion_cycle_conversion_ts") >= F.col("session_start_ts"))


def label_touchpoints(sessions: DataFrame, conv: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                      event_counts: DataFrame | None = None,
                      heavy: dict[str, ck.Heavy | None] | None = None) -> DataFrame:
    """O14 output: 34 columns (``events`` NULL unless ``event_counts`` is given)."""
    tp = label_touchpoints_chunked(sessions, conv, cfg, heavy).rows()
    if event_counts is not None:
        tp = attach_event_count(tp, event_counts, (heavy or {}).get("session"))
    else:
        tp = tp.withColumn("events", F.lit(None).cast("long"))
    return tp.select(*TOUCHPOINT_COLUMNS)
