"""O18 time-decay scores, O19 cycle channel flags, O20-O27 model weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..functions.columns import div0, non_null_long, nulls_last_key
from ..plans import chunked as ck

CHANNEL_FLAG_COLUMNS = (
    "is_first_non_direct_channel_in_conversion_cycle", "is_last_non_direct_channel_in_conversion_cycle",
    "is_conversion_cycle_with_non_direct", "is_first_paid_channel_in_conversion_cycle",
    "is_last_paid_channel_in_conversion_cycle", "is_conversion_cycle_with_paid",
)

WEIGHT_COLUMNS = (
    "last_click_attrib_pct", "last_non_direct_click_attrib_pct", "last_paid_click_attrib_pct",
    "first_click_attrib_pct", "first_non_direct_click_attrib_pct", "first_paid_click_attrib_pct",
    "even_click_attrib_pct", "time_decay_attrib_pct",
)


def _counted(cfg: AttributionConfig):
    """Sessions that count toward splits: all, or non-converting ones only."""
    return F.lit(True) if cfg.include_conversion_session else ~F.col("conversion_session")


def day_session_counts(cfg: AttributionConfig = DEFAULT_CONFIG) -> dict:
    """Per (user, start day) count of session ids that split time-decay scores."""
    day_key = non_null_long(F.unix_date(F.to_date(F.col("session_start_ts"))))
    return {"group": day_key,
            "aggs": {"_day_sessions": (F.count(F.when(_counted(cfg), F.col("session_id"))), "sum")}}


def time_decay_scores(df: ck.Ordered, cfg: AttributionConfig = DEFAULT_CONFIG) -> ck.Ordered:
    """Score, weighting, sessions per user-day, split weighting, apportioned score.

    ``cfg.time_decay_direction == "reference"`` scores 2^(days-1)/divisor,
    which grows with age; "recent" scores 2^(-days)/divisor.  The per-day
    session count covers the user's sessions of that calendar day across all
    cycles; a converting session always counts as 1.
    """
    if "_day_sessions" in df.columns:
        per_day = df
    else:
        counts = day_session_counts(cfg)
        per_day = ck.group_stats(df, counts["group"], counts["aggs"])
    days = F.col("days_before_conversion")
    exponent = days - 1 if cfg.time_decay_direction == "reference" else -days
    power = F.pow(F.lit(2.0), exponent)
    divisor = F.nullif(F.lit(float(cfg.time_decay_divisor)), F.lit(0.0))
    conv = F.col("conversion_session")
    out = per_day.withColumns({
        "time_decay_score": F.when(F.col("is_within_attribution_time_decay_days_window"), power / divisor),
        "weighting": F.when(conv, F.lit(1.0)).otherwise(power),
        "sessions_within_day_to_conversion": F.when(conv, F.lit(1).cast("long")).otherwise(F.col("_day_sessions")),
        "weighting_split_by_days_sessions": F.when(conv, F.lit(1.0)).otherwise(div0(power, F.col("_day_sessions"))),
    })
    out = out.withColumn("apportioned_time_decay_score",
                         F.col("time_decay_score") / F.nullif(F.col("sessions_within_day_to_conversion"), F.lit(0)))
    return out.drop("_day_sessions")


def cycle_stats(df: ck.Ordered, cfg: AttributionConfig = DEFAULT_CONFIG) -> ck.Ordered:
    """Per-cycle first/last qualifying sessions, counts and score sum, one pass."""
    order = nulls_last_key(F.col("session_start_ts"), F.col("session_id"))
    lb = F.col("is_within_attribution_lookback_window") & _counted(cfg)
    sid_ok = F.col("session_id").isNotNull()
    nd = lb & (F.col("is_non_direct_channel") == True)  # noqa: E712  (NULL-aware)
    paid = lb & (F.col("is_paid_channel") == True)  # noqa: E712
    return ck.group_stats(df, F.col("user_conversion_cycle").cast("long"), {
        "_first_nd": (F.min(F.when(nd & sid_ok, order)), "min"),
        "_last_nd": (F.max(F.when(nd & sid_ok, order)), "max"),
        "_n_nd": (F.count(F.when(nd, F.lit(1))), "sum"),
        "_first_paid": (F.min(F.when(paid & sid_ok, order)), "min"),
        "_last_paid": (F.max(F.when(paid & sid_ok, order)), "max"),
        "_n_paid": (F.count(F.when(paid, F.lit(1))), "sum"),
        "_first_lb": (F.min(F.when(lb & sid_ok, order)), "min"),
        "_last_lb": (F.max(F.when(lb & sid_ok, order)), "max"),
        "_n_lb": (F.count(F.when(lb, F.col("session_id"))), "sum"),
        "_sum_apportioned": (F.sum(F.when(_counted(cfg), F.col("apportioned_time_decay_score"))), "sum"),
    })


def _is(stat: str) -> F.Column:
    return F.coalesce(F.col(stat)["_v1"] == F.col("session_id"), F.lit(False))


def cycle_channel_flags(stats: ck.Ordered) -> ck.Ordered:
    """first/last/any non-direct and paid session in the cycle's look-back."""
    return stats.withColumns({
        "is_first_non_direct_channel_in_conversion_cycle": _is("_first_nd"),
        "is_last_non_direct_channel_in_conversion_cycle": _is("_last_nd"),
        "is_conversion_cycle_with_non_direct": F.col("_n_nd") > 0,
        "is_first_paid_channel_in_conversion_cycle": _is("_first_paid"),
        "is_last_paid_channel_in_conversion_cycle": _is("_last_paid"),
        "is_conversion_cycle_with_paid": F.col("_n_paid") > 0,
    })


def model_weights(flags: ck.Ordered, cfg: AttributionConfig = DEFAULT_CONFIG) -> ck.Ordered:
    """The eight attribution weights per session.

    Click models give 1 to one session of the cycle's look-back (first or
    last; non-direct and paid fall back to first/last click when the cycle
    has none).  Linear splits evenly over look-back sessions; time decay
    normalises apportioned scores inside the decay window and is NULL
    outside it.  With ``include_conversion_session=False`` converting
    sessions get 0 and the credit of every model is shared among the others.
    """
    excluded = F.col("conversion_session") & F.lit(not cfg.include_conversion_session)
    last_click = _is("_last_lb")
    first_click = _is("_first_lb")

    def click(primary, with_col, fallback):
        return F.when(excluded, F.lit(0)).otherwise(
            F.when(F.col(primary), F.lit(1)).when(~F.col(with_col) & fallback, F.lit(1)).otherwise(F.lit(0)))

    lb = F.col("is_within_attribution_lookback_window")
    out = flags.withColumns({
        "last_click_attrib_pct": F.when(excluded, F.lit(0)).otherwise(F.when(last_click, F.lit(1)).otherwise(F.lit(0))),
        "last_non_direct_click_attrib_pct": click("is_last_non_direct_channel_in_conversion_cycle",
                                                  "is_conversion_cycle_with_non_direct", last_click),
        "last_paid_click_attrib_pct": click("is_last_paid_channel_in_conversion_cycle",
                                            "is_conversion_cycle_with_paid", last_click),
        "first_click_attrib_pct": F.when(excluded, F.lit(0)).otherwise(F.when(first_click, F.lit(1)).otherwise(F.lit(0))),
        "first_non_direct_click_attrib_pct": click("is_first_non_direct_channel_in_conversion_cycle",
                                                   "is_conversion_cycle_with_non_direct", first_click),
        "first_paid_click_attrib_pct": click("is_first_paid_channel_in_conversion_cycle",
                                             "is_conversion_cycle_with_paid", first_click),
        "even_click_attrib_pct": F.when(excluded, F.lit(0.0)).otherwise(
            F.when(lb, div0(F.lit(1.0), F.col("_n_lb"))).otherwise(F.lit(0.0))),
        "time_decay_attrib_pct": F.when(excluded, F.lit(0.0)).otherwise(
            F.when(F.col("is_within_attribution_time_decay_days_window"),
                   F.col("apportioned_time_decay_score") / F.nullif(F.col("_sum_apportioned"), F.lit(0.0)))),
    })
    return out.drop("_first_nd", "_last_nd", "_n_nd", "_first_paid", "_last_paid", "_n_paid", "_first_lb",
                    "_last_lb", "_n_lb", "_sum_apportioned")
