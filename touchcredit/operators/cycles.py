"""O15 running conversions, O16 conversion cycles, O17 look-back windows.

All run inside the partitioning by user that the touchpoint scan set up (no
further exchange) on the skew-safe plan (plans.chunked).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..plans import chunked as ck
from .touchpoints import TOUCH_ORDER

RUNNING = {
    "user_total_conversions": "conversion_event",
    "user_total_order_conversions": "count_order_conversions",
    "user_total_registration_conversions": "count_registration_conversions",
    "user_total_first_order_conversions": "count_first_order_conversions",
    "user_total_repeat_order_conversions": "count_repeat_order_conversions",
}

# cycle column -> (running total, this-session event flag)
CYCLES = {
    "user_registration_conversion_cycle": ("user_total_registration_conversions", "registration_conversion_event"),
    "user_conversion_cycle": ("user_total_conversions", "conversion_event"),
    "user_first_order_conversion_cycle": ("user_total_first_order_conversions", "first_order_conversion_event"),
    "user_repeat_order_conversion_cycle": ("user_total_repeat_order_conversions", "repeat_order_conversion_event"),
}

MEASURES = ("count_registration_conversions", "count_first_order_conversions", "count_repeat_order_conversions",
            "first_order_revenue", "repeat_order_revenue")


def running_conversions(tp: ck.Ordered, day_counts: dict | None = None) -> ck.Ordered:
    """Five running totals per blended user in start order (kept touchpoints only).

    ``day_counts`` (from ``weights.day_session_counts``) computes the per-day
    session counts of O18 in the same round; they do not depend on cycles.
    """
    group, aggs = (day_counts["group"], day_counts["aggs"]) if day_counts else (None, None)
    scanned = ck.ordered_scan(tp, TOUCH_ORDER, running_sums=RUNNING, group=group, group_aggs=aggs)
    return scanned.withColumns({c: F.col(c).cast("long") for c in RUNNING})


def conversion_cycles(df: ck.Ordered) -> ck.Ordered:
    """cycle = running total, plus one unless this session converts.

    The running totals never decrease, so the running MAX over them is the
    current value and needs no window.
    """
    return df.withColumns({
        name: F.when(F.col(flag) == 0, F.col(total) + 1).otherwise(F.col(total)).cast("long")
        for name, (total, flag) in CYCLES.items()})


def lookback_windows(df: ck.Ordered, cfg: AttributionConfig = DEFAULT_CONFIG) -> ck.Ordered:
    """Day number, days before the cycle's last session day, window flags.

    The same per-cycle pass also keeps the cycle maxima of the five measures
    (``_cycle_max_*``) that the models multiply later.
    """
    day = F.datediff(F.to_date(F.col("session_start_ts")), F.lit(cfg.epoch_date).cast("date"))
    with_day = df.withColumn("session_day_number", day)
    aggs = {"_cycle_max_day": (F.max("session_day_number"), "max")}
    aggs.update({f"_cycle_max_{m}": (F.max(m), "max") for m in MEASURES})
    stats = ck.group_stats(with_day, F.col("user_conversion_cycle").cast("long"), aggs)
    before = F.col("_cycle_max_day") - F.col("session_day_number")
    return (stats.withColumn("days_before_conversion", before)
            .withColumn("is_within_attribution_lookback_window", F.col("days_before_conversion") <= cfg.lookback_days)
            .withColumn("is_within_attribution_time_decay_days_window",
                        F.col("days_before_conversion") <= cfg.time_decay_days)
            .drop("_cycle_max_day"))
