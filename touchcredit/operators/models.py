"""O28 model application and O29 the long-form attribution table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, MODEL_WEIGHTS, AttributionConfig
from .cycles import MEASURES

OUTPUT_MEASURES = {  # output column -> measure whose cycle maximum is credited
    "user_registration_conversions": "count_registration_conversions",
    "first_order_conversions": "count_first_order_conversions",
    "repeat_order_conversions": "count_repeat_order_conversions",
    "first_order_revenue": "first_order_revenue",
    "repeat_order_revenue": "repeat_order_revenue",
}

OUTPUT_COLUMNS = (
    "model", "blended_user_id", "session_id", "session_start_ts", "session_end_ts", "session_seq",
    "user_conversion_cycle", "is_first_non_direct_channel_in_conversion_cycle",
    "is_last_non_direct_channel_in_conversion_cycle", "is_conversion_cycle_with_non_direct",
    "is_first_paid_channel_in_conversion_cycle", "is_last_paid_channel_in_conversion_cycle",
    "is_conversion_cycle_with_paid", "is_non_direct_channel", "is_paid_channel", "is_conversion_session",
    "utm_source", "utm_medium", "utm_campaign", "referrer_host", "channel", "city", "continent", "country",
    "region", *OUTPUT_MEASURES,
)

_DESCRIPTIVE = [c for c in OUTPUT_COLUMNS if c not in ("model", "is_conversion_session", *OUTPUT_MEASURES)]


def _credited(weight: F.Column) -> list[F.Column]:
    return [(F.col(f"_cycle_max_{m}") * weight).cast("double").alias(out) for out, m in OUTPUT_MEASURES.items()]


def apply_model(weights: DataFrame, model: str) -> DataFrame:
    """One model's rows: the cycle maxima of the five measures times its weight."""
    w = F.col(MODEL_WEIGHTS[model]).cast("double")
    return weights.select(F.lit(model).alias("model"), *_DESCRIPTIVE,
                          F.col("conversion_session").alias("is_conversion_session"), *_credited(w)
                          ).select(*OUTPUT_COLUMNS)


def attribution_long(weights: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Every configured model, one row per (model, touchpoint), 30 columns.

    One Generate over an array of (model, weight) pairs instead of a union of
    per-model branches: the per-cycle maxima are computed once, and the plan
    has no Union and no repeated exchange.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(MODEL_WEIGHTS[m]).cast("double").alias("w"))
                      for m in cfg.models])
    exploded = weights.select(*_DESCRIPTIVE, F.col("conversion_session").alias("is_conversion_session"),
                              *[f"_cycle_max_{m}" for m in MEASURES], F.explode(pairs).alias("_m"))
    return exploded.select(F.col("_m.model").alias("model"), *_DESCRIPTIVE, "is_conversion_session",
                           *_credited(F.col("_m.w"))).select(*OUTPUT_COLUMNS)
