"""Flat events from the nested export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import event_key, event_param, micros_to_ts, null_str

EVENT_COLUMNS = (
    "event_ts", "event_id", "user_pseudo_id", "user_id", "utm_channel", "utm_medium", "utm_source", "event_type",
    "event_date", "session_id", "session_number", "page_referrer", "page_path", "page_title", "order_value",
    "order_id", "channel", "device_category", "operating_system", "language", "is_limited_ad_tracking", "browser",
    "hostname", "continent", "country", "region", "city",
)


def normalize_events(export: DataFrame) -> DataFrame:
    """One flat row per export row, 27 columns (narrow: no shuffle).

    Columns downstream operators do not read are pruned by Catalyst, down to
    the nested leaves of the Parquet scan.
    """
    ts = micros_to_ts(F.col("event_timestamp"))
    return export.select(
        ts.alias("event_ts"),
        event_key(F.col("user_pseudo_id"), F.col("event_name"), F.col("event_timestamp")).alias("event_id"),
        F.col("user_pseudo_id"),
        F.col("user_id"),
        F.col("traffic_source.name").alias("utm_channel"),
        F.col("traffic_source.medium").alias("utm_medium"),
        F.col("traffic_source.source").alias("utm_source"),
        F.col("event_name").alias("event_type"),
        F.try_to_date(F.col("event_date"), "yyyyMMdd").alias("event_date"),
        event_param("ga_session_id", "int").alias("session_id"),
        event_param("ga_session_number", "int").alias("session_number"),
        event_param("page_referrer").alias("page_referrer"),
        event_param("page_location").alias("page_path"),
        event_param("page_title").alias("page_title"),
        F.col("ecommerce.purchase_revenue").alias("order_value"),
        F.col("ecommerce.transaction_id").alias("order_id"),
        F.col("platform").alias("channel"),
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.language").alias("language"),
        F.col("device.is_limited_ad_tracking").try_cast("boolean").alias("is_limited_ad_tracking"),
        null_str().alias("browser"),
        null_str().alias("hostname"),
        F.col("geo.continent").alias("continent"),
        F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"),
        F.col("geo.city").alias("city"),
    )
