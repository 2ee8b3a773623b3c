"""Typed schema of the nested web-analytics event export.

Only the paths the attribution reads are declared; passing this schema to
``spark.read.schema(...)`` reads missing fields as NULL, infers nothing and
lets nested-column pruning skip every other leaf of the files.
"""

from __future__ import annotations

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.DoubleType()),
    T.StructField("double_value", T.DoubleType()),
])

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
])

TRAFFIC_SOURCE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("source", T.StringType()),
])

ECOMMERCE = T.StructType([
    T.StructField("purchase_revenue", T.DoubleType()),
    T.StructField("transaction_id", T.StringType()),
])

APP_INFO = T.StructType([T.StructField("id", T.StringType())])

DEVICE = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("operating_system", T.StringType()),
    T.StructField("operating_system_version", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("mobile_brand_name", T.StringType()),
    T.StructField("mobile_model_name", T.StringType()),
    T.StructField("mobile_marketing_name", T.StringType()),
    T.StructField("mobile_os_hardware_model", T.StringType()),
    T.StructField("vendor_id", T.StringType()),
    T.StructField("advertising_id", T.StringType()),
    T.StructField("is_limited_ad_tracking", T.StringType()),
    T.StructField("time_zone_offset_seconds", T.IntegerType()),
    T.StructField("web_info", T.StructType([T.StructField("browser_version", T.StringType())])),
])

GEO = T.StructType([
    T.StructField("continent", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("city", T.StringType()),
])

EXPORT_SCHEMA = T.StructType([
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("traffic_source", TRAFFIC_SOURCE),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("ecommerce", ECOMMERCE),
    T.StructField("app_info", APP_INFO),
    T.StructField("device", DEVICE),
    T.StructField("geo", GEO),
])
