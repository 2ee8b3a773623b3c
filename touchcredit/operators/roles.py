"""The one scan of the export: every row the attribution reads, tagged with its roles.

A role row is a session start, a conversion (order or registration), a row that
carries a login, or several of these.  Columns that none of its roles reads are
NULL, so the table is narrow and can be pinned once and read by every branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..functions.columns import event_key, event_param, micros_to_ts
from .conversions import CANDIDATE_COLUMNS
from .sessions import ATTRIBUTION_SESSION_COLUMNS, session_exprs

START, CONVERSION, LOGIN = "_is_start", "_is_conversion", "_is_login"


def role_rows(export: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Export rows with a role; the filter (event names, ``user_id IS NOT NULL``) reaches the Parquet scan."""
    name = F.col("event_name")
    start = F.coalesce(name == cfg.session_event, F.lit(False))
    conversion = F.coalesce(name.isin(cfg.order_event, cfg.registration_event), F.lit(False))
    login = F.col("user_id").isNotNull()
    wanted = list(dict.fromkeys((cfg.session_event, cfg.order_event, cfg.registration_event)))

    def only(role: Column, value: Column) -> Column:
        return F.when(role, value)

    described = session_exprs()
    shared = ("user_pseudo_id", "session_start_ts", "session_id")
    return export.filter(name.isin(*wanted) | login).select(
        start.alias(START), conversion.alias(CONVERSION), login.alias(LOGIN),
        "user_pseudo_id", "user_id", micros_to_ts(F.col("event_timestamp")).alias("event_ts"),
        only(start | conversion, event_param("ga_session_id", "int")).alias("session_id"),
        only(conversion, event_key(F.col("user_pseudo_id"), name, F.col("event_timestamp"))).alias("event_id"),
        only(conversion, name).alias("event_type"),
        only(conversion, F.col("ecommerce.purchase_revenue")).alias("order_value"),
        only(conversion, F.col("ecommerce.transaction_id")).alias("order_id"),
        *[only(start, described[c]).alias(c) for c in ATTRIBUTION_SESSION_COLUMNS if c not in shared])


def start_rows(roles: DataFrame) -> DataFrame:
    """``ATTRIBUTION_SESSION_COLUMNS`` of the session starts."""
    return roles.filter(START).withColumnRenamed("event_ts", "session_start_ts").select(*ATTRIBUTION_SESSION_COLUMNS)


def conversion_rows(roles: DataFrame) -> DataFrame:
    """``CANDIDATE_COLUMNS`` of the order and registration events."""
    return roles.filter(CONVERSION).select(*CANDIDATE_COLUMNS)


def login_rows(roles: DataFrame) -> DataFrame:
    """``user_pseudo_id, user_id, event_ts`` of the rows that carry a login."""
    return roles.filter(LOGIN).select("user_pseudo_id", "user_id", "event_ts")
