"""O06 sessions and O07 per-session event count.

A session row is a ``session_start`` export row.  Its end is the start of the
same pseudo id's next ``session_start`` row (NULL on the last one), ordered by
start time; ties are broken by ``session_id`` then ``utm_source`` (NULLS
LAST), so results are deterministic.

Exact copies of a start row are legal input (a copy's end is its own start,
only the last copy of a run sees the next start).  They become one row with a
multiplicity inside the exchange that the next-start scan needs anyway; under a
pseudo id with very many rows they are combined before it.  The scan runs on
the skew-safe plan (plans.chunked).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..functions.columns import device_class, event_key, event_param, micros_to_ts, non_null_key, null_str
from ..plans import chunked as ck

MULT = "_mult"

SESSION_COLUMNS = (
    "user_pseudo_id", "session_start_ts", "session_end_ts", "session_id", "session_number", "referrer_host",
    "landing_page_path", "landing_page_title", "utm_campaign", "utm_medium", "utm_source", "channel", "device",
    "mobile_brand_name", "mobile_model_name", "mobile_marketing_name", "mobile_os_hardware_model",
    "operating_system", "operating_system_version", "vendor_id", "advertising_id", "language",
    "is_limited_ad_tracking", "time_zone_offset_seconds", "browser", "browser_version", "hostname", "continent",
    "country", "region", "city", "events",
)

# Columns the attribution reads from a session (the rest never reach its output).
ATTRIBUTION_SESSION_COLUMNS = (
    "user_pseudo_id", "session_start_ts", "session_id", "referrer_host", "utm_campaign", "utm_medium", "utm_source",
    "channel", "continent", "country", "region", "city",
)

SESSION_ORDER = ck.Order(("session_start_ts", "session_id", "utm_source"))


def session_exprs() -> dict:
    return {
        "user_pseudo_id": F.col("user_pseudo_id"),
        "session_start_ts": micros_to_ts(F.col("event_timestamp")),
        "session_id": event_param("ga_session_id", "int"),
        "session_number": event_param("ga_session_number", "int"),
        "referrer_host": event_param("page_referrer"),
        "landing_page_path": event_param("page_location"),
        "landing_page_title": event_param("page_title"),
        "utm_campaign": F.col("traffic_source.name"),
        "utm_medium": F.col("traffic_source.medium"),
        "utm_source": F.col("traffic_source.source").cast("string"),
        "channel": F.col("platform"),
        "device": device_class(F.col("device.category"), F.col("app_info.id")),
        "mobile_brand_name": F.col("device.mobile_brand_name"),
        "mobile_model_name": F.col("device.mobile_model_name"),
        "mobile_marketing_name": F.col("device.mobile_marketing_name"),
        "mobile_os_hardware_model": F.col("device.mobile_os_hardware_model"),
        "operating_system": F.col("device.operating_system"),
        "operating_system_version": F.col("device.operating_system_version"),
        "vendor_id": F.col("device.vendor_id"),
        "advertising_id": F.col("device.advertising_id"),
        "language": F.col("device.language"),
        "is_limited_ad_tracking": F.col("device.is_limited_ad_tracking").try_cast("boolean"),
        "time_zone_offset_seconds": F.col("device.time_zone_offset_seconds").cast("int"),
        "browser": null_str(),
        "browser_version": F.col("device.web_info.browser_version"),
        "hostname": null_str(),
        "continent": F.col("geo.continent"),
        "country": F.col("geo.country"),
        "region": F.col("geo.region"),
        "city": F.col("geo.city"),
    }


def session_start_rows(export: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                       columns: tuple[str, ...] = ATTRIBUTION_SESSION_COLUMNS) -> DataFrame:
    """``session_start`` rows projected to ``columns`` (filter before any window)."""
    exprs = session_exprs()
    return export.filter(F.col("event_name") == cfg.session_event).select(*[exprs[c].alias(c) for c in columns])


def visitor_counts(rows: DataFrame) -> DataFrame:
    """Rows per pseudo id, under the ordered stage's key."""
    return ck.key_counts(rows, non_null_key(F.col("user_pseudo_id")))


def with_session_end(rows: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                     heavy: ck.Heavy | None = None) -> ck.Ordered:
    """Distinct start rows with ``session_end_ts`` and the multiplicity ``_mult``, dealt by pseudo id.

    ``heavy``: pseudo ids with more than ``cfg.chunk_rows`` rows (``ck.heavy_keys`` of
    :func:`visitor_counts`).

    A distinct row with multiplicity m becomes (end = own start, m - 1) and
    (end = next distinct row's start, 1): the LEAD of m identical rows.
    """
    cols = rows.columns
    distinct = ck.arrange(rows.withColumn(MULT, F.lit(1).cast("long")), non_null_key(F.col("user_pseudo_id")),
                          SESSION_ORDER, cols, MULT, heavy, cfg.chunk_rows)
    scanned = ck.ordered_scan(distinct, SESSION_ORDER, lead={"_next_start": "session_start_ts"})
    parts = F.array(
        F.struct(F.col("session_start_ts").alias("end"), (F.col(MULT) - 1).alias("m")),
        F.struct(F.col("_next_start").alias("end"), F.lit(1).cast("long").alias("m")))
    return scanned.each(lambda d: d.select(*ck.internal(d), *cols, F.explode(parts).alias("_p"))
                        .filter(F.col("_p.m") > 0)
                        .select(*ck.internal(d), *cols, F.col("_p.end").alias("session_end_ts"), F.col("_p.m").alias(MULT)))


def session_event_count(export: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Distinct ``session_start`` event keys per ``session_id`` (NULL id is one group).

    Only ``session_start`` rows are counted: the filter precedes the count.
    Spark plans the distinct count as group by (session_id, key) then count
    per session_id, both partially aggregated, so a hot session id is safe.
    """
    rows = export.filter(F.col("event_name") == cfg.session_event).select(
        event_param("ga_session_id", "int").alias("session_id"),
        event_key(F.col("user_pseudo_id"), F.col("event_name"), F.col("event_timestamp")).alias("_k"))
    return rows.groupBy("session_id").agg(F.count_distinct("_k").alias("events"))


def session_counts(rows: DataFrame) -> DataFrame:
    """Rows per session id, for joins by it."""
    return ck.key_counts(rows, non_null_key(F.col("session_id")))


def attach_event_count(df: DataFrame, counts: DataFrame, heavy: ck.Heavy | None = None) -> DataFrame:
    """``df`` + ``events`` by NULL-safe match on ``session_id``; ``heavy`` ids (``session_counts``) stay spread."""
    return ck.join_unique(df, counts.withColumnRenamed("session_id", "_sid"), non_null_key(F.col("session_id")),
                          non_null_key(F.col("_sid")), heavy, distinct=True).drop("_sid")


_BLOCK = 1 << 16


def expand(df: DataFrame, mult: str = MULT) -> DataFrame:
    """One output row per unit of ``mult`` (drops the column).

    A row's copies come in blocks of at most 65,536, one generated row each; the
    second generator turns a block into its rows.  One pass over the input.
    """
    cols = [c for c in df.columns if c != mult]
    last = F.floor((F.col(mult) - 1) / _BLOCK).cast("long")
    blocks = df.select(*cols, F.col(mult), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_b"))
    size = F.least(F.lit(_BLOCK).cast("long"), F.col(mult) - F.col("_b") * _BLOCK)
    return (blocks.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_i"))).drop("_i")


def derive_sessions(export: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per ``session_start`` event, 32 columns.

    ``browser`` is NULL and ``browser_version`` comes from the device's web
    info (each emitted once).  ``events`` counts distinct start events of the
    session id.
    """
    base_cols = tuple(c for c in SESSION_COLUMNS if c not in ("session_end_ts", "events"))
    rows = session_start_rows(export, cfg, base_cols)
    heavy = ck.heavy_by_kind({"visitor": visitor_counts(rows), "session": session_counts(rows)}, cfg.chunk_rows,
                             rows)
    ended = with_session_end(rows, cfg, heavy["visitor"]).rows()
    counted = attach_event_count(ended, session_event_count(export, cfg), heavy["session"])
    return expand(counted).select(*SESSION_COLUMNS)
