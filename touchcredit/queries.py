"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's ``events`` table through the export adapter.
The adapter's output is landed once per session as a Parquet export in the
checkpoint folder and read back with ``load_export`` (O01), as the
workload lands its export before defining the view.  Doubles are rounded to
6 places for comparison with the SQL oracle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import DEFAULT_CONFIG, FIRST_NON_DIRECT, AttributionConfig
from .functions.columns import device_class, event_param, micros_to_ts
from .operators import conversions, cycles, events, identity, models, roles, sessions, touchpoints, weights
from .plans import chunked as ck
from .plans.pipeline import Attribution
from .schema import DEVICE
from .session import ensure_checkpoint_dir
from .sources.adapter import events_to_export
from .sources.export import land_export, land_variant, load_export, variant_leaves

_LANDED: dict[tuple[str, str, str], str] = {}
_RUN: list[Attribution] = []  # the pipeline of the query built last


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _landed(spark: SparkSession, sf_dir: str, form: str, land: Callable[[DataFrame, str], None]) -> str:
    """Folder of a landed form of ``sf_dir``'s export, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), form)
    path = _LANDED.get(key)
    if path is None or not _fs_exists(spark, f"{path}/_SUCCESS"):
        root = ensure_checkpoint_dir(spark)
        path = f"{root.rstrip('/')}/landing/{hashlib.sha256(key[1].encode()).hexdigest()[:16]}{form}"
        land(spark.read.parquet(f"{key[1]}/events.parquet"), path)
        _LANDED[key] = path
    return path


def landed_path(spark: SparkSession, sf_dir: str, irregular: bool = False) -> str:
    """Folder of the export derived from ``sf_dir``'s events, by day."""
    return _landed(spark, sf_dir, "-irregular" if irregular else "",
                   lambda events, path: land_export(events_to_export(events, irregular, by_day=True), path, by_day=True))


def landed_export(spark: SparkSession, sf_dir: str, irregular: bool = False) -> DataFrame:
    """The export derived from ``sf_dir``'s events, landed once, read by ``load_export``."""
    return load_export(spark, landed_path(spark, sf_dir, irregular))


def landed_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same export landed as one shredded VARIANT column."""
    path = _landed(spark, sf_dir, "-variant", lambda _, path: land_variant(landed_export(spark, sf_dir), path))
    return spark.read.schema("v variant").parquet(path)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round doubles as ``round(x * 10^p) / 10^p`` (half away from zero on the scaled double)."""
    scale = float(10 ** places)
    return df.select(*[(F.round(F.col(f.name) * scale, 0) / scale).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields])


TP_KEYS = ("blended_user_id", "session_id", "session_start_ts", "session_end_ts", "session_seq")


def _pipe(spark, sf_dir, cfg=DEFAULT_CONFIG, irregular=False) -> Attribution:
    """A pipeline; the cached rows of the query built before are released."""
    while _RUN:
        _RUN.pop().close()
    _RUN.append(Attribution(landed_export(spark, sf_dir, irregular), cfg))
    return _RUN[0]


def _param_text(p):
    v = p["value"]
    slots = [v["string_value"], *(v[n].cast("string") for n in ("int_value", "float_value", "double_value"))]
    return F.concat(p["key"], F.lit("="), *[F.concat(F.coalesce(x, F.lit("")), F.lit("|")) for x in slots])


def q_export_scan(spark, sf_dir):
    x = landed_export(spark, sf_dir)
    return x.select(
        "event_timestamp", "event_date", "event_name", "user_pseudo_id", "user_id", "platform",
        F.col("traffic_source.name").alias("traffic_source_name"),
        F.col("traffic_source.medium").alias("traffic_source_medium"),
        F.col("traffic_source.source").alias("traffic_source_source"),
        F.size("event_params").alias("n_event_params"),
        F.array_join(F.transform("event_params", _param_text), ";").alias("event_params"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("app_info.id").alias("app_id"),
        F.col("device.category").alias("device_category"),
        *[F.col(f"device.{f.name}").alias(f.name) for f in DEVICE.fields if f.name not in ("category", "web_info")],
        F.col("device.web_info.browser_version").alias("browser_version"),
        F.col("geo.continent").alias("continent"), F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"), F.col("geo.city").alias("city"))


EVEN_DAYS = r"event_date=\d{7}[02468]/.*"


def q_export_by_pattern(spark, sf_dir):
    x = load_export(spark, landed_path(spark, sf_dir), pattern=EVEN_DAYS)
    return x.select("event_timestamp", "event_date", "event_name", "user_pseudo_id", "user_id",
                    F.col("traffic_source.source").alias("traffic_source_source"),
                    event_param("ga_session_id", "int").alias("ga_session_id"))


def q_events_flat_variant(spark, sf_dir):
    return events.normalize_events(variant_leaves(landed_variant(spark, sf_dir)))


def q_event_params(spark, sf_dir):
    x = landed_export(spark, sf_dir)
    return x.select(
        "event_timestamp", "user_pseudo_id", "event_name",
        event_param("ga_session_id", "int").alias("ga_session_id"),
        event_param("ga_session_number", "int").alias("ga_session_number"),
        event_param("page_referrer").alias("page_referrer"),
        event_param("page_location").alias("page_location"),
        event_param("page_title").alias("page_title"),
        event_param("no_such_key").alias("missing_param"))


def q_events_flat(spark, sf_dir):
    return _pipe(spark, sf_dir).events


def q_id_stitching(spark, sf_dir):
    return _pipe(spark, sf_dir).ids


def q_sessions(spark, sf_dir, cfg=DEFAULT_CONFIG, irregular=False):
    p = _pipe(spark, sf_dir, cfg, irregular)
    with ck.owned_by(p.rounds):
        return sessions.derive_sessions(p.export, cfg)


def q_session_event_count(spark, sf_dir, irregular=False):
    return sessions.session_event_count(landed_export(spark, sf_dir, irregular))


def q_device_class(spark, sf_dir):
    x = landed_export(spark, sf_dir).filter(F.col("event_name") == DEFAULT_CONFIG.session_event)
    return x.select("user_pseudo_id", micros_to_ts(F.col("event_timestamp")).alias("session_start_ts"),
                    F.col("device.category").alias("device_category"), F.col("app_info.id").alias("app_id"),
                    device_class(F.col("device.category"), F.col("app_info.id")).alias("device"))


def q_blended_sessions(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    with ck.owned_by(p.rounds):
        return identity.blend_users(sessions.derive_sessions(p.export, p.cfg), p.ids, p.logins)


def q_blended_events(spark, sf_dir):
    p = _pipe(spark, sf_dir)
    return identity.blend_users(p.events, p.ids)


def q_converting_events_filtered(spark, sf_dir):
    return _pipe(spark, sf_dir).converting_events_filtered


def q_converting_events(spark, sf_dir):
    return _pipe(spark, sf_dir).converting_events


def q_converting_sessions(spark, sf_dir, irregular=False):
    return _pipe(spark, sf_dir, irregular=irregular).converting_sessions


def q_lost_conversions(spark, sf_dir, irregular=False):
    p = _pipe(spark, sf_dir, irregular=irregular)
    return conversions.lost_conversions(p.converting_sessions, roles.start_rows(p.roles))


def q_channel_flags(spark, sf_dir):
    x = sessions.session_start_rows(landed_export(spark, sf_dir), DEFAULT_CONFIG,
                                    ("user_pseudo_id", "session_start_ts", "session_id", "utm_source", "utm_medium"))
    return touchpoints.channel_flags(x)


def q_touchpoints(spark, sf_dir, cfg=DEFAULT_CONFIG, irregular=False):
    p = _pipe(spark, sf_dir, cfg, irregular)
    counts = sessions.session_event_count(p.export)
    with ck.owned_by(p.rounds):
        return touchpoints.label_touchpoints(p.blended_sessions, p.converting_sessions, p.cfg, counts, p.heavy)


def q_running_conversions(spark, sf_dir):
    return _pipe(spark, sf_dir).stage("running").select(*TP_KEYS, *cycles.RUNNING)


def q_conversion_cycles(spark, sf_dir):
    return _pipe(spark, sf_dir).stage("cycles").select(*TP_KEYS, *cycles.CYCLES)


def q_lookback_windows(spark, sf_dir):
    return _pipe(spark, sf_dir).stage("lookback").select(
        *TP_KEYS, "user_conversion_cycle", "session_day_number", "days_before_conversion",
        "is_within_attribution_lookback_window", "is_within_attribution_time_decay_days_window")


def q_time_decay_scores(spark, sf_dir, cfg=DEFAULT_CONFIG, irregular=False):
    return _pipe(spark, sf_dir, cfg, irregular).stage("time_decay").select(
        *TP_KEYS, "user_conversion_cycle", "time_decay_score", "weighting", "sessions_within_day_to_conversion",
        "weighting_split_by_days_sessions", "apportioned_time_decay_score")


def q_cycle_channel_flags(spark, sf_dir):
    return _pipe(spark, sf_dir).stage("channel_flags").select(*TP_KEYS, "user_conversion_cycle",
                                                             *weights.CHANNEL_FLAG_COLUMNS)


def _weight_query(column: str, cfg: AttributionConfig = DEFAULT_CONFIG):
    def q(spark, sf_dir):
        return _pipe(spark, sf_dir, cfg).stage("weights").select(*TP_KEYS, "user_conversion_cycle", column)
    return q


def q_attributed_measures(spark, sf_dir):
    return models.apply_model(_pipe(spark, sf_dir).stage("weights"), FIRST_NON_DIRECT)


def q_attribution(spark, sf_dir):
    return _pipe(spark, sf_dir).result


def _attribution_with(cfg: AttributionConfig, irregular: bool = False):
    def q(spark, sf_dir):
        return _pipe(spark, sf_dir, cfg, irregular).result
    return q


LOOKBACK5 = DEFAULT_CONFIG.with_(lookback_days=5)
USER_SESSION = DEFAULT_CONFIG.with_(session_key="user_session")
NO_CONVERSION_SESSION = DEFAULT_CONFIG.with_(include_conversion_session=False)
RECENT_DECAY = DEFAULT_CONFIG.with_(time_decay_direction="recent")
CHUNKS = DEFAULT_CONFIG.with_(chunk_rows=4)  # nearly every user is cut: chunk edges and carries at every data size

_RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "export_scan": q_export_scan,
    "export_by_pattern": q_export_by_pattern,
    "events_flat_variant": q_events_flat_variant,
    "event_params": q_event_params,
    "events_flat": q_events_flat,
    "id_stitching": q_id_stitching,
    "sessions": q_sessions,
    "session_event_count": q_session_event_count,
    "device_class": q_device_class,
    "blended_sessions": q_blended_sessions,
    "blended_events": q_blended_events,
    "converting_events_filtered": q_converting_events_filtered,
    "converting_events": q_converting_events,
    "converting_sessions": q_converting_sessions,
    "lost_conversions": q_lost_conversions,
    "channel_flags": q_channel_flags,
    "touchpoints": q_touchpoints,
    "running_conversions": q_running_conversions,
    "conversion_cycles": q_conversion_cycles,
    "lookback_windows": q_lookback_windows,
    "time_decay_scores": q_time_decay_scores,
    "cycle_channel_flags": q_cycle_channel_flags,
    "attrib_last_click": _weight_query("last_click_attrib_pct"),
    "attrib_last_non_direct": _weight_query("last_non_direct_click_attrib_pct"),
    "attrib_last_paid": _weight_query("last_paid_click_attrib_pct"),
    "attrib_first_click": _weight_query("first_click_attrib_pct"),
    "attrib_first_non_direct": _weight_query("first_non_direct_click_attrib_pct"),
    "attrib_first_paid": _weight_query("first_paid_click_attrib_pct"),
    "attrib_linear": _weight_query("even_click_attrib_pct"),
    "attrib_time_decay": _weight_query("time_decay_attrib_pct"),
    "attrib_linear_lookback5": _weight_query("even_click_attrib_pct", LOOKBACK5),
    "attrib_first_click_lookback5": _weight_query("first_click_attrib_pct", LOOKBACK5),
    "attributed_measures": q_attributed_measures,
    "attribution": q_attribution,
    "attribution_lookback5": _attribution_with(LOOKBACK5),
    "attribution_user_session": _attribution_with(USER_SESSION),
    "attribution_no_conversion_session": _attribution_with(NO_CONVERSION_SESSION),
    "attribution_recent_decay": _attribution_with(RECENT_DECAY),
    "sessions_16_chunks": partial(q_sessions, cfg=CHUNKS),
    "touchpoints_16_chunks": partial(q_touchpoints, cfg=CHUNKS),
    "time_decay_scores_16_chunks": partial(q_time_decay_scores, cfg=CHUNKS),
    "attribution_16_chunks": _attribution_with(CHUNKS),
    # The irregular export (sources.adapter), users cut as well.
    "session_event_count_irregular": partial(q_session_event_count, irregular=True),
    "converting_sessions_irregular": partial(q_converting_sessions, irregular=True),
    "lost_conversions_irregular": partial(q_lost_conversions, irregular=True),
    "sessions_irregular": partial(q_sessions, cfg=CHUNKS, irregular=True),
    "touchpoints_irregular": partial(q_touchpoints, cfg=CHUNKS, irregular=True),
    "time_decay_scores_irregular": partial(q_time_decay_scores, cfg=CHUNKS, irregular=True),
    "attribution_irregular": _attribution_with(CHUNKS, irregular=True),
    "attribution_irregular_user_session": _attribution_with(
        CHUNKS.with_(session_key="user_session"), irregular=True),
    "attribution_irregular_no_conversion_session": _attribution_with(
        CHUNKS.with_(include_conversion_session=False), irregular=True),
}


def _rounded(fn):
    def q(spark, sf_dir):
        return round_doubles(fn(spark, sf_dir))
    q.__name__ = getattr(fn, "__name__", "q")
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _rounded(v) for k, v in _RAW.items()}
