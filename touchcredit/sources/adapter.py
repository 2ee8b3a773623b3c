"""Test scaffolding: the driver's flat ``events`` table as a nested export.

The driver data has no sessions, logins or channels, so this adapter derives
them by fixed rules (FIXTURES.md section 2) and emits rows in the export
schema.  It is not an attribution operator; it only feeds the operators with
data that grows with the ``events`` table.  Sessionisation (a new session at a
user's first event and after every gap over 12 hours) runs on the skew-safe
chunked scans, like the attribution itself.

``irregular=True`` adds the oddities that real exports have and the driver
data lacks, by fixed rules on the user id, the event and the session's first k:
long gaps, session ids shared by two users, session ids and pseudo ids that are
NULL, session starts that are missing or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_null_key
from ..plans import chunked as ck
from .export import rebalanced_by_day

# Fixed values of the adapter rules: the session gap, the mapping of event
# types to export event names, the traffic-source classes picked by
# c = floor(k/5) % 6 of a session's first event, the device classes by
# user_id % 4, and the geo names by user_id % 5.
SESSION_GAP = "INTERVAL 12 HOURS"
TRAFFIC_CLASSES = [  # (source, medium, name) for c = 0..5
    ("(direct)", "(none)", "(direct)"),
    ("google", "cpc", "brand"),
    ("newsletter", "email", "weekly"),
    ("facebook", "paid_social", "promo"),
    (None, None, None),
    ("bing", "organic", None),
]
DEVICE_CATEGORIES = ["desktop", "mobile", "tablet", "smart tv"]
GEO_NAMES = [  # (continent, country, region, city) for user_id % 5 = 0..4
    ("Europe", "Germany", "Berlin", "Berlin"),
    ("Americas", "United States", "California", "San Francisco"),
    ("Asia", "Japan", "Tokyo", "Tokyo"),
    ("Europe", "France", "Ile-de-France", "Paris"),
    ("Oceania", "Australia", "New South Wales", "Sydney"),
]
# Fixed values of the irregular export: a rule holds where the modulus gives the remainder.
GAP_USERS = (7, 3)           # user id: events from day 16 of a month on come 40 days later
SHARED_ID_USERS = (10, 8)    # user id: session ids are those of the user before
NULL_PSEUDO_USERS = (25, 24)  # user id: no pseudo id
NO_START = (17, 0)           # first k: the session has no start row
TWO_STARTS = (13, 0)         # first k: the start row comes twice
NULL_SESSION_ID = (19, 0)    # first k: the session has no id


def _epoch_ntz():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _named(names: list[str], values: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, values, strict=True)])


def _pick(index: Column, structs: list[Column], absent: Column) -> Column:
    """The ``index``-th of constant structs, looked up in one constant array; ``absent`` outside of them.

    A CASE per field makes the generated row code too long for the JVM to compile.
    """
    return F.coalesce(F.get(F.array(*structs), index.cast("int")), absent)


def sessionize(events: DataFrame) -> DataFrame:
    """events + ``k``, ``sn`` (session number), ``is_new``, ``sk`` (first k of the session)."""
    base = (events.select("event_id", "ts", "user_id", "event_type", "value",
                          F.get_json_object("props", "$.k").cast("long").alias("k")))
    order = ck.Order(("ts", "event_id"))
    key = non_null_key(F.col("user_id"))
    tagged = ck.arrange(base, key, order, ["event_id"], heavy=ck.heavy_keys(ck.key_counts(base, key), rows=base))
    with_prev = ck.ordered_scan(tagged, order, lag={"prev_ts": "ts"})
    flagged = with_prev.withColumn(
        "is_new", F.when(F.col("prev_ts").isNull() | (F.col("ts") > F.col("prev_ts") + F.expr(SESSION_GAP)), 1)
        .otherwise(0)).withColumn("_k_new", F.when(F.col("is_new") == 1, F.struct(F.col("k").alias("v"))))
    numbered = ck.ordered_scan(flagged, order, running_sums={"sn": "is_new"},
                               prev_non_null={"sk": "_k_new"})
    return numbered.rows().withColumn("sk", F.col("sk")["v"]).drop("prev_ts", "_k_new")


def _rule(column: str, rule: tuple[int, int]) -> Column:
    return F.coalesce(F.col(column) % rule[0] == rule[1], F.lit(False))


def events_to_export(events: DataFrame, irregular: bool = False, by_day: bool = False) -> DataFrame:
    """Driver ``events`` -> rows in ``schema.EXPORT_SCHEMA`` (plus session starts).

    ``by_day``: in ``export.rebalanced_by_day``'s order, dealt and sorted before the nested columns are built.
    """
    if irregular:
        late = _rule("user_id", GAP_USERS) & (F.dayofmonth("ts") >= 16)
        events = events.withColumn("ts", F.when(late, F.col("ts") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("ts")))
    s = sessionize(events)
    named = F.when(F.col("event_type") == "signup", F.lit("Form Submitted")) \
        .when((F.col("event_type") == "purchase") & (F.col("k") % 5 == 0), F.lit("file_download")) \
        .otherwise(F.col("event_type"))
    # A row that opens a session comes once more as its start: one pass over the scanned events.
    times = F.lit(1)
    if irregular:
        times = F.when(_rule("sk", NO_START), 0).when(_rule("sk", TWO_STARTS), 2).otherwise(1)
    copies = F.concat(F.array(F.lit(False)),
                      F.array_repeat(F.lit(True), F.when(F.col("is_new") == 1, times).otherwise(0)))
    start = F.col("_start")
    u = s.select("event_id", "ts", "user_id", "event_type", "value", "sn", "sk", "k", F.explode(copies).alias("_start")).select(
        "event_id", "ts", "user_id", F.when(~start, F.col("value")).alias("value"), "sn", "sk",
        F.when(start, F.col("sk")).otherwise(F.col("k")).alias("k"),
        F.when(start, F.lit("session_start")).otherwise(named).alias("event_name"),
        F.date_format("ts", "yyyyMMdd").alias("event_date"))
    if by_day:
        u = rebalanced_by_day(u)

    c = F.floor(F.col("sk") / 5) % 6
    uid = F.col("user_id")
    k = F.col("k")
    pseudo = F.concat(F.lit("p"), uid.cast("string"))
    session_id = (uid * 1000 + F.col("sn")).cast("long")
    if irregular:
        pseudo = F.when(~_rule("user_id", NULL_PSEUDO_USERS), pseudo)
        session_id = session_id - F.when(_rule("user_id", SHARED_ID_USERS), 1000).otherwise(0)
        session_id = F.when(~_rule("sk", NULL_SESSION_ID), session_id)

    def param(key, string=None, integer=None):
        return F.struct(F.lit(key).alias("key"), F.struct(
            (string if string is not None else F.lit(None).cast("string")).alias("string_value"),
            (integer if integer is not None else F.lit(None).cast("long")).alias("int_value"),
            F.lit(None).cast("double").alias("float_value"),
            F.lit(None).cast("double").alias("double_value")).alias("value"))

    def device(category):
        return F.struct(F.lit(category).cast("string").alias("category"),
                        *[F.lit(None).cast("string").alias(n) for n in (
                            "operating_system", "operating_system_version", "language", "mobile_brand_name",
                            "mobile_model_name", "mobile_marketing_name", "mobile_os_hardware_model", "vendor_id",
                            "advertising_id", "is_limited_ad_tracking")],
                        F.lit(None).cast("int").alias("time_zone_offset_seconds"),
                        F.struct(F.lit(None).cast("string").alias("browser_version")).alias("web_info"))

    traffic_names = ["source", "medium", "name"]
    geo_names = ["continent", "country", "region", "city"]
    is_order = F.col("event_name") == "file_download"
    return u.select(
        F.timestamp_diff("MICROSECOND", _epoch_ntz(), F.col("ts").cast("timestamp_ntz")).alias("event_timestamp"),
        "event_date", "event_name",
        pseudo.alias("user_pseudo_id"),
        F.when(F.col("event_name") == "Form Submitted",
               F.concat(F.lit("u"), F.floor(uid / 2).cast("string"))).alias("user_id"),
        F.lit("WEB").alias("platform"),
        _pick(c, [_named(traffic_names[::-1], t[::-1]) for t in TRAFFIC_CLASSES],
              _named(traffic_names[::-1], (None,) * 3)).alias("traffic_source"),
        F.array(
            param("ga_session_id", integer=session_id),
            param("ga_session_number", integer=F.col("sn").cast("long")),
            param("page_location", string=F.concat(F.lit("/p"), k.cast("string"))),
            param("page_title", string=F.concat(F.lit("Page "), k.cast("string"))),
            param("page_referrer", string=F.when(k >= 10, F.concat(F.lit("ref"), (k % 7).cast("string")))),
        ).alias("event_params"),
        F.when(is_order, F.struct(F.col("value").alias("purchase_revenue"),
                                  F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("transaction_id"))
               ).alias("ecommerce"),
        F.struct(F.when(uid % 3 == 0, F.lit("app")).alias("id")).alias("app_info"),
        _pick(uid % 4, [device(d) for d in DEVICE_CATEGORIES], device(None)).alias("device"),
        _pick(uid % 5, [_named(geo_names, g) for g in GEO_NAMES], _named(geo_names, (None,) * 4)).alias("geo"),
    )


def export_from_tables(spark, sf_dir: str, irregular: bool = False) -> DataFrame:
    """The export derived from ``{sf_dir}/events.parquet``."""
    return events_to_export(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"), irregular)
