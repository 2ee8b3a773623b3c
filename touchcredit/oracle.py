"""DuckDB SQL for each registered query (the correctness oracle).

Formulated apart from the Spark code: identities, first conversions, cycles and
days are GROUP BYs joined back to their rows, the next conversion is an ASOF
join, the credited session of a model is chosen per cycle and matched by its
id, and the models are one list of (model, weight) pairs unnested once.
Orders are total: ``NULLS LAST`` everywhere, ties broken by ``session_id``,
``utm_source``, ``session_end_ts``.  Doubles are rounded to 6 places.
"""

from __future__ import annotations

from .config import DEFAULT_CONFIG, FIRST_NON_DIRECT, MODEL_WEIGHTS, AttributionConfig
from .schema import DEVICE
from .sources.adapter import (DEVICE_CATEGORIES, GAP_USERS, GEO_NAMES, NO_START, NULL_PSEUDO_USERS, NULL_SESSION_ID,
                              SHARED_ID_USERS, TRAFFIC_CLASSES, TWO_STARTS)

TORD = ("session_start_ts ASC NULLS LAST, session_id ASC NULLS LAST, utm_source ASC NULLS LAST, "
        "session_end_ts ASC NULLS LAST")
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


# touchpoint count -> flag "this session has one"
COUNTS = {
    "count_conversions": "conversion_event",
    "count_order_conversions": "order_conversion_event",
    "count_registration_conversions": "registration_conversion_event",
    "count_first_order_conversions": "first_order_conversion_event",
    "count_repeat_order_conversions": "repeat_order_conversion_event",
}
# running total -> (what it sums, flag of this session, cycle number made from it)
TOTALS = {
    "user_total_conversions": ("conversion_event", "conversion_event", "user_conversion_cycle"),
    "user_total_order_conversions": ("count_order_conversions", None, None),
    "user_total_registration_conversions": ("count_registration_conversions", "registration_conversion_event",
                                            "user_registration_conversion_cycle"),
    "user_total_first_order_conversions": ("count_first_order_conversions", "first_order_conversion_event",
                                           "user_first_order_conversion_cycle"),
    "user_total_repeat_order_conversions": ("count_repeat_order_conversions", "repeat_order_conversion_event",
                                            "user_repeat_order_conversion_cycle"),
}
# result column -> cycle measure that the weights multiply
MEASURES = {
    "user_registration_conversions": "count_registration_conversions",
    "first_order_conversions": "count_first_order_conversions",
    "repeat_order_conversions": "count_repeat_order_conversions",
    "first_order_revenue": "first_order_revenue",
    "repeat_order_revenue": "repeat_order_revenue",
}


def _q(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _case(expr, values):
    arms = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values) if v is not None)
    return f"CAST(CASE {expr} {arms} END AS VARCHAR)" if arms else "CAST(NULL AS VARCHAR)"


def _rule(column: str, rule: tuple[int, int], irregular: bool) -> str:
    """Condition of an irregular-export rule; never true in the regular export."""
    return f"COALESCE({column} % {rule[0]} = {rule[1]}, FALSE)" if irregular else "FALSE"


def _ctes(cfg: AttributionConfig, irregular: bool = False) -> list[tuple[str, str]]:
    c = "(sk // 5) % 6"
    reg, order, start = _q(cfg.registration_event), _q(cfg.order_event), _q(cfg.session_event)
    direct = ", ".join(_q(s) for s in cfg.direct_sources)
    by_user = cfg.session_key == "user_session"
    user_match = " AND v.blended_user_id = c.blended_user_id" if by_user else ""
    eligible = "TRUE" if cfg.include_conversion_session else "NOT conversion_session"
    power = "POW(2, days_before_conversion - 1)" if cfg.time_decay_direction == "reference" else \
        "POW(2, -days_before_conversion)"
    return [
        # ---- adapter: driver events -> flat export (FIXTURES.md section 2)
        ("o_ev0", f"""SELECT event_id AS eid, user_id AS uid, event_type, value,
                 ts + IF({_rule("user_id", GAP_USERS, irregular)} AND day(ts) >= 16, INTERVAL 40 DAY, INTERVAL 0 DAY)
                   AS ts,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""),
        ("o_ev1", "SELECT *, LAG(ts) OVER (PARTITION BY uid ORDER BY ts, eid) AS prev_ts FROM o_ev0"),
        ("o_ev2", """SELECT *, CASE WHEN prev_ts IS NULL OR ts > prev_ts + INTERVAL 12 HOUR THEN 1 ELSE 0 END
                 AS is_new FROM o_ev1"""),
        ("o_ev3", f"SELECT *, SUM(is_new) OVER (PARTITION BY uid ORDER BY ts, eid {RUN}) AS sn FROM o_ev2"),
        ("o_ev4", f"SELECT *, FIRST_VALUE(k) OVER (PARTITION BY uid, sn ORDER BY ts, eid {WHOLE}) AS sk FROM o_ev3"),
        ("o_xr", f"""SELECT eid, ts, uid, value, sn, sk, k,
                 CASE WHEN event_type = 'signup' THEN 'Form Submitted'
                      WHEN event_type = 'purchase' AND k % 5 = 0 THEN 'file_download'
                      ELSE event_type END AS event_name FROM o_ev4
               UNION ALL
               SELECT eid, ts, uid, CAST(NULL AS DOUBLE), sn, sk, sk, 'session_start'
               FROM o_ev4, (VALUES (1), (2)) copies (nth)
               WHERE is_new = 1 AND NOT {_rule("sk", NO_START, irregular)}
                 AND (nth = 1 OR {_rule("sk", TWO_STARTS, irregular)})"""),
        ("o_export", f"""SELECT epoch_us(ts) AS event_timestamp, strftime(ts, '%Y%m%d') AS event_date, event_name,
                 IF({_rule("uid", NULL_PSEUDO_USERS, irregular)}, NULL, 'p' || CAST(uid AS VARCHAR)) AS user_pseudo_id,
                 CASE WHEN event_name = 'Form Submitted' THEN 'u' || CAST(uid // 2 AS VARCHAR) END AS user_id,
                 'WEB' AS platform,
                 {_case(c, [t[2] for t in TRAFFIC_CLASSES])} AS ts_name,
                 {_case(c, [t[1] for t in TRAFFIC_CLASSES])} AS ts_medium,
                 {_case(c, [t[0] for t in TRAFFIC_CLASSES])} AS ts_source,
                 IF({_rule("sk", NULL_SESSION_ID, irregular)}, NULL,
                    CAST(uid * 1000 + sn - IF({_rule("uid", SHARED_ID_USERS, irregular)}, 1000, 0) AS BIGINT))
                   AS p_ga_session_id, CAST(sn AS BIGINT) AS p_ga_session_number,
                 CASE WHEN k >= 10 THEN 'ref' || CAST(k % 7 AS VARCHAR) END AS p_page_referrer,
                 '/p' || CAST(k AS VARCHAR) AS p_page_location, 'Page ' || CAST(k AS VARCHAR) AS p_page_title,
                 CASE WHEN event_name = 'file_download' THEN value END AS purchase_revenue,
                 CASE WHEN event_name = 'file_download' THEN 'T' || CAST(eid AS VARCHAR) END AS transaction_id,
                 CASE WHEN uid % 3 = 0 THEN 'app' END AS app_id,
                 {_case('uid % 4', DEVICE_CATEGORIES)} AS device_category,
                 {_case('uid % 5', [g[0] for g in GEO_NAMES])} AS continent,
                 {_case('uid % 5', [g[1] for g in GEO_NAMES])} AS country,
                 {_case('uid % 5', [g[2] for g in GEO_NAMES])} AS region,
                 {_case('uid % 5', [g[3] for g in GEO_NAMES])} AS city
               FROM o_xr"""),
        # ---- events
        ("o_events", """SELECT make_timestamp(event_timestamp) AS event_ts,
                 user_pseudo_id || '-' || event_name || '-' || CAST(event_timestamp AS VARCHAR) AS event_id,
                 user_pseudo_id, user_id, ts_name AS utm_channel, ts_medium AS utm_medium, ts_source AS utm_source,
                 event_name AS event_type, CAST(try_strptime(event_date, '%Y%m%d') AS DATE) AS event_date,
                 p_ga_session_id AS session_id, p_ga_session_number AS session_number,
                 p_page_referrer AS page_referrer, p_page_location AS page_path, p_page_title AS page_title,
                 purchase_revenue AS order_value, transaction_id AS order_id, platform AS channel,
                 device_category, CAST(NULL AS VARCHAR) AS operating_system, CAST(NULL AS VARCHAR) AS language,
                 CAST(NULL AS BOOLEAN) AS is_limited_ad_tracking, CAST(NULL AS VARCHAR) AS browser,
                 CAST(NULL AS VARCHAR) AS hostname, continent, country, region, city
               FROM o_export"""),
        # ---- id stitching
        ("o_ids", """SELECT user_pseudo_id,
                 FIRST(user_id ORDER BY event_ts DESC NULLS FIRST, user_id DESC) FILTER (WHERE user_id IS NOT NULL)
                   AS user_id,
                 MIN(event_ts) AS first_seen_at, MAX(event_ts) AS last_seen_at
               FROM o_events GROUP BY user_pseudo_id"""),
        # ---- sessions
        ("o_sess0", f"""SELECT user_pseudo_id, make_timestamp(event_timestamp) AS session_start_ts,
                 p_ga_session_id AS session_id, p_ga_session_number AS session_number,
                 p_page_referrer AS referrer_host, p_page_location AS landing_page_path,
                 p_page_title AS landing_page_title, ts_name AS utm_campaign, ts_medium AS utm_medium,
                 ts_source AS utm_source, platform AS channel,
                 CASE WHEN device_category = 'desktop' THEN device_category
                      WHEN device_category IN ('tablet', 'mobile')
                        THEN device_category || IF(app_id IS NULL, '-web', '-app') END AS device,
                 device_category, app_id,
                 user_pseudo_id || '-' || event_name || '-' || CAST(event_timestamp AS VARCHAR) AS event_key,
                 continent, country, region, city
               FROM o_export WHERE event_name = {start}"""),
        ("o_sec", "SELECT session_id, COUNT(DISTINCT event_key) AS events FROM o_sess0 GROUP BY session_id"),
        ("o_sess", """SELECT s.*, LEAD(s.session_start_ts) OVER (PARTITION BY s.user_pseudo_id
                   ORDER BY s.session_start_ts ASC NULLS LAST, s.session_id ASC NULLS LAST,
                   s.utm_source ASC NULLS LAST) AS session_end_ts, e.events
               FROM o_sess0 s LEFT JOIN o_sec e ON s.session_id IS NOT DISTINCT FROM e.session_id"""),
        # ---- blending
        ("o_uss", """SELECT s.*, COALESCE(i.user_id, s.user_pseudo_id) AS blended_user_id
               FROM o_sess s LEFT JOIN o_ids i ON s.user_pseudo_id = i.user_pseudo_id"""),
        ("o_use", """SELECT e.*, COALESCE(i.user_id, e.user_pseudo_id) AS blended_user_id
               FROM o_events e LEFT JOIN o_ids i ON e.user_pseudo_id = i.user_pseudo_id"""),
        # ---- conversions
        ("o_firsts", f"""SELECT DISTINCT ON (blended_user_id, event_type) blended_user_id, event_type,
                 event_id AS first_id
               FROM o_use WHERE event_type IN ({reg}, {order}) AND event_id IS NOT NULL
               ORDER BY blended_user_id, event_type, event_ts NULLS LAST, event_id"""),
        ("o_ef", f"""SELECT e.*, r.first_id AS first_registration_event_id, o.first_id AS first_order_event_id
               FROM o_use e
               LEFT JOIN o_firsts r ON r.event_type = {reg} AND r.blended_user_id IS NOT DISTINCT FROM e.blended_user_id
               LEFT JOIN o_firsts o ON o.event_type = {order}
                 AND o.blended_user_id IS NOT DISTINCT FROM e.blended_user_id
               WHERE e.event_type = {order} OR (e.event_type = {reg} AND e.event_id = r.first_id)"""),
        ("o_kind", f"""SELECT *, event_type = {order} AS is_order, event_type = {reg} AS is_reg,
                 event_type = {order} AND event_id = first_order_event_id AS is_first,
                 event_type = {order} AND event_id <> first_order_event_id AS is_repeat
               FROM o_ef"""),
        ("o_ce", """SELECT blended_user_id, session_id, event_type, order_id, event_ts AS converted_ts,
                 IF(is_first, order_value, 0) AS first_order_revenue,
                 IF(is_repeat, order_value, 0) AS repeat_order_revenue,
                 IF(is_order, 1, 0) AS count_conversions, IF(is_order, 1, 0) AS count_order_conversions,
                 IF(is_first, 1, 0) AS count_first_order_conversions,
                 IF(is_repeat, 1, 0) AS count_repeat_order_conversions,
                 IF(is_reg, 1, 0) AS count_registration_conversions
               FROM o_kind"""),
        ("o_cs", f"""SELECT session_id, {"blended_user_id" if by_user else "MAX(blended_user_id) AS blended_user_id"},
                 SUM(IF(is_first, order_value, 0)) AS first_order_revenue,
                 SUM(IF(is_repeat, order_value, 0)) AS repeat_order_revenue,
                 CAST(COUNT(*) FILTER (WHERE is_first) AS BIGINT) AS count_first_order_conversions,
                 CAST(COUNT(*) FILTER (WHERE is_repeat) AS BIGINT) AS count_repeat_order_conversions,
                 CAST(COUNT(*) FILTER (WHERE is_order) AS BIGINT) AS count_order_conversions,
                 CAST(COUNT(*) FILTER (WHERE is_reg) AS BIGINT) AS count_registration_conversions,
                 CAST(COUNT(*) FILTER (WHERE is_reg OR is_first OR is_repeat) AS BIGINT) AS count_conversions,
                 MAX(event_ts) AS converted_ts, MIN(event_ts) AS min_converted_ts
               FROM o_kind GROUP BY session_id{", blended_user_id" if by_user else ""}"""),
        # ---- touchpoints (O13, O14): equal session rows first collapse into one row with a number of copies
        ("o_visits", """SELECT blended_user_id, session_id, session_start_ts, session_end_ts, utm_source, utm_medium,
                 utm_campaign, referrer_host, channel, city, continent, country, region,
                 ANY_VALUE(events) AS events, COUNT(*) AS copies
               FROM o_uss GROUP BY ALL"""),
        ("o_labelled", f"""SELECT v.* EXCLUDE (copies), CAST(NULL AS VARCHAR) AS utm_content,
                 COALESCE(LOWER(utm_source) NOT IN ({direct}), TRUE) AS is_non_direct_channel,
                 COALESCE(LOWER(utm_medium) LIKE {_q(cfg.paid_medium_pattern)}, FALSE) AS is_paid_channel,
                 c.converted_ts, c.min_converted_ts, c.first_order_revenue, c.repeat_order_revenue,
                 COALESCE(c.count_conversions > 0, FALSE) AS conversion_session,
                 {", ".join(f"CAST(COALESCE(copies * c.{m}, 0) AS BIGINT) AS {m}" for m in COUNTS)},
                 {", ".join(f"IF(c.{m} > 0, 1, 0) AS {flag}" for m, flag in COUNTS.items())}
               FROM o_visits v LEFT JOIN o_cs c ON v.session_id = c.session_id{user_match}"""),
        ("o_seq", f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY blended_user_id ORDER BY {TORD}) AS session_seq
               FROM o_labelled"""),
        ("o_tl", """SELECT s.*, n.next_ts AS conversion_cycle_conversion_ts
               FROM (SELECT *, COALESCE(blended_user_id, chr(1)) AS u FROM o_seq) s
               ASOF JOIN (SELECT COALESCE(blended_user_id, chr(1)) AS u, session_seq, converted_ts AS next_ts
                          FROM o_seq WHERE converted_ts IS NOT NULL) n
                 ON s.u = n.u AND s.session_seq <= n.session_seq
               WHERE n.next_ts >= s.session_start_ts"""),
        # ---- running totals and cycles (O15, O16): one more than the total unless this session converts
        ("o_rc", "SELECT * EXCLUDE (u), " + ", ".join(
            f"CAST(SUM({src}) OVER so_far AS BIGINT) AS {total}" for total, (src, _, _) in TOTALS.items())
            + " FROM o_tl WINDOW so_far AS (PARTITION BY blended_user_id ORDER BY session_seq)"),
        ("o_cc", "SELECT *, " + ", ".join(f"CAST({total} + 1 - {flag} AS BIGINT) AS {cycle}"
                                          for total, (_, flag, cycle) in TOTALS.items() if cycle)
            + f""", CAST(CAST(session_start_ts AS DATE) - DATE '{cfg.epoch_date}' AS INTEGER) AS session_day_number
               FROM o_rc"""),
        # ---- look-back and time decay
        ("o_cycle", "SELECT blended_user_id AS cyc_user, user_conversion_cycle AS cyc, "
            "MAX(session_day_number) AS cyc_last_day, "
            + ", ".join(f"MAX({m}) AS cyc_{m}" for m in MEASURES.values()) + " FROM o_cc GROUP BY 1, 2"),
        ("o_dc", f"""SELECT *, cyc_last_day - session_day_number AS days_before_conversion,
                 session_day_number >= cyc_last_day - {cfg.lookback_days} AS is_within_attribution_lookback_window,
                 session_day_number >= cyc_last_day - {cfg.time_decay_days}
                   AS is_within_attribution_time_decay_days_window
               FROM o_cc JOIN o_cycle ON blended_user_id IS NOT DISTINCT FROM cyc_user AND user_conversion_cycle = cyc"""),
        ("o_day", f"""SELECT blended_user_id AS day_user, session_day_number AS day_no,
                 COUNT(session_id) FILTER (WHERE {eligible}) AS day_sessions FROM o_cc GROUP BY 1, 2"""),
        ("o_split", f"""SELECT *, {power} AS age_power, {eligible} AS eligible,
                 IF(conversion_session, 1, day_sessions) AS sessions_within_day_to_conversion
               FROM o_dc JOIN o_day ON blended_user_id IS NOT DISTINCT FROM day_user AND session_day_number = day_no"""),
        ("o_sp", f"""SELECT *,
                 IF(is_within_attribution_time_decay_days_window,
                    age_power / NULLIF(CAST({float(cfg.time_decay_divisor)} AS DOUBLE), 0), NULL) AS time_decay_score,
                 IF(conversion_session, 1, age_power) AS weighting,
                 CASE WHEN conversion_session THEN 1 WHEN day_sessions > 0 THEN age_power / day_sessions ELSE 0 END
                   AS weighting_split_by_days_sessions,
                 time_decay_score / NULLIF(sessions_within_day_to_conversion, 0) AS apportioned_time_decay_score
               FROM o_split"""),
        # ---- cycle channel flags and weights (O19-O27): sessions chosen per cycle, matched by id
        ("o_pick", "SELECT blended_user_id AS pick_user, user_conversion_cycle AS pick_cycle, "
            + ", ".join(f"""ARG_MIN(session_id, session_seq) FILTER (WHERE session_id IS NOT NULL AND {cond}) AS first_{name},
                 ARG_MAX(session_id, session_seq) FILTER (WHERE session_id IS NOT NULL AND {cond}) AS last_{name},
                 COUNT_IF({cond}) > 0 AS any_{name}""" for name, cond in (
                ("touch", "TRUE"), ("non_direct", "is_non_direct_channel"), ("paid", "is_paid_channel")))
            + """, COUNT(session_id) AS n_touch
               FROM o_sp WHERE eligible AND is_within_attribution_lookback_window GROUP BY 1, 2"""),
        ("o_score", """SELECT blended_user_id AS score_user, user_conversion_cycle AS score_cycle,
                 SUM(apportioned_time_decay_score) AS score_sum FROM o_sp WHERE eligible GROUP BY 1, 2"""),
        ("o_acf", "SELECT *, " + ", ".join(
            [f"COALESCE(session_id = {end}_{name}, FALSE) AS is_{end}_{name}_channel_in_conversion_cycle"
             for name in ("non_direct", "paid") for end in ("first", "last")]
            + [f"COALESCE(any_{name}, FALSE) AS is_conversion_cycle_with_{name}" for name in ("non_direct", "paid")])
            + """ FROM o_sp
               LEFT JOIN o_pick ON blended_user_id IS NOT DISTINCT FROM pick_user AND user_conversion_cycle = pick_cycle
               LEFT JOIN o_score ON blended_user_id IS NOT DISTINCT FROM score_user
                 AND user_conversion_cycle = score_cycle"""),
        ("o_pct", "SELECT *, " + ", ".join(f"IF(eligible AND session_id = {credited}, 1, 0) AS {name}" for name, credited in (
            ("last_click_attrib_pct", "last_touch"),
            ("first_click_attrib_pct", "first_touch"),
            ("last_non_direct_click_attrib_pct", "IF(any_non_direct, last_non_direct, last_touch)"),
            ("first_non_direct_click_attrib_pct", "IF(any_non_direct, first_non_direct, first_touch)"),
            ("last_paid_click_attrib_pct", "IF(any_paid, last_paid, last_touch)"),
            ("first_paid_click_attrib_pct", "IF(any_paid, first_paid, first_touch)")))
            + """, IF(eligible AND is_within_attribution_lookback_window AND n_touch > 0, 1 / n_touch, 0)
                 AS even_click_attrib_pct,
               CASE WHEN NOT eligible THEN 0 WHEN is_within_attribution_time_decay_days_window
                 THEN apportioned_time_decay_score / NULLIF(score_sum, 0) END AS time_decay_attrib_pct
               FROM o_acf"""),
    ]


OUTPUT_TAIL = """blended_user_id, session_id, session_start_ts, session_end_ts, session_seq, user_conversion_cycle,
    is_first_non_direct_channel_in_conversion_cycle, is_last_non_direct_channel_in_conversion_cycle,
    is_conversion_cycle_with_non_direct, is_first_paid_channel_in_conversion_cycle,
    is_last_paid_channel_in_conversion_cycle, is_conversion_cycle_with_paid, is_non_direct_channel, is_paid_channel,
    conversion_session AS is_conversion_session, utm_source, utm_medium, utm_campaign, referrer_host, channel, city,
    continent, country, region"""


SESSION_COLUMNS = """user_pseudo_id, session_start_ts, session_end_ts, session_id, session_number,
    referrer_host, landing_page_path, landing_page_title, utm_campaign, utm_medium, utm_source, channel,
    device, CAST(NULL AS VARCHAR) AS mobile_brand_name, CAST(NULL AS VARCHAR) AS mobile_model_name,
    CAST(NULL AS VARCHAR) AS mobile_marketing_name, CAST(NULL AS VARCHAR) AS mobile_os_hardware_model,
    CAST(NULL AS VARCHAR) AS operating_system, CAST(NULL AS VARCHAR) AS operating_system_version,
    CAST(NULL AS VARCHAR) AS vendor_id, CAST(NULL AS VARCHAR) AS advertising_id,
    CAST(NULL AS VARCHAR) AS language, CAST(NULL AS BOOLEAN) AS is_limited_ad_tracking,
    CAST(NULL AS INTEGER) AS time_zone_offset_seconds, CAST(NULL AS VARCHAR) AS browser,
    CAST(NULL AS VARCHAR) AS browser_version, CAST(NULL AS VARCHAR) AS hostname,
    continent, country, region, city, events"""


def _models_sql(models: tuple[str, ...]) -> str:
    pairs = ", ".join(f"{{'model': {_q(m)}, 'weight': CAST({MODEL_WEIGHTS[m]} AS DOUBLE)}}" for m in models)
    measures = ", ".join(f"ROUND(CAST(cyc_{m} AS DOUBLE) * share.weight, 6) AS {out}" for out, m in MEASURES.items())
    return f"""SELECT share.model AS model, {OUTPUT_TAIL}, {measures}
        FROM (SELECT *, UNNEST([{pairs}]) AS share FROM o_pct)"""


def _with(cfg: AttributionConfig, select: str, irregular: bool = False) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _ctes(cfg, irregular)) + "\n" + select


TP = "blended_user_id, session_id, session_start_ts, session_end_ts, session_seq"


def _r(col: str) -> str:
    return f"ROUND({col}, 6) AS {col}"


def oracle_sql() -> dict[str, str]:
    d = DEFAULT_CONFIG
    sql = {
        "export_scan": _with(d, f"""SELECT event_timestamp, event_date, event_name, user_pseudo_id, user_id, platform,
            ts_name AS traffic_source_name, ts_medium AS traffic_source_medium, ts_source AS traffic_source_source,
            5 AS n_event_params, concat('ga_session_id=|', p_ga_session_id, '|||;ga_session_number=|',
              p_ga_session_number, '|||;page_location=', p_page_location, '||||;page_title=', p_page_title,
              '||||;page_referrer=', p_page_referrer, '||||') AS event_params,
            ROUND(purchase_revenue, 6) AS purchase_revenue, transaction_id, app_id, device_category,
            {", ".join(f"CAST(NULL AS {'INTEGER' if f.name == 'time_zone_offset_seconds' else 'VARCHAR'}) AS {f.name}"
                       for f in DEVICE.fields if f.name not in ("category", "web_info"))},
            CAST(NULL AS VARCHAR) AS browser_version, continent, country, region, city FROM o_export"""),
        "export_by_pattern": _with(d, """SELECT event_timestamp, event_date, event_name, user_pseudo_id, user_id,
            ts_source AS traffic_source_source, p_ga_session_id AS ga_session_id FROM o_export
            WHERE CAST(event_date AS INTEGER) % 2 = 0"""),
        "event_params": _with(d, """SELECT event_timestamp, user_pseudo_id, event_name,
            p_ga_session_id AS ga_session_id, p_ga_session_number AS ga_session_number,
            p_page_referrer AS page_referrer, p_page_location AS page_location, p_page_title AS page_title,
            CAST(NULL AS VARCHAR) AS missing_param FROM o_export"""),
        "events_flat": _with(d, "SELECT * REPLACE (ROUND(order_value, 6) AS order_value) FROM o_events"),
        "events_flat_variant": _with(d, "SELECT * REPLACE (ROUND(order_value, 6) AS order_value) FROM o_events"),
        "id_stitching": _with(d, "SELECT * FROM o_ids"),
        "sessions": _with(d, f"SELECT {SESSION_COLUMNS} FROM o_sess"),
        "session_event_count": _with(d, "SELECT session_id, events FROM o_sec"),
        "device_class": _with(d, "SELECT user_pseudo_id, session_start_ts, device_category, app_id, device FROM o_sess0"),
        "blended_sessions": _with(d, f"SELECT {SESSION_COLUMNS}, blended_user_id FROM o_uss"),
        "blended_events": _with(d, "SELECT * REPLACE (ROUND(order_value, 6) AS order_value) FROM o_use"),
        "converting_events_filtered": _with(d, "SELECT * REPLACE (ROUND(order_value, 6) AS order_value) FROM o_ef"),
        "converting_events": _with(d, f"""SELECT * REPLACE ({_r('first_order_revenue')}, {_r('repeat_order_revenue')})
            FROM o_ce"""),
        "converting_sessions": _with(d, f"""SELECT * REPLACE ({_r('first_order_revenue')},
            {_r('repeat_order_revenue')}) FROM o_cs"""),
        "lost_conversions": _with(d, """SELECT CAST(COUNT(*) AS BIGINT) AS lost_converting_sessions,
            CAST(COALESCE(SUM(count_conversions), 0) AS BIGINT) AS lost_conversions,
            ROUND(COALESCE(SUM(COALESCE(first_order_revenue, 0) + COALESCE(repeat_order_revenue, 0)), 0), 6)
              AS lost_revenue
            FROM o_cs c WHERE NOT EXISTS (SELECT 1 FROM o_sess0 s WHERE s.session_id = c.session_id)"""),
        "channel_flags": _with(d, f"""SELECT user_pseudo_id, session_start_ts, session_id, utm_source, utm_medium,
            CASE WHEN LOWER(utm_source) IN ({", ".join(_q(s) for s in d.direct_sources)}) THEN FALSE ELSE TRUE END
              AS is_non_direct_channel,
            CASE WHEN LOWER(utm_medium) LIKE {_q(d.paid_medium_pattern)} THEN TRUE ELSE FALSE END AS is_paid_channel
            FROM o_sess0"""),
        "touchpoints": _with(d, f"""SELECT * EXCLUDE (u) REPLACE ({_r('first_order_revenue')},
            {_r('repeat_order_revenue')}) FROM o_tl"""),
        "running_conversions": _with(d, f"""SELECT {TP}, user_total_conversions, user_total_order_conversions,
            user_total_registration_conversions, user_total_first_order_conversions,
            user_total_repeat_order_conversions FROM o_rc"""),
        "conversion_cycles": _with(d, f"""SELECT {TP}, user_registration_conversion_cycle, user_conversion_cycle,
            user_first_order_conversion_cycle, user_repeat_order_conversion_cycle FROM o_cc"""),
        "lookback_windows": _with(d, f"""SELECT {TP}, user_conversion_cycle, session_day_number, days_before_conversion,
            is_within_attribution_lookback_window, is_within_attribution_time_decay_days_window FROM o_dc"""),
        "time_decay_scores": _with(d, f"""SELECT {TP}, user_conversion_cycle, {_r('time_decay_score')},
            {_r('weighting')}, sessions_within_day_to_conversion, {_r('weighting_split_by_days_sessions')},
            {_r('apportioned_time_decay_score')} FROM o_sp"""),
        "cycle_channel_flags": _with(d, f"""SELECT {TP}, user_conversion_cycle,
            is_first_non_direct_channel_in_conversion_cycle, is_last_non_direct_channel_in_conversion_cycle,
            is_conversion_cycle_with_non_direct, is_first_paid_channel_in_conversion_cycle,
            is_last_paid_channel_in_conversion_cycle, is_conversion_cycle_with_paid FROM o_acf"""),
    }
    weights = {
        "attrib_last_click": "last_click_attrib_pct",
        "attrib_last_non_direct": "last_non_direct_click_attrib_pct",
        "attrib_last_paid": "last_paid_click_attrib_pct",
        "attrib_first_click": "first_click_attrib_pct",
        "attrib_first_non_direct": "first_non_direct_click_attrib_pct",
        "attrib_first_paid": "first_paid_click_attrib_pct",
        "attrib_linear": "even_click_attrib_pct",
        "attrib_time_decay": "time_decay_attrib_pct",
    }
    for name, col in weights.items():
        val = _r(col) if col in ("even_click_attrib_pct", "time_decay_attrib_pct") else col
        sql[name] = _with(d, f"SELECT {TP}, user_conversion_cycle, {val} FROM o_pct")
    l5 = d.with_(lookback_days=5)
    sql["attrib_linear_lookback5"] = _with(l5, f"SELECT {TP}, user_conversion_cycle, "
                                               f"{_r('even_click_attrib_pct')} FROM o_pct")
    sql["attrib_first_click_lookback5"] = _with(l5, f"SELECT {TP}, user_conversion_cycle, first_click_attrib_pct "
                                                    f"FROM o_pct")
    sql["attributed_measures"] = _with(d, _models_sql((FIRST_NON_DIRECT,)))
    for name, cfg in (("attribution", d), ("attribution_lookback5", l5),
                      ("attribution_user_session", d.with_(session_key="user_session")),
                      ("attribution_no_conversion_session", d.with_(include_conversion_session=False)),
                      ("attribution_recent_decay", d.with_(time_decay_direction="recent"))):
        sql[name] = _with(cfg, _models_sql(cfg.models))
    # Chunks are a matter of the Spark plan alone.
    for name in ("sessions", "touchpoints", "time_decay_scores", "attribution"):
        sql[f"{name}_16_chunks"] = sql[name]
    for name in ("session_event_count", "converting_sessions", "lost_conversions", "sessions", "touchpoints",
                 "time_decay_scores", "attribution"):
        select = sql[name].removeprefix(_with(d, ""))
        sql[f"{name}_irregular"] = _with(d, select, irregular=True)
    for name, cfg in (("user_session", d.with_(session_key="user_session")),
                      ("no_conversion_session", d.with_(include_conversion_session=False))):
        sql[f"attribution_irregular_{name}"] = _with(cfg, _models_sql(cfg.models), irregular=True)
    return sql
