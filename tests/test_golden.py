"""Golden scenarios G1-G8 (FIXTURES.md section 3), expected values worked by hand."""

from __future__ import annotations

import pytest
from conftest import export_row, make_export

from touchcredit.config import DEFAULT_CONFIG, LAST_CLICK
from touchcredit.plans.pipeline import Attribution

S, O, R = "session_start", "file_download", "Form Submitted"


def g1_rows():
    return [
        export_row("p1", S, "2024-01-01 10:00", 101, source="google", medium="cpc"),
        export_row("p1", "page_view", "2024-01-01 10:01", 101, user_id="u42"),
        export_row("p1", S, "2024-01-03 10:00", 102, source="newsletter", medium="paid_social"),
        export_row("p1", S, "2024-01-05 10:00", 103, source="(direct)", medium="(none)"),
        export_row("p1", O, "2024-01-05 10:05", 103, revenue=50.0, txn="T1"),
        export_row("p2", S, "2024-01-07 09:00", 104, source="bing", medium="organic"),
        export_row("p2", "page_view", "2024-01-07 09:01", 104, user_id="u42"),
        export_row("p2", S, "2024-01-07 12:00", 105, source="(direct)", medium="(none)"),
        export_row("p2", O, "2024-01-07 12:10", 105, revenue=20.0, txn="T2"),
        export_row("p2", S, "2024-01-09 09:00", 106, source="(direct)", medium="(none)"),
    ]


def run(spark, rows, cfg=DEFAULT_CONFIG):
    a = Attribution(make_export(spark, rows), cfg)
    weights = a.stage("weights").collect()
    result = a.result.collect()
    return weights, result


def by_session(weights):
    return {r.session_id: r for r in weights}


def totals(result, model):
    rows = [r for r in result if r.model == model]
    return (sum(r.user_registration_conversions for r in rows), sum(r.first_order_conversions for r in rows),
            sum(r.repeat_order_conversions for r in rows), round(sum(r.first_order_revenue or 0 for r in rows), 6),
            round(sum(r.repeat_order_revenue or 0 for r in rows), 6))


def test_g1_base(spark):
    weights, result = run(spark, g1_rows())
    w = by_session(weights)
    assert sorted(w) == [101, 102, 103, 104, 105]
    assert {s: (w[s].blended_user_id, w[s].user_conversion_cycle, w[s].days_before_conversion, w[s].session_seq)
            for s in w} == {101: ("u42", 1, 4, 1), 102: ("u42", 1, 2, 2), 103: ("u42", 1, 0, 3),
                            104: ("u42", 2, 0, 4), 105: ("u42", 2, 0, 5)}
    expect = {
        "last_click_attrib_pct": [0, 0, 1, 0, 1],
        "first_click_attrib_pct": [1, 0, 0, 1, 0],
        "last_non_direct_click_attrib_pct": [0, 1, 0, 1, 0],
        "first_non_direct_click_attrib_pct": [1, 0, 0, 1, 0],
        "last_paid_click_attrib_pct": [0, 1, 0, 0, 1],
        "first_paid_click_attrib_pct": [0, 1, 0, 1, 0],
    }
    for col, vals in expect.items():
        assert [w[s][col] for s in (101, 102, 103, 104, 105)] == vals, col
    assert [round(w[s].even_click_attrib_pct, 6) for s in (101, 102, 103, 104, 105)] == \
        [round(1 / 3, 6)] * 3 + [0.5, 0.5]
    assert [round(w[s].time_decay_attrib_pct, 6) for s in (101, 102, 103, 104, 105)] == \
        [round(8 / 10.5, 6), round(2 / 10.5, 6), round(0.5 / 10.5, 6), round(1 / 3, 6), round(2 / 3, 6)]
    assert len(result) == 35
    for m in DEFAULT_CONFIG.models:
        assert totals(result, m) == (0, 1, 1, 50.0, 20.0), m


def test_g2_registration_opens_a_cycle(spark):
    rows = g1_rows() + [export_row("p1", R, "2024-01-01 10:01", 101), export_row("p1", R, "2024-01-03 10:01", 102)]
    weights, result = run(spark, rows)
    w = by_session(weights)
    assert {s: w[s].user_conversion_cycle for s in w} == {101: 1, 102: 2, 103: 2, 104: 3, 105: 3}
    lc = {r.session_id: r for r in result if r.model == LAST_CLICK}
    assert lc[101].user_registration_conversions == 1
    assert lc[103].first_order_revenue == 50.0 and lc[105].repeat_order_revenue == 20.0


def test_g3_window_boundaries(spark):
    days = [31, 30, 8, 7, 0]
    rows = []
    for i, d in enumerate(days):
        day = 2 + 31 - d  # conversion day 2024-02-02
        ts = f"2024-{'01' if day <= 31 else '02'}-{(day if day <= 31 else day - 31):02d} 10:00"
        rows.append(export_row("p9", S, ts, 900 + i, source="google", medium="organic"))
    rows.append(export_row("p9", O, "2024-02-02 10:30", 904, revenue=10.0, txn="T9"))
    weights, _ = run(spark, rows)
    w = by_session(weights)
    assert [w[900 + i].days_before_conversion for i in range(5)] == days
    assert [round(w[900 + i].even_click_attrib_pct, 6) for i in range(5)] == [0, 0.25, 0.25, 0.25, 0.25]
    assert [w[900 + i].first_click_attrib_pct for i in range(5)] == [0, 1, 0, 0, 0]
    td = [w[900 + i].time_decay_attrib_pct for i in range(5)]
    assert td[:3] == [None, None, None]
    assert round(td[3], 6) == round(64 / 64.5, 6) and round(td[4], 6) == round(0.5 / 64.5, 6)


def test_g4_all_direct(spark):
    rows = [export_row("p4", S, "2024-01-01 10:00", 401, source="(direct)", medium="(none)"),
            export_row("p4", S, "2024-01-02 10:00", 402, source="(direct)", medium="(none)"),
            export_row("p4", O, "2024-01-02 10:10", 402, revenue=10.0, txn="T4")]
    weights, _ = run(spark, rows)
    w = by_session(weights)
    assert (w[401].last_non_direct_click_attrib_pct, w[402].last_non_direct_click_attrib_pct) == (0, 1)
    assert (w[401].last_paid_click_attrib_pct, w[402].last_paid_click_attrib_pct) == (0, 1)
    assert (w[401].first_non_direct_click_attrib_pct, w[402].first_non_direct_click_attrib_pct) == (1, 0)
    assert (w[401].first_paid_click_attrib_pct, w[402].first_paid_click_attrib_pct) == (1, 0)
    assert not w[401].is_conversion_cycle_with_non_direct and not w[401].is_conversion_cycle_with_paid


def test_g5_repeated_session_id(spark):
    a = [export_row("p5", S, "2024-01-01 10:00", 301, source="google", medium="cpc"),
         export_row("p5", S, "2024-01-01 10:20", 301, source="google", medium="cpc"),
         export_row("p5", O, "2024-01-01 10:30", 301, revenue=30.0, txn="T5")]
    weights, result = run(spark, a)
    assert sorted(r.user_conversion_cycle for r in weights) == [1, 2]
    for m in DEFAULT_CONFIG.models:
        t = totals(result, m)
        assert (t[1] + t[2], t[3] + t[4]) == (2, 60.0), m
    b = [export_row("p6", S, "2024-01-01 10:00", 302, source="google", medium="cpc")] * 3 + \
        [export_row("p6", O, "2024-01-01 10:30", 302, revenue=30.0, txn="T6")]
    weights, result = run(spark, b)
    assert sorted((r.session_end_ts is None, r.count_first_order_conversions) for r in weights) == \
        [(False, 2), (True, 1)]
    for m in DEFAULT_CONFIG.models:
        t = totals(result, m)
        assert (t[1] + t[2], t[3] + t[4]) == (3, 60.0), m


def test_g6_conversion_before_session_start(spark):
    rows = [export_row("p7", S, "2024-01-01 10:00", 400, source="google", medium="cpc"),
            export_row("p7", S, "2024-01-02 10:00", 401, source="google", medium="cpc"),
            export_row("p7", O, "2024-01-02 09:59", 401, revenue=10.0, txn="T7a"),
            export_row("p7", S, "2024-01-03 10:00", 402, source="google", medium="cpc"),
            export_row("p7", O, "2024-01-03 10:30", 402, revenue=15.0, txn="T7b")]
    weights, result = run(spark, rows)
    w = by_session(weights)
    assert sorted(w) == [400, 402]
    assert (w[400].session_seq, w[402].session_seq) == (1, 3)
    assert (w[400].user_conversion_cycle, w[402].user_conversion_cycle) == (1, 1)
    lin = [r for r in result if r.model == "Linear"]
    assert sorted(r.repeat_order_revenue for r in lin) == [7.5, 7.5]
    assert totals(result, "Linear") == (0, 0, 1, 0.0, 15.0)


def test_g7_null_channel(spark):
    rows = [export_row("p8", S, "2024-01-01 10:00", 501),
            export_row("p8", S, "2024-01-02 10:00", 502, source="(direct)", medium="(none)"),
            export_row("p8", O, "2024-01-02 10:10", 502, revenue=10.0, txn="T8")]
    weights, _ = run(spark, rows)
    w = by_session(weights)
    assert w[501].is_non_direct_channel is True and w[501].is_paid_channel is False
    assert (w[501].last_non_direct_click_attrib_pct, w[502].last_non_direct_click_attrib_pct) == (1, 0)
    assert (w[501].last_paid_click_attrib_pct, w[502].last_paid_click_attrib_pct) == (0, 1)
    assert (w[501].first_paid_click_attrib_pct, w[502].first_paid_click_attrib_pct) == (1, 0)


@pytest.mark.parametrize("key,expected", [("session", {"pA": 40.0, "pB": 40.0}), ("user_session", {"pA": 40.0})])
def test_g8_colliding_session_ids(spark, key, expected):
    rows = [export_row("pA", S, "2024-01-01 10:00", 500, source="google", medium="cpc"),
            export_row("pB", S, "2024-01-01 10:05", 500, source="bing", medium="cpc"),
            export_row("pA", O, "2024-01-01 10:30", 500, revenue=40.0, txn="TA")]
    _, result = run(spark, rows, DEFAULT_CONFIG.with_(session_key=key))
    lc = {r.blended_user_id: r.first_order_revenue for r in result if r.model == LAST_CLICK}
    assert lc == expected
