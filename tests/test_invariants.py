
from __future__ import annotations

from collections import defaultdict

import pytest
from conftest import SF0001

from touchcredit.config import DEFAULT_CONFIG
from touchcredit.plans.pipeline import Attribution
from touchcredit.queries import landed_export
from touchcredit.operators.weights import WEIGHT_COLUMNS


@pytest.fixture(scope="module")
def stages(spark):
    a = Attribution(landed_export(spark, SF0001))
    return a.stage("weights").collect(), a.result.collect()


def test_weights_sum_to_one_and_are_bounded(stages):
    weights, _ = stages
    sums = defaultdict(lambda: defaultdict(float))
    for r in weights:
        for c in WEIGHT_COLUMNS:
            v = r[c]
            if v is not None:
                assert 0.0 <= v <= 1.0 + 1e-12
                if c not in ("even_click_attrib_pct", "time_decay_attrib_pct"):
                    assert v in (0, 1)
                sums[(r.blended_user_id, r.user_conversion_cycle)][c] += v
    assert sums
    for key, per in sums.items():
        for c in WEIGHT_COLUMNS:
            assert abs(per[c] - 1.0) < 1e-9, (key, c, per[c])


def test_model_totals_equal_and_row_counts(stages):
    weights, result = stages
    by_model = defaultdict(lambda: [0, 0.0, 0.0, 0.0, 0.0, 0.0])
    for r in result:
        t = by_model[r.model]
        t[0] += 1
        t[1] += r.first_order_conversions or 0
        t[2] += r.repeat_order_conversions or 0
        t[3] += r.user_registration_conversions or 0
        t[4] += r.first_order_revenue or 0
        t[5] += r.repeat_order_revenue or 0
    assert set(by_model) == set(DEFAULT_CONFIG.models)
    first = by_model[DEFAULT_CONFIG.models[0]]
    for m, t in by_model.items():
        assert t[0] == len(weights)
        for a, b in zip(t[1:], first[1:]):
            assert abs(a - b) < 1e-6, m
    assert len(result) == 7 * len(weights)


def test_cycles_end_converting_and_have_no_gaps(stages):
    weights, _ = stages
    cycles = defaultdict(list)
    for r in weights:
        cycles[r.blended_user_id].append(r)
    for user, rows in cycles.items():
        rows.sort(key=lambda r: r.session_seq)
        numbers = sorted({r.user_conversion_cycle for r in rows})
        assert numbers == list(range(1, len(numbers) + 1)), user
        for c in numbers:
            last = [r for r in rows if r.user_conversion_cycle == c][-1]
            assert last.conversion_session and last.days_before_conversion == 0


def test_credit_stays_whole_without_conversion_sessions(spark):
    cfg = DEFAULT_CONFIG.with_(include_conversion_session=False)
    with Attribution(landed_export(spark, SF0001), cfg) as a:
        rows = a.stage("weights").collect()
    cycles = defaultdict(list)
    for r in rows:
        cycles[r.blended_user_id, r.user_conversion_cycle].append(r)
    assert any(len(c) == 1 for c in cycles.values()) and any(len(c) > 1 for c in cycles.values())
    for cycle in cycles.values():
        eligible = [r for r in cycle if not r.conversion_session and r.is_within_attribution_lookback_window]
        decaying = [r for r in eligible if r.is_within_attribution_time_decay_days_window]
        for c in WEIGHT_COLUMNS:
            some = decaying if c == "time_decay_attrib_pct" else eligible
            assert abs(sum(r[c] or 0 for r in cycle) - (1.0 if some else 0.0)) < 1e-9, c
