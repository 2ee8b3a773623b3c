"""The refreshed attribution table equals a full rebuild after any sequence of loads."""

from __future__ import annotations

import os

import pytest
from conftest import SF0001, export_row, make_export
from pyspark.sql import functions as F

from touchcredit.config import AttributionConfig
from touchcredit.plans.incremental import AttributionTable
from touchcredit.plans.pipeline import Attribution
from touchcredit.queries import landed_export, round_doubles


def rows(df):
    return sorted(map(repr, round_doubles(df, 9).collect()))


@pytest.mark.parametrize("cfg, loads", [(AttributionConfig(), 3), (AttributionConfig(session_key="user_session", chunk_rows=4), 2)])
def test_random_loads_equal_a_rebuild(spark, scratch_dir, cfg, loads):
    export = landed_export(spark, SF0001, irregular=True)
    part = F.pmod(F.xxhash64("user_pseudo_id", "event_timestamp", "event_name"), F.lit(loads))  # late rows in every load
    table = AttributionTable(spark, os.path.join(scratch_dir, "attribution"), cfg, buckets=8)
    for n in range(loads):
        done = table.refresh(export.filter(part == n))
        assert done.version == n + 1
        with Attribution(export.filter(part <= n), cfg) as full:
            assert rows(table.read()) == rows(full.result)


def test_only_buckets_of_touched_users_are_written(spark, scratch_dir):
    def day(n):
        return [row for u in range(12) for row in (
            export_row(f"p{u}", "session_start", f"2024-01-0{n} 10:00", 100 * n + u),
            export_row(f"p{u}", "file_download", f"2024-01-0{n} 10:05", 100 * n + u, revenue=1.0 + u, txn=f"t{n}-{u}"))]

    first, more = day(1), [
        export_row("p3", "session_start", "2024-01-02 09:00", 901),
        export_row("p3", "Form Submitted", "2024-01-02 09:01", 901, user_id="u1"),  # p3 and p4 become one user
        export_row("p4", "Form Submitted", "2024-01-02 09:02", 104, user_id="u1"),
        export_row("p5", "file_download", "2024-01-02 09:03", 106, revenue=9.0, txn="t9")]  # under p6's session id
    table = AttributionTable(spark, os.path.join(scratch_dir, "a"), buckets=64)
    table.refresh(make_export(spark, first))
    before = table.manifest()["buckets"]
    done = table.refresh(make_export(spark, more))
    after = table.manifest()["buckets"]
    touched = {r.blended_user_id: r.b for r in table.read().select(
        "blended_user_id", table._bucket(F.concat(F.lit("1"), "blended_user_id")).alias("b")).distinct().collect()}
    assert {"u1", "p5", "p6"} <= set(touched) and not {"p3", "p4"} & set(touched)
    assert {touched[u] for u in ("u1", "p5", "p6")} <= set(done.buckets) and len(done.buckets) <= 5
    kept = {b for b in before if int(b) not in done.buckets}
    assert kept and all(after[b] == 1 for b in kept)
    with Attribution(make_export(spark, first + more)) as full:
        assert rows(table.read()) == rows(full.result)


def test_a_failed_refresh_is_not_seen_and_can_be_repeated(spark, scratch_dir, monkeypatch):
    load = make_export(spark, [export_row("a", "session_start", "2024-01-01 10:00", 1),
                               export_row("a", "file_download", "2024-01-01 10:05", 1, revenue=5.0, txn="t1")])
    later = make_export(spark, [export_row("a", "file_download", "2024-01-01 10:06", 1, revenue=7.0, txn="t2")])
    table = AttributionTable(spark, os.path.join(scratch_dir, "a"), buckets=4)
    with pytest.raises(ValueError):
        table.read()
    table.refresh(load)
    seen = rows(table.read())
    publish = AttributionTable._publish
    monkeypatch.setattr(AttributionTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.refresh(later)
    assert rows(table.read()) == seen
    monkeypatch.setattr(AttributionTable, "_publish", publish)
    table.refresh(later)
    with Attribution(load.union(later)) as full:
        assert rows(table.read()) == rows(full.result) != seen
    with pytest.raises(ValueError):
        AttributionTable(spark, table.path, buckets=8).read()


def test_an_empty_load_changes_nothing(spark, scratch_dir):
    load = make_export(spark, [export_row("a", "session_start", "2024-01-01 10:00", 1),
                               export_row("a", "file_download", "2024-01-01 10:05", 1, revenue=5.0, txn="t1")])
    table = AttributionTable(spark, os.path.join(scratch_dir, "a"), buckets=4)
    table.refresh(load.limit(0))
    assert table.read().count() == 0
    table.refresh(load)
    assert table.read().count() == 7
    assert table.refresh(load.limit(0)).buckets == [] and table.read().count() == 7
