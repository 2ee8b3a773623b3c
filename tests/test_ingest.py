"""O01 batch read and O02 incremental landing."""

from __future__ import annotations

import os

from conftest import export_row, make_export

from touchcredit.sources.export import load_export
from touchcredit.streaming.ingest import load_export_incremental


def test_incremental_load_adds_only_new_files(spark, scratch_dir):
    src = os.path.join(scratch_dir, "stage", "daily")
    table = os.path.join(scratch_dir, "landing")
    ckpt = os.path.join(scratch_dir, "load-history")
    day1 = make_export(spark, [export_row("p1", "session_start", "2024-01-01 10:00", 1),
                               export_row("p1", "page_view", "2024-01-01 10:01", 1)])
    day1.coalesce(1).write.parquet(os.path.join(src, "d1"))
    assert load_export_incremental(spark, os.path.join(scratch_dir, "stage"), table, ckpt) == 2
    assert load_export_incremental(spark, os.path.join(scratch_dir, "stage"), table, ckpt) == 0
    day2 = make_export(spark, [export_row("p2", "session_start", "2024-01-02 10:00", 2)])
    day2.coalesce(1).write.parquet(os.path.join(src, "d2"))
    assert load_export_incremental(spark, os.path.join(scratch_dir, "stage"), table, ckpt) == 1
    assert load_export(spark, table).count() == 3


def test_load_export_pattern_and_missing_fields(spark, scratch_dir):
    root = os.path.join(scratch_dir, "exp")
    make_export(spark, [export_row("p1", "session_start", "2024-01-01 10:00", 1)]) \
        .select("event_timestamp", "event_name", "user_pseudo_id").write.parquet(os.path.join(root, "daily", "a"))
    make_export(spark, [export_row("p2", "x", "2024-01-01 11:00", 2)]).write.parquet(os.path.join(root, "other"))
    df = load_export(spark, root, pattern="daily/*.parquet")
    rows = df.collect()
    assert [r.user_pseudo_id for r in rows] == ["p1"]
    assert rows[0].traffic_source is None and rows[0].geo is None  # absent fields read as NULL


def test_variant_landing_round_trip(spark):
    from touchcredit.sources.export import from_variant, to_variant

    ex = make_export(spark, [export_row("p1", "session_start", "2024-01-01 10:00", 1, source="google", medium="cpc",
                                        revenue=3.5, txn="T"),
                             export_row("p2", "x", "2024-01-01 11:00", 2)])
    back = from_variant(to_variant(ex))
    assert sorted(map(str, back.collect())) == sorted(map(str, ex.collect()))


def test_attribution_sinks(spark, scratch_dir):
    from test_golden import g1_rows

    from touchcredit.plans.pipeline import attribution
    from touchcredit.sources.sinks import register_view, write_attribution

    result = attribution(make_export(spark, g1_rows()))
    out = os.path.join(scratch_dir, "attribution")
    write_attribution(result, out)
    back = spark.read.parquet(out)
    assert back.count() == 35 and back.select("model").distinct().count() == 7
    register_view(back, "attribution_g1")
    row = spark.sql("SELECT SUM(first_order_revenue) AS r FROM attribution_g1 WHERE model = 'Linear'").first()
    assert round(row.r, 6) == 50.0


def test_load_export_by_regular_expression_and_partition_folders(spark, scratch_dir):
    from touchcredit.sources.export import land_export

    root = os.path.join(scratch_dir, "stage")
    make_export(spark, [export_row("p1", "session_start", "2024-01-01 10:00", 1)]).write.parquet(f"{root}/daily/a")
    make_export(spark, [export_row("p2", "x", "2024-01-01 11:00", 2)]).write.parquet(f"{root}/other")
    assert [r.user_pseudo_id for r in load_export(spark, root, pattern="daily/.*").collect()] == ["p1"]
    assert load_export(spark, root, pattern="daily/*").count() == 1
    assert load_export(spark, root, pattern="none/.*").count() == 0
    landed = os.path.join(scratch_dir, "landed")
    land_export(make_export(spark, [export_row("p1", "x", "2024-01-01 10:00", 1),
                                    export_row("p1", "x", "2024-01-02 10:00", 1)]), landed)
    by_pattern = load_export(spark, landed, pattern=".*[.]parquet")
    assert sorted(r.event_date for r in by_pattern.collect()) == ["20240101", "20240102"]
    table, ckpt = os.path.join(scratch_dir, "again"), os.path.join(scratch_dir, "history")
    assert load_export_incremental(spark, landed, table, ckpt) == 2
    assert sorted(r.event_date for r in load_export(spark, table).collect()) == ["20240101", "20240102"]


def test_incremental_count_past_a_hundred_batches(spark, scratch_dir):
    src = os.path.join(scratch_dir, "many")
    make_export(spark, [export_row("p1", "x", "2024-01-01 10:00", i) for i in range(130)]) \
        .repartition(130).write.option("maxRecordsPerFile", 1).parquet(src)
    table, ckpt = os.path.join(scratch_dir, "t"), os.path.join(scratch_dir, "c")
    assert load_export_incremental(spark, src, table, ckpt, max_files_per_trigger=1) == 130
    assert load_export(spark, table).count() == 130


def test_pattern_prunes_files_before_any_is_opened(spark, scratch_dir):
    from touchcredit.sources.export import land_export

    landed = os.path.join(scratch_dir, "lan ded+x")  # a path that URIs encode
    days = [export_row("p1", "x", f"2024-01-{d:02d} 10:00", d) for d in range(1, 11)]
    land_export(make_export(spark, days), landed)
    some = load_export(spark, landed, pattern="event_date=2024010[1-3]/.*")
    assert sorted(r.event_date for r in some.collect()) == ["20240101", "20240102", "20240103"]

    def scans(p):
        out = [p] if p.nodeName().startswith("Scan parquet") else []
        it = p.children().iterator()
        while it.hasNext():
            out += scans(it.next())
        return out

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = load_export(spark, landed, pattern="event_date=2024010[1-3]/.*").select("user_pseudo_id")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    read = [s.metrics().apply("numFiles").value() for s in scans(plan)]
    assert read == [3]
    assert load_export(spark, landed, pattern="event_date=2024010?/*").count() == 9
    assert load_export(spark, landed, pattern="*").count() == 10


def test_incremental_load_by_path_pattern(spark, scratch_dir):
    stage, table, history = (os.path.join(scratch_dir, x) for x in ("stage", "table", "history"))
    make_export(spark, [export_row("p1", "x", "2024-01-01 10:00", 1)]).write.parquet(f"{stage}/daily/d1")
    make_export(spark, [export_row("p2", "x", "2024-01-01 11:00", 2)]).write.parquet(f"{stage}/hourly/h1")
    assert load_export_incremental(spark, stage, table, history, pattern="daily/.*") == 1
    make_export(spark, [export_row("p3", "x", "2024-01-02 10:00", 3)]).write.parquet(f"{stage}/daily/d2")
    assert load_export_incremental(spark, stage, table, history, pattern="daily/.*") == 1
    assert load_export_incremental(spark, stage, table, history, pattern="daily/.*") == 0
    rows = load_export(spark, table).collect()
    assert sorted((r.user_pseudo_id, r.event_date) for r in rows) == [("p1", "20240101"), ("p3", "20240102")]


def test_a_batch_that_failed_after_its_write_is_not_added_twice(spark, scratch_dir, monkeypatch):
    from touchcredit.streaming import ingest

    stage, table, history = (os.path.join(scratch_dir, x) for x in ("stage", "table", "history"))
    make_export(spark, [export_row("p1", "x", "2024-01-01 10:00", i) for i in range(5)]).write.parquet(f"{stage}/d1")
    commit = ingest._commit

    def failing(*args):
        commit(*args)
        raise OSError("lost before the stream committed")

    monkeypatch.setattr(ingest, "_commit", failing)
    try:
        load_export_incremental(spark, stage, table, history)
    except Exception as e:
        assert "lost before" in str(e)
    else:
        raise AssertionError("the batch should have failed")
    monkeypatch.setattr(ingest, "_commit", commit)
    make_export(spark, [export_row("p2", "x", "2024-01-02 10:00", 9)]).write.parquet(f"{stage}/d2")
    assert load_export_incremental(spark, stage, table, history) == 6
    assert load_export(spark, table).count() == 6
    other = os.path.join(scratch_dir, "other-history")  # another history adds its own batches, and replaces none
    assert load_export_incremental(spark, stage, table, other) == 6
    assert load_export(spark, table).count() == 12


def test_output_files_are_sized(spark, scratch_dir):
    from touchcredit.sources.sinks import write_attribution

    rows = spark.range(200_000).selectExpr("if(id % 10 = 0, 'B', 'A') AS model", "cast(id AS string) AS k",
                                           "sha2(cast(id AS string), 512) AS pad").repartition(40)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(4 << 20))
    try:
        write_attribution(rows, os.path.join(scratch_dir, "sized"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {m: [f for f in os.listdir(os.path.join(scratch_dir, "sized", f"model={m}")) if f.endswith(".parquet")]
             for m in "AB"}
    assert 3 <= len(files["A"]) <= 16 and 1 <= len(files["B"]) <= 3  # 40 tasks wrote 40 each before
    assert spark.read.parquet(os.path.join(scratch_dir, "sized")).count() == 200_000
