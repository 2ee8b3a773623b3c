"""Landing the export: rows are computed once, by code that the JVM compiles, and split by day and size."""

from __future__ import annotations

import pytest
from conftest import SF0001, export_row, make_export

from touchcredit.queries import q_lost_conversions as lost_conversions
from touchcredit.sources.adapter import events_to_export
from touchcredit.sources.export import land_export

HUGE_METHOD = 8000  # bytes of bytecode from which the JVM leaves a method interpreted


def _largest_method(spark, df):
    debug = getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$")
    stages = getattr(debug, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


@pytest.mark.parametrize("irregular", [False, True])
def test_the_adapters_rows_are_compiled(spark, irregular):
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _largest_method(spark, events_to_export(events, irregular)) < HUGE_METHOD
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_landing_computes_every_row_once(spark, scratch_dir):
    rows = [export_row(f"p{i}", "x", f"2024-01-{1 + i % 9:02d} 10:00", i) for i in range(200)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    export = make_export(spark, rows).repartition(4)
    land_export(export.mapInArrow(counted, export.schema), f"{scratch_dir}/landed")
    assert seen.value == 200
    landed = spark.read.schema(export.schema).parquet(f"{scratch_dir}/landed")
    assert landed.count() == 200 and landed.select("event_date").distinct().count() == 9


def test_lost_conversions_scans_the_export_once(spark):
    plan = lost_conversions(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan parquet" not in plan  # only pinned rows are left to read
