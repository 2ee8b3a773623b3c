"""Plan shape of the attribution: scans of the export, shuffles of session rows,
no Python, no cached or pinned session rows without a heavy user."""

from __future__ import annotations

import pytest
from conftest import SF0001

from touchcredit.config import AttributionConfig
from touchcredit.plans import chunked as ck
from touchcredit.plans.pipeline import Attribution
from touchcredit.queries import landed_export

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow")


def _nodes(plan):
    """All operators, through cached relations too."""
    out = [plan]
    if plan.nodeName().startswith("InMemoryTableScan"):
        out += _nodes(plan.relation().cachedPlan())
    it = plan.children().iterator()
    while it.hasNext():
        out += _nodes(it.next())
    return out


@pytest.fixture()
def without_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _shuffles(nodes, column):
    """Shuffle exchanges whose rows carry ``column``."""
    return [n for n in nodes if n.nodeName() == "Exchange" and any(a.name() == column for a in _seq(n.output()))]


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def test_one_shuffle_per_ordered_stage(spark, without_aqe):
    a = Attribution(landed_export(spark, SF0001))
    nodes = _nodes(a.result._jdf.queryExecution().executedPlan())
    names = [n.nodeName() for n in nodes]
    # Only session rows carry a landing city: dealt by pseudo id, joined to conversions by session id, dealt by user.
    assert len(_shuffles(nodes, "city")) == 3, names
    assert "Union" not in names and not any(n.startswith("InMemoryTableScan") for n in names)
    assert names.count("Generate") == 2  # session ends; the models
    assert not any(p in n for n in names for p in PYTHON_NODES)
    windows = Attribution(landed_export(spark, SF0001))
    session_nodes = _nodes(windows.sessions.plain._jdf.queryExecution().executedPlan())
    assert len(_shuffles(session_nodes, "city")) == 1
    blended = _nodes(windows.blended_sessions._jdf.queryExecution().executedPlan())
    assert len(_shuffles(blended, "city")) == 1  # the login join reuses the stage's exchange


def test_the_export_is_scanned_once(spark, without_aqe):
    export = landed_export(spark, SF0001)
    seen = []
    pin = ck.checkpoint

    def watched(df):
        seen.append(df._jdf.queryExecution().executedPlan())
        return pin(df)

    ck.checkpoint = watched
    try:
        a = Attribution(export, AttributionConfig(chunk_rows=10))
        seen.append(a.result._jdf.queryExecution().executedPlan())
    finally:
        ck.checkpoint = pin
    scans = [n for p in seen for n in _nodes(p) if n.nodeName().startswith("Scan parquet")]
    assert len(scans) == 1
    assert "event_name" in scans[0].toString() and "PushedFilters" in scans[0].verboseStringWithOperatorId()
    assert len(seen) > 5  # heavy users: their rounds were looked at as well


def test_last_logins_are_hash_aggregated(spark, without_aqe):
    a = Attribution(landed_export(spark, SF0001))
    for df in (a.ids, a.logins):
        names = [n.nodeName() for n in _nodes(df._jdf.queryExecution().executedPlan())]
        assert "SortAggregate" not in names and "HashAggregate" in names


def test_plans_of_every_stage_build(spark):
    a = Attribution(landed_export(spark, SF0001))
    for name in ("sessions", "blended_sessions", "converting_sessions", "touchpoints_chunked", "weights"):
        assert a.stage(name).columns


def test_variant_reads_only_the_needed_leaves(spark, without_aqe):
    from pyspark.sql import functions as F

    from touchcredit.queries import landed_variant
    from touchcredit.sources.export import from_variant, variant_leaves

    landing = landed_variant(spark, SF0001)
    some = variant_leaves(landing).groupBy("geo.country").agg(F.max("event_timestamp"), F.max("device.category"))
    scan = [n for n in _nodes(some._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet")]
    read = scan[0].schema().simpleString()
    assert len(scan) == 1 and "variant" not in read  # three extractions are read in place of the column
    assert sum(read.count(k) for k in ("bigint", "string")) == 3, read
    want = from_variant(landing).groupBy("geo.country").agg(F.max("event_timestamp"), F.max("device.category"))
    assert sorted(map(str, some.collect())) == sorted(map(str, want.collect()))
