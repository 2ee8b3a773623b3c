"""The chunked scans and group statistics equal plain per-key windows, also when
one key holds a large share of the rows and spans many chunks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchcredit.functions.columns import non_null_key
from touchcredit.plans import chunked as ck


def _data(spark, n=4000, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        r = rng.random()
        key = "hot" if r < 0.4 else (None if r < 0.45 else f"k{rng.randint(0, 60)}")
        rows.append((key, rng.randint(0, 400), i, rng.choice([None, 0, 1, 2, 5])))
    return spark.createDataFrame(rows, "k string, t long, id long, v long")


@pytest.mark.parametrize("chunk_rows", [250, 40, 3, 10 ** 6])
def test_scan_and_group_stats_match_plain_windows(spark, chunk_rows):
    df = _data(spark)
    order = ck.Order(("t", "id"))
    key = non_null_key(F.col("k"))
    heavy = ck.heavy_keys(ck.key_counts(df, key), chunk_rows)
    tagged = ck.arrange(df, key, order, ["id"], heavy=heavy, chunk_rows=chunk_rows)
    if chunk_rows == 10 ** 6:
        assert heavy is None and tagged.cut is None
    else:
        assert heavy.count() <= 4000 / chunk_rows
        sizes = [r["count"] for r in tagged.cut.groupBy(ck.KEY, ck.CHUNK).count().collect()]
        assert max(sizes) <= 3 * chunk_rows  # no key is left in one task
        assert tagged.plain.groupBy(ck.KEY).count().filter(F.col("count") > chunk_rows).isEmpty()
    out = ck.ordered_scan(tagged, order, row_number="rn", running_sums={"s": "v"}, lead={"nx": "t"},
                          lag={"pv": "t"}, next_non_null={"nn": "v"},
                          prev_non_null={"pn": "v"})
    out = ck.group_stats(out, F.floor(F.col("t") / 50).cast("long"),
                         {"g_max": (F.max("v"), "max"), "g_cnt": (F.count("v"), "sum"),
                          "g_sum": (F.sum("v"), "sum"), "g_min": (F.min("id"), "min")})
    got = {r.id: r for r in out.rows().collect()}

    w = Window.partitionBy("k").orderBy("t", "id")
    rev = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("id").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    g = Window.partitionBy("k", F.floor(F.col("t") / 50))
    ref = df.select("id", F.row_number().over(w).alias("rn"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("s"),
                    F.lead("t").over(w).alias("nx"), F.lag("t").over(w).alias("pv"),
                    F.last("v", ignorenulls=True).over(rev).alias("nn"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("pn"),
                    F.max("v").over(g).alias("g_max"), F.count("v").over(g).alias("g_cnt"),
                    F.sum("v").over(g).alias("g_sum"), F.min("id").over(g).alias("g_min"))
    n = 0
    for r in ref.collect():
        x = got[r.id]
        for c in ("rn", "s", "nx", "pv", "nn", "pn", "g_max", "g_cnt", "g_sum", "g_min"):
            assert x[c] == r[c], (r.id, c, x[c], r[c])
        n += 1
    assert n == 4000 == len(got)


def test_copies_under_a_heavy_key_become_one_row(spark):
    df = spark.createDataFrame([("hot", i % 7, 1) for i in range(3000)] + [("k", 1, 1), ("k", 1, 1), (None, 2, 1)],
                               "k string, t long, m long").repartition(6)
    key = non_null_key(F.col("k"))
    heavy = ck.heavy_keys(ck.key_counts(df, key), 100)
    out = ck.arrange(df, key, ck.Order(("t",)), ["k", "t"], "m", heavy, 100).rows()
    assert sorted((r.k or "", r.t, r.m) for r in out.collect()) == sorted(
        [("hot", i, 3000 // 7 + (i < 3000 % 7)) for i in range(7)] + [("k", 1, 2), ("", 2, 1)])


def test_split_points_are_searched_by_halving(spark):
    rows = [(points, x) for points in ([], [5], [1, 3, 5, 7], list(range(0, 60, 3))) for x in range(-1, 62)]
    df = spark.createDataFrame(rows, "p array<long>, x long")
    got = df.select("p", "x", ck._points_passed(F.col("p"), F.col("x")).alias("n")).collect()
    assert all(r.n == sum(p <= r.x for p in r.p) for r in got if r.p)


@pytest.mark.parametrize("hot_rows", [10 ** 6, 500])
def test_many_heavy_keys_are_not_broadcast(spark, monkeypatch, hot_rows):
    """More heavy keys and chunks than may be broadcast: the same results, with only the hot keys known everywhere."""
    monkeypatch.setattr(ck, "BROADCAST_KEYS", 5, raising=False)
    monkeypatch.setattr(ck, "BROADCAST_ROWS", 5, raising=False)
    monkeypatch.setattr(ck, "DEFAULT_CHUNK_ROWS", hot_rows)
    sent = []
    hint = F.broadcast
    monkeypatch.setattr(ck.F, "broadcast", lambda df: sent.append(df.count()) or hint(df))
    test_scan_and_group_stats_match_plain_windows(spark, 3)
    assert max(sent, default=0) <= 5


def test_many_heavy_keys_that_fit_a_task_run_no_rounds(spark, monkeypatch):
    """Chunks of keys that a task holds: carried in one lazy plan, no checkpoint, no cached rows, one exchange."""
    monkeypatch.setattr(ck, "BROADCAST_KEYS", 5)
    df = _data(spark)
    order = ck.Order(("t", "id"))
    heavy = ck.heavy_keys(ck.key_counts(df, non_null_key(F.col("k"))), 3)
    pinned = []
    pin = ck.checkpoint
    monkeypatch.setattr(ck, "checkpoint", lambda d: pinned.append(d) or pin(d))
    with ck.owned_by(ck.Rounds()) as rounds:
        out = ck.arrange(df, non_null_key(F.col("k")), order, ["id"], heavy=heavy, chunk_rows=3)
        out = ck.ordered_scan(out, order, row_number="rn", running_sums={"s": "v"}, next_non_null={"nn": "v"},
                              group=F.floor(F.col("t") / 50).cast("long"), group_aggs={"g": (F.sum("v"), "sum")})
        out = ck.group_stats(out, F.floor(F.col("t") / 90).cast("long"), {"h": (F.max("v"), "max")})
        assert out.cut.agg(F.max(ck.CHUNK)).first()[0] > 400
    assert not pinned and not rounds.staged
    assert out.rows()._jdf.queryExecution().sparkPlan().toString().count("REPARTITION") == 1
