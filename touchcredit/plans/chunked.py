"""Skew-safe per-key ordered processing.

The attribution is a chain of per-user computations in time order: next
session start, session sequence number, running conversion counts, the next
conversion, and per-cycle / per-day totals.  Written as
``Window.partitionBy(user)``, Spark puts each user in one task, so one hot
user (NULL ids, bots) holding a third of all rows would become one task over
a third of the data.  This module runs the same computations with bounded
work per task:

1. ``arrange`` counts rows per key (partial counts, one column read).  Keys with
   more than ``chunk_rows`` rows are heavy: there are at most rows / chunk_rows
   of them, the proven bound of every broadcast here.
2. All other rows are ``plain``: one hash exchange on the key, and every later
   window, grouping and join on the key reuses it.  Nothing of them is pinned
   or cached; they are ordinary lazy plans.
3. Rows of heavy keys are ``cut``: collapsed map-side, pinned by a reliable
   checkpoint, and dealt to chunks along their order.  The chunk is a function of
   the row: a table of split points (every ``SAMPLE``-th row, in order, of a
   sample by row hash) is searched by halving.  Windows run per (key, chunk),
   so no window group is much over ``chunk_rows`` rows, and one exchange on (key,
   chunk) serves all of them.
4. Results of cut rows that cross a chunk boundary are corrected: carries for
   scans, merged partials for per-cycle and per-day statistics, from tables of
   2-4 rows per chunk, broadcast with that bound.  Each such round caches its
   rows and checkpoints only its small correction table; everything after the
   pin is a function of checkpointed data, so a lost block is recomputed to the
   same values.

Many heavy keys that each fit a task (a small ``chunk_rows``) are dealt whole, like plain
rows, and cut by their row numbers.  Their windows run per (key, chunk) too, and what
crosses a chunk is carried by windows over the chunks of the key in the same task
(:func:`_dealt_scan`), so nothing of them is pinned, cached, broadcast or moved once more.

:class:`Ordered` holds the two sets of rows; a table without hot keys never has
the second.  Cached rounds belong to a :class:`Rounds`; a pipeline opens its own
(:func:`owned_by`), so pipelines in one session never drop each other's rows.

All columns named here are internal and start with ``_ck_``.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT_CHUNK_ROWS
from ..functions.columns import nulls_last_key
from ..session import ensure_checkpoint_dir

KEY = "_ck_key"
CHUNK = "_ck_chunk"
TB = "_ck_tb"
RN = "_ck_rn"      # row number inside (key, chunk), cut rows only
CNT = "_ck_cnt"    # rows inside (key, chunk), cut rows only
_AT = "_ck_at"
_KIND = "_ck_kind"
_IS_CUT = "_ck_is_cut"
_BACK = "_ck_back"
_JOIN = "_ck_join"
_HOT = "_ck_hot"

SAMPLE = 32  # sampled rows per chunk
BROADCAST_KEYS = 1 << 13  # heavy keys that are broadcast; of more, only those too large for one task
BROADCAST_ROWS = 1 << 16  # rows of a correction table that is broadcast; a larger one is joined by (key, chunk)

_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing


@dataclass(frozen=True)
class Order:
    """An ascending, NULLS LAST order; ``columns`` are column names."""

    columns: tuple[str, ...]

    def asc(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in self.columns] + [F.col(TB).asc_nulls_last()]

    def desc(self) -> list[Column]:
        return [F.col(c).desc_nulls_first() for c in self.columns] + [F.col(TB).desc_nulls_first()]


@dataclass(frozen=True)
class Heavy:
    """Keys with more than ``chunk_rows`` rows.

    ``hot`` are broadcast: all of them, or, if they or their chunks are too many for that, those with more
    than ``DEFAULT_CHUNK_ROWS`` rows (at most rows / ``DEFAULT_CHUNK_ROWS``; None if there are none).  Of the
    others a task holds whole keys.
    """

    keys: DataFrame
    hot: DataFrame | None
    many: bool = False

    def count(self) -> int:
        return self.keys.count()


@dataclass(frozen=True)
class Ordered:
    """Rows of an ordered stage: those whose key a task holds whole, and those of other keys, pinned in chunks.

    Where heavy keys are many, dealt rows have a ``_ck_chunk`` as well.
    """

    dealt: DataFrame
    pinned: DataFrame | None = None
    heavy: Heavy | None = None  # the keys whose rows are cut

    @property
    def plain(self) -> DataFrame:
        """Rows of ordinary keys."""
        return self.dealt.filter(~F.col(_IS_CUT)) if _IS_CUT in self.dealt.columns else self.dealt

    @property
    def cut(self) -> DataFrame | None:
        """Rows of heavy keys, in chunks."""
        if _IS_CUT not in self.dealt.columns:
            return self.pinned
        inside = self.dealt.filter(_IS_CUT)
        return inside if self.pinned is None else inside.unionByName(self.pinned, allowMissingColumns=True)

    def each(self, step: Callable[[DataFrame], DataFrame]) -> "Ordered":
        """The same row-wise step on both."""
        return Ordered(step(self.dealt), None if self.pinned is None else step(self.pinned), self.heavy)

    @property
    def columns(self) -> list[str]:
        return self.dealt.columns

    def withColumn(self, name: str, column: Column) -> "Ordered":
        return self.each(lambda d: d.withColumn(name, column))

    def withColumns(self, columns: dict[str, Column]) -> "Ordered":
        return self.each(lambda d: d.withColumns(columns))

    def filter(self, condition: Column) -> "Ordered":
        return self.each(lambda d: d.filter(condition))

    def drop(self, *names: str) -> "Ordered":
        return self.each(lambda d: d.drop(*names))

    def rows(self) -> DataFrame:
        """All rows, without internal columns."""
        dealt = drop_internal(self.dealt)
        return dealt if self.pinned is None else dealt.unionByName(drop_internal(self.pinned))


def heavy_by_kind(counts: dict[str, DataFrame], limit: int, rows: DataFrame | None = None
                  ) -> dict[str, Heavy | None]:
    """Per kind the keys (``_ck_key``) whose ``n`` add up to more than ``limit``; None if there are none.

    One job finds and pins them all: at most rows / limit keys a kind.  ``rows``, if given, are what
    all kinds count: no key has more rows than they are, so up to ``limit`` of them nothing is counted by key.
    """
    if rows is not None and rows.count() <= limit:
        return dict.fromkeys(counts)
    parts = [c.groupBy(KEY).agg(F.sum("n").alias("n")).filter(F.col("n") > limit).select(F.lit(k).alias(_KIND), KEY, "n")
             for k, c in counts.items()]
    table = parts[0]
    for p in parts[1:]:
        table = table.unionAll(p)
    table = checkpoint(table)
    large = F.col("n") > DEFAULT_CHUNK_ROWS
    found = table.groupBy(_KIND).agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"),
                                     F.max(large).alias("large")).collect()  # at most one row a kind

    def heavy(kind: str, n_keys: int, n_rows: int, any_large: bool) -> Heavy:
        of_kind = table.filter(F.col(_KIND) == kind)
        keys = of_kind.select(KEY)
        if n_keys <= BROADCAST_KEYS and n_rows // limit <= BROADCAST_ROWS:
            return Heavy(keys, keys)
        return Heavy(keys, of_kind.filter(large).select(KEY) if any_large else None, many=True)

    return dict.fromkeys(counts) | {r[_KIND]: heavy(*r) for r in found}


def heavy_keys(counts: DataFrame, limit: int = DEFAULT_CHUNK_ROWS, rows: DataFrame | None = None) -> Heavy | None:
    """:func:`heavy_by_kind` of one kind."""
    return heavy_by_kind({"": counts}, limit, rows)[""]


def key_counts(rows: DataFrame, key: Column) -> DataFrame:
    """``_ck_key, n`` of ``rows``: pre-aggregated where the rows are read."""
    return rows.groupBy(key.alias(KEY)).agg(F.count(F.lit(1)).alias("n"))


def join_unique(big: DataFrame, small: DataFrame, key: Column, small_key: Column, heavy: Heavy | None,
                distinct: bool = False) -> DataFrame:
    """``big`` LEFT JOIN ``small``, which has one row per key.

    Keys are strings (as in ``heavy``); a NULL key matches nothing.  Rows of ``big`` under a heavy key
    never share a task because of it: their matches are a broadcast of at most one row per heavy key (per
    ``hot`` key if there are many; the rows of any other fit a task).  ``distinct``: no two rows of ``big`` are
    equal, so those under a heavy key spread by a hash of the row, and ``big`` is computed once.
    """
    names = small.columns
    small = small.withColumn(_JOIN, small_key)
    big = big.withColumn(KEY, key)

    def joined(rows: DataFrame, matches: DataFrame) -> DataFrame:
        return rows.join(matches, F.col(KEY) == F.col(_JOIN), "left").drop(KEY, _JOIN)

    if heavy is None or heavy.hot is None:
        return joined(big, small)
    if distinct:
        wanted = heavy.hot.withColumnRenamed(KEY, _JOIN)
        found = small.join(F.broadcast(wanted), _JOIN, "left_semi").select(_JOIN, F.struct(*names).alias(_HOT))
        known = wanted.join(found, _JOIN, "left").select(F.col(_JOIN).alias(KEY), F.struct(_HOT).alias(_HOT))
        nowhere = F.concat(F.lit("-"), F.xxhash64(*[F.col(c) for c in big.columns]).cast("string"))  # no key of small's
        routed = big.join(F.broadcast(known), KEY, "left").withColumn(
            KEY, F.when(F.col(_HOT).isNotNull(), nowhere).otherwise(F.col(KEY)))
        return routed.join(small, F.col(KEY) == F.col(_JOIN), "left").select(
            *[c for c in big.columns if c != KEY],
            *[F.when(F.col(_HOT).isNotNull(), F.col(_HOT)[_HOT][n]).otherwise(F.col(n)).alias(n) for n in names])
    known = F.broadcast(heavy.hot)
    matches = small.join(F.broadcast(heavy.hot.withColumnRenamed(KEY, _JOIN)), _JOIN, "left_semi")
    return joined(big.join(known, KEY, "left_anti"), small).unionByName(
        joined(big.join(known, KEY, "left_semi"), F.broadcast(matches)))


def arrange(rows: DataFrame, key: Column, order: Order, tiebreak: list[str], mult: str | None = None,
            heavy: Heavy | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> Ordered:
    """``rows`` with ``_ck_key`` and ``_ck_tb``, dealt by key; those of ``heavy`` keys cut into chunks.

    ``mult`` names a multiplicity: rows equal in all other columns become one,
    with the sum.  For plain rows that grouping reuses the key's exchange; copies
    under a heavy key are combined before they are shuffled.

    Where heavy keys are many, those whose rows fit a task are dealt by key like the plain rows, and cut by
    their row numbers in the same plan; only hot keys are broadcast, pinned and cut at split points.
    """
    tagged = rows.withColumn(KEY, key)

    def collapsed(df: DataFrame) -> DataFrame:
        one = df.groupBy(*[c for c in df.columns if c != mult]).agg(F.sum(mult).alias(mult)) if mult else df
        return one.withColumn(TB, F.xxhash64(*[F.col(c) for c in tiebreak]))

    if heavy is None:
        return Ordered(collapsed(tagged.repartition(KEY)))
    rest, cut = tagged, None
    if heavy.hot is not None:
        rest = tagged.join(F.broadcast(heavy.hot), KEY, "left_anti")
        cut = _in_chunks(checkpoint(collapsed(tagged.join(F.broadcast(heavy.hot), KEY, "left_semi"))), order, chunk_rows)
    dealt = collapsed(rest.repartition(KEY))
    if not heavy.many:
        return Ordered(dealt, cut, heavy)
    by_key = Window.partitionBy(KEY).orderBy(*order.asc())
    placed = dealt.withColumns({CHUNK: F.floor((F.row_number().over(by_key) - 1) / chunk_rows).cast("int"),
                                _IS_CUT: F.count(F.lit(1)).over(by_key.rowsBetween(_UNB, _UNF)) > chunk_rows})
    return Ordered(placed, cut, heavy)


def _in_chunks(cut: DataFrame, order: Order, chunk_rows: int) -> DataFrame:
    """Pinned rows with ``_ck_chunk``: how many of the key's split points are at or before the row."""
    at = nulls_last_key(*[F.col(c) for c in (*order.columns, TB)])
    step = max(1, chunk_rows // SAMPLE)
    per_chunk = max(1, chunk_rows // step)
    sample = cut.select(KEY, TB, at.alias(_AT)).filter(F.pmod(F.xxhash64(KEY, TB), F.lit(step)) == 0)
    place = F.row_number().over(Window.partitionBy(KEY).orderBy(_AT))
    points = checkpoint(sample.select(KEY, _AT, place.alias(RN)).filter(F.col(RN) % per_chunk == 0)
                        .groupBy(KEY).agg(F.sort_array(F.collect_list(_AT)).alias("_ck_points")))
    return (cut.join(F.broadcast(points), KEY, "left")
            .withColumn(CHUNK, F.coalesce(_points_passed(F.col("_ck_points"), at), F.lit(0)))
            .drop("_ck_points"))


def _points_passed(points: Column, at: Column) -> Column:
    """Number of the ascending ``points`` that are <= ``at``, by halving."""
    size = F.size(points)

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        passed = F.get(points, middle) <= at
        return F.when(s["lo"] < s["hi"], F.struct(F.when(passed, middle + 1).otherwise(s["lo"]).alias("lo"),
                                                  F.when(passed, s["hi"]).otherwise(middle).alias("hi"))).otherwise(s)

    steps = F.sequence(F.lit(1), F.ceil(F.log2(size + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), size.alias("hi")), halve, lambda s: s["lo"])


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint in the session's checkpoint folder (never local).

    One job computes and writes the rows; the result is a leaf plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    t = time.time()
    out = df.checkpoint(eager=True)
    if os.environ.get("TOUCHCREDIT_TRACE"):
        print(f"[chunked] checkpoint {time.time() - t:.2f}s", file=sys.stderr, flush=True)
    return out


@dataclass
class Rounds:
    """Cached rows of one pipeline's rounds."""

    staged: list[DataFrame] = field(default_factory=list)

    def retire(self, keep: DataFrame | None = None) -> None:
        """Drop cached rows of earlier rounds (they recompute from the pinned rows if read again)."""
        for d in [d for d in self.staged if d is not keep]:
            d.unpersist()
        self.staged = [d for d in self.staged if d is keep]


_ROUNDS: ContextVar[Rounds] = ContextVar("touchcredit_rounds")


def _rounds() -> Rounds:
    current = _ROUNDS.get(None)
    if current is None:
        current = Rounds()
        _ROUNDS.set(current)
    return current


@contextmanager
def owned_by(rounds: Rounds) -> Iterator[Rounds]:
    """Rounds built inside the block belong to ``rounds``."""
    token = _ROUNDS.set(rounds)
    try:
        yield rounds
    finally:
        _ROUNDS.reset(token)


def _stage(df: DataFrame) -> DataFrame:
    """Persist a round's cut rows: read by the main chain and by its correction table.

    The cached rows keep their (key, chunk) hash partitioning and sort, so
    later rounds add no exchange.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _rounds().staged.append(kept)
    return kept


def _retire(keep: DataFrame | None = None) -> None:
    """Drop cached rows of earlier rounds once a later round is materialised."""
    _rounds().retire(keep)


def _correction(table: DataFrame, local: DataFrame) -> DataFrame:
    """Materialise a round's correction table (<= 4 rows per chunk) as a leaf.

    The eager checkpoint also fills ``local``'s cache; the main chain then
    joins ``local`` to a leaf, so plans grow by one round, not threefold.
    """
    out = checkpoint(table)
    _retire(keep=local)
    return out


def _join_correction(local: DataFrame, *tables: DataFrame) -> DataFrame:
    """``local`` with the corrections of its chunks, one row a chunk in each table.

    Small tables are broadcast.  Larger ones are dealt by (key, chunk), as ``local`` is already: no chunk
    is larger than a task, and nothing grows on the driver.
    """
    for table in tables:
        few = table.count() <= BROADCAST_ROWS
        local = local.join(F.broadcast(table) if few else table, [KEY, CHUNK], "left")
    return local


def release() -> None:
    """Unpersist the cached rows of rounds that were built outside a pipeline."""
    _retire()


def _frames(keys: list[str], order: Order) -> tuple[Window, Window, Window, Window]:
    w = Window.partitionBy(*keys).orderBy(*order.asc())
    back = Window.partitionBy(*keys).orderBy(*order.desc()).rowsBetween(_UNB, Window.currentRow)
    return w, w.rowsBetween(_UNB, Window.currentRow), w.rowsBetween(_UNB, _UNF), back


def ordered_scan(df: Ordered, order: Order, *, row_number: str | None = None,
                 running_sums: dict[str, str] | None = None, lead: dict[str, str] | None = None,
                 lag: dict[str, str] | None = None, next_non_null: dict[str, str] | None = None,
                 prev_non_null: dict[str, str] | None = None,
                 group: Column | None = None, group_aggs: dict[str, tuple[Column, str]] | None = None) -> Ordered:
    """Per-key scans over rows from :func:`arrange`.

    ``running_sums``/``lead``/``lag``/``next_non_null`` map output column ->
    input column.  ``next_non_null`` is the first non-NULL value at or after
    the row (a forward-looking FIRST_VALUE IGNORE NULLS), computed by a
    running frame over the reversed order, so its cost stays linear;
    ``prev_non_null`` is the last non-NULL value at or before the row.
    ``group``/``group_aggs`` add :func:`group_stats` in the same round (the
    statistics must not depend on the scan outputs).
    """
    scans = {"running_sums": running_sums or {}, "lead": lead or {}, "lag": lag or {},
             "next_non_null": next_non_null or {}, "prev_non_null": prev_non_null or {}}
    pinned = None if df.pinned is None else _cut_scan(df.pinned, order, row_number, group, group_aggs, **scans)
    scan = _dealt_scan if CHUNK in df.columns else _plain_scan
    return Ordered(scan(df.dealt, order, row_number, group, group_aggs, **scans), pinned, df.heavy)


def _plain_scan(df, order, row_number, group, group_aggs, running_sums, lead, lag, next_non_null, prev_non_null):
    w, run, _, back = _frames([KEY], order)
    ahead = {out: F.last(c, ignorenulls=True).over(back) for out, c in next_non_null.items()}
    cols: dict[str, Column] = {}
    if row_number:
        cols[row_number] = F.row_number().over(w).cast("long")
    cols.update({out: F.sum(c).over(run) for out, c in running_sums.items()})
    cols.update({out: F.lead(c).over(w) for out, c in lead.items()})
    cols.update({out: F.lag(c).over(w) for out, c in lag.items()})
    cols.update({out: F.last(c, ignorenulls=True).over(run) for out, c in prev_non_null.items()})
    if ahead:  # backwards first, so that the forward order is left for what follows
        df = df.withColumns(ahead)
    out = df.withColumns(cols)
    return out if not group_aggs else _plain_stats(out, group, group_aggs)


def _plain_stats(df: DataFrame, group: Column, aggs: dict[str, tuple[Column, str]]) -> DataFrame:
    w = Window.partitionBy(KEY, _G)
    return df.withColumn(_G, group).withColumns({name: agg.over(w) for name, (agg, _) in aggs.items()}).drop(_G)


def _dealt_scan(df, order, row_number, group, group_aggs, running_sums, lead, lag, next_non_null, prev_non_null):
    """The same over (key, chunk) where a task holds the key: carries are windows over the edges of its chunks."""

    def frames(chunk: str, along: list[Column]) -> tuple[Window, ...]:
        inside, across = Window.partitionBy(KEY, chunk).orderBy(*along), Window.partitionBy(KEY).orderBy(chunk, *along)
        return (inside, inside.rowsBetween(_UNB, Window.currentRow), inside.rowsBetween(_UNB, _UNF), across,
                across.rowsBetween(_UNB, -1))

    def at_edge(value: Column, edge: Column) -> Column:
        return F.when(F.col(RN) == edge, value)

    def sized(w: Window, wall: Window) -> dict[str, Column]:
        return {RN: F.row_number().over(w), CNT: F.count(F.lit(1)).over(wall)}

    size = F.col(CNT)
    if next_non_null:  # backwards first, so that the forward order is left for what follows
        w, wrun, wall, _, before = frames(_BACK, order.desc())
        df = df.withColumn(_BACK, -F.col(CHUNK)).withColumns(
            sized(w, wall) | {f"_ck_ln_{out}": F.last(c, ignorenulls=True).over(wrun) for out, c in next_non_null.items()})
        df = df.withColumns({
            f"_ck_c_{out}": F.last(at_edge(F.col(f"_ck_ln_{out}"), size), ignorenulls=True).over(before)
            for out in next_non_null}).withColumns({
                out: F.coalesce(f"_ck_ln_{out}", f"_ck_c_{out}") for out in next_non_null})
        df = df.drop(_BACK, *[f"_ck_{x}_{out}" for out in next_non_null for x in ("ln", "c")])
    w, wrun, wall, across, before = frames(CHUNK, order.asc())
    local = sized(w, wall)
    carry = {"_ck_c_rn": F.sum(at_edge(size, size)).over(before)}
    final: dict[str, Column] = {}
    if row_number:
        final[row_number] = (F.col(RN) + F.coalesce(F.col("_ck_c_rn"), F.lit(0))).cast("long")
    for out, c in running_sums.items():
        x, y = f"_ck_l_{out}", f"_ck_c_{out}"
        local[x], carry[y] = F.sum(c).over(wrun), F.sum(at_edge(F.col(x), size)).over(before)
        final[out] = F.when(F.col(x).isNotNull() | F.col(y).isNotNull(),
                            F.coalesce(F.col(x), F.lit(0)) + F.coalesce(F.col(y), F.lit(0)))
    for out, c in lead.items():
        x, y = f"_ck_l_{out}", f"_ck_c_{out}"
        local[x] = F.lead(c).over(w)
        carry[y] = F.lead(at_edge(F.struct(F.col(c).alias("v")), F.lit(1))).over(across)
        final[out] = F.when(F.col(RN) == size, F.col(y)["v"]).otherwise(F.col(x))
    for out, c in lag.items():
        x, y = f"_ck_l_{out}", f"_ck_c_{out}"
        local[x] = F.lag(c).over(w)
        carry[y] = F.lag(at_edge(F.struct(F.col(c).alias("v")), size)).over(across)
        final[out] = F.when(F.col(RN) == 1, F.col(y)["v"]).otherwise(F.col(x))
    for out, c in prev_non_null.items():
        x, y = f"_ck_l_{out}", f"_ck_c_{out}"
        local[x] = F.last(c, ignorenulls=True).over(wrun)
        carry[y] = F.last(at_edge(F.col(x), size), ignorenulls=True).over(before)
        final[out] = F.coalesce(x, y)
    done = df.withColumns(local).withColumns(carry).withColumns(final)
    done = done.drop(*[c for c in done.columns if c.startswith(("_ck_l_", "_ck_c_"))])
    return done if not group_aggs else _dealt_stats(done, group, group_aggs)


def _dealt_stats(df: DataFrame, group: Column, aggs: dict[str, tuple[Column, str]]) -> DataFrame:
    """Statistics per (key, chunk, group), and those of all chunks of the group put together in the same task."""
    inside = Window.partitionBy(KEY, _G, CHUNK).orderBy(RN)
    wall, whole = inside.rowsBetween(_UNB, _UNF), Window.partitionBy(KEY, _G)
    once = F.col(_FIRST) == 1
    return (df.withColumn(_G, group)
            .withColumns({_FIRST: F.row_number().over(inside)} | {name: agg.over(wall) for name, (agg, _) in aggs.items()})
            .withColumns({name: _COMBINE[comb](F.when(once, F.col(name))).over(whole)
                          for name, (_, comb) in aggs.items()})
            .drop(_G, _FIRST))


def _cut_scan(df, order, row_number, group, group_aggs, running_sums, lead, lag, next_non_null, prev_non_null):
    """The same over (key, chunk), and what must be carried from chunk to chunk."""
    w, wrun, wall, wrev = _frames([KEY, CHUNK], order)
    cols: dict[str, Column] = {RN: F.row_number().over(w), CNT: F.count(F.lit(1)).over(wall)}
    for out, c in running_sums.items():
        cols[f"_ck_ls_{out}"] = F.sum(c).over(wrun)
        cols[f"_ck_lt_{out}"] = F.sum(c).over(wall)
    for out, c in lead.items():
        cols[f"_ck_ll_{out}"] = F.lead(c).over(w)
        cols[f"_ck_lf_{out}"] = F.first(F.struct(F.col(c).alias("v"))).over(wall)
    for out, c in lag.items():
        cols[f"_ck_lg_{out}"] = F.lag(c).over(w)
        cols[f"_ck_lz_{out}"] = F.last(F.struct(F.col(c).alias("v"))).over(wall)
    for out, c in next_non_null.items():
        cols[f"_ck_ln_{out}"] = F.last(c, ignorenulls=True).over(wrev)
        cols[f"_ck_lq_{out}"] = F.first(c, ignorenulls=True).over(wall)
    for out, c in prev_non_null.items():
        cols[f"_ck_lb_{out}"] = F.last(c, ignorenulls=True).over(wrun)
        cols[f"_ck_le_{out}"] = F.last(c, ignorenulls=True).over(wall)
    if group_aggs:
        wg = Window.partitionBy(KEY, CHUNK, _G)
        df = df.withColumn(_G, group)
        cols.update({name: agg.over(wg) for name, (agg, _) in group_aggs.items()})
    local = _stage(df.withColumns(cols))

    # Carry across the chunks of a key.
    summary_cols = [KEY, CHUNK, CNT] + [c for c in cols if c.startswith(("_ck_lt_", "_ck_lf_", "_ck_lz_", "_ck_lq_",
                                                                           "_ck_le_"))]
    summary = local.filter(F.col(RN) == 1).select(*summary_cols)
    wc = Window.partitionBy(KEY).orderBy(CHUNK)
    before = wc.rowsBetween(_UNB, -1)
    after = Window.partitionBy(KEY).orderBy(F.col(CHUNK).desc()).rowsBetween(_UNB, -1)
    carry_cols = [KEY, CHUNK, F.sum(CNT).over(before).alias("_ck_c_rn")]
    for out in running_sums:
        carry_cols.append(F.sum(f"_ck_lt_{out}").over(before).alias(f"_ck_c_{out}"))
    for out in lead:
        carry_cols.append(F.lead(f"_ck_lf_{out}").over(wc).alias(f"_ck_c_{out}"))
    for out in lag:
        carry_cols.append(F.lag(f"_ck_lz_{out}").over(wc).alias(f"_ck_c_{out}"))
    for out in next_non_null:
        carry_cols.append(F.last(f"_ck_lq_{out}", ignorenulls=True).over(after).alias(f"_ck_c_{out}"))
    for out in prev_non_null:
        carry_cols.append(F.last(f"_ck_le_{out}", ignorenulls=True).over(before).alias(f"_ck_c_{out}"))
    carry_table = summary.select(*carry_cols)  # one row per chunk
    if group_aggs:
        # One job writes both correction tables (tagged, then split again).
        both = _correction(carry_table.withColumn(_KIND, F.lit(0)).unionByName(
            _group_cross(local, group_aggs).withColumn(_KIND, F.lit(1)), allowMissingColumns=True), local)
        carry = both.filter(F.col(_KIND) == 0).select(*carry_table.columns)
        cross = both.filter(F.col(_KIND) == 1).select(KEY, CHUNK, _FIRST, _LAST)
        joined = _group_apply(_join_correction(local, carry, cross), group_aggs)
    else:
        joined = _join_correction(local, _correction(carry_table, local))
    out_cols: dict[str, Column] = {}
    if row_number:
        out_cols[row_number] = (F.col(RN) + F.coalesce(F.col("_ck_c_rn"), F.lit(0))).cast("long")
    for out in running_sums:
        loc, car = F.col(f"_ck_ls_{out}"), F.col(f"_ck_c_{out}")
        out_cols[out] = F.when(loc.isNull() & car.isNull(), F.lit(None)).otherwise(
            F.coalesce(loc, F.lit(0)) + F.coalesce(car, F.lit(0)))
    for out in lead:
        out_cols[out] = F.when(F.col(RN) == F.col(CNT), F.col(f"_ck_c_{out}")["v"]).otherwise(F.col(f"_ck_ll_{out}"))
    for out in lag:
        out_cols[out] = F.when(F.col(RN) == 1, F.col(f"_ck_c_{out}")["v"]).otherwise(F.col(f"_ck_lg_{out}"))
    for out in next_non_null:
        out_cols[out] = F.coalesce(F.col(f"_ck_ln_{out}"), F.col(f"_ck_c_{out}"))
    for out in prev_non_null:
        out_cols[out] = F.coalesce(F.col(f"_ck_lb_{out}"), F.col(f"_ck_c_{out}"))
    result = joined.withColumns(out_cols)
    result = result.drop(*[c for c in result.columns if c.startswith(("_ck_ls_", "_ck_lt_", "_ck_ll_", "_ck_lf_",
                                                                       "_ck_lg_", "_ck_lz_", "_ck_ln_", "_ck_lq_",
                                                                       "_ck_lb_", "_ck_le_", "_ck_c_"))])
    return result


_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}
_G = "_ck_g"
_FIRST = "_ck_x_first"
_LAST = "_ck_x_last"


def _group_cross(local: DataFrame, aggs: dict[str, tuple[Column, str]]) -> DataFrame:
    """Per chunk the merged statistics of its first and last group, the only ones that other chunks may share."""
    whole = Window.partitionBy(KEY, _G)
    edge = (local.filter((F.col(RN) == 1) | (F.col(RN) == F.col(CNT)))
            .select(KEY, CHUNK, _G, *aggs.keys())
            .dropDuplicates([KEY, CHUNK, _G]))
    merged = edge.withColumns({name: _COMBINE[comb](name).over(whole) for name, (_, comb) in aggs.items()})
    group = F.struct(_G, *aggs.keys())  # groups never fall along the order, so the least is the first
    return merged.groupBy(KEY, CHUNK).agg(F.min(group).alias(_FIRST), F.max(group).alias(_LAST))


def _group_apply(joined: DataFrame, aggs: dict[str, tuple[Column, str]]) -> DataFrame:
    first, last = F.col(_FIRST), F.col(_LAST)
    fixed = joined.withColumns({
        name: F.when(F.col(_G) == first[_G], first[name]).when(F.col(_G) == last[_G], last[name])
        .otherwise(F.col(name)) for name in aggs})
    return fixed.drop(_G, _FIRST, _LAST)


def group_stats(df: Ordered, group: Column, aggs: dict[str, tuple[Column, str]]) -> Ordered:
    """Whole-group aggregates per (key, group), attached to every row.

    ``group`` must be non-null and non-decreasing along the scan order within
    a key (a cycle number, a day), so every group is a contiguous run of rows.
    ``aggs`` maps output column -> (aggregate Column, combine) where combine
    in {"sum", "min", "max"} merges partial results across chunks (use "sum"
    for counts).  Needs an :func:`ordered_scan` before.  Windows run per (key,
    group) inside the existing partitioning; groups of pinned rows that span
    chunks are corrected from a table of at most 4 rows per chunk.
    """
    pinned = None
    if df.pinned is not None:
        wg = Window.partitionBy(KEY, CHUNK, _G)
        local = _stage(df.pinned.withColumn(_G, group).withColumns(
            {name: agg.over(wg) for name, (agg, _) in aggs.items()}))
        cross = _correction(_group_cross(local, aggs), local)
        pinned = _group_apply(_join_correction(local, cross), aggs)
    stats = _dealt_stats if CHUNK in df.columns else _plain_stats
    return Ordered(stats(df.dealt, group, aggs), pinned, df.heavy)


def internal(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_ck_")]


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*internal(df))
