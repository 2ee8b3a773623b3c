"""Mixing sources to target weights with Pareto order sampling.

Every source gets a target number of words: its share, by weight, of
``total_share`` times all words, but never more than ``max_copies`` times its
own words; what is above is shared again among the others by weight until no
source is above.  A document's expected number of copies is its source's target
over the source's words.  The whole part is allocated to every document for
certain.  The fraction p is an inclusion probability: documents draw a uniform
U (a hash of seed, id and text) and are ranked by the Pareto quotient
``Q = (U / (1 - U)) / (p / (1 - p))``, random odds over inclusion odds, kept as
the integer part of ``2^48 Q / (1 + Q)``; the sample of a source is the
documents of lowest rank whose words fill what is left of its target.

The cut is found without sorting a source: ranks are split into 4,096 bins, the
words per (source, bin) are summed, and the bin in which the target is reached is
split again until it holds at most ``BOUNDARY`` documents (more only when rows
repeat id and text).  The documents just beyond the cut (a few hundred per
source) are walked in rank order, and those that still fit are taken, so the
target is met to within about the size of one small document.  Rows of equal
rank, id and size are counted first and walked as one entry, so repeated rows,
however many, are never gathered.

Per-source totals are collected (one row per source); document rows never are.

Defined cases: NULL or blank text has size 0 and is never taken; a NULL source
is a source of its own and sorts last; NULL ids draw by their text; repeated rows
are documents of their own with equal U; a source without words has target 0; an
empty table gives an empty table; extra columns of any name are kept by
``mixed_documents`` and not read by ``mix_sources``.
"""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sessions import expand
from .common import fresh, pin, ship

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = Fraction(3, 2)
MAX_COPIES = 2
BOUNDARY = 4096
SALTS = 256
TAIL = 512  # documents beyond the cut that are tried one by one
_BITS, _STEP = 48, 12  # ranks have 48 bits and are split by 12 at a time


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, total_share: Fraction = TOTAL_SHARE,
            max_copies: int = MAX_COPIES) -> dict[str | None, Fraction]:
    """Target words per source (exact): weights repeat over the sources in code-point order, NULL last."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left = total_share * sum(sizes.values())
    out: dict[str | None, Fraction] = {}
    open_ = list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > max_copies * sizes[s]]
        if not over:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            out[s] = Fraction(max_copies * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in over]
    return out


def _key(source_col: str):
    return F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col)))


def _draw(id_col: str, text_col: str, seed: int) -> Column:
    """U, strictly between 0 and 1, from what the row holds: every pass over the rows draws the same."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), F.col(id_col), F.col(text_col)), 12)
    return (h + F.lit(0.5)) / F.lit(float(1 << 52))


def _size(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), _key(source_col).alias("source_key"),
                       _size(text_col).alias("size"), _draw(id_col, text_col, seed).alias("u"))


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, Q, as the 48-bit integer part of ``2^48 Q / (1 + Q)`` (ascending in Q)."""
    quotient = (u / (1 - u)) / (p / (1 - p))
    return F.floor(quotient / (1 + quotient) * float(1 << _BITS)).cast("long")


def _take_boundary(g: pd.DataFrame) -> pd.DataFrame:
    """Rank order walk over one source's boundary entries of ``n`` equal rows; ``room`` is what its target has left."""
    g = g.sort_values(["rank", "doc_id", "size"], na_position="first")
    room, extras = float(g["room"].iloc[0]), []
    sizes, counts = g["size"].tolist(), g["n"].tolist()
    for size, n in zip(sizes, counts):
        extras.append(min(n, int(room // size)) if size > 0 else 0)
        room -= size * extras[-1]
    rest = [(size, i) for i, (size, n) in enumerate(zip(sizes, counts)) if size > 0 and extras[i] < n]
    if rest and abs(min(rest)[0] - room) < room:
        extras[min(rest)[1]] += 1
    g["extras"] = extras
    return g.drop(columns=["room"])


def _cuts(sized: DataFrame) -> DataFrame:
    """One row per source: size, target, whole copies, inclusion probability, and between which ranks its cut lies."""
    spark = sized.sparkSession
    totals = {r[0]: int(r[1]) for r in sized.groupBy("source_key").agg(F.sum("size")).collect()}
    named = {(None if k == "n" else k[1:]): k for k in totals}
    goal = {named[s]: t for s, t in targets({s: totals[k] for s, k in named.items()}).items()}
    whole = {k: min(MAX_COPIES, int(goal[k] / totals[k])) if totals[k] else 0 for k in totals}
    room = {k: float(goal[k] - whole[k] * totals[k]) for k in totals}
    odds = {k: min(room[k] / totals[k], 1 - 2 ** -53) if totals[k] else 0.0 for k in totals}  # p, below 1 when rounded
    # Search state per source: documents with rank < lo are in, those with rank >= hi are out.
    lo = {k: 0 for k in totals}
    hi = {k: 1 << _BITS if room[k] > 0 else 0 for k in totals}
    shift, searching = _BITS, [k for k in totals if room[k] > 0]
    while searching and shift > 0:
        shift -= _STEP
        state = spark.createDataFrame([(k, lo[k], hi[k], room[k], odds[k]) for k in searching],
                                      "source_key string, lo long, hi long, room double, p double")
        bins = (sized.join(F.broadcast(state) if len(searching) <= 10_000 else state, "source_key")
                .withColumn("rank", pareto_rank(F.col("u"), F.col("p"))).filter("rank >= lo and rank < hi")
                .groupBy("source_key", "room", F.shiftright("rank", shift).alias("bin"))
                .agg(F.sum("size").alias("words"), F.count("*").alias("docs")))
        run = Window.partitionBy("source_key").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        run = (bins.withColumn("words_to", F.sum("words").over(run)).withColumn("docs_to", F.sum("docs").over(run)))
        cut = F.col("words_to") > F.col("room")
        found = run.groupBy("source_key").agg(
            F.min(F.when(cut, F.struct("bin", (F.col("words_to") - F.col("words")).alias("before"),
                                       (F.col("docs_to") - F.col("docs")).alias("docs_before"), "docs"))).alias("c"))
        found = run.join(found, "source_key").groupBy("source_key", "c").agg(
            F.min(F.when(F.col("docs_to") >= F.col("c.docs_before") + TAIL, F.col("bin"))).alias("last"))
        searching = []
        for r in found.collect():
            k, c = r["source_key"], r["c"]
            if c is None:  # rounding: every document is in
                lo[k] = hi[k]
                continue
            room[k] -= c["before"]
            lo[k] = c["bin"] << shift
            if c["docs"] > BOUNDARY and shift > 0:
                hi[k] = (c["bin"] + 1) << shift
                searching.append(k)
            elif r["last"] is not None:
                hi[k] = min(hi[k], (max(r["last"], c["bin"]) + 1) << shift)
    state = spark.createDataFrame(
        [(k, totals[k], float(goal[k]), whole[k], lo[k], hi[k], room[k], odds[k]) for k in totals],
        "source_key string, source_size long, target double, whole int, lo long, hi long, room double, p double")
    return F.broadcast(state) if len(totals) <= 10_000 else state


def _ranked(rows: DataFrame, u: str = "u", rank: str = "rank", cut: str = "cut") -> DataFrame:
    """Rows that are joined to their source's cut, with their rank; where nothing is sampled all rank last."""
    p = F.col(f"{cut}.p")
    return rows.withColumn(rank, F.when(p > 0, pareto_rank(F.col(u), p)).otherwise(1 << _BITS))


def _near(rank: str = "rank", cut: str = "cut") -> Column:
    return (F.col(rank) >= F.col(f"{cut}.lo")) & (F.col(rank) < F.col(f"{cut}.hi"))


def _edge(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    """The documents next to their source's cut: ``n`` equal rows an entry, of which ``extras`` get a further copy."""
    cut = cuts.select("source_key", F.struct(*cuts.columns).alias("cut"))
    edge = _ranked(sized.join(cut, "source_key")).filter(_near())
    entries = edge.groupBy("doc_id", "source_key", "size", "rank", F.col("cut.room").alias("room")).agg(
        F.count(F.lit(1)).alias("n"))
    entries = entries.select("doc_id", "source_key", "size", "rank", "n", "room")
    schema = entries.drop("room").schema.add("extras", "long")
    return entries.groupBy("source_key").applyInPandas(lambda g: _take_boundary(g)[schema.names], schema)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: int = 7) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; ``taken`` counts words with repeats."""
    ship(docs.sparkSession)
    sized = pin(_sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    cuts = _cuts(sized)
    cut = cuts.select("source_key", F.struct(*cuts.columns).alias("cut"))
    clear = _ranked(sized.join(cut, "source_key")).filter(~_near())
    clear = clear.withColumn("extra", F.col("rank") < F.col("cut.lo"))
    # An entry's rows are alike: the first ``extras`` of them get the copies.
    edge = _edge(sized, cuts)
    shares = F.array(F.struct(F.col("extras").alias("rows"), F.lit(True).alias("extra")),
                     F.struct((F.col("n") - F.col("extras")).alias("rows"), F.lit(False).alias("extra")))
    edge = edge.select("doc_id", "source_key", "size", F.explode(shares).alias("share"))
    edge = edge.select("doc_id", "source_key", "size", "share.rows", "share.extra").filter("rows > 0")
    edge = expand(edge, "rows").join(cut, "source_key")
    taken = (F.col("size") * (F.col("cut.whole") + F.col("extra").cast("int"))).alias("taken")
    columns = ["doc_id", "size", "cut.source_size", "cut.target", taken]
    return clear.select(*columns).unionAll(edge.select(*columns))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = 7) -> DataFrame:
    """The mixed corpus: every document as often as it is taken (0, 1 or 2 times), with all its columns.

    Ranks are drawn again from the rows, so a document beyond doubt is decided
    where it is read; only the documents next to a cut are shuffled.
    """
    ship(docs.sparkSession)
    sized = pin(_sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    cuts = _cuts(sized)
    key, u, rank, copies, cut = (fresh(docs, f"mix_{x}") for x in ("key", "u", "rank", "copies", "cut"))
    cut_of = cuts.select(F.col("source_key").alias(key), F.struct(*cuts.columns).alias(cut))
    whole = docs.withColumn(key, _key(source_col)).withColumn(u, _draw(id_col, text_col, seed)).join(cut_of, key)
    whole = _ranked(whole, u, rank, cut)
    some = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))  # a text without words is not taken
    clear = (whole.filter(~_near(rank, cut)).filter(some)
             .withColumn(copies, (F.col(f"{cut}.whole") + (F.col(rank) < F.col(f"{cut}.lo")).cast("int")).cast("long")))
    # Next to a cut: of the rows of equal id, rank and size some ``extras`` get a further copy.
    alike = _edge(sized, cuts).select("source_key", "doc_id", "size", "rank", "extras")
    more = fresh(docs, "mix_extra")
    found = alike.select(F.struct(*alike.columns).alias(more))
    edge = whole.filter(_near(rank, cut))
    same = ((edge[key] == found[f"{more}.source_key"]) & (edge[rank] == found[f"{more}.rank"])
            & edge[id_col].eqNullSafe(found[f"{more}.doc_id"]) & (_size(text_col) == found[f"{more}.size"]))
    edge = edge.filter(some).join(found, same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = clear.select(*columns, copies).unionAll(_with_copies(edge, docs, key, rank, cut, more, copies, id_col))
    return expand(out.filter(F.col(copies) > 0), copies)


def _with_copies(edge: DataFrame, docs: DataFrame, key: str, rank: str, cut: str, more: str, copies: str,
                 id_col: str) -> DataFrame:
    """Distinct boundary rows with the copies all rows like them get together.

    Equal rows are counted before they are shuffled.  The rows of an entry that differ in
    other columns are numbered in ``SALTS`` parts, whose sizes tell where each part begins.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    n, salt, part, at = (fresh(docs, f"mix_{x}") for x in ("n", "salt", "part", "at"))
    extras, whole, size = (fresh(docs, f"mix_{x}") for x in ("extras", "whole", "size"))
    rows = (edge.select(*columns, key, rank, F.col(f"{more}.size").alias(size), F.col(f"{more}.extras").alias(extras),
                        F.col(f"{cut}.whole").alias(whole))
            .groupBy(*columns, key, rank, size, extras, whole).agg(F.count(F.lit(1)).alias(n))
            .withColumn(salt, F.pmod(F.xxhash64(*columns), F.lit(SALTS))))
    entry = [key, rank, id_col, size]
    sums = rows.groupBy(*entry, salt).agg(F.sum(n).alias(part))
    before = Window.partitionBy(*entry).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*entry, salt, F.coalesce(F.sum(part).over(before), F.lit(0)).alias(part))
    sums = sums.select(F.struct(*sums.columns).alias(at))
    same = ((rows[key] == sums[f"{at}.{key}"]) & (rows[rank] == sums[f"{at}.{rank}"])
            & rows[id_col].eqNullSafe(sums[f"{at}.{id_col}"]) & (rows[size] == sums[f"{at}.{size}"])
            & (rows[salt] == sums[f"{at}.{salt}"]))
    inside = Window.partitionBy(*entry, salt).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col(f"{at}.{part}") + F.coalesce(F.sum(n).over(inside), F.lit(0))
    lucky = F.greatest(F.lit(0), F.least(F.col(n), F.col(extras) - first))
    return rows.join(sums, same).select(*columns, (F.col(whole) * F.col(n) + lucky).alias(copies))
