"""Exact top-k by exhaustive term-at-a-time accumulation.

Vectors become integer weights per component.  Within a block of candidates
every component has a posting list of (candidate, weight).  A query row is
sparse: it walks its non-zero components and scatters each one's weighted
postings into a dense score array over the block.  The best k of each array are
partitioned out (ties to the smaller id), and the blocks' winners are merged by
a window over each query.

Queries go out in blocks of at most ``query_block`` rows, the size bound of what
is collected and broadcast.  One block is searched at a time: its merged winners
are pinned and its broadcast destroyed before the next one goes out.  Candidates
stay where they are read, and each block of candidates sends at most k rows per
query.  No pair list is ever made.

Scores are exact integers of any size.  Rows whose weights all stay within 15
bits are scored in machine integers; a row with a larger weight is split into
15-bit limbs, the same accumulation runs for each pair of limbs, and candidates
are ordered by the digits of the sums.

Defined cases: a score that no long holds is given as the nearest long, but
ordered by its exact value; NULL vectors, and vectors with a component that is
NULL or not finite (or not after scaling), take no part; a shorter vector counts
as padded with zeros; rows that share the query's id are not its candidates; a
query id that occurs twice is asked once (its smallest vector that takes part);
fewer than k candidates give fewer rows; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, ship

K = 20
SCALE = 64.0
CANDIDATES = 16_384  # rows of a block of postings
SCORES = 1 << 22  # scores that are accumulated at once
DENSE = 0.25  # postings over this share of the block are kept as a whole row of weights
LIMB = 15  # bits of a limb; products of two of them, summed over a vector, fit a long
FOUND = "query_id long, vec_id long, score long, beyond int, digits binary"


def weights(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer weights (a matrix of whole doubles) of the rows that take part."""
    ids, rows = [], []
    for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
        if i is None or not v.is_valid:
            continue
        values = v.values
        if values.null_count:
            continue
        with np.errstate(over="ignore"):
            x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
        if np.isfinite(x).all():
            ids.append(i)
            rows.append(x)
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return np.array(ids, np.int64), out


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def postings(block: np.ndarray, kind) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per component the candidates with a weight and their weights; ``None`` candidates: a weight for every one."""
    out = []
    for column in block.T:
        hit = np.flatnonzero(column)
        out.append((None, column.astype(kind)) if len(hit) > DENSE * len(column) else (hit, column[hit].astype(kind)))
    return out


def accumulate(part: np.ndarray, lists: list[tuple[np.ndarray | None, np.ndarray]], n: int, kind) -> np.ndarray:
    """Score arrays of some queries over a block of ``n`` candidates, term at a time."""
    part = part.astype(kind)
    scores = np.zeros((len(part), n), kind)
    for j, (hit, weight) in enumerate(lists):
        if not len(weight):
            continue
        rows = np.flatnonzero(part[:, j])
        if hit is None and len(rows) == len(part):
            scores += part[:, j][:, None] * weight
        elif hit is None:
            scores[rows] += part[rows, j][:, None] * weight
        else:
            for r in rows.tolist():
                scores[r, hit] += part[r, j] * weight
    return scores


def limbs(m: np.ndarray) -> list[np.ndarray]:
    """Whole doubles as 15-bit limbs, lowest first; the last one has the sign.  Every step is exact."""
    out, high = [], m
    while np.abs(high).max(initial=0) >= 1 << LIMB:
        above = np.floor(high / (1 << LIMB))
        out.append((high - above * (1 << LIMB)).astype(np.int64))
        high = above
    return [*out, high.astype(np.int64)]


Winners = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]


def _narrow_best(query_ids, queries, ids, block, k: int) -> Iterator[Winners]:
    n, width = len(ids), max(1, block.shape[1])
    kind = np.int32 if float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * width < 2 ** 31 \
        else np.int64
    lists = postings(block, kind)
    step = max(1, SCORES // max(1, n))
    for at in range(0, len(queries), step):
        scores = accumulate(queries[at:at + step], lists, n, kind)
        place = scores.astype(np.int64) * n + np.arange(n - 1, -1, -1)  # unique, so ties go to the smaller id
        own = ids[None, :] == query_ids[at:at + step][:, None]
        place[own] = np.iinfo(np.int64).min
        keep = min(k, n)
        top = np.argpartition(place, n - keep, axis=1)[:, n - keep:]
        row = np.repeat(np.arange(len(scores)), keep)
        column = top.ravel()
        ok = ~own[row, column]
        row, column = row[ok], column[ok]
        yield (query_ids[at:at + step][row], ids[column], scores[row, column].astype(np.int64),
               np.zeros(len(row), np.int32), [None] * len(row))


def _long_and_digits(score: int) -> tuple[int, int, bytes | None]:
    """The nearest long, on which side of the longs the score lies, and bytes that order scores of that side."""
    if -2 ** 63 <= score < 2 ** 63:
        return score, 0, None
    side = 1 if score > 0 else -1
    size = (score.bit_length() + 8) // 8 + 1
    digits = (score if side > 0 else (1 << 8 * size) + score).to_bytes(size, "big")
    head = size if side > 0 else 2 ** 32 - size  # longer is greater, below zero it is less
    return (2 ** 63 - 1 if side > 0 else -2 ** 63), side, head.to_bytes(4, "big") + digits


def _wide_best(query_ids, queries, ids, block, k: int) -> Iterator[Winners]:
    """The same for weights of any size."""
    n = len(ids)
    parts = [postings(x, np.int64) for x in limbs(block)]
    for at in range(0, len(queries), max(1, SCORES // max(1, n) // 8)):
        some = queries[at:at + max(1, SCORES // max(1, n) // 8)]
        asked = limbs(some)
        sums = [np.zeros((len(some), n), np.int64) for _ in range(len(asked) + len(parts))]
        for i, a in enumerate(asked):
            for j, lists in enumerate(parts):
                sums[i + j] += accumulate(a, lists, n, np.int64)
                # carried on at once, so that sums stay small
                sums[i + j + 1] += sums[i + j] >> LIMB
                sums[i + j] &= (1 << LIMB) - 1
        for low in range(len(sums) - 1):
            sums[low + 1] += sums[low] >> LIMB
            sums[low] &= (1 << LIMB) - 1
        for r, query in enumerate(query_ids[at:at + len(some)].tolist()):
            order = np.lexsort((-np.arange(n), *(x[r] for x in sums)))[::-1]
            best = order[ids[order] != query][:k]
            exact = [sum(int(x[r, c]) << LIMB * i for i, x in enumerate(sums)) for c in best.tolist()]
            score, side, digits = zip(*map(_long_and_digits, exact)) if exact else ((), (), ())
            yield (np.full(len(best), query, np.int64), ids[best], np.array(score, np.int64),
                   np.array(side, np.int32), list(digits))


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, block: np.ndarray, k: int) -> Winners:
    """Query ids, candidate ids, scores (nearest long, side, digits) of the best k candidates for every query.

    A query that meets both kinds of candidates may get k of each.
    """
    order = np.argsort(ids, kind="stable")
    ids, block = ids[order], block[order]
    width = max(queries.shape[1], block.shape[1])
    queries, block = _wide(queries, width), _wide(block, width)

    def large(m: np.ndarray) -> np.ndarray:
        return np.abs(m).max(axis=1, initial=0) >= 1 << LIMB

    q, c = large(queries), large(block)
    found = [*_narrow_best(query_ids[~q], queries[~q], ids[~c], block[~c], k)] if (~q).any() and (~c).any() else []
    if q.any():
        found += _wide_best(query_ids[q], queries[q], ids, block, k)
    if c.any() and (~q).any():
        found += _wide_best(query_ids[~q], queries[~q], ids[c], block[c], k)
    joined = [np.concatenate(x) for x in zip(*(f[:4] for f in found))]
    return (*joined, [d for f in found for d in f[4]])


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE, query_block: int = 8192,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every query row."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    asked = vectors.filter(is_query).select(F.col(id_col).cast("long").alias("vec_id"),
                                            F.col(vector_col).alias("embedding")).filter("vec_id is not null")
    whole = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * F.lit(scale)) < float("inf"),
                                                       F.lit(False)))  # NaN is above infinity here
    asked = asked.filter(F.coalesce(whole, F.lit(False)))  # before one of an id's vectors is chosen
    blocks = max(1, -(-asked.count() // query_block))  # hashing fills them evenly
    parts = []
    for number in range(blocks):
        some = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        table = some.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).toArrow()
        if not table.num_rows:
            continue
        query_ids, queries = weights(table.combine_chunks().to_batches()[0], scale)
        if not len(query_ids):
            continue
        shared = spark.sparkContext.broadcast((query_ids, queries))
        parts.append(pin(_search(rows, shared, k, scale), "top-k"))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    return found


def _search(rows: DataFrame, shared, k: int, scale: float) -> DataFrame:
    """The k best of all rows for each query of one broadcast block."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out():
            width = max(m.shape[1] for _, m in held)
            *found, digits = best_of_block(query_ids, queries, np.concatenate([i for i, _ in held]),
                                           np.concatenate([_wide(m, width) for _, m in held]), k)
            return pa.RecordBatch.from_arrays([*(pa.array(x) for x in found), pa.array(digits, pa.binary())],
                                              ["query_id", "vec_id", "score", "beyond", "digits"])

        for b in batches:
            for i in range(0, b.num_rows, CANDIDATES):
                ids, block = weights(b.slice(i, CANDIDATES), scale)
                if len(ids):
                    held.append((ids, block))
                if sum(len(x) for x, _ in held) >= CANDIDATES:
                    yield out()
                    held.clear()
        if held:
            yield out()

    best = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), F.desc("digits"), "vec_id")
    return (rows.mapInArrow(score, FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
