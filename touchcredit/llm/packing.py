"""Lexical retrieval packing.

Documents are tokenised once and placed by content into shards of about
``SHARD_TOKENS`` tokens: a document's BM25 weights are projected onto
``SKETCH`` random directions, a sample of these sketches is cut into ever
smaller groups by k-means, and every document of the corpus goes to the group
it is nearest to.  Neighbouring groups share a shard.  So a seed's neighbours
come to its shard from wherever they lie in the corpus; only a group of more
than a shard's tokens (copies, one large topic) is split, by a hash of the row.
Each shard builds a BM25 inverted index over its documents whose terms are
token ids, so the document frequencies, counted over *all* documents, fit one
array of the vocabulary's size.  Every term is indexed; those that many of the
shard's documents hold are kept as whole rows of weights.  A window starts with
a seed document; the index returns the seed's neighbours among the unused
documents by descending score, and they fill the window greedily.  The document
that crosses the window's end is cut there, its rest opens the next window and
is the next seed; otherwise the next seed is the first unused document.

Every window of a shard but the last is full.  The last one is cut into pieces
whose lengths are powers of two, each a sequence of its own, so nothing is
padded.

Sketches and centres are small integers, so a document's group is the same
whenever it is computed anew.  The sample (by a hash of the row number that is
pinned with the tokens) tells how much each group holds; no id, source or group
of copies makes a shard large, but a document longer than a shard does, and it
alone bounds a task's memory.  The placement is approximate: a neighbour that
falls into another group is not found (README: measured recall).

Defined cases: NULL text counts as empty, so the document is its end id alone;
NULL ids and repeated rows are packed like any row; ties in score go to the
earlier row; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import pin, ship, strings

WINDOW = 2048
SHARD_TOKENS = 1 << 20
VOCABULARY = 1 << 16
K1, B = 1.2, 0.75
DENSE = 0.25  # terms of more than this share of a shard's documents are kept as a whole row of weights
SKETCH = 128  # numbers of a sketch
SAMPLE = 128  # sampled documents per shard: half make the groups, half tell how much they hold
MOST_SAMPLED = 1 << 19  # and in all (70 MB of sketches on the driver)
BRANCHES = 16

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def bm25_weights(ids: np.ndarray, idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a document and their weights."""
    t, n = np.unique(ids, return_counts=True)
    return t, idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ids) / mean_length))


class Bm25:
    """Inverted index over one shard's documents; ``idf`` and ``mean_length`` are those of the corpus."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        terms, rows, weights = [], [], []
        for i, ids in enumerate(docs):
            t, w = bm25_weights(ids, idf, mean_length)
            terms.append(t)
            rows.append(np.full(len(t), i, np.int32))
            weights.append(w)
        self.terms_of, self.n = terms, len(docs)
        flat, row, weight = np.concatenate(terms), np.concatenate(rows), np.concatenate(weights)
        often = np.flatnonzero(np.bincount(flat, minlength=VOCABULARY) > DENSE * len(docs))
        self.dense_of = np.full(VOCABULARY, -1, np.int32)  # term to its row of ``dense``
        self.dense_of[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), len(docs)))
        at = self.dense_of[flat]
        self.dense[at[at >= 0], row[at >= 0]] = weight[at >= 0]
        flat, row, weight = flat[at < 0], row[at < 0], weight[at < 0]
        order = np.argsort(flat, kind="stable")
        self.rows, self.weights = row[order], weight[order]
        self.bounds = np.searchsorted(flat[order], np.arange(VOCABULARY + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Scores of all documents for the seed's distinct terms, accumulated term by term."""
        t = self.terms_of[seed].astype(np.int64)
        at = self.dense_of[t]
        out, t = np.zeros(self.n), t[at < 0]
        for row in self.dense[at[at >= 0]]:  # in the same order for every document, so copies score the same
            out += row
        if len(t):
            lo, hi = self.bounds[t].tolist(), self.bounds[t + 1].tolist()
            rows = np.concatenate([self.rows[a:b] for a, b in zip(lo, hi)])
            weights = np.concatenate([self.weights[a:b] for a, b in zip(lo, hi)])
            out += np.bincount(rows, weights=weights, minlength=self.n)
        return out


@functools.lru_cache(maxsize=1)
def _directions() -> np.ndarray:
    return np.random.default_rng(0).integers(0, 2, (VOCABULARY, SKETCH), np.int8) * np.int8(2) - np.int8(1)


def _whole(m: np.ndarray) -> np.ndarray:
    """Rows as whole numbers of one byte with the same directions (sums of their products are exact in 32 bits)."""
    norm = np.sqrt(np.sum(m * m, axis=1, keepdims=True))
    return np.clip(np.rint(400 * m / np.maximum(norm, 1e-9)), -127, 127).astype(np.int8)


def sketches(docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> np.ndarray:
    """One row per document: its BM25 weights along the random directions."""
    out = np.zeros((len(docs), SKETCH))
    for i, ids in enumerate(docs):
        t, w = bm25_weights(ids, idf, mean_length)
        out[i] = np.rint(4096 * w) @ _directions()[t].astype(np.float64)  # whole numbers: no rounding in the sum
    return _whole(out)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of every point's nearest centre (of equals the first)."""
    across = centres.astype(np.float32).T
    return np.concatenate([np.argmax(points[i:i + 512].astype(np.float32) @ across, axis=1)
                           for i in range(0, len(points), 512)] or [np.zeros(0, np.int64)])


def _split(points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of every point and the groups' centres, by k-means on directions from far-apart starts."""
    rng, unit = np.random.default_rng(0), points.astype(np.float32) / 400
    first, apart = [int(rng.integers(len(unit)))], np.full(len(unit), np.inf)
    while len(first) < k:
        apart = np.minimum(apart, np.maximum(0, 1 - unit @ unit[first[-1]]))
        apart[(points == points[first[-1]]).all(axis=1)] = 0
        if not apart.sum():
            break
        first.append(int(rng.choice(len(unit), p=(apart / apart.sum()).astype(np.float64))))
    centres = points[first]
    for _ in range(8):
        own = nearest(points, centres)
        centres = _whole(np.array([unit[own == c].sum(axis=0, dtype=np.float64) for c in np.unique(own)]))
    return nearest(points, centres), centres


def group_tree(points: np.ndarray, load: np.ndarray, most: float) -> tuple[tuple | int, int]:
    """Tree of groups of at most ``most`` load or of equal points, and their number.

    A node holds its branches' centres and the branches; a leaf is the group's number, so near groups have near numbers.
    """
    leaves = 0

    def node(at: np.ndarray) -> tuple | int:
        nonlocal leaves
        k = min(BRANCHES, len(at), int(-(-load[at].sum() // most)))
        if k > 1:
            own, centres = _split(points[at], k)
            if len(parts := np.unique(own)) > 1:
                return centres[parts], [node(at[own == c]) for c in parts]
        leaves += 1
        return leaves - 1

    return node(np.arange(len(points))), leaves


def groups(points: np.ndarray, tree: tuple | int) -> np.ndarray:
    """Group of every point: down the tree by the nearest centre."""
    out, todo = np.zeros(len(points), np.int64), [(tree, np.arange(len(points)))]
    while todo:
        branch, at = todo.pop()
        if isinstance(branch, int):
            out[at] = branch
            continue
        own = nearest(points[at], branch[0])
        todo += [(branch[1][c], at[own == c]) for c in np.unique(own)]
    return out


def group_shards(load: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of every group: neighbours share one, a group above ``most`` has several."""
    first, parts = np.zeros(len(load), np.int64), np.ones(len(load), np.int64)
    shard, held = 0, 0.0
    for g, x in enumerate(load.tolist()):
        if held and held + x > most:
            shard, held = shard + 1, 0.0
        first[g], parts[g], held = shard, max(1, -(-x // most)), held + x
        if parts[g] > 1:
            shard, held = shard + int(parts[g]), 0.0
    return first, parts


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float,
               window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece of one shard."""
    index = Bm25(docs, idf, mean_length)
    unused = np.ones(len(docs), bool)
    left = sum(map(len, docs))
    first, sequence, rest = 0, 0, None  # rest: (document, tokens already packed)
    while left:
        if left < window:  # powers of two, largest first
            sizes = [1 << b for b in range(window.bit_length(), -1, -1) if left >> b & 1]
        else:
            sizes = [window]
        ranked: Iterator[int] | None = None
        for size in sizes:
            room, offset = size, 0
            while room:
                if rest is None:
                    if ranked is None:
                        while first < len(docs) and not unused[first]:
                            first += 1
                        doc = first
                    else:
                        doc = next(ranked)
                    unused[doc], rest = False, (doc, 0)
                doc, done = rest
                if ranked is None:
                    ranked = _neighbours(index, doc, unused)
                n = min(room, len(docs[doc]) - done)
                yield doc, done, n, sequence, offset
                offset, room = offset + n, room - n
                rest = (doc, done + n) if done + n < len(docs[doc]) else None
            sequence += 1
        left -= sum(sizes)


def _neighbours(index: Bm25, seed: int, unused: np.ndarray) -> Iterator[int]:
    """Unused documents by descending score (computed when the first one is asked for)."""
    free = np.flatnonzero(unused)
    s = index.scores(seed)[free]
    if len(free) > 256:
        head = np.argpartition(-s, 255)[:256]
        head = head[np.lexsort((free[head], -s[head]))]
        yield from free[head].tolist()
        rest = np.setdiff1d(np.arange(len(free)), head)
        yield from free[rest[np.lexsort((free[rest], -s[rest]))]].tolist()
    else:
        yield from free[np.lexsort((free, -s))].tolist()


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (16-bit, end id included) and a row number, pinned."""
    ship(docs.sparkSession)
    end = int(end_id).to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.byte_bpe(tokenizer)
        for b in batches:
            ids = [vocabulary.ids16(t) + end for t in strings(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.large_binary()).cast(pa.binary())],
                                             ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, ids binary")
    return pin(rows.withColumn("row", F.monotonically_increasing_id()), "packing-tokens")


def term_statistics(tokens: DataFrame) -> tuple[np.ndarray, int, int]:
    """Document frequency of every token id, number of documents and of tokens, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(VOCABULARY, np.int64)
        docs = total = 0
        for b in batches:
            for ids in b.column(0).to_pylist():
                ids = np.frombuffer(ids, "<u2")
                df[np.unique(ids)] += 1
                docs, total = docs + 1, total + len(ids)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hit, [-1, -2])), pa.array(np.append(df[hit], [docs, total]))], ["term", "n"])

    rows = tokens.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    found = dict(map(tuple, rows))  # at most the vocabulary's size and two totals
    df = np.zeros(VOCABULARY, np.int64)
    for t, n in found.items():
        if t >= 0:
            df[t] = n
    return df, found.get(-1, 0), found.get(-2, 0)


def place(tokens: DataFrame, idf: np.ndarray, n_docs: int, n_tokens: int, shard_tokens: int) -> DataFrame:
    """``tokens`` with a column ``shard``: documents of like content in the same one."""
    spark = tokens.sparkSession
    mean = max(1.0, n_tokens / max(1, n_docs))
    shards = -(-n_tokens // shard_tokens)
    if shards <= 1:
        return tokens.withColumn("shard", F.lit(0).cast("long"))
    shared = spark.sparkContext.broadcast(idf)  # one number per token id

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.frombuffer(x, "<u2") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(map(len, ids)), pa.int64()),
                 pa.array([x.tobytes() for x in sketches(ids, shared.value, mean)], pa.binary())],
                ["row", "n", "sketch"])

    step = 1 << 20
    keep = min(step, -(-min(SAMPLE * shards, MOST_SAMPLED) * step // n_docs))
    some = tokens.filter(F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(step)) < keep).select("row", "ids")
    sample = some.mapInArrow(sketch, "row long, n long, sketch binary").toArrow().sort_by("row")
    if not sample.num_rows:
        return tokens.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    points = np.frombuffer(b"".join(sample.column("sketch").to_pylist()), np.int8).reshape(-1, SKETCH)
    load = sample.column("n").to_numpy() + mean / 4  # many short documents count too
    tree, leaves = group_tree(points[::2], load[::2] * (n_tokens / load[::2].sum()), shard_tokens / 2)
    rest = slice(1, None, 2) if len(points) > 1 else slice(None)  # not those that the groups were fitted to
    held = np.bincount(groups(points[rest], tree), load[rest], leaves)
    first, parts = group_shards(held * (n_tokens / held.sum()), shard_tokens)
    table = spark.sparkContext.broadcast((tree, first, parts))  # a few groups per shard

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, first, parts = table.value
        for b in batches:
            ids = [np.frombuffer(x, "<u2") for x in b.column("ids").to_pylist()]
            group = groups(sketches(ids, shared.value, mean), tree)
            shard = first[group] + np.mod(b.column("spread").to_numpy(), parts[group])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "ids", "row")), pa.array(shard)],
                                             ["doc_id", "ids", "row", "shard"])

    return (tokens.select("doc_id", "ids", "row", F.xxhash64("row").alias("spread"))
            .mapInArrow(deal, "doc_id long, ids binary, row long, shard long"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS,
         end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: document, place in the document, checksum of its ids, sequence and place in it."""
    spark = docs.sparkSession
    tokens = tokenised(docs, tokenizer, end_id, id_col, text_col)
    df, n_docs, n_tokens = term_statistics(tokens)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
    mean = max(1.0, n_tokens / max(1, n_docs))
    shared = spark.sparkContext.broadcast(idf)  # one number per token id

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        ids = [np.frombuffer(x, "<u2") for x in table.column("ids").to_pylist()]
        shard = table.column("shard")[0].as_py()
        pieces = list(pack_shard(ids, shared.value, mean, window))
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        crc = [zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(doc)), "start": start, "length": length,
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": np.array(list(map(len, ids)), np.int64)[doc],
            "sequence_id": (shard << 32) + sequence, "offset": offset})

    return place(tokens, idf, n_docs, n_tokens, shard_tokens).groupBy("shard").applyInArrow(run, SCHEMA)
