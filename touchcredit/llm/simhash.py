"""SimHash near-duplicates through Golay-code fuzzy hashing.

Two fingerprints link when at most 3 of their 64 bits differ.  Candidate keys:

* The 64 bits are cut into four blocks of 16.  Three errors leave one block
  without an error (pigeonhole); it goes into the key as it is.
* The other 48 bits are cut into two segments of 24.  One of them has at most
  one error.  Its first 23 bits are decoded with the perfect binary Golay code:
  the index of every code word within distance 4 (one, or six) gives a key.
  If two segments differ in at most one bit, the code word nearest to either
  lies within 3 of it and so within 4 of the other: both have that key.

So linked fingerprints always share a key of which at least one is the nearest
code word ("own"), and no cap is needed.  Candidates are verified on all 64
bits.  Only distinct fingerprints are keyed, so a group of copies is one row; a
key run of more than ``RUN`` rows is cut into blocks, and every pair of blocks
is compared in a task of its own.  Tasks report a spanning forest of the links
they find (never all pairs of a group), and connected components are found by
alternating star contractions on the pinned links.

Defined cases: NULL or blank text has fingerprint zero and links like any
other; NULL ids never become a component id unless the component has no other
(then it is NULL); repeated rows get a row each; an empty table gives an empty
table; extra columns of any name are kept by ``drop_near_duplicates`` and not
read by ``near_duplicates``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_dir, fresh, pin, ship, shuffle_partitions, strings, work_dir

SHINGLE = 3
MAX_BITS = 3
RUN = 4096  # rows of one key that are compared in one piece
GOLAY = 0xC75  # fixed value: generator polynomial of the (23, 12) Golay code
_HASHES = 1 << 16  # shingle hashes that are counted at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 (seed 42) of the text's word shingles, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    start = np.concatenate([[0], stop[:-1] + 1])
    if n <= shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip(start[:n - shingle + 1].tolist(), stop[shingle - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _HASHES):
        ones += np.unpackbits(h[i:i + _HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


@functools.lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and per syndrome the error patterns of weight 4 or less.

    The first pattern of a syndrome is the lightest; missing ones repeat it.
    """
    def remainder(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= GOLAY << (bit - 11)
        return v

    low = np.array([remainder(v) for v in range(1 << 12)], np.uint32)
    high = np.array([remainder(v << 12) for v in range(1 << 11)], np.uint32)
    single = [1 << i for i in range(23)]
    patterns: list[list[int]] = [[] for _ in range(2048)]
    layer = {0}
    for _ in range(5):
        for e in sorted(layer):
            patterns[int(low[e & 4095] ^ high[e >> 12])].append(e)
        layer = {e | b for e in layer for b in single if b > e}
    near = np.array([(p + p[:1] * 6)[:6] for p in patterns], np.uint32)
    return low, high, near


def golay_indices(v: np.ndarray) -> np.ndarray:
    """Message bits of the code words within distance 4 of each 23-bit value, the nearest first: shape (n, 6)."""
    low, high, near = golay_tables()
    v = v.astype(np.uint32)
    return ((v[:, None] ^ near[low[v & 4095] ^ high[v >> 12]]) >> 11).astype(np.int64)


def segment_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(position in fp, key, own)`` of every key of unsigned 64-bit fingerprints."""
    rows, keys, owns = [], [], []
    at = np.arange(len(fp))
    for block in range(4):
        shift = np.uint64(16 * block)
        exact = ((fp >> shift) & np.uint64(0xFFFF)).astype(np.int64)
        below = fp & np.uint64((1 << 16 * block) - 1)
        rest = below | ((fp >> np.uint64(16)) & ~np.uint64((1 << 16 * block) - 1))
        if block == 3:
            rest = below
        for segment in range(2):
            part = (rest >> np.uint64(24 * segment)) & np.uint64(0x7FFFFF)
            index = golay_indices(part)
            head = (np.int64(block * 2 + segment) << 28) | (exact << 12)
            for k in range(6):
                new = np.ones(len(fp), bool) if k == 0 else index[:, k] != index[:, 0]
                rows.append(at[new])
                keys.append((head | index[:, k])[new])
                owns.append(np.full(int(new.sum()), k == 0))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(owns)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components as ``(a, b)``: each node with the smallest node of its component."""
    if not len(a):
        return a, b
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[:len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _links_in_runs(key: np.ndarray, fp: np.ndarray, own: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal key (sorted by key), as a spanning forest."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held, at, d = 0, np.arange(len(key)), 0
    while True:
        d += 1
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        if not len(at):
            break
        x = fp[at] ^ fp[at + d]
        ok = (own[at] | own[at + d]) & (np.bitwise_count(x) <= bits) & (x != 0)
        if ok.any():
            found.append((fp[at[ok]], fp[at[ok] + d]))
            held += int(ok.sum())
            if held > 1 << 20:
                found = [spanning(*map(np.concatenate, zip(*found)))]
                held = len(found[0][0])
    if not found:
        return fp[:0], fp[:0]
    return spanning(*map(np.concatenate, zip(*found)))


def _batch(names, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


_FOUND = ["kind", "a", "b", "part", "own"]
_FOUND_DDL = "kind int, a long, b long, part int, own boolean"


def _found(kind: int, a, b, part=None, own=None) -> pa.RecordBatch:
    n = len(a)
    part = np.zeros(n, np.int32) if part is None else part
    own = np.zeros(n, bool) if own is None else own
    return _batch(_FOUND, np.full(n, kind, np.int32), a, b, part, own)


def _compare(bits: int):
    """Reads (key, fp, own) sorted by key.  Kind 0 rows are links; kind 1 rows are the blocks of over-long runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, own = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        long_key, long_rows = None, 0

        def settle(key, fp, own):
            nonlocal long_key, long_rows
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            size = np.diff(cut)
            each = np.repeat(size, size)
            short = (each <= RUN) & (key != (long_key if long_key is not None else -1))
            a, b = _links_in_runs(key[short], fp[short], own[short], bits)
            if len(a):
                yield _found(0, a.view(np.int64), b.view(np.int64))
            for i, n in zip(cut[:-1].tolist(), size.tolist()):
                if n > RUN or key[i] == long_key:
                    if key[i] != long_key:
                        long_key, long_rows = int(key[i]), 0
                    part = ((long_rows + np.arange(n)) // RUN).astype(np.int32)
                    long_rows += n
                    yield _found(1, key[i:i + n], fp[i:i + n].view(np.int64), part, own[i:i + n])

        for b in batches:
            key = np.concatenate([key, b.column(0).to_numpy()])
            fp = np.concatenate([fp, b.column(1).to_numpy().view(np.uint64)])
            own = np.concatenate([own, b.column(2).to_numpy(zero_copy_only=False)])
            if len(key) < 1 << 18:
                continue
            done = int(np.searchsorted(key, key[-1]))
            if done == 0 and len(key) > RUN:
                done = len(key)  # one over-long run: it leaves in blocks
            if done:
                yield from settle(key[:done], fp[:done], own[:done])
                key, fp, own = key[done:], fp[done:], own[done:]
        if len(key):
            yield from settle(key, fp, own)

    return run


def _compare_blocks(bits: int):
    """One pair of blocks of an over-long run; ``side`` tells the blocks apart."""

    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy()
        left = table.column("side").to_numpy() == 0
        links = [(fp[:0], fp[:0])]
        same = table.column("same").to_numpy()[0]
        other = np.flatnonzero(left if same else ~left)
        for i in np.flatnonzero(left).tolist():
            x = fp[other] ^ fp[i]
            ok = (own[other] | own[i]) & (np.bitwise_count(x) <= bits) & (x != 0)
            if ok.any():
                links.append((np.full(int(ok.sum()), fp[i]), fp[other[ok]]))
            if len(links) > 512:
                links = [spanning(*map(np.concatenate, zip(*links)))]
        a, b = spanning(*map(np.concatenate, zip(*links)))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links ``a, b`` between the distinct values of ``prints.fp`` that differ in at most 3 bits."""
    spark = prints.sparkSession
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys hold for at most 3 differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fp), 20_000):
                part = fp[i:i + 20_000]
                row, key, own = segment_keys(part)
                yield _batch(["key", "fp", "own"], key, part[row].view(np.int64), own)

    n = shuffle_partitions(spark)
    keys = prints.select("fp").distinct().mapInArrow(keyed, "key long, fp long, own boolean")
    found = pin(keys.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_compare(max_bits), _FOUND_DDL),
                "simhash-links")
    links = found.filter("kind = 0").select("a", "b")
    blocks = found.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"), "part", "own")
    if blocks.isEmpty():
        return links
    parts = blocks.groupBy("key").agg((F.max("part") + 1).alias("parts"))
    cells = blocks.join(parts, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("key", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "fp",
                         "own", (F.col("part") > F.col("other")).cast("int").alias("side"),
                         (F.col("part") == F.col("other")).alias("same"))
    return links.unionAll(cells.groupBy("key", "x", "y").applyInArrow(_compare_blocks(max_bits), "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``a, b`` links: ``node, root`` for every node that is not its own root.

    Large-star and small-star contractions alternate until nothing moves;
    every round is written to the shared folder and the one before removed.
    """
    spark = links.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = work_dir(spark, "components")
        df.write.parquet(path)
        df = spark.read.schema("a long, b long").parquet(path)
        mark = df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        return df, path, tuple(mark)

    low_first = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, path, mark = stored(low_first)
    while mark[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        before, old = mark, path
        edges, path, mark = stored(small)
        delete_dir(spark, old)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _fingerprints(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``docs`` with columns for the fingerprint (signed) and a row number, pinned; returns their names too."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def prints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array(np.array([fingerprint(x, shingle) for x in strings(t)], np.uint64).view(np.int64))

    return docs.withColumn(fresh(docs, "fp"), prints(F.col(text_col)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = pin(_fingerprints(narrow, "text", shingle).select("doc_id", "fp"), "fingerprints")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return (prints.join(component_ids(prints, max_bits), "fp")
            .select("doc_id", hexed.alias("fingerprint"), "component_id"))


def component_ids(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, component_id`` for every distinct ``fp`` of a pinned ``doc_id, fp`` table."""
    roots = components(fingerprint_links(prints, max_bits))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = (first.join(roots, first["fp"] == roots["node"], "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one row left of every component: the smallest id, then the first row.  All columns stay."""
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    whole = pin(_fingerprints(docs, text_col, shingle).withColumn(row, F.monotonically_increasing_id()), "simhash")
    prints = whole.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    roots = components(fingerprint_links(prints, max_bits))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = prints.groupBy("fp").agg(F.min(order).alias("low"), F.count(F.lit(1)).alias("n"))
    rooted = (first.join(roots, first["fp"] == roots["node"], "left")
              .select("fp", "low", "n", F.coalesce("root", "fp").alias("root")))
    stays = rooted.groupBy("root").agg(F.min("low").alias("stay"), F.sum("n").alias("all"))
    # Only rows that go are looked up: those of a group of several, but for its first.
    several = rooted.join(stays.filter("all > 1"), "root").select(F.col("fp").alias("of"), F.col("stay.row").alias("stays"))
    gone = prints.join(several, prints["fp"] == several["of"]).filter("row <> stays").select(F.col("row").alias("gone"))
    return whole.join(gone, whole[row] == gone["gone"], "left_anti").drop(fp, row)
