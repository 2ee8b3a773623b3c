"""Exact deduplication by Golomb-coded fingerprint exchange.

1. Every input partition hashes its normalised texts to 64 bits and sends each
   owner (a range of hashes) its sorted distinct hashes as Golomb code: the gap
   quotients in unary, the remainders in a fixed width.  The divisor is a power
   of two near the mean gap, so a hash costs little more than
   ``log2(mean gap) + 1.5`` bits.  Which hashes occur twice within the
   partition goes along as a bitmap.
2. Owners decode what they got and answer each list with a bitmap of the hashes
   that some other list holds too (or that the sender marked).
3. Every partition, read again, decodes its own lists and bitmaps from the
   shared folder and so knows which of its rows are suspects.  All other rows
   are unique and never move.
4. Only suspects are shuffled; they are grouped by the bytes of the normalised
   text themselves, so equal hashes of different texts never merge.

Owners hold a hash range each, so nothing is skewed by a text that a third of
the rows repeat: a partition sends it once, and the suspects' grouping is
pre-aggregated.  The two passes must see the same partitions: an input that is
not the scan of a stored table is pinned first, and a pass that meets a hash
missing from its own list fails instead of guessing.  There are as many owners as
hold the hashes ``OWNER_HASHES`` each, however many partitions the input has, and
``SENDERS`` partitions' answers share a folder.

Defined cases: NULL text counts as empty and equals it; only A-Z are folded;
NULL ids sort below all others; of rows that repeat id and text the first one
read stays; an empty table gives an empty table; extra columns of any name are
kept by ``drop_exact_duplicates`` and not read by ``exact_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fresh, open_fs, pin, ship, strings, work_dir

OWNER_HASHES = 8 << 20  # hashes an owner compares
SENDERS = 64  # partitions whose answers share a folder


def normalised(text: str) -> bytes:
    """UTF-8 bytes with A-Z lowered (and nothing else)."""
    return text.encode().lower()


def golomb_encode(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit integers as count, first value, shift, unary quotients, remainders."""
    v = np.asarray(values, np.uint64)
    if not len(v):
        return np.zeros(3, "<u8").tobytes()
    gaps = np.diff(v)
    mean = int(v[-1] - v[0]) // max(1, len(gaps))
    shift = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    rest = (gaps & np.uint64((1 << shift) - 1)).astype(">u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(rest, axis=1)[:, 64 - shift:]
    head = np.array([len(v), v[0], shift], "<u8").tobytes()
    return b"".join([head, len(unary).to_bytes(8, "little"), np.packbits(unary).tobytes(),
                     np.packbits(bits).tobytes()])


def golomb_decode(code: bytes) -> np.ndarray:
    n, first, shift = (int(x) for x in np.frombuffer(code, "<u8", 3))
    if not n:
        return np.zeros(0, np.uint64)
    length = int.from_bytes(code[24:32], "little")
    cut = 32 + -(-length // 8)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, cut - 32, 32), count=length))
    quotients = np.diff(ones, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(code, np.uint8, -1, cut), count=(n - 1) * shift).reshape(n - 1, shift)
    rest = np.zeros((n - 1, 64), np.uint8)
    rest[:, 64 - shift:] = bits
    rest = np.packbits(rest, axis=1).view(">u8").ravel().astype(np.uint64) if n > 1 else np.zeros(0, np.uint64)
    gaps = (quotients.astype(np.uint64) << np.uint64(shift)) | rest
    return np.cumsum(np.concatenate([np.array([first], np.uint64), gaps]), dtype=np.uint64)


def _owner(h: np.ndarray, owners: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def _lists(owners: int):
    """One partition's hashes as a Golomb list per owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        parts = [np.array([digest(normalised(t)) for t in strings(b.column(0))], np.uint64) for b in batches]
        if not parts:
            return
        h, count = np.unique(np.concatenate(parts), return_counts=True)
        sender = TaskContext.get().partitionId()
        owner = _owner(h, owners).astype(np.int32)
        for o in np.unique(owner).tolist():
            mine = owner == o
            yield pa.RecordBatch.from_arrays(
                [pa.array([sender], pa.int32()), pa.array([o], pa.int32()), pa.array([golomb_encode(h[mine])]),
                 pa.array([np.packbits(count[mine] > 1).tobytes()])], ["sender", "owner", "hashes", "again"])

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lists of one or more owners; answers every list with the bitmap of its duplicated hashes."""
    by_owner: dict[int, list[tuple[int, bytes, bytes]]] = {}
    for b in batches:
        for s, o, code, again in zip(*(b.column(i).to_pylist() for i in range(4))):
            by_owner.setdefault(o, []).append((s, code, again))
    for o, lists in by_owner.items():
        hashes = [golomb_decode(code) for _, code, _ in lists]
        distinct, count = np.unique(np.concatenate(hashes), return_counts=True)
        duplicated = distinct[count > 1]
        out = [np.packbits(np.isin(h, duplicated) | np.unpackbits(np.frombuffer(again, np.uint8), count=len(h))
                           .astype(bool)).tobytes() for h, (_, _, again) in zip(hashes, lists)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _, _ in lists], pa.int32()), pa.array([o] * len(lists), pa.int32()),
             pa.array([c for _, c, _ in lists]), pa.array(out)], ["sender", "owner", "hashes", "again"])


def _received(path: str, sender: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that partition ``sender`` sent, ascending, and which of them are duplicated."""
    store, root = open_fs(path)
    table = pads.dataset(f"{root}/senders={sender // SENDERS}", filesystem=store, format="parquet").to_table(
        columns=["owner", "hashes", "again"], filter=pc.field("sender") == sender)
    rows = sorted(zip(*(table.column(i).to_pylist() for i in range(3))))
    hashes = [golomb_decode(code) for _, code, _ in rows]
    marks = [np.unpackbits(np.frombuffer(bits, np.uint8), count=len(h)).astype(bool)
             for h, (_, _, bits) in zip(hashes, rows)]
    return np.concatenate(hashes), np.concatenate(marks)


def _marked(docs: DataFrame, text_col: str, narrow: bool, stored: bool) -> tuple[DataFrame, dict[str, str]]:
    """The pinned rows with suspect flag, digest, suspects' normalised text and a row number."""
    spark = docs.sparkSession
    ship(spark)
    if not stored:
        docs = pin(docs, "dedup-input")
    owners = max(1, -(-docs.count() // OWNER_HASHES))
    path = work_dir(spark, "dedup-answers")
    lists = docs.select(text_col).mapInArrow(_lists(owners), "sender int, owner int, hashes binary, again binary")
    answers = lists.repartitionById(owners, "owner").mapInArrow(
        _answers, "sender int, owner int, hashes binary, again binary")
    (answers.withColumn("senders", F.floor(F.col("sender") / SENDERS).cast("int"))
     .repartition("senders").sortWithinPartitions("senders", "sender")
     .write.partitionBy("senders").option("compression", "none").parquet(path))

    names = {k: fresh(docs, k) for k in ("suspect", "sha256", "norm", "row")}
    at = docs.columns.index(text_col)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for b in batches:
            if not b.num_rows:
                continue
            texts = [normalised(t) for t in strings(b.column(at))]
            h = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
            if known is None:
                known, dup = _received(path, TaskContext.get().partitionId())
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            if (known[place] != h).any():
                raise RuntimeError("the input's partitions changed between the two passes")
            suspect = dup[place]
            kept = [b.column(i) for i in range(b.num_columns) if not (narrow and i == at)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(suspect), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([t if s else None for t, s in zip(texts, suspect)], pa.binary())],
                schema=to_arrow_schema(schema))

    fields = [f for f in docs.schema.fields if not (narrow and f.name == text_col)]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]
                          + [T.StructField(names["suspect"], T.BooleanType()),
                             T.StructField(names["sha256"], T.BinaryType()),
                             T.StructField(names["norm"], T.BinaryType())])
    rows = docs.mapInArrow(mark, schema).withColumn(names["row"], F.monotonically_increasing_id())
    return pin(rows, "dedup-marked"), names


def _groups(marked: DataFrame, names: dict[str, str], id_col: str) -> DataFrame:
    """One row per text that suspects share: digest, the row that stays, number of rows.  Grouped by its bytes."""
    order = F.struct(F.col(id_col).isNotNull().alias("some"), F.col(id_col).alias("id"),
                     (-F.col(names["row"])).alias("first"))
    return (marked.filter(F.col(names["suspect"])).groupBy(names["sha256"], names["norm"])
            .agg(F.max(order).alias("best"), F.count("*").alias("group_size"))
            .select(F.col(names["sha256"]).alias("group_sha"), F.col("best.id").alias("keep_id"),
                    (-F.col("best.first")).alias("keep_row"), "group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every document, dropped ones too.

    ``stored``: the rows are a scan of a stored table, so they need not be pinned to be read twice.
    """
    two = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked, names = _marked(two, "text", narrow=True, stored=stored)
    sha = F.lower(F.hex(names["sha256"])).alias("text_sha256")
    alone = marked.filter(~F.col(names["suspect"])).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha)
    shared = (marked.filter(F.col(names["suspect"])).drop(names["norm"])
              .join(_groups(marked, names, "doc_id"), F.col(names["sha256"]) == F.col("group_sha"))
              .select("doc_id", "keep_id", "group_size", (F.col(names["row"]) == F.col("keep_row")).alias("kept"), sha))
    return alone.unionAll(shared)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          stored: bool = False) -> DataFrame:
    """The documents with one row left of each group of equal texts: the largest id's.  All columns stay."""
    marked, names = _marked(docs, text_col, narrow=False, stored=stored)
    stays = _groups(marked, names, id_col).select(F.col("keep_row"))
    alone = marked.filter(~F.col(names["suspect"]))
    shared = marked.filter(F.col(names["suspect"])).join(stays, marked[names["row"]] == stays["keep_row"], "left_semi")
    return alone.unionAll(shared).drop(*names.values())
