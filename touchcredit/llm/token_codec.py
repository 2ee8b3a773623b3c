"""Token ids in Simple-8b files.

Ids are packed into 64-bit words: the top 4 bits select how many values of how
many bits the other 60 hold (60 x 1 bit ... 1 x 60 bits); a value of 2^60 or
more follows an escape word as a whole word.  A file holds blocks of 65,536
ids, then the document table and the offset of every block, so any document
can be found and decoded on its own; each block is decoded selector by selector
with array operations.

File layout (little-endian): ``S8BT`` | blocks | footer | footer length (8
bytes) | ``S8BT``.  Footer: id base of the file within its shard, number of
documents, number of blocks (8 bytes each), then as 8-byte integers the
document ids, their NULL flags, their token counts, and the byte offset of
every block.

Writing on the cluster: documents are encoded where they are read, shuffled as
ids into shards by ascending ``doc_id`` (fixed split points), sorted, and
streamed into files that are written under a temporary name and renamed; a
repeated task writes the same bytes to the same names.  The document order is
ascending ``doc_id``, NULL first; rows with equal ids lie next to each other.

Defined cases: NULL text counts as empty (just the end id); special strings in
a text are the library's special ids; an empty table writes no file and reads
as empty; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import open_fs, pair_bounds, pin, shard_of_pair, ship, shuffle_partitions, strings, work_dir

MAGIC = b"S8BT"
BLOCK_IDS = 65_536
FILE_IDS = 4_000_000
ESCAPE = 0
# Fixed values: (values per word, bits per value) of selectors 1 to 14.
PACKINGS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
            (2, 30), (1, 60))


def encode_block(values: np.ndarray) -> np.ndarray:
    """Unsigned integers to Simple-8b words; each word takes as many values as fit."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    choice = np.zeros(n, np.int64)  # 0: escape
    for s in range(len(PACKINGS), 0, -1):
        count, bits = PACKINGS[s - 1]
        wide = np.concatenate([[0], np.cumsum(v >> np.uint64(bits) != 0)])
        fits = wide[np.minimum(np.arange(n) + count, n)] == wide[:-1]
        choice[fits] = s
        if not fits.any():
            break
    taken = np.array([1, *(c for c, _ in PACKINGS)])[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += taken[at]
    starts = np.array(starts, np.int64)
    used = choice[starts]
    place = np.cumsum(1 + (used == ESCAPE)) - (1 + (used == ESCAPE))
    words = np.zeros(int(len(starts) + (used == ESCAPE).sum()), np.uint64)
    padded = np.concatenate([v, np.zeros(60, np.uint64)])
    for s in np.unique(used).tolist():
        here = used == s
        if s == ESCAPE:
            words[place[here] + 1] = v[starts[here]]
            continue
        count, bits = PACKINGS[s - 1]
        word = np.full(int(here.sum()), s << 60, np.uint64)
        for k in range(count):
            word |= padded[starts[here] + k] << np.uint64(k * bits)
        words[place[here]] = word
    return words


def decode_block(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of a block."""
    words = np.asarray(words, np.uint64)
    select = (words >> np.uint64(60)).astype(np.int64)
    if (select == ESCAPE).any() or (select > len(PACKINGS)).any():  # a raw word follows each escape word
        raw, at = np.zeros(len(words), bool), 0
        codes = select.tolist()
        while at < len(codes):
            if codes[at] == ESCAPE and at + 1 < len(codes):
                raw[at + 1] = True
                at += 1
            at += 1
        values = words[raw]
        words, select = words[~raw], select[~raw]
    else:
        values = words[:0]
    counts = np.array([1, *(c for c, _ in PACKINGS)])[select]
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(select).tolist():
        here = select == s
        if s == ESCAPE:
            out[place[here]] = values
            continue
        count, bits = PACKINGS[s - 1]
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        part = (words[here][:, None] >> shifts) & np.uint64((1 << bits) - 1)
        out[place[here][:, None] + np.arange(count)] = part
    return out[:n]


def write_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, base: int) -> bytes:
    """One file's bytes: ``ids`` of the documents one after the other, ``counts`` ids each."""
    body, offsets, at = [MAGIC], [], len(MAGIC)
    for i in range(0, len(ids), BLOCK_IDS):
        block = encode_block(ids[i:i + BLOCK_IDS]).astype("<u8").tobytes()
        offsets.append(at)
        body.append(block)
        at += len(block)
    footer = np.array([base, len(doc_ids), len(offsets), *(d or 0 for d in doc_ids), *(d is None for d in doc_ids),
                       *counts, *offsets], "<i8").tobytes()
    return b"".join([*body, footer, len(footer).to_bytes(8, "little"), MAGIC])


class TokenFile:
    """Reader of one file's bytes; decodes only the blocks that are asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC or data[-4:] != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(data[-12:-4], "little")
        self.data, self.end = data, len(data) - 12 - size
        f = np.frombuffer(data, "<i8", size // 8, self.end)
        self.base, docs, blocks = (int(x) for x in f[:3])
        ids, null, self.counts, self.offsets = np.split(f[3:], [docs, 2 * docs, 3 * docs])
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]
        self.starts = np.cumsum(self.counts) - self.counts
        self.total = int(self.counts.sum())

    def block(self, k: int) -> np.ndarray:
        stop = int(self.offsets[k + 1]) if k + 1 < len(self.offsets) else self.end
        start = int(self.offsets[k])
        return decode_block(np.frombuffer(self.data, "<u8", (stop - start) // 8, start),
                            min(BLOCK_IDS, self.total - k * BLOCK_IDS))

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file."""
        a, n = int(self.starts[i]), int(self.counts[i])
        first = a // BLOCK_IDS
        blocks = [self.block(k) for k in range(first, -(-(a + n) // BLOCK_IDS))]
        return np.concatenate([np.zeros(0, np.uint64), *blocks])[a - first * BLOCK_IDS:][:n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start in the file, ids)`` of every document, one block in memory at a time."""
        left, at, k = np.zeros(0, np.uint64), 0, 0
        for doc, n in zip(self.doc_ids, self.counts.tolist()):
            parts = [left]
            have = len(left)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            whole = np.concatenate(parts) if len(parts) > 1 else left
            yield doc, at, whole[:n]
            left, at = whole[n:], at + n


def write_atomically(uri: str, name: str, data: bytes) -> None:
    """Write a file under a temporary name, then rename it; the last writer of equal bytes wins."""
    store, root = open_fs(uri)
    store.create_dir(root, recursive=True)
    temp = f"{root}/_{name}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temp) as f:
        f.write(data)
    store.move(temp, f"{root}/{name}")


def read_whole(uri: str, name: str) -> bytes:
    """The bytes of one file of a folder."""
    store, root = open_fs(uri)
    with store.open_input_file(f"{root}/{name}") as f:
        return f.read()


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text into token files under ``path``; returns the pinned manifest (one row per file)."""
    spark = docs.sparkSession
    ship(spark)
    shards = shuffle_partitions(spark)
    salted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("salt"))
    bounds = pair_bounds(salted, "doc_id", "salt", shards)
    end = b"" if end_id is None else int(end_id).to_bytes(2, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.word_bpe(tokenizer)
        for b in batches:
            ids = [vocabulary.ids16(t) + end for t in strings(b.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array(shard_of_pair(b.column(0), b.column(2), bounds)), b.column(0),
                                              b.column(2), pa.array(ids, pa.large_binary()).cast(pa.binary())],
                                             ["shard", "doc_id", "salt", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, base, number = None, 0, 0
        docs_, counts, parts, held = [], [], [], 0

        def flush():
            nonlocal base, number, docs_, counts, parts, held
            data = write_file(docs_, counts, np.frombuffer(b"".join(parts), "<u2"), base)
            name = f"tokens-{shard:06d}-{number:06d}.s8b"
            write_atomically(path, name, data)
            row = pa.RecordBatch.from_pylist([{"shard": shard, "number": number, "file": name, "n_docs": len(docs_),
                                               "n_ids": held, "n_bytes": len(data), "crc32": zlib.crc32(data)}])
            base, number = base + held, number + 1
            docs_, counts, parts, held = [], [], [], 0
            return row.cast(_MANIFEST)

        for b in batches:
            for s, d, _, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
                if docs_ and (s != shard or held >= FILE_IDS):
                    yield flush()
                if s != shard:
                    shard, base, number = s, 0, 0
                docs_.append(d)
                counts.append(len(ids) // 2)
                parts.append(ids)
                held += len(ids) // 2
        if docs_:
            yield flush()

    encoded = salted.mapInArrow(encode, "shard int, doc_id long, salt long, ids binary")
    # A total order but for equal rows: whatever the input's partitions, the files' bytes are the same.
    files = (encoded.repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id", "salt", "ids")
             .mapInArrow(write, _MANIFEST_DDL))
    return pin(files, "token-manifest")


_MANIFEST_DDL = "shard int, number int, file string, n_docs long, n_ids long, n_bytes long, crc32 long"
_MANIFEST = pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()),
                       ("n_ids", pa.int64()), ("n_bytes", pa.int64()), ("crc32", pa.int64())])


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    The manifest says which files there are and what their checksums must be;
    other files in the folder (of an attempt that failed) are never read.
    ``start`` counts the ids of all documents before it.  The driver gets one
    total per shard (at most ``spark.sql.shuffle.partitions`` rows).
    """
    totals = {r[0]: r[1] for r in manifest.groupBy("shard").agg(F.sum("n_ids")).collect()}
    before, at = {}, 0
    for s in sorted(totals):
        before[s] = at
        at += totals[s]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, name, checksum in zip(*(c.to_pylist() for c in b.columns)):
                data = read_whole(path, name)
                if zlib.crc32(data) != checksum:
                    raise ValueError(f"{name} differs from its manifest")
                file = TokenFile(data)
                base = before[shard] + file.base
                crc = [zlib.crc32(ids.astype("<u4").tobytes()) for _, _, ids in file.documents()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(base + file.starts), pa.array(file.counts),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not totals:
        return spark.createDataFrame([], schema)
    files = manifest.select("shard", "file", "crc32").repartition(shuffle_partitions(spark))
    return files.mapInArrow(decode, schema)


def token_file_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents to token files and read them back."""
    path = work_dir(docs.sparkSession, "token-files")
    return read_token_files(docs.sparkSession, path, write_token_files(docs, tokenizer, path))
