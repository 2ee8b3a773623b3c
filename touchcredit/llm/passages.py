"""Repeated passages by suffix arrays over shards of shared text.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  The corpus is dealt so that equal strings meet:

1. Texts are pinned in blocks of a few MB.  Every window of ``LENGTH`` bytes
   belongs to its anchor, the ``ANCHOR``-byte string in it with the least hash, so
   equal windows have equal anchors wherever they lie.  Consecutive windows of
   one anchor are one piece, at most ``2 * LENGTH - ANCHOR`` bytes.
2. Every block sends owners of hash ranges its sorted distinct anchor hashes, and
   learns which of them other documents hold too.  The rest never moves.
3. An anchor with over ``HOT`` different pieces (a line that very many documents
   go on from in their own way) would be one large shard.  Its windows are dealt by
   their own hash instead, after one more such round tells which of them repeat.
4. Blocks send the pieces that are left, each once with the least id that holds
   it.  An owner puts copies together again.  Of each anchor with several different
   pieces it builds the suffix array (``suffix_array``, grouping by Lyndon prefixes)
   and finds the neighbours in it that agree on ``LENGTH`` bytes; a piece that is its
   anchor's only one has no other to agree with.  It answers every window's least id.
5. Blocks, read again, mark the windows whose least id is below the document's own.

A block is one row of the pinned table, so what it sends and the order it sends it
in are the same each time it is read; answers come back by its number, in files.
It is a row group of its own too: tasks write and read one block at a time, by path,
whatever the size of the files and of the input's own row groups.  Answers of a round
tell how much the next one sends, and that sets its number of owners.
Copies of a text, however many, send their pieces once a block.  Hashes only route: a
string counts as repeated because the suffix arrays' neighbours, or copies of a piece, agree
byte by byte.

Defined cases: a NULL text is empty; a text under ``LENGTH`` bytes loses nothing; NULL ids
count as the least long, below other ids; documents of equal ids take nothing from
each other; what is left may end inside a character, so it is binary; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_fs, ship, text_bytes, work_dir
from .suffix_array import ragged, suffix_arrays

LENGTH, ANCHOR = 50, 25
HOT = 24  # different pieces of an anchor that are compared in one suffix array
BLOCK_BYTES = 4 << 20
OWNER_BYTES = 16 << 20  # text per owner of anchors
OWNER_WINDOWS = 1 << 19  # windows of hot anchors per owner
SHARD_BYTES = 16 << 20  # pieces sent to an owner
SENT_BYTES = 4 << 20  # messages that leave a task together
SLICE = (1 << 16) - 2 * LENGTH  # windows hashed at a time; places in a slice fit 16 bits
SYMBOLS, TEXTS = 1 << 18, 512  # suffix arrays built together: so many symbols, or so many texts
_MULTIPLY, _FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOW16 = np.uint64(0xFFFF)
NO_ID = np.iinfo(np.int64).min

Send = Callable[["Block"], Iterator[tuple[int, bytes]]]
Answer = Callable[[list[bytes | pa.Buffer]], list[bytes]]


# ---- blocks

@dataclass
class Block:
    number: int
    ids: np.ndarray
    null: np.ndarray
    text: np.ndarray  # bytes of all documents
    offsets: np.ndarray
    windows: np.ndarray  # per piece: its windows, and where its anchor is in the first one
    anchors: np.ndarray


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows gathered to blocks, one row each."""
    schema = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int64())), ("text", pa.binary()), ("windows", pa.binary()),
                        ("anchors", pa.binary())])
    number = TaskContext.get().partitionId() << 32
    ids: list = []
    sizes: list[int] = []
    texts: list[bytes] = []
    held = 0

    def out():
        text = b"".join(texts)
        cut = find_pieces(np.frombuffer(text, np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([text], pa.binary()),
             *(pa.array([x.tobytes()], pa.binary()) for x in cut)], schema=schema)

    for b in batches:
        flat, offsets = text_bytes(b.column(1))
        for k, i in enumerate(b.column(0).to_pylist()):
            t = flat[offsets[k]:offsets[k + 1]].tobytes()
            if ids and held + len(t) > BLOCK_BYTES:
                yield out()
                number += 1
                ids, sizes, texts, held = [], [], [], 0
            ids.append(i)
            sizes.append(len(t))
            texts.append(t)
            held += len(t)
    if ids:
        yield out()


#: Parquet options by which every row is a row group: sizes are looked at after each row, and any is enough.
#: Statistics would hold the least and greatest text of each, the text itself, until the file is closed.
ROW_GROUPS = {"parquet.block.size": "1", "parquet.page.size.row.check.min": "1", "parquet.column.statistics.enabled": "false",
              "compression": "zstd"}
PLACES = ["block", "n_bytes", "_metadata.file_name", "_metadata.row_index"]


def pin_blocks(rows: DataFrame) -> tuple[str, DataFrame]:
    """The folder of the blocks of ``rows`` (id, text), and where each one lies in it."""
    spark = rows.sparkSession
    path = work_dir(spark, "passage-blocks")
    (rows.mapInArrow(_blocks_of, "block long, n_bytes long, ids array<long>, sizes array<long>, text binary, "
                                 "windows binary, anchors binary")
     .write.options(**ROW_GROUPS).parquet(path))
    return path, spark.read.schema("block long, n_bytes long").parquet(path).select(*PLACES)


def _read_blocks(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks at the places given, one row group at a time."""
    store, root = open_fs(path)
    opened = None
    for b in batches:
        for name, at in zip(b.column("file_name").to_pylist(), b.column("row_index").to_pylist()):
            if name != opened:
                file, opened = pq.ParquetFile(store.open_input_file(f"{root}/{name}")), name
                ends = np.cumsum([file.metadata.row_group(g).num_rows for g in range(file.metadata.num_row_groups)])
            group = int(np.searchsorted(ends, at, side="right"))
            table = file.read_row_group(group, use_threads=False)
            row = {c: table.column(c)[at - int(ends[group])] for c in table.column_names}  # from its end
            sizes = row["sizes"].values.to_numpy(zero_copy_only=False)
            text, windows, anchors = (np.frombuffer(row[c].as_buffer(), np.uint8) if len(row[c].as_buffer())
                                      else np.zeros(0, np.uint8) for c in ("text", "windows", "anchors"))
            yield Block(row["block"].as_py(), row["ids"].values.fill_null(NO_ID).to_numpy(zero_copy_only=False),
                        row["ids"].values.is_null().to_numpy(zero_copy_only=False), text,
                        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), windows, anchors)


# ---- windows, anchors, pieces

def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on as one integer (a view, nothing is copied)."""
    return np.ndarray((max(len(text) - 7, 0),), "<u8", np.ascontiguousarray(text), 0, (1,))


def _chain(parts: Iterator[np.ndarray]) -> np.ndarray:
    h = None
    for w in parts:
        h = w * _MULTIPLY if h is None else (h ^ w) * _MULTIPLY
        h ^= h >> np.uint64(32)
    h *= _FINISH
    h ^= h >> np.uint64(29)
    return h


def _words_at(text: np.ndarray, at: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The ``size`` bytes from each place of ``at`` on, 8 at a time (the last 8 may overlap those before)."""
    rows = np.ndarray((max(len(text) - size + 1, 0),), f"V{size}", text, 0, (1,))[at]
    for step in (*range(0, size - 7, 8), *([size - 8] if size % 8 else [])):
        yield np.ndarray((len(at),), "<u8", rows, step, (size,))


def _hash_at(text: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place of ``at`` on."""
    out = np.empty(len(at), np.uint64)
    for low in range(0, len(at), SLICE):
        out[low:low + SLICE] = _chain(_words_at(text, at[low:low + SLICE], size))
    return out


def _as_before(text: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` bytes from a place of ``at`` on are those from the place before it on."""
    out = np.zeros(len(at), bool)
    for low in range(1, len(at), SLICE):
        same = out[low:low + SLICE]
        same[:] = True
        for words in _words_at(text, at[low - 1:low + SLICE], size):
            same &= words[1:] == words[:-1]
    return out


_ANCHOR_STEPS = [*range(0, ANCHOR - 7, 8)] + ([ANCHOR - 8] if ANCHOR % 8 else [])


def _anchors(text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per slice of windows: the first window, and every window's anchor place."""
    words = _words(text)
    width = LENGTH - ANCHOR + 1
    for start in range(0, len(text) - LENGTH + 1, SLICE):
        windows = min(SLICE, len(text) - LENGTH + 1 - start)
        grams = windows + width - 1
        h = _chain(words[start + s:start + s + grams].copy() for s in _ANCHOR_STEPS)
        least = (h & ~_LOW16) | np.arange(grams, dtype=np.uint64)  # of equal hashes the first
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:span - width], least[width - span:])
        yield start, (least & _LOW16).astype(np.int64) + start


def find_pieces(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows of one anchor, in text order: number of windows, and the anchor's place in the first one."""
    fits = max(len(text) - LENGTH + 1, 0)
    change = np.zeros(len(text) + 2, np.int8)  # windows that would leave their document are none
    np.add.at(change, np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1), 1)
    np.add.at(change, offsets[1:], -1)
    whole = np.cumsum(change, dtype=np.int8)[:fits] == 0
    starts, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    anchor_before, whole_before = -1, False
    for at, anchor in _anchors(text):
        ok = whole[at:at + len(anchor)]
        new = np.empty(len(anchor), bool)
        new[0] = anchor[0] != anchor_before or not whole_before
        new[1:] = (anchor[1:] != anchor[:-1]) | ~ok[:-1]
        begin = np.flatnonzero(new & ok)
        starts.append(begin + at)
        places.append(anchor[begin] - (begin + at))
        anchor_before, whole_before = anchor[-1], ok[-1]
    start = np.concatenate(starts)
    doc = np.searchsorted(offsets, start, side="right") - 1
    end = np.minimum(np.append(start[1:], fits)[:len(start)], offsets[doc + 1] - LENGTH + 1)
    return (end - start).astype(np.uint8), np.concatenate(places).astype(np.uint8)


@dataclass
class Pieces:
    """Runs of consecutive windows of one anchor, in text order."""

    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray  # anchor hash, spread over all 64-bit integers
    mark: np.ndarray  # hash of the whole piece
    doc: np.ndarray

    def where(self, take: np.ndarray) -> Pieces:
        """Those of ``take``, not marked."""
        key = self.key[take]
        return Pieces(self.start[take], self.windows[take], key, key, self.doc[take])


def pieces(block: Block) -> Pieces:
    """The block's pieces, not yet marked: documents' windows follow each other, so run lengths tell where each starts."""
    kind = np.int32 if len(block.text) < 2 ** 30 else np.int64
    windows = block.windows.astype(kind)
    fit = np.concatenate([[0], np.cumsum(np.maximum(np.diff(block.offsets) - LENGTH + 1, 0))])
    number = np.cumsum(windows, dtype=kind) - windows  # of the first window, among those of all documents
    doc = (np.searchsorted(fit, number, side="right") - 1).astype(kind)
    start = (block.offsets[:-1] - fit[:-1]).astype(kind)[doc] + number
    # Anchors are least hashes, so small ones: hashed once more they fall to all owners alike.
    key = _chain(iter((_hash_at(block.text, start + block.anchors, ANCHOR), np.uint64(LENGTH)))) if len(start) \
        else np.zeros(0, np.uint64)
    return Pieces(start, windows, key, key, doc)


def marked(block: Block, p: Pieces) -> Pieces:
    """The same with ``mark`` filled in."""
    if not len(p.start):
        return p
    return replace(p, mark=_mark_of(block.text, p.start, p.windows))


def _mark_of(text: np.ndarray, start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Hash of whole pieces: their first window, the end of their last, and how many they have."""
    out = np.empty(len(start), np.uint64)
    for low in range(0, len(start), SLICE):
        at, size = start[low:low + SLICE], windows[low:low + SLICE]
        head = _hash_at(text, at, LENGTH)
        tail = _hash_at(text, at + size - 1 + LENGTH - ANCHOR, ANCHOR)
        out[low:low + SLICE] = _chain(iter((head + tail * _FINISH, size.astype(np.uint64))))
    return out


# ---- messages

def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes; 8-byte ones by planes, so that equal high bytes compress."""
    out = [len(arrays).to_bytes(2, "little")]
    for a in arrays:
        data = a.view(np.uint8).reshape(-1, 8).T.tobytes() if a.dtype.itemsize == 8 else a.tobytes()
        out += [a.dtype.str.encode().ljust(4), len(data).to_bytes(8, "little"), data]
    return b"".join(out)


def _unpack(message: bytes | pa.Buffer) -> list[np.ndarray]:
    out, at, message = [], 2, memoryview(message)
    for _ in range(int.from_bytes(message[:2], "little")):
        kind = np.dtype(bytes(message[at:at + 4]).decode().strip())
        size = int.from_bytes(message[at + 4:at + 12], "little")
        data = np.frombuffer(message, np.uint8, size, at + 12)
        out.append(np.ascontiguousarray(data.reshape(8, -1).T).view(kind).ravel() if kind.itemsize == 8
                   else data.view(kind))
        at += 12 + size
    return out


def _by_owner(key: np.ndarray, owners: int) -> Iterator[tuple[int, slice]]:
    """Runs of ascending keys that one owner has: equal ranges of hashes."""
    owner = ((key >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(key) else np.zeros(0, np.int64)
    for low, high in zip(cut, np.append(cut[1:], len(key))):
        yield int(owner[low]), slice(int(low), int(high))


def _by_key_and_mark(key: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Order by key, then mark, then place; only rows whose key has several marks are compared further."""
    by = np.argsort(key, kind="stable")
    if not len(by):
        return by
    k = key[by]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    del k
    m = mark[by]
    other = np.zeros(len(by), bool)
    other[1:] = (m[1:] != m[:-1]) & ~new[1:]
    del m
    first = np.flatnonzero(new)
    several = np.repeat(np.logical_or.reduceat(other, first), np.diff(np.append(first, len(by))))
    some = by[several]
    by[several] = some[np.lexsort((mark[some], key[some]))]
    return by


def _kinds(text: np.ndarray, start: np.ndarray, windows: np.ndarray, key: np.ndarray,
           mark: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of pieces that puts copies together, the first of each run of copies in it, and every piece's run.

    Copies have the same bytes: hashes bring them together, neighbours are compared.
    """
    by = _by_key_and_mark(key, mark)
    new = np.ones(len(by), bool)
    if len(by):
        at, size = start[by], windows[by]
        tail = at + size - 1 + LENGTH - ANCHOR  # with the first window all of the piece
        k = key[by]
        new[1:] = (k[1:] != k[:-1]) | (size[1:] != size[:-1])
        del k
        new |= ~(_as_before(text, at, LENGTH) & _as_before(text, tail, ANCHOR))
    kind = np.empty(len(by), np.int64)
    kind[by] = np.cumsum(new) - 1
    return by, np.flatnonzero(new), kind


def _distinct(key: np.ndarray, doc: np.ndarray, mark: np.ndarray | None = None):
    """Per distinct key, ascending: the key, whether two documents hold it, its number of marks and their sum."""
    by = np.argsort(key) if mark is None else _by_key_and_mark(key, mark)
    k, d = key[by], doc[by]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first) if len(k) else new
    if mark is None:
        return k[first], several
    m = mark[by]
    other = new.copy()
    other[1:] |= m[1:] != m[:-1]
    count = np.add.reduceat(other.astype(np.int64), first) if len(k) else first
    total = np.add.reduceat(np.where(other, m, np.uint64(0)), first) if len(k) else m
    return k[first], several, count, total


def _send_keys(block: Block, owners: int) -> Iterator[tuple[int, bytes]]:
    p = marked(block, pieces(block))
    key, several, count, total = _distinct(p.key, p.doc, p.mark)
    for owner, mine in _by_owner(key, owners):
        yield owner, _pack(np.diff(key[mine], prepend=np.uint64(0)), np.packbits(several[mine]),
                           np.minimum(count[mine], 65535).astype(np.uint16), (total[mine] & _LOW16).astype(np.uint16))


def _answer_keys(messages: list[bytes]) -> list[bytes]:
    """For every list: which keys two documents hold, which of those are hot, and how many pieces of either it has."""
    lists = [_unpack(m) for m in messages]
    sizes = [len(x[0]) for x in lists]
    key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in lists])
    several = np.concatenate([np.unpackbits(x[1], count=n).astype(bool) for x, n in zip(lists, sizes)])
    count = np.concatenate([x[2] for x in lists])
    mark = np.concatenate([x[3] for x in lists])
    del lists
    by = _by_key_and_mark(key, mark)
    k, m = key[by], mark[by]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    first = np.flatnonzero(new)
    held = np.diff(np.append(first, len(k)))
    shared = (held > 1) | np.logical_or.reduceat(several[by], first)
    other = new.copy()
    other[1:] |= m[1:] != m[:-1]  # lists with the same pieces (sum of their marks) count once
    hot = shared & (np.add.reduceat(np.where(other, count[by], 0), first, dtype=np.int64) > HOT)
    bits = np.zeros((2, len(key)), bool)
    bits[0, by], bits[1, by] = np.repeat(shared, held), np.repeat(hot, held)
    out, low = [], 0
    for n in sizes:
        mine = slice(low, low + n)
        low = mine.stop
        shared, hot = bits[:, mine]
        out.append(_pack(*np.packbits(bits[:, mine], axis=1),
                         np.array([count[mine][shared & ~hot].sum(), count[mine][hot].sum()], np.int64)))
    return out


def _bits(answers: dict[int, bytes], key: np.ndarray, owners: int, which: int) -> np.ndarray:
    out = np.zeros(len(key), bool)
    for owner, mine in _by_owner(key, owners):
        out[mine] = np.unpackbits(_unpack(answers[owner])[which], count=mine.stop - mine.start)
    return out


def _told(key: np.ndarray, said: dict[int, bytes], owners: int, which: tuple[int, ...]) -> list[np.ndarray]:
    """What the owners say of every key, in the keys' own order."""
    by = np.argsort(key)
    k = key[by]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    distinct, number = k[new], np.cumsum(new) - 1
    out = []
    for w in which:
        bits = np.empty(len(key), bool)
        bits[by] = _bits(said, distinct, owners, w)[number]
        out.append(bits)
    return out


def _hot_windows(block: Block, p: Pieces, hot: np.ndarray) -> Pieces:
    """The single windows of hot pieces, dealt by their own hash."""
    start = ragged(p.start[hot], p.windows[hot])
    one = np.ones(len(start), start.dtype)
    if not len(start):
        return Pieces(start, one, start.astype(np.uint64), start.astype(np.uint64), start)
    key = _hash_at(block.text, start, LENGTH)
    return Pieces(start, one, key, key, np.repeat(p.doc[hot], p.windows[hot]))


def _send_windows(block: Block, keys_said: dict[int, bytes], owners: int,
                  window_owners: int | None = None) -> Iterator[tuple[int, bytes]]:
    p = pieces(block)
    w = _hot_windows(block, p, *_told(p.key, keys_said, owners, (1,)))
    del p
    key, several = _distinct(w.key, w.doc)
    for owner, mine in _by_owner(key, window_owners or owners):
        yield owner, _pack(np.diff(key[mine], prepend=np.uint64(0)), np.packbits(several[mine]),
                           np.ones(mine.stop - mine.start, np.uint16), np.zeros(mine.stop - mine.start, np.uint16))


def _candidates(block: Block, keys_said: dict[int, bytes], windows_said: dict[int, bytes], owners: int,
                window_owners: int | None) -> tuple:
    """Pieces that other documents may hold, and per distinct one, in the order sent, its first place in the list."""
    p = pieces(block)
    shared, hot = _told(p.key, keys_said, owners, (0, 1))
    w = _hot_windows(block, p, hot)
    p = p.where(shared & ~hot)
    w = w.where(*_told(w.key, windows_said, window_owners or owners, (0,)))
    fields = [np.concatenate(x) for x in zip((p.start, p.windows, p.key, p.doc), (w.start, w.windows, w.key, w.doc))]
    del p, w
    both = Pieces(*fields[:3], fields[2], fields[3])
    return both, *_kinds(block.text, both.start, both.windows, both.key, marked(block, both).mark)


def _send_pieces(block: Block, keys_said: dict[int, bytes], windows_said: dict[int, bytes], owners: int,
                 shards: int, window_owners: int | None = None) -> Iterator[tuple[int, bytes]]:
    both, by, first, _ = _candidates(block, keys_said, windows_said, owners, window_owners)
    if not len(by):
        return
    one = by[first]
    key, start, windows = both.key[one], both.start[one], both.windows[one]
    least = np.minimum.reduceat(block.ids[both.doc[by]], first)
    for owner, mine in _by_owner(key, shards):
        yield owner, _pack(np.diff(key[mine], prepend=np.uint64(0)), windows[mine].astype(np.uint8), least[mine],
                           block.text[ragged(start[mine], windows[mine] + LENGTH - 1)])


# ---- suffix arrays of the shards

def _window_ids(text: np.ndarray, start: np.ndarray, windows: np.ndarray, key: np.ndarray,
                ids: np.ndarray) -> np.ndarray:
    """Least id of the documents that hold each window, windows in piece order.  Pieces come by ascending key.

    The windows of a piece that is its anchor's only one are in no other piece, so their least id is the piece's.
    """
    size = windows + LENGTH - 1
    window_at, id_of = np.cumsum(windows) - windows, np.repeat(ids, windows)
    out = id_of.copy()
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(new)  # pieces of one anchor are one text
    held = np.diff(np.append(first, len(key)))
    total = np.add.reduceat(size + 1, first) + 1
    first, held, total = (x[held > 1] for x in (first, held, total))
    shortest = np.argsort(total, kind="stable")
    upto = np.cumsum(total[shortest])
    low = 0
    while low < len(shortest):
        most = max(SYMBOLS, TEXTS * int(total[shortest[low]]))
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + most, side="right")))
        some = shortest[low:high]
        low = high
        piece = ragged(first[some], held[some])
        bounds = np.concatenate([[0], np.cumsum(total[some])])
        at = np.cumsum(size[piece] + 1) - size[piece] - 1 + np.repeat(np.arange(len(some)), held[some])
        symbols = np.ones(int(bounds[-1]), np.uint16)  # 1 behind each piece, 0 behind each text
        symbols[bounds[1:] - 1] = 0
        symbols[ragged(at, size[piece])] = text[ragged(start[piece], size[piece])].astype(np.uint16) + 2
        owner = np.full(len(symbols), -1, np.int64)  # of the places where a window starts: its number
        owner[ragged(at, windows[piece])] = ragged(window_at[piece], windows[piece])
        order = suffix_arrays(symbols, bounds)
        window = owner[order]
        starts = window >= 0
        order, window = order[starts], window[starts]
        problem = np.repeat(np.arange(len(some)), np.diff(bounds))[starts]
        same = _as_before((symbols - 2).astype(np.uint8), order, LENGTH)
        same[1:] &= problem[1:] == problem[:-1]
        run = np.flatnonzero(~same)
        least = np.minimum.reduceat(id_of[window], run)
        out[window] = np.repeat(least, np.diff(np.append(run, len(order))))
    return out


def _answer_pieces(messages: list[bytes]) -> list[bytes]:
    """For every list: each window's least id, as runs of equal ones."""
    lists = [_unpack(m) for m in messages]
    held = [len(x[0]) for x in lists]
    key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in lists])
    windows = np.concatenate([x[1] for x in lists]).astype(np.int64)
    ids = np.concatenate([x[2] for x in lists])
    text = np.concatenate([x[3] for x in lists])
    del lists
    size = windows + LENGTH - 1
    start = np.cumsum(size) - size
    by, first, kind = _kinds(text, start, windows, key, _mark_of(text, start, windows))
    one = by[first]
    found = _window_ids(text, start[one], windows[one], key[one], np.minimum.reduceat(ids[by], first))
    at = np.cumsum(windows[one]) - windows[one]
    out, low = [], 0
    for n in held:
        mine = slice(low, low + n)
        low = mine.stop
        ids_of = found[ragged(at[kind[mine]], windows[mine])]
        run = np.flatnonzero(np.concatenate([[True], ids_of[1:] != ids_of[:-1]]))
        out.append(_pack(ids_of[run], np.diff(np.append(run, len(ids_of))).astype(np.uint32)))
    return out


# ---- rounds

MESSAGES = "block long, owner int, payload binary"
REPLIES = f"{MESSAGES}, light long, heavy long"


def _together(messages: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Messages, payload third, in batches of about ``SENT_BYTES``."""
    rows, held = [], 0
    for m in messages:
        rows.append(m)
        held += len(m[2])
        if held >= SENT_BYTES:
            yield _batch(rows, names)
            rows, held = [], 0
    if rows:
        yield _batch(rows, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _answers(path: str, block: int) -> dict[int, bytes]:
    """What the owners answered a block."""
    store, root = open_fs(path)
    folder = f"{root}/block={block}"
    if store.get_file_info(folder).type == pafs.FileType.NotFound:
        return {}
    table = pads.dataset(folder, filesystem=store, format="parquet").to_table(
        columns=["owner", "payload"], use_threads=False)
    return dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))


def _round(path: str, blocks: DataFrame, send: Send, answer: Answer, owners: int, name: str,
           amounts: Callable[[bytes], tuple[int, int]] = lambda reply: (0, 0)) -> str:
    """Blocks send, owners answer; returns the folder of the answers, by block."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read_blocks(path, batches):
            yield from _together(((block.number, *m) for m in send(block)), ["block", "owner", "payload"])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mail: dict[int, list[tuple[int, pa.Buffer]]] = {}
        for b in batches:
            for block, owner, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                mail.setdefault(owner, []).append((block, payload.as_buffer()))
        for owner, letters in mail.items():
            replies = answer([p for _, p in letters])
            yield from _together(((block, owner, r, *amounts(r)) for (block, _), r in zip(letters, replies)),
                                 ["block", "owner", "payload", "light", "heavy"])

    answers = work_dir(blocks.sparkSession, name)
    replies = (blocks.mapInArrow(sent, MESSAGES).repartitionById(owners, "owner").mapInArrow(answered, REPLIES))
    (replies.repartition("block").sortWithinPartitions("block", "owner")
     .write.partitionBy("block").option("compression", "zstd").parquet(answers))
    return answers


def _amounts(reply: bytes) -> tuple[int, int]:
    """What ``_answer_keys`` counts: pieces of shared keys that are not hot, and of hot ones."""
    return tuple(_unpack(reply)[2].tolist())


def _amounts_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """The same of a whole round."""
    told = spark.read.schema(f"{REPLIES.split(', ', 1)[1]}, block long").parquet(path)
    light, heavy = told.agg(F.sum("light"), F.sum("heavy")).first()
    return light or 0, heavy or 0


def _mark(block: Block, keys_said, windows_said, pieces_said, owners: int, shards: int,
          window_owners: int | None = None) -> pa.RecordBatch:
    """The block's documents with their removed runs and what is left."""
    both, by, first, kind = _candidates(block, keys_said, windows_said, owners, window_owners)
    text, offsets = block.text, block.offsets
    change = np.zeros(len(text) + 1, np.int8)  # every window of a block is in one piece, so no place has two of a kind
    if len(by):
        one = by[first]
        sizes = both.windows[one]
        least = np.empty(int(sizes.sum()), np.int64)
        at = np.cumsum(sizes) - sizes
        for owner, mine in _by_owner(both.key[one], shards):
            ids, runs = _unpack(pieces_said[owner])
            least[at[mine.start]:at[mine.stop - 1] + sizes[mine.stop - 1]] = np.repeat(ids, runs)
        step = max(1, SLICE // LENGTH)  # pieces
        for low in range(0, len(kind), step):
            mine = slice(low, low + step)
            size = both.windows[mine]
            own = np.repeat(block.ids[both.doc[mine]], size)
            gone = ragged(both.start[mine], size)[least[ragged(at[kind[mine]], size)] < own]
            change[gone] += 1
            change[gone + LENGTH] -= 1
    out = np.cumsum(change, dtype=np.int8)[:-1] > 0  # at most LENGTH windows cover a byte
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True  # runs end with their document
    before = np.concatenate([[False], out[:-1]])
    begin = np.flatnonzero(out & (~before | edge[:-1]))
    end = np.flatnonzero(np.concatenate([[False], out]) & (np.concatenate([~out, [True]]) | edge))
    runs_at = np.searchsorted(begin, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(runs_at))
    spans = pa.ListArray.from_arrays(pa.array(runs_at, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(begin - offsets[doc]), pa.array(end - offsets[doc])], ["start", "end"]))
    left = offsets - np.concatenate([[0], np.cumsum(end - begin)])[runs_at]
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1,
                                            [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(text[~out])])
    return pa.RecordBatch.from_arrays(
        [pa.array(block.ids, mask=block.null), pa.array(np.diff(offsets)), spans, kept.cast(pa.binary())],
        ["doc_id", "n_bytes", "spans", "kept"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` per document: byte spans (start, end) that repeat, and the bytes left."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path, blocks = pin_blocks(rows)
    size = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    owners = max(1, -(-size // OWNER_BYTES))
    said = _round(path, blocks, lambda b: _send_keys(b, owners), _answer_keys, owners, "passage-anchors", _amounts)
    light, heavy = _amounts_of(spark, said)
    window_owners = max(1, -(-heavy * (LENGTH - ANCHOR + 1) // OWNER_WINDOWS))  # the most windows that a piece has
    hot = _round(path, blocks, lambda b: _send_windows(b, _answers(said, b.number), owners, window_owners), _answer_keys,
                 window_owners, "passage-windows", _amounts)
    sent = light * (2 * LENGTH - ANCHOR) + sum(_amounts_of(spark, hot)) * LENGTH
    shards = max(1, -(-sent // SHARD_BYTES))
    found = _round(path, blocks, lambda b: _send_pieces(b, _answers(said, b.number), _answers(hot, b.number), owners, shards,
                                                        window_owners), _answer_pieces, shards, "passage-pieces")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _read_blocks(path, batches):
            yield _mark(b, _answers(said, b.number), _answers(hot, b.number), _answers(found, b.number), owners, shards,
                        window_owners)

    return blocks.mapInArrow(cleaned, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def passage_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removed bytes and runs per document, and the digest of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return repeated_passages(docs, id_col, text_col).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
