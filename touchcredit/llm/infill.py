"""Fill-in-the-middle transformation by displacement scatter.

A batch of documents is one array of UTF-8 bytes.  A scan finds the ends of all
tokens (a run of white space and the run of other characters after it; white
space at the end of a text is a token of its own) and so the two cuts of every
document.  Each of its three pieces moves by one distance; the distances are
written as differences at the pieces' first bytes, their cumulative sum is every
byte's shift, and one scatter puts the bytes of all documents into place.  The
markers go into the gaps that stay.

``restore`` reads an output and its form only: it scans the markers, builds the
same differences from where it finds them, and gathers the text back.  A
document whose text holds a marker is left plain, and no marker can arise at a
seam (``<`` never follows ``<`` or a letter inside one), so the scan is exact.

Defined cases: a NULL text is empty, and empty texts are plain; a NULL id draws
as an empty string after ``42:``; rows that repeat an id draw alike; long texts
are whole (a batch is cut between documents only); an empty table gives an empty
table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, text_bytes

FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
MARKS = np.frombuffer(b"<P><S><M>", np.uint8).reshape(3, 3)  # prefix, suffix, middle
PREFIX, SUFFIX, MIDDLE = range(3)
SLICE_BYTES = 1 << 22


def _texts(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.large_string())


def _marker_places(flat: np.ndarray, mark: np.ndarray) -> np.ndarray:
    if len(flat) < 3:
        return np.zeros(0, np.int64)
    return np.flatnonzero((flat[:-2] == mark[0]) & (flat[1:-1] == mark[1]) & (flat[2:] == mark[2]))


def _owners(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The document that holds the whole three-byte marker at each place; -1 if it straddles two."""
    row = np.searchsorted(offsets, places, side="right") - 1
    return np.where(places + 3 <= offsets[row + 1], row, -1)


def token_ends(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places behind a token: after a word, and after white space that ends a text."""
    space = (flat == 32) | ((flat >= 9) & (flat <= 13))
    last = np.zeros(len(flat) + 1, bool)
    last[offsets[1:][offsets[1:] > offsets[:-1]]] = True
    word_ends = np.zeros(len(flat) + 1, bool)
    word_ends[1:] = ~space
    word_ends[:-1] &= space | last[:-1]
    return np.flatnonzero(word_ends | last)


def _shifts(size: int, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Every byte's displacement from those at the first bytes of all pieces (ascending, empty ones included)."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, np.diff(moves, prepend=0))
    return np.cumsum(step)[:size]


def transform(flat: np.ndarray, offsets: np.ndarray, draws: np.ndarray, fim_percent: int, spm_percent: int):
    """Outputs of a batch: bytes, offsets, forms, token counts, cuts.  ``draws``: four unsigned integers a row."""
    ends = token_ends(flat, offsets)
    first = np.searchsorted(ends, offsets[:-1], side="right")
    n = np.searchsorted(ends, offsets[1:], side="right") - first
    held = [_owners(_marker_places(flat, m), offsets) for m in MARKS]
    plain = (n == 0) | (draws[:, 2] % 100 >= fim_percent)
    for rows_with in held:
        plain[rows_with[rows_with >= 0]] = True
    form = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < spm_percent, SPM, PSM))
    one, two = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)

    def place(units):  # the byte behind that many tokens
        at = np.minimum(first + units - 1, max(len(ends) - 1, 0))
        return np.where(units > 0, ends[at] if len(ends) else 0, offsets[:-1])

    cut1, cut2 = place(np.minimum(one, two)), place(np.maximum(one, two))
    cut1, cut2 = np.where(plain, offsets[:-1], cut1), np.where(plain, offsets[:-1], cut2)
    sizes = np.diff(offsets) + np.where(plain, 0, 9)
    out_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    starts = np.stack([offsets[:-1], cut1, cut2], axis=1)  # of prefix, middle, suffix
    lengths = np.stack([cut1 - offsets[:-1], cut2 - cut1, offsets[1:] - cut2], axis=1)
    spm = form == SPM
    suffix_at = out_at[:-1] + 3 + np.where(spm, 0, lengths[:, 0] + 3)
    prefix_at = out_at[:-1] + 3 + np.where(spm, lengths[:, 2] + 3, 0)
    middle_at = out_at[1:] - lengths[:, 1]
    to = np.stack([prefix_at, middle_at, suffix_at], axis=1)
    to[plain] = out_at[:-1][plain, None]
    shift = _shifts(len(flat), starts.ravel(), (to - starts).ravel())
    out = np.empty(int(out_at[-1]), np.uint8)
    out[np.arange(len(flat)) + shift] = flat
    moved = np.flatnonzero(~plain)
    for mark, behind in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        out[behind[moved, None] - 3 + np.arange(3)] = MARKS[mark]
    return out, out_at, form, n, cut1, cut2


def restore_batch(flat: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind outputs, from the outputs' bytes and forms alone."""
    moved = form != PLAIN
    at = np.zeros((3, len(form)), np.int64)
    for k, mark in enumerate(MARKS):
        places = _marker_places(flat, mark)
        row = _owners(places, offsets)
        ok = (row >= 0) & moved[row]
        if np.bincount(row[ok], minlength=len(form))[moved].tolist() != [1] * int(moved.sum()):
            raise ValueError("an output does not hold each marker once")
        at[k, row[ok]] = places[ok] + 3
    begin, end = offsets[:-1], offsets[1:]
    spm = form == SPM
    lengths = np.stack([np.where(spm, at[MIDDLE] - 3, at[SUFFIX] - 3) - at[PREFIX], end - at[MIDDLE],
                        np.where(spm, at[PREFIX] - 3, at[MIDDLE] - 3) - at[SUFFIX]], axis=1)
    source = np.stack([at[PREFIX], at[MIDDLE], at[SUFFIX]], axis=1)
    lengths[~moved] = 0
    lengths[~moved, 0] = (end - begin)[~moved]
    source[~moved] = begin[~moved, None]
    text_at = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))]).astype(np.int64)
    starts = text_at[:-1, None] + np.cumsum(lengths, axis=1) - lengths
    shift = _shifts(int(text_at[-1]), starts.ravel(), (source - starts).ravel())
    return flat[np.arange(int(text_at[-1])) + shift], text_at


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``SLICE_BYTES``; a longer document is a run of its own."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, s in enumerate(size.tolist()):
        if i > start and held + s > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += s
    if start < len(size):
        yield start, len(size)


def _characters(flat: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    leads = np.flatnonzero((flat & 0xC0) != 0x80)
    return np.searchsorted(leads, high) - np.searchsorted(leads, low)


def _draws(id_col: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = 50,
                   spm_percent: int = 80, seed: int = 42) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document.

    ``n``: tokens; ``form``: plain, psm or spm; lengths in code points, NULL for plain documents.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.array(*_draws(id_col, seed)).alias("draws"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low, high in _slices(whole.column(1)):
                b = whole.slice(low, high - low)
                flat, offsets = text_bytes(b.column(1))
                draws = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                out, out_at, form, n, cut1, cut2 = transform(flat, offsets, draws, fim_percent, spm_percent)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n), pa.array(FORMS).take(pa.array(form)),
                     pa.array(_characters(flat, offsets[:-1], cut1), mask=plain),
                     pa.array(_characters(flat, cut1, cut2), mask=plain), _texts(out, out_at).cast(pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` (with ``output`` and ``form``) and the exact text as ``restored``."""
    ship(transformed.sparkSession)
    output, form_col = transformed.columns.index("output"), transformed.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low, high in _slices(whole.column(output)):
                b = whole.slice(low, high - low)
                form = np.array([FORMS.index(f) for f in b.column(form_col).to_pylist()], np.int64)
                text, text_at = restore_batch(*text_bytes(b.column(output)), form)
                yield pa.RecordBatch.from_arrays([*b.columns, _texts(text, text_at).cast(pa.string())],
                                                 [*b.schema.names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields)
    return transformed.mapInArrow(run, f"{schema}, restored string")


def fim_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The transformation's shape per document, with digests of its output and of the text restored from it."""
    return restore(fill_in_middle(docs, id_col, text_col)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))
