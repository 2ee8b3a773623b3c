"""Repeated passages: suffix arrays against sorting, removal against all strings of 50 bytes."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchcredit.llm import passages
from touchcredit.llm.suffix_array import suffix_arrays


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=60), min_size=1, max_size=8))
def test_suffix_arrays_equal_sorting(texts):
    texts = [[*t, 0] for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    got = suffix_arrays(np.array(sum(texts, []), np.uint16), bounds)
    for q, t in enumerate(texts):
        assert (got[bounds[q]:bounds[q + 1]] - bounds[q]).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def slow(rows):
    """Spans and remaining bytes per row of (id, text), from every string of 50 bytes."""
    low = passages.NO_ID
    data = [(low if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in data:
        for a in range(len(t) - 49):
            w = t[a:a + 50]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for a in range(len(t) - 49):
            if least[t[a:a + 50]] < i:
                gone[a:a + 50] = b"\1" * 50
        spans = []
        for k, g in enumerate(gone):
            if g and spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            elif g:
                spans.append([k, k + 1])
        out.append(([tuple(s) for s in spans], bytes(c for c, g in zip(t, gone) if not g)))
    return out


def rounds(rows, block_rows, owners):
    """The operator's rounds without Spark."""
    blocks = []
    for number, at in enumerate(range(0, len(rows), block_rows)):
        part = rows[at:at + block_rows]
        texts = [(t or "").encode() for _, t in part]
        text = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        blocks.append(passages.Block(number, np.array([passages.NO_ID if i is None else i for i, _ in part], np.int64),
                                     np.array([i is None for i, _ in part]), text, offsets,
                                     *passages.find_pieces(text, offsets)))

    def one(send, answer):
        mail, said = {}, [{} for _ in blocks]
        for b in blocks:
            for owner, message in send(b):
                mail.setdefault(owner, []).append((b.number, message))
        for owner, letters in mail.items():
            for (number, _), reply in zip(letters, answer([m for _, m in letters])):
                said[number][owner] = reply
        return said

    said = one(lambda b: passages._send_keys(b, owners), passages._answer_keys)
    hot = one(lambda b: passages._send_windows(b, said[b.number], owners), passages._answer_keys)
    found = one(lambda b: passages._send_pieces(b, said[b.number], hot[b.number], owners, owners + 2), passages._answer_pieces)
    out = []
    for b in blocks:
        got = passages._mark(b, said[b.number], hot[b.number], found[b.number], owners, owners + 2)
        out += [([(s["start"], s["end"]) for s in r["spans"]], r["kept"]) for r in got.to_pylist()]
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    common = ["".join(r.choice("ab é") for _ in range(r.randint(20, 200))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 6)):
            parts.append(r.choice(common) if r.random() < 0.5 else "".join(r.choice("abcdefgh ") for _ in range(r.randint(0, 90))))
            if r.random() < 0.2:
                parts[-1] = parts[-1][r.randint(0, 20):]
        rows.append((r.choice([i, i, i, r.randint(0, n), None]), "".join(parts) if r.random() < 0.95 else None))
    rows += [(1000 + k, rows[k][1]) for k in range(10)] + [(5, "a" * 700), (2, "a" * 400), (2000, "ab" * 300), (7, "ab" * 99)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("hot", [24, 2, 0])
def test_removal_equals_all_strings(monkeypatch, seed, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    rows = corpus(seed)
    assert rounds(rows, 1 + seed * 3, 1 + seed % 4) == slow(rows)


def test_slices_and_batches_do_not_matter(monkeypatch):
    rows = corpus(99, 120)
    want = slow(rows)
    monkeypatch.setattr(passages, "SLICE", 37)
    monkeypatch.setattr(passages, "SYMBOLS", 500)
    assert rounds(rows, 50, 3) == want


def test_whole_table(spark, nasty, docs):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    got = passages.repeated_passages(nasty).collect()
    want = sorted(repr((i, len((t or "").encode()), s, k)) for (i, t), (s, k) in zip(rows, slow(rows)))
    assert sorted(repr((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept))) for r in got) == want
    some = docs.repartition(5)
    rows = [(r.doc_id, r.text) for r in some.collect()]
    want = {i: (len((t or "").encode()), sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest())
            for (i, t), (s, k) in zip(rows, slow(rows))}
    got = {r.doc_id: tuple(r)[1:] for r in passages.passage_digests(some).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_empty_table(empty):
    out = passages.passage_digests(empty)
    assert out.collect() == [] and out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_rows_are_ordered_by_key_then_mark_then_place():
    """As a sort by both, with few, many and only repeated keys."""
    rng = np.random.default_rng(5)
    for n, keys in ((0, 1), (1, 1), (500, 1), (500, 40), (500, 10 ** 9)):
        key, mark = rng.integers(0, keys, n).astype(np.uint64), rng.integers(0, 3, n).astype(np.uint64)
        assert passages._by_key_and_mark(key, mark).tolist() == np.lexsort((mark, key)).tolist()


def test_suffix_arrays_hold_pieces_to_compare(monkeypatch):
    """A piece that is its anchor's only one needs none; of the others every symbol is in one."""
    built, found = [], []

    def arrays(symbols, bounds):
        built.extend(int((symbols[a:b] == 1).sum()) for a, b in zip(bounds, bounds[1:]))  # pieces of each text
        return suffix_arrays(symbols, bounds)

    def ids(text, start, windows, key, least, plain=passages._window_ids):
        found.extend(np.unique(key, return_counts=True)[1].tolist())
        return plain(text, start, windows, key, least)

    monkeypatch.setattr(passages, "suffix_arrays", arrays)
    monkeypatch.setattr(passages, "_window_ids", ids)
    rows = corpus(7, 120)
    assert rounds(rows, 20, 2) == slow(rows)
    assert sorted(built) == sorted(n for n in found if n > 1) and built and 1 in found


@pytest.mark.parametrize("hot", [24, 2])
def test_copies_are_told_by_their_bytes(monkeypatch, hot):
    """Pieces of one anchor whose hashes are all equal stay apart, in blocks and at owners."""
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "_mark_of", lambda text, start, windows: np.zeros(len(start), np.uint64))
    rows = corpus(3, 90)
    assert rounds(rows, 15, 2) == slow(rows)


def test_every_block_is_a_row_group(spark):
    """However many blocks a task has, it holds one of them: no row group has two, no footer a text."""
    import glob

    import pyarrow.parquet as pq

    from touchcredit.session import ensure_checkpoint_dir

    rows = [(i, f"{i} and " * 500_000 if i else "x") for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folders = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/llm/passage-blocks-*"
    before = set(glob.glob(folders))
    got = {r.doc_id: (r.n_bytes, len(r.kept)) for r in passages.repeated_passages(df).collect()}
    assert got == {i: (len(t), len(t)) for i, t in rows}
    folder, = set(glob.glob(folders)) - before
    files = [pq.read_metadata(f) for f in glob.glob(f"{folder}/*.parquet")]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert len(groups) >= 6 and {g.num_rows for g in groups} == {1}
    assert not any(g.column(c).is_stats_set for g in groups for c in range(g.num_columns))


@pytest.mark.parametrize("hot", [24, 2, 0])
def test_answers_tell_what_the_next_round_sends(monkeypatch, hot):
    """The number of owners follows from it: pieces of keys that are not hot, and windows of hot ones."""
    monkeypatch.setattr(passages, "HOT", hot)
    told, sent, plain = [], [], passages._answer_keys

    def answer_keys(messages):
        replies = plain(messages)
        told.append(np.sum([passages._unpack(r)[2] for r in replies], axis=0))
        return replies

    def answer_pieces(messages, plain=passages._answer_pieces):
        sent.append(sum(len(passages._unpack(m)[0]) for m in messages))
        return plain(messages)

    monkeypatch.setattr(passages, "_answer_keys", answer_keys)
    monkeypatch.setattr(passages, "_answer_pieces", answer_pieces)
    rows = corpus(11, 90)
    assert rounds(rows, 15, 1) == slow(rows)
    (light, heavy), *windows = told  # without hot keys nothing is asked about windows
    assert light + np.sum(windows) == sum(sent) and (light > 0) == (hot > 0) and (heavy > 0) == (hot < 24)


def test_windows_of_a_block_do_not_lie_in_memory_together():
    """A window has 50 bytes; of a text whose windows are all hot, or all pieces of their own, far fewer are kept for each."""
    import tracemalloc

    n = 1 << 20
    text = np.frombuffer(b"ab" * (n // 2), np.uint8)
    block = passages.Block(0, np.array([5], np.int64), np.array([False]), text, np.array([0, n]),
                           *passages.find_pieces(text, np.array([0, n])))
    p = passages.pieces(block)
    tracemalloc.start()
    try:
        for step in (lambda: passages._hot_windows(block, p, np.ones(len(p.start), bool)),
                     lambda: passages._mark_of(text, p.start, p.windows)):
            tracemalloc.reset_peak()
            low = tracemalloc.get_traced_memory()[0]
            step()
            assert tracemalloc.get_traced_memory()[1] - low < 45 * n
    finally:
        tracemalloc.stop()
