"""Fill-in-the-middle transformation against a document-at-a-time version."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchcredit.llm import infill

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def slow(doc_id, text, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def fast(ids, texts):
    flat, offsets = infill.text_bytes(pa.array(texts, pa.string()))
    draws = np.array([[int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[8 * k:8 * k + 8], 16)
                       for k in range(4)] for i in ids], np.int64).reshape(-1, 4)
    out, out_at, form, n, cut1, cut2 = infill.transform(flat, offsets, draws, 50, 80)
    back, back_at = infill.restore_batch(out, out_at, form)
    chars = infill._characters(flat, offsets[:-1], cut1), infill._characters(flat, cut1, cut2)
    got = [(int(n[i]), infill.FORMS[form[i]], *((int(c[i]) if form[i] else None) for c in chars), t)
           for i, t in enumerate(infill._texts(out, out_at).to_pylist())]
    return got, infill._texts(back, back_at).to_pylist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\t<>PSMé日a\x0b\x1c\x00", max_size=40), st.text(max_size=20)), max_size=12),
       st.integers(0, 10 ** 6))
def test_batches_equal_the_slow_version(texts, start):
    ids = list(range(start, start + len(texts)))
    got, back = fast(ids, texts)
    assert got == [slow(i, t) for i, t in zip(ids, texts)]
    assert back == [t or "" for t in texts]


def test_markers_across_documents_are_none():
    texts = ["a <", "P> b", "x <P", "> y", "<S", ">", "<M> inside"]
    for start in range(40):
        ids = list(range(start, start + len(texts)))
        got, back = fast(ids, texts)
        assert got == [slow(i, t) for i, t in zip(ids, texts)] and back == texts


def test_whole_table(spark, nasty):
    rows = infill.restore(infill.fill_in_middle(nasty)).collect()
    want = sorted(map(repr, ((i, *slow(i, t)) for i, t in [(r.doc_id, r.text) for r in nasty.collect()])))
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in rows) == want
    assert sorted(r.restored for r in rows) == sorted(r.text or "" for r in nasty.collect())
    assert {r.form for r in rows} == set(infill.FORMS)


def test_slices_never_cut_documents(monkeypatch, spark, nasty):
    whole = sorted(map(repr, infill.fim_digests(nasty).collect()))
    monkeypatch.setattr(infill, "SLICE_BYTES", 50)
    column = pa.array(["a" * 60, None, "b" * 20, "c" * 40])
    assert list(infill._slices(column)) == [(0, 1), (1, 3), (3, 4)]
    assert sorted(map(repr, infill.fim_digests(nasty).collect())) == whole


def test_empty_table(empty):
    out = infill.fim_digests(empty)
    assert out.count() == 0
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_a_damaged_output_is_refused():
    flat, offsets = infill.text_bytes(pa.array(["<P>a<S>b"]))
    with pytest.raises(ValueError):
        infill.restore_batch(flat, offsets, np.array([infill.PSM]))
