"""Operators over single texts: language, token counts, token files, personal data."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from touchcredit.llm import bpe, lang_id, pii, token_codec, token_counts

BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
BITS = ["a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "\t", "'s", "'re", "don't", "!", "...", "12", "345",
        "<|endoftext|>", "<|", "|>", "日本", "́", "İ", "Σ", "ς", "\x1c", "\x85", "\xa0", "　", "\r\n", "the", "ing",
        "²", "½", "_", "'LL", "<|startoftext|>", "👍🏽", "​", "ŀ", "ǆ", "'", "ll", "ve", "thing,", "ONE.", " \n"]


def scrambled(n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("path,own", [(BYTE, bpe.ByteBpe), (WORD, bpe.WordBpe)])
def test_ids_equal_the_library(path, own, docs):
    encoder = own(path)
    texts = scrambled(5000, 14, 1) + [r.text for r in docs.limit(150).collect()]
    for t in texts:
        want = np.array(encoder.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
        assert encoder.ids16(t) == want, repr(t)


def test_every_prefix_count_equals_the_library():
    counter = token_counts.PrefixCounter(BYTE)
    for t in scrambled(1500, 9, 2) + ["the " * 40 + "cats' don're", "a" * 300, "  x\n\n\n y<|endoftext|>!\n\n"]:
        want = [0] + [len(e.ids) for e in counter.bpe.library.encode_batch(
            [t[:i] for i in range(1, len(t) + 1)], add_special_tokens=False)]
        steps = counter.steps(t)
        assert token_counts.decode_steps(steps).tolist() == want, repr(t)
        for budget in (0, 1, 5):
            assert token_counts.cut_for_budget(steps, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_token_counts_rows(nasty, docs, empty):
    library = Tokenizer.from_file(BYTE)
    for df in (nasty, docs.filter("doc_id % 4 = 0")):
        got = sorted(token_counts.token_counts(df, BYTE).drop("cut_chars").collect(), key=str)
        want = []
        for r in df.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(empty, BYTE).count() == 0
    kept = token_counts.token_counts(nasty, BYTE, keep_prefixes=True).filter("doc_id = 10").first()
    assert token_counts.count_at(kept.prefix_steps, 10 ** 9) == kept.n_tokens


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2 ** 64 - 1)), max_size=400))
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    assert token_codec.decode_block(token_codec.encode_block(v), len(v)).tolist() == values


def test_file_gives_any_document():
    rng = np.random.default_rng(3)
    counts = [0, 5, 100_000, 1, 70_000, 0]
    ids = rng.integers(0, 49_408, sum(counts)).astype(np.uint64)
    file = token_codec.TokenFile(token_codec.write_file([None, 3, 4, 4, 9, 10], counts, ids, 17))
    at = 0
    for i, (n, (doc, start, got)) in enumerate(zip(counts, file.documents())):
        assert (doc, start) == ([None, 3, 4, 4, 9, 10][i], at)
        assert got.tolist() == file.document(i).tolist() == ids[at:at + n].tolist()
        at += n
    assert file.base == 17


def test_token_files_round_trip(nasty, docs, empty):
    library = Tokenizer.from_file(WORD)
    for df in (nasty, docs):
        want, at = {}, 0
        for r in sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
            ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
            want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        rows = token_codec.token_file_round_trip(df, WORD).collect()
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
            want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        assert not any(want.values())
        order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
        assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert token_codec.token_file_round_trip(empty, WORD).count() == 0


def brute_spans(text):
    """The contract's patterns, matched by ``re`` alone."""
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


PII_BITS = ["1", "23", "4.", ".", "-", " ", "+", "+1 (555)", "@", "a.b", "x", "é", "4111 1111 1111 1111", "10.0.0.255",
            "256.", "mail@h.example.com", "..", "%", "(", ")", "0123456789012", "5", "0", "\n", "IBAN ", "ssn: "]


def test_base_spans_equal_brute_force(docs):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PII_BITS, k=rng.randint(0, 14))) for _ in range(30000)]
    texts += [r.text for r in docs.collect()]
    for t in texts:
        assert [s for s in pii.find_spans(t) if s[0] in pii.BASE] == brute_spans(t), repr(t)


def test_added_kinds():
    def of(kind, text):
        return [text[s:e] for k, s, e in pii.find_spans(text) if k == kind]

    assert of("account", "IBAN: GB82 WEST 1234 5698 7654 32 and more") == ["GB82 WEST 1234 5698 7654 32"]
    assert of("account", "my SSN is 078-05-1120.") == ["078-05-1120"]
    assert of("account", "account number: 00123-456789; accounts 5") == ["00123-456789"]
    assert of("account", "no cue 078-05-1120, accountant 12345678") == []
    assert of("login", "see https://bob:s3cret@host.example/x and http://host/a:b@c") == ["bob:s3cret"]
    text = "write to a.b@c.example or +1 (555) 555-0100"
    assert pii.mask(text, pii.find_spans(text)) == "write to <email> or <phone>"
    assert pii.find_spans("1" * 300_000) == [] and pii.find_spans("1." * 100_000 + "@" * 100_000)[0][0] == "ip"


def test_cues_in_any_case_and_before_brackets():
    def accounts(text):
        return [text[s:e] for k, s, e in pii.find_spans(text) if k == "account"]

    iban = "GB82 WEST 1234 5698 7654 32"
    assert accounts("Social Security number: 078-05-1120") == ["078-05-1120"]
    assert accounts(f"iBAN {iban}. Routing NUMBER 021000021, Passport nO: X1234567") == [iban, "021000021", "X1234567"]
    assert accounts(f"IBAN ({iban}) or SSN: \"078-05-1120\"") == [iban, "078-05-1120"]
    assert accounts("İİ été Acct [00123-456789] and sSn('078-05-1120')") == ["00123-456789", "078-05-1120"]


def test_personal_data_rows(nasty, empty):
    rows = {r.doc_id: r for r in pii.personal_data(nasty).collect()}
    assert rows[3].n_email == 0 and rows[3].spans == "" and rows[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(nasty).count() == nasty.count() and pii.personal_data(empty).count() == 0


def test_language_accuracy_on_held_out_documents(docs):
    rows = lang_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 150
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_backoff_and_cases(spark, nasty, empty):
    model = lang_id.train(spark.createDataFrame(
        [(i, t, x) for i, (t, x) in enumerate([("the thing this", "en"), ("der die das ich", "de")] * 5)],
        "doc_id long, text string, lang string"))
    assert model.predict("the")[0] == "en" and model.predict("THIS, thing!")[0] == "en"
    assert model.predict("thingish")[0] == "en"  # unseen word, known 5-grams
    assert model.predict("zzdz")[0] == "de"  # only single letters are known
    assert model.predict("1234 !!") == ("und", 0.0)
    rows = {(r.doc_id, r.lang_pred) for r in lang_id.identify_languages(nasty).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (9, "und")} <= rows
    assert lang_id.identify_languages(empty).count() == 0
    unlabelled = nasty.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in lang_id.identify_languages(unlabelled).collect()} == {"und"}


def test_small_languages_are_learned(spark):
    rows = [(i, f"alpha{i} beta{i} gamma{i}", "xx") for i in range(600)]
    rows += [(7000 + i, "żółw kość", "pl") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.train(df, max_train_docs=40, max_words=20, max_grams=30)
    assert model.languages == ["pl", "xx"]  # 2 rows of 602
    assert model.predict("żółw")[0] == model.predict("Kość żółw")[0] == "pl"
    assert model.predict("alpha7 gamma9 beta")[0] == "xx"
    assert "<" not in model.pieces and ">" not in model.pieces
    same = spark.createDataFrame([(5, f"alpha beta w{chr(97 + i // 26)}{chr(97 + i % 26)}", "xx") for i in range(600)],
                                 "doc_id long, text string, lang string")  # one id on all the rows
    words = lang_id.train(same, max_train_docs=40).words
    assert 10 < len([w for w in words if w.startswith("w")]) < 120


def test_language_counts_come_one_language_at_a_time():
    """Counts leave a worker by language and kind, and add up to those of all texts."""
    texts = [("de", "Das Haus das"), ("en", "the house"), ("de", "Haus"), ("en", None)]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in texts]), pa.array([t for _, t in texts])], ["lang", "text"])
    got = list(lang_id._count(iter([batch])))
    assert len(got) == 4 and all(len(set(zip(*(c.to_pylist() for c in b.columns[:2])))) == 1 for b in got)
    rows = {tuple(r.values())[:3]: r["n"] for b in got for r in b.to_pylist()}
    assert rows["de", "w", "haus"] == rows["de", "w", "das"] == 2 and rows["en", "w", "the"] == 1
    assert rows["de", "g", "a"] == 4 and rows["en", "g", "<the>"] == 1 and ("en", "w", "haus") not in rows
