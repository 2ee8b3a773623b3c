"""Operators over whole tables: near and exact duplicates, packing, WARC, mixing, top-k, the pipeline."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchcredit.llm import exact_dedup, mixing, packing, simhash, topk, warc

BYTE = public_tokenizers.path("byte_bpe_50k.json")


# ---- SimHash

def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ")
             .replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_components(ids, prints, bits=3):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    p = np.array(prints, np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p ^ p[i]) <= bits).tolist():
            parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(d, low[r])
    return [low[find(i)] for i in range(len(ids))]


def test_golay_code_is_perfect():
    low, high, near = simhash.golay_tables()
    weight = np.bitwise_count(near)
    assert weight[:, 0].max() == 3 and np.all(weight[:, 0] <= weight.min(axis=1))
    assert np.all((weight[:, 1] == 4) == (weight[:, 0] == 3))  # six code words only at distance 3


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.lists(st.integers(0, 63), min_size=0, max_size=3, unique=True))
def test_linked_fingerprints_share_an_own_key(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    row, key, own = simhash.segment_keys(np.array([fp, other], np.uint64))
    mine, theirs = set(key[(row == 0) & own]), set(key[row == 1])
    assert mine & theirs


@pytest.mark.parametrize("run", [4096, 16])
def test_near_duplicates_equal_brute_force(docs, nasty, empty, run, monkeypatch, spark):
    import pyspark.cloudpickle as cp
    monkeypatch.setattr(simhash, "RUN", run)
    cp.register_pickle_by_value(simhash)  # workers see the changed constant
    try:
        rng = random.Random(6)
        base = rng.getrandbits(64)
        cluster = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)]
        chain = [rng.getrandbits(64)]
        for _ in range(60):
            chain.append(chain[-1] ^ sum(1 << b for b in rng.sample(range(64), 3)))
        prints = cluster + chain + [rng.getrandbits(64) for _ in range(300)]
        ids = list(range(len(prints)))
        rng.shuffle(ids)
        table = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for i, p in zip(ids, prints)],
                                      "doc_id long, fp long")
        got = {r.fp: r.component_id for r in simhash.component_ids(table).collect()}
        want = slow_components(ids, prints)
        assert [got[int(np.uint64(p).view(np.int64))] for p in prints] == want
    finally:
        cp.unregister_pickle_by_value(simhash)
    if run == 16:
        return
    for df in (docs, nasty):
        rows = df.select("doc_id", "text").collect()
        prints = [slow_fingerprint(r.text) for r in rows]
        want = sorted(((r.doc_id, f"{p:016x}", c) for r, p, c in
                       zip(rows, prints, slow_components([r.doc_id for r in rows], prints))), key=str)
        assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str) == want
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    stays = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in left.collect()) == sorted(stays)
    assert simhash.drop_near_duplicates(nasty).columns == nasty.columns
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(500)] + [(1000 + i, 1000) for i in range(1, 200)]
    random.Random(1).shuffle(path)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 501)}, **{1000 + i: 1000 for i in range(1, 200)}}


# ---- Exact duplicates

@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), max_size=300))
def test_golomb_round_trip(values):
    v = sorted(values)
    assert exact_dedup.golomb_decode(exact_dedup.golomb_encode(np.array(v, np.uint64))).tolist() == v


def test_golomb_is_compact():
    v = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 20_000).astype(np.uint64))
    assert len(exact_dedup.golomb_encode(v)) * 8 / len(v) < 64 - np.log2(len(v)) + 2


def slow_exact(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")].append(i)
    return groups


def test_exact_duplicates_equal_brute_force(docs, nasty, empty, spark):
    hot = spark.createDataFrame([(i, "Hot TEXT" if i % 3 else f"text {i % 50}") for i in range(3000)],
                                "doc_id long, text string").repartition(7)
    for df in (docs, nasty, hot):
        rows = df.select("doc_id", "text").collect()
        want = []
        for norm, at in slow_exact(rows).items():
            ids = [rows[i].doc_id for i in at]
            keep = max((d for d in ids if d is not None), default=None)
            sha = hashlib.sha256(norm.encode()).hexdigest()
            first = ids.index(keep)
            want += [(d, keep, len(at), k == first, sha) for k, d in enumerate(ids)]
        got = exact_dedup.exact_duplicates(df).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        left = exact_dedup.drop_exact_duplicates(df)
        assert left.columns == df.columns and left.count() == len(slow_exact(rows))
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0
    shuffled = docs.join(docs.select("doc_id"), "doc_id")  # a plan with a shuffle is pinned first
    assert exact_dedup.exact_duplicates(shuffled).count() == docs.count()


# ---- Packing

def check_packing(rows, pieces):
    library = Tokenizer.from_file(BYTE)
    ids = defaultdict(list)
    for r in rows:
        ids[r.doc_id].append(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        assert sum(p.length for p in ps) == sum(map(len, ids[d]))
        if len(ids[d]) == 1:
            at = 0
            for p in sorted(ps, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids[d][0])
                assert p.ids_crc32 == zlib.crc32(ids[d][0][at:at + p.length].tobytes())
                at += p.length
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two: nothing is padded


def test_packing(docs, nasty, empty):
    for df, shard in ((docs, 1 << 20), (docs.filter("doc_id % 5 = 0"), 5000), (nasty, 20_000)):
        check_packing(df.collect(), packing.pack(df, BYTE, shard_tokens=shard).collect())
    assert packing.pack(empty, BYTE).count() == 0


def test_neighbours_follow_bm25():
    rng = np.random.default_rng(2)
    topics = [rng.choice(5000, 40, replace=False) for _ in range(6)]
    docs = [rng.choice(topics[i % 6], 300).astype(np.uint16) for i in range(60)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=packing.VOCABULARY)
    idf = np.log1p((60 - df + 0.5) / (df + 0.5))
    index = packing.Bm25(docs, idf, 300.0)
    for seed in (0, 7):
        want = [sum(idf[t] * (n := int((d == t).sum())) * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(d) / 300))
                    for t in np.unique(docs[seed]) if t in d) for d in docs]
        assert np.allclose(index.scores(seed), want)
    windows = defaultdict(set)
    for d, _, _, sequence, _ in packing.pack_shard(docs, idf, 300.0, 1024):
        windows[sequence].add(d % 6)
    assert np.mean([len(t) for t in windows.values()]) < 2


# ---- WARC

def topic_rows(topics, each):
    """Documents of about 250 tokens: half words of their topic, half words that all share."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    shared, own = [word() for _ in range(60)], [[word() for _ in range(30)] for _ in range(topics)]
    rows = [(i, " ".join(rng.choices(own[i % topics], k=40) + rng.choices(shared, k=40)))
            for i in range(topics * each)]
    return rng.sample(rows, len(rows))


def test_neighbours_come_from_the_whole_corpus(spark):
    topics = 30
    rows = topic_rows(topics, 24)
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), BYTE,
                          shard_tokens=20_000).collect()
    check_packing(spark.createDataFrame(rows, "doc_id long, text string").collect(), pieces)
    assert len({p.sequence_id >> 32 for p in pieces}) >= 5
    inside, windows = defaultdict(set), defaultdict(set)
    for p in pieces:
        inside[p.doc_id % topics].add(p.sequence_id >> 32)
        windows[p.sequence_id].add(p.doc_id % topics)
    assert np.mean([len(x) for x in inside.values()]) < 1.5  # a topic lies in one shard, not dealt over all
    assert np.mean([len(x) for x in windows.values()]) < 2.5


def test_groups_of_copies_are_split_over_shards(spark):
    rows = [(i, "the same words again " * 30) for i in range(400)] + topic_rows(5, 20)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), BYTE,
                          shard_tokens=10_000).collect()
    held = defaultdict(int)
    for p in pieces:
        held[p.sequence_id >> 32] += p.length
    assert sum(held.values()) == sum(p.length for p in pieces) and max(held.values()) < 30_000


def test_common_terms_count(spark):
    rows = topic_rows(6, 20)
    rows += [(len(rows) + i, rows[0][1]) for i in range(len(rows) // 2)]  # a third of the table are copies
    rows = [(i, t) for i, (_, t) in enumerate(random.Random(3).sample(rows, len(rows)))]
    copies = {i for i, t in rows if sum(t == x for _, x in rows) > 1}
    assert 3 * len(copies) > len(rows)
    windows = defaultdict(set)
    for p in packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), BYTE).collect():
        windows[p.sequence_id].add(p.doc_id in copies)
    mixed = sum(len(x) == 2 for x in windows.values())
    assert mixed <= 3, (mixed, len(windows))  # where the copies start and end


def test_every_term_is_indexed():
    docs = [np.array(x, np.uint16) for x in ([5, 6, 1], [8, 9, 1], [5, 6, 7, 1])]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=packing.VOCABULARY)
    idf = np.log1p((3 - df + 0.5) / (df + 0.5))
    index = packing.Bm25(docs, idf, 10 / 3)
    for seed in range(3):
        want = [sum(idf[t] * 2.2 / (1 + 1.2 * (0.25 + 0.75 * len(d) / (10 / 3))) for t in set(docs[seed]) & set(d))
                for d in docs]
        assert np.allclose(index.scores(seed), want) and (index.scores(seed) > 0).all()


def test_a_table_of_three_documents_retrieves(spark):
    text = ["lorem ipsum dolor " * 300, "wholly other words " * 300, "lorem ipsum dolor sit " * 300]
    df = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string").coalesce(1)
    pieces = sorted(packing.pack(df, BYTE).collect(), key=lambda p: (p.sequence_id, p.offset))
    order = list(dict.fromkeys(p.doc_id for p in pieces))
    assert order == [0, 2, 1]  # the like one before the other


def slow_warc(rows, least=0):
    best = defaultdict(list)
    for r in rows:
        best[r.html or ""].append(r.page_id)
    out = []
    for html, ids in best.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        top = max((i for i in ids if i is not None), default=None)
        first = ids.index(top)
        for k, i in enumerate(ids):
            answer = k == first or len(data) < least
            out.append((i, len(data), digest, "response" if answer else "revisit", None if answer else top))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = spark.createDataFrame([
        (1, "http://a/é x\r\nX-Page-ID: 99", "<p>one</p>", 1), (2, None, "<p>one</p>", 2), (3, "u", None, 3),
        (4, "u", "", 4), (4, "u", "", 4), (None, "u", "<p>one</p>", 5), (None, None, "lost", 6), (None, None, "lost", 7),
        (5, "u", "x\r\n\r\ny" * 200000, 8), (6, "u", "日本", 9)], "page_id long, url string, html string, sha int")
    for df, least in ((pages, 0), (odd.repartition(3), 0), (odd, 5)):
        got = warc.warc_round_trip(df, least).collect()
        assert sorted(map(tuple, got), key=str) == slow_warc(df.collect(), least)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_warc_is_deterministic_and_rolls(spark, scratch_dir):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    first = warc.write_warc(pages, f"{scratch_dir}/a", roll_bytes=20_000).collect()
    again = warc.write_warc(pages.repartition(5), f"{scratch_dir}/b", roll_bytes=20_000).collect()
    assert sorted(first) == sorted(again) and len(first) > 8
    assert all(r.n_bytes < 20_000 + 60_000 for r in first)
    data = open(f"{scratch_dir}/a/{first[0].file}", "rb").read()
    heads = [h for h, _ in warc.records(data)]
    assert heads[0]["WARC-Type"] == "warcinfo" and len(heads) == first[0].n_records + 1


# ---- Mixing

def test_targets():
    t = mixing.targets({"a": 100, "b": 100, None: 100})
    assert t == {"a": 200, "b": Fraction(500, 3), None: Fraction(250, 3)} or sum(t.values()) == 450
    assert t["a"] == 200 and t["b"] == 2 * t[None] and sum(t.values()) == 450
    assert mixing.targets({"a": 0, "b": 10}) == {"a": 0, "b": 15}
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def test_mixing(docs, nasty, empty, spark):
    hot = spark.range(60_000).selectExpr("id as doc_id", "repeat('w ', cast(id % 37 as int)) as text",
                                         "case when id % 3 > 0 then 'big' else concat('s', id % 7) end as source")
    for df, near in ((docs, 0.01), (hot, 0.001), (nasty, None)):
        source = {}
        for r in df.select("doc_id", "source", "text").collect():
            source.setdefault(r.doc_id, []).append((r.source, len((r.text or "").encode().split())))
        rows = mixing.mix_sources(df).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_sources(df).collect()), key=str)
        sizes, got, goal = defaultdict(int), defaultdict(int), {}
        for pairs in source.values():
            for s, n in pairs:
                sizes[s] += n
        want = mixing.targets(sizes)
        assert len(rows) == df.count()
        for r in rows:
            s = next(s for s, n in source[r.doc_id] if n == r.size and sizes[s] == r.source_size)
            assert r.taken in (0, r.size, 2 * r.size) and r.target == pytest.approx(float(want[s]))
            got[s] += r.taken
            goal[s] = r.target
        if near:
            for s in sizes:
                assert abs(got[s] - goal[s]) <= max(3, near * goal[s]), s
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix_sources(docs).collect()}
    assert {r.doc_id: r["count"] for r in copies.groupBy("doc_id").count().collect()} == {
        d: n for d, n in taken.items() if n}
    assert mixing.mixed_documents(nasty).columns == nasty.columns
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixing_splits_crowded_bins(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BOUNDARY", 4)
    monkeypatch.setattr(mixing, "TAIL", 3)
    df = spark.range(50_000).selectExpr("id as doc_id", "'a b c' as text", "concat('s', id % 2) as source")
    rows = mixing.mix_sources(df).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 3 for r in rows)


# ---- Top-k

def slow_top(rows, k=20):
    ok = [(r[0], [int(np.floor(64 * float(x))) for x in r[1]]) for r in rows
          if r[1] is not None and r[0] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    out = []
    for q, w in dict(ok).items():
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, c)), v) for v, c in ok if v != q)
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.choice([0, 0, 0, 0.1, -0.2, 0.5], 12)]) for i in range(400)]
    rows += [(400, None), (401, [None, 1.0]), (402, [float("nan")] * 12), (403, [float("inf")] * 12), (404, []),
             (405, [1.0]), (420, [0.5] * 14), (None, [1.0] * 12), (440, None), (40, rows[40][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "vec_id long, embedding array<float>, score int, rank int").repartition(4)
    want = slow_top([(a, None if b is None else [None if x is None else np.float32(x) for x in b]) for a, b in rows])
    query = F.col("vec_id") % 20 == 0
    for block in (8192, 6):
        assert sorted(map(tuple, topk.top_k(df, query, query_block=block).collect())) == want
    few = df.filter("vec_id in (0, 1, 2)")
    assert topk.top_k(few, query).count() == 2 and topk.top_k(df.limit(0), query).count() == 0


def test_invalid_queries_hide_no_valid_one(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 4)
    rows = [(i, [float(i), 1.0]) for i in range(1, 12)]
    rows += [(20, [1.0, 2.0]), (20, [None, 2.0]), (20, [float("-inf"), 2.0]), (40, [None, 1.0]), (60, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    want = slow_top([(a, b) for a, b in rows])
    assert len(want) == 11 and {q for q, *_ in want} == {20}
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0).collect())) == want
    bad = df.filter("vec_id <> 20")  # no valid query at all, more candidates than a block
    assert topk.top_k(bad, F.col("vec_id") % 20 == 0).count() == 0


# ---- Pipeline

def test_language_stage_keeps_shared_words(spark):
    import corpus_pipeline as cp

    own = {"en": "the thing", "de": "der ding", "fr": "le truc", "es": "la cosa", "it": "il coso"}
    rows = [(i * 5 + j, f"{text} anna berlin", lang) for i in range(8) for j, (lang, text) in enumerate(own.items())]
    rows += [(100, "Anna", None), (101, "anna berlin", "en"), (102, "Berlin!", None), (103, "12 !!", "en"),
             (104, None, None), (None, "berlin", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in cp.language_stage(spark, df, "").collect()}
    assert kept == {r[0] for r in rows} - {103, 104}
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert cp.language_stage(spark, unlabelled, "").count() == len(rows)


def test_pipeline_stage_by_stage(spark, docs):
    import corpus_pipeline as cp
    from touchcredit.llm.common import pin

    sf = "/root/testdata/sf0.01"
    now, kept = docs, {}
    for name, stage in cp.STAGES:
        now = pin(stage(spark, now, sf), "test-stage")
        kept[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    speech = {r.doc_id for r in kept["language_id"].collect()}
    assert all(any(c.isalpha() for c in rows[d].text) for d in speech)
    assert len(speech) >= 0.97 * sum(any(c.isalpha() for c in r.text or "") for r in rows.values())
    exact = {r.doc_id for r in kept["exact_dedup"].collect()}
    groups = slow_exact([rows[d] for d in sorted(speech)])
    assert exact == {max(sorted(speech)[i] for i in at) for at in groups.values()}
    near = {r.doc_id for r in kept["simhash_near_dedup"].collect()}
    ids = sorted(exact)
    assert near == set(slow_components(ids, [slow_fingerprint(rows[d].text) for d in ids]))
    mixed = kept["mixing"].groupBy("doc_id").count().collect()
    assert {r.doc_id for r in mixed} <= near and all(r["count"] in (1, 2) for r in mixed)
    sizes = defaultdict(int)
    for d in near:
        sizes[rows[d].source] += len(rows[d].text.encode().split())
    goal, got = mixing.targets(sizes), defaultdict(int)
    for r in mixed:
        got[rows[r.doc_id].source] += r["count"] * len(rows[r.doc_id].text.encode().split())
    assert all(abs(got[s] - goal[s]) <= max(3, 0.02 * goal[s]) for s in goal)
    check_packing(kept["mixing"].collect(), kept["packing"].collect())
