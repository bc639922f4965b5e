"""Each corpus operator against a brute-force version, on small tables with the awkward cases."""

import hashlib
import os
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pricemill.llm import anchors, blockmax, bpe, debruijn, decontam, htmltext, langid, quality, sharding, simhash, suffixes
from pricemill.llm.common import BATCH_BYTES, stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, id string, tag long"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that the operators use inside."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "y", 7) for i, t, lang in rows], DOCS)


def words(rng, n, vocabulary=40):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ünder", "zoo"]) + str(rng.randrange(vocabulary)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    shared = words(rng, 70)
    long = words(rng, 6000, 900)
    near = words(rng, 200)
    out = [
        (3, None, "en"),
        (1, "", "en"),
        (2, "   \n\t ", "en"),
        (4, "One", None),
        (5, "one TWO", "en"),
        (10, shared, "en"),
        (11, "before " + shared + "\n\nafter that", "de"),
        (12, shared, "en"),
        (20, long, "en"),
        (21, long[:9000] + " cut " + long[9000:], "en"),
        (22, "x" * 1000, "fr"),
        (23, "é" * 300 + "x" * 150, "fr"),
        (24, "abc " * 400, "fr"),
        (40, long, "en"),
    ]
    for k in range(12):
        parts = near.split()
        parts[(17 * k) % len(parts)] = f"edit{k}"
        out.append((100 + k, " ".join(parts), "en"))
    for k in range(30):
        out.append((200 + k, words(rng, rng.randrange(1, 300)), "en"))
    return out


def text_of(rows):
    return [(i, t) for i, t, _ in rows]


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in fps:
        for j in fps:
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in fps}


def test_simhash(spark, rows):
    found = {r.id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    fps = {i: fingerprint(t) for i, t in text_of(rows)}
    assert {i: f for i, (f, _) in found.items()} == fps
    assert {i: c for i, (_, c) in found.items()} == classes(fps)


def test_simhash_repeated_rows_and_null_ids(spark):
    got = simhash.near_duplicates(frame(spark, [(5, "a b c", "x"), (5, "a b c", "x"), (None, "a b c", "x"), (None, None, "x")])).collect()
    assert sorted((str(r.id), str(r.component_id)) for r in got) == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
    kept = simhash.keep_one(frame(spark, [(5, "a b c", "x"), (5, "a b c", "x"), (6, "a b c", "y")])).collect()
    assert [(r.doc_id, r.tag) for r in kept] == [(5, 7)]


def test_keep_one_keeps_a_row_of_each_component(spark):
    rng = random.Random(6)
    t1, t2, t3, t4 = (words(rng, 60) for _ in range(4))
    rows = [(3, t1), (5, t1), (5, t2), (None, t3), (None, t3), (None, t4), (7, t4), (None, words(rng, 60)), (None, None), (None, "")]
    kept = simhash.keep_one(frame(spark, [(i, t, "") for i, t in rows])).collect()
    got = Counter((r.doc_id, r.text or "") for r in kept)
    assert got == Counter([(3, t1), (5, t2), (None, t3), (7, t4), (None, rows[7][1]), (None, "")])
    assert all(r.tag == 7 and r.fp == "x" for r in kept)


def test_simhash_crowded_buckets_lose_no_link(spark):
    rng = random.Random(2)
    base = rng.getrandbits(63)
    fps = {base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(60)} | {rng.getrandbits(63) for _ in range(20)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
    wide = {tuple(r) for r in simhash.links(df).collect()}
    assert wide == want

    def joined(edges):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return {f: find(f) for f in fps}

    crowded = {tuple(r) for r in simhash.links(df, crowd=3).collect()}
    assert crowded <= want | {(b, a) for a, b in want}
    assert joined(crowded) == joined(want)


def test_simhash_broadcasts_no_variants(spark, monkeypatch):
    """The 64 variants of each fingerprint outgrow what Spark expects of them."""
    plans = []

    def watched(df):
        out = stored(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(simhash, "stored", watched)
    rng = random.Random(3)
    fps = [rng.getrandbits(60) for _ in range(500)]
    found = simhash.links(spark.createDataFrame([(f,) for f in [*fps, *(f ^ 5 for f in fps)]], "fp long")).collect()
    assert {tuple(r) for r in found} == {(min(f, f ^ 5), max(f, f ^ 5)) for f in fps}
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_components_of_a_long_chain(spark):
    from pricemill.llm.common import components

    n = 300
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (1001, 1000)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_decontamination(spark, rows):
    rng = random.Random(8)
    items = [(1, "ab Cd ef"), (2, words(rng, 30)), (3, None), (4, ""), (7, "..."), (None, "zz zz"), (10, rows[5][1]), (11, "cd EF"), (12, "x x x x")]
    docs = text_of(rows) + [(900, "start AB, cd.ef end"), (901, "x x x x x"), (902, "  " + items[1][1].upper() + " more"), (903, None), (904, " ".join(items[1][1].split()[4:20]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontam.digest(decontam.hits(frame(spark, [(i, t, "") for i, t in docs]), bench)).collect()}
    fold = decontam.words_of
    windows = defaultdict(set)
    for i, t in items:
        w = fold((t or "").encode())
        if i is not None and w:
            n = min(13, len(w))
            for a in range(len(w) - n + 1):
                windows[tuple(w[a : a + n])].add(str(i))
    for i, t in docs:
        w = fold((t or "").encode())
        hit, names = set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if (run := tuple(w[a : a + n])) in windows:
                    hit.update(range(a, a + n))
                    names |= windows[run]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert got[i] == (len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)), i
    kept = decontam.clean(frame(spark, [(i, t, "") for i, t in docs]), bench).collect()
    assert {r.doc_id for r in kept} == {i for i, v in got.items() if not v[4]}
    assert decontam.hits(frame(spark, docs_ := [(1, "a b", "")]), bench.where("false")).first().n_words == len(docs_[0][1].split())


def test_decontamination_by_items_without_an_id(spark):
    bench = spark.createDataFrame([(None, "zz yy"), (None, "qq pp"), (3, "ab cd"), (None, None)], "item_id long, text string")
    docs = frame(spark, [(1, "Zz yy and qq pp", ""), (2, "ab cd zz yy", ""), (3, "zz and yy", "")])
    got = {r.doc_id: tuple(r)[1:] for r in decontam.digest(decontam.hits(docs, bench)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got == {1: (5, 4, 1, sha(""), True), 2: (4, 4, 2, sha("3"), True), 3: (3, 0, 0, sha(""), False)}
    assert [r.doc_id for r in decontam.clean(docs, bench).collect()] == [3]


@pytest.mark.parametrize("sizes", [(50, 14), (5, 3), (3, 3)])
def test_repeated_words(spark, rows, sizes):
    got = {r.doc_id: tuple(r)[1:] for r in debruijn.digest(debruijn.repeated_words(frame(spark, rows), *sizes)).collect()}
    assert got == debruijn.brute_force(text_of(rows), sizes[0])


@pytest.mark.parametrize("sizes", [(100, 28), (12, 7)])
def test_repeated_bytes(spark, rows, sizes):
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.digest(suffixes.repeated_bytes(frame(spark, rows), *sizes)).collect()}
    assert got == suffixes.brute_force(text_of(rows), sizes[0])


def test_repeated_bytes_in_crowded_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 2)
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.digest(suffixes.repeated_bytes(frame(spark, rows))).collect()}
    assert got == suffixes.brute_force(text_of(rows))


def test_repeated_bytes_take_texts_in_small_batches(spark, monkeypatch):
    def watched(make):
        def bounded(batches):
            for b in batches:
                assert b.nbytes < 6 << 20
                yield b

        return lambda size: lambda batches: make(size)(bounded(batches))

    for name in ("_fetch", "_cut"):
        monkeypatch.setattr(suffixes, name, watched(getattr(suffixes, name)))
    before = spark.conf.get(BATCH_BYTES, None)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "concat(repeat(md5(cast(id AS string)), 100), repeat('x', 1000)) AS text")
    try:
        spark.conf.unset(BATCH_BYTES)
        found = suffixes.digest(suffixes.repeated_bytes(docs)).agg(F.count("*"), F.sum("n_bytes"), F.min(F.when(F.col("doc_id") > 0, F.col("n_removed")))).first()
        # A text's own 32 bytes are new once; their repeats and the x after them go.
        assert tuple(found) == (3000, 3000 * 4200, 4168)
        spark.conf.set(BATCH_BYTES, "1m")
        suffixes.repeated_bytes(docs)
        assert spark.conf.get(BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def test_open_runs_are_sorted_in_small_memory():
    rng = np.random.default_rng(2)
    rows = []
    for key in range(300):
        grams = rng.integers(97, 123, 28, dtype=np.uint8).tobytes()
        h = int(anchors.gram_hashes(anchors._SYMBOL[np.frombuffer(grams, np.uint8)], 28).view(np.int64)[0])
        rows += [(h, i, 0, 0, 37, rng.integers(97, 123, 72, dtype=np.uint8).tobytes() + grams + rng.integers(97, 123, 36, dtype=np.uint8).tobytes()) for i in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "id", "tag", "at", "n", "data"])
    tracemalloc.start()
    try:
        found = sum(b.num_rows for b in suffixes._resolve(100, 28)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 0 and peak < 64 << 20


def test_repeated_words_in_crowded_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(debruijn, "CROWD", 2)
    got = {r.doc_id: tuple(r)[1:] for r in debruijn.digest(debruijn.repeated_words(frame(spark, rows))).collect()}
    assert got == debruijn.brute_force(text_of(rows))


def test_repeats_with_equal_and_null_ids(spark):
    rng = random.Random(4)
    t, other = words(rng, 80), words(rng, 80)
    rows = [(None, t, ""), (None, t, ""), (7, t, ""), (7, other, ""), (8, other, ""), (8, other, "")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed > 0) for r in debruijn.digest(debruijn.repeated_words(frame(spark, rows))).collect())
    assert got == [(False, 7, False), (False, 7, True), (False, 8, True), (False, 8, True), (True, 0, False), (True, 0, False)]
    bytes_ = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed > 0) for r in suffixes.digest(suffixes.repeated_bytes(frame(spark, rows))).collect())
    assert bytes_ == got


def test_suffix_order_with_long_ties():
    rng = np.random.default_rng(3)
    part = rng.integers(97, 99, 400, dtype=np.uint8)
    buffer = np.concatenate([part, part[:200], np.full(300, 97, np.uint8), part[50:350]])
    starts = np.arange(len(buffer))
    order, same = suffixes.sort_suffixes(buffer, starts, 100)
    padded = buffer.tobytes() + bytes(200)
    firsts = [padded[s : s + 100] for s in starts[order]]
    assert firsts == sorted(firsts)
    assert same.tolist() == [False] + [a == b for a, b in zip(firsts, firsts[1:])]


def test_pipeline_cut_keeps_whole_characters(spark):
    rng = random.Random(1)
    passage = "".join(rng.choice("éèàùôîçñ") for _ in range(120))
    docs = frame(spark, [(1, passage + " one two", ""), (2, "xé" + passage, ""), (3, passage + " one two", ""), (4, None, ""), (5, "", "")])
    got = {r.doc_id: (r.text, r.n_chars) for r in suffixes.without_repeats(docs).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1][0] == passage + " one two" and got[4] == (None, None) and got[5] == ("", 0)
    assert got[2][0].startswith("x") and got[2][1] == len(got[2][0])


def test_runs_cover_every_window_once():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 4, 5000).astype(np.uint64)
    key, at, n = anchors.runs_of(symbols, 20, 6)
    assert at[0] == 0 and (at[1:] == (at + n)[:-1]).all() and at[-1] + n[-1] == 5000 - 19
    h = anchors.gram_hashes(symbols, 6)
    order = np.uint64(0xFFFFFFFFFFF00000)
    for p in range(0, 4900, 37):
        run = np.searchsorted(at, p, side="right") - 1
        window = h[p : p + 15] & order
        assert key[run] == h[p + int(np.argmin(window))]


def test_bpe_against_tiktoken(spark, rows):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = bpe.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks(path), special_tokens={})
    rng = random.Random(3)
    odd = ["  two  spaces ", "it's we'll I'D x y", "日本語 テキスト 123", "a\x1cb\x1dc \x85 d", "½ ² Ⅷ ۳", "\U0001f600 ‍!", "<|endoftext|>", "z" * 3000, "ñ" * 700]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), rng.randrange(0x250, 0xD000), 32, 10])) for _ in range(200)) for _ in range(30)]
    docs = text_of(rows) + [(1000 + k, t) for k, t in enumerate(odd)]
    got = {r.doc_id: r for r in bpe.encode(frame(spark, [(i, t, "") for i, t in docs])).collect()}
    for i, t in docs:
        assert list(got[i].ids) == library.encode_ordinary(t or ""), i
        assert bytes(got[i].decoded) == (t or "").encode()
    digest = {r.doc_id: r for r in bpe.digest(bpe.encode(frame(spark, rows))).collect()}
    ids = library.encode_ordinary(rows[5][1])
    assert digest[10].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and digest[10].n_tokens == len(ids)
    assert digest[3].n_tokens == 0 and digest[3].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_bpe_decode_joins_the_token_table(spark):
    tokens = bpe.token_table(spark)
    text = "Zwölf Boxkämpfer 123!"
    path, pattern = bpe.vocabulary()
    ids = [i for w in bpe.pre_tokens(text, bpe.patterns(pattern)) for i in bpe.merge(w.encode(), bpe.ranks(path))]
    df = spark.createDataFrame([(1, ids), (1, ids), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = sorted((r.doc_id, bytes(r.decoded)) for r in bpe.decode(df, tokens).collect())
    assert got == [(1, text.encode()), (1, text.encode()), (2, b""), (3, b"")]
    with pytest.raises(Exception, match="unknown token"):
        bpe.decode(spark.createDataFrame([(1, [10**8])], "doc_id long, ids array<int>"), tokens).collect()


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(230)]
    vectors += [(300, None), (350, [1.0, float("nan")] * 8), (400, [float("inf")] * 16), (450, [None] + [0.5] * 15), (None, [1.0] * 16)]
    vectors += [(50, vectors[50][1]), (500, []), (550, [0.25, -0.1]), (7, vectors[7][1])]
    df = spark.createDataFrame([(i, v, 1, "g") for i, v in vectors], "vec_id long, embedding array<double>, label int, group string")
    got = defaultdict(list)
    for r in sorted(blockmax.top_k(df).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    valid = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    asked = {i: v for i, v in valid if i % 50 == 0}
    want = {i: [(j, s) for s, j in sorted((-dot(v, w), j) for j, w in valid if j != i)[:5]] for i, v in asked.items()}
    assert dict(got) == {i: [(j, -s) for j, s in v] for i, v in want.items()}
    assert blockmax.top_k(df.where("false")).count() == 0


def test_top_k_broadcasts_no_batches(spark, monkeypatch):
    """Batches copied to every block outgrow what Spark expects of them."""
    monkeypatch.setattr(blockmax, "BLOCK", 64)
    monkeypatch.setattr(blockmax, "BATCH", 8)
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)]) for i in range(1000)], "vec_id long, embedding array<double>")
    found = blockmax.top_k(df)
    assert len(found.collect()) == 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_top_k_stops_only_on_proof():
    rng = np.random.default_rng(6)
    v = rng.integers(-300, 300, (400, 24))
    v[:20] *= 50
    ids = np.arange(400)
    got, _ = blockmax.best_in_block(ids[:40], v[:40], ids, v, 5)
    for i in range(40):
        want = sorted((-int(v[i] @ v[j]), j) for j in range(400) if j != i)[:5]
        assert [(-s, j) for q, j, s in got if q == i] == want


def test_top_k_reads_a_part_of_clustered_postings():
    """Less than half of the postings are read where a query's neighbours stand out, and the result is exact."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, 48))
    v = np.floor(256 * (centres[rng.integers(0, 60, 3000)] + 0.04 * rng.normal(size=(3000, 48)))).astype(np.int64)
    v[100] = 0
    v[200:210] = v[5]
    ids = np.arange(3000)
    shares = []
    for a in range(0, 300, 10):
        got, share = blockmax.best_in_block(ids[a : a + 10], v[a : a + 10], ids, v, 5)
        shares.append(share)
        for i in range(a, a + 10):
            scores = v @ v[i]
            want = sorted((-int(scores[j]), j) for j in range(3000) if j != i)[:5]
            assert [(-s, j) for q, j, s in got if q == i] == want
    assert np.median(shares) < 0.5


def test_top_k_computes_bounds_where_they_can_tell(monkeypatch):
    """On vectors without clusters the bounds of all queries are left out while a few queries still want most vectors."""
    rng = np.random.default_rng(10)
    v = np.floor(64 * rng.normal(size=(1500, 32))).astype(np.int64)
    ids = np.arange(1500)
    cells, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *more, **named: (cells.append(a.size), partition(a, *more, **named))[1])
    got, _ = blockmax.best_in_block(ids[:200], v[:200], ids, v, 5)
    want = [sorted((-int(v[i] @ v[j]), j) for j in range(1500) if j != i)[:5] for i in range(200)]
    assert got == [(i, j, -s) for i in range(200) for s, j in want[i]]
    assert sum(cells) < 0.5 * blockmax.LEVELS * 200 * 1500


def test_top_k_segments_are_in_order_of_impact():
    rng = np.random.default_rng(8)
    v = rng.integers(-50, 50, (30, 7))
    postings, ends = blockmax.segments(v)
    size = np.abs(v).reshape(-1)
    assert sorted(postings.tolist()) == np.flatnonzero(size).tolist() and ends[-1] == len(postings)
    step = size.max() / blockmax.LEVELS
    for level, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        low = (blockmax.LEVELS - 1 - level) * step
        assert all(low <= x <= low + step for x in size[postings[a:b]].tolist())


def test_shards(spark, rows):
    hot = [(10_000 + k, "the same text again", "en") for k in range(500)]
    df = frame(spark, rows + hot + [(None, "no id", "en")])
    got = sharding.shard_by_bytes(df, 6).collect()
    assert Counter(r.doc_id for r in got) == Counter([r[0] for r in rows + hot] + [None])
    sizes, slots = Counter(), defaultdict(list)
    by_id = {i: t for i, t, _ in rows + hot}
    for r in got:
        if r.doc_id is not None:
            raw = (by_id[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) <= set(range(6))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    most = max(len((t or "").encode()) for _, t, _ in rows) + 8
    assert max(sizes.values()) - min(sizes.values()) <= 2 * most
    assert sharding.shard_by_bytes(df.where("false")).count() == 0


def test_shards_against_a_plain_cut(spark, rows):
    """Shards are stretches of one order of all rows, and each begins where a plain running sum says, within a row's
    bytes and the tolerance."""
    from pyspark.sql import functions as F

    more = rows + [(1000 + k, "same text here", "en") for k in range(300)]
    df = frame(spark, more)
    got = {}
    for r in sharding.shard_by_bytes(df, 7).collect():
        got.setdefault(r.doc_id, []).append(r)
    hashed = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = sorted((r.h, r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in hashed)
    total, largest = sum(x[2] for x in order), max(x[2] for x in order)
    shards = [got[i][0].shard for _, i, _, _ in order]
    assert shards == sorted(shards) and set(shards) <= set(range(7))
    before = 0
    for k, (_, i, size, crc) in enumerate(order):
        r = got[i][0]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (size, crc, "bytes", None)
        # A document longer than a shard's part leaves the next one empty.
        for s in range(shards[k - 1] + 1 if k else 1, shards[k] + 1):
            assert abs(before - s * total / 7) <= largest + sharding.TOLERANCE * total
        before += size
    for s in range(7):
        assert sorted(r.slot for rs in got.values() for r in rs if r.shard == s) == list(range(shards.count(s)))


def test_shards_cut_a_group_of_copies(spark):
    df = spark.createDataFrame([(i, "copy") for i in range(240)], "doc_id long, text string")
    counts = Counter(r.shard for r in sharding.shard_by_bytes(df).collect())
    assert counts == {s: 10 for s in range(24)}


def test_quality_learns_and_scores_everything(spark):
    rng = random.Random(9)
    good = [(i, ". ".join(words(rng, 12).capitalize() for _ in range(rng.randrange(2, 12))), "en") for i in range(160)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in words(rng, rng.randrange(20, 80)).split()), "en") for i in range(120)]
    docs = frame(spark, good + bad + [(5000, None, "en"), (5001, "", "en"), (None, "text", "en"), (0, good[0][1], "en")])
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in bad] + [(5000, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert len(got) == 284 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert all(r.predicted == (r.doc_id < 1000) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 5000)
    none = quality.score(docs, quality.learn(docs, labels.where("false")))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.keep_good(docs, quality.learn(docs, labels)).columns == docs.columns


def test_quality_ignores_held_out_labels(spark):
    rng = random.Random(9)
    docs = frame(spark, [(i, words(rng, 30 + i % 60), "en") for i in range(200)])
    labels = [(i, i % 2, 0) for i in range(200)]
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, 0) for i, q, _ in labels]
    a, b = (quality.learn(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, wrong))
    assert np.array_equal(a.value, b.value) and np.array_equal(a.feature, b.feature)


def plain_gain(g, h, left):
    def part(of):
        return g[of].sum() ** 2 / (h[of].sum() + quality.RIDGE)

    return part(left) + part(~left) - g.sum() ** 2 / (h.sum() + quality.RIDGE)


def test_quality_trees_against_a_plain_search(monkeypatch):
    """Every split is the best of all cuts of all features, every leaf has the plain step, and the flat walk ends where a
    recursive one does."""
    monkeypatch.setattr(quality, "DEPTH", 3)
    monkeypatch.setattr(quality, "TREES", 4)
    monkeypatch.setattr(quality, "BINS", 8)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=300), rng.integers(0, 3, 300), np.full(300, 2.0), rng.pareto(1, 300)])
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] == 1) | (x[:, 3] > 4)).astype(float)
    trees = quality.fit(x, y)
    b = trees.binned(x)
    total = np.full(len(x), np.log(y.mean() / (1 - y.mean())))

    def check(t, node, rows, depth, g, h):
        """Walks down with the rows of a node; returns the value that each of them gets."""
        assert trees.value[t, node] == pytest.approx(-quality.RATE * g[rows].sum() / (h[rows].sum() + quality.RIDGE))
        cuts = {}
        if depth < quality.DEPTH:
            for f in range(x.shape[1]):
                for c in range(quality.BINS):
                    left = b[rows, f] <= c
                    if quality.LEAF <= left.sum() <= len(rows) - quality.LEAF:
                        cuts[f, c] = plain_gain(g[rows], h[rows], left)
        best = max(cuts.values(), default=0.0)
        f = trees.feature[t, node]
        if depth == quality.DEPTH or f < 0:
            assert best <= 1e-6 + 1e-9
            return {int(i): trees.value[t, node] for i in rows}
        assert cuts[f, trees.bin[t, node]] == pytest.approx(best)
        left = b[rows, f] <= trees.bin[t, node]
        return check(t, 2 * node + 1, rows[left], depth + 1, g, h) | check(t, 2 * node + 2, rows[~left], depth + 1, g, h)

    for t in range(quality.TREES):
        p = 1 / (1 + np.exp(-total))
        step = check(t, 0, np.arange(len(x)), 0, p - y, p * (1 - p))
        total += np.array([step[i] for i in range(len(x))])
    assert trees.score(x) == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > max(y.mean(), 1 - y.mean()) + 0.1


def test_quality_statistics_by_hand():
    text = b"Ab c!\n12 $x |\xc3\xa9"
    found = dict(zip([*quality._CLASSES], quality.statistics(text)))
    assert [round(found[k] * len(text)) for k in ("lower", "upper", "digit", "beyond", "line", "loud", "sign", "bar")] == [3, 1, 2, 2, 1, 1, 1, 1]
    assert all(np.isfinite(quality.statistics(t)).all() for t in (b"", b" ", b"\n", b"a" * 100_000))


def test_quality_sample_is_bounded_by_documents(spark):
    """An id that repeats counts once, whatever number of rows it has."""
    rng = random.Random(14)
    rows = [(i % 5, words(rng, 20 + i), "en") for i in range(60)] + [(100 + i, words(rng, 15), "en") for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in [*range(5), *range(100, 130)]], "doc_id long, quality int, toxic int")
    seen = []
    fit = quality.fit
    try:
        quality.fit = lambda x, y: seen.append(len(x)) or fit(x, y)
        quality.learn(frame(spark, rows), labels)
        quality.learn(frame(spark, rows), labels, sample=7)
    finally:
        quality.fit = fit
    assert seen[0] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in [*range(5), *range(100, 130)]) and seen[1] <= 7


def greedy(sample, text):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at : at + size] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_language_phrases_are_greedy_longest_matches():
    rng = random.Random(2)
    samples = {"a": "".join(rng.choice("abc ") for _ in range(600)).encode(), "b": "".join(rng.choice("bcd ") for _ in range(500)).encode()}
    m = langid.model(samples)
    texts = ["".join(rng.choice("abcdx ") for _ in range(n)).encode() for n in (0, 1, 7, 300, langid.PIECE, 0, 3 * langid.PIECE + 5)]
    # Long phrases that never meet those of a piece parsed alone, and pieces that end in the middle of a phrase.
    texts += [b"a" * 5000, (samples["a"] * 30)[7:4000], (samples["b"] * 3)[:1700] + b"x" + samples["a"] * 9]
    got = langid.phrases(m, texts)
    for t, row in zip(texts, got):
        assert row.tolist() == [greedy(samples[k], t) for k in ("a", "b")]


def test_phrases_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(12)
    samples = {"a": "".join(rng.choice("ab ") for _ in range(300)).encode(), "b": b"ab" * 50}
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(200))).encode() for _ in range(60)] + [b"ab" * 400]
    m = langid.model(samples)
    whole = langid.phrases(m, texts)
    for piece, lanes in ((1, 7), (3, 5), (64, 1000)):
        monkeypatch.setattr(langid, "PIECE", piece)
        monkeypatch.setattr(langid, "LANES", lanes)
        assert (langid.phrases(m, texts) == whole).all()


def test_language_samples(spark):
    """An opening that all texts of a language share is not all that is learned of it, and a small sample still wins."""
    rng = random.Random(13)
    sets = {"en": "the of and thing with ation ing house water under".split(), "es": "el de que los casa agua bajo cion mente para".split()}
    rows = [(i, " ".join(rng.choice(sets[k]) for _ in range(80)), k) for i, k in enumerate(["en", "es"] * 300)]
    opened = [(i, ("xyz " * 24 if k == "es" else "") + t, k) for i, t, k in rows]
    few = [r for r in rows if r[2] == "en"] + [(r[0], r[1][:90], r[2]) for r in rows if r[2] == "es"][:4]
    tested = [(10_000 + i, " ".join(rng.choice(sets[k]) for _ in range(60)), k) for i, k in enumerate(["en", "es"] * 40)]
    for learned in (opened, few):
        m = langid.learn(frame(spark, learned))
        got = {r.doc_id: r.lang_pred for r in langid.predict(frame(spark, tested), m).collect()}
        assert sum(got[i] == k for i, _, k in tested) >= 78


def test_language(spark):
    rng = random.Random(3)
    sets = {"en": "the of and thing with ation ing".split(), "fr": "été le aux eau ière que ment".split()}
    rows = [(i, " ".join(rng.choice(sets[k]) for _ in range(rng.randrange(5, 60))), k) for i, k in enumerate(["en", "fr"] * 60)]
    odd = [(500, None, "en"), (501, "", "fr"), (502, "123 !!", "en"), (503, "été", None), (None, "the thing", "en")]
    docs = frame(spark, rows + odd)
    got = langid.predict(docs, langid.learn(docs)).collect()
    assert len(got) == 125 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (500, 501, 502, 503)] == ["und", "und", "und", "fr"]
    assert all(by_id[i].lang_pred == k for i, _, k in rows if by_id[i].held_out)
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    assert {r.lang_pred for r in langid.predict(docs, langid.learn(docs.where("false"))).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- x --><div class="ad">Buy</div>{body}
<footer>&copy; site</footer></body></html>"""


def test_html_article():
    page = PAGE.format(body="<article><header><h1>Tom &amp; Jerry&#39;s</h1></header><p>One <b>two</b><br>three <span class=ad><div>buy</div></span>\n  four<p>five &lt;p&gt;<aside>related</aside><form>x</form><section class='comments'><p>first!</p></section><p>six</article>")
    lines, found = htmltext.lines_of(page)
    assert found and [t for t, inside in lines if inside] == ["Tom & Jerry's", "One two three four", "five <p>", "six"]


def test_html_differencing(spark):
    body = "<div><p>Welcome to the site</p></div><p>Own {n} text</p><p>Same {n} again</p><p>All rights kept by us</p>"
    pages = [(i, f"http://h.example/a/{i}", PAGE.format(body=body.format(n=i))) for i in range(4)]
    quoted = PAGE.format(body="<article><p>quoted line</p></article>")
    pages += [(10, "http://q.example/1", quoted), (11, "http://q.example/2", quoted.replace("</article>", "<p>own</p></article>")), (20, None, None), (21, "http://[bad", ""), (22, "x", "plain"), (22, "x", "plain"), (None, "http://q.example/3", quoted)]
    df = spark.createDataFrame([(*p, "k", "n") for p in pages], "page_id long, url string, html string, key string, near string")
    got = htmltext.main_text(df).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert [text[i] for i in range(4)] == [f"Own {i} text\nSame {i} again" for i in range(4)]
    assert text[10] == "quoted line" and text[11] == "quoted line\nown" and text[20] == "" and text[21] == "" and text[22] == "plain"


def html_by_brute_force(pages):
    """Text of pages without an article, each against all pages of its host."""
    from os.path import commonprefix

    seen = {}
    for key, url, lines in pages:
        seen[key] = (*htmltext.address(url), key, lines)
    order = sorted(seen.values(), key=lambda r: (r[0], r[1].encode(), r[2]))
    out = {}
    for i, (host, path, key, lines) in enumerate(order):
        far = lambda o: 5 * (len(lines) + len(o) - 2 * len(htmltext.shared(lines, o))) > 2 * len(lines)
        best = None
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(order) and order[j][0] == host and not far(order[j][3]):
                j += step
            if 0 <= j < len(order) and order[j][0] == host:
                size = len(commonprefix([path, order[j][1]]))
                if best is None or size > best[0]:
                    best = (size, order[j][3])
        site = set(htmltext.shared(lines, best[1])) if best else set()
        out[key] = "\n".join(t for k, t in enumerate(lines) if k not in site)
    return out


def html_frame(spark, pages):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, u, "".join(f"<p>{t}</p>" for t in lines)) for i, u, lines in pages], "page_id long, url string, html string")
    keys = {r.page_id: r.k for r in df.select("page_id", F.xxhash64("page_id", "url", "html").alias("k")).collect()}
    return df, keys


def html_check(spark, pages):
    """Text by address, once it equals brute force."""
    df, keys = html_frame(spark, pages)
    want = html_by_brute_force([(keys[i], u, lines) for i, u, lines in pages])
    got = {r.page_id: r.text for r in htmltext.main_text(df).collect()}
    assert got == {i: want[keys[i]] for i, _, _ in pages}
    return {u: got[i] for i, u, _ in pages}


def test_html_large_host_with_sections(spark):
    pages = []
    for k in range(2600):
        section = k // 2
        pages.append((k, f"http://big.example/s{section:04}/{k}", ["Site", f"Menu of {section}", f"Notice of {section}", *[f"own {k} {x}" for x in "abc"]]))
    text = html_check(spark, pages)
    assert all(text[u] == f"own {k} a\nown {k} b\nown {k} c" for k, u, _ in pages)


def test_html_groups_of_copies(spark):
    rng = random.Random(8)
    pages = []

    def add(url, lines):
        pages.append((len(pages), url, lines))

    for group in range(60):  # copies, near copies and chains of edits, in groups that span ranges
        text = [f"text {group} {i}" for i in range(10)]
        for k in range(rng.choice([1, 2, 3, 40])):
            if rng.random() < 0.5:
                text[rng.randrange(10)] = f"edit {group} {k}"
            add(f"http://copies.example/{group:02}?p={k:02}", ["Top", f"Group {group}", *text, "End"])
    for k in range(600):
        add(f"http://same.example/{k:04}", [f"line {i}" for i in range(10)] + ["all"])
    add("http://same.example/zzz", ["all", "other"])
    for k in range(3):
        add(f"http://two.example/{k}", [f"line {i}" for i in range(9)] + [f"odd {k}"])
    text = html_check(spark, pages)
    assert text["http://same.example/0300"].endswith("line 9") and text["http://two.example/1"].endswith("line 8\nodd 1")


def test_longest_common_subsequence(monkeypatch):
    rng = random.Random(1)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for bits in (1 << 26, 20):
        monkeypatch.setattr(htmltext, "TABLE_BITS", bits)
        for _ in range(60):
            a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 30))] for _ in range(2))
            at = htmltext.shared(a, b)
            assert len(at) == length(a, b) and at == sorted(set(at))
            rest = iter(b)
            assert all(any(a[i] == y for y in rest) for i in at)


def test_empty_tables(spark):
    none = frame(spark, [(1, "a", "en")]).where("false")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    assert quality.score(none, quality.learn(none, labels)).count() == 0
    assert decontam.digest(decontam.hits(none, bench)).count() == 0
    assert debruijn.repeated_words(none).count() == 0
    assert suffixes.repeated_bytes(none).count() == 0
    assert suffixes.without_repeats(none).count() == 0
    assert bpe.digest(bpe.encode(none)).count() == 0
    assert langid.predict(none, langid.learn(none)).count() == 0
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string").where("false")
    assert htmltext.main_text(pages).count() == 0


def brute_hits(docs, bench):
    """Hit words of each document, by comparing every window."""
    windows = set()
    for _, t in bench:
        w = decontam.words_of((t or "").encode())
        n = min(13, len(w))
        windows |= {tuple(w[a : a + n]) for a in range(len(w) - n + 1) if n}
    out = {}
    for i, t in docs:
        w = decontam.words_of((t or "").encode())
        out[i] = {a + k for n in {len(x) for x in windows} for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in windows for k in range(n)}
    return out


@pytest.mark.parametrize("most", [30, 400_000])
def test_hits_of_several_automata(spark, monkeypatch, most):
    """A benchmark that needs many automata gives what one gives: intervals of a document are united over all."""
    monkeypatch.setattr(decontam, "AUTOMATON_WORDS", most)
    rng = random.Random(21)
    bench = [(f"i{k}" if k % 7 else None, words(rng, rng.choice([5, 13, 40]), 9)) for k in range(25)] + [("none", None), ("empty", "!")]
    docs = []
    for k in range(40):
        parts = [words(rng, rng.choice([0, 20, 200]), 9) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            item = rng.choice(bench[:25])[1].split()
            a = rng.randrange(len(item))
            parts.insert(rng.randrange(4), " ".join(item[max(0, a - 15) : a + 15]))
        docs.append((k, ", ".join(parts)))
    docs += [(50, None), (51, ""), (52, bench[3][1] + "\n" + bench[4][1]), (52, bench[3][1] + "\n" + bench[4][1]), (None, bench[5][1])]
    table = frame(spark, [(i, t, "") for i, t in docs])
    items = spark.createDataFrame(bench, "item_id string, text string")
    want = brute_hits(docs, bench)
    got = decontam.hits(table, items).collect()
    assert len(got) == len(docs) and any(want.values())
    for r in got:
        assert {k for s, e in zip(r.starts, r.ends) for k in range(s, e)} == want[r.doc_id]
        assert all(a < b for a, b in zip(r.ends, r.starts[1:]))
    bad = {i for i, t in docs if want[i] and 20 * len(want[i]) >= len(decontam.words_of((t or "").encode()))}
    kept = decontam.clean(table, items)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad

    cut = {}
    for r in decontam.without_spans(table, items, words=20).collect():
        assert r.n_chars == len(r.text or "")
        cut[r.doc_id] = r.text
    for r in got:
        text = dict(docs)[r.doc_id]
        spans = [(s, e) for s, e in zip(r.starts, r.ends) if r.doc_id in bad or e - s >= 20]
        w = decontam.words_of((text or "").encode())
        left = [x for k, x in enumerate(w) if not any(s <= k < e for s, e in spans)]
        assert decontam.words_of((cut[r.doc_id] or "").encode()) == left
        assert spans or cut[r.doc_id] == text


def test_spans_go_and_the_rest_stays(spark):
    item = " ".join(f"q{k}" for k in range(30))
    text = f"Before, it -- {item.upper()}. \u00c4fter <b>{item}</b>!  " + "word " * 2000
    docs = frame(spark, [(1, text, "")]).selectExpr("*", "1 as id2", "text as `spans`", "doc_id as `row`")
    bench = spark.createDataFrame([("a", item)], "item_id string, text string")
    row = decontam.without_spans(docs, bench).first()
    assert row.text == "Before, it -- . \u00c4fter <b></b>!  " + "word " * 2000 and row.spans == text
    assert decontam.without_spans(docs, bench, words=61).first().text == text
    assert decontam.without_spans(docs, bench.where("false")).first().text == text


def thue_morse(levels):
    a, b = "a", "b"
    for _ in range(levels):
        a, b = a + b, b + a
    return a, b


def test_long_words_that_a_polynomial_takes_for_equal(spark):
    """The two Thue-Morse words of 1,024 letters and more have equal polynomials modulo 2^64 at any base."""
    for levels in (4, 10, 11):
        one, other = thue_morse(levels)
        plain = [f"w{i}" for i in range(60)]
        docs = [(1, " ".join([*plain[:30], one, *plain[30:]]), "en"), (2, " ".join([*plain[:30], other, *plain[30:]]), "en")]
        docs += [(3, docs[0][1], "en")]
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in debruijn.digest(debruijn.repeated_words(frame(spark, docs))).collect()}
        assert got == debruijn.brute_force(text_of(docs)) and got[2][1] == 0 and got[3][1] == 61


def test_word_numbers():
    """Words of at most eight bytes are told apart by all their bytes, zero bytes and lengths included."""
    some = [b"a", b"a\0", b"\0", b"\0\0", b"ab", b"ba", b"abcdefgh", b"abcdefg", b"abcdefghi", b"x" * 5000, b"x" * 5001]
    numbers = anchors.word_symbols(b" ".join(some) + b"\n")[0]
    assert len(set(numbers.tolist())) == len(some)
    assert anchors.word_symbols(b"  " + some[6] + b" ")[0][0] == numbers[6]


CLASHING = ["__id", "__at", "__n", "__tag", "__kept", "__kept_tag", "row", "id", "at", "n", "tag", "least", "kept_id", "kept_tag", "fp", "c0", "with.dot"]


@pytest.mark.parametrize("stage", [simhash.keep_one, suffixes.without_repeats])
def test_stages_keep_columns_of_any_name(spark, rows, stage):
    plain = frame(spark, rows).select("doc_id", "text", "lang", "n_chars")
    clashing = plain.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in CLASHING])
    got = stage(clashing)
    assert got.columns == clashing.columns
    want = sorted(tuple(r) for r in stage(plain).collect())
    kept = got.collect()
    assert sorted(tuple(r)[:4] for r in kept) == want
    assert all(r[c] == f"{c}{r.doc_id}" for r in kept for c in CLASHING)


def test_html_names_inside_an_article():
    """Readers' replies go; a section that is about a search stays."""
    page = "<body><div class='search'>find</div><article><h1>T</h1><section class='search'><p>The search went on.</p></section><div class='replies'><p>me too</p></div><p>End</p></article><div id=login>x</div><p>beside</p></body>"
    lines, _ = htmltext.lines_of(page)
    assert [t for t, inside in lines if inside] == ["T", "The search went on.", "End"]
    assert [t for t, inside in lines if not inside] == ["beside"]


GIVEN = "/root/testdata/sf0.01/pages.parquet"


@pytest.mark.skipif(not os.path.exists(GIVEN), reason="supplied tables are absent")
def test_html_given_pages_without_article_elements(spark):
    """With article elements renamed, differencing and the names of elements alone decide about the given pages."""
    from pyspark.sql import functions as F

    given = spark.read.parquet(GIVEN)
    want = {r.page_id: r.text.split("\n") for r in htmltext.main_text(given).collect()}
    plain = given.withColumn("html", F.regexp_replace("html", "(?i)(</?)(article|main)\\b", "$1div"))
    got = {r.page_id: r.text.split("\n") for r in htmltext.main_text(plain).collect()}
    outlines = [(r.page_id, r.url, [t for t, _ in htmltext.lines_of(r.html)[0]]) for r in plain.collect()]
    assert {i: "\n".join(x) for i, x in got.items()} == html_by_brute_force(outlines)
    own, kept, right = (sum(x) for x in zip(*[(len(want[i]), len(got[i]), sum((Counter(want[i]) & Counter(got[i])).values())) for i in want]))
    print("article lines", own, "kept lines", kept, "of them article lines", right)
    assert right / own > 0.95 and right / kept > 0.95


def test_html_self_closing_pictures():
    for picture in ('<svg width="1"/>', "<math />", "<SVG/>", '<svg viewBox="0 0 1 1"><path d="M0"/></svg>'):
        lines, found = htmltext.lines_of(f"<article>{picture}<p>Hello world</p></article>")
        assert found and lines == [("Hello world", True)]
