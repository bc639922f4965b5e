"""The corpus queries over the supplied tables, and the pipeline stage by stage against brute force."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402

from pricemill.llm import bpe, decontam, htmltext, quality, simhash, suffixes  # noqa: E402
from pricemill.llm.common import stored, table  # noqa: E402
from pricemill.llm.oracle import ORACLES  # noqa: E402
from pricemill.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables are absent")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result_as_sql(spark, name):
    verdict = compare.compare(spark, compare.duck(SF), name, SF)
    assert verdict.startswith("ok"), verdict


def test_all_are_registered():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, SF)
        assert seen.schema.names == docs.schema.names, name


def test_pipeline_is_its_stages(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}

    scored = {r.doc_id: r.predicted for r in quality.score(docs, quality.learn(docs, table(spark, SF, "labels"))).collect()}
    kept = [i for i in sorted(rows) if scored[i]]
    assert 0 < len(kept) < len(rows)

    # Near-duplicates: smallest id of each component of fingerprints within two bits.
    fps = {i: simhash.simhash((rows[i].text or "").encode()) % 2**64 for i in kept}
    root = {i: i for i in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in kept:
        for j in kept:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = [i for i in kept if find(i) == i]

    # Repeated passages: bytes of windows that start earlier; only whole characters go.
    texts, seen = {}, set()
    for i in kept:
        t = (rows[i].text or "").encode()
        gone = bytearray(len(t))
        for a in range(len(t) - suffixes.SIZE + 1):
            w = t[a : a + suffixes.SIZE]
            if w in seen:
                gone[a : a + suffixes.SIZE] = b"\1" * suffixes.SIZE
            seen.add(w)
        text, at = "", 0
        for c in t.decode():
            n = len(c.encode())
            if not all(gone[at : at + n]):
                text += c
            at += n
        if text.strip() or not t:
            texts[i] = text

    # Contamination.
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = decontam.words_of((r.text or "").encode())
        n = min(13, len(w))
        windows |= {tuple(w[a : a + n]) for a in range(len(w) - n + 1) if n}
    for i in list(texts):
        w = decontam.words_of(texts[i].encode())
        hit = set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit.update(range(a, a + n))
        if hit and 20 * len(hit) >= len(w):
            del texts[i]

    path, pattern = bpe.vocabulary()
    compiled, ranks = bpe.patterns(pattern), bpe.ranks(path)
    want = {i: sum(len(bpe.merge(w.encode(), ranks)) for w in bpe.pre_tokens(t, compiled)) for i, t in texts.items()}
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stage_of_near_duplicates_broadcasts_no_variants(spark, monkeypatch):
    """Spark expects the 64 variants of each fingerprint to be as small as the fingerprints, which must not put them in the driver."""
    plans = []

    def watched(df):
        out = stored(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(simhash, "stored", watched)
    docs = spark.createDataFrame([(i, f"one text of number {i // 2}") for i in range(400)], "doc_id long, text string")
    kept = corpus_pipeline.distinct(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} <= set(range(0, 400, 2))
    variants = [p for p in plans if "explode" in p]
    assert len(variants) == 1 and "SortMergeJoin" in variants[0] and "Broadcast" not in variants[0]


def test_pages_keep_their_article(spark):
    """The supplied pages hold one article; every paragraph of it stays, and nothing else does."""
    import html
    import re

    got = {r.page_id: r.text for r in htmltext.main_text(table(spark, SF, "pages")).collect()}
    for r in table(spark, SF, "pages").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1|article)>", article)]
        assert got[r.page_id].split("\n") == [b for b in blocks if b]
