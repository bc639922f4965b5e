"""Repeated word passages by compaction of a de Bruijn graph.

An edge of the graph is a window of 50 words; edges that follow each other share 49 of them. Edges are kept in buckets
by anchor, as runs of consecutive windows (`anchors`), so equal edges always meet in one bucket. A run whose class also
occurs under a smaller document id repeats as a whole. What is left open is compacted: where an edge has one successor
everywhere it occurs, and that one has no other predecessor, both belong to one path; the end of a run counts as a
successor of its own. A path so occurs as a whole or not at all. Paths are joined with their smallest source id, and
the coordinates of their occurrences say which words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.anchors import by_document, settle, word_bounds, word_symbols
from pricemill.llm.common import keyed, packed, partitions, runs, unkeyed, unpacked
from pricemill.sources.tables import stored

SIZE, GRAM = 50, 14

#: Open runs in a bucket from which its edges are joined one by one instead, so that no task holds the bucket.
CROWD = 20_000
#: Edges that are compacted together, as whole buckets.
BLOCK = 1 << 18
#: What stands before a run's first edge and after its last one.
_START, _END = -1, -2

_RUNS = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("edges", pa.binary()), ("hot", pa.bool_())])
RUNS = "key long, id long, tag long, at long, edges binary, hot boolean"
PATHS = "path long, check long, id long, tag long, at long, n int"
_PATHS = ["path", "check", "id", "tag", "at", "n"]


def edges_of(words: list[bytes], size: int, parts: list[tuple[int, int]]) -> Iterator[np.ndarray]:
    """The edges of runs (first window, number of windows), each as the 128 bits of a hash of its words' bytes."""
    line = memoryview(b" ".join(words))
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    begin = np.concatenate([[0], end[:-1] + 1]).tolist()
    end, h = end.tolist(), xxhash.xxh3_128_digest
    for at, n in parts:
        yield np.frombuffer(b"".join(h(line[begin[i] : end[i + size - 1]]) for i in range(at, at + n)), "<u8").reshape(-1, 2)


def _expand(size: int):
    """The edges of open runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for id_, tag, text, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), unpacked(b.column(2)), b.column(3).to_pylist()):
                for p, edges in zip(parts, edges_of(text.split(), size, [(p["at"], p["n"]) for p in parts])):
                    rows.append((p["key"], id_, tag, p["at"], edges.tobytes(), p["hot"]))
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 10_000]), _RUNS)], schema=_RUNS)

    return run


def paths(runs_: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(run, first edge in it, number of edges, path as 128 bits) of each place of the nonbranching paths that occur
    twice or more in some runs of edges, which hold whole buckets."""
    edges = np.concatenate(runs_)
    sizes = np.array([len(r) for r in runs_])
    first = np.zeros(len(edges), bool)
    first[np.cumsum(sizes) - sizes] = True
    order = np.lexsort((edges[:, 1], edges[:, 0]))
    same = edges[order]
    heads = np.flatnonzero(np.concatenate([[True], (same[1:] != same[:-1]).any(axis=1)]))
    times = np.diff(np.concatenate([heads, [len(edges)]]))
    of = np.empty(len(edges), np.int64)
    of[order] = np.repeat(np.arange(len(heads)), times)
    before = np.where(first, _START, np.concatenate([[_START], of[:-1]]))
    after = np.where(np.concatenate([first[1:], [True]]), _END, np.concatenate([of[1:], [_END]]))
    one_before, one_after = (np.minimum.reduceat(x[order], heads) == np.maximum.reduceat(x[order], heads) for x in (before, after))
    linked = np.concatenate([[False], one_after[of[:-1]] & one_before[of[1:]]]) & ~first
    start = np.flatnonzero(~linked)
    n = np.diff(np.concatenate([start, [len(edges)]]))
    often = times[of[start]] > 1
    start, n = start[often], n[often]
    owner = np.repeat(np.arange(len(runs_)), sizes)[start]
    data, h = memoryview(edges.tobytes()), xxhash.xxh3_128_digest
    path = np.frombuffer(b"".join(h(data[16 * s : 16 * (s + k)]) for s, k in zip(start.tolist(), n.tolist())), "<i8").reshape(-1, 2)
    return owner, start - (np.cumsum(sizes) - sizes)[owner], n, path


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of whole buckets; the runs come sorted by key."""

    def rows_of(held: list[tuple]) -> pa.RecordBatch:
        owner, off, n, path = paths([np.frombuffer(r[4], "<u8").reshape(-1, 2) for r in held])
        id_, tag, at = (np.array([r[c] for r in held], np.int64) for c in (1, 2, 3))
        columns = (path[:, 0], path[:, 1], id_[owner], tag[owner], at[owner] + off, n.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _PATHS)

    held: list[tuple] = []
    volume = 0
    for b in batches:
        for row in zip(*[b.column(c).to_pylist() for c in range(5)]):
            if volume >= BLOCK and row[0] != held[-1][0]:
                yield rows_of(held)
                held, volume = [], 0
            held.append(row)
            volume += len(row[4]) // 16
    if held:
        yield rows_of(held)


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each edge as a path of its own."""
    for b in batches:
        for id_, tag, at, edges in zip(*[b.column(c).to_pylist() for c in range(1, 5)]):
            e = np.frombuffer(edges, "<i8").reshape(-1, 2)
            m = len(e)
            columns = (e[:, 0], e[:, 1], np.full(m, id_, np.int64), np.full(m, tag, np.int64), at + np.arange(m), np.ones(m, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _PATHS)


def repeats(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """(id, tag, at, n): n windows from word `at` on whose words also start under a smaller id. docs: keyed."""
    spark = docs.sparkSession
    found = stored(spark, runs=settle(docs, word_symbols, size, gram, by_id=True))["runs"]
    sure = found.where("not open").select("id", "tag", "at", "n")
    open_ = found.where("open")
    crowded = open_.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > CROWD).select("key", F.lit(True).alias("crowd"))
    # Stored sides keep the joins splittable where a key or a path has many places.
    crowded = stored(spark, crowded=crowded)["crowded"]
    told = open_.join(crowded, "key", "left").withColumn("hot", F.coalesce("crowd", F.lit(False)))
    undecided = by_document(told, "key", "at", "n", "hot")
    wanted = packed(docs).join(undecided, ["id", "tag"]).select("id", "tag", "text", "parts")
    runs_ = stored(spark, edges=wanted.mapInArrow(_expand(size), RUNS))["edges"]
    dealt = runs_.where("not hot").repartition(partitions(spark), "key").sortWithinPartitions("key")
    occurrences = stored(spark, paths=dealt.mapInArrow(_compact, PATHS).union(runs_.where("hot").mapInArrow(_single, PATHS)))["paths"]
    by = ["path", "check"]
    sources = stored(spark, sources=occurrences.groupBy(*by).agg(F.min("id").alias("source")))["sources"]
    late = occurrences.join(sources, by).where("source < id").select("id", "tag", "at", "n")
    return sure.union(late)


KEPT = "doc_id long, n_words long, starts array<long>, ends array<long>, kept binary"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for id_, text, at, n in zip(b.column(0).to_pylist(), unpacked(b.column(1)), b.column(2), b.column(3)):
                begin, end = word_bounds(text)
                s = np.array(at.as_py() or [], np.int64)
                s, e = runs(s, s + np.array(n.as_py() or [], np.int64) + size - 1)
                words = text.split()
                for a, z in zip(s[::-1].tolist(), e[::-1].tolist()):
                    del words[a:z]
                rows.append((id_, len(begin), s.tolist(), e.tolist(), b" ".join(words)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _KEPT)], schema=_KEPT)

    return run


def repeated_words(docs: DataFrame, size: int = SIZE, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, starts, ends, kept) for every row: disjoint intervals of removed words, and the kept words
    joined by one space.

    A null or empty text has no words. A null id counts as smaller than any other, and rows that share an id do not
    count as earlier than each other. Repeated rows give repeated rows. An empty table gives no rows. Long texts are
    compared whole, in overlapping pieces that no window falls between. Other columns are not looked at, whatever their
    names.
    """
    texts = keyed(docs, id_col, text_col)
    found = repeats(texts.dropDuplicates(["id", "tag"]) if _repeated(texts) else texts, size, gram).groupBy("id", "tag").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))
    return packed(texts).join(found, ["id", "tag"], "left").select(unkeyed().alias("doc_id"), "text", "at", "n").mapInArrow(_cut(size), KEPT)


def _repeated(texts: DataFrame) -> bool:
    """Whether any row repeats another; judged without the texts."""
    return texts.groupBy("id", "tag").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, x: n + x["ends"] - x["starts"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str]], size: int = SIZE) -> dict[int, tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) of each document, straight from the definition; for tests."""
    words = {i: (t or "").encode().split() for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for a in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][a : a + size]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for a in range(len(w) - size + 1):
            if first[tuple(w[a : a + size])] < i:
                gone.update(range(a, a + size))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out
