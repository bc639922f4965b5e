"""Repeated byte passages by blockwise suffix sorting with a difference cover.

Suffixes that start equal windows of 100 bytes share an anchor (`anchors`), so they are sorted in buckets by anchor.
Runs of windows whose class has an earlier occurrence repeat as a whole. The suffixes left open are sorted, one bucket
at a time. Suffixes are compared by at most 31 bytes: the positions whose number modulo 31 lies in a difference cover
are ranked beforehand, and for any two suffixes some distance below 31 leads both to ranked positions, whose ranks
decide a longer tie. Memory is bounded by the block of text a task holds, not by the length of ties; texts reach the
tasks' Python in small batches.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.anchors import _SYMBOL, by_document, byte_symbols, gram_hashes, settle
from pricemill.llm.common import NO_ID, bytes_of, keyed, partitions, runs, small_batches, unkeyed
from pricemill.sources.tables import stored

SIZE, GRAM = 100, 28
#: A planar difference set: every difference modulo PERIOD is one of two members, exactly once.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Bytes of open runs that are sorted together, and suffixes in a bucket.
BLOCK, BUCKET = 1 << 19, 1 << 16
#: Open runs in a bucket from which its windows are told apart by hash instead, row by row, so that no task holds it.
CROWD = 20_000

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Distance from residue r to the first covered residue, and to one that suits both r and s.
_NEXT = np.array([next(d for d in range(PERIOD) if _IN_COVER[(r + d) % PERIOD]) for r in range(PERIOD)])
_BOTH = np.array([[next(d for d in range(PERIOD) if _IN_COVER[(r + d) % PERIOD] and _IN_COVER[(s + d) % PERIOD]) for s in range(PERIOD)] for r in range(PERIOD)])


def _eights(buffer: np.ndarray) -> np.ndarray:
    """Eight bytes from each position on as one number, so that numbers compare as the bytes do."""
    out = np.zeros(len(buffer), np.uint64)
    for j in range(8):
        out <<= np.uint64(8)
        out[: max(len(buffer) - j, 0)] |= buffer[j:]
    return out


def _at(eights: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return np.where(pos < len(eights), eights[np.minimum(pos, len(eights) - 1)], np.uint64(0))


def _ranked(eights: np.ndarray, pos: np.ndarray, depth: int, rank: np.ndarray | None = None) -> np.ndarray:
    """Rank of each position by its next `depth` bytes; equal bytes have equal ranks."""
    rank = np.zeros(len(pos), np.int64) if rank is None else rank
    for j in range(0, depth, 8):
        word = _at(eights, pos + j)
        if depth - j < 8:
            word = word >> np.uint64(8 * (8 - (depth - j)))
        order = np.lexsort((word, rank))
        r, w = rank[order], word[order]
        new = np.concatenate([[False], (r[1:] != r[:-1]) | (w[1:] != w[:-1])])
        rank = np.empty(len(pos), np.int64)
        rank[order] = np.cumsum(new)
        if len(pos) and new.sum() == len(pos) - 1:
            break
    return rank


def cover_ranks(eights: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Rank by `depth` bytes at each covered position, -1 elsewhere."""
    sample = np.flatnonzero(np.resize(_IN_COVER, n))
    out = np.full(n + PERIOD, -1, np.int32)
    out[sample] = _ranked(eights, sample, depth)
    return out


def sort_suffixes(buffer: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): starts in the order of their suffixes' first `size` bytes at least, and whether each shares its
    first `size` bytes with the one before it. Behind the buffer lie zeros."""
    n = len(buffer)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    eights = _eights(buffer)
    ranks = cover_ranks(eights, n, size)
    lead = _at(eights, starts)
    by_lead = np.argsort(lead, kind="stable")
    # A bucket ends where the leading eight bytes change; one bucket is sorted at a time.
    changes = np.flatnonzero(np.diff(lead[by_lead])) + 1
    wanted = np.arange(BUCKET, len(starts), BUCKET)
    cuts = np.unique(changes[np.minimum(np.searchsorted(changes, wanted), len(changes) - 1)]) if len(changes) else np.zeros(0, np.int64)
    order = np.concatenate([bucket[_sorted_bucket(eights, ranks, starts[bucket])] for bucket in np.split(by_lead, cuts)])
    s = starts[order]
    same = np.ones(len(s), bool)
    same[0] = False
    for j in range(0, size, 8):
        word = _at(eights, s + j)
        if size - j < 8:
            word = word >> np.uint64(8 * (8 - (size - j)))
        same[1:] &= word[1:] == word[:-1]
    return order, same


def _sorted_bucket(eights: np.ndarray, ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    tie = _ranked(eights, starts, PERIOD)
    residue = starts % PERIOD
    near = ranks[starts + _NEXT[residue]]
    order = np.lexsort((near, residue, tie))
    # Ties between different residues: merge by the distance that leads both to ranked positions.
    t, r = tie[order], residue[order]
    mixed = np.unique(t[1:][(t[1:] == t[:-1]) & (r[1:] != r[:-1])])
    for group in mixed.tolist():
        a, b = np.searchsorted(t, [group, group + 1])
        part = order[a:b]

        def compare(x: int, y: int) -> int:
            d = _BOTH[residue[x], residue[y]]
            return int(ranks[starts[x] + d]) - int(ranks[starts[y] + d])

        order[a:b] = sorted(part.tolist(), key=cmp_to_key(compare))
    return order


_OPEN = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("n", pa.int32()), ("data", pa.binary()), ("hot", pa.bool_())])
OPEN = "key long, id long, tag long, at long, n int, data binary, hot boolean"


def _fetch(size: int):
    """The bytes of open runs; of runs in a crowded bucket, a 128-bit hash for each window instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for id_, tag, text, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2)), b.column(3).to_pylist()):
                for p in parts:
                    at, n = p["at"], p["n"]
                    if p["hot"]:
                        rows += [(p["key"], id_, tag, a, 1, xxhash.xxh3_128_digest(text[a : a + size]), True) for a in range(at, at + n)]
                    else:
                        rows.append((p["key"], id_, tag, at, n, text[at : at + n + size - 1], False))
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 10_000]), _OPEN)], schema=_OPEN)

    return run


def _anchor_places(rows: list[tuple], lengths: np.ndarray, size: int) -> np.ndarray:
    """Where in its bytes each run's anchor stands: the first gram with the key as its hash that all windows hold."""
    data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
    begin = np.cumsum(lengths) - lengths
    key, n, gram = np.array([r[0] for r in rows]).view(np.uint64), np.array([r[4] for r in rows]), rows[0][6]
    h = gram_hashes(_SYMBOL[data], gram)
    places = size - gram - n + 2
    owner = np.repeat(np.arange(len(rows)), places)
    off = np.arange(len(owner)) - np.repeat(np.cumsum(places) - places, places) + n[owner] - 1
    hit = np.where(h[begin[owner] + off] == key[owner], off, size)
    return np.minimum.reduceat(hit, np.cumsum(places) - places)


def _resolve_block(rows: list[tuple], size: int) -> tuple[np.ndarray, ...]:
    """Windows of the open runs that have an earlier equal window: (id, tag, at, n)."""
    # Each run is laid down with zeros behind it and its anchor at residue 0, so that windows which can be equal have
    # equal residues, and their ranks decide without a merge.
    lengths = np.array([len(r[5]) for r in rows])
    shift = -_anchor_places(rows, lengths, size) % PERIOD
    slots = -(-(lengths + 2 * PERIOD) // PERIOD) * PERIOD
    begin = np.cumsum(slots) - slots + shift
    buffer = np.zeros(int(slots.sum()), np.uint8)
    for b, r in zip(begin.tolist(), rows):
        buffer[b : b + len(r[5])] = np.frombuffer(r[5], np.uint8)
    n = np.array([r[4] for r in rows])
    owner = np.repeat(np.arange(len(rows)), n)
    off = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    starts = begin[owner] + off
    id_, tag, at = (np.array([r[c] for r in rows], np.int64) for c in (1, 2, 3))
    order, same = sort_suffixes(buffer, starts, size)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(~same)
    place = np.lexsort((at[owner] + off, tag[owner], id_[owner], group))
    first = np.concatenate([[True], np.diff(group[place]) > 0])
    late = np.zeros(len(order), bool)
    late[place[~first]] = True
    # Consecutive late windows of a run become one row.
    edge = np.diff(np.concatenate([[0], late.view(np.int8), [0]]))
    breaks = np.concatenate([[False], (owner[1:] != owner[:-1]) & late[1:] & late[:-1]])
    a = np.flatnonzero((edge[:-1] == 1) | breaks)
    z = np.flatnonzero((edge[1:] == -1) | np.concatenate([breaks[1:], [False]])) + 1
    return id_[owner[a]], tag[owner[a]], at[owner[a]] + off[a], (z - a).astype(np.int32)


def _resolve(size: int, gram: int):
    def rows_of(block: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in _resolve_block(block, size)], ["id", "tag", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        volume = 0
        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in range(6)], itertools.repeat(gram)):
                if volume >= BLOCK and held and row[0] != held[-1][0]:
                    yield rows_of(held)
                    held, volume = [], 0
                held.append(row)
                volume += len(row[5])
        if held:
            yield rows_of(held)

    return run


def repeats(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """(id, tag, at, n): n windows from byte `at` on that also start earlier. docs: keyed."""
    spark = docs.sparkSession
    found = stored(spark, runs=settle(docs, byte_symbols, size, gram, by_id=False))["runs"]
    sure = found.where("not open").select("id", "tag", "at", "n")
    open_ = found.where("open")
    crowded = open_.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > CROWD).select("key", F.lit(True).alias("crowd"))
    crowded = stored(spark, crowded=crowded)["crowded"]  # so that the join can be split
    told = open_.join(crowded, "key", "left").withColumn("hot", F.coalesce("crowd", F.lit(False)))
    undecided = by_document(told, "key", "at", "n", "hot")
    texts = stored(spark, open=docs.join(undecided, ["id", "tag"]).select("id", "tag", "text", "parts").mapInArrow(_fetch(size), OPEN))["open"]
    dealt = texts.where("not hot").drop("hot").repartition(partitions(spark), "key").sortWithinPartitions("key")
    sorted_ = dealt.mapInArrow(_resolve(size, gram), "id long, tag long, at long, n int")
    hot = texts.where("hot").select("data", F.struct("id", "tag", "at").alias("place"))
    first = hot.groupBy("data").agg(F.min("place").alias("first"))
    late = hot.join(first, "data").where("place > first").select("place.id", "place.tag", "place.at", F.lit(1).alias("n"))
    return sure.union(sorted_).union(late)


KEPT = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])


def remove(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    keep = [0, *np.stack([starts, ends], axis=1).reshape(-1).tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(keep[::2], keep[1::2]))


def _spans(at: list | None, n: list | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    s = np.array(at or [], np.int64)
    return runs(s, s + np.array(n or [], np.int64) + size - 1)


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for id_, text, at, n in zip(b.column(0).to_pylist(), bytes_of(b.column(1)), b.column(2), b.column(3)):
                s, e = _spans(at.as_py(), n.as_py(), size)
                rows.append((id_, len(text), s.tolist(), e.tolist(), remove(text, s, e)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _KEPT)], schema=_KEPT)

    return run


def _found(texts: DataFrame, size: int, gram: int) -> DataFrame:
    """(id, tag, at, n): the windows of each document as lists. Rows that repeat both id and text are one document."""
    once = texts.dropDuplicates(["id", "tag"]) if _repeated(texts) else texts
    return repeats(once, size, gram).groupBy("id", "tag").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))


def _repeated(texts: DataFrame) -> bool:
    """Whether any row repeats another; judged without the texts."""
    return texts.groupBy("id", "tag").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0


def repeated_bytes(docs: DataFrame, size: int = SIZE, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept) for every row: disjoint intervals of removed bytes, and the bytes kept.

    A null or empty text has no bytes. A null id counts as smaller than any other; rows that share an id are ordered
    by a hash of their text. Rows that repeat both are one document, and each gets its result. An empty table gives no
    rows. Long texts are compared whole, in overlapping pieces that no window falls between. Other columns are not
    looked at, whatever their names. The session gets smaller Arrow batches, unless their bytes were set (`small_batches`).
    """
    small_batches(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    return texts.join(_found(texts, size, gram), ["id", "tag"], "left").select(unkeyed().alias("doc_id"), "text", "at", "n").mapInArrow(_cut(size), KEPT)


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, x: n + x["ends"] - x["starts"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """The documents, all columns, their texts without repeated bytes. A character goes if all of its
    bytes do. A column n_chars is counted anew. Documents of which nothing but white space is left, but had a text, go.
    Null and empty texts stay, other columns keep their names and values, and an empty table stays empty. The session
    gets smaller Arrow batches, unless their bytes were set (`small_batches`)."""
    small_batches(docs.sparkSession)
    texts = keyed(docs, "doc_id", "text")
    # The given columns travel as one, whatever their names, and are then told by place.
    given = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"))
    joined = given.join(_found(texts, size, gram), ["id", "tag"], "left")
    joined = joined.select(*[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col("at"), F.col("n"))
    names, at = docs.columns, docs.columns.index("text")
    counts = {docs.columns.index("n_chars")} if "n_chars" in docs.columns else set()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new, keep = [], []
            for text, s, n in zip(b.column(at).cast(pa.binary()).to_pylist(), b.column(len(names)), b.column(len(names) + 1)):
                if text and s.as_py():
                    cut = remove(text, *_whole_characters(text, *_spans(s.as_py(), n.as_py(), size)))
                    new.append(cut.decode())
                    keep.append(bool(cut.strip()))
                else:
                    new.append(None if text is None else text.decode())
                    keep.append(True)
            columns = [pa.array(new, pa.string()) if i == at else pa.array([None if t is None else len(t) for t in new], b.column(i).type) if i in counts else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, docs.schema)


def _whole_characters(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without the parts of characters at their ends."""
    s, e = starts.copy(), ends.copy()
    for i in range(len(s)):
        while s[i] < e[i] and text[s[i]] & 0xC0 == 0x80:
            s[i] += 1
        while s[i] < e[i] < len(text) and text[e[i]] & 0xC0 == 0x80:
            e[i] -= 1
    return s, e


def brute_force(rows: list[tuple[int, str]], size: int = SIZE) -> dict[int, tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each document, straight from the definition; for tests."""
    texts = {i: (t or "").encode() for i, t in rows}
    seen: set[bytes] = set()
    out = {}
    for i in sorted(texts):
        t = texts[i]
        starts = []
        for a in range(len(t) - size + 1):
            if t[a : a + size] in seen:
                starts.append(a)
            else:
                seen.add(t[a : a + size])
        s = np.array(starts, np.int64)
        s, e = runs(s, s + size)
        out[i] = (len(t), int((e - s).sum()), len(s), hashlib.sha256(remove(t, s, e)).hexdigest())
    return out
