"""Exact top-k inner products over an impact-ordered index, score at a time.

The index is cut into blocks of vectors. In a block each non-zero component is a posting (vector, dimension, value),
and postings are kept in segments by their quantised impact, the size of the value, in descending order. The blocks
are stored with their postings in that order. A batch of queries meets a block segment by segment: each segment adds
its postings to the partial scores. What the segments not yet read can still add to a vector's score is at most the
product of two norms (Cauchy-Schwarz), both over the vector's unread dimensions: the query's and the vector's own. A
vector that no query can want any more is left out of the segments that follow. Once the k-th best lower bound proves
that few vectors can still be members, reading stops and these are scored again from their whole integer vectors.
Without such a proof all segments are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import stored

#: Vectors in an index block and queries in a batch.
BLOCK, BATCH = 8192, 512
#: Impacts are quantised into so many equal steps of a block's largest one.
LEVELS = 16
#: Possible members per query at which reading stops.
FEW = 4
#: So many queries of a batch tell, after each segment, whether the bounds of all are worth their computation: not as long
#: as these want more than the share HOPE of the vectors.
PROBES, HOPE = 16, 0.5
SCALE = 256.0


def components_of(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v: array<long>), each component floor(256 x); rows without a whole finite vector or an id are left out."""
    v = F.col("raw")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("raw"))
        .where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
        .select("id", F.transform(v, lambda x: F.floor(x * SCALE)).alias("v"))
    )


_PACKED = "group int, ids binary, dims int, cells binary, postings binary, ends binary"


def _pack(indexed: bool):
    def pack(pdf):
        import pandas as pd

        n = max((len(v) for v in pdf["v"]), default=0)
        cells = np.zeros((len(pdf), n), "<i8")
        for i, v in enumerate(pdf["v"]):
            cells[i, : len(v)] = v
        order = np.argsort(pdf["id"].to_numpy(), kind="stable")
        ids, cells = pdf["id"].to_numpy().astype("<i8")[order], cells[order]
        postings, ends = segments(cells) if indexed else (np.zeros(0, "<u4"), np.zeros(0, "<i8"))
        row = {"group": int(pdf["group"].iloc[0]), "ids": ids.tobytes(), "dims": n, "cells": cells.tobytes()}
        return pd.DataFrame([row | {"postings": postings.tobytes(), "ends": ends.tobytes()}])

    return pack


def packed(rows: DataFrame, groups: int, indexed: bool) -> DataFrame:
    """Rows (id, v) in so many groups, each one row; places of stored rows decide, so that repeated rows spread as well.
    An indexed group has its postings in descending order of impact."""
    spread = rows.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    return spread.groupBy("group").applyInPandas(_pack(indexed), _PACKED)


def _unpack(ids: bytes, dims: int, cells: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(cells, "<i8").reshape(len(ids), dims)


def segments(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the non-zero cells by descending quantised impact, and where each level's segment ends."""
    size = np.abs(cells).astype(np.float64).reshape(-1)
    top = size.max(initial=0.0)
    if not top:
        return np.zeros(0, "<u4"), np.zeros(LEVELS, "<i8")
    level = np.minimum((size / top * LEVELS).astype(np.int64), LEVELS - 1)
    at = np.flatnonzero(size > 0)
    order = np.argsort(-level[at], kind="stable")
    counts = np.bincount(LEVELS - 1 - level[at], minlength=LEVELS)
    return at[order].astype("<u4"), np.cumsum(counts).astype("<i8")


def best_in_block(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, index: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[list[tuple[int, int, int]], float]:
    """The k best of the block for each query, ties to the smaller id, as (query, vector, score); and the share of the
    block's postings that were read for it."""
    dims = max(q.shape[1], v.shape[1])
    postings, ends = segments(v) if index is None else index
    width = max(v.shape[1], 1)
    q, v = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, v))
    qf = q.astype(np.float64)
    exact = float(np.abs(qf).max(initial=0.0)) * float(np.abs(v).max(initial=0)) * max(dims, 1) < 2**53
    own = q_ids[:, None] == ids[None, :]
    members = ~own
    alive = np.arange(len(v))  # vectors that some query can still want
    place = np.arange(len(v))
    scores = np.zeros((len(q), len(v)))
    rest = v.astype(np.float64)
    added = rest.copy()  # what was not read when the scores were last added to
    some = np.arange(0, len(q), max(1, len(q) // PROBES))
    begin, read = 0, 0 if exact else len(postings)

    def bounds(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of these queries with all that is read, and which vectors they can still want."""
        now = scores[at] + qf[at] @ (added - rest).T
        slack = np.sqrt((qf[at] ** 2) @ (rest != 0).T) * np.sqrt((rest**2).sum(axis=1))
        hidden = own[np.ix_(at, alive)]
        low = np.where(hidden, -np.inf, now - slack)
        kth = -np.partition(-low, k - 1, axis=1)[:, k - 1]
        # A relative margin covers the rounding of the square roots.
        return now, ~hidden & (now + slack >= kth[:, None] - 1e-6 * (1 + np.abs(kth[:, None])))

    for end in ends.tolist() if exact else ():
        if begin == end:
            continue
        rows, cols = np.divmod(postings[begin:end].astype(np.int64), width)
        kept = place[rows] >= 0
        rows, cols, begin = place[rows[kept]], cols[kept], end
        read += len(rows)
        rest[rows, cols] = 0
        if len(alive) <= k or end < len(postings) and bounds(some)[1].mean() > HOPE:
            continue
        scores, wanted = bounds(np.arange(len(q)))
        added = rest.copy()
        members = np.zeros_like(own)
        members[:, alive] = wanted
        left = wanted.any(axis=0)
        if wanted.sum() <= FEW * k * len(q):
            break
        if not left.all():
            alive, scores, rest, added = alive[left], scores[:, left], rest[left], added[left]
            place = np.full(len(v), -1)
            place[alive] = np.arange(len(alive))
    out = []
    for i in range(len(q)):
        at = np.nonzero(members[i])[0]
        if exact:
            true = v[at] @ q[i]
        else:
            true = np.array([sum(int(a) * int(b) for a, b in zip(v[j], q[i])) for j in at], object)
        order = sorted(zip((-true).tolist(), ids[at].tolist()))[:k] if len(at) <= 64 * k else _top(true, ids[at], k)
        out += [(int(q_ids[i]), int(j), int(-s)) for s, j in order]
    return out, read / max(len(postings), 1)


def _top(true: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    kth = np.sort(true)[-k]
    at = true >= kth
    return sorted(zip((-true[at]).tolist(), ids[at].tolist()))[:k]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                index = np.frombuffer(r["postings"], "<u4"), np.frombuffer(r["ends"], "<i8")
                found, _ = best_in_block(*_unpack(r["q_ids"], r["q_dims"], r["q_cells"]), *_unpack(r["ids"], r["dims"], r["cells"]), k, index)
                q, v, s = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by `every`, the k best others.

    Vectors that are null, hold null or non-finite components, or have no id take no part; shorter vectors count as
    filled with zeros. Ties go to the smaller id. Repeated rows are candidates each on their own, but no row with the
    query's id is one, and a repeated query answers once. Fewer candidates than k give fewer rows; an empty table none.
    Other columns are not looked at, whatever their names.
    """
    rows = stored(components_of(vectors, id_col, vec_col))
    asking = rows.where(F.col("id") % every == 0).dropDuplicates(["id"])
    sizes = rows.agg(F.count("*").alias("all"), F.sum((F.col("id") % every == 0).cast("int")).alias("asking")).first()
    blocks = max(1, -(-sizes.all // BLOCK))
    index = stored(packed(rows, blocks, True))
    batches = packed(stored(asking), max(1, -(-(sizes.asking or 0) // BATCH)), False).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("group"),
        F.col("ids").alias("q_ids"),
        F.col("dims").alias("q_dims"),
        F.col("cells").alias("q_cells"),
    )
    # Spark sizes the batches by the rows before they were packed and copied to every block, far too low for a broadcast.
    found = batches.join(index.hint("merge"), "group").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
