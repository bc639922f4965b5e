"""Hard negatives by lists shared within clusters of anchors, walked until nothing better can follow.

Anchors are grouped around centroids, and a cluster's members differ from their centroid by at most an angle t. For
a candidate at an angle a from the centroid no member can score more than the product of the two lengths and
cos(max(0, a - t)). In every block of candidates this bound is computed and sorted once for a cluster, and all its
members walk the one list; a member stops as soon as the bound of what follows is below everything it still lacks.
The first walk finds the positives of every anchor, the second the negatives below each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import batched, stored

#: Candidates in a block, anchors that walk together, steps of a list that are taken at once.
BLOCK, BATCH, STRIDE = 8192, 256, 512
#: Centroids at most, and anchors they are fitted on at most, chosen by a hash of the id.
CLUSTERS, SAMPLE = 32, 2048
SCALE = 256.0


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, v: array<long>) of the rows that have an id, a label and a whole finite vector."""
    picked = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = picked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    return whole.select("id", "label", F.transform("raw", lambda x: F.floor(x * SCALE)).alias("v"))


def centroids(vectors: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Directions of so many groups of vectors: k-means on the sphere, started from vectors that lie far apart."""
    length = np.linalg.norm(vectors, axis=1)
    unit = vectors[length > 0] / length[length > 0, None]
    if not len(unit):
        return np.zeros((1, vectors.shape[1]))
    centres = unit[:1]
    nearest = unit @ centres[0]
    while len(centres) < min(clusters, len(unit)):
        centres = np.vstack([centres, unit[np.argmin(nearest)]])
        nearest = np.maximum(nearest, unit @ centres[-1])
    for _ in range(rounds):
        of = np.argmax(unit @ centres.T, axis=1)
        sums = np.array([unit[of == c].sum(axis=0) for c in range(len(centres))])
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def fitted_to(m: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, dims - m.shape[1]))) if m.shape[1] < dims else m[:, :dims]


def matrix(rows: list) -> np.ndarray:
    """Integer vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def angles(v: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and angles from a direction; a vector without length lies at no angle."""
    length = np.linalg.norm(v, axis=1)
    cos = np.divide(v @ centre, length, out=np.ones(len(v)), where=length > 0)
    return length, np.arccos(np.clip(cos, -1, 1))


class Listed:
    """A block's candidates in descending order of the bound for one cluster's members."""

    def __init__(self, v: np.ndarray, centre: np.ndarray, widest: float):
        length, angle = angles(v, centre)
        bound = length * np.cos(np.maximum(0.0, angle - widest))
        self.order = np.argsort(-bound, kind="stable")
        # Rounding of angles must not end a walk early.
        self.bound = bound[self.order] + 2e-6 * length.max(initial=0.0)


def walk(q: np.ndarray, listed: Listed, v: np.ndarray, allowed, low: np.ndarray, high: np.ndarray, k: int) -> tuple[dict, int]:
    """The k best candidates of a block for every member and window of scores.

    allowed(members, candidates) tells which pairs count; low and high hold the windows, a row for each member, and
    only scores inside count. Returns {(member, window): [(position, score), ...]} with all ties of the k-th score,
    and how many scores were computed.
    """
    length = np.linalg.norm(q, axis=1)
    best = np.full((*low.shape, k), -np.inf)
    kept: dict = {}
    alive, scored = np.arange(len(q)), 0
    for at in range(0, len(v), STRIDE):
        # What a window still lacks: more than its k-th score so far, and at least its lower end.
        least = np.maximum(best[alive].min(axis=2), low[alive])
        unsettled = length[alive, None] * listed.bound[at] >= least
        alive = alive[(unsettled & (low[alive] <= high[alive])).any(axis=1)]
        if not len(alive):
            break
        here = listed.order[at : at + STRIDE]
        scores = q[alive] @ v[here].T
        scored += scores.size
        ok = allowed(alive, here)
        for w in range(low.shape[1]):
            inside = np.where(ok & (scores >= low[alive, w, None]) & (scores <= high[alive, w, None]), scores, -np.inf)
            both = np.concatenate([best[alive, w], inside], axis=1)
            best[alive, w] = -np.partition(-both, k - 1, axis=1)[:, :k]
            rows, cols = np.nonzero((inside >= best[alive, w].min(axis=1)[:, None]) & (inside > -np.inf))
            for i, j in zip(rows.tolist(), cols.tolist()):
                kept.setdefault((int(alive[i]), w), []).append((int(here[j]), scores[i, j]))
    return {key: [(j, s) for j, s in found if s >= best[key].min()] for key, found in kept.items()}, scored


def plainly(q, v, allowed, windows, k) -> dict:
    """The same in whole numbers of any size, for components whose products do not fit a double."""
    out: dict = {}
    every = np.arange(len(v))
    for i in range(len(q)):
        ok = np.nonzero(allowed(np.array([i]), every)[0])[0]
        scores = [(int(j), sum(int(a) * int(b) for a, b in zip(q[i], v[j]))) for j in ok]
        for w, (low, high) in enumerate(windows[i]):
            inside = sorted((s for _, s in scores if (low is None or s >= low) and (high is None or s <= high)), reverse=True)
            if inside:
                least = inside[min(k, len(inside)) - 1]
                out[i, w] = [(j, s) for j, s in scores if s >= least and (high is None or s <= high)]
    return out


_CELLS = "ids binary, labels binary, dims int, cells binary"
_OUT = "anchor_id long, mark int, other_id long, score long"


def _cells(pdf) -> dict:
    m = matrix(list(pdf["v"]))
    return {"ids": pdf["id"].to_numpy().astype("<i8").tobytes(), "labels": pdf["label"].to_numpy().astype("<i8").tobytes(), "dims": m.shape[1], "cells": m.astype("<i8").tobytes()}


def _read(r: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(r[prefix + "ids"], "<i8")
    return ids, np.frombuffer(r[prefix + "labels"], "<i8"), np.frombuffer(r[prefix + "cells"], "<i8").reshape(len(ids), r[prefix + "dims"])


def blocks_of(rows: DataFrame, blocks: int) -> DataFrame:
    """Candidates (id, label, v) in so many rows; places of stored rows decide, so that repeated rows spread as well."""

    def pack(pdf):
        import pandas as pd

        return pd.DataFrame([{"block": int(pdf["block"].iloc[0])} | _cells(pdf)])

    spread = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    return stored(spread.groupBy("block").applyInPandas(pack, f"block int, {_CELLS}"))


def batches_of(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Anchors (id, label, v, marks) in rows of one cluster each, with the cluster's widest angle; marks are the scores of
    an anchor's positives."""

    def cluster(pdfs):
        for pdf in pdfs:
            m = matrix(list(pdf["v"])).astype(np.float64)
            near = np.argmax(fitted_to(m, centres.shape[1]) @ centres.T, axis=1)
            # Dimensions that no centroid has widen the angle.
            wide = fitted_to(centres, max(m.shape[1], centres.shape[1]))
            m = fitted_to(m, wide.shape[1])
            angle = np.array([angles(m[i : i + 1], wide[c])[1][0] for i, c in enumerate(near)])
            yield pdf.assign(cluster=near.astype(np.int32), angle=angle.astype(np.float64))

    def pack(pdf):
        import pandas as pd

        marks = [[int(s) for s in x] for x in pdf["marks"]]
        return pd.DataFrame([{"cluster": int(pdf["cluster"].iloc[0]), "widest": float(pdf["widest"].iloc[0]), "marks": marks} | _cells(pdf)])

    found = stored(anchors.mapInPandas(cluster, "id long, label long, v array<bigint>, marks array<bigint>, cluster int, angle double"))
    # A row for each centroid.
    clusters = found.groupBy("cluster").agg(F.count("*").alias("n"), F.max("angle").alias("widest")).collect()
    parts: Column = F.lit(1)
    widest: Column = F.lit(0.0)
    for r in clusters:
        of = F.col("cluster") == r.cluster
        parts, widest = F.when(of, -(-r.n // BATCH)).otherwise(parts), F.when(of, r.widest).otherwise(widest)
    split = found.withColumns({"part": F.pmod(F.xxhash64("id"), parts).cast("int"), "widest": widest})
    return split.groupBy("cluster", "part").applyInPandas(pack, f"cluster int, widest double, marks array<array<bigint>>, {_CELLS}")


def _searcher(centres: np.ndarray, same: bool, k: int, low: int, high: int):
    """Walks of joined rows (batch, block); windows are those below the marks, or all scores for positives."""
    # The lists of the block at hand, one for each cluster, shared by all its batches.
    lists: dict = {"block": None}

    def list_of(r: dict, v: np.ndarray, centre: np.ndarray) -> Listed:
        if lists["block"] != r["block"]:
            lists.clear()
            lists["block"] = r["block"]
        key = r["q_cluster"], v.shape[1]
        if key not in lists:
            lists[key] = Listed(v, centre, r["q_widest"])
        return lists[key]

    def found(r: dict) -> Iterator[tuple]:
        q_ids, q_labels, q = _read(r, "q_")
        ids, labels, v = _read(r)
        dims = max(q.shape[1], v.shape[1], 1)
        q, v = fitted_to(q, dims), fitted_to(v, dims)

        def allowed(members, candidates):
            equal = q_labels[members, None] == labels[None, candidates]
            return (equal if same else ~equal) & (q_ids[members, None] != ids[None, candidates])

        if same:
            windows = [[(None, None)]] * len(q)
        else:
            windows = [[(-(-low * s // 100), high * s // 100) for s in marks] for marks in r["q_marks"]]
        largest = max(int(np.abs(q).max(initial=0)), 1) * max(int(np.abs(v).max(initial=0)), 1) * dims
        if largest < 2**52:
            width = max((len(w) for w in windows), default=1) or 1
            lows, highs = np.full((len(q), width), np.inf), np.full((len(q), width), -np.inf)
            for i, row in enumerate(windows):
                for w, (a, b) in enumerate(row):
                    lows[i, w], highs[i, w] = (-np.inf if a is None else a), (np.inf if b is None else b)
            centre = fitted_to(centres, max(dims, centres.shape[1]))[r["q_cluster"]]
            qf, vf = (fitted_to(m.astype(np.float64), len(centre)) for m in (q, v))
            hits, _ = walk(qf, list_of(r, vf, centre), vf, allowed, lows, highs, k)
        else:
            hits = plainly(q, v, allowed, windows, k)
        for (i, w), members in hits.items():
            best = sorted((-int(s), int(ids[j])) for j, s in members)[:k]
            for s, j in best:
                yield int(q_ids[i]), w + 1, j, -s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor_id", pa.int64()), ("mark", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])
        yield from batched((x for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist() for x in found(r)), schema)

    return run


def _searched(batches: DataFrame, index: DataFrame, blocks: int, run, k: int) -> DataFrame:
    """The k best of all blocks for each anchor and mark, ranked from 1."""
    columns = [F.col(c).alias(f"q_{c}") for c in ("cluster", "widest", "marks", "ids", "labels", "dims", "cells")]
    everywhere = batches.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), *columns)
    order = Window.partitionBy("anchor_id", "mark").orderBy(F.desc("score"), "other_id")
    # A merge join brings the batches of a block one after the other, so that they share its lists.
    found = everywhere.join(index.hint("merge"), "block").mapInArrow(run, _OUT)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    every: int = 50,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (id divisible by
    `every`) and each of its best rows of the same label, the best rows of other labels whose score is between low and
    high per cent of the positive's.

    Components become floor(256 x), the score is the integer inner product (it must fit a long), ties go to the smaller id. Rows without an
    id, label or whole finite vector take no part; shorter vectors count as filled with zeros. No row with the anchor's
    id is its positive or negative; of rows that repeat an anchor's id the one with the smallest label and vector asks.
    Other repeated rows count each on their own. A positive with a negative score has no window. Fewer rows than asked
    for give fewer rows, an empty table none. Other columns are not looked at, whatever their names.
    """
    rows = stored(usable(vectors, id_col, vec_col, label_col))
    asking = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v")).alias("first"))
    anchors = stored(asking.select("id", "first.label", "first.v"))
    sample = anchors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()  # at most SAMPLE vectors
    if not sample:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    centres = centroids(matrix([r.v for r in sample]).astype(np.float64), max(1, min(CLUSTERS, len(sample) // 16)))
    blocks = max(1, -(-rows.count() // BLOCK))
    index = blocks_of(rows, blocks)

    none = F.array().cast("array<bigint>")
    first = _searched(batches_of(anchors.select("*", none.alias("marks")), centres), index, blocks, _searcher(centres, True, positives, low, high), positives)
    good = stored(first.select("anchor_id", F.col("rank").alias("mark"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")))
    marks = good.groupBy(F.col("anchor_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("mark", "positive_score"))), lambda x: x["positive_score"]).alias("marks"))
    second = _searched(batches_of(anchors.join(marks, "id"), centres), index, blocks, _searcher(centres, False, negatives, low, high), negatives)
    return second.join(good, ["anchor_id", "mark"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
