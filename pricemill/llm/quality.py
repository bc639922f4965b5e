"""Quality classifier: gradient-boosted trees over histograms of document statistics.

The trees are fitted with numpy on a bounded sample of labelled documents; all trees lie in flat arrays, and a batch
of documents walks down them together, one level of one tree per numpy step.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import bytes_of

#: Labelled documents used for fitting, those with the smallest hash of their id.
SAMPLE = 16_000
BINS, DEPTH, TREES, RATE, RIDGE, LEAF = 64, 5, 80, 0.15, 1.0, 10
#: Score from which a document is taken as good.
THRESHOLD = 0.7

_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "beyond": range(128, 256),
    "space": b" ",
    "line": b"\n",
    "stop": b".,;:'\"-()",
    "loud": b"!?",
    "sign": b"#$%&*+=<>@^~_\\/",
    "bar": b"|[]{}",
    "control": [*range(9), *range(11, 32), 127],
}
_IS = np.array([[c in set(v) for c in range(256)] for v in _CLASSES.values()], np.float64).T


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text; all zero for an empty one but for the counts."""
    words, lines = text.split(), text.split(b"\n")
    n, w = max(len(text), 1), max(len(words), 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts[counts > 0] / n
    often = Counter(words)
    most = often.most_common(3)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    three = max(len(words) - 2, 1)
    sentences = max(counts[46] + counts[33] + counts[63], 1)
    return [
        *(counts @ _IS / n).tolist(),
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        float(-(share * np.log2(share)).sum()) if len(text) else 0.0,
        float(sizes.mean()),
        float(sizes.std()),
        float(sizes.max()),
        float((sizes <= 3).mean()),
        len(often) / w,
        most[0][1] / w if most else 0.0,
        sum(c for _, c in most) / w,
        len(set(zip(words, words[1:], words[2:]))) / three,
        len(set(lines)) / len(lines),
        len(text) / len(lines),
        w / sentences,
        sum(map(bytes.isupper, often)) / max(len(often), 1),
        text.count(b"http") / w,
        text.count(b"...") / w,
    ]


@dataclass
class Trees:
    """Nodes of tree t start at t * size; children of node i are 2 i + 1 and 2 i + 2; a leaf has feature -1."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def score(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.binned(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.bin, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                down = 2 * node + 1 + (b[rows, np.maximum(f, 0)] > cut[node])
                node = np.where(f >= 0, down, node)
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the log loss, each split chosen on histograms of gradients and curvatures."""
    n, n_features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) if n else np.zeros(0) for f in range(n_features)]
    rate = np.clip(y.mean() if n else 0.5, 0.01, 0.99)
    size = 2 ** (DEPTH + 1) - 1
    out = Trees(edges, float(np.log(rate / (1 - rate))), np.full((TREES, size), -1, np.int16), np.zeros((TREES, size), np.int16), np.zeros((TREES, size)))
    b = out.binned(x)
    total = np.full(n, out.base)
    for t in range(TREES if n else 0):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH + 1):
            first, width = 2**level - 1, 2**level
            alive = node >= first
            at = node[alive] - first
            sum_g, sum_h = np.bincount(at, g[alive], width), np.bincount(at, h[alive], width)
            out.value[t, first : first + width] = -RATE * sum_g / (sum_h + RIDGE)
            if level == DEPTH:
                break
            best, which, where = np.full(width, 1e-6), np.full(width, -1), np.zeros(width, np.int64)
            for f in range(n_features):
                key = at * BINS + b[alive, f]
                left_g, left_h, left_n = (np.cumsum(np.bincount(key, v, width * BINS).reshape(width, BINS), axis=1) for v in (g[alive], h[alive], None))
                right_g, right_h, right_n = sum_g[:, None] - left_g, sum_h[:, None] - left_h, left_n[:, -1:] - left_n
                gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - (sum_g**2 / (sum_h + RIDGE))[:, None]
                gain[(left_n < LEAF) | (right_n < LEAF)] = -1
                cut = gain.argmax(axis=1)
                most = gain[np.arange(width), cut]
                better = most > best
                best[better], which[better], where[better] = most[better], f, cut[better]
            out.feature[t, first : first + width], out.bin[t, first : first + width] = which, where
            split = np.flatnonzero(alive)
            f = which[at]
            goes = f >= 0
            split, f = split[goes], f[goes]
            node[split] = 2 * node[split] + 1 + (b[split, f] > where[at[goes]])
        total += out.value[t, node]
    return out


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([statistics(t) for t in bytes_of(b.column(2))], pa.list_(pa.float64()))], ["h", "label", "x"])


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Trees:
    """Fitted on at most `sample` labelled documents that are not held out. Null labels and ids are left out; an id with
    several labels counts with the largest, and one with several texts with that of the smallest statistics; without
    any label every score is 0.5. Texts are measured whole, however long."""
    known = labels.where(~held_out(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    n = known.count()
    # The hash is uniform: a little more than the wanted share is all but sure to hold enough ids.
    bound = -(2**63) + min(int(min(1.0, 1.1 * sample / max(n, 1)) * 2**64), 2**64 - 1)
    hashed = known.withColumn("h", F.xxhash64("id")).where(F.col("h") <= bound)
    chosen = F.broadcast(hashed.orderBy("h").limit(sample))  # at most so many rows of three numbers
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select("h", "label", "text")
    measured = texts.mapInArrow(_measure, "h long, label double, x array<double>").groupBy("h", "label").agg(F.min("x").alias("x"))
    rows = sorted(measured.collect(), key=lambda r: r.h)  # one for each sampled id
    width = len(statistics(b""))
    return fit(np.array([r.x for r in rows], np.float64).reshape(-1, width), np.array([min(max(r.label, 0.0), 1.0) for r in rows]))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, from the whole text.

    Null counts as empty and both are scored like any text. Repeated rows give repeated rows, rows with a null id count
    as not held out, an empty table gives no rows. Other columns are not looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = trees.score(np.array([statistics(t) for t in bytes_of(b.column(2))], np.float64).reshape(b.num_rows, -1)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return given.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, all columns. Null and empty texts are scored like any other,
    repeated rows each, and an empty table stays empty."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([statistics(t) for t in bytes_of(b.column(at))], np.float64)
                yield b.filter(pa.array(trees.score(x) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
