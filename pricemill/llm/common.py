"""What several corpus operators share: reading tables, stored intermediate results, row keys, packing, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.session import shared_folder

#: Stands for a null id in comparisons; it is smaller than any other.
NO_ID = -(2**63)
#: Setting for the bytes of an Arrow batch, and what operators that send whole texts to Python put there.
BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """df written once to the folder in spark.checkpoint.dir and read from there, so that a lost executor costs no
    recomputation. A session without that setting (tests) gets a folder of its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session by BATCH bytes. Spark's own bound of 64 MB is held several times over by
    the JVM and by Python, for each running task. A bound that the session has been given stays; this one stays set, as
    frames are computed after the operator has returned."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(BATCH))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, text): id is never null (NO_ID instead), text never null; tag tells rows that share an id apart."""
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def unkeyed(col: str | Column = "id") -> Column:
    """The id as it was given."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NO_ID, c)


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([pack(t) for t in bytes_of(b.column(2))], pa.binary())], ["id", "tag", "text"])


def packed(texts: DataFrame) -> DataFrame:
    """Keyed texts compressed one by one, for a shuffle that carries them whole."""
    return texts.mapInArrow(_packed, "id long, tag long, text binary")


def unpacked(column: pa.Array) -> list[bytes]:
    return [zstandard.decompress(x) for x in column.to_pylist()]


def runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal disjoint ones, in order; touching ones merge."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([first[1:], [True]])
    return s[first], e[last]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v: long); root is the smallest node that can be reached.

    In every round each tree of nodes with one root hangs itself below the smallest root among its neighbours, then
    nodes jump to the root of their root, so the number of rounds grows with the logarithm of the longest chain. The
    labels are stored after each round; a hub's edges are aggregated before they move, and joins on a hub can be split.
    """
    both = stored(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("root")))
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("node").alias("v"), F.col("root").alias("m")), "v").groupBy(F.col("u").alias("node")).agg(F.min("m").alias("m"))
        # Stored, so that the join by root has plain exchanges on both sides and a large component can be split.
        lower = stored(labels.join(seen, "node").where("m < root").groupBy("root").agg(F.min("m").alias("to")))
        hung = stored(labels.join(lower, "root", "left").select("node", F.coalesce("to", "root").alias("root"), F.col("root").alias("was")))
        above = hung.select(F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = stored(hung.join(above, "root").select("node", F.least("root", "far").alias("root"), "was"))
        changed = jumped.where("root <> was").limit(1).count()
        labels = jumped.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle within {rounds} rounds")


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most size rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
