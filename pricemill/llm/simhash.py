"""SimHash near-duplicates by deletion variants.

Two 64-bit fingerprints that differ in at most two bits are cut into two halves; one half then differs in at most
one bit. Each distinct fingerprint is indexed under 64 keys: a half with one of its 32 bits left out. Fingerprints
that meet under a key are verified on all 64 bits. Links between distinct fingerprints make components; copies of
one fingerprint are one node, so groups of copies never meet row by row.

A key under which more than `crowd` fingerprints meet is not compared pair by pair. All of them agree on 31 bits, so
the remaining 33 bits are indexed once more with two of them left out: members of such a second bucket differ in at
most these two bits, hence each is linked and a star around the smallest says the same as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import bytes_of, components, partitions, stored

BITS, HALF, SEED, SHINGLE = 64, 32, 42, 3
#: Largest bucket that is compared pair by pair.
CROWD = 512


def simhash(text: bytes) -> int:
    """Fingerprint of a text as a signed 64-bit number; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [h(b" ".join(words), SEED)]
    else:
        hashes = [h(b"%b %b %b" % s, SEED) for s in zip(words, words[1:], words[2:])]
    values = np.array(hashes, np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(values), 1 << 16):
        part = np.ascontiguousarray(values[i : i + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([simhash(t) for t in bytes_of(b.column(1))], pa.int64()), *b.columns[2:]], ["id", "fp", *b.schema.names[2:]])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for every row."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints, "id long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): 64 keys each, the number of the bit left out above the half without that bit."""
    half = lambda i: F.col("fp") if i < HALF else F.shiftrightunsigned("fp", HALF)
    keys = [half(i).bitwiseAND(F.lit(0xFFFFFFFF & ~(1 << i % HALF))).bitwiseOR(F.lit(i << HALF)) for i in range(BITS)]
    # Stored fingerprints lie in few large partitions; 64 times the rows come out.
    dealt = fps.repartition(partitions(fps.sparkSession), "fp")
    return dealt.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(u, v) between distinct fingerprints fps.fp; same components as all pairs within two bits."""
    index = variants(fps)
    sizes = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # Spark sizes the index by the fingerprints before their variants, 64 times too low for a broadcast.
    met = stored(index.join(sizes.hint("merge"), "key"))
    few = met.where(F.col("n") <= crowd).select("key", "fp")
    pairs = (
        few.select("key", F.col("fp").alias("u"))
        .join(few.select("key", F.col("fp").alias("v")), "key")
        .where((F.col("u") < F.col("v")) & (_differ("u", "v") <= 2))
        .select("u", "v")
    )
    if not sizes_over(met, crowd):
        return pairs.distinct()
    many = met.where(F.col("n") > crowd).select("key", "fp")
    # The other half and the bit left out: 33 bits.
    left_out = F.shiftrightunsigned("key", HALF)
    other = F.when(left_out < HALF, F.shiftrightunsigned("fp", HALF)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    bit = F.expr(f"shiftrightunsigned(fp, cast(shiftrightunsigned(key, {HALF}) as int)) & 1L")
    rest = F.shiftleft(bit, HALF).bitwiseOR(other)
    two = [(i, j) for i in range(HALF + 1) for j in range(i + 1, HALF + 1)]
    masks = F.lit([1 << i | 1 << j for i, j in two])
    second = many.withColumn("rest", rest).select("key", "fp", "rest", F.explode(masks).alias("mask")).select("key", "fp", "mask", F.expr("rest & ~mask").alias("sub"))
    by = ["key", "mask", "sub"]
    centre = second.groupBy(*by).agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = second.join(centre, by).where("u <> fp").select("u", F.col("fp").alias("v"))
    return pairs.union(stars).distinct()


def sizes_over(met: DataFrame, crowd: int) -> bool:
    return met.where(F.col("n") > crowd).limit(1).count() > 0


def _rooted(nodes: DataFrame) -> DataFrame:
    """nodes, one for each fingerprint fp, with the root of its component."""
    roots = components(links(nodes.select("fp")))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row; component_id is the smallest id whose fingerprint can be reached over links.

    Null and empty texts have fingerprint zero and link like any other. Rows with a null id take part and get their
    component, but name it only if the component has no other id. Repeated rows give repeated rows. An empty table
    gives no rows. Texts are read whole, however long, and other columns are not looked at, whatever their names.
    """
    marked = stored(fingerprints(docs, id_col, text_col))
    nodes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")))
    rooted = _rooted(nodes)
    # Stored, so that both sides of the joins are plain exchanges, and a large component or a fingerprint with many
    # copies can be split.
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    by_fp = stored(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"))
    return marked.join(by_fp, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, all columns: the one with the smallest id, and among rows that share it the one
    with the smallest hash of its text. A null id is larger than any other. Of rows that repeat id and text, one. Null and empty
    texts are one component; an empty table stays empty."""
    tag = F.xxhash64(F.col("text").isNull(), F.col("text"))
    marked = docs.select(F.col("doc_id").cast("long").alias("id"), "text", tag.alias("tag")).mapInArrow(_fingerprints, "id long, fp long, tag long")
    nodes = stored(marked.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "tag")).alias("least")))
    first = _rooted(nodes).groupBy("root").agg(F.min("least").alias("least"))
    kept = first.select(F.col("least.id").alias("kept_id"), F.col("least.tag").alias("kept_tag"))
    # The given columns travel as one, whatever their names.
    given = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), tag.alias("tag"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("tag") == F.col("kept_tag"))
    return given.join(kept, same, "left_semi").dropDuplicates(["id", "tag"]).select("row.*")
