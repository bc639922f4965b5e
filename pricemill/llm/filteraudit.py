"""How document filters interact: who removes what in every order, from one pass over the documents.

Each document becomes a truth-table word of 32 bits, one for each subset of the five filters: bit S is set if the
document survives every filter of S. Words are never kept: tasks count them by position with a tree of carry-save
adders, per part and label, and Spark adds up the counts. Survivors per subset answer every question about orders:
what a filter removes after others is a difference of two of the 32 counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import stored

FILTERS = "ABCDE"
SUBSETS = 2 ** len(FILTERS)
#: Planes up to this length are counted bit by bit; longer ones pass through adders first.
SHORT = 64

_WORD = r"[^\x20\x09-\x0D]+"


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails each of the filters that look at one document alone: A to D."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def survival_word(failed: int) -> int:
    """The word of a document that fails the filters in the mask `failed`."""
    return sum(1 << s for s in range(SUBSETS) if not s & failed)


_WORDS = np.array([survival_word(f) for f in range(SUBSETS)], np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """For each of the 32 positions, how many words have that bit: carry-save adders fold three planes of one weight
    into one of the same weight and one of twice the weight, until few words are left at each weight."""
    totals = np.zeros(32, np.int64)
    plane, weight = words.astype(np.uint32), 1
    while len(plane):
        carries = []
        while len(plane) > SHORT:
            n = len(plane) // 3
            a, b, c, rest = plane[:n], plane[n : 2 * n], plane[2 * n : 3 * n], plane[3 * n :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            plane = np.concatenate([half ^ c, rest])
        totals += weight * ((plane[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(axis=0, dtype=np.int64)
        plane, weight = np.concatenate(carries) if carries else plane[:0], 2 * weight
    return totals


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "kind", *(f"s{s}" for s in range(SUBSETS))]
    for b in batches:
        part = b.column(0).dictionary_encode()
        group = part.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + b.column(1).to_numpy(zero_copy_only=False)
        words = _WORDS[b.column(2).to_numpy(zero_copy_only=False)]
        order = np.argsort(group, kind="stable")
        cuts = np.nonzero(np.diff(group[order]))[0] + 1
        groups = [g for g in np.split(order, cuts) if len(g)]
        if not groups:
            continue
        counts = np.array([positional_counts(words[g]) for g in groups])
        first = [int(g[0]) for g in groups]
        columns = [b.column(0).take(pa.array(first)).cast(pa.string()), pa.array([int(group[i]) % 4 for i in first], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(counts[:, s], pa.int64()) for s in range(SUBSETS)], names)


def marked(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, kind, failed) of every document: kind has bit 0 if it is good and bit 1 if it is toxic, failed is the
    mask of the filters it fails."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = F.lit(0)
    for i, name in enumerate(FILTERS[:4]):
        mask = mask + F.when(failures(F.col("text"))[name], 1 << i).otherwise(0)
    # Digests of 256 bits stand for texts, so that whole texts are not shuffled.
    seen = stored(
        docs.select(
            F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")
        ).select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    )
    # Only texts that occur more than once, and the labels by document, are joined; stored, so that the join of a text
    # with a third of all rows can be split.
    firsts = stored(seen.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    kinds = stored(
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg((F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).alias("kind"))
    )
    late = F.when(F.col("first") < F.col("id"), 1 << 4).otherwise(0)
    found = seen.join(firsts, "digest", "left").select("id", "part", (F.col("mask") + late).cast("int").alias("failed"))
    return found.join(kinds, "id", "left").select("part", F.coalesce("kind", F.lit(0)).cast("int").alias("kind"), "failed")


def survivors(found: DataFrame) -> DataFrame:
    """(part, all, good, toxic): counts of the survivors of each subset, as arrays by mask, per part."""
    names = [f"s{s}" for s in range(SUBSETS)]
    partial = found.mapInArrow(_counted, "part string, kind int, " + ", ".join(f"{n} long" for n in names))
    bit = {"all": F.lit(True), "good": F.col("kind").bitwiseAND(1) > 0, "toxic": F.col("kind").bitwiseAND(2) > 0}
    sums = [F.sum(F.when(of, F.col(n)).otherwise(0)).alias(f"{k}_{n}") for k, of in bit.items() for n in names]
    return partial.groupBy("part").agg(*sums).select("part", *[F.array(*[f"{k}_{n}" for n in names]).alias(k) for k in bit])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows
    for each part, one for each step of each order of the filters A to E.

    Every row of docs is a document; whole texts are read, however long. A null text is empty, a null part the empty
    string. Filter E compares ids: a row without an id fails it never and makes no other fail it, and of rows that
    repeat the smallest id of a text none does. Rows that repeat an id of labels are good or toxic if any of them is;
    documents without labels or without an id are neither. Other columns are not looked at, whatever their names. An empty table gives
    no rows.
    """
    counts = survivors(marked(docs, labels, id_col, text_col, part_col))
    orders = ",".join("'" + "".join(p) + "'" for p in permutations(FILTERS))
    bits = f"transform(sequence(1, step), i -> shiftleft(1, ascii(substr(filter_order, i, 1)) - ascii('A')))"
    steps = (
        counts.select("*", F.explode(F.expr(f"array({orders})")).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .withColumn("after", F.expr(f"aggregate({bits}, 0, (a, b) -> a | b)"))
        .withColumn("own", F.expr("shiftleft(1, ascii(substr(filter_order, step, 1)) - ascii('A'))"))
        .withColumn("before", F.expr("after - own"))
    )

    def at(kind: str, mask: str) -> Column:
        return F.expr(f"element_at({kind}, ({mask}) + 1)")

    everyone = SUBSETS - 1
    return steps.select(
        "part",
        "filter_order",
        "step",
        at("all", "after").alias("kept"),
        (at("all", "before") - at("all", "after")).alias("removed"),
        (at("all", "0") - at("all", "own") - at("all", "before") + at("all", "after")).alias("redundant"),
        (at("all", f"{everyone} - own") - at("all", str(everyone))).alias("unique_fails"),
        (at("good", "before") - at("good", "after")).alias("good_lost"),
        (at("toxic", "before") - at("toxic", "after")).alias("toxic_lost"),
        "own",
    ).select("*", F.sum("removed").over(Window.partitionBy("part", "own")).alias("shapley")).drop("own")
