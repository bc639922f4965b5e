"""Shards of nearly equal bytes by histogram sort, in DataFrame operations only.

Documents are ordered by (hash of the text, doc_id), so equal texts stand side by side and a group of copies can be
cut anywhere by id. A splitter is wanted at each b-th part of all bytes. Every round counts the exact bytes and rows
between probes that divide the ranges still holding a wanted splitter, until what lies between two probes is within
the tolerance or is a single key; then all rows move once, to their shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import NO_ID, partitions, stored

#: Bits that one round adds to the probes: 256 ranges for each open splitter.
STEP = 8
#: Part of a shard's bytes by which a splitter may miss its place.
TOLERANCE = 0.0005


def _place(counts: list, before: int, want: float) -> tuple[int, object]:
    """The range that holds the wanted place, and the bytes before it."""
    for c in counts:
        if before + c.size >= want:
            return before, c
        before += c.size
    return before - counts[-1].size, counts[-1]


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """shards - 1 keys (h, id), ascending; a row belongs right of a splitter if its key is not below it."""
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    if not total:
        return [(0, 0)] * (shards - 1)
    slack = tolerance * total / shards
    # For each open splitter: the wanted bytes, the hash if it is known, the range that holds it, the bytes before it.
    found: dict[int, tuple[int, int]] = {}
    open_: dict[int, dict] = {b: {"want": b * total / shards, "h": None, "lo": None, "hi": None, "before": 0} for b in range(1, shards)}
    while open_:
        groups: dict[tuple, list[int]] = {}
        for b, o in open_.items():
            groups.setdefault((o["h"] is not None, o["h"], o["lo"], o["hi"]), []).append(b)
        asked: dict[tuple, list] = {}
        for deep in (False, True):
            of = [g for g in groups if g[0] == deep]
            by_shift: dict[int, list[tuple]] = {}
            for g in of:
                width = 64 if g[2] is None or (g[2] < 0) != (g[3] < 0) else (g[2] ^ g[3]).bit_length()
                by_shift.setdefault(max(0, width - STEP), []).append(g)
            for shift, gs in by_shift.items():
                col = "id" if deep else "h"
                for g, counts in _ask(keys, col, gs, shift).items():
                    asked[g] = counts
        for g, bs in groups.items():
            for b in bs:
                o = open_[b]
                before, c = _place(asked[g], o["before"], o["want"])
                deep, single = g[0], c.lo == c.hi
                if c.size <= slack or single and (deep or c.id_lo == c.id_hi):
                    right = o["want"] - before < before + c.size - o["want"]  # the nearer end
                    edge = c.lo if right else c.hi + 1 if c.hi < 2**63 - 1 else None
                    if edge is None:
                        found[b] = (2**63 - 1, 2**63 - 1)
                    else:
                        found[b] = (o["h"], edge) if deep else (edge, NO_ID)
                    del open_[b]
                elif single:
                    open_[b] = o | {"h": c.lo, "lo": None, "hi": None, "before": before}
                else:
                    open_[b] = o | {"lo": c.lo, "hi": c.hi, "before": before}
    return [found[b] for b in range(1, shards)]


def _ask(keys: DataFrame, col: str, groups: list[tuple], shift: int) -> dict[tuple, list]:
    """One job for all ranges that are probed at the same distance."""
    inside = F.lit(None).cast("int")
    for i, (deep, h, lo, hi) in enumerate(groups):
        test = F.lit(True) if lo is None else F.col(col).between(lo, hi)
        if deep:
            test = test & (F.col("h") == h)
        inside = F.when(test, F.lit(i)).otherwise(inside)
    rows = (
        keys.withColumn("g", inside)
        .where("g is not null")
        .groupBy("g", F.shiftright(col, shift).alias("p"))
        .agg(F.sum("size").alias("size"), F.min(col).alias("lo"), F.max(col).alias("hi"), F.min("id").alias("id_lo"), F.max("id").alias("id_hi"))
        .collect()
    )
    out: dict[tuple, list] = {g: [] for g in groups}
    for r in sorted(rows, key=lambda r: (r.g, r.p)):
        out[groups[r.g]].append(r)
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row; law is `bytes`.

    Size is the UTF-8 length of the text plus 8; a null text has no bytes and the checksum of an empty text. A null id
    stands before all others. Rows that repeat both id and text cannot be told apart: they stay in one shard. Fewer
    rows than shards leave shards empty; an empty table gives no rows. Slots count from 0 without gaps in each shard. A
    text longer than a shard's part stays whole and may leave the next shard empty. Other columns are not looked at,
    whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = stored(
        docs.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(text).alias("h"),
        )
    )
    shard = F.lit(0)
    for h, id_ in splitters(keys, shards):
        shard = shard + F.when((F.col("h") > h) | ((F.col("h") == h) & (F.col("id") >= id_)), 1).otherwise(0)
    # Slots are numbered in several parts of each shard at once; a part starts after the rows of the parts before it.
    parts = -(-partitions(spark) // shards)
    placed = keys.withColumn("shard", shard.cast("int")).withColumn("part", F.pmod(F.xxhash64("id", "h"), F.lit(parts)).cast("int"))
    counted = {(r.shard, r.part): r.n for r in placed.groupBy("shard", "part").agg(F.count("*").alias("n")).collect()}
    starts = []
    for s in range(shards):
        at = 0
        for p in range(parts):
            starts.append((s, p, at))
            at += counted.get((s, p), 0)
    begin = F.broadcast(spark.createDataFrame(starts, "shard int, part int, start long"))  # shards * parts rows
    order = Window.partitionBy("shard", "part").orderBy("h", "id")
    return placed.withColumn("n", F.row_number().over(order)).join(begin, ["shard", "part"]).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("n") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
