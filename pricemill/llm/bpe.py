"""Byte-level BPE over the distinct words of the whole corpus.

1. Documents are taken in blocks. A block's pre-tokens are reduced to its distinct words, and these are sent, packed,
   to the shards of a global word shuffle: a word's shard is a hash of its bytes.
2. A shard encodes each distinct word once and sends the ids back to the blocks that asked.
3. A block meets its word list again, and its documents are put together by position. Their ids are decoded by the
   token-byte table; `decode` does the same for stored ids, as a join.

Words travel in packs (one row per block and shard) instead of one row per occurrence, so what moves is the distinct
words of the blocks, not the text's 10^8 positions. Documents meet their words by the block's number, which is drawn
from the documents themselves; no list of words is broadcast or collected.
"""

from __future__ import annotations

import base64
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.llm.common import bytes_of, partitions

#: Bytes of text in a block.
BLOCK = 12 << 20
#: Distinct words a shard keeps before it forgets them.
MEMORY = 1_000_000
#: Code points that the fast pattern covers; longer scripts go through the full one.
_NARROW = 0x250


def patterns(pattern: str) -> tuple:
    """The given pattern compiled, and the same with its classes spelled out for code points below 0x250."""
    import regex

    def chars(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(_NARROW) if unicodedata.category(chr(c))[0] == kind)

    full = regex.compile(pattern)
    letters, numbers, blank = chars("L"), chars("N"), "\t-\r \x85\xa0"
    if pattern != r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""":
        return full, None
    return full, re.compile(
        rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{blank}{letters}{numbers}]+| ?[{numbers}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


def pre_tokens(text: str, compiled: tuple) -> list[str]:
    full, narrow = compiled
    if narrow is not None and (text.isascii() or max(text) < chr(_NARROW)):
        return narrow.findall(text)
    return full.findall(text)


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_bytes(path: str) -> dict[int, bytes]:
    return {i: b for b, i in ranks(path).items()}


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one word: the neighbouring pair of lowest rank merges until none is left, the first of equals first."""
    if word in rank:
        return [rank[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 500:
        return _merge_long(parts, rank)
    none = len(rank) + 256
    pairs = [rank.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = rank.get(parts[i - 1] + parts[i], none)
    return [rank[p] for p in parts]


def _merge_long(parts: list[bytes], rank: dict[bytes, int]) -> list[int]:
    """The same with a heap and links, for words of many bytes."""
    import heapq

    n = len(parts)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(rank[parts[i] + parts[i + 1]], i, parts[i], parts[i + 1]) for i in range(n - 1) if parts[i] + parts[i + 1] in rank]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if j < n and parts[i] + parts[j] in rank:
            heapq.heappush(heap, (rank[parts[i] + parts[j]], i, parts[i], parts[j]))

    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j], after[i] = a + b, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [rank[p] for p, ok in zip(parts, alive) if ok]


def _pack(parts: list[bytes]) -> bytes:
    return zstandard.compress(np.fromiter(map(len, parts), "<u4", len(parts)).tobytes() + b"".join(parts), 3)


def _unpack(data: bytes, n: int) -> list[bytes]:
    raw = zstandard.decompress(data)
    ends = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64) + 4 * n
    return [raw[a:b] for a, b in zip([4 * n, *ends[:-1].tolist()], ends.tolist())]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block number, ids, texts): consecutive documents with about BLOCK bytes. The number is a checksum of ids and
    sizes, so that both passes over the documents name a block alike."""
    ids: list = []
    texts: list[bytes] = []
    size, first = 0, 0

    def number() -> int:
        told = repr((first, ids)).encode() + np.fromiter(map(len, texts), "<i8", len(texts)).tobytes()
        return zlib.crc32(told) << 31 | zlib.adler32(told) >> 1

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), bytes_of(b.column(1))):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= BLOCK:
                yield number(), ids, texts
                ids, texts, size, first = [], [], 0, first + 1
    if ids:
        yield number(), ids, texts


def _words(pattern: str, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = patterns(pattern)
        for block, _, texts in _blocks(batches):
            distinct: set[str] = set()
            for t in texts:
                distinct.update(pre_tokens(t.decode(), compiled))
            by_shard: list[list[bytes]] = [[] for _ in range(shards)]
            for w in sorted(distinct):
                raw = w.encode()
                by_shard[zlib.crc32(raw) % shards].append(raw)
            filled = [(s, words) for s, words in enumerate(by_shard) if words]
            if filled:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in filled], pa.int32()), pa.array([block] * len(filled), pa.int64()), pa.array([len(w) for _, w in filled], pa.int32()), pa.array([_pack(w) for _, w in filled], pa.binary())],
                    ["shard", "block", "n", "words"],
                )

    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks(path)
        known: dict[bytes, bytes] = {}
        for b in batches:
            out = []
            for r in b.to_pylist():
                answers = []
                for w in _unpack(r["words"], r["n"]):
                    if (a := known.get(w)) is None:
                        if len(known) >= MEMORY:
                            known.clear()
                        a = known[w] = np.array(merge(w, rank), "<i4").tobytes()
                    answers.append(a)
                out.append((r["block"], r["n"], r["words"], _pack(answers)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["block", "n", "words", "ids"])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, ids, texts in _blocks(batches):
        known = np.array([i is not None for i in ids])
        numbers = np.array([0 if i is None else i for i in ids], "<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([known.tobytes()], pa.binary()), pa.array([numbers.tobytes()], pa.binary()), pa.array([_pack(texts)], pa.binary())],
            ["block", "n", "known", "doc_ids", "texts"],
        )


ENCODED = "doc_id long, ids array<int>, decoded binary"
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


class _Table:
    """Token bytes by id, as one buffer with offsets; decodes many ids at once."""

    def __init__(self, path: str):
        known = token_bytes(path)
        parts = [known.get(i, b"") for i in range(max(known) + 1)]
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.start = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        shift = self.start[ids] - (np.cumsum(size) - size)
        return self.data[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes()


def _rebuild(path: str, pattern: str):
    def rebuilt(docs: pa.Table, packs: pa.Table) -> Iterator[pa.RecordBatch]:
        compiled, table = patterns(pattern), _Table(path)
        ids_of: dict[str, bytes] = {}
        for r in packs.to_pylist():
            ids_of.update(zip([w.decode() for w in _unpack(r["words"], r["n"])], _unpack(r["ids"], r["n"])))
        # Rows that repeat a whole block have its number too; each is rebuilt.
        for r in docs.to_pylist():
            known, numbers = np.frombuffer(r["known"], bool), np.frombuffer(r["doc_ids"], "<i8")
            names, ids, decoded = [], [], []
            for ok, i, t in zip(known, numbers, _unpack(r["texts"], r["n"])):
                own = np.frombuffer(b"".join(map(ids_of.__getitem__, pre_tokens(t.decode(), compiled))), "<i4")
                names.append(int(i) if ok else None)
                ids.append(own)
                decoded.append(table.decode(own))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists, pa.array(decoded, pa.binary())], schema=_ENCODED)

    def run(docs: pa.Table, packs: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(rebuilt(docs, packs)), _ENCODED)

    return run


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path of a rank file and the pattern that splits text before its merges."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row.

    A null or empty text has no ids. Repeated rows give repeated rows, a null id stays null, an empty table gives no
    rows. A text longer than a block is a block of its own. Other columns are not looked at, whatever their names.
    """
    found_path, found_pattern = vocabulary() if path is None or pattern is None else (path, pattern)
    path, pattern = path or found_path, pattern or found_pattern
    shards = partitions(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = given.mapInArrow(_words(pattern, shards), "shard int, block long, n int, words binary")
    # Word lists of blocks that are copies of each other are the same.
    answers = words.repartition(shards, "shard").mapInArrow(_encode(path), "block long, n int, words binary, ids binary")
    texts = given.mapInArrow(_texts, "block long, n int, known binary, doc_ids binary, texts binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_rebuild(path, pattern), ENCODED)


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def token_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, bytes) of a rank file."""
    return spark.createDataFrame(sorted(token_bytes(path or vocabulary()[0]).items()), "id int, bytes binary")


def decode(encoded: DataFrame, tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) for rows of stored ids, by a join with the token-byte table; a null or empty list decodes to
    nothing, an unknown id raises. Rows are told apart by a number, so repeated ids stay apart."""
    rows = encoded.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    each = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    found = each.join(F.broadcast(tokens), "id", "left").select("row", "doc_id", F.struct("pos", F.when(F.col("id").isNotNull() & F.col("bytes").isNull(), F.raise_error(F.format_string("unknown token %d", "id"))).otherwise(F.hex("bytes")).alias("hex")).alias("piece"))
    joined = found.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return joined.select("doc_id", F.unhex(F.array_join(F.transform("pieces", lambda p: F.coalesce(p["hex"], F.lit(""))), "")).alias("decoded"))
