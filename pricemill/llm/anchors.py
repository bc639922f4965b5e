"""Which windows of a corpus can repeat: windows grouped by their anchor.

A window of `size` symbols contains `size - gram + 1` grams; the one with the smallest hash, the first of equals, is
its anchor. Equal windows have equal anchors at equal offsets, so comparing windows that share an anchor loses no
repeat. Neighbouring windows mostly share their anchor, and such a run of windows is one row: (key: hash of the
anchor, cls: hash of all symbols the run covers, at: its first window, n: its number of windows). That is about one
row for (size - gram) / 2 windows instead of one for each.

`settle` brings the runs of a key together, sorted. A run whose class has an earlier occurrence repeats as a whole.
The first occurrence of a class can still share single windows with other classes of its key: it is left open, for
the operators to resolve by their own methods. All other runs are unique.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import bytes_of, partitions

#: Positions that go through numpy at once; longer texts are cut into overlapping pieces.
PIECE = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_rng = np.random.default_rng(20240229)
_SYMBOL = _rng.integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: White space of the word contracts.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each gram of uint64 symbols, put together from grams of 1, 2, 4, ... symbols."""
    n = len(symbols) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, block = _BASE, 1, symbols
    total, done = None, 0
    while True:
        if gram & width:
            part = block[done : done + n]
            total = part.copy() if total is None else total * power + part
            done += width
        width *= 2
        if width > gram:
            break
        block = block[: -width // 2] * power + block[width // 2 :]
        power = np.uint64(int(power) ** 2 % 2**64)
    return _mixed(total)


def runs_of(symbols: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, at, n) of the runs of windows that share an anchor occurrence."""
    keys, ats, ns = [], [], []
    for a in range(0, max(len(symbols) - size + 1, 0), PIECE):
        part = symbols[a : a + PIECE + size - 1]
        h = gram_hashes(part, gram)
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        grams, width = size - gram + 1, 1
        while width * 2 <= grams:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < grams:
            low = np.minimum(low[: len(low) - (grams - width)], low[grams - width :])
        place = (low & _PLACE).astype(np.int64)
        at = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        keys.append(h[place[at]])
        ats.append(at + a)
        ns.append(np.diff(np.concatenate([at, [len(place)]])))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(ats), np.concatenate(ns)


def byte_symbols(text: bytes) -> tuple[np.ndarray, bytes, int]:
    """(symbols to hash, buffer whose slices tell symbols apart, bytes of a symbol in it)."""
    return _SYMBOL[np.frombuffer(text, np.uint8)], text, 1


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last byte of each word."""
    blank = np.concatenate([[True], _BLANK[np.frombuffer(text, np.uint8)], [True]])
    edges = np.flatnonzero(np.diff(blank))
    return edges[::2], edges[1::2]


def word_symbols(text: bytes) -> tuple[np.ndarray, bytes, int]:
    """A number for each word: its bytes themselves up to eight of them, and the XXH3 hash of longer ones. Mixing tells
    lengths apart and can be undone, so two words of at most eight bytes and equal length never share a number."""
    begin, end = word_bounds(text)
    if not len(begin):
        return np.zeros(0, np.uint64), b"", 8
    size = end - begin
    data = np.frombuffer(text, np.uint8)
    values = np.zeros(len(begin), np.uint64)
    for j in range(8):
        at = np.flatnonzero(size > j) if j else slice(None)
        values[at] |= data[begin[at] + j].astype(np.uint64) << np.uint64(8 * j)
    view, h = memoryview(text), xxhash.xxh3_64_intdigest
    for i in np.flatnonzero(size > 8).tolist():
        values[i] = h(view[begin[i] : end[i]])
    h = _mixed(values ^ _mixed(np.minimum(size, 9).astype(np.uint64) * _BASE))
    return h, h.tobytes(), 8


ROWS = "route long, sure boolean, key long, cls long, id long, tag long, at long, n int"
_NAMES = ["route", "sure", "key", "cls", "id", "tag", "at", "n"]


def _emit(symbols_of: Callable, size: int, gram: int, by_id: bool, chunk: int = 2 << 20):
    """Runs of whole documents. Within a chunk of documents the copies of a class are settled at once: all but the
    first repeat for sure, and go their own way instead of to their key, so a frequent passage sends its key a row for
    each chunk and not for each document."""

    def flush(held: list) -> pa.RecordBatch:
        key, cls, id_, tag, at, n = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((at, tag, id_, cls, key))
        key, cls, id_, tag, at, n = (c[order] for c in (key, cls, id_, tag, at, n))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
        if by_id:
            first = id_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            sure = id_ > first
        else:
            sure = ~new
        route = np.where(sure, id_ * 31 + at, key)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (route, sure, key, cls, id_, tag, at, n.astype(np.int32))], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        volume = 0
        for b in batches:
            for id_, tag, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2))):
                symbols, buffer, width = symbols_of(text)
                key, at, n = runs_of(symbols, size, gram)
                volume += len(text)
                if len(key):
                    view, h = memoryview(buffer), xxhash.xxh3_64_intdigest
                    begin, end = (at * width).tolist(), ((at + n + size - 1) * width).tolist()
                    cls = np.array([h(view[s:e]) for s, e in zip(begin, end)], np.uint64).view(np.int64)
                    held.append((key.view(np.int64), cls, np.full(len(key), id_, np.int64), np.full(len(key), tag, np.int64), at, n))
                if volume >= chunk and held:
                    yield flush(held)
                    held, volume = [], 0
        if held:
            yield flush(held)

    return run


def _settle(by_id: bool):
    """Over runs sorted by (key, cls, id, tag, at): keeps those that repeat and those left open. Memory does not grow
    with the number of occurrences: only the first rows of a key's first class wait for a second class."""
    order = ("sure", "key", "cls", "id", "tag", "at", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, class, first id, whether the key has several classes
        waiting: list[tuple] = []
        for b in batches:
            col = {c: b.column(c).to_numpy(zero_copy_only=False) for c in order}
            m = b.num_rows
            sure, key, cls, id_ = col["sure"], col["key"], col["cls"], col["id"]
            loose = ~sure
            at = np.flatnonzero(loose)
            keep = sure.copy()
            open_ = np.zeros(m, bool)
            if len(at):
                k, c, i = key[at], cls[at], id_[at]
                new_key = np.concatenate([[last is None or k[0] != last[0]], k[1:] != k[:-1]])
                new_cls = new_key | np.concatenate([[last is None or c[0] != last[1]], c[1:] != c[:-1]])
                # The first id of each class; rows before the first change belong to the last batch's class.
                mark = np.maximum.accumulate(np.where(new_cls, np.arange(len(at)), -1))
                first = np.where(mark >= 0, i[np.maximum(mark, 0)], last[2] if last else 0)
                later = (i > first) if by_id else ~new_cls
                keep[at[later]] = True
                # Does the key have several classes, as far as this batch shows?
                group = np.cumsum(new_key)
                classes = np.bincount(group, new_cls, group[-1] + 1)
                several = classes[group] > 1
                continued = group == 0  # rows of the last batch's key
                if continued.any() and (last[3] or new_cls[continued].any()):
                    several |= continued
                    if waiting:
                        yield _rows(waiting)
                        waiting = []
                elif continued.any():
                    several &= ~continued
                if group[-1]:
                    waiting = []  # that key had one class
                firsts = ~later
                open_[at[firsts & several]] = True
                for j in at[firsts & (group == group[-1]) & ~several].tolist():
                    waiting.append(tuple(col[x][j].item() for x in order[1:]))
                last = (k[-1], c[-1], first[-1], bool(several[-1]))
            out = keep | open_
            if out.any():
                # The hashes of runs that repeat are not needed any more.
                col["key"], col["cls"] = np.where(open_, key, 0), np.where(open_, cls, 0)
                yield pa.RecordBatch.from_arrays([pa.array(open_[out]), *[pa.array(col[x][out]) for x in order[1:]]], ["open", *order[1:]])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(),) * 5 + (pa.int32(),)
        return pa.RecordBatch.from_arrays([pa.array([True] * len(rows)), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], ["open", *order[1:]])

    return run


def settle(texts: DataFrame, symbols_of: Callable, size: int, gram: int, by_id: bool) -> DataFrame:
    """(open, key, cls, id, tag, at, n) from keyed texts (id, tag, text). Not open: every window of the run repeats an
    earlier one. Open: its class occurs here first, and its key has other classes. `by_id`: only occurrences under a
    smaller id count as earlier; else occurrences are ordered by (id, tag, at)."""
    runs = texts.mapInArrow(_emit(symbols_of, size, gram, by_id), ROWS)
    dealt = runs.repartition(partitions(texts.sparkSession), "route").sortWithinPartitions("sure", "key", "cls", "id", "tag", "at")
    return dealt.mapInArrow(_settle(by_id), "open boolean, key long, cls long, id long, tag long, at long, n int")


def by_document(rows: DataFrame, *fields: str) -> DataFrame:
    """(id, tag, parts): the rows of each document as one list."""
    return rows.groupBy("id", "tag").agg(F.collect_list(F.struct(*fields)).alias("parts"))
