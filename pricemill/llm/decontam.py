"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words that occurs in an item. A document streams through it word by word; the state
tells the longest run ending here that some item contains. Each 13-word window of an item (or a shorter item as a
whole) is marked at the state of its last word, so a match of that length names the items whose window occurs.

A word that no item contains resets the match, and a window lies between two such words. So only runs of item words
that are as long as the shortest window go through the automaton; numpy finds these runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import NO_ID, batched, bytes_of, keyed, runs, stored, unkeyed

WINDOW = 13
#: A document is contaminated if at least one word in this many is hit.
SHARE = 20
#: Words of test items in one automaton; a larger benchmark is streamed against several in turn.
AUTOMATON_WORDS = 400_000

#: Lower-cases A-Z and turns all other ASCII but digits and a-z into spaces; other bytes stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences with windows marked at their states."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append((name, codes))
                last = 0
                for c in codes:
                    last = self._extend(last, c)
        self.shortest = min([min(len(c), window) for _, c in coded], default=window)
        # Marks of a state: window length -> items; `marked` leads to the nearest marked state on the suffix path.
        self.marks: list[dict[int, set]] = [{} for _ in self.next]
        for name, codes in coded:
            size = min(len(codes), window)
            for end, state, length in self._walk(codes):
                if end + 1 >= size:
                    while self.length[self.link[state]] >= size:
                        state = self.link[state]
                    self.marks[state].setdefault(size, set()).add(name)
        self.marked = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.marked[s] = s if self.marks[s] else self.marked[self.link[s]]

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # another item has been here
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state({}, self.length[last] + 1, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        copy = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _state(self, moves: dict, length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _walk(self, codes) -> Iterator[tuple[int, int, int]]:
        """Position, state and length of the longest match that ends there."""
        state = length = 0
        for i, c in enumerate(codes):
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                length += 1
            yield i, state, length

    def matches(self, codes) -> Iterator[tuple[int, int, set]]:
        """(start, end, items) of each window that occurs."""
        for i, state, length in self._walk(codes):
            s = self.marked[state]
            while s > 0:
                for size, names in self.marks[s].items():
                    if size <= length:
                        yield i + 1 - size, i + 1, names
                s = self.marked[self.link[s]]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, set]:
        """Disjoint hit intervals and the items of a document."""
        get = self.vocabulary.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        inside = np.concatenate([[0], (codes >= 0).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(inside))
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins >= self.shortest
        starts, stops, names = [], [], set()
        for a, b in zip(begins[long].tolist(), ends[long].tolist()):
            for s, e, found in self.matches(codes[a:b].tolist()):
                starts.append(a + s)
                stops.append(a + e)
                names |= found
        s, e = runs(np.array(starts, np.int64), np.array(stops, np.int64))
        return s, e, names


_SCHEMA = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_MARKED = "id long, tag long, n_words long, starts array<long>, ends array<long>, items array<string>"


def _named(names: set) -> list:
    return sorted(names, key=lambda n: (n is None, n))


def _scan(automaton: Automaton, only_hit: bool):
    """Hit intervals and items of each text under one automaton."""

    def rows(b: pa.RecordBatch) -> Iterator[tuple]:
        for id_, tag, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2))):
            words = words_of(text)
            s, e, names = automaton.scan(words)
            if len(s) or not only_hit:
                yield id_, tag, len(words), s.tolist(), e.tolist(), _named(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from batched(rows(b), _SCHEMA)

    return run


def automata(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[Automaton]:
    """Automata of at most AUTOMATON_WORDS words each (or one item), one after the other: the driver holds the items of
    one, and each goes to the tasks of its own job. The benchmark, not the corpus, sets their number.

    Items with a null text or no words have no windows and are left out of results. Items with a null id have windows
    like any other.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    held, size = [], 0
    for r in items.orderBy("item", "text").toLocalIterator():
        words = words_of(r.text.encode())
        if held and size + len(words) > AUTOMATON_WORDS:
            yield Automaton(held)
            held, size = [], 0
        held.append((r.item, words))
        size += len(words)
    yield Automaton(held)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each document from its rows of several automata."""
    for b in batches:
        rows = []
        for id_, tag, n, parts in zip(*[b.column(c).to_pylist() for c in range(4)]):
            s, e = runs(*[np.array([x for p in parts for x in p[c]], np.int64) for c in ("starts", "ends")])
            rows.append((id_, tag, n, s.tolist(), e.tolist(), _named({x for p in parts for x in p["items"]})))
        yield from batched(iter(rows), _SCHEMA)


def marked(docs: DataFrame, parts: Iterator[Automaton], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, n_words, starts, ends, items) of every row; id and tag as `keyed` has them.

    Documents stream past one automaton after the other; what they hit is stored, and where a benchmark needs several
    automata the intervals of a document are united.
    """
    texts = keyed(docs, id_col, text_col)
    first, more = None, []
    for automaton in parts:
        if first is None:
            first = stored(texts.mapInArrow(_scan(automaton, False), _MARKED))
        else:
            # Rows that repeat id and text hit the same.
            more.append(stored(texts.mapInArrow(_scan(automaton, True), _MARKED)).dropDuplicates(["id", "tag"]))
    if not more:
        return first
    hit = ["starts", "ends", "items"]
    others = reduce(DataFrame.union, more).groupBy("id", "tag").agg(F.collect_list(F.struct(*hit)).alias("others"))  # a row of each automaton
    joined = first.join(stored(others), ["id", "tag"], "left")
    parts = F.concat(F.array(F.struct(*hit)), F.coalesce("others", F.array().cast("array<struct<starts:array<bigint>,ends:array<bigint>,items:array<string>>>")))
    return joined.select("id", "tag", "n_words", parts.alias("parts")).mapInArrow(_merged, _MARKED)


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, starts, ends, items) for every row: disjoint intervals of hit words, and the items found.

    A null or empty text has no words; long texts are read whole. Repeated rows give repeated rows, a null id stays
    null, an empty benchmark hits nothing and an empty table gives no rows. Items without an id hit like others and are
    one null, the last, in the items. Other columns are not looked at, whatever their names.
    """
    return marked(docs, automata(benchmark), id_col, text_col).select(unkeyed().alias("doc_id"), "n_words", "starts", "ends", "items")


def digest(found: DataFrame) -> DataFrame:
    """Numbers and a hash for each row; items without an id count as one in n_items, and have no name to hash."""
    return found.select(
        "doc_id",
        "n_words",
        _n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def _n_hit() -> Column:
    return F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, x: n + x["ends"] - x["starts"])


def contaminated() -> Column:
    return (_n_hit() > 0) & (SHARE * _n_hit() >= F.col("n_words"))


def _filter(automaton: Automaton, text_at: int):
    def dirty(text: bytes) -> bool:
        words = words_of(text)
        s, e, _ = automaton.scan(words)
        n = int((e - s).sum())
        return n > 0 and SHARE * n >= len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not dirty(t) for t in bytes_of(b.column(text_at))], pa.bool_()))

    return run


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, all columns. Null and empty texts stay, and so do repeated rows; an
    empty table stays empty. Documents that one automaton can judge do not leave their task."""
    parts = automata(benchmark)
    first, second = next(parts), next(parts, None)
    if second is None:
        return docs.mapInArrow(_filter(first, docs.columns.index(text_col)), docs.schema)
    found = marked(docs, chain([first, second], parts), id_col, text_col)
    dirty = stored(found.where(contaminated()).select("id", "tag").distinct())
    return _rowed(docs, id_col, text_col).join(dirty, ["id", "tag"], "left_anti").select("row.*")


def _rowed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, tag): the given columns as one, whatever their names, and the key of `keyed`."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag")
    return docs.select(F.struct("*").alias("row"), *key)


def _without(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """The text without the words of the intervals; what separates words stays, but for that inside of an interval."""
    blank = np.frombuffer(text.translate(_FOLD), np.uint8) == 32
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
    begin, end = edges[::2], edges[1::2]
    out, at = [], 0
    for s, e in zip(starts, ends):
        out.append(text[at : begin[s]])
        at = end[e - 1]
    return b"".join(out) + text[at:]


def without_spans(docs: DataFrame, benchmark: DataFrame, words: int = 2 * WINDOW, share: int = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without what they share with the benchmark: each hit span of at least so many words
    goes, and every hit span of a document in which at least one word in `share` is hit.

    A column n_chars is counted anew where a text changes. Documents stay, even if nothing is left of them; null and empty texts, repeated
    rows and an empty table stay as they are.
    """
    spans = F.filter(F.arrays_zip("starts", "ends"), lambda x: contaminated() | (x["ends"] - x["starts"] >= words))
    found = marked(docs, automata(benchmark), id_col, text_col).dropDuplicates(["id", "tag"]).select("id", "tag", spans.alias("spans")).where("size(spans) > 0")
    joined = _rowed(docs, id_col, text_col).join(stored(found), ["id", "tag"], "left")
    names, at = docs.columns, docs.columns.index(text_col)
    counts = {i for i, c in enumerate(names) if c == "n_chars"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new, size = [], {}
            for row, (text, cut) in enumerate(zip(b.column(at).cast(pa.binary()).to_pylist(), b.column(len(names)).to_pylist())):
                if text and cut:
                    text = _without(text, [x["starts"] for x in cut], [x["ends"] for x in cut])
                    size[row] = len(text.decode())
                new.append(None if text is None else text.decode())
            columns = [b.column(i) for i in range(len(names))]
            columns[at] = pa.array(new, pa.string())
            for i in counts:
                columns[i] = pa.array([size.get(row, n) for row, n in enumerate(columns[i].to_pylist())], columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    told = joined.select(*[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(names)], "spans")
    return told.mapInArrow(run, docs.schema)
