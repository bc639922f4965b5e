"""Language identification by cross-parsing.

For each language a suffix automaton holds all substrings of a sample of its text. A text is parsed greedily into the
longest phrases that the sample contains. To name a phrase takes the logarithm of the sample's length, so phrases times
that is what the text costs under a language, whatever the size of its sample; the least cost wins.

Since a phrase only follows transitions from the automaton's root until one is missing, the automaton is laid out as one
table of moves by byte, and numpy parses many pieces of text at once, one byte of each per step. Pieces are only a way
to work side by side: each is parsed from the root first, and then from the state in which the piece before it ends,
until both parses begin a phrase at the same byte; from there on they are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import bytes_of

#: Bound of the training sample: documents of a language, and bytes of it in the automaton.
SAMPLE_DOCS, SAMPLE_BYTES = 400, 24_000
#: Texts are parsed in pieces of this many bytes side by side; the result does not depend on it.
PIECE = 512
#: Pieces parsed at once.
LANES = 16384

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 97 or 122 < c < 128 else c for c in range(256))


@dataclass
class Model:
    """Moves of all languages' automata over a common alphabet; a move is 2 * state + 1 where a new phrase begins.
    ``price`` is what a phrase costs: the logarithm of the sample's length."""

    langs: list[str]
    alphabet: np.ndarray
    size: int
    moves: list[np.ndarray]
    price: list[float]


def _automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a text; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def normal(text: bytes) -> bytes:
    """Lower-case ASCII letters and bytes beyond ASCII, one space for each run of anything else."""
    return b" ".join(text.translate(_FOLD).split())


def model(samples: dict[str, bytes]) -> Model:
    langs = sorted(samples)
    seen = sorted(set(b"".join(samples.values())))
    alphabet = np.zeros(256, np.int32)  # 0: bytes that no sample has
    alphabet[seen] = np.arange(1, len(seen) + 1)
    size = len(seen) + 1
    tables = []
    for lang in langs:
        states = _automaton(samples[lang])
        root = np.ones(size, np.int32)  # a phrase of one unknown byte, then the root again
        for c, s in states[0].items():
            root[alphabet[c]] = 2 * s + 1
        moves = np.tile(root, (len(states), 1))
        for s, to in enumerate(states[1:], 1):
            for c, t in to.items():
                moves[s, alphabet[c]] = 2 * t
        tables.append(moves.reshape(-1))
    return Model(langs, alphabet, size, tables, [float(np.log2(len(samples[k]) + 1)) for k in langs])


def _parse(moves: np.ndarray, size: int, codes: np.ndarray, start: np.ndarray, stop: np.ndarray, state: np.ndarray, begins: np.ndarray, again: bool) -> np.ndarray:
    """States after pieces of the text that begin in the given states; ``begins`` is set where a phrase begins. Parsed
    ``again``, a piece is left where it meets the phrases that are marked already, with state -1."""
    ends = np.empty(len(start), np.int64)
    order = np.argsort(start - stop, kind="stable")  # longest pieces first, so that those still going are a prefix
    at, left, now, piece = start[order], (stop - start)[order], state[order], order
    step = 0
    while len(at):
        n = int(np.searchsorted(-left, -step, side="left"))  # pieces longer than the steps made
        ends[piece[n:]] = now[n:]
        at, left, now, piece = at[:n], left[:n], now[:n], piece[:n]
        if not n:
            break
        move = moves[now * size + codes[at + step]]
        new, now = (move & 1).astype(bool), move >> 1
        if again:
            met = new & begins[at + step]
            begins[at + step] = new
            if met.any():
                ends[piece[met]] = -1
                at, left, now, piece = at[~met], left[~met], now[~met], piece[~met]
        else:
            begins[at + step] = new
        step += 1
    return ends


def phrases(m: Model, texts: list[bytes]) -> np.ndarray:
    """Number of phrases of each text under each language."""
    out = np.zeros((len(texts), len(m.langs)), np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return out
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    pieces = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(texts)), pieces)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = begin[owner] + within * PIECE
    stop = np.minimum(start + PIECE, begin[owner] + sizes[owner])
    codes = m.alphabet[data].astype(np.int64)
    some = sizes > 0
    for j, moves in enumerate(m.moves):
        begins = np.zeros(len(data), bool)
        ends = np.empty(len(start), np.int64)
        for a in range(0, len(start), LANES):
            lanes = slice(a, a + LANES)
            ends[lanes] = _parse(moves, m.size, codes, start[lanes], stop[lanes], np.zeros(len(start[lanes]), np.int64), begins, False)
        # A piece whose end changes has its successor parsed once more; most meet the marked phrases at once.
        todo = np.flatnonzero(within > 0)
        while len(todo):
            came = np.empty(len(todo), np.int64)
            states = ends[todo - 1]
            for a in range(0, len(todo), LANES):
                lanes = todo[a : a + LANES]
                came[a : a + LANES] = _parse(moves, m.size, codes, start[lanes], stop[lanes], states[a : a + LANES], begins, True)
            changed = (came >= 0) & (came != ends[todo])
            ends[todo[changed]] = came[changed]
            after = todo[changed] + 1
            after = after[after < len(start)]
            todo = after[within[after] > 0]
        out[some, j] = np.add.reduceat(begins, begin[some], dtype=np.int64)
    return out


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def decide(m: Model, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and score of each text; `und` and 0 without a letter."""
    letters = [_has_letter(t) for t in texts]
    clean = [normal(t) if ok else b"" for t, ok in zip(texts, letters)]
    counts = phrases(m, clean)
    names, scores = [], []
    for ok, row in zip(letters, counts * np.array(m.price)):
        if not ok or not m.langs:
            names.append("und")
            scores.append(0.0)
            continue
        order = np.argsort(row, kind="stable")
        names.append(m.langs[order[0]])
        second = row[order[1]] if len(row) > 1 else 0.0
        scores.append(float(second / (row[order[0]] + second)) if second else 1.0)
    return names, scores


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES
) -> Model:
    """Automata of a bounded sample: at most sample_docs documents of each language, those with the smallest hash of
    their id, and sample_bytes bytes of normal text in equal shares. A document gives a stretch at a place that the
    hash draws from its whole text; equal stretches count once. Held-out rows and null labels are not used."""
    known = docs.where(~held_out(id_col)).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text")).where("lang is not null and text is not null and text <> ''")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not counts:
        return model({})
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, sample_bytes // min(n, sample_docs))])
    first = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    # Blanks shrink in normal text: a longer stretch is cut to its share later. Only stretches of the sample leave a task.
    shared = known.withColumn("share", F.greatest(F.element_at(shares, F.col("lang")), F.lit(1)))
    long = 2 * F.col("share") + 20
    place = F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.char_length("text") - long, F.lit(0)) + 1).cast("int") + 1
    # The hash is uniform: twice the wanted share of a language is all but sure to hold enough rows, and few are ranked.
    bounds = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, -(2**63) + min(int(min(1.0, 2 * sample_docs / n) * 2**64), 2**64 - 1))])
    cut = shared.where(F.col("h") <= F.element_at(bounds, F.col("lang"))).select("lang", "h", "share", F.substring("text", place, long).alias("text"))
    chosen = cut.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample_docs).drop("rank")
    samples: dict[str, list[bytes]] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r.lang, r.h, r.text)):  # at most sample_docs short stretches of each language
        samples.setdefault(r.lang, []).append(normal(r.text.encode())[: r.share])
    return model({k: b" ".join(dict.fromkeys(x for x in v if x))[:sample_bytes] + b" " for k, v in samples.items()})


def predict(docs: DataFrame, m: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row, from the whole text.

    The language with the least cost wins, ties go to the first name. The score is the second-best cost over the sum
    of the two best: 0.5 for a tie, near 1 for a clear case. A text that is null or has no letter is `und` with score
    0, as is every text without a learned language. Long texts are parsed whole, as one sequence. Rows with a null id
    count as not held out; repeated rows are answered each. An empty table gives no rows, and other columns are not
    looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _parts(b):
                names, scores = decide(m, bytes_of(part.column(2)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return given.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def _parts(b: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of rows with about `most` bytes of text."""
    ends = np.cumsum([len(t) for t in bytes_of(b.column(2))])
    at = 0
    while at < b.num_rows:
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        upto = max(at + 1, upto)
        yield b.slice(at, upto - at)
        at = upto
