"""Operator 12: periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q, at least max(``MIN_WORDS``,
``MIN_EXPONENT`` * q) long, that no neighbouring word extends keeping period q.

1. The words of many texts (a slice of at most about 1 MB, or one longer text) become numbers;
   a symbol of its own, a wall, stands before each text and after the last one.
2. Recompression: maximal blocks of one symbol are replaced by a symbol for (symbol, length), then
   every pair of a left and a right symbol by a symbol for the pair, in turns, until each
   text is one symbol.  The levels form a run-length grammar of about four times the slice's words.
   What becomes of a symbol depends on its neighbours only, so equal stretches are compressed alike
   but at their ends.
3. A longest common extension of two positions climbs the levels while the symbols agree, with at
   most one step aside per level, and descends from the first difference, again with at most
   one step per level; many queries go together as arrays.
4. Every run of period p with exponent ``MIN_EXPONENT`` = 4 holds a point i of the grid 0, 3p, 6p, ... together
   with i + p.  Those pairs, n/3 * ln n per text, are the candidates; where the two words are equal,
   extensions to both sides give the exact maximal stretch of period p.  A stretch that several periods
   reach has the least of them (the others are its multiples and end at the same words).

Everything is map-only: a task holds one slice, its grammar and at most ``PAIRS`` candidates at once.

Cases: null and empty texts and texts of white space have no words, no runs and an empty collapsed
text; rows that repeat an id are each judged; very long texts go alone; texts shorter than
``MIN_WORDS`` have no run; an empty table gives no rows; other columns are left as they are by
:func:`collapse_runs`.  Words are compared by their bytes, in every case exactly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, lean, slices
from .shingles import mix

MIN_WORDS, MIN_EXPONENT = 6, 4
PAIRS = 1 << 21  # candidate pairs examined at once
SHAKE = 0x9E3779B97F4A7C15


def numbered(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 for equal keys, and how many there are."""
    found, number = np.unique(keys, return_inverse=True)
    return number.reshape(-1), len(found)


class Grammar:
    """Levels of the recompression of a symbol sequence.

    Non-negative symbols are compressed, negative ones are walls: each occurs once.  The sequence
    begins and ends with a wall.  Level k + 1 was made from level k by ``kind[k]``; ``parent[k]`` maps its
    symbols up, ``first[k]`` gives the first child of each symbol of level k + 1 (and, last, the length of level k).
    """

    def __init__(self, symbols: np.ndarray):
        self.levels, self.kind, self.parent, self.first = [symbols.astype(np.int64)], [], [], []
        self.used, seed = int(symbols.max(initial=0)) + 1, 0
        while len(self.levels[-1]) > 1 and ((self.levels[-1][1:] >= 0) & (self.levels[-1][:-1] >= 0)).any():
            self.blocks()
            self.pairs(seed)
            seed += 1

    def add(self, kind: str, head: np.ndarray, made: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
        """A level whose symbols begin at the heads; ``made`` gives the symbols of those with several children."""
        s, first = self.levels[-1], np.flatnonzero(head)
        size = np.diff(np.append(first, len(s)))
        up, several = s[first], size > 1
        number, n = numbered(made(first[several], size[several]))
        up[several] = self.used + number
        self.used += n
        self.levels.append(up)
        self.kind.append(kind)
        self.parent.append((np.cumsum(head) - 1).astype(np.int32))
        self.first.append(np.append(first, len(s)).astype(np.int32))

    def blocks(self) -> None:
        s = self.levels[-1]
        head = np.concatenate([[True], s[1:] != s[:-1]])
        if not head.all():
            self.add("block", head, lambda first, size: s[first] * (int(size.max(initial=0)) + 1) + size)

    def pairs(self, seed: int) -> None:
        """Each symbol is a left or a right one, by a hash; walls are neither."""
        s = self.levels[-1]
        side = (mix(s.astype(np.uint64) + np.uint64((seed * SHAKE) & (1 << 64) - 1)) & np.uint64(1)).astype(bool)
        joins = ~side[:-1] & side[1:] & (s[:-1] >= 0) & (s[1:] >= 0)
        if joins.any():
            self.add("pair", np.concatenate([[True], ~joins]), lambda first, size: s[first] * self.used + s[first + 1])

    def extension(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from i and j on, i <> j, to the right (step 1) or to the left (step -1)."""
        a, b, height = i.astype(np.int64), j.astype(np.int64), np.full(len(i), -1, np.int64)
        live = np.arange(len(i))
        for k in range(len(self.levels)):
            s = self.levels[k]
            same = s[a[live]] == s[b[live]]
            height[live[~same]] = k
            live = live[same]
            if not len(live) or k == len(self.kind):
                break
            parent, first = self.parent[k], self.first[k]
            left_a, left_b = self.remaining(k, a[live], step), self.remaining(k, b[live], step)
            aside = (left_a != self.size(k, a[live])) | (left_b != self.size(k, b[live]))  # inside a parent
            if self.kind[k] == "pair":  # equal symbols inside a pair: both are then at its far end or alone
                a[live[aside]] += step
                b[live[aside]] += step
            else:
                less = np.minimum(left_a, left_b)[aside]
                a[live[aside]] += step * less
                b[live[aside]] += step * less
                apart = aside & (left_a != left_b)
                height[live[apart]] = k  # one block goes on, the other has ended
                live = live[~apart]
            a[live], b[live] = parent[a[live]], parent[b[live]]
        while len(live):  # the top: one symbol per text, then a wall
            s = self.levels[-1]
            same = s[a[live]] == s[b[live]]
            height[live[~same]] = len(self.levels) - 1
            live = live[same]
            a[live] += step
            b[live] += step
        for k in range(len(self.kind) - 1, -1, -1):
            live, first, s = np.flatnonzero(height > k), self.first[k], self.levels[k]
            if not len(live):
                continue
            x, y = (first[a[live]], first[b[live]]) if step == 1 else (first[a[live] + 1] - 1, first[b[live] + 1] - 1)
            less = np.minimum(self.size(k, x), self.size(k, y)) if self.kind[k] == "block" else 1
            more = np.where(s[x] == s[y], less, 0)
            a[live], b[live] = x + step * more, y + step * more
        return (a - i) * step

    def size(self, k: int, at: np.ndarray) -> np.ndarray:
        """Children of the parents."""
        up, first = self.parent[k][at], self.first[k]
        return first[up + 1] - first[up]

    def remaining(self, k: int, at: np.ndarray, step: int) -> np.ndarray:
        """Children of the parent from this one on, itself included."""
        up, first = self.parent[k][at], self.first[k]
        return first[up + 1] - at if step == 1 else at - first[up] + 1


def grid(lengths: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, position, period) of all candidates, in batches: positions 0, 3p, 6p, ... of each text for p up to a fourth of it."""
    longest = np.where(lengths >= MIN_WORDS, lengths // MIN_EXPONENT, 0)
    text = np.repeat(np.arange(len(lengths)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    points = (lengths[text] - 1 - period) // ((MIN_EXPONENT - 1) * period) + 1
    ends = np.cumsum(points)
    at = 0
    while at < len(text):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        n = points[at:upto]
        which = np.repeat(np.arange(at, upto), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield text[which], starts[text[which]] + k * (MIN_EXPONENT - 1) * period[which], period[which]
        at = upto


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Every text's runs (start, length, period) by start, then period; a text is an array of numbers from 0."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if lengths.max(initial=0) < MIN_WORDS:
        return out
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + 1  # a wall before each text
    symbols = np.empty(int(lengths.sum()) + len(texts) + 1, np.int64)
    walls = np.append(starts - 1, len(symbols) - 1)
    symbols[walls] = -1 - np.arange(len(walls))
    for t, s in zip(texts, starts):
        symbols[s:s + len(t)] = t
    grammar, found = Grammar(symbols), []
    for text, i, p in grid(lengths, starts):
        same = symbols[i] == symbols[i + p]
        text, i, p = text[same], i[same], p[same]
        before = grammar.extension(i - 1, i + p - 1, -1)
        length = p + before + grammar.extension(i, i + p, 1)
        run = length >= np.maximum(MIN_WORDS, MIN_EXPONENT * p)
        found.append(np.stack([text, i - before - starts[text], length, p])[:, run])
    rows = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((4, 0), np.int64)
    least = np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)])[:rows.shape[1]]  # sorted: the least period first
    rows = rows[:, least]
    for t, s, n, p in rows[:, np.lexsort((rows[3], rows[1], rows[0]))].T.tolist():
        out[t].append((s, n, p))
    return out


def repeated_words(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def plant(words: list[bytes], row_id: int | None) -> list[bytes]:
    """The words, of every tenth id (by checksum) with a tail that repeats some of them."""
    h = 1 if row_id is None else zlib.crc32(str(row_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def analysed(words: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """(runs, collapsed text) of each of the word lists, in order."""
    number: dict[bytes, int] = {}
    coded = [np.fromiter((number.setdefault(w, len(number)) for w in t), np.int64, len(t)) for t in words]
    for t, runs in zip(words, find_runs(coded)):
        gone = repeated_words(runs, len(t)) if runs else ()
        yield runs, b" ".join([w for w, out in zip(t, gone) if not out] if runs else t)


def read(batch: pa.RecordBatch, change: Callable | None) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(row, runs, collapsed text) of a batch of ids and texts, in slices of bounded size."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1)
    for part in slices([len(t.as_buffer()) if t.is_valid else 0 for t in texts]):
        words = [(t.as_py() or b"").split() for t in texts[part]]
        if change:
            words = [change(w, i) for w, i in zip(words, ids[part])]
        for row, (runs, kept) in enumerate(analysed(words), part.start):
            yield row, runs, kept


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable | None = None) -> DataFrame:
    """(id, runs array of (start, length, period), collapsed): each text's runs, and its words
    but those that a run repeats, joined by one space.  ``change`` (words, id) may alter the words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(runs, kept.decode()) for _, runs, kept in read(batch, change)]
            runs = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in found], RUNS)
            yield pa.RecordBatch.from_arrays([batch.column(0), runs, pa.array([k for _, k in found], pa.string())], names=["id", "runs", "collapsed"])

    src = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(lean(run), f"id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.select(F.col("id").alias(id_col), "runs", "collapsed")


def best_run(runs: list[tuple[int, int, int]]) -> tuple:
    """start, length, period and 1000 * exponent of the run of the greatest exponent; ties by start, then period."""
    if not runs:
        return None, None, None, None
    start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return start, length, period, 1000 * length // period


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable | None = plant) -> DataFrame:
    """Per document: id, n_runs, the best run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256."""
    fields = [(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")] + [(c, pa.string()) for c in ("runs_sha256", "collapsed_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, runs, kept in read(batch, change):
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                rows.append((len(runs), *best_run(runs), hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()))
            columns = zip(*rows) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, (_, t) in zip(columns, fields)]], names=["id", *[f for f, _ in fields]])

    src = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    longs = ", ".join(f"{f} {'long' if t == pa.int64() else 'string'}" for f, t in fields)
    return src.mapInArrow(lean(run), f"id {kind}, {longs}").withColumnRenamed("id", id_col)
