"""Benchmark decontamination by spaced seeds.

A document leaks a benchmark item if somewhere `window` consecutive words of the item stand in the document, in order,
with at most `misses` of them substituted (compared without A-Z case). A spaced seed is a mask of compared positions; the
masks are chosen so that any such window has, under one of them, a stretch whose compared words all agree. Hashes of the
benchmark's words under the masks are sent to the documents' tasks; equal hashes name a diagonal (document position less
item position), and each diagonal is verified by counting equal words in every window along it.

An item of fewer words than a window leaks only if all its words stand in a row. The benchmark is taken in blocks of at
most `block_words` words, so that what a task gets has a fixed bound; all documents see all blocks.

Defined cases: null and empty texts have no words, and such items leak nowhere. Items equal in id and text are one; other
repeated items and documents are reported for each id; a null doc_id or item_id is reported as null. An empty benchmark or table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

_TABLE = 22
#: Diagonals that are held at once: seeds that many items share name very many.
_LINES = 500_000
_HITS = "doc_id long, item_id long, first int, words int, matched int"


def covering_masks(window: int, misses: int, weight: int = 5, span: int = 9) -> list[tuple[int, ...]]:
    """Masks (compared positions, from 0) of which each pattern of misses in a window leaves one whole; chosen greedily."""
    span = min(span, window)
    weight = max(1, min(weight, (window - misses) // max(1, misses), span))
    masks = [(0, *m) for m in combinations(range(1, span), weight - 1)]
    open_ = {frozenset(p) for p in combinations(range(window), misses)}
    covers = {m: {p for p in open_ if any(not any(s + k in p for k in m) for s in range(window - m[-1]))} for m in masks}
    chosen = []
    while open_:
        best = max(masks, key=lambda m: (len(covers[m] & open_), m))
        chosen.append(best)
        open_ -= covers[best]
    return chosen


def _masked(h: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    n = len(h) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt + 1, np.uint64)
    for i, k in enumerate(mask):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * (i + salt * 16))
        out ^= out >> np.uint64(29)
    return C.mix(out)


def _different(lines: list[np.ndarray]) -> np.ndarray:
    whole = np.concatenate(lines, 1)
    whole = whole[:, np.lexsort(whole)]
    new = np.ones(whole.shape[1], bool)
    new[1:] = (whole[:, 1:] != whole[:, :-1]).any(0)
    return whole[:, new]


class Seeds:
    """The hashes of a block of items, and how documents are held against them."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int, misses: int) -> None:
        self.window, self.misses = window, misses
        self.ids = [i for i, _ in items]
        data, off = C.utf8(pa.array([t for _, t in items], pa.string()))
        data = C.lower(data)
        start, end, row = C.words(data, off)
        self.words = C.word_hash(data, start, end)
        self.size = np.bincount(row, minlength=len(items))
        self.head = np.cumsum(self.size) - self.size
        masks = covering_masks(window, misses)
        short = sorted({int(n) for n in self.size if 0 < n < window})
        self.masks = [*masks, *(tuple(range(n)) for n in short)]
        keys, at = [], []
        for s, mask in enumerate(self.masks):
            h = _masked(self.words, mask, s)
            whole = np.flatnonzero(row[: len(h)] == row[mask[-1] :])
            size = self.size[row[whole]]
            whole = whole[size >= window] if s < len(masks) else whole[size == len(mask)]
            keys.append(h[whole])
            at.append(whole)
        keys, at = np.concatenate(keys), np.concatenate(at)
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.row = keys[order], at[order], row
        self.seen = np.zeros(1 << _TABLE, bool)
        self.seen[self.keys >> np.uint64(64 - _TABLE)] = True

    def _lines(self, h: np.ndarray, row: np.ndarray, done: np.ndarray | None) -> Iterator[np.ndarray]:
        """Shift, item and document row of each diagonal that a seed names, about _LINES at a time; none of rows that are done."""
        held, size = [], 0
        for s, mask in enumerate(self.masks):
            key = _masked(h, mask, s)
            pos = np.flatnonzero(self.seen[key >> np.uint64(64 - _TABLE)])
            pos = pos[row[pos] == row[pos + mask[-1]]]
            lo, hi = np.searchsorted(self.keys, key[pos], "left"), np.searchsorted(self.keys, key[pos], "right")
            pos, lo, n = pos[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            upto = np.concatenate([[0], np.cumsum(n)])
            for i, j in C.slices(upto, _LINES):
                k = np.arange(i, j)
                if done is not None:
                    k = k[~done[row[pos[k]]]]
                m = n[k]
                item = self.at[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo[k], m)]
                held.append(np.stack([np.repeat(pos[k], m) - item, self.row[item], np.repeat(row[pos[k]], m)]))
                size += len(item)
                if size >= _LINES:
                    yield _different(held)
                    held, size = [], 0
        if size:
            yield _different(held)

    def _read(self, data: np.ndarray, off: np.ndarray):
        start, end, row = C.words(data := C.lower(data), off)
        count = np.bincount(row, minlength=len(off) - 1)
        return C.word_hash(data, start, end), row, np.cumsum(count) - count, count

    def leaks(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Document row, item, first word, words and equal words of the best leak of each pair."""
        h, row, head, count = self._read(data, off)
        best: list[np.ndarray] = [np.zeros((5, 0), np.int64)]
        for lines in self._lines(h, row, None):
            best += [self._verify(h, head, count, *lines[:, i : i + 20_000]) for i in range(0, lines.shape[1], 20_000)]
        best = np.concatenate(best, 1)
        order = np.lexsort((best[3], best[2], -best[4], best[1], best[0]))
        best = best[:, order]
        pair = best[0] * len(self.ids) + best[1]
        return list(best[:, np.diff(pair, prepend=-1) != 0])

    def leaking(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Whether each document leaks any item; what is known to leak is not looked at again."""
        h, row, head, count = self._read(data, off)
        done = np.zeros(len(off) - 1, bool)
        for lines in self._lines(h, row, done):
            for i in range(0, lines.shape[1], 20_000):
                part = lines[:, i : i + 20_000]
                done[self._verify(h, head, count, *part[:, ~done[part[2]]])[0]] = True
        return done

    def _verify(self, h, head, count, shift, item, row) -> np.ndarray:
        """shift: word number in the documents less word number in the items."""
        i0, i1 = self.head[item], self.head[item] + self.size[item]
        a = np.maximum(i0, head[row] - shift)
        n = np.minimum(i1, head[row] + count[row] - shift) - a
        need = np.minimum(self.window, self.size[item])
        base = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(base, n) + np.repeat(a, n)
        same = np.concatenate([[0], np.cumsum(self.words[at] == h[at + np.repeat(shift, n)])])
        good = np.zeros(len(same), bool)
        within = np.arange(len(at)) - np.repeat(base, n)
        ok = within + np.repeat(need, n) <= np.repeat(n, n)
        begin = np.flatnonzero(ok)
        width = np.repeat(need, n)[begin]
        allowed = np.where(width < self.window, 0, self.misses)
        begin_good = begin[same[begin + width] - same[begin] >= width - allowed]
        good[begin_good] = True
        line = np.repeat(np.arange(len(n)), n)[begin_good]
        if not len(line):
            return np.zeros((5, 0), np.int64)
        lines, first = np.unique(line, return_index=True)
        last = np.append(first[1:], len(line)) - 1
        x, y = begin_good[first], begin_good[last] + need[lines]
        return np.stack([row[lines], item[lines], (a + shift - head[row])[lines] + x - base[lines], y - x, same[y] - same[x]])


def blocks(bench: DataFrame, block_words: int, window: int, misses: int) -> Iterator[Seeds]:
    """The benchmark's seeds, block by block."""
    size = bench.agg(F.sum(C.n_words(F.col("text")))).first()[0] or 0
    n = 1 + size // block_words
    items = bench.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield Seeds(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), window, misses)


def leaks(docs: DataFrame, bench: DataFrame, window: int = 13, misses: int = 2, block_words: int = 1_000_000) -> DataFrame:
    """doc_id, item_id, first (word number), words and matched of the best leak of each item in each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for seeds in blocks(bench, block_words, window, misses):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def run(batches, shared=shared):
            seeds = shared.value
            for b in batches:
                data, off = C.utf8(b.column("text"))
                for i, j in C.slices(off):
                    row, item, *numbers = seeds.leaks(data[off[i] : off[j]], off[i : j + 1] - off[i])
                    yield pa.record_batch([b.column("doc_id").slice(i, j - i).take(pa.array(row)), pa.array([seeds.ids[k] for k in item.tolist()], pa.int64()), *(pa.array(x.astype(np.int32)) for x in numbers)], names=["doc_id", "item_id", "first", "words", "matched"])

        found = docs.mapInArrow(run, _HITS)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, bench: DataFrame, window: int = 13, misses: int = 2, block_words: int = 1_000_000) -> DataFrame:
    """The rows of docs that leak nothing."""
    for seeds in blocks(bench, block_words, window, misses):
        shared = docs.sparkSession.sparkContext.broadcast(seeds)

        def run(batches, shared=shared):
            for b in batches:
                data, off = C.utf8(b.column("text"))
                keep = np.ones(b.num_rows, bool)
                for i, j in C.slices(off):
                    keep[i:j] = ~shared.value.leaking(data[off[i] : off[j]], off[i : j + 1] - off[i])
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
