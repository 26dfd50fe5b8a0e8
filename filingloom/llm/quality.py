"""Quality classifier from weak labels.

Ten heuristic labellers vote good, bad or nothing on each text. Expectation-maximisation on the counts of vote patterns
over all documents, begun from "a bad vote is right", estimates each labeller's accuracies and the share of good texts; a
pattern's posterior is the label of its documents. A linear scorer is trained on a sample of about `sample` different
documents (smallest hash of doc_id and text), and scores every whole text. Its features: hashed n-grams (1 to 3) of
character shapes, the share of words that repeat the one before, and hashed lower-cased words, each as there or not. No
given label is read.

Defined cases: a null or empty text gets no votes but "too short", and quality 0. Without documents there is nothing to
score. A text of over a million bytes is read piece by piece, cut at white space (a longer run of other bytes is cut where
the piece ends). Equal rows count as one in the sample. Each row is judged on its text alone, so repeats and null ids stay
as they are; columns of docs are kept, but for those of the result's names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from . import linear

DIMENSIONS = 512
_ROWS = 2048
_BITS = 17
#: Shape of each byte: lower case, upper case, digit, white space, byte of a longer character; others are themselves.
_SHAPE = np.arange(256, dtype=np.uint32)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 1, 2, 3, 5
_SHAPE[[9, 10, 11, 12, 13, 32]] = 4
_PLAIN = np.isin(np.arange(256), [ord(c) for c in "\t\n\v\f\r 0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#$%&*@^~<>{}[]\\|=+_"])


def _sums(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[off]).astype(np.float64)


def _repeats(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Words of each text that repeat the word before."""
    return np.bincount(row[1:], (h[1:] == h[:-1]) & (row[1:] == row[:-1]), n) if len(h) > 1 else np.zeros(n)


def shape_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of hashed shape n-grams (1 to 3) of each text."""
    n = len(off) - 1
    c = _SHAPE[data]
    row = np.repeat(np.arange(n), np.diff(off))
    out = np.zeros(n * DIMENSIONS)
    code = c.copy()
    for k in range(3):
        if k:
            code = code[:-1] * np.uint32(263) + c[k:]
        if len(code):
            same = row[: len(code)] == row[k:]
            h = (code[same] + np.uint32(k * 7919)) * np.uint32(0x9E3779B1)
            out += np.bincount(row[: len(code)][same] * DIMENSIONS + (h >> np.uint32(23)), minlength=len(out))
    return out.reshape(n, DIMENSIONS)


def measures(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: bytes, words, upper and lower case, symbols, bytes in words, shouts, words that end a clause, other
    marks, words that end in a symbol, repeated words; then row and hash of each word."""
    n = len(off) - 1
    start, end, row = C.words(data, off)
    h = C.word_hash(data, start, end)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    columns = [
        np.diff(off), np.bincount(row, minlength=n), _sums((data >= 65) & (data <= 90), off), _sums((data >= 97) & (data <= 122), off), _sums(_SYMBOL[data], off), np.bincount(row, end - start, n), _sums(data == 33, off),
        np.bincount(row, np.isin(last, [44, 46]), n), _sums((data < 128) & ~_PLAIN[data], off), np.bincount(row, _SYMBOL[last], n), _repeats(row, h, n),
    ]
    return np.stack(columns, 1).astype(np.float64), row, h


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def read(texts, shapes: bool = True, most: int = C.SLICE) -> Iterator[tuple]:
    """First row, last row, and for these rows: measures, different words, shape counts, row and hashed feature of each
    different lower-cased word."""
    data, off = C.utf8(texts)
    for a, b in C.slices(off, most):
        if off[b] - off[a] > most:
            yield a, b, *_long(data[off[a] : off[b]], shapes, most)
            continue
        for i in range(a, b, _ROWS):
            j = min(i + _ROWS, b)
            part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
            numbers, row, h = measures(part, at)
            own, _ = _distinct(row, h)
            yield i, j, numbers, np.bincount(own, minlength=j - i), shape_counts(part, at) if shapes else None, *(_features(part, at) if shapes else (None, None))


def _features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = C.lower(data)
    start, end, row = C.words(low, off)
    return _distinct(row, (C.word_hash(low, start, end) >> np.uint64(64 - _BITS)).astype(np.int64))


def _long(data: np.ndarray, shapes: bool, most: int) -> tuple:
    """What read() gives for one text, summed over its pieces."""
    numbers, seen, counts, features, before = 0.0, np.zeros(0, np.uint64), 0.0, np.zeros(0, np.int64), None
    for x, y in C.pieces(data, most):
        part = np.array([0, y - x])
        one, _, h = measures(data[x:y], part)
        if len(h):
            one[0, -1] += before is not None and h[0] == before
            before = h[-1]
        numbers, seen = numbers + one, np.unique(np.concatenate([seen, np.unique(h)]))
        if shapes:  # n-grams that begin in the piece before count here
            head = max(0, x - 2)
            counts = counts + shape_counts(data[head:y], np.array([0, y - head])) - shape_counts(data[head:x], np.array([0, x - head]))
            features = np.union1d(features, _features(data[x:y], part)[1])
    return numbers, np.array([len(seen)]), counts if shapes else None, np.zeros(len(features), np.int64), features


def votes(numbers: np.ndarray, different: np.ndarray) -> np.ndarray:
    """A row of votes for each text: 1 good, -1 bad, 0 none."""
    size, words, upper, lower, symbols, length, shout, ends, marks, odd, again = numbers.T
    size, some = np.maximum(size, 1), np.maximum(words, 1)
    symbols, marks, caps, length, shout, ends, odd, again, distinct = symbols / size, marks / size, upper / np.maximum(upper + lower, 1), length / some, shout / some, ends / some, odd / some, again / some, different / some
    calm, varied = (caps < 0.2) & (shout < 0.02), again < 0.1
    out = [
        np.where(symbols > 0.015, -1, 0),
        np.where(marks > 0.08, -1, 0),
        np.where(odd > 0.1, -1, 0),
        np.where(caps > 0.4, -1, 0),
        np.where(shout > 0.1, -1, 0),
        np.where(again > 0.2, -1, 0),
        np.where((distinct < 0.2) & (words > 30) & (words < 2000), -1, 0),
        np.where((length > 15) | (length < 1.5), -1, 0),
        np.where(calm & varied & (marks < 0.06), 1, 0),
        np.where(varied & (ends > 0.02) & (ends < 0.5) & (odd < 0.05), 1, np.where((ends == 0) & (words > 30), -1, 0)),
    ]
    out = np.stack(out, 1).astype(np.int8)
    out[words == 0] = [0, 0, 0, 0, 0, 0, 0, -1, 0, 0]
    return out


def dense(counts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Square roots of the shares of shape n-grams and of repeated words, times 10."""
    again = numbers[:, -1] / np.maximum(numbers[:, 1], 1)
    return np.hstack([10 * np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)), 10 * np.sqrt(again)[:, None]]).astype(np.float32)


def _settle(x: np.ndarray, size: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Draws a short text's features to the mean."""
    return mean + (x - mean) * (size / (size + 100.0))[:, None]


def _spread(row: np.ndarray, n: int) -> np.ndarray:
    """The value of each word that is there: all of a text's have unit length."""
    return (1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1)))[row]


def accuracies(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """Probabilities of each vote given the class (class, labeller, vote + 1), share of good texts, posterior of each pattern."""
    good = np.where((patterns < 0).any(1), 0.1, 0.98)
    for _ in range(steps):
        share = float((counts * good).sum() / counts.sum())
        table = np.zeros((2, patterns.shape[1], 3))
        for c, p in enumerate((1 - good, good)):
            for v in (-1, 0, 1):
                table[c, :, v + 1] = ((counts * p)[:, None] * (patterns == v)).sum(0) + 0.5
        table /= table.sum(2, keepdims=True)
        score = np.log(max(share, 1e-9) / max(1 - share, 1e-9)) + sum(np.log(table[1, k, patterns[:, k] + 1] / table[0, k, patterns[:, k] + 1]) for k in range(patterns.shape[1]))
        now = linear.sigmoid(score)
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return table, share, good


def fit(docs: DataFrame, sample: int = 6000) -> dict | None:
    docs = docs.select("doc_id", "text")

    def count(batches):
        seen: dict[bytes, int] = {}
        for b in batches:
            for _, _, numbers, different, *_ in read(b.column("text"), shapes=False):
                kinds, n = np.unique(votes(numbers, different), axis=0, return_counts=True)
                for k, m in zip(kinds, n.tolist(), strict=True):
                    seen[k.tobytes()] = seen.get(k.tobytes(), 0) + m
        yield pa.record_batch({"k": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    found = docs.select("text").mapInArrow(count, "k binary, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    if not found:
        return None
    patterns = np.array([np.frombuffer(bytes(r["k"]), np.int8) for r in found]).astype(int)
    order = np.lexsort(patterns.T)
    patterns, counts = patterns[order], np.array([r["n"] for r in found], np.float64)[order]
    table, share, good = accuracies(patterns, counts)
    posterior = {p.astype(np.int8).tobytes(): g for p, g in zip(patterns, good, strict=True)}

    def features(batches):
        for b in batches:
            for i, j, numbers, different, shapes, row, word in read(b.column("text")):
                edge = np.searchsorted(row, np.arange(j - i + 1))
                kinds = [v.tobytes() for v in votes(numbers, different)]
                x = [r.astype(np.float16).tobytes() for r in dense(shapes, numbers)]
                words = [C.squeeze_sorted(word[s:e].astype(np.uint64)) for s, e in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.record_batch({"k": b.column("__fl_k").slice(i, j - i), "n": pa.array(numbers[:, 0]), "y": pa.array(kinds, pa.binary()), "x": pa.array(x, pa.binary()), "w": pa.array(words, pa.binary())})

    rows = C.sampled(docs, sample).select("text", "__fl_k").mapInArrow(features, "k long, n double, y binary, x binary, w binary").orderBy("k").limit(sample).collect()
    x = np.stack([np.frombuffer(bytes(r["x"]), np.float16) for r in rows]).astype(np.float32)
    y = np.array([posterior.get(bytes(r["y"]), share) for r in rows])
    words = [C.unsqueeze_sorted(bytes(r["w"])).astype(np.int64) for r in rows]
    mean = x.mean(0)
    x = _settle(x, np.array([r["n"] for r in rows]), mean)
    row, word = np.repeat(np.arange(len(rows)), [len(w) for w in words]), np.concatenate(words)
    value = _spread(row, len(rows))
    shape = linear.fit_logistic(x, y)
    z = x @ shape[:-1] + shape[-1]
    weights = linear.fit_sparse(row, word, value, y, 1 << _BITS, z)
    shape = linear.fit_logistic(x, y, offset=np.bincount(row, value * weights[word], len(rows)))
    return {"shape": shape.astype(np.float32), "words": weights.astype(np.float32), "mean": mean, "accuracies": table, "share": share}


def score(docs: DataFrame, model: dict | None, least: float = 0.5) -> DataFrame:
    """docs with quality (probability of a good text) and keep."""
    kept = docs.drop("quality", "keep")

    def run(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            for i, j, numbers, _, shapes, row, word in read(b.column("text")) if model is not None else ():
                x = _settle(dense(shapes, numbers), numbers[:, 0], model["mean"])
                z = x @ model["shape"][:-1] + model["shape"][-1] + np.bincount(row, _spread(row, j - i) * model["words"][word], j - i)
                out[i:j] = np.where(numbers[:, 0] > 0, linear.sigmoid(z), 0)
            yield pa.record_batch({n: b.column(n) for n in b.schema.names} | {"quality": pa.array(out), "keep": pa.array(out >= least)})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("quality", T.DoubleType()), T.StructField("keep", T.BooleanType())]))
