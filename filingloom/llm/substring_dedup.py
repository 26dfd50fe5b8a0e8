"""Removal of passages that occur earlier in the corpus, by super-k-mer partitioning.

A window is `window` consecutive words of one document, its minimiser the smallest hash among its runs of `mini` words.
Consecutive windows with one minimiser form a super-k-mer: one string, which goes to the minimiser's bucket. There all
windows are sorted by hash, equal hashes are compared byte by byte, and every window but the first of each group of
equals is marked. Before the exchange each map task drops the super-k-mers that it has sent before and marks them at
once, so copies of a document cost one row a task. Minimisers that would fill a bucket are found beforehand by a count
of heavy hitters; their windows travel one by one to buckets by the window's own hash.

Defined cases: a null or empty text has no words (n_words 0, kept text empty). A null doc_id counts as later than any
number; such rows are dealt out by their texts. Repeated rows (equal doc_id and text) are one document. Rows that share a doc_id with different texts are
separate documents, and neither is earlier at the same start. Only doc_id and text are read; other columns are kept, but
for those of the result's names (names that begin with `__fl` are the operators' own).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

_LAST = np.iinfo(np.int64).max
#: Windows of a super-k-mer at most; a longer run is cut, which loses nothing.
_RUN = 256
#: Super-k-mers that a map task remembers at most; it then starts anew, and may send one twice.
_SENT = 300_000
#: Bytes of super-k-mers that a map task gathers before it sends a row to each bucket.
_HELD = 16 << 20
#: Spans that a task gathers before it sends a row to each part of the documents.
_SPANS = 2_000_000
#: Windows of a bucket that are sorted at once, but for those of one hash.
_TURN = 250_000
#: Rows whose texts are cut at once.
_ROWS = 1000
_FAR = 1 << 31


def _slide_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    width = 1
    while 2 * width <= w:
        h = np.minimum(h[: len(h) - width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (w - width)], h[w - width :]) if w > width else h


def _tidy(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by single spaces, and where they begin and end now."""
    size = end - start
    new = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 32, np.uint8)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[at + np.repeat(new, size)] = data[at + np.repeat(start, size)]
    return out, new, new + size


def _super(data: np.ndarray, off: np.ndarray, window: int, mini: int):
    """Tidy bytes, word starts and ends, word hashes, first word of each row; then row, first window, windows and minimiser of each super-k-mer."""
    start, end, row = C.words(data, off)
    text, start, end = _tidy(data, start, end)
    h = C.word_hash(text, start, end)
    head = np.searchsorted(row, np.arange(len(off) - 1))
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return text, start, end, h, head, (none, none, none, none.astype(np.uint64))
    low = _slide_min(C.gram_hash(h, mini), window - mini + 1)
    valid = row[: len(low)] == row[window - 1 :]
    at = np.flatnonzero(valid)
    if not len(at):
        return text, start, end, h, head, (none, none, none, none.astype(np.uint64))
    new = np.ones(len(at), bool)
    new[1:] = (low[at[1:]] != low[at[:-1]]) | (np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]])
    run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= (np.arange(len(at)) - run) % _RUN == 0
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    return text, start, end, h, head, (row[at[first]], at[first], n, low[at[first]])


def _tables(batches: Iterator[pa.RecordBatch]):
    """Slices of the batches: bytes and offsets of text, doc_id and text key."""
    for b in batches:
        data, off = C.utf8(b.column("text"))
        doc = b.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
        key = b.column("text_key").to_numpy(zero_copy_only=False)
        for i, j in C.slices(off):
            yield data[off[i] : off[j]], off[i : j + 1] - off[i], doc[i:j], key[i:j]


def _heavy(docs: DataFrame, window: int, mini: int, share: int) -> tuple[list[int], int]:
    """Every minimiser with over 2/share of the super-k-mers, and some with half that; bytes of all of them. A task
    names its own with at least 1/share of its rows, so at most `share` of them, and the sum misses less than 1/share
    of all: those kept have at least 1/share each, so there are at most `share`."""

    def count(batches):
        seen, total, size = {}, 0, 0
        for data, off, doc, key in _tables(batches):
            _, start, end, _, _, (row, first, n, low) = _super(data, off, window, mini)
            if len(first):
                size += int((end[first + n + window - 2] - start[first]).sum())
            total += len(low)
            for k, c in zip(*(x.tolist() for x in np.unique(low, return_counts=True)), strict=True):
                seen[k] = seen.get(k, 0) + c
            if len(seen) > 64 * share:  # space-saving: what is dropped has under 1/(8 share) of the rows so far
                seen = {k: c for k, c in seen.items() if c * 8 * share > total}
        kept = [(k, c) for k, c in seen.items() if c * share >= total]
        yield pa.record_batch({"k": pa.array(np.array([x for x, _ in kept], np.uint64).view(np.int64)), "n": pa.array([c for _, c in kept], pa.int64()), "total": pa.array([0] * len(kept), pa.int64()), "size": pa.array([0] * len(kept), pa.int64())})
        yield pa.record_batch({"k": pa.array([None], pa.int64()), "n": pa.array([0], pa.int64()), "total": pa.array([total], pa.int64()), "size": pa.array([size], pa.int64())})

    sums = C.cut(docs.mapInArrow(count, "k long, n long, total long, size long").groupBy("k").agg(*(F.sum(c).alias(c) for c in ("n", "total", "size"))))
    whole = sums.where("k is null").first()
    least = -(-(whole["total"] if whole else 0) // share)
    return [r[0] for r in sums.where(F.col("k").isNotNull() & (F.col("n") >= max(1, least))).select("k").collect()], whole["size"] if whole else 0


def marked_spans(docs: DataFrame, window: int = 20, mini: int = 4, task_bytes: int = 24 << 20) -> DataFrame:
    """For each document with words that windows which occur earlier cover: doc_id (null is the largest long), text_key, spans (first and last word, last excluded)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    spark = docs.sparkSession
    hot, size = _heavy(docs, window, mini, 4 * C.partitions(spark))
    hot = np.sort(np.array(hot, np.int64).view(np.uint64))
    parts = max(C.partitions(spark), -(-size // task_bytes))
    buckets = 3 * parts

    def send(batches):
        sent: dict[bytes, int] = {}  # a number for doc_id and start together, in their order
        held, size = [[] for _ in range(7)], 0
        for data, off, doc, key in _tables(batches):
            text, start, end, h, head, (row, first, n, low) = _super(data, off, window, mini)
            single = np.isin(low, hot)
            if single.any():  # windows of heavy minimisers travel alone
                many = np.where(single, n, 1)
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                row, first, n, low, single = (np.repeat(x, many) for x in (row, first, n, low, single))
                first, n = first + step * single, np.where(single, 1, n)
                low = np.where(single, C.gram_hash(h, window)[first], low)
            last = first + n + window - 1
            raw, at = text.tobytes(), first - head[row] if len(row) else first
            keep = np.ones(len(row), bool)
            bucket = (C.mix(low) % np.uint64(buckets)).astype(np.int32)
            strings = []
            spots = zip(doc[row].tolist(), at.tolist(), start[first].tolist(), end[last - 1].tolist(), strict=True)
            for i, (d, f, x, y) in enumerate(spots):
                s = raw[x:y]
                k, was = hashlib.blake2b(s, digest_size=16).digest(), (d << 32) + f
                old = sent.get(k)
                if old is not None and was > old:  # all its windows occur earlier in this task
                    keep[i] = False
                    continue
                if old is None or was < old:
                    if len(sent) >= _SENT:
                        sent.clear()
                    sent[k] = was
                strings.append(s)
                size += y - x
            at, to = at.astype(np.int32), (at + n + window - 1).astype(np.int32)
            marks = (_dealt(doc[row[~keep]], key[row[~keep]]) % np.uint64(buckets)).astype(np.int32)
            for out, x in zip(held, (np.concatenate([bucket[keep], marks]), np.concatenate([np.ones(keep.sum(), bool), np.zeros(len(marks), bool)]), *(np.concatenate([v[keep], v[~keep]]) for v in (doc[row], key[row], at, to)), strings), strict=True):
                out.append(x) if out is not held[6] else out.extend(x)
            if size > _HELD:
                yield _pack(held)
                held, size = [[] for _ in range(7)], 0
        if held[0]:
            yield _pack(held)

    def settle(batches):
        bodies: dict[int, list[bytes]] = {}
        for b in batches:
            for k, body in zip(b.column("bucket").to_pylist(), b.column("body").to_pylist(), strict=True):
                bodies.setdefault(k, []).append(body)
        spans, size = [], 0
        for k in list(bodies):
            whole = [_unpack(x) for x in bodies.pop(k)]
            real, doc, key, first, last = (np.concatenate([x[i] for x in whole]) for i in range(5))
            spans.append((doc[~real], key[~real], first[~real], last[~real]))
            if real.any():
                text = b" ".join(x[5] for x in whole if x[5])
                del whole
                spans.append(_mark(text, doc[real], key[real], first[real], last[real], window))
            size += sum(len(x[0]) for x in spans[-2:])
            if size > _SPANS:
                yield _by_document(spans, parts)
                spans, size = [], 0
        yield _by_document(spans, parts)

    def gather(batches):
        """All spans of each document in one row, joined where they touch."""
        bodies = [C.parts(x) for b in batches for x in b.column("body").to_pylist()]
        doc, key, first, last = (np.concatenate([np.zeros(0, np.int64), *(C.unsqueeze(x[i]).astype(np.int64) for x in bodies)]) for i in range(4))
        order = np.lexsort((first, key, doc))
        doc, key, first, last = doc[order], key[order], first[order], last[order]
        begins = np.ones(len(doc), bool)
        begins[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
        at = np.flatnonzero(begins)
        which = np.cumsum(begins) - 1
        reach = np.maximum.accumulate(last + which * _FAR) - which * _FAR if len(doc) else last  # the furthest end so far in the document
        apart = begins.copy()
        apart[1:] |= first[1:] > reach[:-1]
        i = np.flatnonzero(apart)
        ends = reach[np.append(i[1:], len(doc)) - 1] if len(doc) else last
        lists = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(i, at), len(i)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(first[i].astype(np.int32)), pa.array(ends.astype(np.int32))], names=["first", "last"]))
        yield pa.record_batch({"doc_id": pa.array(doc[at]), "text_key": pa.array(key[at]), "spans": lists})

    sent = docs.mapInArrow(send, "bucket int, body binary").repartition(parts, "bucket")
    marked = sent.mapInArrow(settle, "part int, body binary").repartition(parts, "part")
    return marked.mapInArrow(gather, "doc_id long, text_key long, spans array<struct<first:int,last:int>>")


def _dealt(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A hash of id and text, so that rows without an id are dealt out too."""
    return C.mix(C.mix(doc.view(np.uint64) + np.uint64(1)) ^ key.view(np.uint64))


def _by_document(spans: list, parts: int) -> pa.RecordBatch:
    """A row for each part of the documents, by hash: its spans, compressed."""
    doc, key, first, last = (np.concatenate([np.zeros(0, np.int64), *(np.asarray(x[i], np.int64) for x in spans)]) for i in range(4))
    part = (_dealt(doc, key) % np.uint64(2 * parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.diff(part[order], prepend=-1))
    out = ([], [])
    for i, j in zip(edge, [*edge[1:], len(order)][: len(edge)], strict=True):
        at = order[i:j]
        body = [C.squeeze(x) for x in (doc[at], key[at], first[at].astype(np.int32), last[at].astype(np.int32))]
        out[0].append(int(part[at[0]]))
        out[1].append(b"".join(len(x).to_bytes(4, "little") + x for x in body))
    return pa.record_batch({"part": pa.array(out[0], pa.int32()), "body": pa.array(out[1], pa.binary())})


def _pack(held: list) -> pa.RecordBatch:
    """A row for each bucket: its super-k-mers' numbers, then their words joined by spaces, all compressed."""
    bucket, real, *numbers = (np.concatenate(x) for x in held[:6])
    strings = np.full(len(bucket), None, object)
    strings[real] = held[6]
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    out = ([], [])
    for i, j in zip(edge, [*edge[1:], len(order)][: len(edge)], strict=True):
        at = order[i:j]
        text = b" ".join(strings[at[real[at]]].tolist())
        parts = [C.squeeze(x[at]) for x in (real.astype(np.uint8), *numbers)] + [C.squeeze(np.frombuffer(text, np.uint8))]
        out[0].append(int(bucket[at[0]]))
        out[1].append(b"".join(len(x).to_bytes(4, "little") + x for x in parts))
    return pa.record_batch({"bucket": pa.array(out[0], pa.int32()), "body": pa.array(out[1], pa.binary())})


def _unpack(body: bytes) -> tuple:
    real, doc, key, first, last, text = (C.unsqueeze(x) for x in C.parts(body))
    return real.astype(bool), doc, key, first, last, text.tobytes()


def _mark(text: bytes, doc, key, first, last, window: int) -> tuple:
    """Sort a bucket's windows; mark those that an equal one precedes. Windows are sorted in turns by their hash, so that
    a turn has few of them; equal windows share a turn."""
    data = np.frombuffer(text, np.uint8)
    start, end, _ = C.words(data, np.array([0, len(data)]))
    h = C.gram_hash(C.word_hash(data, start, end), window)
    n = (last - first).astype(np.int64)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    begin = np.cumsum(n) - n
    places = np.flatnonzero(row[: len(h)] == row[window - 1 :]).astype(np.int32)
    turns = -(-len(places) // _TURN)
    turn = ((h >> np.uint64(32)) % np.uint64(max(1, turns))).astype(np.int32)[places]
    found = [(row[:0], first[:0])]
    for t in range(turns):
        at = places[turn == t]
        r = row[at]
        found.append(_later(text, data, start, end, h[at], at, r, (at - begin[r] + first[r]).astype(np.int32), doc, window))
    row, p = (np.concatenate(x) for x in zip(*found, strict=True))
    d, k = doc[row], key[row]
    order = np.lexsort((p, k, d))
    d, p, k = d[order], p[order], k[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (p[1:] - p[:-1] > 1)
    i = np.flatnonzero(new)
    final = p[np.append(i[1:], len(d)) - 1] + window if len(d) else p
    return d[i], k[i], p[i], final


def _later(text: bytes, data, start, end, h, at, row, pos, doc, window: int) -> tuple:
    """Row and position of each of these windows (h: hash, at: first word) that an equal one precedes."""
    order = np.lexsort((pos, doc[row], h))
    h, row, pos, at = h[order], row[order], pos[order], at[order]
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    a, b = start[at], end[at + window - 1]
    group = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    pairs = np.flatnonzero(same)
    if len(pairs) and not _equal(data, a[pairs], b[pairs], a[group[pairs]], b[group[pairs]]):  # equal hashes of unequal windows: tell them apart by their bytes
        seen: dict[bytes, int] = {}
        group = np.array([seen.setdefault(text[x:y], i) for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True))])
    later = (doc[row] != doc[row[group]]) | (pos != pos[group])
    return row[later], pos[later]


def _equal(data, a, b, c, d) -> bool:
    if not np.array_equal(b - a, d - c):
        return False
    for i in range(0, len(a), 4_000):
        size = (b - a)[i : i + 4_000]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if not np.array_equal(data[at + np.repeat(a[i : i + 4_000], size)], data[at + np.repeat(c[i : i + 4_000], size)]):
            return False
    return True


def cut_repeats(docs: DataFrame, window: int = 20, mini: int = 4) -> DataFrame:
    """docs with spans (first, last: words that are covered by earlier windows), n_words, n_removed and kept_words (the words left, joined by one space)."""
    docs = docs.drop("spans", "n_words", "n_removed", "kept_words")
    spans = marked_spans(docs, window, mini)
    spans = spans.withColumnsRenamed({"doc_id": "__fl_doc", "text_key": "__fl_key"})
    fields = docs.schema.fields
    keyed = docs.withColumns({"__fl_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "__fl_text": F.xxhash64("text")})
    joined = C.shrunk(keyed).join(spans, (F.col("__fl_id") == F.col("__fl_doc")) & (F.col("__fl_text") == F.col("__fl_key")), "left").drop("__fl_id", "__fl_text", "__fl_doc", "__fl_key")

    def cutting(batches):
        for b in (x.slice(i, _ROWS) for x in batches for i in range(0, x.num_rows, _ROWS)):
            texts = [None if x is None else C.unsqueeze(x).tobytes() for x in b.column("text").to_pylist()]
            total, removed, kept = [], [], []
            for text, spans in zip(texts, b.column("spans").to_pylist(), strict=True):
                got = (text or b"").split()
                gone = np.zeros(len(got), bool)
                for x in spans or ():
                    gone[x["first"] : x["last"]] = True
                total.append(len(got))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([got[k] for k in np.flatnonzero(~gone)] if removed[-1] else got))
            whole = {n: b.column(n) for n in b.schema.names} | {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.record_batch(whole | {"n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_words": pa.array(kept, pa.binary()).cast(pa.string())})

    own = [f for f in joined.schema.fields if f.name == "spans"]
    more = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_words", T.StringType())]
    return joined.mapInArrow(cutting, T.StructType([*fields, *own, *more]))
