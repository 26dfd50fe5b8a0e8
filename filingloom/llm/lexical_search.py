"""Ranked lexical search: an inverted index in shards, searched by MaxScore.

index() reads each text once. A shard is a run of documents of about `shard_bytes` of text in the task that reads them, kept
as one row: document ids and lengths, the terms' hashes in order, and for each term its number of documents, its largest
count, the least length of its documents, and its postings (document, count). Nothing is shuffled, so no term is hot.

search() first adds up the numbers of documents and terms, and in how many documents each query term stands. Then each task
goes through its shards with the k best documents of each query so far. A term's upper bound in a shard is the score of its
largest count in its shortest document. With the terms in order of their bounds, the longest head whose bounds together
stay below the k-th best score is non-essential: no document that has only such terms can qualify. Postings of the other,
essential terms are added up; non-essential ones, the largest bound first, are only probed for documents that may still
reach the k-th score. The tasks' lists are then ranked.

Scores are whole numbers, as in the formula of score_parts(). Queries come in blocks of at most `block_words` words, so that
what tasks and driver get has a fixed bound; every block searches all shards. Terms are compared by 64-bit hashes.

Defined cases: a null or empty text has no terms; such documents count nowhere and such queries find nothing. Of equal
scores the smaller doc_id is first, a null doc_id last; rows that share a doc_id are documents of their own. Queries equal in
id and text are one; those that share only the id are ranked each on its own, under that id. A long text is read piece by
piece, cut between terms. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Bytes that separate terms: all of ASCII but digits and letters.
_GAP = np.zeros(256, bool)
_GAP[:128] = True
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_SHARD = "docs long, terms long, ids array<long>, body binary"
#: The share of a document's length in its score, of 100.
SLOPE = 90


class Shard(NamedTuple):
    """A shard as arrays: lengths by document; key, size, most and least by term; doc and count by posting."""

    length: np.ndarray
    key: np.ndarray
    size: np.ndarray
    most: np.ndarray
    least: np.ndarray
    doc: np.ndarray
    count: np.ndarray


def _sums(term: np.ndarray, row: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, rows and counts of the different pairs, by term and row."""
    order = np.lexsort((row, term))
    term, row = term[order], row[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(term))) if count is None else np.add.reduceat(count[order], first) if len(first) else count
    return term[first], row[first], count


def terms_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms (hashes), rows and counts."""
    found = []
    for i, j in C.slices(off):
        part = C.lower(data[off[i] : off[j]])
        whole = C.whole_words(part, blank=_GAP) if j == i + 1 else [(0, len(part))]
        for a, b in whole:
            start, end, row = C.words(part[a:b], np.array([0, b - a]) if j == i + 1 else off[i : j + 1] - off[i], _GAP)
            found.append(_sums(C.word_hash(part[a:b], start, end), row + i))
    none = np.zeros(0, np.int64)
    return _sums(*(np.concatenate(x) for x in zip((none.astype(np.uint64), none, none), *found, strict=True)))


def _packed(ids: pa.Array, term: np.ndarray, row: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    length = np.bincount(row, count, len(ids)).astype(np.int64)
    kept = np.flatnonzero(length)
    at = np.cumsum(length > 0) - 1
    key, first, size = np.unique(term, return_index=True, return_counts=True)
    most, least = (f.reduceat(x, first) if len(first) else x for f, x in ((np.maximum, count), (np.minimum, length[row])))
    body = C.packed(C.squeeze_sorted(key), *(C.squeeze(C.narrow(x)) for x in (size, length[kept], most, least, at[row], count)))
    return pa.record_batch({"docs": pa.array([len(kept)], pa.int64()), "terms": pa.array([int(length.sum())], pa.int64()), "ids": pa.array([ids.take(pa.array(kept)).to_pylist()], pa.list_(pa.int64())), "body": pa.array([body], pa.binary())})


def index(docs: DataFrame, shard_bytes: int = 8 << 20) -> DataFrame:
    """The shards of docs (doc_id, text), written to the checkpoint folder: docs and terms (how many), ids, body."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, ids, size = [], [], 0
        rows = 0
        for b in batches:
            data, off = C.utf8(b.column("text"))
            for i, j in C.slices(off):
                term, row, count = terms_of(data[off[i] : off[j]], off[i : j + 1] - off[i])
                held.append((term, row + rows, count))
                ids.append(b.column("doc_id").slice(i, j - i))
                rows += j - i
                size += int(off[j] - off[i])
                if size >= shard_bytes:
                    yield _packed(pa.concat_arrays(ids), *_sums(*(np.concatenate(x) for x in zip(*held, strict=True))))
                    held, ids, size, rows = [], [], 0, 0
        if held:
            yield _packed(pa.concat_arrays(ids), *_sums(*(np.concatenate(x) for x in zip(*held, strict=True))))

    return C.cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SHARD))


def _lists(body: bytes) -> Shard:
    packed = C.parts(body)
    key, size = C.unsqueeze_sorted(packed[0]), C.unsqueeze(packed[1]).astype(np.int64)
    length, most, least, doc, count = (C.unsqueeze(x) for x in packed[2:])
    return Shard(length.astype(np.int64), key, size, most.astype(np.int64), least.astype(np.int64), doc, count)


def _where(key: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Each sought key's place, or -1."""
    if not len(key):
        return np.full(len(sought), -1)
    at = np.minimum(np.searchsorted(key, sought), len(key) - 1)
    return np.where(key[at] == sought, at, -1)


class Queries:
    """A block of queries: ids; for each its terms, as places in the sorted vocabulary."""

    def __init__(self, items: list[tuple[int | None, str | None]]) -> None:
        self.ids = [i for i, _ in items]
        term, row, _ = terms_of(*C.utf8(pa.array([t for _, t in items], pa.string())))
        self.vocabulary, at = np.unique(term, return_inverse=True)
        order = np.argsort(row, kind="stable")
        self.terms = np.split(at[order], np.cumsum(np.bincount(row, minlength=len(items)))[:-1])[: len(items)]


def length_parts(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length brings into its scores."""
    return 100 - SLOPE + (SLOPE * length * n_docs) // n_terms


def score_parts(count: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a term's count in documents (length_parts) brings, before its weight."""
    return (1_000_000_000 * count) // (1000 * count + 8 * lengths)


def weights(n_docs: int, holding: np.ndarray) -> np.ndarray:
    """The weight of each term by the number of documents that hold it; 0 for one that none does."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) if n else 0 for n in holding.tolist()], np.int64)


class Best:
    """The k best documents of each query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.n = k, np.zeros(queries, np.int64)
        self.score, self.doc, self.null = np.zeros((queries, k), np.int64), np.zeros((queries, k), np.int64), np.zeros((queries, k), bool)

    def floor(self, q: int) -> int:
        """The least score that can still get in."""
        return max(1, int(self.score[q, -1])) if self.n[q] == self.k else 1

    def add(self, q: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        n = self.n[q]
        score, doc, null = (np.concatenate([a[q, :n], b]) for a, b in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.n[q] = n = len(order)
        self.score[q, :n], self.doc[q, :n], self.null[q, :n] = score[order], doc[order], null[order]


def max_score(shard: Shard, lengths: np.ndarray, places: np.ndarray, weight: np.ndarray, bound: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that score `least` or more, and their scores. places, weight, bound: of the query's terms that
    the shard has."""
    order = np.argsort(bound, kind="stable")
    places, weight, bound = places[order], weight[order], np.cumsum(bound[order])
    essential = int(np.searchsorted(bound, least, "left"))
    none = np.zeros(0, np.int64)
    if essential == len(places):
        return none, none
    ends = np.cumsum(shard.size)
    size, first = shard.size[places], (ends - shard.size)[places]
    n = size[essential:]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[essential:], n)
    doc = shard.doc[at]
    parts = np.repeat(weight[essential:], n) * score_parts(shard.count[at].astype(np.int64), lengths[doc])
    total = np.bincount(doc, parts, len(lengths)).astype(np.int64)
    live = np.flatnonzero(total)
    for i in range(essential - 1, -1, -1):
        live = live[total[live] + bound[i] >= least]
        if not len(live):
            return none, none
        holds = shard.doc[first[i] : first[i] + size[i]]
        near = np.minimum(np.searchsorted(holds, live), size[i] - 1)
        hit = holds[near] == live
        if hit.any():
            total[live[hit]] += weight[i] * score_parts(shard.count[first[i] + near[hit]].astype(np.int64), lengths[live[hit]])
    live = live[total[live] >= least]
    return live, total[live]


def blocks(items: DataFrame, block_words: int) -> Iterator[Queries]:
    """The queries (item_id, text), block by block."""
    n = 1 + (items.agg(F.sum(C.n_words(F.col("text")))).first()[0] or 0) // block_words
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    for b in range(n):
        got = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield Queries(sorted(((r[0], r[1]) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))


def _holding(shards: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each term of the vocabulary stands."""
    shared = shards.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for b in batches:
            for body in b.column("body").to_pylist():
                packed = C.parts(body)
                at = _where(C.unsqueeze_sorted(packed[0]), shared.value)
                total[at >= 0] += C.unsqueeze(packed[1]).astype(np.int64)[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    for r in shards.select("body").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["term"]] = r["n"]
    return out


def search(shards: DataFrame, items: DataFrame, k: int = 10, block_words: int = 1_000_000, task_terms: int = 100_000_000) -> DataFrame:
    """The k best documents of index()'s shards for each item (item_id, text): item_id, rank, doc_id, score."""
    spark = shards.sparkSession
    n_docs, n_terms = shards.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    # a task ranks k documents a query whatever it reads, so tasks read no less than task_terms
    dealt = shards.coalesce(max(C.partitions(spark), n_terms // task_terms))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(items, block_words) if n_docs else ():
        shared = spark.sparkContext.broadcast((block.ids, block.terms, block.vocabulary, weights(n_docs, _holding(dealt, block.vocabulary))))

        def run(batches, shared=shared) -> Iterator[pa.RecordBatch]:
            ids, terms, vocabulary, weight = shared.value
            terms = [t[weight[t] > 0] for t in terms]
            best = Best(len(ids), k)
            for b in batches:
                for docs, body in zip(b.column("ids"), b.column("body"), strict=True):
                    shard = _lists(body.as_py())
                    doc, null = docs.values.fill_null(0).to_numpy(zero_copy_only=False), docs.values.is_null().to_numpy(zero_copy_only=False)
                    lengths = length_parts(shard.length, n_docs, n_terms)
                    at = _where(shard.key, vocabulary)
                    bound = np.where(at >= 0, weight * score_parts(shard.most, length_parts(shard.least, n_docs, n_terms))[at], 0) if len(shard.key) else np.zeros(len(at), np.int64)
                    for q, t in enumerate(terms):
                        t = t[bound[t] > 0]
                        live, score = max_score(shard, lengths, at[t], weight[t], bound[t], best.floor(q))
                        if len(live):
                            best.add(q, score, doc[live], null[live])
            q = np.repeat(np.arange(len(ids)), best.n)
            some = np.arange(k) < best.n[:, None]
            yield pa.record_batch([pa.array(q.astype(np.int32)), pa.array([ids[x] for x in q.tolist()], pa.int64()), pa.array(best.doc[some], mask=best.null[some]), pa.array(best.score[some])], names=["query", "item_id", "doc_id", "score"])

        found = dealt.select("ids", "body").mapInArrow(run, "query int, item_id long, doc_id long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        out = out.unionByName(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
    return out
