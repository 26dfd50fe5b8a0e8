"""Language-model scoring by deleted interpolation.

A token's probability mixes the maximum-likelihood estimates of its k-grams, k from `order` down to 1, and the uniform
one. The mixture weights depend on how often the longest context occurs (buckets by powers of two). They are learned by
expectation-maximisation on the counts of the tuning documents, against estimates from the other training documents;
the final estimates come from all training documents. Counts cover every document. Words and longer grams are
counted by hashes of as many bits as the size of the corpus asks for (_key_masks); each block of documents asks for the
totals of its own distinct grams, and keeps the counts of its tokens, from which weights and scores are taken.

A text's tokens are its words with A-Z lower-cased, then one end. A first token's context is the start, which occurs once
a training document.

Defined cases: a null or empty text is the end alone. Without training documents all counts are 0 and every token has
the uniform probability 1 / (V + 1) = 1. Without tuning tokens in a bucket its weights are even. Repeated rows and null
ids are documents of their own. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

_END, _START = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
_BUCKETS = 40
HELD, TUNE, TRAIN = 0, 1, 2


def tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each token."""
    data, off = C.utf8(texts)
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in C.slices(off):
        part = C.lower(data[off[i] : off[j]])
        start, end, row = C.words(part, off[i : j + 1] - off[i])
        n = np.bincount(row, minlength=j - i)
        h = np.full(len(row) + j - i, _END)
        h[np.arange(len(row)) + row] = C.word_hash(part, start, end)
        hashes.append(h)
        rows.append(np.repeat(np.arange(i, j), n + 1))
    return np.concatenate(hashes), np.concatenate(rows)


def grams(h: np.ndarray, row: np.ndarray, order: int) -> list[np.ndarray]:
    """For k from 1 to order, the hash of the k tokens that end at each token; starts stand before a text."""
    first = np.ones(len(h), bool)
    first[1:] = row[1:] != row[:-1]
    out = [h]
    for k in range(2, order + 1):
        before = np.empty_like(h)
        before[1:] = out[-1][:-1]
        before[first] = C.mix(np.array([_START + np.uint64(k)]))[0]
        out.append(C.mix(before * np.uint64(0x9E3779B97F4A7C15) + h * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)))
    return out


def _contexts(counts: list[np.ndarray], first: np.ndarray, tokens_total: int, texts_total: int) -> list[np.ndarray]:
    """For each k how often the context of the k-gram occurs."""
    out = [np.full(len(first), tokens_total, np.int64)]
    for c in counts[:-1]:
        before = np.empty_like(c)
        before[1:] = c[:-1]
        before[first] = texts_total
        out.append(before)
    return out


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(_BUCKETS - 1, np.ceil(np.log2(context.astype(np.float64) + 1))).astype(np.int64)


def _parts(counts, contexts, types: int) -> np.ndarray:
    """The estimates that are mixed, uniform first, a row for each."""
    return np.stack([np.full(len(counts[0]), 1 / (types + 1)), *(c / np.maximum(x, 1) for c, x in zip(counts, contexts, strict=True))])


def _key_masks(total_bytes: int, order: int) -> list[np.uint64]:
    """The bits that keys keep, by what the number of bytes takes: 12 more for longer grams, so that under one in 20,000
    shares its key with another at any size of corpus; 24 more for words, up to all 64, so that hardly any two do."""
    size = max(28, int(total_bytes).bit_length())
    return [np.uint64((1 << 64) - (1 << 64 - min(64, size + (12 if k else 24)))) for k in range(order)]


def score(docs: DataFrame, training: Column, tuning: Column, order: int = 3, steps: int = 20, **limits: int) -> DataFrame:
    """doc_id, held_out (not training), n_tokens, n_known, train_tokens, base_score and score of each row. tuning: which
    training rows set the weights; limits: those of common.shape()."""
    size = C.text_bytes(docs)
    part = F.when(~training, HELD).when(tuning, TUNE).otherwise(TRAIN)
    blocks, own = C.blocked(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), part.alias("part")], size, **limits)
    masks = _key_masks(size, order)

    def keyed(table) -> tuple[np.ndarray, list[np.ndarray]]:
        h, row = tokens(table.column("text"))
        return row, [g & mask for g, mask in zip(grams(h, row, order), masks, strict=True)]

    def keys(table):
        row, levels = keyed(table)
        kind = np.array(table.column("part"))[row]
        for g in levels:
            distinct, where = np.unique(g, return_inverse=True)
            yield distinct, [np.bincount(where[kind == k], minlength=len(distinct)) for k in (TRAIN, TUNE)]

    def look(table, answer):
        """A block's documents, and the counts of its tokens' grams: of all training rows, and for tuning rows without them."""
        row, levels = keyed(table)
        kind = np.array(table.column("part"))
        tuned = kind[row] == TUNE
        every, rest = [], []
        for level, g in enumerate(levels):
            train, tune = (x.astype(np.int64) for x in C.answers_of(answer, level))
            where = np.unique(g, return_inverse=True)[1]
            every += C.by_rank((train + tune)[where])
            rest.append(C.squeeze(C.narrow(train[where[tuned]])))
        ids = table.column("doc_id")
        body = C.packed(C.squeeze(ids.fill_null(0).to_numpy()), C.squeeze(ids.is_null().to_numpy()), C.squeeze(kind), C.squeeze(np.bincount(row, minlength=len(kind))), *every, *rest)
        sums = [x for x, k in zip(answer.column("sums").to_pylist(), answer.column("level").to_pylist(), strict=True) if x is not None and k == 0]
        sums = [sum(x) for x in zip(*sums, strict=True)] or [0, 0, 0]
        return pa.table({"texts": pa.array([[int((kind == k).sum()) for k in (TRAIN, TUNE)]]), "sums": pa.array([sums]), "body": pa.array([body], pa.binary())})

    answers = C.block_counts(blocks, keys, own, lambda totals: list(totals))
    looked = C.cut(blocks.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(look, "texts array<long>, sums array<long>, body binary"))
    row = looked.agg(*(F.coalesce(F.sum(F.col("texts")[k]), F.lit(0)) for k in range(2)), *(F.coalesce(F.sum(F.col("sums")[k]), F.lit(0)) for k in range(3))).first()
    texts, total, types = (row[0], row[0] + row[1]), (row[2], row[2] + row[3]), row[4]

    def observe(batches):
        for b in batches:
            for body in b.column("body").to_pylist():
                _, _, kind, n, *counts = map(C.unsqueeze, C.parts(body))
                counts = [c.astype(np.int64) for c in counts[2 * order :]]
                first = np.zeros(len(counts[0]), bool)
                first[np.cumsum(n[kind == TUNE]) - n[kind == TUNE]] = True
                seen = np.stack([*counts, *_contexts(counts, first, total[0], texts[0])[1:]])
                seen, times = np.unique(seen, axis=1, return_counts=True)
                yield pa.record_batch({"body": pa.array([C.packed(*(C.squeeze(C.narrow(x)) for x in (*seen, times)))], pa.binary())})

    weights = np.array([1.0, *[0.0] * order])[:, None].repeat(_BUCKETS, 1)
    if total[1]:
        tuned = C.cut(looked.where(F.col("texts")[1] > 0).select("body").mapInArrow(observe, "body binary"))
        weights = learn(tuned.coalesce(max(8, own.parts // 8)), order, total[0], types, steps)

    def rate(batches):
        for b in batches:
            for body in b.column("body").to_pylist():
                ids, null, kind, n, *counts = map(C.unsqueeze, C.parts(body))
                counts = [counts[2 * k][counts[2 * k + 1]].astype(np.int64) for k in range(order)]
                row = np.repeat(np.arange(len(n)), n)
                first = np.zeros(len(row), bool)
                first[np.cumsum(n) - n] = True
                contexts = _contexts(counts, first, total[1], texts[1])
                p = (weights[:, _bucket(contexts[-1])] * _parts(counts, contexts, types)).sum(0)
                base = np.log10((counts[0] + 0.1) / (total[1] + 0.1 * (types + 1)))
                known, base, model = (np.bincount(row, x, len(n)) for x in (counts[0] > 0, base, np.log10(p)))
                yield pa.record_batch({"doc_id": pa.array(ids, pa.int64(), mask=null), "held_out": pa.array(kind == HELD), "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known.astype(np.int64)),
                                       "train_tokens": pa.array(np.full(len(n), total[1], np.int64)), "base_score": pa.array(base), "score": pa.array(model)})

    return looked.select("body").mapInArrow(rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def learn(tuned: DataFrame, order: int, total: int, types: int, steps: int) -> np.ndarray:
    """The weights, a column for each bucket, uniform first, by expectation-maximisation over the observed tokens."""
    weights = np.full((order + 1, _BUCKETS), 1 / (order + 1))
    for _ in range(steps):

        def expect(batches, weights=weights):
            sums = np.zeros((order + 1, _BUCKETS))
            for b in batches:
                for body in b.column("body").to_pylist():
                    *seen, n = (C.unsqueeze(x).astype(np.int64) for x in C.parts(body))
                    contexts = [np.full(len(n), total), *seen[order:]]
                    bucket = _bucket(contexts[-1])
                    p = weights[:, bucket] * _parts(seen[:order], contexts, types)
                    p *= n / p.sum(0)
                    for k in range(order + 1):
                        sums[k] += np.bincount(bucket, p[k], _BUCKETS)
            yield pa.record_batch({"at": pa.array(range(sums.size), pa.int32()), "v": pa.array(sums.ravel())})

        sums = np.zeros((order + 1) * _BUCKETS)
        for at, v in tuned.mapInArrow(expect, "at int, v double").groupBy("at").agg(F.sum("v")).collect():
            sums[at] = v
        sums = sums.reshape(order + 1, _BUCKETS)
        now = np.where(sums.sum(0) > 0, np.maximum(sums / np.maximum(sums.sum(0), 1e-300), 1e-9), 1 / (order + 1))
        now /= now.sum(0)
        moved = np.abs(now - weights).max()
        weights = now
        if moved < 1e-4:
            break
    return weights
