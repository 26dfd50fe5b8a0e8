"""What each filter removes under every order of the filters: a direct replay of all documents.

Each document's failed filters are a bit mask. The masks are crossed with the broadcast table of orders (a row for each
permutation of at most `MOST` filters, so its size has a fixed bound), the first step that fails is the least position of a
failed filter, the steps of the order are exploded, and sums under conditions are combined in each task before anything
is shuffled: a task sends at most parts x orders x steps rows, whatever it has read.

Texts are read once. Words of long texts are counted piece by piece; distinct words by 64-bit hashes, within one text.
Equal texts are found by 128-bit hashes: the least doc_id of each text is combined in the tasks and joined back on doc_id and
text together, a key that no group of copies shares.

Defined cases: a null text is an empty one (no words, no capitals, no symbols; it fails the first filter, and duplicates
count). A null doc_id is larger than any other; rows equal in doc_id and text are no duplicates of each other, as neither id
is smaller, and each counts. A null part is the empty string. A document with several labels is good (toxic) if one of them
says so; labels without doc_id belong to no one. An empty table has no parts, hence no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Filters that are replayed at most: 120 orders of five, 720 of six.
MOST = 6
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


@dataclass(frozen=True)
class Limits:
    """The text filters, in the order of their bits; a document fails one that holds."""

    words: int = 200  # fewer words
    distinct_percent: int = 50  # a smaller share of distinct words
    capitals_percent: int = 3  # a larger share of A-Z among the characters
    symbols: bytes = b"#$%&*|"  # any of these


def _facts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and distinct words of each row."""
    n = len(off) - 1
    start, end, row = C.words(data, off)
    salt = C.mix(np.arange(1, n + 1, dtype=np.uint64))
    _, first = np.unique(C.mix(C.word_hash(data, start, end) + salt[row]), return_index=True)
    return np.bincount(row, minlength=n), np.bincount(row[first], minlength=n)


def _long(data: np.ndarray) -> tuple[int, int]:
    """Words and distinct words of one text, a piece at a time."""
    total, seen = 0, np.zeros(0, np.uint64)
    for a, b in C.whole_words(data):
        start, end, _ = C.words(part := data[a:b], np.array([0, b - a]))
        total += len(start)
        seen = np.union1d(seen, C.word_hash(part, start, end))
    return total, len(seen)


def masks(data: np.ndarray, off: np.ndarray, limits: Limits) -> np.ndarray:
    """Each row's failed text filters: bit 0 words, 1 distinct words, 2 capitals, 3 symbols."""
    n = len(off) - 1
    words, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    counted = [np.zeros(n, np.int64) for _ in range(3)]
    symbol = np.zeros(256, bool)
    symbol[list(limits.symbols)] = True
    for i, j in C.slices(off):
        part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
        if j == i + 1 and len(part) > C.SLICE:
            words[i], distinct[i] = _long(part)
            edges = [(x, np.array([0, len(x)])) for x in np.array_split(part, 1 + len(part) // C.SLICE)]
        else:
            words[i:j], distinct[i:j] = _facts(part, at)
            edges = [(part, at)]
        for x, ends in edges:
            for out, hit in zip(counted, ((x >= 65) & (x <= 90), (x & 0xC0) != 0x80, symbol[x]), strict=True):
                out[i:j] += np.diff(np.concatenate([[0], np.cumsum(hit)])[ends])
    capitals, points, symbols = counted
    fails = (words < limits.words, 100 * distinct < limits.distinct_percent * words, 100 * capitals > limits.capitals_percent * points, symbols > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def flagged(docs: DataFrame, part: str, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """doc_id, part, text_key and mask of each document: the text filters' bits, and above them that of duplicates. Rows
    equal in all of these are one, with their number n."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = C.utf8(b.column("text"))
            keys = [hashlib.blake2b(data[i:j], digest_size=16).digest() for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.record_batch([b.column("doc_id"), b.column("part"), pa.array(keys, pa.binary()), pa.array(masks(data, off, limits))], names=["doc_id", "part", "text_key", "mask"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text"))
    read = C.cut(plain.mapInArrow(run, "doc_id long, part string, text_key binary, mask int"))
    rows = read.groupBy("doc_id", "part", "text_key", "mask").agg(F.count("*").alias("n"))
    first = read.groupBy(F.col("text_key").alias("key")).agg(F.min("doc_id").alias("first"))
    joined = rows.join(C.merged(first), F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("text_key") == F.col("key")), "left")
    bit = F.lit(1 << 4)
    return joined.select("doc_id", "part", "text_key", F.when(F.col("key").isNull(), F.col("mask").bitwiseOR(bit)).otherwise(F.col("mask")).alias("mask"), "n")


def with_labels(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """flags with good and toxic. Rows without doc_id are dealt out by their text."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"), F.lit(0).cast("long").alias("label_salt"))
    known = known.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("text_key")).otherwise(0)
    joined = flags.join(C.merged(known), (F.col("doc_id") == F.col("label_id")) & (salt == F.col("label_salt")), "left")
    return joined.select(*flags.columns, *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")))


def orders(spark: SparkSession, filters: str) -> DataFrame:
    """Each order of the filters' letters: filter_order, the place of each filter (at0, at1, …), and steps: step, letter, bit."""
    if not 0 < len(filters) <= MOST or len(set(filters)) < len(filters):
        raise ValueError(f"filters: from one to {MOST} different letters")
    rows = []
    for p in permutations(range(len(filters))):
        rows.append(("".join(filters[k] for k in p), *(p.index(k) + 1 for k in range(len(p))), [(s, filters[k], 1 << k) for s, k in enumerate(p, 1)]))
    places = ", ".join(f"at{k} int" for k in range(len(filters)))
    return spark.createDataFrame(rows, f"filter_order string, {places}, steps array<struct<step:int,letter:string,bit:int>>")


def replay(flags: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """flags: part, mask (bit k: fails the k-th letter of filters), n (rows it stands for), good, toxic. Returns part,
    filter_order, step, letter, COUNTS and shapley, a row for each part, order and step."""
    mask, n = F.col("mask"), F.col("n")
    none = F.lit(len(filters) + 1)
    first = F.least(none, *(F.when(mask.bitwiseAND(F.lit(1 << k)) != 0, F.col(f"at{k}")).otherwise(none) for k in range(len(filters))))
    crossed = flags.select("part", "mask", "n", "good", "toxic").crossJoin(F.broadcast(orders(flags.sparkSession, filters)))
    steps = crossed.select("part", "mask", "n", "good", "toxic", "filter_order", first.alias("first"), F.explode("steps").alias("s")).select("*", "s.step", "s.letter", "s.bit")
    fails, removed = mask.bitwiseAND(F.col("bit")) != 0, F.col("first") == F.col("step")
    counts = {"kept": F.col("first") > F.col("step"), "removed": removed, "redundant": fails & (F.col("first") < F.col("step")), "unique_fails": mask == F.col("bit"), "good_lost": removed & F.col("good"), "toxic_lost": removed & F.col("toxic")}
    summed = steps.groupBy("part", "filter_order", "step", "letter").agg(*(F.sum(F.when(x, n).otherwise(0)).alias(c) for c, x in counts.items()))
    return summed.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """The replay of the four text filters and of duplicates over docs (doc_id, text, the part's column)."""
    return replay(with_labels(flagged(docs, part, limits), labels))
