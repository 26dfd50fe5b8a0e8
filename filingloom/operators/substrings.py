"""Substring join: which of many patterns stand in which texts.

Each pattern is filed under one of its q-grams, the one that the fewest texts have. A text's q-grams fetch the patterns filed
under them, and only fetched patterns are looked for in the text. A pattern shorter than q is its own gram, and texts are
cut into grams of each length that occurs.

The index has a row a pattern. Up to `most` rows it is broadcast: grams are made, looked up and verified as one stage that
moves nothing, and the text is never copied.

More patterns share their grams, so that each text would fetch many that it hasn't. Then patterns of up to LONGEST
characters are known by a filter (visited.py, at most FILTER bytes) of their hashes: all runs of a text that are as long as some pattern
are hashed in arrays, a length at a time, and those that the filter lets through meet the patterns in an exact join. Only
those runs and the keys move. The time follows the texts times the number of different lengths. Patterns that are longer
are filed under grams, and met by a shuffle of the texts' keys and grams, each gram over `salts` tasks, as a gram may stand
in most texts; what is fetched is verified beside the text.

Compared as given: who wants no case lowers both. Null texts and null or empty patterns match nothing; equal patterns are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import saved
from . import visited

#: Index rows that are broadcast at most.
MOST = 20_000
#: Characters of a pattern that is known by its hash, bytes of the filter of hashes, characters that are hashed at once.
LONGEST, FILTER, CHARACTERS = 64, 128 << 20, 1 << 16


def grams(chars: Column, n: int) -> Column:
    """The different runs of n characters, from an array of characters that is a column."""
    at = F.transform(F.sequence(F.lit(0), F.size(chars) - n), lambda i: F.concat(*(F.get(chars, i + k) for k in range(n))))
    return F.when(F.size(chars) >= n, F.array_distinct(at)).otherwise(F.array().cast("array<string>"))


def _cut(df: DataFrame, text: str, lengths: list[int]) -> DataFrame:
    """df with __gram, a row for each different gram of the text."""
    cut = df.withColumn("__chars", F.split(F.col(text), ""))
    every = reduce(lambda a, b: F.concat(a, b), (grams(F.col("__chars"), n) for n in lengths))
    return cut.select(*df.columns, F.explode(every).alias("__gram"))


def index(patterns: DataFrame, texts: DataFrame, text: str, q: int = 3, every: int = 16) -> DataFrame:
    """pattern and gram: each pattern under its rarest gram, by the texts whose hash is a multiple of `every`."""
    known = patterns.select("pattern").where(F.length("pattern") > 0).distinct()
    size = F.least(F.length("pattern"), F.lit(q))
    cut = reduce(lambda a, b: a.unionByName(b), (_cut(known.where(size == n), "pattern", [n]) for n in range(1, q + 1)))
    some = texts.select(F.col(text).alias("__text")).where(F.pmod(F.xxhash64("__text"), F.lit(every)) == 0)
    seen = _cut(some, "__text", list(range(1, q + 1))).groupBy("__gram").agg(F.count("*").alias("__n"))
    counted = cut.join(seen, "__gram", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    return counted.groupBy("pattern").agg(F.min_by("__gram", F.struct("__n", "__gram")).alias("gram"))


def _hashes(texts: list[str], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """n, places and hashes of all runs of n characters within texts, for n up to `longest`; places are in the texts put
    one after the other."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    at, h = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
    left = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts]) - at
    for n in range(1, longest + 1):
        if not (keep := left >= n).all():
            at, h, left = at[keep], h[keep], left[keep]
        if not len(at):
            return
        h = h * np.uint64(0x2545F4914F6CDD1D) + chars[at + (n - 1)]
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        yield n, at, mixed ^ (mixed >> np.uint64(32))


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """The texts (null: empty) in runs of CHARACTERS at most, or one text, with the place of the first."""
    first, own, size = 0, [], 0
    for k, t in enumerate(texts):
        t = t or ""
        if own and size + len(t) > CHARACTERS:
            yield first, own
            first, own, size = k, [], 0
        own.append(t)
        size += len(t)
    if own:
        yield first, own


def _by_hash(texts: DataFrame, keys: list[str], text: str, known: DataFrame) -> DataFrame:
    """matches() of different patterns (known) of up to LONGEST characters."""
    lengths = {r[0] for r in known.select(F.length("pattern")).distinct().collect()}  # LONGEST rows at most

    def hashed(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, own in _slices(b.column("pattern").to_pylist()):
                size, got = np.array([len(t) for t in own]), np.zeros(len(own), np.uint64)
                starts = np.cumsum(size) - size
                for n, at, h in _hashes(own, int(size.max())):
                    whole = np.flatnonzero(size == n)
                    got[whole] = h[np.searchsorted(at, starts[whole])]
                yield pa.record_batch([pa.array(got.view(np.int64))], names=["h"])

    pages = visited.pages_for(known.count(), FILTER, 32)
    body = visited.body_of(visited.built(known.mapInArrow(hashed, "h long"), pages), pages)
    shared = texts.sparkSession.sparkContext.broadcast(body)
    given = texts.select(*keys, F.col(text).alias("__text"))

    def runs(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, own in _slices(b.column("__text").to_pylist()):
                whole, ends, found = "".join(own), np.cumsum([len(t) for t in own]), set()
                for n, at, h in _hashes(own, max(lengths)):
                    if n in lengths:
                        at = at[visited.known(shared.value, h)]
                        found.update((k, whole[p : p + n]) for k, p in zip(np.searchsorted(ends, at, "right").tolist(), at.tolist(), strict=True))
                rows = b.slice(first, len(own)).take(pa.array([k for k, _ in found], pa.int64()))
                yield pa.record_batch([*(rows.column(c) for c in keys), pa.array([t for _, t in found], pa.string())], names=[*keys, "pattern"])

    some = given.mapInArrow(runs, T.StructType([*(given.schema[c] for c in keys), T.StructField("pattern", T.StringType())]))
    return some.join(known.hint("merge"), "pattern").select(*keys, "pattern")


def matches(texts: DataFrame, keys: list[str], text: str, patterns: DataFrame, q: int = 3, most: int = MOST, salts: int = 8, every: int = 16) -> DataFrame:
    """keys and pattern for each pattern (column pattern) that stands in a text. keys tell the rows of texts apart."""
    known = saved(patterns.select("pattern").where(F.length("pattern") > 0).distinct())
    if known.count() > most:
        short, longer = known.where(F.length("pattern") <= LONGEST), known.where(F.length("pattern") > LONGEST)
        found = [] if short.isEmpty() else [_by_hash(texts, keys, text, short)]
        found += [] if longer.isEmpty() else [_by_gram(texts, keys, text, longer, q, most, salts, every)]
        return reduce(lambda a, b: a.unionByName(b), found)
    return _by_gram(texts, keys, text, known, q, most, salts, every)


def _by_gram(texts: DataFrame, keys: list[str], text: str, patterns: DataFrame, q: int, most: int, salts: int, every: int) -> DataFrame:
    filed = saved(index(patterns, texts, text, q, every).withColumnRenamed("pattern", "__pattern"))
    facts = filed.groupBy(F.length("gram").alias("n")).agg(F.count("*").alias("rows")).collect()  # q rows at most
    held = texts.select(*keys, F.col(text).alias("__text"))
    if not facts:
        return held.select(*keys, F.lit("").alias("pattern")).limit(0)
    lengths = sorted(r["n"] for r in facts)
    if sum(r["rows"] for r in facts) <= most:
        found = _cut(held, "__text", lengths).join(F.broadcast(filed), F.col("__gram") == F.col("gram"))
    else:
        salt = F.pmod(F.xxhash64(*keys), F.lit(salts))
        filed = filed.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        fetched = _cut(held, "__text", lengths).select(*keys, "__gram", salt.alias("__of"))
        fetched = fetched.join(filed.hint("merge"), (F.col("__gram") == F.col("gram")) & (F.col("__of") == F.col("__salt"))).select(*keys, "__pattern")
        found = fetched.join(held.hint("merge"), keys)
    return found.where(F.contains("__text", "__pattern")).select(*keys, F.col("__pattern").alias("pattern"))
