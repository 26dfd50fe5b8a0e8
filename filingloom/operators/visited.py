"""A filter of what has been visited, before the exact anti-join.

The filter is a blocked Bloom filter: a key's hash names a block of 512 bits and eight bits in it. It is kept as pages of
blocks, a row a page, and built page by page: hashes travel to their page's task, eight bytes a key. Pages of later keys
are merged into it by or, so it grows with what is new. Its size follows the number of keys, up to `most` bytes; beyond
that it lets more through, and stays right, as whatever it lets through meets the exact anti-join. As its size is bounded it
is sent to the tasks whole, and a key that it doesn't know moves nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import saved

#: Bytes of a block and of a page.
BLOCK, PAGE = 64, 1 << 16
_BITS = 8
_PAGES = "page int, bits binary"


def pages_for(n: int, most: int = 32 << 20, bits: int = 12) -> int:
    """Pages of a filter for n keys, a power of two."""
    want = max(1, -(-n * bits // (8 * PAGE)))
    return min(1 << (want - 1).bit_length(), max(1, most // PAGE))


def hashed(*keys: Column) -> Column:
    return F.xxhash64(*keys)


def _places(h: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """Each hash's block, and its bits' places in the block."""
    h = h.astype(np.int64).view(np.uint64)
    block = (h >> np.uint64(32)) % np.uint64(pages * (PAGE // BLOCK))
    g = h * np.uint64(0x9E3779B97F4A7C15)
    shift = np.arange(_BITS, dtype=np.uint64) * np.uint64(7)
    return block.astype(np.int64), ((g[:, None] >> shift) & np.uint64(511)).astype(np.int64)


def built(keys: DataFrame, pages: int) -> DataFrame:
    """page and bits of the hashes in the column h."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            block, bit = _places(b.column("h").to_numpy(zero_copy_only=False), pages)
            page, at = block // (PAGE // BLOCK), (block % (PAGE // BLOCK))[:, None] * BLOCK + bit // 8
            for p in np.unique(page).tolist():
                own = page == p
                np.bitwise_or.at(held.setdefault(p, np.zeros(PAGE, np.uint8)), at[own].ravel(), (1 << (bit[own] % 8)).astype(np.uint8).ravel())
        yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["page", "bits"])

    # as _places() has it
    block = F.pmod(F.shiftrightunsigned("h", 32), F.lit(pages * (PAGE // BLOCK)))
    dealt = keys.select("h").repartition(F.floor(block / (PAGE // BLOCK)))
    return merged(dealt.mapInArrow(run, _PAGES))


def merged(pages: DataFrame) -> DataFrame:
    """Pages of one filter, those of a number put together by or."""

    def run(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return pa.table({"page": table.column("page").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    return pages.groupBy("page").applyInArrow(run, _PAGES)


def body_of(filter_: DataFrame, pages: int) -> np.ndarray:
    """The filter (page, bits) as one array of pages * PAGE bytes."""
    body = np.zeros(pages * PAGE, np.uint8)
    for r in filter_.toLocalIterator():
        body[r["page"] * PAGE : (r["page"] + 1) * PAGE] = np.frombuffer(r["bits"], np.uint8)
    return body


def known(body: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The places in h (unsigned) of hashes that the filter may know, as `_places` has them; a bit is only looked at for
    those that the bits before let through."""
    block, g = (h >> np.uint64(32)) & np.uint64(len(body) // BLOCK - 1), h * np.uint64(0x9E3779B97F4A7C15)
    at, base = np.arange(len(h)), (block * np.uint64(BLOCK)).astype(np.int64)
    for k in range(_BITS):
        bit = ((g >> np.uint64(7 * k)) & np.uint64(511)).astype(np.int64)
        kept = np.flatnonzero((body[base + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1)
        at, base, g = at[kept], base[kept], g[kept]
    return at


def marked(df: DataFrame, hash_: Column, filter_: DataFrame, pages: int, name: str = "maybe") -> DataFrame:
    """df with whether the filter (page, bits) may know the row's hash."""
    body = body_of(filter_, pages)
    shared = df.sparkSession.sparkContext.broadcast(body)
    columns, given = df.columns, df.withColumn("__h", hash_)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, bit = _places(b.column("__h").to_numpy(zero_copy_only=False), pages)
            known = ((shared.value[block[:, None] * BLOCK + bit // 8] >> (bit % 8)) & 1).all(1) if b.num_rows else np.zeros(0, bool)
            yield pa.record_batch([*(b.column(c) for c in columns), pa.array(known)], names=[*columns, name])

    return given.mapInArrow(run, T.StructType([*df.schema, T.StructField(name, T.BooleanType())]))


def unvisited(candidates: DataFrame, visited: DataFrame, keys: list[str], most: int = 32 << 20) -> DataFrame:
    """The candidates whose keys visited (keys) doesn't have, as a left anti-join has them. Null keys are in no visited row."""
    past = visited.select(*keys).dropna()
    pages = pages_for(past.count(), most)
    known = built(past.select(hashed(*(F.col(k) for k in keys)).alias("h")), pages)
    seen = saved(marked(candidates, hashed(*(F.col(k) for k in keys)), known, pages, "__maybe"))
    check = seen.where("__maybe").drop("__maybe").join(past, keys, "left_anti")
    return seen.where("not __maybe").drop("__maybe").unionByName(check.select(*candidates.columns))
