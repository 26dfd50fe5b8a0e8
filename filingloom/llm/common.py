"""Shared pieces: stage tables, vectorised tokenising and hashing, packed arrays, block-wise counting."""

from __future__ import annotations

import ctypes
import re
import tempfile
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that separate words: tab to carriage return, and the space.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes handled at once by the vectorised code; one longer document is handled alone.
SLICE = 1 << 20
_SAMPLE = 1 << 40


def _lean() -> None:
    """Have this process give arrays of a megabyte or more back to the system once they are freed. As it is, the C library
    keeps blocks of up to 32 MB, and Arrow's own pool more, so that workers that wait for tasks hold what old ones took."""
    pa.set_memory_pool(pa.system_memory_pool())
    if put := getattr(ctypes.CDLL(None), "mallopt", None):  # in the GNU C library alone
        for option in (-1, -3):  # M_TRIM_THRESHOLD, M_MMAP_THRESHOLD: setting them also ends their growth
            put(option, SLICE)


_lean()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the session's checkpoint folder and read it back: later steps neither recompute it nor lose it with an executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="stage-"))
    return df.checkpoint(eager=True)


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that is never broadcast, so that the driver doesn't build what grows with the data."""
    return df.hint("merge")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_bucket(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def row_key(df: DataFrame) -> Column:
    """A hash of all of a row's columns but maps and variants, which have none: rows that share it are as good as equal."""
    named = [f.name for f in df.schema.fields if not re.search(r'"(type": ?"map|variant)"', f.dataType.json())]
    return F.xxhash64(*(F.col(f"`{n}`") for n in named), F.lit("row"))


def sampled(df: DataFrame, n: int) -> DataFrame:
    """About n different rows of df and never many more, those of the smallest hashes, with the hash as __fl_k; all rows
    if there are fewer. Equal rows count as one."""
    keyed = df.withColumn("__fl_k", F.pmod(row_key(df), F.lit(_SAMPLE)))
    total = keyed.agg(F.approx_count_distinct("__fl_k")).first()[0]
    return keyed.where(F.col("__fl_k") < F.lit(int(min(1.0, (1.2 * n + 50) / max(total, 1)) * _SAMPLE))).dropDuplicates(["__fl_k"])


# --- vectorised text -------------------------------------------------------------------------------------------------


def utf8(texts) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column, or of one that shrunk() made, and the rows' offsets in them; nulls are empty."""
    if pa.types.is_binary(texts.type):
        rows = [unsqueeze(x) if x else np.zeros(0, np.uint8) for x in texts.to_pylist()]
        return np.concatenate([np.zeros(0, np.uint8), *rows]), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` bytes."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def pieces(data: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Where the parts of a text of at most `most` bytes begin and end, cut after white space; a longer run of other bytes
    is cut where the part ends."""
    at = 0
    while at < len(data):
        end = min(len(data), at + most)
        if end < len(data) and len(blank := np.flatnonzero(_SPACE[data[at:end]])):
            end = at + int(blank[-1]) + 1
        yield at, end
        at = end


def whole_words(data: np.ndarray, most: int = SLICE, blank: np.ndarray = _SPACE) -> Iterator[tuple[int, int]]:
    """As pieces(), but never within a word: a part that has no blank goes on to the next one."""
    at = 0
    while at < len(data):
        end = min(len(data), at + most)
        if end < len(data):
            if len(gaps := np.flatnonzero(blank[data[at:end]])):
                end = at + int(gaps[-1]) + 1
            else:
                while end < len(data) and not len(gaps := np.flatnonzero(blank[data[end : end + most]])):
                    end = min(len(data), end + most)
                end = end + int(gaps[0]) + 1 if end < len(data) else end
        yield at, end
        at = end


def words(data: np.ndarray, off: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word of the rows; blank: which bytes separate words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~blank[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    before[inner], after[inner - 1] = False, False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _draws(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes; done in slices, as it takes many times their size."""
    size = end - start
    upto = np.concatenate([[0], np.cumsum(size)])
    out, letters = np.zeros(len(start), np.uint64), _draws(seed, 256)
    for i, j in slices(upto):
        n, first = size[i:j], upto[i:j] - upto[i]
        at = np.arange(upto[j] - upto[i]) - np.repeat(first, n)
        power = np.cumprod(np.full(int(n.max()), 0x9E3779B97F4A7C15, np.uint64))
        value = letters[data[at + np.repeat(start[i:j], n)]]
        value *= power[at]
        out[i:j] = np.add.reduceat(value, first) + n.astype(np.uint64)
    return mix(out)


def gram_hash(h: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hashes of n consecutive word hashes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    c = _draws(seed * 1000 + n, n) | np.uint64(1)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total += h[k : len(h) - n + 1 + k] * c[k]
    return mix(total)


# --- packed arrays ---------------------------------------------------------------------------------------------------


def squeeze(a: np.ndarray) -> bytes:
    """Numbers as compressed bytes, equal bytes of all numbers side by side."""
    a = np.ascontiguousarray(a)
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + (pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True) if raw else b"")


def unsqueeze(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:4].decode().strip()), int.from_bytes(b[4:12], "little")
    if not n:
        return np.zeros(0, kind)
    raw = pa.decompress(b[12:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def unsqueeze_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(b), dtype=np.uint64)


def shrunk(df: DataFrame) -> DataFrame:
    """df with each text compressed, for exchanges of whole texts; utf8() reads it."""

    def run(batches):
        for b in batches:
            data, off = utf8(b.column("text"))
            valid = b.column("text").is_valid().to_pylist()
            texts = [squeeze(data[i:j]) if v else None for i, j, v in zip(off[:-1].tolist(), off[1:].tolist(), valid, strict=True)]
            yield pa.record_batch({n: b.column(n) for n in b.schema.names} | {"text": pa.array(texts, pa.binary())})

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in df.schema.fields]))


def unshrunk(df: DataFrame) -> DataFrame:
    """df as it was before shrunk()."""

    def run(batches):
        for b in batches:
            texts = [None if x is None else unsqueeze(x).tobytes() for x in b.column("text").to_pylist()]
            yield pa.record_batch({n: b.column(n) for n in b.schema.names} | {"text": pa.array(texts, pa.binary()).cast(pa.string())})

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, T.StringType()) if f.name == "text" else f for f in df.schema.fields]))


def parts(body: bytes) -> list[bytes]:
    """The byte strings, each after its length, that a body is made of."""
    out, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 4], "little")
        out.append(body[at + 4 : at + 4 + n])
        at += 4 + n
    return out


# --- counting keys of blocks of documents over the whole corpus ----------------------------------------------------
#
# Each block of documents lists its distinct 64-bit keys once, sorted, with its own counts, cut into ranges of the key
# space. The task of a range adds the counts of all blocks and sends each block the totals of its own keys, in the
# block's order. A key travels once per block however frequent it is, so no key is hot; ranges of hashes are even.
#
# A block can't be cut into ever more ranges, as their bodies would shrink to nothing. Where ranges would outgrow
# `range_bytes`, the lists go by way of cells: a cell adds up one wide range of `fan` blocks, cuts it into `fan` narrower
# ranges and asks on as a block of its own, and deals the answers to its blocks. So what a task holds is bounded at any
# size of input: blocks, cells and ranges alike grow in number only.


class Shape(NamedTuple):
    """How an input is dealt: partitions, blocks, ranges that a block is cut into, and the fan of each turn of cells."""

    parts: int
    blocks: int
    ranges: int
    fans: tuple[int, ...]


def shape(total_bytes: int, least: int, block_bytes: int = 8 << 20, body_bytes: int = 8 << 10, task_bytes: int = 64 << 20, range_bytes: int = 64 << 20, most_fan: int = 1024, most_parts: int = 20_000) -> Shape:
    # both sides of an exchange have them, so there can't be ever more; a task beyond that goes through more blocks, one at a time
    parts = max(least, min(most_parts, -(-int(total_bytes) // task_bytes)))
    blocks = max(2 * parts, -(-int(total_bytes) // block_bytes))
    ranges = max(1, min(3 * parts, int(total_bytes) // (blocks * body_bytes)))
    fans, have = [], ranges
    while total_bytes > have * range_bytes:
        fans.append(min(most_fan, -(-int(total_bytes) // (have * range_bytes))))
        have *= fans[-1]
    return Shape(parts, blocks, ranges, tuple(fans))


def blocked(docs: DataFrame, columns: list[Column], total_bytes: int, **limits: int) -> tuple[DataFrame, Shape]:
    """The columns with blk, a block number by hash of all columns; dealt by block. limits: those of shape()."""
    own = shape(total_bytes, partitions(docs.sparkSession), **limits)
    df = docs.select(*columns)
    blk = F.pmod(F.xxhash64(*df.columns), F.lit(own.blocks)).cast("int")
    return shrunk(df.withColumn("blk", blk)).repartition(own.parts, "blk"), own


def ranges_of(keys: np.ndarray, first: int, n: int, of: int) -> np.ndarray:
    """Where each of n ranges, from number `first` of `of`, begins in the sorted keys, and the end."""
    edges = np.array([(i << 64) // of for i in range(first + 1, first + n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]]).astype(np.int64)


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 up in the smallest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def by_rank(a: np.ndarray) -> tuple[bytes, bytes]:
    """Whole numbers of which few are frequent: the different ones, the most frequent first, and each one's rank there."""
    values, where, times = np.unique(a, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    return squeeze(narrow(values[order])), squeeze(narrow(rank[where]))


def packed(*arrays: bytes) -> bytes:
    """What parts() reads."""
    return b"".join(len(x).to_bytes(4, "little") + x for x in arrays)


_ASKED = "blk int, level int, rng int, body binary"
_ANSWERED = _ASKED + ", sums array<long>"


def _listed(keys: np.ndarray, counts: list[np.ndarray], first: int, n: int, of: int) -> Iterator[tuple[int, bytes]]:
    at = ranges_of(keys, first, n, of)
    for r in np.flatnonzero(np.diff(at)):
        part = slice(at[r], at[r + 1])
        yield first + int(r), packed(squeeze_sorted(keys[part]), *(squeeze(narrow(c[part])) for c in counts))


def _added(bodies: list) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Each list's keys, the distinct keys, where each key of the lists is among them, and their counts, kinds by keys."""
    asked = [parts(x.as_py()) for x in bodies]
    lists = [unsqueeze_sorted(x[0]) for x in asked]
    distinct, where = np.unique(np.concatenate(lists), return_inverse=True)
    totals = np.stack([np.bincount(where, np.concatenate([unsqueeze(x[1 + k]) for x in asked]), len(distinct)).astype(np.int64) for k in range(len(asked[0]) - 1)])
    return lists, distinct, where, totals


def _dealt(table: pa.Table, lists: list[np.ndarray], where: np.ndarray, got: list[np.ndarray], rng: int, sums: list | None) -> pa.Table:
    """A row for each row of the table: the answers to its keys; the sums in the first."""
    n, ends = table.num_rows, np.cumsum([len(x) for x in lists])
    bodies = [packed(*(squeeze(narrow(a[where[e - len(x) : e]])) for a in got)) for x, e in zip(lists, ends, strict=True)]
    level = table.column("level")[0].as_py()
    return pa.table({"blk": table.column("blk"), "level": pa.array([level] * n, pa.int32()), "rng": pa.array([rng] * n, pa.int32()), "body": pa.array(bodies, pa.binary()), "sums": pa.array([sums, *[None] * (n - 1)], pa.list_(pa.int64()))})


def block_counts(blocks: DataFrame, keys: Callable, own: Shape, answer: Callable) -> DataFrame:
    """keys(table) gives a block's levels: lists of (sorted distinct keys, counts of one or more kinds as rows).
    answer(totals) turns the totals of a range, kinds by keys, into the arrays of whole numbers that blocks get.
    Returns rows (blk, level, rng, body; in one row of a range sums: the total of each kind and the keys that any has),
    dealt by blk; answers_of() reads a block's."""

    def ask(table: pa.Table) -> pa.Table:
        out = {"blk": [], "level": [], "rng": [], "body": []}
        blk = table.column("blk")[0].as_py()
        for level, (ks, counts) in enumerate(keys(table)):
            for r, body in _listed(ks, counts, 0, own.ranges, own.ranges):
                for x, v in zip(out.values(), (blk, level, r, body), strict=True):
                    x.append(v)
        return pa.table(out, pa.schema([("blk", pa.int32()), ("level", pa.int32()), ("rng", pa.int32()), ("body", pa.binary())]))

    def add(table: pa.Table) -> pa.Table:
        lists, _, where, totals = _added(table.column("body"))
        sums = [*(int(t.sum()) for t in totals), int((totals.sum(0) > 0).sum())]
        return _dealt(table, lists, where, answer(totals), table.column("rng")[0].as_py(), sums)

    def settled(asked: DataFrame, have: int, fans: tuple[int, ...]) -> DataFrame:
        if not fans:
            return asked.repartition(own.parts, "level", "rng").groupBy("level", "rng").applyInArrow(add, _ANSWERED)
        fan, cell = fans[0], ["level", "rng", "cell"]

        def merge(table: pa.Table) -> pa.Table:
            _, distinct, _, totals = _added(table.column("body"))
            level, rng, cell = (table.column(c)[0].as_py() for c in ("level", "rng", "cell"))
            rows = list(_listed(distinct, list(totals), rng * fan, fan, have * fan))
            n = len(rows)
            return pa.table({"blk": pa.array([cell] * n, pa.int32()), "level": pa.array([level] * n, pa.int32()), "rng": pa.array([r for r, _ in rows], pa.int32()), "body": pa.array([b for _, b in rows], pa.binary())})

        def spread(table: pa.Table, got: pa.Table) -> pa.Table:
            lists, _, where, _ = _added(table.column("body"))
            sums = [x for x in got.column("sums").to_pylist() if x is not None]
            return _dealt(table, lists, where, answers_of(got), table.column("rng")[0].as_py(), [sum(x) for x in zip(*sums, strict=True)] if sums else None)

        cells = asked.withColumn("cell", F.floor(F.col("blk") / fan).cast("int")).repartition(own.parts, *cell)
        answers = settled(cells.groupBy(*cell).applyInArrow(merge, _ASKED), have * fan, fans[1:])
        back = answers.withColumnsRenamed({"blk": "cell", "rng": "part"}).withColumn("rng", F.floor(F.col("part") / fan).cast("int"))
        back = back.select("cell", "level", "rng", "part", "body", "sums").repartition(own.parts, *cell)
        return cells.groupBy(*cell).cogroup(back.groupBy(*cell)).applyInArrow(spread, _ANSWERED)

    asked = blocks.groupBy("blk").applyInArrow(ask, _ASKED)
    return settled(asked, own.ranges, own.fans).repartition(own.parts, "blk")


def answers_of(got: pa.Table, level: int | None = None) -> list[np.ndarray]:
    """A block's or cell's answers put together, of one level or of all rows."""
    order = got.column("part" if level is None else "rng").to_pylist()
    levels = got.column("level").to_pylist()
    rows = sorted((r, k) for k, (r, x) in enumerate(zip(order, levels, strict=True)) if level is None or x == level)
    columns = [[unsqueeze(y) for y in parts(got.column("body")[k].as_py())] for _, k in rows]
    return [np.concatenate(x) for x in zip(*columns, strict=True)]


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
