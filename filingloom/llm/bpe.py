"""Byte-level BPE by replaying the merges over all words of a chunk of the corpus at once.

The pattern's matches ("words") cover a text, and none goes from other characters over to white space. So encode() cuts
texts before white space that follows a character which is none, and matches equal pieces once. The words that are no
token themselves are laid out one after another, a token a byte. An inverted index leads from each pair of neighbours that
the vocabulary knows (by the token it makes) to its positions. The merges are replayed by rank, the lowest first: each is
applied to all of its positions, and only the two neighbours of a position get new entries. Where a merge may bring up a
pair of a lower rank than its own, it is applied to the first position of each word alone before the index is asked again,
so that the order within a word is that of the word-by-word rule.

The words of a chunk (`chunk_bytes` of text) are encoded together, and pieces met before in the task are looked up, up to
`known` of them (and a fourth as many words), so memory is bounded whatever the text; a longer text is cut into chunks at
the same places. Nothing is shuffled. Pieces are found again by 64-bit hashes and each chunk's ids are decoded and compared;
should they differ (a hash shared by two pieces), its documents are encoded again without looking up.

Vocabulary files hold a token a line, base64 and rank; they are read by the driver and sent to the tasks, and may hold at
most `MOST` tokens. Ids are packed as little-endian unsigned 32-bit integers.

Defined cases: a null text is an empty one and has no ids; equal rows get equal ids; an empty table gives no rows; other
columns stay, but those named like the result's are replaced. One match as long as the whole text (letters without end)
is one word: it is merged whole, at some 150 bytes of memory a byte.
"""

from __future__ import annotations

import base64
import contextlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Tokens that a vocabulary may have.
MOST = 1 << 20
_ID = np.dtype("<u4")
# Letters and digits (first, last) that the regex package knows and the tables of Unicode 16 don't, by which
# the library classes characters. They count as neither.
LATER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2,
    0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5,
    0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09,
    0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0,
    0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
_LATER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER) + "]")


class Vocabulary:
    """Tokens by rank, and for each pair of tokens the token that it makes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing or len(ranks) > MOST:
            raise ValueError(f"a vocabulary has all bytes and at most {MOST} tokens" + f"; there is none for {missing[:5]}" * bool(missing))
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.wide = 1 + max(ranks.values())
        pairs = np.array(sorted((ranks[t[:i]] * self.wide + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks), np.int64).reshape(-1, 2)
        self.pair, self.made = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        # the lowest rank that a merge can bring up beside itself
        self.lowest = np.full(self.wide, self.wide)
        for side in (self.pair // self.wide, self.pair % self.wide):
            np.minimum.at(self.lowest, side, self.made)
        size = np.zeros(self.wide + 1, np.int64)
        for t, r in ranks.items():
            size[r + 1] = len(t)
        self.starts = np.cumsum(size)
        self.bytes = np.zeros(self.starts[-1], np.uint8)
        for t, r in ranks.items():
            self.bytes[self.starts[r] : self.starts[r + 1]] = np.frombuffer(t, np.uint8)
        #: Ids of the words that are a token themselves.
        self.whole = {}
        for t, r in ranks.items():
            with contextlib.suppress(UnicodeDecodeError):
                self.whole[t.decode()] = np.array([r], _ID).tobytes()

    def makes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or -1; a token of -1 makes none."""
        if not len(self.pair):
            return np.full(len(left), -1)
        key = left * self.wide + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)


@lru_cache(maxsize=2)
def vocabulary(lines: bytes) -> Vocabulary:
    """The vocabulary of a file's content; made once a worker."""
    return Vocabulary({base64.b64decode(t): int(r) for t, r in (x.split() for x in lines.splitlines() if x.strip())})


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y), in order, are merged if each takes its bytes from the next: every other one of a run."""
    run = np.ones(len(x), bool)
    run[1:] = y[:-1] != x[1:]
    k = np.arange(len(x))
    return (k - k[run][np.cumsum(run) - 1]) % 2 == 0


def merged(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all words, by replaying the merges over all words together, and how many each word has."""
    data = np.frombuffer(b"".join(words), np.uint8)
    n, ends = len(data), np.cumsum([len(w) for w in words])
    # position n stands for no neighbour
    token = np.append(v.byte[data], -1)
    before, after = np.arange(-1, n), np.append(np.arange(1, n + 1), n)
    after[ends - 1] = before[0] = n
    before[ends] = n
    made = np.append(v.makes(token[:-1], token[after[:-1]]), -1)
    order = np.argsort(made, kind="stable")
    order = order[np.searchsorted(made[order], 0) :]
    ranks, first = np.unique(made[order], return_index=True)
    places = {r: x.tolist() for r, x in zip(ranks.tolist(), np.split(order, first[1:]), strict=False)}  # with nothing to split there is one empty part
    waiting = ranks.tolist()
    while waiting:
        rank = heappop(waiting)
        x = np.array(places.pop(rank))
        x = x[made[x] == rank]  # others have met another neighbour since they were listed
        if not len(x):
            continue
        x.sort()
        x = x[np.diff(x, prepend=-1) > 0]
        if v.lowest[rank] < rank:  # a pair that comes up may have to come first: only the first of each word now
            word = np.searchsorted(ends, x, "right")
            later = np.diff(word, prepend=-1) == 0
            if later.any():
                places[rank] = x[later].tolist()
                heappush(waiting, rank)
                x = x[~later]
        y = after[x]
        if (y[:-1] == x[1:]).any():
            keep = _apart(x, y)
            x, y = x[keep], y[keep]
        z = after[y]
        token[x], token[y], made[y], after[x] = rank, -1, -1, z
        before[z] = x
        p = before[x]
        made[x], made[p] = v.makes(token[x], token[z]), v.makes(token[p], token[x])
        made[n] = -1
        for at in (x, p):
            for r, k in zip(made[at].tolist(), at.tolist(), strict=True):
                if r >= 0:
                    if r in places:
                        places[r].append(k)
                    else:
                        places[r] = [k]
                        heappush(waiting, r)
    live = token[:-1] >= 0
    return token[:-1][live].astype(_ID), np.diff(np.concatenate([[0], np.cumsum(live)])[np.append(0, ends)])


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SEEN = np.zeros(256, bool)
_SEEN[33:127] = True


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places before white space whose character before is surely none; no match of the pattern reaches over them."""
    n = len(data)
    solid = _SEEN[data]
    # the last byte of a character that is certainly no white space: lead bytes C3 to DF, E4 to EF, F0 on
    solid[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    solid[2:] |= (data[:-2] >= 0xE4) & (data[:-2] <= 0xEF)
    solid[3:] |= data[:-3] >= 0xF0
    return np.flatnonzero(_BLANK[data[1:]] & solid[: n - 1]) + 1


class Encoder:
    """Ids of pieces, with those met before in the task."""

    def __init__(self, v: Vocabulary, pattern: str, known: int) -> None:
        self.v, self.pattern, self.most = v, pattern, known
        self.matches = regex.compile(pattern)
        self.words = dict(v.whole)
        self._empty()

    def _empty(self) -> None:
        self.key, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.ids = np.zeros(1, np.int64), np.zeros(0, _ID)

    def find(self, text: str) -> list[str]:
        if not _LATER.search(text):
            return self.matches.findall(text)
        return [text[m.start() : m.end()] for m in self.matches.finditer(_LATER.sub("\ue000", text))]

    def _packed(self, words: list[str]) -> list[bytes]:
        """Each word's ids."""
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        if len(self.words) + len(new) > self.most // 4 + len(self.v.whole):
            self.words = dict(self.v.whole)
            new = [w for w in dict.fromkeys(words) if w not in self.words]
        if new:
            ids, size = merged([w.encode() for w in new], self.v)
            body, ends = ids.tobytes(), np.cumsum(size) * _ID.itemsize
            self.words.update((w, body[a:b]) for w, a, b in zip(new, [0, *ends[:-1].tolist()], ends.tolist(), strict=True))
        return list(map(self.words.__getitem__, words))

    def _pieces(self, pieces: list[str], inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each has. Inner pieces, which begin with white space and end before some, are
        matched in one go, as they could follow each other in a text."""
        joined = [p for p, i in zip(pieces, inner.tolist(), strict=True) if i]
        words = self.find("".join(joined))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        place = [np.flatnonzero(inner)[np.searchsorted(np.cumsum([len(p) for p in joined]), ends, "left")]]
        for k in np.flatnonzero(~inner).tolist():
            own = self.find(pieces[k])
            words += own
            place.append(np.full(len(own), k))
        place = np.concatenate(place)
        order = np.argsort(place, kind="stable")
        packed = self._packed([words[k] for k in order.tolist()])
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // _ID.itemsize
        return np.frombuffer(b"".join(packed), _ID), np.bincount(place[order], size, len(pieces)).astype(np.int64)

    def ids_of(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, and where each row's begin and end."""
        n = len(data)
        if not n:
            return np.zeros(0, _ID), np.zeros(len(off), np.int64)
        start = np.union1d(_cuts(data), off[:-1][np.diff(off) > 0])
        end = np.append(start[1:], n)
        key, first, where = np.unique(C.word_hash(data, start, end), return_index=True, return_inverse=True)
        if len(self.key) + len(key) > self.most:
            self._empty()
        at = np.searchsorted(self.key, key)
        new = np.ones(len(key), bool)
        near = at < len(self.key)
        new[near] = self.key[at[near]] != key[near]
        if new.any():
            raw, a, b = data.tobytes(), start[first[new]], end[first[new]]
            inner = _BLANK[data[a]] & ~np.isin(b, off)
            ids, size = self._pieces([raw[x:y].decode() for x, y in zip(a.tolist(), b.tolist(), strict=True)], inner)
            slots = len(self.start) - 1 + np.arange(len(size))
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])
            self.ids = np.concatenate([self.ids, ids])
            self.key, self.slot = np.insert(self.key, at[new], key[new]), np.insert(self.slot, at[new], slots)
        slot = self.slot[np.searchsorted(self.key, key)][where]
        size = self.start[slot + 1] - self.start[slot]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(upto[-1]) - np.repeat(upto[:-1] - self.start[slot], size)]
        return ids, upto[np.searchsorted(start, off)]

    def alone(self, data: np.ndarray) -> np.ndarray:
        """The ids of one text, nothing looked up."""
        return np.frombuffer(b"".join(Encoder(self.v, self.pattern, self.most)._packed(self.find(data.tobytes().decode()))), _ID)


def decoded(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The bytes of the tokens."""
    size = v.starts[ids.astype(np.int64) + 1] - v.starts[ids]
    upto = np.cumsum(size)
    return v.bytes[np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - size - v.starts[ids], size)]


def _chunks(data: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Parts of a long text of about `most` bytes, cut where the pattern is cut; one without such a place goes on to the next."""
    at = 0
    while at < len(data):
        end, reach = len(data), most
        while at + reach < len(data):
            if len(cuts := _cuts(data[at : at + reach])):
                end = at + int(cuts[-1])
                break
            reach *= 2
        yield at, end
        at = end


def _row(encoder: Encoder, data: np.ndarray, chunk_bytes: int) -> bytes:
    ids = []
    for a, b in _chunks(data, chunk_bytes):
        part = data[a:b]
        got = encoder.ids_of(part, np.array([0, b - a]))[0]
        ids.append((got if np.array_equal(decoded(got, encoder.v), part) else encoder.alone(part)).tobytes())
    return b"".join(ids)


def _file(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, chunk_bytes: int = 8 << 20, known: int = 2_000_000) -> DataFrame:
    """docs without text, with ids (binary) of the texts by the vocabulary file at `path` (on the driver)."""
    lines = _file(docs.sparkSession, path)
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("text", "ids")]
    read = docs.select("text", *(F.col(f"`{f.name}`") for f in kept))

    def run(batches) -> Iterator[pa.RecordBatch]:
        v = vocabulary(lines.value)
        encoder = Encoder(v, pattern, known)
        for b in batches:
            data, off = C.utf8(b.column(0))
            for i, j in C.slices(off, chunk_bytes):
                part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
                if len(part) > chunk_bytes:
                    rows = [_row(encoder, part, chunk_bytes)]
                else:
                    ids, ends = encoder.ids_of(part, at)
                    whole = np.array_equal(decoded(ids, v), part)
                    rows = [(ids[x:y] if whole else encoder.alone(part[s:e])).tobytes() for x, y, s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.record_batch([*(b.column(k + 1).slice(i, j - i) for k in range(len(kept))), pa.array(rows, pa.binary())], names=[*(f.name for f in kept), "ids"])

    return read.mapInArrow(run, T.StructType([*kept, T.StructField("ids", T.BinaryType())]))


def _packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a column of packed ids, and the rows' offsets in them; null is none."""
    rows = [x or b"" for x in column.to_pylist()]
    return np.frombuffer(b"".join(rows), _ID), np.cumsum([0, *(len(x) // _ID.itemsize for x in rows)])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (ids, others) with decoded: the bytes that the ids stand for. Null ids are none."""
    lines = _file(encoded.sparkSession, path)
    kept = [f for f in encoded.schema.fields if f.name.lower() not in ("ids", "decoded")]
    read = encoded.select("ids", *(F.col(f"`{f.name}`") for f in kept))

    def run(batches) -> Iterator[pa.RecordBatch]:
        v = vocabulary(lines.value)
        for b in batches:
            ids, off = _packed(b.column(0))
            for i, j in C.slices(off, C.SLICE):
                texts = [b"".join(decoded(ids[k : min(k + C.SLICE, y)], v).tobytes() for k in range(x, y, C.SLICE)) for x, y in zip(off[i:j].tolist(), off[i + 1 : j + 1].tolist(), strict=True)]
                yield pa.record_batch([*(c.slice(i, j - i) for c in b.columns), pa.array(texts, pa.binary())], names=[*b.schema.names, "decoded"])

    return read.mapInArrow(run, T.StructType([T.StructField("ids", T.BinaryType()), *kept, T.StructField("decoded", T.BinaryType())]))


def unpacked(encoded: DataFrame) -> DataFrame:
    """encoded with its packed ids as array<int>."""
    kept = [f for f in encoded.schema.fields if f.name.lower() != "ids"]
    read = encoded.select("ids", *(F.col(f"`{f.name}`") for f in kept))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, off = _packed(b.column(0))
            yield pa.record_batch([pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32))), *b.columns[1:]], names=b.schema.names)

    return read.mapInArrow(run, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), *kept]))
