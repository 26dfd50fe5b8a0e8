"""Progressive JPEG columns.

`decode` reads a progressive JPEG (8 bits, Huffman coded; one or three components, sampling factors that divide the largest): each scan adds
its spectral band, at its successive-approximation step, to the components' coefficient arrays; the arrays are
dequantised and inverse-transformed in numpy, chroma is repeated to full resolution, and the result is an RGB tensor.

`encode` writes coefficient arrays as such a file: a scan of all DC coefficients, then two spectral bands of luma and one of
each chroma, each first without the lowest bit and then that bit. A table made for the scan holds just the symbols it uses, so
where a band's coefficients all have one size, a scan is a string of equal steps, which is read and written as an array;
refining bits after an end-of-band run are an array as well. Other streams are read symbol by symbol.

Payloads: a byte is stored as a coefficient with a fixed number of bits, 64 bytes as one 8 x 8 block, so the bytes that
are read back are exact. A long payload is a file of several images, one after another, which are written and read one by
one: what a task works with is bounded, beside the text, file and tensor themselves.

Defined cases: `pack` of a null text is that of the empty text, one block of zeros. `tensors` and `facts` of a null, empty
or damaged file have nulls and an error text. Rows are judged one by one, so repeats and null ids stay as they are; columns
are kept, but for those of the result's names. Most files are small, so what a numpy call costs is met once for many of
them: `facts` transforms the images of several files as one array, whose blocks don't bear on one another.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import zlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Where the zigzag order visits an 8 x 8 block.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_FROM_ZIGZAG = np.argsort(ZIGZAG)
_COSINE = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(1 / 8) if u == 0 else 0.5) for x in range(8)] for u in range(8)], np.float32)
_MARKER = re.compile(rb"\xff[^\x00]")
#: Bytes of a payload that one image holds; a longer payload is a file of several images.
TILE = 1 << 20
#: Spectral bands of the AC scans, of luma and of chroma.
BANDS, CHROMA_BANDS = ((1, 5), (6, 63)), ((1, 63),)


class Damaged(ValueError):
    """The bytes are no progressive JPEG that this reader knows."""


# --- bits ------------------------------------------------------------------------------------------------------------


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.raw = data.replace(b"\xff\x00", b"\xff")
        self.n = 8 * len(self.raw)
        self.unpacked: np.ndarray | None = None
        self.at = 0

    def take(self, n: int) -> int:
        if self.at + n > self.n:
            raise Damaged("a scan ends early")
        first, last = self.at >> 3, (self.at + n + 7) >> 3
        value = int.from_bytes(self.raw[first:last], "big") >> (8 * last - self.at - n)
        self.at += n
        return value & ((1 << n) - 1)

    def array(self, n: int) -> np.ndarray:
        if self.at + n > self.n:
            raise Damaged("a scan ends early")
        if self.unpacked is None:
            self.unpacked = np.unpackbits(np.frombuffer(self.raw, np.uint8))
        self.at += n
        return self.unpacked[self.at - n : self.at]


class _Table:
    """A Huffman table: counts of codes of each length, and their symbols in order."""

    def __init__(self, counts: list[int], symbols: list[int]) -> None:
        self.counts, self.symbols, self.codes, code, k = counts, symbols, {}, 0, 0
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                self.codes[length, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
        self.write = {s: lc for lc, s in self.codes.items()}
        self.longest = max((n for n, _ in self.codes), default=1)
        self.by_symbol = np.array([self.write.get(x, (0, 0)) for x in range(max(symbols, default=0) + 1)], np.int64)
        self.look: list[tuple[int, int] | None] | None = None

    def looked_up(self) -> list[tuple[int, int] | None]:
        """Length and symbol by the next `longest` bits."""
        if self.look is None:
            self.look = [None] * (1 << self.longest)
            for (length, code), symbol in self.codes.items():
                free = self.longest - length
                self.look[code << free : (code + 1) << free] = [(length, symbol)] * (1 << free)
        return self.look

    def read(self, bits: _Bits) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | bits.take(1)
            if (length, code) in self.codes:
                return self.codes[length, code]
        raise Damaged("no such code")


@functools.lru_cache(maxsize=64)
def _table(counts: bytes, symbols: bytes) -> _Table:
    """Files tend to hold the same few tables."""
    return _Table(list(counts), list(symbols))


def table_for(symbols: list[int]) -> _Table:
    """Codes for the symbols, the most common first; one symbol gets one bit. No code is all ones."""
    counts, length, left = [0] * 16, 1, len(symbols)
    if left > 3:
        length = (left).bit_length()
        counts[length - 1] = left
    else:
        for i in range(left):
            counts[i] = 1
    return _table(bytes(counts), bytes(symbols))


def _extend(v, size):
    return np.where(v < (1 << np.maximum(size, 1) - 1), v - (1 << size) + 1, v)


#: The value in a byte that is one bit of code and seven of value.
_SEVEN = _extend(np.arange(256, dtype=np.int32) & 127, 7).astype(np.int32)


# --- reading ---------------------------------------------------------------------------------------------------------


def coefficients(data: bytes) -> tuple[tuple[int, int], list[dict]]:
    """Height and width, and for each component its sampling factors, quantisation and coefficients (rows, columns, 64 in
    zigzag order) of the first image."""
    return _image(data, 0)[:2]


def images(data: bytes) -> Iterator[tuple[tuple[int, int], list[dict]]]:
    """The images that stand one after another in a file, one at a time."""
    at = 0
    while at < len(data) or not at:
        size, parts, at = _image(data, at)
        yield size, parts


def _image(data: bytes, at: int) -> tuple[tuple[int, int], list[dict], int]:
    """What coefficients() gives for the image that begins here, and where it ends."""
    if data[at : at + 2] != b"\xff\xd8":
        raise Damaged("no start of image")
    quant, dc, ac, parts, size, restart, at = {}, {}, {}, [], None, 0, at + 2
    while at + 2 <= len(data):
        if data[at] != 0xFF:
            raise Damaged("no marker")
        kind = data[at + 1]
        if kind == 0xD9:
            at += 2
            break
        end = at + 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : end], end
        if kind == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[65 + 64 * wide :]
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                (ac if body[0] >> 4 else dc)[body[0] & 15] = _table(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif kind == 0xC2:
            size = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            parts = [{"id": body[6 + 3 * i], "h": body[7 + 3 * i] >> 4, "v": body[7 + 3 * i] & 15, "q": body[8 + 3 * i]} for i in range(body[5])]
            if not parts or body[0] != 8 or 0 in size:
                raise Damaged("frame not supported")
            hm, vm = max(p["h"] for p in parts), max(p["v"] for p in parts)
            mcus = -(-size[0] // (8 * vm)), -(-size[1] // (8 * hm))
            for p in parts:
                p["c"] = np.zeros((mcus[0] * p["v"], mcus[1] * p["h"], 64), np.int32)
                p["own"] = _own(size, p, hm, vm)
        elif kind in (0xC0, 0xC1, 0xC3, 0xC9, 0xCA):
            raise Damaged("not a progressive Huffman frame")
        elif kind == 0xDD:
            restart = int.from_bytes(body[:2], "big")
        elif kind == 0xDA:
            at = _scan(data, at, body, parts, mcus if size else None, dc, ac, restart)
    if size is None:
        raise Damaged("no frame")
    for p in parts:
        p["quant"] = quant[p["q"]]
    return size, parts, at


def _own(size: tuple[int, int], part: dict, hm: int, vm: int) -> tuple[int, int]:
    """Rows and columns of blocks that a component needs for the image, without what fills up the last units."""
    high, wide = -(-size[0] * part["v"] // vm), -(-size[1] * part["h"] // hm)
    return -(-high // 8), -(-wide // 8)


def _scan(data: bytes, at: int, head: bytes, parts, mcus, dc, ac, restart) -> int:
    if mcus is None:
        raise Damaged("a scan before the frame")
    n = head[0]
    by_id = {p["id"]: p for p in parts}
    chosen = [(by_id[head[1 + 2 * i]], head[2 + 2 * i] >> 4, head[2 + 2 * i] & 15) for i in range(n)]
    lo, hi, high, low = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
    pieces = []
    while True:  # up to the next marker, cut at restarts
        found = _MARKER.search(data, at)
        if found is None:
            raise Damaged("no marker after a scan")
        end = found.start()
        pieces.append(data[at:end])
        if not 0xD0 <= data[end + 1] <= 0xD7:
            break
        at = end + 2
    if n > 1:
        total = mcus[0] * mcus[1]
        number = _blocks if total <= 1 << 12 else _blocks.__wrapped__  # only small arrays are held
        blocks = [number(mcus, p["v"], p["h"]) for p, _, _ in chosen]
    else:
        p, _, t = chosen[0]
        rows, columns = p["own"]
        total = rows * columns
        whole = p["c"].shape[1] == columns
    step = restart or total
    for i, piece in enumerate(pieces):
        a, b = i * step, min(total, (i + 1) * step)
        if a >= b:
            break
        bits = _Bits(piece)
        if lo == 0:
            if n == 1:
                k = np.arange(a, b)
                index = [(k // columns * p["c"].shape[1] + k % columns)[:, None]]
            else:
                index = [x[a:b] for x in blocks]
            _dc(bits, [(q, None if high else dc[x]) for q, x, _ in chosen], index, high, low)
        else:
            k = None if whole else np.arange(a, b)
            grid = p["c"].reshape(-1, 64)[a:b] if whole else p["c"][k // columns, k % columns]
            (_ac_refine if high else _ac_first)(bits, grid, ac[t], lo, hi, low)
            if not whole:
                p["c"][k // columns, k % columns] = grid
    return end


@functools.lru_cache(maxsize=64)
def _blocks(mcus: tuple[int, int], v: int, h: int) -> np.ndarray:
    """For every unit of an image, the numbers of a component's blocks in it."""
    k = np.arange(mcus[0] * mcus[1])[:, None]
    down, across = np.divmod(np.arange(v * h), h)
    return (k // mcus[1] * v + down) * (mcus[1] * h) + k % mcus[1] * h + across


def _differences(bits: _Bits, tables: list[_Table], n: int) -> list[int]:
    """n coded differences, the tables taken in turn."""
    raw, at, out = bits.raw + bytes(8), bits.at, []
    looks = [(t.looked_up(), 48 - t.longest, (1 << t.longest) - 1) for t in tables]
    for look, shift, mask in itertools.islice(itertools.cycle(looks), n):
        word, skip = int.from_bytes(raw[at >> 3 : (at >> 3) + 6], "big"), at & 7
        found = look[word >> (shift - skip) & mask]
        if found is None:
            raise Damaged("no such code")
        length, size = found
        v = word >> (48 - skip - length - size) & ((1 << size) - 1)
        out.append(v if not size or v >> (size - 1) else v - (1 << size) + 1)
        at += length + size
    if at > bits.n:
        raise Damaged("a scan ends early")
    bits.at = at
    return out


def _dc(bits: _Bits, chosen: list[tuple[dict, _Table | None]], index: list[np.ndarray], high: int, low: int) -> None:
    """chosen: components and their tables; index: for each of them its blocks' numbers in every unit."""
    n, turns = len(index[0]), [x.shape[1] for x in index]
    if high:
        got = bits.array(n * sum(turns)).astype(np.int32).reshape(n, -1) << low
    else:
        got = np.array(_differences(bits, [t for (_, t), k in zip(chosen, turns, strict=True) for _ in range(k)], n * sum(turns)), np.int64).reshape(n, -1)
    at = 0
    for (p, _), blocks in zip(chosen, index, strict=True):
        own = got[:, at : at + blocks.shape[1]]
        at += blocks.shape[1]
        flat = p["c"].reshape(-1, 64)
        flat[blocks, 0] = flat[blocks, 0] | own if high else np.cumsum(own.ravel()).reshape(own.shape) << low


def _ac_first(bits: _Bits, grid: np.ndarray, table: _Table, lo: int, hi: int, low: int) -> None:
    n = hi - lo + 1
    if table.counts[0] == 1 and len(table.symbols) == 1 and table.symbols[0] >> 4 == 0 and table.symbols[0] & 15:  # equal steps
        size = table.symbols[0] & 15
        if size == 7 and not bits.at and len(grid) * n <= len(bits.raw):  # steps of a byte
            grid[:, lo : hi + 1] = (_SEVEN << low)[np.frombuffer(bits.raw, np.uint8, len(grid) * n)].reshape(len(grid), n)
            return
        steps = bits.array(len(grid) * n * (1 + size)).reshape(-1, 1 + size)[:, 1:]
        grid[:, lo : hi + 1] = (_extend(steps @ (1 << np.arange(size)[::-1]), size) << low).reshape(len(grid), n)
        return
    run = 0
    for block in grid:
        if run:
            run -= 1
            continue
        k = lo
        while k <= hi:
            symbol = table.read(bits)
            zeros, size = symbol >> 4, symbol & 15
            if size:
                k += zeros
                if k > hi:
                    raise Damaged("a band runs over")
                v = bits.take(size)
                block[k] = (v if v >= 1 << (size - 1) else v - (1 << size) + 1) << low
                k += 1
            elif zeros == 15:
                k += 16
            else:
                run = (1 << zeros) - 1 + (bits.take(zeros) if zeros else 0)
                break


def _ac_refine(bits: _Bits, grid: np.ndarray, table: _Table, lo: int, hi: int, low: int) -> None:
    one = 1 << low

    def correct(cells: np.ndarray) -> np.ndarray:
        """The cells, those not zero moved away from zero by their bits."""
        if cells.all():
            move = (bits.array(len(cells)).astype(np.int32) << low) & ~np.abs(cells)
            sign = cells >> 31
            return cells + ((move ^ sign) - sign)
        some = np.flatnonzero(cells)
        if len(some):
            value = cells[some]
            move = bits.array(len(some)).astype(np.int32) * one
            cells[some] = value + np.where(value > 0, move, -move) * ((np.abs(value) & one) == 0)
        return cells

    i = 0
    while i < len(grid):
        block, k = grid[i], lo
        while k <= hi:
            symbol = table.read(bits)
            zeros, size = symbol >> 4, symbol & 15
            if not size and zeros < 15:
                run = (1 << zeros) + (bits.take(zeros) if zeros else 0)
                if k == lo:
                    grid[i : i + run, lo : hi + 1] = correct(grid[i : i + run, lo : hi + 1].ravel()).reshape(-1, hi - lo + 1)
                    i += run - 1
                    break
                block[k : hi + 1] = correct(block[k : hi + 1].copy())
                if run > 1:
                    grid[i + 1 : i + run, lo : hi + 1] = correct(grid[i + 1 : i + run, lo : hi + 1].ravel()).reshape(-1, hi - lo + 1)
                i += run - 1
                break
            new = (one if bits.take(1) else -one) if size else 0
            while k <= hi:
                if block[k]:
                    if bits.take(1) and not abs(int(block[k])) & one:
                        block[k] += one if block[k] > 0 else -one
                elif zeros == 0:
                    block[k] = new
                    k += 1
                    break
                else:
                    zeros -= 1
                k += 1
        i += 1


def rgb(size: tuple[int, int], parts: list[dict]) -> np.ndarray:
    """The full-resolution tensor: height, width, 3."""
    return rgbs([(size, parts)])[0]


def rgbs(found: list[tuple[tuple[int, int], list[dict]]]) -> list[np.ndarray]:
    """The tensors of several images, whose blocks and pixels are transformed together."""
    block = np.concatenate([p["c"].reshape(-1, 64) * p["quant"] for _, parts in found for p in parts])
    block = block[:, _FROM_ZIGZAG].astype(np.float32)
    block = _COSINE.T @ block.reshape(-1, 8, 8) @ _COSINE
    block += 128
    np.clip(np.rint(block, out=block), 0, 255, out=block)
    at, planes = 0, ([], [], [])
    for size, parts in found:
        hm, vm = max(p["h"] for p in parts), max(p["v"] for p in parts)
        own = []
        for p in parts:
            rows, columns = p["c"].shape[:2]
            plane = block[at : at + rows * columns].reshape(rows, columns, 8, 8).swapaxes(1, 2).reshape(rows * 8, columns * 8)
            at += rows * columns
            if vm > p["v"] or hm > p["h"]:
                plane = plane.repeat(vm // p["v"], 0).repeat(hm // p["h"], 1)
            own.append(plane[: size[0], : size[1]].ravel())
        y, cb, cr = own if len(own) > 1 else (own[0], *[np.full(size[0] * size[1], 128, np.float32)] * 2)
        for plane, pixels in zip(planes, (y, cb, cr), strict=True):
            plane.append(pixels)
    y, cb, cr = map(np.concatenate, planes)
    cb -= 128
    cr -= 128
    out = np.empty((len(y), 3), np.float32)
    np.add(y, 1.402 * cr, out=out[:, 0])
    np.subtract(y - 0.344136 * cb, 0.714136 * cr, out=out[:, 1])
    np.add(y, 1.772 * cb, out=out[:, 2])
    out = np.clip(np.rint(out, out=out), 0, 255, out=out).astype(np.uint8)
    ends = np.cumsum([h * w for (h, w), _ in found]).tolist()
    return [out[end - h * w : end].reshape(h, w, 3) for ((h, w), _), end in zip(found, ends, strict=True)]


def decode(data: bytes) -> np.ndarray:
    """The tensor of a file; those of several images of one width stand below one another."""
    return np.concatenate([rgb(*image) for image in images(data)])


# --- writing ---------------------------------------------------------------------------------------------------------


class _Writer:
    def __init__(self) -> None:
        self.bits: list[np.ndarray] = []

    def put(self, value: int, n: int) -> None:
        self.bits.append(np.array([value >> k & 1 for k in range(n - 1, -1, -1)], np.uint8))

    def code(self, table: _Table, symbol: int) -> None:
        length, code = table.write[symbol]
        self.put(code, length)

    def bytes(self) -> bytes:
        n = sum(map(len, self.bits))
        bits = np.concatenate([*self.bits, np.ones(-n % 8, np.uint8)])
        return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


def _marker(kind: int, body: bytes) -> bytes:
    return bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body


@functools.lru_cache(maxsize=256)
def _head(components: tuple[int, ...], table: _Table, ac: int, lo: int, hi: int, high: int, low: int) -> bytes:
    """What stands before a scan: its table, and what it holds."""
    codes = _marker(0xC4, bytes([16 * ac]) + bytes(table.counts) + bytes(table.symbols))
    body = bytes([len(components)]) + b"".join(bytes([c + 1, 0]) for c in components) + bytes([lo, hi, high << 4 | low])
    return codes + _marker(0xDA, body)


def _size(v: np.ndarray) -> np.ndarray:
    return np.frexp(v.astype(np.float64))[1]


def encode(size: tuple[int, int], parts: list[dict]) -> bytes:
    """parts: h, v, quant and c, as coefficients() gives them."""
    out = [b"\xff\xd8"]
    for i, p in enumerate(parts):
        out.append(_marker(0xDB, bytes([i]) + np.asarray(p["quant"], np.uint8).tobytes()))
    frame = b"".join(bytes([i + 1, p["h"] << 4 | p["v"], i]) for i, p in enumerate(parts))
    out.append(_marker(0xC2, bytes([8]) + size[0].to_bytes(2, "big") + size[1].to_bytes(2, "big") + bytes([len(parts)]) + frame))

    def scan(components, table, ac, lo, hi, high, low, stream):
        out.append(_head(components, table, ac, lo, hi, high, low) + stream)

    hm, vm = max(p["h"] for p in parts), max(p["v"] for p in parts)
    own = [_own(size, p, hm, vm) for p in parts]
    steps = []  # DC of all components in one scan, unit by unit
    for p in parts:
        rows, columns = p["c"].shape[:2] if len(parts) > 1 else own[0]
        v, h = (p["v"], p["h"]) if len(parts) > 1 else (1, 1)
        dc = p["c"][:rows, :columns, 0].reshape(rows // v, v, columns // h, h).swapaxes(1, 2).reshape(-1, v * h)
        own_steps = dc.flatten()
        own_steps[1:] -= dc.ravel()[:-1]
        steps.append(own_steps.reshape(dc.shape))
    step = np.concatenate(steps, 1).ravel()
    sizes = _size(step)
    table = table_for(np.flatnonzero(np.bincount(sizes)).tolist())
    writer = _Writer()
    writer.bits.append(_codes(step, sizes, table))
    scan(tuple(range(len(parts))), table, 0, 0, 0, 0, 0, writer.bytes())
    for i, p in enumerate(parts):
        for lo, hi in CHROMA_BANDS if i else BANDS:
            grid = p["c"][: own[i][0], : own[i][1]].reshape(-1, 64)[:, lo : hi + 1]
            size = np.abs(grid)
            half = size >> 1
            stream, table = _band_first(half, grid < 0)
            scan((i,), table, 1, lo, hi, 0, 1, stream)
            stream, table = _band_rest(grid, half, (size & 1).astype(np.uint8))
            scan((i,), table, 1, lo, hi, 1, 0, stream)
    return b"".join(out) + b"\xff\xd9"


def _codes(values: np.ndarray, sizes: np.ndarray, table: _Table) -> np.ndarray:
    """The bits of each value's code and of the value."""
    low = np.where(values < 0, values + (1 << sizes) - 1, values)
    length = table.by_symbol[sizes]
    n = length[:, 0] + sizes
    whole = (length[:, 1] << sizes) | low
    ends = np.cumsum(n)
    shift = np.repeat(ends, n) - np.arange(1, 1 + (int(ends[-1]) if len(ends) else 0))
    return ((np.repeat(whole, n) >> shift) & 1).astype(np.uint8)


def _band_first(half: np.ndarray, below: np.ndarray) -> tuple[bytes, _Table]:
    """half: the coefficients without sign and lowest bit; below: those under zero."""
    writer = _Writer()
    size = int(half.max(initial=0)).bit_length()
    if half.size and size and int(half.min()).bit_length() == size:
        low = half ^ (below * np.int32((1 << size) - 1))
        if size == 7:  # with its code, a zero, a value is a byte
            return low.astype(np.uint8).tobytes(), table_for([size])
        bits = np.zeros((low.size, 1 + size), np.uint8)
        for k in range(size):
            bits[:, 1 + k] = low.ravel() >> (size - 1 - k) & 1
        writer.bits.append(bits.ravel())
        return writer.bytes(), table_for([size])
    first = np.where(below, -half, half)
    stream: list[tuple[int, int, int]] = []
    for block, own in zip(first.tolist(), _size(first).tolist(), strict=True):
        zeros = 0
        for v, s in zip(block, own, strict=True):
            if not s:
                zeros += 1
                continue
            stream += [(0xF0, 0, 0)] * (zeros // 16)
            stream.append((zeros % 16 << 4 | s, v if v > 0 else v + (1 << s) - 1, s))
            zeros = 0
        if zeros:
            stream.append((0, 0, 0))
    table = table_for(sorted({s for s, _, _ in stream}))
    for symbol, v, n in stream:
        writer.code(table, symbol)
        if n:
            writer.put(v, n)
    return writer.bytes(), table


def _band_rest(grid: np.ndarray, first: np.ndarray, bit: np.ndarray) -> tuple[bytes, _Table]:
    """first: what the earlier scan holds, not zero where it has a value; bit: the lowest bits."""
    writer = _Writer()
    if first.all():  # only bits to add: runs of blocks without new coefficients
        table = table_for(sorted({_run(n)[0] << 4 for n in _runs(len(grid))}))
        at = 0
        for n in _runs(len(grid)):
            size, rest = _run(n)
            length, code = table.write[size << 4]
            writer.put(code << size | rest, length + size)
            writer.bits.append(bit[at : at + n].ravel())
            at += n
        return writer.bytes(), table
    stream: list[tuple[int, list[int]]] = []
    for values, old, bits in zip(grid.tolist(), first.tolist(), bit.tolist(), strict=True):
        new = [k for k, (v, o) in enumerate(zip(values, old, strict=True)) if v and not o]
        k = 0
        for at in new:
            zeros, more = 0, []
            while k < at:
                if old[k]:
                    more.append(bits[k])
                else:
                    zeros += 1
                    if zeros == 16:
                        stream.append((0xF0, more))
                        zeros, more = 0, []
                k += 1
            stream.append((zeros << 4 | 1, [int(values[at] > 0), *more]))
            k = at + 1
        if k < len(values):
            stream.append((0, [bits[j] for j in range(k, len(values)) if old[j]]))
    table = table_for(sorted({s for s, _ in stream}))
    for symbol, more in stream:
        writer.code(table, symbol)
        writer.bits.append(np.array(more, np.uint8))
    return writer.bytes(), table


def _runs(n: int) -> list[int]:
    return [32767] * (n // 32767) + ([n % 32767] if n % 32767 else [])


def _run(n: int) -> tuple[int, int]:
    size = n.bit_length() - 1
    return size, n - (1 << size)


# --- payloads --------------------------------------------------------------------------------------------------------


def payload(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


#: The coefficient of a byte: -255 to -128 and 128 to 255, eight bits each.
_EIGHT = np.array([x - 255 if x < 128 else x for x in range(256)], np.int32)


def pack(data: bytes, most: int = TILE, widest: int = 255) -> bytes:
    """A file whose coefficients are the bytes; their number is a multiple of 64. Four blocks of luma to one of each
    chroma; after as many full rows as `most` bytes make, another image of the same width begins."""
    across = max(1, min(widest, -(-len(data) // 384)))
    full = max(1, most // (384 * across)) * 384 * across
    return b"".join(_packed(data[i : i + full], across) for i in range(0, max(1, len(data)), full))


def _packed(data: bytes, across: int) -> bytes:
    down = max(1, -(-len(data) // (384 * across)))
    blocks = np.zeros((6 * across * down, 64), np.uint8)
    blocks.reshape(-1)[: len(data)] = np.frombuffer(data, np.uint8)
    c = _EIGHT[blocks]
    c[:, 0] = (blocks[:, 0].astype(np.int32) - 128) * 4
    n = across * down
    luma, cb, cr = c[: 4 * n], c[4 * n : 5 * n], c[5 * n :]
    parts = [{"h": 2, "v": 2, "c": luma.reshape(2 * down, 2 * across, 64)}, *({"h": 1, "v": 1, "c": x.reshape(down, across, 64)} for x in (cb, cr))]
    for p in parts:
        p["quant"] = np.ones(64, np.int32)
    return encode((16 * down, 16 * across), parts)


def unpack(parts: list[dict], n: int) -> bytes:
    """The first n bytes that the coefficients hold."""
    c = np.concatenate([p["c"].reshape(-1, 64) for p in parts])
    out = c.astype(np.uint8) - (c < 0)  # 255 is 1 less than 256
    out[:, 0] = c[:, 0] // 4 + 128
    return out.tobytes()[:n]


def _runs_of(sizes: list[int], rows: int, most: int = 2 * TILE) -> Iterator[tuple[int, int]]:
    """Runs of rows, at most so many and of about `most` bytes."""
    a, held = 0, 0
    for k, n in enumerate(sizes):
        if k > a and (k - a >= rows or held + n > most):
            yield a, k
            a, held = k, 0
        held += n
    if a < len(sizes):
        yield a, len(sizes)


def _lengths(column) -> list[int]:
    return [n or 0 for n in pc.binary_length(column).to_pylist()]


def store(docs: DataFrame) -> DataFrame:
    """docs with media (a file of the whole text's payload) and n_bytes (of the text)."""
    kept = docs.drop("media", "n_bytes")

    def run(batches):
        for b in batches:
            sizes = _lengths(b.column("text"))
            for i, j in _runs_of(sizes, 256):
                whole = b.slice(i, j - i)
                files = [pack(payload((whole.column("text")[k].as_py() or "").encode())) for k in range(j - i)]
                yield pa.record_batch({n: whole.column(n) for n in whole.schema.names} | {"media": pa.array(files, pa.binary()), "n_bytes": pa.array(sizes[i:j], pa.int64())})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("media", T.BinaryType()), T.StructField("n_bytes", T.LongType())]))


_UNREAD = (Damaged, KeyError, IndexError, ValueError)
_TENSOR = {"height": T.IntegerType(), "width": T.IntegerType(), "rgb": T.BinaryType(), "error": T.StringType()}


def _fields(kinds: dict) -> list[T.StructField]:
    return [T.StructField(n, t) for n, t in kinds.items()]


def _columns(rows: list[tuple], kinds: dict) -> dict:
    return {n: pa.array([r[k] for r in rows], to_arrow_type(t)) for k, (n, t) in enumerate(kinds.items())}


def tensors(media: DataFrame, column: str = "media") -> DataFrame:
    """media with height, width, rgb (bytes, row by row, three a pixel) and error."""
    kept = media.drop("height", "width", "rgb", "error")

    def read(data: bytes | None) -> tuple:
        try:
            t = decode(data or b"")
            return t.shape[0], t.shape[1], t.tobytes(), None
        except _UNREAD as e:
            return None, None, None, f"{type(e).__name__}: {e}"

    def run(batches):
        for b in batches:
            for i, j in _runs_of(_lengths(b.column(column)), 64):
                whole = b.slice(i, j - i)
                yield pa.record_batch({n: whole.column(n) for n in whole.schema.names} | _columns([read(x.as_py()) for x in whole.column(column)], _TENSOR))

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *_fields(_TENSOR)]))


_FACTS = {"payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(), "media_bytes": T.LongType(), "media_sha256": T.StringType(), "feature": T.StringType()}


#: Bytes of coefficients' payload that are transformed together.
TOGETHER = 1 << 17


class _Reading:
    """A file's facts, as far as its images have been seen."""

    def __init__(self, data: bytes | None, n: int | None) -> None:
        self.data, self.left = data, max(64, -(-(n or 0) // 64) * 64)
        self.digest, self.done, self.tail, self.tensor, self.sums, self.error = hashlib.sha256(), 0, b"", [], np.zeros(3, np.int64), None

    def fails(self, e: Exception) -> None:
        self.error, self.tensor = self.error or f"{type(e).__name__}: {e}", []

    def add(self, parts: list[dict], t: np.ndarray) -> None:
        if self.error:
            return
        if self.tensor and t.shape[1] != self.tensor[0].shape[1]:
            self.fails(Damaged("images of several widths"))
            return
        back = unpack(parts, self.left - self.done)
        self.digest.update(back)
        self.done, self.tail = self.done + len(back), back[-64:] or self.tail
        self.sums += t.reshape(len(t), -1).sum(0, dtype=np.uint32).reshape(-1, 3).sum(0, dtype=np.int64)
        self.tensor.append(t)

    def row(self) -> tuple:
        size, own = (None, None) if self.data is None else (len(self.data), hashlib.sha256(self.data).hexdigest())
        if self.error:
            return None, None, None, size, own, None, None, None, None, self.error
        high, width, raw = sum(map(len, self.tensor)), self.tensor[0].shape[1], b"".join(t.tobytes() for t in self.tensor)
        feature = f"{high}x{width}:{'/'.join(map(str, self.sums.tolist()))}:{zlib.crc32(raw):08x}"
        return self.done, self.digest.hexdigest(), zlib.crc32(self.tail), size, own, feature, high, width, raw, None


def _fact(data: bytes | None, n: int | None) -> tuple:
    """A file's facts, its tensor, and what is wrong with it; image by image."""
    return _facts([(data, n)])[0]


def _facts(files: list[tuple[bytes | None, int | None]]) -> list[tuple]:
    """The same for several files. Images wait until they are enough to be transformed together."""
    found, waiting, held = [_Reading(data, n) for data, n in files], [], 0

    def transform(some: list[tuple]) -> None:
        try:
            made = rgbs([(size, parts) for _, size, parts in some])
        except _UNREAD as e:
            if len(some) == 1:
                some[0][0].fails(e)
            else:  # one of them is at fault
                for x in some:
                    transform([x])
            return
        for (file, _, parts), t in zip(some, made, strict=True):
            file.add(parts, t)

    for file in found:
        try:
            for size, parts in images(file.data or b""):
                waiting.append((file, size, parts))
                held += sum(p["c"].size for p in parts)
                if held >= TOGETHER:
                    transform(waiting)
                    waiting, held = [], 0
        except _UNREAD as e:
            file.fails(e)
    if waiting:
        transform(waiting)
    return [file.row() for file in found]


def facts(media: DataFrame) -> DataFrame:
    """media (media, n_bytes, other columns) without media, with digests of what the files hold when read back, a feature
    of the decoded tensor, and the tensor as tensors() gives it. A null or damaged file has nulls and an error text."""
    added = _FACTS | _TENSOR
    kept = media.drop("media", *added).schema.fields
    names = [f.name for f in kept]

    def run(batches):
        for b in batches:
            for i, j in _runs_of(_lengths(b.column("media")), 64):
                whole = b.slice(i, j - i)
                rows = _facts(list(zip(whole.column("media").to_pylist(), whole.column("n_bytes").to_pylist(), strict=True)))
                yield pa.record_batch({n: whole.column(n) for n in names} | _columns(rows, added))

    return media.mapInArrow(run, T.StructType([*kept, *_fields(added)]))
