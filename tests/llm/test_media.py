"""Progressive JPEG: exact round trips, general streams, odd rows."""

import cProfile
import hashlib
import zlib

import numpy as np
import plain
import pytest

from filingloom.llm import media


@pytest.mark.parametrize("n", [0, 1, 64, 65, 700, 20_000])
def test_payload(n):
    data = media.payload(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes())
    file = media.pack(data)
    size, parts = media.coefficients(file)
    assert media.unpack(parts, len(data)) == data and len(data) % 64 == 0 and len(data) >= 64
    assert media.rgb(size, parts).shape == (*size, 3)
    assert file.startswith(b"\xff\xd8") and file.endswith(b"\xff\xd9") and b"\xff\xc2" in file


@pytest.mark.parametrize("trial", range(12))
def test_general_streams(trial):
    """Sparse coefficients, odd sizes, sampling factors: codes, zero runs, ends of bands and refinements of all kinds."""
    rng = np.random.default_rng(trial)
    high, wide = (int(x) for x in rng.integers(1, 70, 2))
    factors = [[(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)], [(1, 1)]][trial % 3]
    hm, vm = max(h for h, _ in factors), max(v for _, v in factors)
    down, across = -(-high // (8 * vm)), -(-wide // (8 * hm))
    parts = []
    for h, v in factors:
        p = {"h": h, "v": v, "quant": rng.integers(1, 20, 64)}
        c = rng.integers(-60, 60, (down * v, across * h, 64)) * (rng.random((down * v, across * h, 64)) < rng.choice([0.02, 0.2, 0.6]))
        rows, columns = media._own((high, wide), p, hm, vm)
        c[rows:], c[:, columns:] = 0, 0
        parts.append(p | {"c": c.astype(np.int32)})
    size, got = media.coefficients(media.encode((high, wide), parts))
    assert size == (high, wide) and all((a["c"] == b["c"]).all() and (a["quant"] == b["quant"]).all() for a, b in zip(parts, got, strict=True))


def test_inverse_transform_and_colour():
    c = np.zeros((2, 2, 64), np.int32)
    c[0, 0, 0], c[0, 1, 1] = 80, 40
    parts = [{"h": 2, "v": 2, "c": c, "quant": np.full(64, 2)}, *({"h": 1, "v": 1, "c": np.zeros((1, 1, 64), np.int32), "quant": np.ones(64, int)} for _ in range(2))]
    parts[2]["c"][0, 0, 0] = 160  # Cr 20 above the middle
    got = media.rgb((16, 16), parts)
    assert (got[:8, :8, 0] == round(148 + 1.402 * 20)).all() and (got[:8, :8, 2] == 148).all()
    x = np.arange(8)
    wave = 128 + 80 * np.cos((2 * x + 1) * np.pi / 16) * 0.5 * np.sqrt(1 / 8)
    assert np.abs(got[0, 8:, 2].astype(float) - wave).max() <= 1


def test_restarts_and_interleaved_dc():
    """DC of three components in one scan, cut by restart markers, written by hand."""
    table = media._Table([0, 1, 5, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0], [0, 1, 2, 3, 4, 5])
    pieces, want = [], []
    for v in (3, -2, 7):
        w = media._Writer()
        for x in (v, 0, 0):
            size = abs(x).bit_length()
            w.code(table, size)
            if size:
                w.put(x if x > 0 else x + (1 << size) - 1, size)
        pieces.append(w.bytes())
        want.append(v)
    body = b"".join(p + (bytes([0xFF, 0xD0 + i]) if i < 2 else b"") for i, p in enumerate(pieces))
    head = media._marker(0xDB, bytes(1) + bytes([1] * 64)) + media._marker(0xC2, bytes([8, 0, 8, 0, 24, 3, 1, 0x11, 0, 2, 0x11, 0, 3, 0x11, 0])) + media._marker(0xC4, bytes(1) + bytes(table.counts) + bytes(table.symbols)) + media._marker(0xDD, bytes([0, 1]))
    file = b"\xff\xd8" + head + media._marker(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 0, 0])) + body + b"\xff\xd9"
    _, parts = media.coefficients(file)
    assert parts[0]["c"][0, :, 0].tolist() == want and not parts[1]["c"].any()


def test_columns(spark):
    stored = media.store(plain.odd(spark))
    got = media.facts(stored.drop("text")).collect()
    assert len(got) == len(plain.ODD)
    texts = {(r[0], len((r[1] or "").encode())): (r[1] or "").encode() for r in plain.ODD}
    for r in got:
        data = media.payload(texts[r["doc_id"], r["n_bytes"]])
        assert r["payload_sha256"] == hashlib.sha256(data).hexdigest() and r["payload_bytes"] == len(data) and r["tail_crc32"] == zlib.crc32(data[-64:])
    same = {r["feature"] for r in got if r["doc_id"] in (1, 6)}
    assert len(same) == 1
    opened = media.tensors(stored.limit(3)).collect()
    assert all(len(r["rgb"]) == r["height"] * r["width"] * 3 and r["error"] is None for r in opened)
    assert media.facts(media.store(plain.none(spark))).count() == 0


def test_damaged(spark):
    good = media.pack(media.payload(b"hello"))
    files = [None, b"", b"no", good[:100], good[:-40], bytes(good).replace(b"\xff\xc2", b"\xff\xc0")]
    got = media.tensors(spark.createDataFrame([(i, f) for i, f in enumerate(files)], "i int, media binary")).collect()
    assert all(r["rgb"] is None and r["error"] for r in got)


def test_files_of_several_images():
    data = media.payload(np.random.default_rng(3).integers(0, 256, 5000, dtype=np.uint8).tobytes())
    file = media.pack(data, 768, widest=2)
    found = list(media.images(file))
    assert len(found) == -(-len(data) // 768) and len({size[1] for size, _ in found}) == 1
    assert b"".join(media.unpack(parts, 768) for _, parts in found)[: len(data)] == data
    assert media.decode(file).shape == (sum(size[0] for size, _ in found), found[0][0][1], 3)
    got = media._fact(file, 5000)
    assert got[:3] == (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:])) and got[9] is None


def test_facts_of_bad_files(spark):
    good = media.pack(media.payload(b"some text"))
    rows = [(1, good, 9, "x"), (2, None, 9, "x"), (3, b"", 0, "x"), (4, good[:-40], 9, "x"), (5, b"\xff\xd8\xff", 1, "x"), (6, good, None, "x")]
    got = {r["id"]: r for r in media.facts(spark.createDataFrame(rows, "id long, media binary, n_bytes long, rgb string")).collect()}
    assert all((got[i]["payload_sha256"] is None) == (got[i]["error"] is not None) == (i in (2, 3, 4, 5)) for i in got)
    assert got[1]["rgb"] == got[6]["rgb"] and len(got[1]["rgb"]) == 3 * got[1]["height"] * got[1]["width"] and got[2]["media_bytes"] is None and got[3]["media_bytes"] == 0


def _texts(n):
    rng = np.random.default_rng(n)
    return [rng.integers(0, 256, int(k), dtype=np.uint8).tobytes() for k in rng.integers(0, 4000, n)]


def test_files_are_read_together(monkeypatch):
    """Small files share the transform, and what is found of one doesn't depend on those beside it."""
    texts = _texts(200)
    files = [(media.pack(media.payload(x)), len(x)) for x in texts]
    two = media.payload(bytes(range(256)) * 20)
    rows = [*files, (media.pack(two, 768, widest=2), len(two)), (None, 3), (b"", 0), (files[0][0][:-40], 9), (files[1][0] + files[199][0], 9), files[0]]
    calls, plain_rgbs = [], media.rgbs
    monkeypatch.setattr(media, "rgbs", lambda found: calls.append(len(found)) or plain_rgbs(found))
    together = media._facts(rows)
    assert sum(calls) >= 200 and len(calls) <= 10
    monkeypatch.setattr(media, "TOGETHER", 1)
    assert together == [media._fact(*row) for row in rows] and together[0] == together[-1]
    assert [r[-1] is not None for r in together[200:]] == [False, True, True, True, True, False]


def test_frames_that_cannot_be_shown():
    """A frame of two components, in the midst of good files, is the only one that fails."""
    good = media.pack(media.payload(b"some text"))
    part = {"h": 1, "v": 1, "quant": np.ones(64, np.int32), "c": np.zeros((1, 1, 64), np.int32)}
    bad = media.encode((8, 8), [part, {**part, "c": part["c"].copy()}])
    got = media._facts([(good, 9), (bad, 9), (good, 9)])
    assert got[0] == got[2] == media._fact(good, 9) and got[0][-1] is None and got[1][-1] and got[1][1] is None


def test_calls_for_a_file():
    """What a small file costs, counted in calls, which no machine's speed changes."""
    texts = _texts(64)
    profile = cProfile.Profile()
    profile.enable()
    files = [(media.pack(media.payload(x)), len(x)) for x in texts]
    got = media._facts(files)
    profile.disable()
    assert sum(x.callcount for x in profile.getstats()) < 1000 * len(texts)
    assert [r[1] for r in got] == [hashlib.sha256(media.payload(x)).hexdigest() for x in texts]


def test_bytes_stay():
    """The stored bytes and the tensor, as they were before files were read together."""
    row = media._fact(media.pack(media.payload(bytes(i * i % 251 for i in range(3000)))), 3000)
    assert (row[4], row[5]) == ("1c46cee96b35b2ab572968ce36f067ec67d4e91311f1e800107a12348476b9b2", "16x128:247464/270498/233529:ef2c2479")
