"""The filter replay against a plain one, on odd rows, copies and an empty table."""

from collections import Counter
from itertools import permutations

import numpy as np
import plain
import pytest

from filingloom.llm import common, filter_audit


def fails(rows):
    """rows (doc_id, text): the letters that each fails."""
    out = []
    for d, t in rows:
        t = t or ""
        w = plain.words(t)
        low = [x for x, y in rows if (y or "") == t and x is not None]
        smaller = bool(low) if d is None else any(x < d for x in low)
        found = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t), smaller)
        out.append("".join(x for x, y in zip("ABCDE", found) if y))
    return out


def replayed(rows, good, toxic):
    """rows (doc_id, text, part): {(part, order, step): counts}."""
    out, shapley = Counter(), Counter()
    letters = fails([r[:2] for r in rows])
    for (d, _, part), f in zip(rows, letters):
        for p in permutations("ABCDE"):
            hit = False
            for s, x in enumerate(p, 1):
                here, key = x in f, (part or "", "".join(p), s)
                removed = here and not hit
                out[key, "redundant"] += here and hit
                hit |= here
                for name, v in (("kept", not hit), ("removed", removed), ("unique_fails", f == x), ("good_lost", removed and d in good), ("toxic_lost", removed and d in toxic)):
                    out[key, name] += v
                shapley[part or "", x] += removed
    keys = {(part or "", "".join(p), s) for _, _, part in rows for p in permutations("ABCDE") for s in range(1, 6)}
    return {k: (*(out[k, c] for c in filter_audit.COUNTS), shapley[k[0], k[1][k[2] - 1]]) for k in keys}


def seen(df):
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): (*(r[c] for c in filter_audit.COUNTS), r["shapley"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_replay(spark):
    many = " ".join(f"w{i}" for i in range(250))
    rows = [(1, many, "en"), (2, many, "en"), (3, many, "de"), (4, many.upper(), "de"), (5, many + " #", "en"), (6, "w " * 300, ""), (7, "SHOUT", None), (8, "", None), (9, None, "en"), (10, "a" * 64, "en"), (11, "A" + "é" * 32, "en"), (None, many, "en"), (None, "lone", "fr"), (12, "x", "en"), (12, "x", "en")]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, lang string, mask string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (2, 0, 1), (7, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert seen(filter_audit.audit(docs, labels)) == replayed(rows, {1, 2}, {2, 7})


def test_odd_rows(spark):
    rows = [r[:3] for r in plain.ODD]
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    assert seen(filter_audit.audit(plain.odd(spark), labels)) == replayed(rows, {1}, {6})
    assert filter_audit.audit(plain.none(spark), labels).count() == 0
    assert len(seen(filter_audit.audit(plain.odd(spark), labels.where("false"), part="source"))) == 600 * 4


def test_pieces_of_long_texts(monkeypatch):
    texts = [b"Aa bb cc aa bb " * 40 + "ünï#".encode() * 30, b"", b"x y z", b"Q" * 700]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = filter_audit.masks(data, off, filter_audit.Limits(words=300))
    monkeypatch.setattr(common, "SLICE", 64)
    assert filter_audit.masks(data, off, filter_audit.Limits(words=300)).tolist() == whole.tolist()
    for t in texts:
        parts = [t[a:b] for a, b in common.whole_words(np.frombuffer(t, np.uint8), 64)]
        assert b"".join(parts) == t and [w for p in parts for w in p.split()] == t.split()


def test_other_numbers_of_filters(spark):
    flags = spark.createDataFrame([("p", 0b01, 2, True, False), ("p", 0b11, 1, False, False)], "part string, mask int, n long, good boolean, toxic boolean")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["shapley"]) for r in filter_audit.replay(flags, "XY").collect()}
    assert got == {("XY", 1): (0, 3, 0, 2, 2, 5), ("XY", 2): (0, 0, 1, 0, 0, 1), ("YX", 1): (2, 1, 0, 0, 0, 1), ("YX", 2): (0, 2, 1, 2, 2, 5)}
    with pytest.raises(ValueError):
        filter_audit.orders(spark, "ABCDEFG")
