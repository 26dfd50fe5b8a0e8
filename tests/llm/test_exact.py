"""Substring dedup, Jaccard join and decontamination against brute force, on odd rows, empty tables and random texts."""

import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from filingloom.llm import common, components, decontaminate, jaccard_join, substring_dedup


def made(seed, n=150):
    """Texts of few words, with copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.2:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.5:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(1, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 5, 19, 20, 21, 60, 200]))]
            if kind > 0.8:
                at = rng.randint(0, len(w))
                w[at:at] = passage[rng.randint(0, 20) :]
            texts.append(rng.choice([" ", "\n"]).join(w))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_cut_repeats(spark, seed):
    rows = made(seed)
    got = substring_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r["doc_id"], r["text"]): (r["n_words"], r["n_removed"], r["kept_words"]) for r in got} == {k: (*v[:2], v[3]) for k, v in plain.cut(rows).items()}


def test_cut_repeats_with_heavy_minimisers(spark, monkeypatch):
    rows = made(3)
    whole = substring_dedup._heavy

    def all_heavy(docs, window, mini, share):
        return whole(docs, window, mini, 1 << 20)

    monkeypatch.setattr(substring_dedup, "_heavy", all_heavy)
    got = substring_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["text"]): (r["n_words"], r["n_removed"], r["kept_words"]) for r in got} == {k: (*v[:2], v[3]) for k, v in plain.cut(rows).items()}


def test_cut_repeats_odd(spark):
    df = plain.odd(spark)
    got = substring_dedup.cut_repeats(df).collect()
    rows = [(r[0], r[1]) for r in plain.ODD]
    assert len(got) == len(rows)
    want = plain.cut(rows)
    assert all((r["n_words"], r["n_removed"], r["kept_words"]) == (*want[r["doc_id"], r["text"]][:2], want[r["doc_id"], r["text"]][3]) for r in got)
    assert got[0]["host"] == "host" and substring_dedup.cut_repeats(plain.none(spark)).count() == 0


def test_null_ids_are_dealt_out():
    import numpy as np

    key = np.arange(4000)
    part = substring_dedup._dealt(np.full(4000, substring_dedup._LAST), key) % np.uint64(16)
    assert np.bincount(part.astype(int), minlength=16).max() < 2 * 4000 / 16


def test_windows_are_sorted_in_turns(monkeypatch):
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 3, n) for n in rng.integers(4, 60, 40)]
    text = b" ".join(b" ".join(b"w%d" % x for x in w) for w in words)
    doc, last = rng.integers(0, 9, 40), np.array([len(w) for w in words], np.int32)
    found = []
    for turn in (10**6, 100, 1):
        monkeypatch.setattr(substring_dedup, "_TURN", turn)
        found.append([x.tolist() for x in substring_dedup._mark(text, doc, doc, 0 * last, last, 4)])
    assert found[0][0] and found[0] == found[1] == found[2]


def test_equal_hashes_are_told_apart():
    data = b"a b c a b c x y z"
    import numpy as np

    doc, key, first, last = substring_dedup._mark(data, np.array([1, 2, 3]), np.array([0, 0, 0]), np.array([0, 0, 0]), np.array([3, 3, 3]), 3)
    assert doc.tolist() == [2] and first.tolist() == [0] and last.tolist() == [3]
    buffer = np.frombuffer(data, np.uint8)
    assert not substring_dedup._equal(buffer, np.array([0]), np.array([5]), np.array([12]), np.array([17]))


@pytest.mark.parametrize(("seed", "limits"), [(4, {}), (5, {"block_bytes": 2000, "body_bytes": 200, "task_bytes": 1 << 20, "range_bytes": 700, "most_fan": 3})])
def test_groups(spark, seed, limits):
    rows = made(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), **limits).collect()}
    assert got == {d: x for (d, _), x in zip(rows, plain.groups(rows), strict=True)}


def test_groups_of_a_hub(spark):
    """Near copies that link to the original alone, one of which a set outside links to."""
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 40):
        w = list(base)
        for j in range(4):
            w[(k * 5 + 47 * j) % 200] = f"e{k}-{j}"
        rows.append((k, " ".join(w)))
    w = rows[7][1].split()
    w[100:104] = ["q1", "q2", "q3", "q4"]
    rows.append((99, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: x for (d, _), x in zip(rows, plain.groups(rows), strict=True)}


def test_groups_odd(spark):
    rows = [(r[0], r[1]) for r in plain.ODD]
    want = sorted(((d, *x) for (d, _), x in zip(rows, plain.groups(rows), strict=True)), key=repr)
    # a row that nothing links to keeps its own id, null included
    want = sorted(((d, n, c if c is not None else d) for d, n, c in want), key=repr)
    got = jaccard_join.groups(plain.odd(spark)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert jaccard_join.groups(plain.none(spark)).count() == 0


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    at = {}

    def find(x):
        at.setdefault(x, x)
        while at[x] != x:
            x = at[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            at[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in at}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def bench(seed, docs):
    rng = random.Random(seed)
    items = [(100 + i, " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(9)) for _ in range(rng.choice([3, 8, 13, 20, 40])))) for i in range(12)]
    rows = []
    for d, t in docs:
        w = t.split()
        if rng.random() < 0.5:
            x = rng.choice(items)[1].split()
            x = x[rng.randrange(max(1, len(x) - 12)) :]
            for _ in range(rng.randrange(4)):
                x[rng.randrange(len(x))] = "zz"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [v.upper() for v in x]
        rows.append((d, " ".join(w)))
    return rows, items


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_leaks(spark, block_words):
    rows, items = bench(7, made(7, 80))
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain.leaks(rows, items)
    got = decontaminate.leaks(docs, table, block_words=block_words)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and got.count() == len(want)
    assert {r["doc_id"] for r in decontaminate.clean(docs, table, block_words=block_words).collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_leaks_of_a_template(spark, monkeypatch):
    """Many items that begin alike, in many small batches of candidates; items given twice."""
    rng = random.Random(3)
    head = [f"h{k}" for k in range(15)]
    items = [(i, " ".join(head + [f"t{rng.randrange(40)}" for _ in range(12)])) for i in range(120)]
    rows = [(d, " ".join([f"x{rng.randrange(40)}" for _ in range(30)] + (head[: rng.randrange(16)] if d % 2 else []) + items[d][1].split()[rng.randrange(15) :] + ["end"])) for d in range(20)]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items + items[:30], "item_id long, text string")
    want = plain.leaks(rows, items)
    seeds = decontaminate.Seeds(items, 13, 2)
    monkeypatch.setattr(decontaminate, "_LINES", 7)
    data, off = common.utf8(pa.array([t for _, t in rows]))
    got = seeds.leaks(data, off)
    assert len(want) > 1000 and sorted(zip(got[0].tolist(), got[1].tolist())) == sorted(want)
    assert [d for d, x in enumerate(seeds.leaking(data, off)) if x] == sorted({d for d, _ in want})
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, table).collect()) == sorted(want)


def test_leaks_odd(spark):
    items = spark.createDataFrame([(1, "One TWO three"), (2, None), (None, "no id at all"), (4, "")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(plain.odd(spark), items).collect()), key=repr)
    assert got == sorted([(1, 1), (6, 1), (6, 1), (None, None)], key=repr)
    assert decontaminate.leaks(plain.none(spark), items).count() == 0 and decontaminate.leaks(plain.odd(spark), items.where("false")).count() == 0
    left = decontaminate.clean(plain.odd(spark), items)
    assert left.count() == len(plain.ODD) - 4 and left.columns == plain.odd(spark).columns


def test_masks_cover():
    from itertools import combinations

    for window, misses in ((13, 2), (10, 1), (20, 3), (5, 2)):
        masks = decontaminate.covering_masks(window, misses)
        for gone in combinations(range(window), misses):
            assert any(not any(s + k in gone for k in m) for m in masks for s in range(window - m[-1]))


def test_packed_arrays():
    import numpy as np

    for a in (np.array([], np.uint64), np.array([1, 5, 2**63], np.uint64), np.arange(1000, dtype=np.int32)):
        assert (common.unsqueeze(common.squeeze(a)) == a).all()
    a = np.sort(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64))
    assert (common.unsqueeze_sorted(common.squeeze_sorted(a)) == a).all()


def test_words_are_the_contracts(spark):
    texts = ["a\x1cb c\x0bd", "\u00a0x \u2003y", "", " lead trail ", "é\tü\r\nß"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r[0] for r in df.orderBy("i").select(common.n_words(F.col("text"))).collect()]
    assert got == [len(plain.words(t)) for t in texts]
    import numpy as np
    import pyarrow as pa

    data, off = common.utf8(pa.array(texts))
    _, _, row = common.words(data, off)
    assert np.bincount(row, minlength=len(texts)).tolist() == got
