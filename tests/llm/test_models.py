"""Language models, classifiers, mixing and URL rules: brute force, held-out accuracy, odd rows and empty tables."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import plain
import pytest
from pyspark.sql import functions as F

from filingloom.llm import common, language_id, linear, lm_score, mixing, quality, queries, toxicity, url_filter

DIR = "/root/testdata/sf0.01"


def test_base_scores(spark):
    rows = [(r[0], r[1]) for r in plain.ODD if r[0] not in (None, 5)] + [(i, f"the w{i % 3} of the w{i % 5}") for i in range(10, 60)]
    tenth = common.crc_bucket(F.col("doc_id"), 10)
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), tenth != 0, tenth == 1).collect()
    count = collections.Counter()
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 10:
            count.update([*plain.words(t, True), None])
    n, v = sum(count.values()), len(count)
    want = sorted((d, zlib.crc32(str(d).encode()) % 10 == 0, len(w) + 1, sum(count[x] > 0 for x in [*w, None]), n, round(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*w, None]), 6)) for d, t in rows for w in [plain.words(t, True)])
    assert sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want


#: Limits that deal a small input by way of two turns of cells.
CELLS = {"block_bytes": 400, "body_bytes": 40, "task_bytes": 1 << 20, "range_bytes": 150, "most_fan": 3}


def _plain_model(rows, order, steps=20):
    """Scores by deleted interpolation, from the contract alone: {id: log10 probability}."""
    part = {i: zlib.crc32(str(i).encode()) % 10 for i, _ in rows}
    token = {i: [*plain.words(t), "</s>"] for i, t in rows}

    def gram(t, i, k):
        return tuple((["<s>"] * k + t)[i + 1 : i + 1 + k])

    def counted(ids):
        c = collections.Counter(gram(token[i], j, k) for i in ids for j in range(len(token[i])) for k in range(1, order + 1))
        return c, sum(v for g, v in c.items() if len(g) == 1), len(ids)

    def estimates(t, j, counts, n, texts, types):
        context = [n] + [counts[gram(t, j - 1, k - 1)] if j else texts for k in range(2, order + 1)]
        bucket = min(lm_score._BUCKETS - 1, math.ceil(math.log2(context[-1] + 1)))
        return bucket, np.array([1 / (types + 1)] + [counts[gram(t, j, k)] / max(1, context[k - 1]) for k in range(1, order + 1)])

    every, rest = counted([i for i in part if part[i]]), counted([i for i in part if part[i] > 1])
    types = sum(len(g) == 1 for g in every[0])
    seen = [estimates(token[i], j, *rest, types) for i in part if part[i] == 1 for j in range(len(token[i]))]
    weights = np.full((lm_score._BUCKETS, order + 1), 1 / (order + 1))
    for _ in range(steps):
        sums = np.zeros_like(weights)
        for b, p in seen:
            sums[b] += weights[b] * p / (weights[b] * p).sum()
        now = np.where(sums.sum(1, keepdims=True) > 0, np.maximum(sums / np.maximum(sums.sum(1, keepdims=True), 1e-300), 1e-9), 1 / (order + 1))
        now /= now.sum(1, keepdims=True)
        moved, weights = np.abs(now - weights).max(), now
        if moved < 1e-4:
            break
    return {i: sum(math.log10((weights[b] * p).sum()) for j in range(len(t)) for b, p in [estimates(t, j, *every, types)]) for i, t in token.items()}


@pytest.mark.parametrize(("order", "limits"), [(2, {}), (3, {}), (3, CELLS)])
def test_interpolated_scores(spark, order, limits):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.6, rng.integers(1, 30)) if x < 200)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tenth = common.crc_bucket(F.col("doc_id"), 10)
    got = {r["doc_id"]: r["score"] for r in lm_score.score(docs, tenth != 0, tenth == 1, order, **limits).collect()}
    want = _plain_model(rows, order)
    assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-6 * max(1, abs(want[i])) for i in want)


def test_ranges_stay_small():
    """What a range, a cell, a block holds, and the number of bodies a block sends, from a megabyte to an exabyte."""
    for size in (10**k * m for k in range(6, 19) for m in (1, 3)):
        own = common.shape(size, 8)
        ranges = own.ranges * math.prod(own.fans)
        assert size / ranges <= 64 << 20 and size / own.blocks <= 8 << 20 and own.ranges <= 1024 and all(2 <= f <= 1024 for f in own.fans)
        assert own.parts <= 20_000
        asked, wide = own.blocks, own.ranges
        for fan in own.fans:  # a cell: one range of `fan` lists
            assert fan * size / asked / wide <= 16 << 20
            asked, wide = asked / fan, wide * fan
    assert common.shape(30 * 10**9, 1000).fans == () and len(common.shape(10**14, 100_000).fans) == 2


def test_counts_beyond_32_bits():
    body = common.packed(common.squeeze_sorted(np.array([5, 9], np.uint64)), common.squeeze(common.narrow(np.array([5_000_000_000, 1]))))
    lists, distinct, where, totals = common._added(pa.array([body, body]))
    got = common._dealt(pa.table({"blk": [0, 1], "level": [0, 0]}), lists, where, list(totals), 0, None).column("body").to_pylist()
    assert [common.unsqueeze(common.parts(x)[0]).tolist() for x in got] == [[10_000_000_000, 2]] * 2


def test_lm_odd(spark):
    everything = lm_score.score(plain.odd(spark), F.lit(True), F.col("doc_id") == 1)
    assert everything.count() == len(plain.ODD)
    untrained = lm_score.score(plain.odd(spark), F.lit(False), F.lit(False)).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in untrained)
    assert lm_score.score(plain.none(spark), F.lit(True), F.lit(False)).count() == 0


def test_model_beats_base(spark):
    got = queries.op3_lm_score(spark, DIR).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    tenth = common.crc_bucket(F.col("doc_id"), 10)
    pairs = lm_score.score(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text"), tenth != 0, tenth == 1, order=2).where("held_out").agg(F.sum("score")).first()
    assert got[0] > pairs[0] > got[1]


def test_languages(spark):
    got = queries.op5_language_id(spark, DIR).join(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert sum(r["rejected"] for r in got) < 0.02 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_languages_odd(spark):
    docs = plain.odd(spark)
    model = language_id.fit(spark.read.parquet(f"{DIR}/documents.parquet"), F.lit(True))
    got = language_id.predict(docs, model)
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.where("doc_id in (2, 3, 4)").collect()} == dict.fromkeys((2, 3, 4), ("und", 0.0))
    assert got.count() == len(plain.ODD) and language_id.predict(plain.none(spark), model).count() == 0
    other = spark.createDataFrame([(1, "Съешь же ещё этих мягких французских булок да выпей чаю")], "doc_id long, text string")
    assert language_id.predict(other, model).first()["rejected"]
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.fit(plain.none(spark), F.lit(True))).collect()} == {"und"}


def _invented(rng, letters, n):
    """n texts of words from letters, all of one invented vocabulary."""
    words = ["".join(rng.choice(list(letters), rng.integers(2, 7))) for _ in range(60)]
    return [" ".join(rng.choice(words, 40)) for _ in range(n)]


def test_language_centroids(spark):
    model = language_id.fit(spark.read.parquet(f"{DIR}/documents.parquet"), F.lit(True))
    assert min(r["count"] for r in model["table"].groupBy("lang").count().collect()) > 1


def test_language_blocks(spark):
    """Forty languages, held against the texts in blocks of three: as in one block, and as a plain restatement has it."""
    rng = np.random.default_rng(11)
    texts = [(f"l{k:02}", t) for k in range(40) for t in _invented(rng, list("abcdefghijklmnopqrstuvwxyz"[k % 13 :: 2]) + [chr(0x430 + k % 7)], 8)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    one, many = ([tuple(r) for r in language_id.predict(docs, model, block).orderBy("doc_id").collect()] for block in (256, 3))
    assert [(*r[:4], r[5]) for r in one] == [(*r[:4], r[5]) for r in many] and np.allclose([r[4] for r in one], [r[4] for r in many], atol=1e-6) and model["languages"] == 40
    rows = sorted((r["lang"], bytes(r["centre"]), r["least"]) for r in model["table"].collect())
    for i, (lang, t) in enumerate(texts[::17]):
        count = collections.Counter()
        for w in "".join(c if c.isalpha() else " " for c in t.lower()).split():
            for n in (1, 2, 3):
                padded = w if n == 1 else f"_{w}_"
                count.update(padded[k : k + n] for k in range(len(padded) - n + 1))
        assert language_id.grams([t]).sum() == sum(count.values())
        v = np.log1p(language_id.grams([t])[0]) * model["idf"]
        near = [(float(v @ np.frombuffer(c, np.float32)) / np.linalg.norm(v), name) for name, c, _ in rows]
        best = max(near, key=lambda x: (x[0], [-ord(c) for c in x[1]]))
        got = next(r for r in one if r[1] == t)
        assert got[3] == best[1] and abs(got[4] - best[0]) < 1e-5


def test_language_pieces():
    text = "ein zwei drei, vier fünf! sechs 7 acht " * 50 + "x" * 300
    whole = language_id.grams([text])[0]
    cut = next(language_id.counted(pa.array([text]), 350))[1][0]
    assert np.array_equal(whole, cut) and [len(x) for x in language_id._pieces("abcdef gh", 4)] == [4, 3, 2]


def test_language_variant(spark):
    rng = np.random.default_rng(3)
    latin, cyrillic, other = _invented(rng, "aeioubdkmnst", 300), _invented(rng, "аеиоубдкмнст", 6), _invented(rng, "aeioyfghlprw", 300)
    texts = [("sr", t) for t in latin + cyrillic[:5] + ["qqqq", "xxzz", "jjjj"]] + [("xx", t) for t in other]
    model = language_id.fit(spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string"), F.lit(True))
    got = language_id.predict(spark.createDataFrame([(1, cyrillic[5])], "doc_id long, text string"), model).first()
    assert (got["lang_pred"], got["rejected"]) == ("sr", False) and got["score"] > 0.5


FOREIGN = [
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, ché la diritta via era smarrita. Ahi quanto a dir qual era è cosa dura esta selva selvaggia e aspra e forte",
    "O governo anunciou ontem que as novas medidas para a economia deverão entrar em vigor no início do próximo ano, embora muitos especialistas tenham manifestado dúvidas",
    "De regering heeft gisteren aangekondigd dat de nieuwe maatregelen voor de economie begin volgend jaar van kracht zullen worden, hoewel veel deskundigen twijfels hebben",
    "Hallitus ilmoitti eilen, että uudet talouden toimenpiteet tulevat voimaan ensi vuoden alussa, vaikka monet asiantuntijat ovat ilmaisseet epäilyksensä niiden vaikutuksista",
]


@pytest.mark.parametrize("junk", [1, 6])
def test_languages_unlearned(spark, junk):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "lang")
    bad = [(-1 - i, t, lang) for lang in ("de", "en", "es", "fr") for i, t in enumerate(["qq", "Xzwk", "jjj", "vv kk", "Qxyz", "wq"][:junk])]
    model = language_id.fit(docs.unionByName(spark.createDataFrame(bad, docs.schema)), F.lit(True))
    got = language_id.predict(spark.createDataFrame(list(enumerate(FOREIGN)), "doc_id long, text string"), model).collect()
    assert all(r["rejected"] for r in got)
    assert language_id.predict(docs, model).where("rejected").count() < 0.02 * docs.count()


def test_quality(spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", F.col("quality").alias("given"))
    got = queries.op7_quality(spark, DIR).join(labels, "doc_id").groupBy("given").agg(F.avg(F.col("keep").cast("int")), F.avg("quality")).collect()
    kept = {r[0]: r[1] for r in got}
    assert kept[1] > 0.98 and kept[0] < 0.1


def test_quality_odd(spark):
    model = quality.fit(plain.odd(spark))
    got = quality.score(plain.odd(spark), model)
    assert got.count() == len(plain.ODD) and all(r["quality"] == 0 and not r["keep"] for r in got.where("text is null or text = ''").collect())
    assert quality.fit(plain.none(spark)) is None and quality.score(plain.none(spark), None).count() == 0


PROSE = "the cat sat on the mat, and it was good. we saw them in the house of the old man."
TEXTS = [PROSE, PROSE.upper() + "!!", "word word word word " * 12, "a | b | c | d | e | f | g | h", "$$$ ### %%% &&& ***", PROSE + " " + "again again " * 9, "Plain words here.", "x" * 40, "", "Hello, world! 12 (34) 56", "ñandú größe. " * 3]


def _plain_votes(text):
    """The ten labellers, from their description."""
    raw, w = text.encode(), [x.encode() for x in plain.words(text)]
    if not w:
        return [0] * 7 + [-1, 0, 0]
    symbol = set(b"#$%&*@^~<>{}[]\\|=+_")
    upper, lower = sum(65 <= c <= 90 for c in raw), sum(97 <= c <= 122 for c in raw)
    n = len(w)
    symbols, marks = sum(c in symbol for c in raw) / len(raw), sum(c < 128 and not chr(c).isalnum() and c not in b"\t\n\v\f\r " for c in raw) / len(raw)
    caps, shout, odd, ends = upper / max(1, upper + lower), raw.count(b"!") / n, sum(x[-1] in symbol for x in w) / n, sum(x[-1:] in (b",", b".") for x in w) / n
    again, different, length = sum(x == y for x, y in zip(w, w[1:])) / n, len(set(w)) / n, sum(map(len, w)) / n
    varied = again < 0.1
    return [-(symbols > 0.015), -(marks > 0.08), -(odd > 0.1), -(caps > 0.4), -(shout > 0.1), -(again > 0.2), -(different < 0.2 and 30 < n < 2000), -(length > 15 or length < 1.5), int(caps < 0.2 and shout < 0.02 and varied and marks < 0.06),
            1 if varied and 0.02 < ends < 0.5 and odd < 0.05 else -(ends == 0 and n > 30)]


def test_quality_by_hand(spark):
    """Votes, posteriors and scores of a small table against plain Python."""
    texts = [t + (f" {k}" if k % 3 else "") for k in range(12) for t in TEXTS]
    votes = [_plain_votes(t) for t in texts]
    model = quality.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    good = [0.1 if min(v) < 0 else 0.98 for v in votes]
    for _ in range(200):
        share = sum(good) / len(good)
        table = [[[0.5 + sum(p if c else 1 - p for p, v in zip(good, votes) if v[k] == x) for x in (-1, 0, 1)] for k in range(10)] for c in (0, 1)]
        table = [[[x / sum(t) for x in t] for t in row] for row in table]
        now = [1 / (1 + math.exp(-max(-35, min(35, math.log(share / (1 - share)) + sum(math.log(table[1][k][v[k] + 1] / table[0][k][v[k] + 1]) for k in range(10)))))) for v in votes]
        moved, good = max(abs(a - b) for a, b in zip(now, good)), now
        if moved < 1e-9:
            break
    assert np.allclose(model["accuracies"], table, atol=1e-6) and abs(model["share"] - share) < 1e-6
    got = {r["text"]: r["quality"] for r in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert got[""] == 0 and all((got[t] >= 0.5) == (p >= 0.5) for t, p in zip(texts, good) if t)
    words = {}
    for t in set(texts) - {""}:
        counts = quality.shape_counts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
        w = plain.words(t)
        x = 10 * np.sqrt(np.append(counts / max(1, counts.sum()), sum(a == b for a, b in zip(w, w[1:])) / max(1, len(w))))
        x = model["mean"] + (x - model["mean"]) * len(t.encode()) / (len(t.encode()) + 100)
        for v in plain.words(t, True):
            words.setdefault(v, int(quality._features(np.frombuffer(v.encode(), np.uint8), np.array([0, len(v.encode())]))[1][0]))
        there = sorted({words[v] for v in plain.words(t, True)})
        z = x @ model["shape"][:-1] + model["shape"][-1] + model["words"][there].sum() / math.sqrt(max(1, len(there)))
        assert abs(linear.sigmoid(z) - got[t]) < 1e-3


def test_quality_pieces():
    texts = pa.array([" ".join(TEXTS) * 3, "short text", "again " * 200 + "y" * 250])
    whole, cut = list(quality.read(texts)), list(quality.read(texts, most=300))
    numbers = np.concatenate([x[2] for x in cut])
    assert np.array_equal(whole[0][2], numbers) and np.array_equal(whole[0][3], np.concatenate([x[3] for x in cut])) and np.allclose(whole[0][4], np.concatenate([x[4] for x in cut]))
    assert [next(quality.read(pa.array(["a b " + "y" * 500]), most=m))[2][0, 1] for m in (1000, 300)] == [3, 4]  # a run without a blank is cut
    assert set(zip(whole[0][5], whole[0][6])) == {(a + int(x), y) for a, _, *_, row, f in cut for x, y in zip(row, f)}


def test_accuracies_are_learned():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(20_000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) * (rng.random(20_000) < 0.9) for a in (0.95, 0.9, 0.85, 0.6)], 1)
    patterns, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    table, share, good = quality.accuracies(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03 and np.allclose([table[1, k, 2] / (table[1, k, 2] + table[1, k, 0]) for k in range(4)], (0.95, 0.9, 0.85, 0.6), atol=0.04)
    assert ((good[where] > 0.5) == truth).mean() > 0.93


def test_toxicity(spark):
    """Recall over all labelled rows, by models that have seen the other three quarters of them."""
    large = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{large}/labels.parquet")
    part, counts = common.crc_bucket(F.col("doc_id"), 4), collections.Counter()
    for f in range(4):
        got = toxicity.score(docs, toxicity.fit(docs, labels.where(part != f))).join(labels.where(part == f).select("doc_id", F.col("toxic").alias("given")), "doc_id")
        counts.update({(r["given"], r["toxic"]): r["count"] for r in got.groupBy("given", "toxic").count().collect()})
    assert counts[1, True] >= 0.88 * (counts[1, True] + counts[1, False]) and counts[0, True] <= 0.005 * counts[0, False]


def _invented_toxic(n=600):
    """Texts as lists of words, toxic, low quality; four toxic words in two groups, which never meet."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        w = [f"c{k}" for k in rng.integers(0, 80, 25)]
        toxic = int(i % 5 == 0)
        if toxic:
            w[3:3] = [["t0", "t1"], ["t2", "t3"]][i % 2][: 1 + int(rng.integers(0, 2))]
        low = int(rng.random() < 0.2)
        rows.append((w + ["###"] * low + ["zz"] * low, toxic, low if i % 7 else None))
    return rows


def _hashed(rows):
    return [(np.unique(np.concatenate([w for _, _, _, w in toxicity._present(pa.array([" ".join(ws)]))])), y, low) for ws, y, low in rows]


def test_toxicity_chain_by_hand():
    rows = _invented_toxic()
    model = toxicity.learn(_hashed(rows), 200, 2)
    sets, y = [{w for w in ws if w != "###"} for ws, _, _ in rows], np.array([r[1] for r in rows], float)
    seen = {w: [sum(w in s for s, t in zip(sets, y) if t == c) for c in (0, 1)] for w in set().union(*sets)}

    def ratio(b, a):
        e = (a + b) * y.mean()
        return 2 * sum(n * math.log(n / m) for n, m in ((a, e), (b, a + b - e)) if n) if a > e else 0

    assert {w for w, (b, a) in seen.items() if ratio(b, a) > 12} == {"t0", "t1", "t2", "t3"}
    of = {w: int(toxicity._present(pa.array([w])).__next__()[3][0]) for w in ("t0", "t1", "t2", "t3")}
    assert sorted(sorted(w for w in of if of[w] in group) for group in model["words"]) == [["t0", "t1"], ["t2", "t3"]]
    order = sorted(of, key=of.get)
    x = np.array([[w in s for w in order] for s in sets], float)
    groups = [{w for w in of if of[w] in g} for g in model["words"]]
    targets = [[r[2] for r in rows], *([int(t and bool(s & g)) for s, t in zip(sets, y)] for g in groups), y.tolist()]
    for k, target in enumerate(targets):
        known = [i for i, t in enumerate(target) if t is not None]
        t = np.array([target[i] for i in known], float)
        assert np.allclose(model["models"][k], linear.fit_logistic(x[known], t, toxicity._RIDGE), atol=1e-6)
        out = np.zeros(len(rows))
        for f in range(5):
            rest = [j for j, i in enumerate(known) if i % 5 != f]
            w = linear.fit_logistic(x[[known[j] for j in rest]], t[rest], toxicity._RIDGE)
            for i in range(f, len(rows), 5):
                out[i] = linear.sigmoid(x[i] @ w[:-1] + w[-1])
        x = np.hstack([x, out[:, None]])


def test_toxicity_vocabulary(spark):
    """Other words in the same places: the same probabilities and flags."""
    rows = _invented_toxic()
    swapped = [([f"{w[::-1]}ж" if w != "###" else w for w in ws], y, low) for ws, y, low in rows]
    found = []
    for x in (rows, swapped):
        docs = spark.createDataFrame([(i, " ".join(ws)) for i, (ws, _, _) in enumerate(x)], "doc_id long, text string")
        found.append([tuple(r) for r in toxicity.score(docs, toxicity.learn(_hashed(x), 200, 2)).drop("text").orderBy("doc_id").collect()])
    assert np.allclose(*[[r[1:-1] for r in f] for f in found], atol=1e-6) and [r[-1] for r in found[0]] == [r[-1] for r in found[1]] == [bool(y) for _, y, _ in rows]


def test_toxicity_odd(spark):
    labels = spark.createDataFrame([(1, 1, 1), (6, 0, 0), (7, None, 1), (None, 1, 0), (8, 0, None)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(plain.odd(spark), labels)
    got = toxicity.score(plain.odd(spark), model)
    assert got.count() == len(plain.ODD) and {"p_low_quality", "p_group_1", "p_group_2", "p_toxic", "toxic"} <= set(got.columns)
    assert toxicity.fit(plain.odd(spark), labels.where("false")) is None
    assert not any(r["toxic"] for r in toxicity.score(plain.odd(spark), None).collect()) and toxicity.score(plain.none(spark), model).count() == 0
    again = spark.createDataFrame([(1, "a b")] * 3000 + [(2, "c d")] * 3000, "doc_id long, text string")
    assert toxicity.fit(again, spark.createDataFrame([(1, 1, 1), (2, 0, 1)], labels.schema), sample=10) is not None


def test_logistic():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3))
    y = rng.random(4000) < linear.sigmoid(x @ [2.0, -1.0, 0.0] + 0.5)
    assert np.allclose(linear.fit_logistic(x, y.astype(float), 0.01), [2, -1, 0, 0.5], atol=0.2)


def waterfill(sizes, weights, share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(target.values())) / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > most * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in free}
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


def test_mixing(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(0, 300)), [None, "a", "ä", "B", "z"][min(4, int(rng.zipf(1.5)) - 1)]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, chunk=200).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = waterfill(sizes, (3, 1, 2))
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * want[r["source"]] and 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) < 0.02 * want[s] + 300 for s in sizes)
    again = mixing.mix(docs.repartition(7), chunk=200).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mixing_meets_the_dual(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 90), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    sums = mixing.mix(docs).groupBy("source", "target").agg(F.sum(F.col("rate") * F.col("size")).alias("got")).collect()
    assert all(abs(r["got"] / r["target"] - 1) < 1e-6 for r in sums)


@pytest.mark.parametrize("share", [0.05, 0.7, 1.0, 1.5, 1.97])
def test_mixing_rates_are_tilted(spark, share):
    """The rates are exp(lambda * size) up to the cap, with the lambda that bisection finds."""
    sizes = np.random.default_rng(9).integers(1, 400, 500)
    docs = spark.createDataFrame([(i, "w " * int(n), "a") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, share=share).collect()}
    lo, hi = -10.0, 10.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if (sizes * np.exp(np.minimum(mid * sizes, math.log(2)))).sum() < share * sizes.sum():
            lo = mid
        else:
            hi = mid
    assert np.allclose([got[i] for i in range(500)], np.exp(np.minimum(lo * sizes, math.log(2))), rtol=1e-6)


def test_mixing_order(spark):
    """Null and repeated ids of one size: the copies follow the rows, however these are ordered."""
    rows = [(d, f"{'w ' * 40}x{k}", "ab"[k % 2]) for d in (None, 7) for k in range(50)] + [(8, "one more " * 9, "a")]
    found = [sorted((repr(r["doc_id"]), r["text"], r["copies"]) for r in mixing.mix(spark.createDataFrame(x, "doc_id long, text string, source string").repartition(n)).collect()) for x, n in ((rows, 3), (rows[::-1], 5))]
    assert found[0] == found[1] and {c for _, _, c in found[0]} == {1, 2}


def test_mixing_odd(spark):
    odd = plain.odd(spark)
    got = mixing.mix(odd)
    assert set(got.columns) == set(odd.columns) | set(mixing.RESULT) and [r["host"] for r in got.collect()] == ["host"] * len(plain.ODD)
    assert got.where("size = 0 and taken > 0").count() == 0 and mixing.mix(plain.none(spark)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(empty).collect()] == [(0, 0), (0, 0)]


URLS = ["https://WWW.Example.com/en/7198#top", "http://a.com/en", "http://a.com/en/x?y", "x.com/en/", None, "", "http://example.net/de/8/", "http://b.net/de/8", "http://example.com", "ftp://notexample.com/en/7", "http://org/es/", "http://a.org/es/q://z", "http://a.com:80/en/", "http://a.com/EN/", "http://com/en/\nx"]


def fits(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    host = host.translate(plain.A_TO_Z)
    best = min(((-len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best and best[1], best[2] if best else default


#: The first two and two more of the same host and path with contrary verdicts; rules of a host alone.
MORE_RULES = [*queries.URL_RULES, ("block", "example.com", ""), ("block", "a.com", "/e"), ("block", "com", ""), ("block", "B.net", "/de"), ("allow", "b.net", "/de"), ("block", "", "/x")]


@pytest.mark.parametrize("most", [url_filter.BROADCAST, 0])
def test_url_rules(spark, most):
    rows = [(i, u) for i, u in enumerate([*URLS, "http://com.evil.org/x", "http://example.com.evil.org/en/7", "http://a.comx/e", "http://com"] * 2)] + [(None, URLS[0])]
    for rules in (queries.URL_RULES, MORE_RULES):
        last = [(v, h, p) for (h, p), v in {(h.lower(), p): v for v, h, p in rules if h}.items()]
        got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("old")), rules, most=most).collect()
        assert sorted([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got], key=repr) == sorted([(i, *fits(u, last)) for i, u in rows], key=repr)
    nothing = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(nothing, queries.URL_RULES, most=most).count() == 0
    assert {r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), []).collect()} == {"allow"}


def test_url_rules_many(spark):
    """A thousand rules, fetched by token; no Python worker in the plan."""
    rng = np.random.default_rng(5)
    rules = [("block" if k % 3 else "allow", f"h{rng.integers(200)}.example", f"/p{rng.integers(30)}/" * int(rng.integers(0, 3))) for k in range(1000)]
    rows = [(i, f"http://www.h{rng.integers(220)}.example/p{rng.integers(30)}/p{rng.integers(30)}/x") for i in range(300)]
    last = [(v, h, p) for (h, p), v in {(h, p): v for v, h, p in rules}.items()]
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules)
    assert {(r["page_id"], r["rule"], r["verdict"]) for r in judged.collect()} == {(i, *fits(u, last)[2:]) for i, u in rows}
    plan = queries.op2_url_filter(spark, DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rarest_token(spark):
    table = url_filter.rule_table(spark, [("block", "com", "/en/")])
    seen = spark.createDataFrame([(["com.", "/en/"],), (["com."],)], "tokens array<string>")
    assert url_filter.rule_index(table, seen).first()["token"] == "/en/"
