"""Lexical search against a plain ranking; byte-level BPE against the library it has to agree with."""

import hashlib
import math
import random
import re
import struct

import numpy as np
import plain
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from filingloom.llm import bpe, common, lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=10):
    """docs (doc_id, text), items (item_id, text): rows (item_id, rank, doc_id, score)."""
    held = [(d, TERM.findall((t or "").translate(plain.A_TO_Z))) for d, t in docs]
    held = [(d, w) for d, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    out = []
    for i, t in set(items):
        scores = []
        for d, w in held:
            m, score = 100 - 90 + (90 * len(w) * n) // total, 0
            for term in set(TERM.findall((t or "").translate(plain.A_TO_Z))):
                df, tf = sum(term in x for _, x in held), w.count(term)
                if df:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **how):
    rows = lexical_search.search(lexical_search.index(docs, how.pop("shard_bytes", 300)), items, **how).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_search(spark, seed):
    rng = random.Random(seed)
    words = [f"{'Äß'[i % 2] if i % 5 == 0 else ''}w{i}" for i in range(80)]

    def text(n):
        return rng.choice([" ", "-", "\n"]).join(words[min(79, int(rng.expovariate(0.06)))].upper() if rng.random() < 0.2 else words[min(79, int(rng.expovariate(0.06)))] for _ in range(n))

    docs = [(i, text(rng.choice([0, 1, 3, 30, 120]))) for i in range(250)]
    docs += [(i + 300, t) for i, t in docs[:60]] + [(None, docs[5][1]), (5, docs[7][1])]
    items = [(i, text(rng.choice([0, 1, 5, 20]))) for i in range(30)] + [(3, "w0 w1 w79"), (None, "w2 w60"), (77, None)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items + items[:4], "item_id long, text string")
    want = ranked(docs, items)
    assert found(a, b) == want
    assert found(a, b, block_words=40) == want
    assert found(a, b, k=1) == ranked(docs, items, 1)


def test_search_probes_less():
    """Non-essential lists leave documents out, never one that qualifies."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"t{x}" for x in rng.geometric(0.05, rng.integers(1, 60))) for _ in range(400)]
    ids = pa.array(range(400), pa.int64())
    batch = lexical_search._packed(ids, *lexical_search.terms_of(*common.utf8(pa.array(texts))))
    shard = lexical_search._lists(batch.column("body")[0].as_py())
    lengths = lexical_search.length_parts(shard.length, 400, int(shard.length.sum()))
    weight = lexical_search.weights(400, shard.size)
    bound = weight * lexical_search.score_parts(shard.most, lexical_search.length_parts(shard.least, 400, int(shard.length.sum())))
    for _ in range(50):
        t = rng.choice(len(shard.key), 6, replace=False)
        whole = lexical_search.max_score(shard, lengths, t, weight[t], bound[t], 1)
        for least in (int(np.median(whole[1])), int(whole[1].max()), int(whole[1].max()) + 1):
            doc, score = lexical_search.max_score(shard, lengths, t, weight[t], bound[t], least)
            keep = whole[1] >= least
            assert doc.tolist() == whole[0][keep].tolist() and score.tolist() == whole[1][keep].tolist()


def test_search_odd(spark):
    items = spark.createDataFrame([(1, "one x"), (1, "one x"), (2, "text nothing"), (3, "")], "item_id long, text string")
    rows = [r[:2] for r in plain.ODD]
    assert found(plain.odd(spark), items) == ranked(rows, [(1, "one x"), (2, "text nothing"), (3, "")])
    assert found(plain.none(spark), items) == [] and found(plain.odd(spark), items.where("false")) == []


def test_search_long_text(monkeypatch):
    text = ("Ab c-d, " * 50 + "x" * 300 + " é9 ").encode() * 3
    data, off = np.frombuffer(b"q" + text + b"z", np.uint8), np.array([0, 1, 1 + len(text), 2 + len(text)])
    whole = [x.tolist() for x in lexical_search.terms_of(data, off)]
    monkeypatch.setattr(common, "SLICE", 100)
    monkeypatch.setattr(common.slices, "__defaults__", (100,))
    monkeypatch.setattr(common.whole_words, "__defaults__", (100, common._SPACE))
    assert [x.tolist() for x in lexical_search.terms_of(data, off)] == whole


PATHS = [P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.tiktoken")]


def library(path):
    with open(path, "rb") as f:
        v = bpe.vocabulary(f.read())
    ranks = {v.bytes[v.starts[r] : v.starts[r + 1]].tobytes(): r for r in range(v.wide) if v.starts[r + 1] > v.starts[r]}
    return v, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed=5):
    rng = random.Random(seed)
    pool = "aabbc  \n\t\r\x0b\x0c\x1c\x85\xa0 　'stdrl 09²½é日😀़्٣_-.#​﻿\x00"
    out = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x370, 0x600), rng.randrange(0x4E00, 0x5000)])) for _ in range(30)) for _ in range(300)]
    out += ["", " ", "\n", "I'll 've don't", "<|endoftext|> x", "a" * 5000, "ab" * 3000, "ha" * 700 + "hah", "  two  three   ", plain.LONG[:20000]]
    out += [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for ends in bpe.LATER for c in ends] + ["".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x34000)])) for _ in range(30)) for _ in range(500)]
    out += ["".join(rng.choice("etaoin") for _ in range(400)) for _ in range(30)]
    return out


@pytest.mark.parametrize("path", PATHS)
def test_encode(path):
    v, own = library(path)
    data, off = common.utf8(pa.array(texts()))
    for chunk, known in ((1 << 20, 10**6), (500, 40)):
        encoder, got = bpe.Encoder(v, P.PATTERN, known), []
        for i, j in common.slices(off, chunk):
            if j == i + 1:
                got.append(np.frombuffer(bpe._row(encoder, data[off[i] : off[j]], chunk), bpe._ID).tolist())
                continue
            ids, ends = encoder.ids_of(data[off[i] : off[j]], off[i : j + 1] - off[i])
            assert np.array_equal(bpe.decoded(ids, v), data[off[i] : off[j]])
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert got == [own.encode_ordinary(t) for t in texts()]


def test_pairs_of_a_lower_rank_come_first():
    """Vocabularies whose merges bring up pairs of lower ranks, as no trained one has so often."""
    rng = random.Random(3)
    for _ in range(60):
        ranks = [bytes([b]) for b in range(256)]
        more = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(25)}
        order = [*ranks, *rng.sample(sorted(more), len(more))]
        table = {t: r for r, t in enumerate(order)}
        v = bpe.Vocabulary(table)
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40))) for _ in range(40)]
        ids, size = bpe.merged(words, v)
        own = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=table, special_tokens={})
        for w, got in zip(words, np.split(ids, np.cumsum(size)[:-1])):
            assert w in table or got.tolist() == own.encode_ordinary(w.decode())


def test_encode_and_decode_frames(spark):
    _, own = library(PATHS[0])
    docs = plain.odd(spark).withColumnsRenamed({"blk": "ids", "key": "decoded"})
    encoded = bpe.encode(docs, PATHS[0], P.PATTERN, chunk_bytes=1000)
    rows = bpe.decode(encoded, PATHS[0]).collect()
    want = sorted((own.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in plain.ODD)
    assert sorted((list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])), bytes(r["decoded"])) for r in rows) == want
    assert rows[0]["host"] == "host" and "text" not in rows[0].asDict()
    assert sorted(r["ids"] for r in bpe.unpacked(encoded).collect()) == [w[0] for w in want]
    assert bpe.decode(bpe.encode(plain.none(spark), PATHS[0], P.PATTERN), PATHS[0]).count() == 0


def test_equal_hashes_are_noticed(spark, monkeypatch):
    v, own = library(PATHS[0])
    monkeypatch.setattr(common, "word_hash", lambda data, start, end, seed=1: (end - start).astype(np.uint64))
    docs = spark.createDataFrame([(1, "some words that meet"), (2, "none")], "doc_id long, text string")
    encoder = bpe.Encoder(v, P.PATTERN, 1000)
    text = np.frombuffer(b"some words that meet", np.uint8)
    ids, _ = encoder.ids_of(text, np.array([0, len(text)]))
    assert not np.array_equal(bpe.decoded(ids, v), text) and bpe._row(encoder, text, 10**6) == np.array(own.encode_ordinary("some words that meet"), "<u4").tobytes()
    assert docs.count() == 2


def test_query_agrees_with_the_library(spark):
    from filingloom.llm import queries

    _, own = library(PATHS[0])
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in queries.op13_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = own.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest())
