"""Exact Jaccard join of shingle sets, and its groups, with set-relation skipping.

Sets are of 64-bit hashes of lower-cased shingles. A set's order is by document frequency, then hash. Two sets that link
share an element among the first n - ceil(t n) + 1 of each, so a set whose first elements occur in no other document has
no partner and leaves here; the rest ("suspects") are indexed by those of their first elements that others have.

* Equal sets become one node.
* Relations of sets: nodes that share a minimum hash are compared with the most typical of them, a hub. A node that links
  to its hub has its answer, the hub's group, without any list being read for it.
* Index lists hold only elements that nodes of several groups share. They are stored in blocks by size and position, and
  a probe skips a block whose best case is below the threshold. Only nodes outside a list's largest group probe it.
* A candidate whose distance to its hub is known is skipped if the probe's distance to that hub shows, by the triangle
  inequality of the Jaccard distance, that they don't link: its answer follows from the hub's.
* What is left is compared exactly.

Document frequencies count every document; their keys keep the hash's top 40 bits, and two elements that share them
only seem more frequent, alike to all sets. Equality of sets is taken from 128 bits of digest.

Defined cases: a null or empty text has no shingles, links to nothing and is its own group; so is a null doc_id's row if
nothing links to it (component_id null). Repeated rows are equal sets. Rows that share a doc_id count as separate
documents. A group's id is its smallest doc_id. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

_BANDS = 6
_MEMBERS = 64
#: Pairs whose nodes are broadcast to pick out their sets; more are joined by a shuffle of all sets.
_FEW = 50_000
_KEY = np.uint64(0xFFFFFFFFFF000000)


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, sorted; rows of fewer words have one of all their words."""
    data = C.lower(data)
    start, end, row = C.words(data, off)
    h = C.word_hash(data, start, end)
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if len(h) >= size:
        at = np.flatnonzero(row[: len(h) - size + 1] == row[size - 1 :])
        rows.append(row[at])
        hashes.append(C.gram_hash(h, size)[at])
    n = np.bincount(row, minlength=len(off) - 1)
    first = np.cumsum(n) - n
    for k in range(1, size):
        if len(short := np.flatnonzero(n == k)):
            rows.append(short)
            hashes.append(C.gram_hash(h, k)[first[short]])
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def _block_sets(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, off = C.utf8(texts)
    parts = [(i, *shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], size)) for i, j in C.slices(off)]
    return np.concatenate([np.zeros(0, np.int64), *(r + i for i, r, _ in parts)]), np.concatenate([np.zeros(0, np.uint64), *(h for *_, h in parts)])


def _rarity(totals: np.ndarray) -> list[np.ndarray]:
    """Document frequency up to 128 exactly, then by quarter powers of two."""
    df = totals[0]
    return [np.where(df <= 128, df, 128 + np.minimum(127, np.ceil(4 * np.log2(np.maximum(df, 1) / 128)))).astype(np.int64)]


_SETS = "doc_id long, text_key long, n int, sid long, sid2 long, uid long, typical double, bands array<long>, first int, post array<long>, elements binary"


def _suspects(docs: DataFrame, size: int, num: int, den: int, limits: dict) -> DataFrame:
    blocks, own = C.blocked(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_key")], C.text_bytes(docs), **limits)

    def keys(table):
        _, h = _block_sets(table.column("text"), size)
        return [(k, [c]) for k, c in [np.unique(h & _KEY, return_counts=True)]]

    answers = C.block_counts(blocks, keys, own, _rarity)

    def build(table, answer):
        n_rows = table.num_rows
        row, h = _block_sets(table.column("text"), size)
        key = h & _KEY
        code = np.zeros(0, np.uint8)
        if len(h):
            where = np.unique(key, return_inverse=True)[1]
            code = C.answers_of(answer, 0)[0][where]
        n = np.bincount(row, minlength=n_rows)
        edge = np.concatenate([[0], np.cumsum(n)])
        once = np.bincount(row, code == 1, n_rows).astype(np.int64)
        prefix = n + (-n * num // den) + 1  # n - ceil(n num / den) + 1
        full = np.flatnonzero(n > 0)
        sid, sid2 = np.zeros(n_rows, np.uint64), np.zeros(n_rows, np.uint64)
        sid[full] = C.mix(np.add.reduceat(C.mix(h), edge[full])) if len(full) else 0
        sid2[full] = np.add.reduceat(C.mix(h ^ np.uint64(0x5DEECE66D)), edge[full]) if len(full) else 0
        out = {k: [None] * n_rows for k in ("typical", "bands", "first", "post", "elements")}
        for i in np.flatnonzero((n > 0) & (once < prefix)).tolist():
            own, rare = h[edge[i] : edge[i + 1]], code[edge[i] : edge[i + 1]]
            order = np.lexsort((own, rare))[once[i] : prefix[i]]
            out["typical"][i] = float(rare.astype(np.float64).mean())
            out["bands"][i] = [int(C.mix(own ^ np.uint64(b + 1)).min() >> np.uint64(1)) for b in range(_BANDS)]
            out["first"][i] = int(once[i])
            out["post"][i] = own[order].view(np.int64)
            out["elements"][i] = C.squeeze_sorted(own)
        uid = (table.column("blk")[0].as_py() << 32) + np.arange(n_rows)
        return pa.table({"doc_id": table.column("doc_id").cast(pa.int64()), "text_key": table.column("text_key"), "n": pa.array(n.astype(np.int32)), "sid": pa.array(sid.view(np.int64)), "sid2": pa.array(sid2.view(np.int64)), "uid": pa.array(uid),
                         "typical": pa.array(out["typical"], pa.float64()), "bands": pa.array(out["bands"], pa.list_(pa.int64())), "first": pa.array(out["first"], pa.int32()), "post": pa.array(out["post"], pa.list_(pa.int64())), "elements": pa.array(out["elements"], pa.binary())})

    return blocks.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(build, _SETS)


def compare(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs (a, b) with the sizes of their sets and of what these share: a, b, na, nb, shared."""
    pairs = C.cut(pairs.select("a", "b"))
    kept, ids = nodes.select("node", "elements"), pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    if pairs.count() <= _FEW:
        kept = kept.join(F.broadcast(ids), "node", "left_semi")
    both = pairs.join(C.merged(kept.withColumnsRenamed({"node": "a", "elements": "ea"})), "a").join(C.merged(kept.withColumnsRenamed({"node": "b", "elements": "eb"})), "b")

    def run(batches):
        for batch in batches:
            a, b = batch.column("ea"), batch.column("eb")
            size = ([], [], [])
            for i in range(batch.num_rows):
                x, y = C.unsqueeze_sorted(a[i].as_py()), C.unsqueeze_sorted(b[i].as_py())
                z = np.concatenate([x, y])
                z.sort()
                for k, v in zip(size, (len(x), len(y), int((z[1:] == z[:-1]).sum())), strict=True):
                    k.append(v)
            yield pa.record_batch([batch.column("a"), batch.column("b"), *(pa.array(x, pa.int64()) for x in size)], names=["a", "b", "na", "nb", "shared"])

    return both.select("a", "b", "ea", "eb").mapInArrow(run, "a long, b long, na long, nb long, shared long")


def groups(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, **limits: int) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key (a hash of the text) and group_key (a number for each group, apart even
    where groups share a doc_id) for each row; sets link where den * shared >= num * union. limits: those of common.shape()."""
    sets = C.cut(_suspects(docs, size, num, den, limits))
    order = F.coalesce("doc_id", F.lit(int(np.iinfo(np.int64).max))).alias("order")
    first = sets.where("elements is not null").groupBy("sid", "sid2").agg(F.min(order).alias("order"), F.min("uid").alias("uid")).select("uid", "order", F.xxhash64("sid", "sid2").alias("node"))
    nodes = C.cut(sets.drop("doc_id", "text_key").where("elements is not null").join(C.merged(first), "uid").drop("uid"))
    linked = F.expr(f"{den} * shared >= {num} * (na + nb - shared)")

    # Relations: each node and the hubs of its bands.
    banded = nodes.select("node", "typical", F.posexplode("bands").alias("band", "low"))
    hubs = C.cut(banded.groupBy("band", "low").agg(F.min(F.struct((-F.col("typical")).alias("t"), F.col("node").alias("hub"))).alias("x"), F.count("*").alias("c")).where("c > 1").select("band", "low", "x.hub"))
    pairs = banded.join(C.merged(hubs), ["band", "low"]).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    star = C.cut(compare(pairs, nodes).where(linked).withColumn("near", F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))))
    roots = components(star.select("a", "b"))
    hub = star.groupBy("a").agg(F.max(F.struct("near", F.col("b").alias("hub"))).alias("x")).select(F.col("a").alias("node"), "x.near", "x.hub")
    known = nodes.select("node", "n", "first", "post").join(C.merged(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))

    # Index lists of the elements that several groups share.
    posts = C.cut(known.select("node", "n", "root", "first", F.posexplode("post").alias("k", "element")).withColumn("pos", F.col("first") + F.col("k")).drop("first", "k"))
    shared = posts.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("listed")).where("lo <> hi").select("element", "listed")
    largest = posts.join(C.merged(shared), "element").groupBy("element", "root", "listed").count().groupBy("element", "listed").agg(F.max(F.struct("count", "root")).alias("x")).select("element", "listed", F.col("x.root").alias("main"))
    lists = C.cut(posts.join(C.merged(largest), "element"))
    step = float(np.log(den / num))
    classed = lists.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / step).cast("int"))
    blocks = (
        classed.groupBy("element", "main", "class", F.floor(F.col("pos") / 8).alias("at"), F.pmod(F.hash("node"), (F.col("listed") / _MEMBERS + 1).cast("int")).alias("chunk"))
        .agg(F.collect_list(F.struct("node", "n", "pos", "root")).alias("members"), F.min("n").alias("small"), F.max(F.col("n") - F.col("pos")).alias("rest"))
        .drop("at", "chunk", "main")
    )
    probe = classed.where("root <> main").select("element", "main", F.col("node").alias("a"), F.col("n").alias("pn"), F.col("pos").alias("pp"), F.col("root").alias("proot"), F.explode(F.array(F.col("class") - 1, "class", F.col("class") + 1)).alias("class"))
    enough = f"least(pn - pp, {{rest}}) * {num + den} >= {num} * (pn + {{n}})"
    hit = probe.join(C.merged(blocks), ["element", "class"]).where(enough.format(rest="rest", n="small"))
    hit = hit.select("a", "pn", "pp", "proot", "main", F.explode("members").alias("m"))
    pair = hit.where(f"m.root <> proot and (m.root = main or a < m.node) and least(pn, m.n) * {den} >= greatest(pn, m.n) * {num} and {enough.format(rest='m.n - m.pos', n='m.n')}")
    candidates = C.cut(pair.select("a", F.col("m.node").alias("b")).distinct())

    # Answers that follow from the hub's.
    with_hub = candidates.join(C.merged(hub.withColumnRenamed("node", "b")), "b", "left")
    to_hub = compare(with_hub.where("hub is not null and hub <> a").select("a", F.col("hub").alias("b")).distinct(), nodes)
    to_hub = to_hub.select("a", F.col("b").alias("hub"), (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("far"))
    left = with_hub.join(C.merged(to_hub), ["a", "hub"], "left").where(f"far is null or (1 - far) - (1 - near) <= {1 - num / den + 1e-9}")
    more = compare(left.select("a", "b"), nodes).where(linked).select("a", "b")
    root = known.select("node", "root")
    between = more.join(C.merged(root.withColumnsRenamed({"node": "a", "root": "ra"})), "a").join(C.merged(root.withColumnsRenamed({"node": "b", "root": "rb"})), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    joined = components(between).select(F.col("node").alias("root"), F.col("root").alias("last"))
    whole = nodes.select("node", "sid", "sid2", "order").join(C.merged(root), "node").join(C.merged(joined), "root", "left").withColumn("last", F.coalesce("last", "root"))
    least = C.cut(whole.groupBy("last").agg(F.min("order").alias("component_id")))  # written first, so that the join of a large group can be split
    named = whole.join(C.merged(least), "last").select("sid", "sid2", "component_id", "last")
    out = sets.select("doc_id", "text_key", "n", "sid", "sid2").join(C.merged(named), ["sid", "sid2"], "left")
    known_id = F.coalesce(F.col("component_id"), F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(known_id == int(np.iinfo(np.int64).max), F.lit(None)).otherwise(known_id).alias("component_id"), "text_key", F.coalesce("last", F.xxhash64("doc_id", "text_key")).alias("group_key"))
