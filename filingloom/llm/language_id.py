"""Language identification by nearest centroid.

A text is lower-cased, all but letters become word boundaries, and its letter n-grams (1 to 3, not across a boundary
inside) are hashed to a vector. TF-IDF vectors of unit length are compared by cosine with several centroids of each
language, found by spherical k-means. A text whose best cosine is below that centroid's limit is rejected; limits come
from cosines with centroids that were fitted without the text, so training rows can fall below them too.

Inverse document frequencies come from all training rows. Centroids and limits of each language are fitted by one task on
at most `per_language` of its different training rows, those of the smallest hash of doc_id and text. The model is a
table of centroids; any number of languages is learned, and texts are held against them `block` languages at a time.

Defined cases: a null text, or one without letters, is `und` with score 0 and rejected. Rows without language aren't
learned from; equal rows count as one in the sample. Without training rows all texts are `und`. Ties go to the language
that sorts first. A text of over a million characters is counted piece by piece, cut between words (a longer run of
letters is cut where the piece ends). Each row is judged on its text alone, so repeats and null ids stay as they are;
columns of docs are kept, but for those of the result's names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

DIMENSIONS = 4096
#: Rows of a dense matrix.
_ROWS = 512
_KEYS = 1 << 40
#: Languages whose shares of the sample are broadcast; more are joined by a shuffle.
BROADCAST = 10_000


def grams(texts: list[str]) -> np.ndarray:
    """A row of hashed n-gram counts for each text."""
    low = [t.lower() for t in texts]
    size = np.array([len(t) for t in low], np.int64) + 2
    code = np.frombuffer(("\0" + "\0\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(low)), size)
    table = np.array([chr(i).isalpha() for i in range(0x0600)])
    letter = table[np.minimum(code, 0x05FF)]
    if len(odd := np.flatnonzero(code >= 0x0600)):
        kinds, which = np.unique(code[odd], return_inverse=True)
        letter[odd] = np.array([chr(k).isalpha() for k in kinds.tolist()])[which]
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    code, row = np.where(letter, code, 0)[keep].astype(np.uint32), row[keep]
    if len(code):
        double = np.zeros(len(code), bool)
        double[1:] = (code[1:] == 0) & (code[:-1] == 0) & (row[1:] == row[:-1])
        code, row = code[~double], row[~double]
    out = np.zeros(len(low) * DIMENSIONS, np.float32)
    one = code * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B) + one[1:]
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE35) + one[2:]
    full = code != 0
    for h, ok, at in ((one, full, row), (two, (full[:-1] | full[1:]) & (row[:-1] == row[1:]), row[1:]), (three, full[1:-1] & (row[:-2] == row[2:]), row[2:])):
        if len(h):
            h = h[ok]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out += np.bincount(at[ok] * DIMENSIONS + (h >> np.uint32(20)), minlength=len(out)).astype(np.float32)
    return out.reshape(len(low), DIMENSIONS)


def _pieces(text: str, most: int = C.SLICE) -> Iterator[str]:
    """The text in pieces of at most `most` characters, cut between words."""
    at = 0
    while at < len(text):
        end = k = min(len(text), at + most)
        while end < len(text) and k > at and text[k - 1].isalpha():
            k -= 1
        yield text[at : k if k > at else end]
        at = k if k > at else end


def counted(texts, most: int = C.SLICE) -> Iterator[tuple[list[int], np.ndarray]]:
    """Row numbers and their n-gram counts, nulls left out."""
    rows, held, size = [], [], 0
    for i in range(len(texts)):
        t = texts[i].as_py()
        if t is None:
            continue
        if len(t) > most:
            yield [i], sum(grams([x]).astype(np.float64) for x in _pieces(t, most)).astype(np.float32)
            continue
        rows.append(i)
        held.append(t)
        size += len(t)
        if len(held) >= _ROWS or size > most:
            yield rows, grams(held)
            rows, held, size = [], [], 0
    if held:
        yield rows, grams(held)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def _seeds(near: np.ndarray, k: int) -> list[int]:
    """Rows to start k-means from, given the cosines of all rows: each serves best the rows that the ones before it serve
    worst. A row doesn't count for itself, so one that is like no other is no seed, however far off it is."""
    far = 1 - np.clip(near, 0, 1)
    np.fill_diagonal(far, 1)
    far **= 4
    left, chosen = np.ones(len(far), far.dtype), []
    while len(chosen) < k:
        gain = np.maximum(left[:, None] - far, 0).sum(0)
        gain[chosen] = -1
        best = int(gain.argmax())
        if chosen and gain[best] < 1e-3:
            break
        chosen.append(best)
        left = np.minimum(left, far[:, best])
        left[best] = 0
    return chosen


def _centroids(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means. A cluster of one or two rows is dropped together with its rows and the rest is seeded anew, so
    that k clusters stay where there are rows for them, small ones too."""
    near, rows = v @ v.T, np.arange(len(v))
    while True:
        u = v[rows]
        c = u[_seeds(near[np.ix_(rows, rows)], min(k, max(1, len(rows) // 3)))]
        for _ in range(12):
            own = np.argmax(u @ c.T, 1)
            for j in range(len(c)):
                if (own == j).any():
                    m = u[own == j].mean(0)
                    c[j] = m / max(np.linalg.norm(m), 1e-9)
        own = np.argmax(u @ c.T, 1)
        size = np.bincount(own, minlength=len(c))
        if size.min() >= 3 or size.max() < 3:
            return c[size > 0]
        if size.min() == 0:
            k = len(c) - 1
        rows = rows[size[own] >= 3]


def _limits(v: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The least cosine that each of the centroids c accepts: 3/4 of the 1 % quantile of its own rows' cosines with centroids
    fitted without them, or of that of all rows if less, as copies of a text say little of what else lies near them.
    At least a quarter of the median, so that junk opens no gate where it is more than 1 % of the rows or has a centroid."""
    own, held = np.argmax(v @ c.T, 1), (v @ c.T).max(1)
    fold = np.arange(len(v)) % 4
    if len(v) >= 12:
        for f in range(4):
            held[fold == f] = (v[fold == f] @ _centroids(v[fold != f], k).T).max(1)
    low = [np.quantile(held[own == j], 0.01) if (own == j).any() else np.inf for j in range(len(c))]
    return np.maximum(0.75 * np.minimum(low, np.quantile(held, 0.01)), np.median(held) / 4)


def fit(docs: DataFrame, training: Column, per_language: int = 400, clusters: int = 4) -> dict:
    """Learn from the training rows of docs (doc_id, text, lang): idf, and a table of centroids."""
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_KEYS)).alias("key")
    train = docs.where(training & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text", key)
    sizes = C.cut(train.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")))
    languages = sizes.count()

    def frequencies(batches):
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for b in batches:
            for rows, counts in counted(b.column("text")):
                seen += (counts > 0).sum(0)
                n += len(rows)
        yield pa.record_batch({"k": pa.array(range(-1, DIMENSIONS), pa.int32()), "n": pa.array([n, *seen.tolist()], pa.int64())})

    df = np.zeros(DIMENSIONS + 1)
    for k, n in train.select("text").mapInArrow(frequencies, "k int, n long").groupBy("k").agg(F.sum("n")).collect():
        df[k + 1] = n
    idf = (np.log((1 + df[0]) / (1 + df[1:])) + 0.1).astype(np.float32)

    shares = sizes.select("lang", F.least(F.lit(1.0), (1.3 * per_language + 20) / F.col("n")).alias("share"))
    chosen = train.join(F.broadcast(shares) if languages <= BROADCAST else shares, "lang").where(F.col("key") < F.col("share") * _KEYS).drop("share")

    def vectors(batches):
        for b in batches:
            for rows, counts in counted(b.column("text")):
                at = pa.array(rows, pa.int64())
                yield pa.record_batch({"lang": b.column("lang").take(at), "key": b.column("key").take(at), "v": pa.array([C.squeeze(x.astype(np.uint32)) for x in counts], pa.binary())})

    def centroids(table):
        order = np.argsort(table.column("key").to_numpy(), kind="stable")[:per_language]
        v = _vectors(np.stack([C.unsqueeze(table.column("v")[k].as_py()) for k in order.tolist()]).astype(np.float32), idf)
        v = v[v.any(1)]
        c = _centroids(v, clusters) if len(v) else v
        limits = _limits(v, c, clusters) if len(v) else []
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(c), pa.string()), "centre": pa.array([x.astype(np.float32).tobytes() for x in c], pa.binary()), "least": pa.array(limits, pa.float64())})

    sample = chosen.select("text", "lang", "key").mapInArrow(vectors, "lang string, key long, v binary").dropDuplicates(["lang", "key"])
    return {"idf": idf, "languages": languages, "table": C.cut(sample.groupBy("lang").applyInArrow(centroids, "lang string, centre binary, least double"))}


def predict(docs: DataFrame, model: dict, block: int = 256) -> DataFrame:
    """docs with lang_pred, score (best cosine) and rejected."""
    idf, kept = model["idf"], docs.drop("lang_pred", "score", "rejected")
    blocks = max(1, -(-model["languages"] // block))
    found = kept.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)})
    for k in range(blocks):
        rows = sorted((r["lang"], bytes(r["centre"]), r["least"]) for r in model["table"].where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k).collect())
        if not rows:
            continue
        names, limits = [r[0] for r in rows], np.array([r[2] for r in rows])
        centres = np.ascontiguousarray(np.stack([np.frombuffer(r[1], np.float32) for r in rows]).T)

        def run(batches, names=names, limits=limits, centres=centres):
            for b in batches:
                lang, score, out = b.column("lang_pred").to_pylist(), b.column("score").to_numpy().copy(), b.column("rejected").to_numpy(zero_copy_only=False).copy()
                for rows, counts in counted(b.column("text")):
                    near = _vectors(counts, idf) @ centres
                    best, some = near.argmax(1), counts.any(1)
                    top = np.clip(near[np.arange(len(best)), best], 0, 1)
                    for i, j, v, ok in zip(rows, best.tolist(), top.tolist(), some.tolist(), strict=True):
                        if ok and (lang[i] == "und" or v > score[i] or (v == score[i] and names[j] < lang[i])):
                            lang[i], score[i], out[i] = names[j], v, v < limits[j]
                whole = {n: b.column(n) for n in b.schema.names}
                yield pa.record_batch(whole | {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "rejected": pa.array(out)})

        found = found.mapInArrow(run, found.schema)
    return found
