"""Toxicity categories by a classifier chain.

The categories, in the chain's order: `low_quality` (the given label quality is 0), one for each group of the words that
set toxic rows apart (a toxic row with a word of the group), and last `toxic`, the given label. A linear model of each
sees hashed words of the text and the probabilities of the categories before it. It is trained on out-of-fold
probabilities of these, from models that have not seen the row. No word is given: what sets toxic rows apart, and how
these words fall into `groups` by the rows that they share, is learned from the labelled rows.

Words are runs of letters, digits and non-ASCII bytes, in lower case; a text has a word or not, however often. Models see
the hashed words that stand in toxic rows more often than chance gives (by likelihood ratio), at most `features`, in a
sample of at most `sample` different labelled rows (smallest hash of id, labels and text). The limit on the last probability is the one, from 0.15 up, with the best F1
on the out-of-fold probabilities.

Defined cases: null and empty texts have no words. Rows with null toxic labels or ids aren't learned from, those with a
null quality label not for the first category; a doc_id with several labels counts with each. Without both labels nothing
is toxic (probabilities 0). A category that no row or every row has is constant. Each row is judged on its text alone, so
repeats and null ids stay as they are; columns of docs are kept, but for those of the result's names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from . import linear

_BITS = 20
_ROWS = 4096
_FOLDS = 5
#: Likelihood ratio from which a word counts as telling, penalty of the linear models, and least limit. Chosen by
#: four-fold cross-validation on 3,980 labelled rows.
_CHANCE, _RIDGE, _LEAST = 12.0, 0.3, 0.15
#: ASCII bytes other than letters and digits separate words.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = 32


def _present(texts):
    """First row, last row, then row and hashed word of each distinct word of these rows."""
    data, off = C.utf8(texts)
    for a, b in C.slices(off):
        for i in range(a, b, _ROWS):
            j = min(i + _ROWS, b)
            part = _PLAIN[data[off[i] : off[j]]]
            start, end, row = C.words(part, off[i : j + 1] - off[i])
            word = (C.word_hash(part, start, end) >> np.uint64(64 - _BITS)).astype(np.int64)
            yield i, j, row, word


def word_groups(present: np.ndarray, n: int) -> np.ndarray:
    """A group from 0 to n - 1 for each word (column), by cosine of the rows that have it with the groups' means. What
    the words are doesn't matter: order and ties are settled by the rows alone."""
    v = present.T.astype(np.float64)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    order = sorted(range(len(v)), key=lambda k: (-present[:, k].sum(), np.flatnonzero(present[:, k]).tolist()))
    centres = v[order[:1]]
    while len(centres) < min(n, len(v)):
        near = (v[order] @ centres.T).max(1)
        centres = np.vstack([centres, v[order[int(np.round(near, 9).argmin())]]])
    own = np.zeros(len(v), int)
    for _ in range(20):
        own = np.round(v @ centres.T, 9).argmax(1)
        for j in range(len(centres)):
            if (own == j).any():
                centres[j] = v[own == j].mean(0)
                centres[j] /= max(np.linalg.norm(centres[j]), 1e-9)
    return own


def fit(docs: DataFrame, labels: DataFrame, sample: int = 16000, features: int = 200, groups: int = 2) -> dict | None:
    """Learn from docs (doc_id, text) joined with labels (doc_id, quality, toxic)."""
    given = labels.select(F.col("doc_id").alias("_id"), (F.col("toxic") != 0).cast("int").alias("y"), (F.col("quality") == 0).cast("int").alias("low")).where("_id is not null and y is not null").distinct()
    total = given.count()
    key = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("sample")), F.lit(1 << 40))
    chosen = given.where(key < F.lit(int(min(1.0, (1.1 * sample + 50) / max(total, 1)) * (1 << 40))))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "y", "low", F.xxhash64("_id", "y", "low", "text").alias("k"))

    def words(batches):
        for b in batches:
            for i, j, row, word in _present(b.column("text")):
                edge = np.searchsorted(row, np.arange(j - i + 1))
                sets = [C.squeeze_sorted(np.unique(word[x:y]).astype(np.uint64)) for x, y in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.record_batch({n: b.column(n).slice(i, j - i) for n in ("k", "y", "low")} | {"x": pa.array(sets, pa.binary())})

    found = rows.mapInArrow(words, "k long, y int, low int, x binary").dropDuplicates(["k"]).orderBy("k").limit(sample)
    return learn([(C.unsqueeze_sorted(bytes(r["x"])).astype(np.int64), r["y"], r["low"]) for r in found.collect()], features, groups)


def learn(rows: list[tuple[np.ndarray, int, int | None]], features: int, groups: int) -> dict | None:
    """rows: hashed words, toxic, low quality."""
    sets, y = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return None
    both = [np.bincount(np.concatenate([s for s, v in zip(sets, y, strict=True) if v == c]), minlength=1 << _BITS).astype(np.float64) for c in (0, 1)]
    expected = (both[0] + both[1]) * y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (np.where(both[1] > 0, both[1] * np.log(both[1] / expected), 0) + np.where(both[0] > 0, both[0] * np.log(both[0] / (both[0] + both[1] - expected)), 0))
    gain = np.where(both[1] > expected, gain, 0)
    picked = np.argsort(-gain, kind="stable")[:features]
    picked = np.sort(picked[gain[picked] > _CHANCE])
    where = np.full(1 << _BITS, -1, np.int32)
    where[picked] = np.arange(len(picked))
    x = np.zeros((len(sets), len(picked)))
    for i, s in enumerate(sets):
        at = where[s]
        x[i, at[at >= 0]] = 1
    own = word_groups(x[y == 1], groups) if len(picked) else np.zeros(0, int)
    targets = [np.array([np.nan if r[2] is None else r[2] for r in rows], np.float64), *(y * x[:, own == j].any(1) for j in range(groups)), y]
    fold = np.arange(len(y)) % _FOLDS
    models = []
    for t in targets:
        known = ~np.isnan(t)
        if not known.any() or t[known].min() == t[known].max():
            value = float(known.any() and t[known].max())
            out = np.full(len(y), value)
            models.append(np.concatenate([np.zeros(x.shape[1]), [70 * value - 35]]))
        else:
            out = np.zeros(len(y))
            for f in range(_FOLDS):
                out[fold == f] = linear.predict(x[fold == f], linear.fit_logistic(x[known & (fold != f)], t[known & (fold != f)], _RIDGE))
            models.append(linear.fit_logistic(x[known], t[known], _RIDGE))
        x = np.hstack([x, out[:, None]])
    order = np.argsort(-out, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    best = int(np.where(out[order] >= _LEAST, f1, -1).argmax())
    after = out[order[best + 1]] if best + 1 < len(y) else 0.0
    return {"picked": picked, "models": models, "limit": float((out[order[best]] + after) / 2), "words": [picked[own == j] for j in range(groups)]}


def categories(groups: int = 2) -> list[str]:
    return ["low_quality", *(f"group_{j + 1}" for j in range(groups)), "toxic"]


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """docs with a probability for each category (p_low_quality, p_group_1, ..., p_toxic) and toxic."""
    names = [f"p_{c}" for c in (categories(len(model["words"])) if model else categories())]
    kept = docs.drop(*names, "toxic")
    width = 0 if model is None else len(model["picked"])

    def run(batches):
        where = np.full(1 << _BITS, -1, np.int32)
        if width:
            where[model["picked"]] = np.arange(width)
        for b in batches:
            out = np.zeros((b.num_rows, len(names)))
            for i, j, row, word in _present(b.column("text")) if model is not None else ():
                at = where[word]
                x = np.zeros((j - i, width + len(names)))
                x[row[at >= 0], at[at >= 0]] = 1
                for k, w in enumerate(model["models"]):
                    out[i:j, k] = linear.predict(x[:, : width + k], w)
                    x[:, width + k] = out[i:j, k]
            flag = out[:, -1] >= model["limit"] if model is not None else np.zeros(b.num_rows, bool)
            yield pa.record_batch({n: b.column(n) for n in b.schema.names} | {n: pa.array(out[:, k]) for k, n in enumerate(names)} | {"toxic": pa.array(flag)})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names), T.StructField("toxic", T.BooleanType())]))
