"""Plain restatements of the operators' contracts, and a fixture of odd rows."""

import hashlib
import re

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(A_TO_Z) if lower else text)


def cut(rows, window=20):
    """rows (doc_id, text): {(doc_id, text): (words, removed, sha of what is left)}."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            at = (LAST if d is None else d, i)
            first[k] = min(first.get(k, at), at)
    out = {}
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (LAST if d is None else d, i):
                gone[i : i + window] = [True] * window
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out[d, t] = (len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest(), left)
    return out


def shingles(text, n=5):
    w = words(text, True)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def groups(rows):
    """rows (doc_id, text): list of component ids, in order."""
    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                at[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(len(sets[i]), low.get(find(i))) for i in range(len(rows))]


def leaks(rows, items, window=13, misses=2):
    out = set()
    for d, t in rows:
        w = words(t, True)
        for i, item in items:
            x = words(item, True)
            n = min(window, len(x))
            allowed = misses if n == window else 0
            if n and any(sum(a == b for a, b in zip(x[q : q + n], w[p : p + n])) >= n - allowed for q in range(len(x) - n + 1) for p in range(len(w) - n + 1)):
                out.add((d, i))
    return out


LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ODD = [
    (1, "one two three", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \t\n", "fr", None), (5, LONG, "en", "b"), (6, "one two three", "en", "a"), (6, "one two three", "en", "a"), (7, "Größe ñandú \x1c odd", "de", "b"),
    (None, "no id at all", "en", "a"), (None, None, None, "b"), (8, "x " * 500, None, "c"), (5, "same id other text", "en", "b"),
]
CLASH = ["spans", "n_words", "kept_words", "score", "rejected", "lang_pred", "quality", "keep", "toxic", "p_toxic", "media", "n_bytes", "rule", "verdict", "host", "path", "blk", "size", "copies", "rate", "node", "key", "Text_Key"]


def odd(spark, clash=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(c) for c in CLASH}) if clash else df


def none(spark):
    return odd(spark).where("false")
