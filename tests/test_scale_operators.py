"""Kept answers, distributed ordinals and the visited filter, each against the plain way."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filingloom.operators import answers, ordinals, visited


def test_each_prompt_is_asked_once(spark, tmp_path):
    log = tmp_path / "asked"

    def ask(texts):
        if any("bad" in t for t in texts):
            raise OSError("no")
        with open(log, "a") as f:
            f.writelines(t + "\n" for t in texts)
        return texts.str.len() / 10

    rows = [(k, f"text {k % 7}" if k % 3 else "hot") for k in range(200)] + [(500, None), (501, "bad one")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    first = answers.Answers(spark, str(tmp_path / "store"), salts=3)
    assert answers.scored(df.where("id < 100"), F.col("text"), first, "length", ask).count() == 100
    second = answers.Answers(spark, str(tmp_path / "store"), salts=3)
    got = {r["id"]: r["relevance_score"] for r in answers.scored(df, F.col("text"), second, "length", ask).collect()}
    assert got == {k: len(t) / 10 if t and t != "bad one" else 0.5 for k, t in rows}
    assert Counter(log.read_text().splitlines()) == Counter({t: 1 for _, t in rows if t and t != "bad one"})
    other = second.answered(df.where("id = 1"), F.col("text"), "upper", lambda t: t.str.upper())
    assert other.first()["answer"] == "TEXT 1" and other.columns == ["id", "text", "answer"]
    assert second.answered(df.where("false"), F.col("text"), "upper", lambda t: t).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_ordinals(spark, parts):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, ""]), rng.random(), k) for k in range(500)]
    got = ordinals.ordinals(spark.createDataFrame(rows, "host string, x double, k long"), ["host"], ["x", "k"], parts=parts)
    want = {}
    for h in {r[0] for r in rows}:
        want |= {r[2]: i for i, r in enumerate(sorted((r for r in rows if r[0] == h), key=lambda r: (r[1], r[2])))}
    assert {r["k"]: r["place"] for r in got.collect()} == want and got.columns == ["host", "x", "k", "place"]


def test_calendar(spark):
    df = spark.range(60).select(F.when(F.col("id") % 3 > 0, "h1").otherwise("h2").alias("host"), "id")
    got = ordinals.calendar(df, "host", ["id"], 1.5, 10.0)
    plan = got._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
    for h in ("h1", "h2"):
        at = sorted((r["id"], r["slot"]) for r in got.where(F.col("host") == h).collect())
        assert [s for _, s in at] == [10.0 + 1.5 * k for k in range(len(at))]
    assert ordinals.calendar(df.where("false"), "host", ["id"], 1.0).count() == 0


@pytest.mark.parametrize("most", [1 << 16, 1 << 22])
def test_unvisited(spark, most):
    past = spark.range(3000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), (F.col("id") % 2).alias("crawl"))
    new = spark.range(2000, 6000, 3).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), (F.col("id") % 2).alias("crawl"), F.lit("x").alias("more")).union(spark.createDataFrame([(None, 1, "n"), ("u1", 0, "other crawl")], "url string, crawl long, more string"))
    got = visited.unvisited(new, past, ["crawl", "url"], most)
    want = new.join(past, ["crawl", "url"], "left_anti").select(*new.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert visited.unvisited(new, past.where("false"), ["url"]).count() == new.count() and visited.unvisited(new.where("false"), past, ["url"]).count() == 0


def test_the_filter_lets_little_through_and_merges(spark):
    a, b, c = (spark.range(n, n + 20000).select(F.xxhash64("id").alias("h")) for n in (0, 50000, 10**6))
    pages = visited.pages_for(40000)
    whole = visited.merged(visited.built(a, pages).union(visited.built(b, pages)))
    assert visited.marked(a.union(b), F.col("h"), whole, pages).where("maybe").count() == 40000
    through = visited.marked(c, F.col("h"), whole, pages).where("maybe").count()
    assert through < 0.03 * 20000, through
    assert visited.pages_for(10**12, 1 << 20) == 16 and visited.pages_for(0) == 1


def test_hits_alone_are_exchanged(spark):
    """Rows that the filter doesn't know take no part in the anti-join."""
    past = spark.range(1000).select(F.col("id").alias("k"))
    counts = []
    for start in (0, 500, 1000):
        new = spark.range(start, start + 1000).select(F.col("id").alias("k"))
        pages = visited.pages_for(1000)
        known = visited.built(past.select(visited.hashed(F.col("k")).alias("h")), pages)
        counts.append(visited.marked(new, visited.hashed(F.col("k")), known, pages).where("maybe").count())
    assert counts[0] == 1000 and 500 <= counts[1] < 540 and counts[2] < 40
