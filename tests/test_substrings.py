"""The substring join against a loop over all pairs."""

import random

import pytest

from filingloom.operators import substrings


@pytest.mark.parametrize("most", [1000, 0])
def test_matches(spark, most):
    rng = random.Random(2)
    texts = [(i, i % 3, "".join(rng.choice("abcd é😀") for _ in range(rng.choice([0, 1, 2, 5, 40])))) for i in range(120)] + [(500, 0, None), (501, 0, "aaaa" * 50)]
    patterns = ["".join(rng.choice("abcd é😀") for _ in range(rng.choice([1, 2, 3, 4, 6]))) for _ in range(300)] + ["", None, "aaaaaaaaa", "never there"]
    got = substrings.matches(spark.createDataFrame(texts, "id long, part int, body string"), ["id", "part"], "body", spark.createDataFrame([(p,) for p in patterns], "pattern string"), most=most, salts=3, every=1)
    rows = [(r["id"], r["part"], r["pattern"]) for r in got.collect()]
    assert sorted(rows) == sorted((i, k, p) for i, k, t in texts if t for p in set(patterns) if p and p in t)


def test_nothing(spark):
    texts, patterns = spark.createDataFrame([(1, "abc")], "id long, text string"), spark.createDataFrame([("b",)], "pattern string")
    assert substrings.matches(texts, ["id"], "text", patterns.where("false")).count() == 0 and substrings.matches(texts.where("false"), ["id"], "text", patterns).count() == 0
    assert substrings.matches(texts, ["id"], "text", patterns).columns == ["id", "pattern"]


def test_a_pattern_is_filed_once_under_its_rarest_gram(spark):
    texts = spark.createDataFrame([(k, "the cat") for k in range(20)] + [(99, "the quix")], "id long, text string")
    filed = {r["pattern"]: r["gram"] for r in substrings.index(spark.createDataFrame([("the qu",), ("a",)], "pattern string"), texts, "text", every=1).collect()}
    assert filed == {"the qu": " qu", "a": "a"}


def test_a_small_index_moves_no_text(spark):
    texts, patterns = spark.createDataFrame([(1, "abc")], "id long, text string"), spark.createDataFrame([("bc",)], "pattern string")
    plan = substrings.matches(texts, ["id"], "text", patterns)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_many_patterns_fetch_no_more_than_stands_in_a_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHARACTERS", 50)
    long = "x" * 70 + "é😀"
    texts = [(k, f"/{k}/doc_{k % 7}.") for k in range(300)] + [(400, long + "y"), (401, None), (402, "")]
    patterns = [f"/{k}/" for k in range(2000)] + ["_3.", "é", "x" * 64, "x" * 65, long, "y" * 70]
    df = substrings.matches(spark.createDataFrame(texts, "id long, text string"), ["id"], "text", spark.createDataFrame([(p,) for p in patterns], "pattern string"), most=10)
    assert sorted((r["id"], r["pattern"]) for r in df.collect()) == sorted((i, p) for i, t in texts if t for p in set(patterns) if p in t)
    few = substrings.matches(spark.createDataFrame(texts, "id long, text string"), ["id"], "text", spark.createDataFrame([(p,) for p in patterns[:2002]], "pattern string"), most=10)
    assert "__gram" not in few._jdf.queryExecution().toString()  # no grams are made or moved
