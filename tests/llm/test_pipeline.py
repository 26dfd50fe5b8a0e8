"""Queries against their SQL, and each stage of the pipeline against plain Python."""

import collections

import corpus_pipeline
import duckdb
import plain
import pytest

from filingloom.llm import language_id, queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DIR), con.sql(queries.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(repr(tuple(r[c] for c in want.columns)) for r in got.collect()) == sorted(map(repr, want.fetchall()))


def test_names():
    assert sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [n for k in range(1, 11) for n in queries.QUERIES if n.startswith(f"op{k}_")]


def held(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    steps = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        steps.append(held(spark, stage(spark, steps[-1], DIR), tmp_path / str(k)))
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps]
    assert all(s.columns == docs.columns for s in steps[:5])
    from pyspark.sql import functions as F

    rejected = {r["doc_id"] for r in language_id.predict(docs, language_id.fit(docs, F.lit(True))).where("rejected").collect()}
    assert set(texts[1]) == set(texts[0]) - rejected and len(rejected) < 10
    rows = sorted(texts[1].items())
    assert set(texts[2]) == {c for (d, _), (n, c) in zip(rows, plain.groups(rows), strict=True)}
    cut = plain.cut(sorted(texts[2].items()))
    assert texts[3] == {d: (v[3] if v[1] else t) for (d, t), v in cut.items()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaked = {d for d, _ in plain.leaks(sorted(texts[3].items()), items)}
    assert set(texts[4]) == set(texts[3]) - leaked
    sums, largest = collections.defaultdict(int), collections.defaultdict(int)
    last = steps[5].collect()
    for r in last:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        sums[r["source"]] += r["taken"]
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * len(plain.words(r["text"]))
    assert texts[5] == texts[4] and all(abs(sums[r["source"]] - r["target"]) <= largest[r["source"]] + 1 for r in last)


def test_run_cuts_between_stages(spark, monkeypatch):
    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.where("doc_id % 2 = 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", stage), ("b", stage), ("c", stage)])
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert corpus_pipeline.run(spark, DIR).count() == docs.where("doc_id % 2 = 0").count()
    assert read[0] and read[1:] == [[], []]


def test_odd_rows(spark, tmp_path):
    df = plain.odd(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = held(spark, stage(spark, df, DIR), tmp_path / str(k))
        if name == "mix":
            assert set(got.columns) == set(df.columns) | {"size", "source_size", "target", "rate", "copies", "taken"} and got.schema["size"].dataType.typeName() == "long"
        else:
            assert got.columns == df.columns
        assert got.count() <= df.count() and {r["host"] for r in got.collect()} == {"host"}
        assert held(spark, stage(spark, df.where("false"), DIR), tmp_path / f"none{k}").count() == 0
    kept = corpus_pipeline.near_duplicates(spark, df, DIR)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted({(r[0], r[1]) for r in plain.ODD} - {(6, "one two three")}, key=repr)
    assert corpus_pipeline.mix(spark, df, DIR).count() == len(plain.ODD)


def test_equal_documents_of_two_sources(spark):
    """Rows of one id and text: which stays doesn't hang on their order; in the mix each is a document."""
    rows = [(1, "a b c d e f g", "en", s, k) for k, s in enumerate("zyxw")]
    one = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [[tuple(r) for r in corpus_pipeline.near_duplicates(spark, x, DIR).collect()] for x in (one, spark.createDataFrame(rows[::-1], one.schema))]
    assert len(kept[0]) == 1 and kept[0] == kept[1]
    assert corpus_pipeline.mix(spark, one, DIR).count() == 4
