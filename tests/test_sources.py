"""Readers, writers and providers on small files."""

import json

from pyspark.sql import functions as F

from filingloom.operators import ranking
from filingloom.sources import files, providers


def test_companies(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps([{"ticker": "A", "company_name": "Aa", "investor_relations_url": "https://a"}, {"url": "https://b", "type": "IR_PAGE", "ticker": "no", "metadata": {"ticker": "B", "company_name": "Bb"}}, {"company_name": "C"}, {"ticker": "no", "metadata": {"company_name": "D"}}]))
    rows = [(r["ord"], r["ticker"], r["investor_relations_url"]) for r in files.companies(spark, str(path)).orderBy("ord").collect()]
    assert rows == [(0, "A", "https://a"), (1, "B", "https://b"), (2, "UNKNOWN", None), (3, "UNKNOWN", None)]
    assert [r["ord"] for r in files.companies(spark, str(path), 1, 3).orderBy("ord").collect()] == [1, 2]


def test_documents(spark, tmp_path):
    docs = {"A": [{"title": "one", "url": "u1", "document_type": "X", "extracted_year": 2024}], "B": [{"title": "two", "url": "u2"}, {"title": "three", "url": "u3"}]}
    for name, whole in (("bare", docs), ("wrapped", {"all_documents": docs, "latest_quarterly_reports": {}})):
        path = tmp_path / name
        path.write_text(json.dumps(whole))
        got = files.documents(spark, str(path))
        assert {(r["ticker"], r["ord"], r["title"]) for r in got.collect()} == {("A", 0, "one"), ("B", 0, "two"), ("B", 1, "three")}
        assert files.documents(spark, str(path), ["B"]).count() == 2
    back = json.loads(files.document_map(got, got.where("ticker = 'A'")).first()[0])
    assert [d["title"] for d in back["all_documents"]["B"]] == ["two", "three"] and back["latest_quarterly_reports"]["A"]["title"] == "one"


def test_reports(spark, tmp_path):
    folder = tmp_path / "AB - Alpha + Beta"
    folder.mkdir()
    (folder / "10-K 2023 Q4.pdf").write_bytes(b"Total revenue: $5 million. Net income 2")
    (folder / "x.txt").write_text("no")
    (folder / "_metadata.json").write_text('{"ticker": "AB"}')
    got = files.report_folder(spark, str(tmp_path)).collect()
    assert [(r["ticker"], r["company_name"], r["document_type"], r["extracted_year"], r["extracted_quarter"], r["metadata"]) for r in got] == [("AB", "Alpha + Beta", "10-K Annual Report", 2023, 4, '{"ticker": "AB"}')]
    content = spark.read.format("binaryFile").load(str(folder / "*.pdf")).select("content")
    results = providers.extracted(files.report_folder(spark, str(tmp_path)).join(content)).cache()
    assert [(r["revenue"], r["profit"]) for r in providers.financial_metrics(results).collect()] == [("5", "2")]
    assert providers.document_summary(results).first()["extraction_success"]
    failed = providers.extracted(spark.createDataFrame([(bytearray(b"x"),)], "content binary"), decode=lambda c: 1 / 0).first()["result"]
    assert not failed["success"] and "ZeroDivisionError" in failed["error"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, 0), ("B", 2, 1)], "ticker string, x int, batch int")
    files.by_ticker(df, str(tmp_path / "t"))
    files.by_batch(df, str(tmp_path / "b"))
    files.write_csv(df, str(tmp_path / "c"))
    files.upload(df, str(tmp_path / "u"), "2024-01-01")
    files.upload(df, str(tmp_path / "u"), "2024-01-02")
    assert (tmp_path / "t" / "ticker=A").exists() and spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert spark.read.json(str(tmp_path / "b")).count() == 2 and spark.read.json(str(tmp_path / "u" / "latest")).count() == 2


def test_fetch_and_download(spark, tmp_path):
    calls = spark.createDataFrame([("https://a/x",), ("https://bad",)], "url string")

    def fetch(u):
        if "bad" in u:
            raise OSError("no")
        return "<p>ok"

    got = {r["url"]: r for r in providers.fetched(calls, fetch, tries=2, wait=lambda s: None).collect()}
    assert got["https://a/x"]["success"] and got["https://bad"]["tries"] == 2 and "OSError" in got["https://bad"]["error"]
    pages = spark.createDataFrame([("HTTPS://A/x/", "<p>stored")], "url string, html string")
    assert {r["url"]: r["success"] for r in providers.stored(calls, pages).collect()} == {"https://a/x": True, "https://bad": False}

    def save(url, folder, name):
        if "bad" in url:
            raise OSError("no")
        return 2**20

    docs = spark.createDataFrame([("https://a", "f", "1"), ("https://bad", "f", "2"), ("https://b", "f", "3")], "url string, folder string, file_name string")
    there = spark.createDataFrame([("f", "3")], "folder string, file_name string")
    assert {r["file_name"]: (r["status"], r["size_mb"]) for r in providers.downloaded(docs, there, save, 1).collect()} == {"1": ("downloaded", 1.0), "2": ("failed", 0.0), "3": ("skipped", 0.0)}


def test_empty_companies_stay(spark):
    companies = spark.createDataFrame([("A",), ("B",)], "ticker string")
    rows = ranking.regrouped(spark.createDataFrame([("A", 1, "x"), ("A", 0, "y")], "ticker string, ord int, url string"), "ticker", "url")
    assert {r["ticker"]: [x["url"] for x in r["rows"]] for r in ranking.without_empty(rows, companies).collect()} == {"A": ["y", "x"], "B": []}


def test_target_paths(spark):
    df = spark.createDataFrame([("A", "A/B Co", "Press Release", "Quarterly results and outlook", 2024, 3, ".pdf")], "ticker string, company_name string, document_type string, title string, extracted_year int, extracted_quarter int, file_extension string")
    r = files.target_paths(df).first()
    assert (r["folder"], r["file_name"]) == ("A - A_B Co", "Press Release - 2024_Q3 - Quarterly results and outlook.pdf")
    assert files.manifests(df.withColumn("ord", F.lit(0)), df.select("ticker", F.lit("failed").alias("status"))).count() == 1
