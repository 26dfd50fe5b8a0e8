"""Chains and modes on small inputs."""

import pandas as pd
import pytest
from test_html import PAGE

from filingloom.operators import discovery, filters, ranking, resolve, scorers, summaries

INTENT = {"keywords": ["report"], "expanded_intent": "find report", "target_content_types": ["links", "documents"]}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, "https://site.com/dir/page", PAGE)], "page_id int, url string, html string")


def test_page_by_intent(spark, pages):
    got = discovery.page_by_intent(pages, INTENT)
    assert [r["text"] for r in got["documents"].collect()] == ["Report"] and got["images"].count() == 0 and got["structure"].count() == 0
    assert [(r["url"], r["final_priority"]) for r in got["next_links"].collect()] == [("https://site.com/dir/report.pdf", 2.1), ("https://site.com/dir/report.pdf?x=1", 2.1)]
    investor = discovery.page_by_intent(pages, INTENT | {"expanded_intent": "investor pages"})
    assert investor["links"].count() == 0 or investor["links"].columns
    with pytest.raises(ValueError):
        filters.by_intent({}, INTENT, ["page_id"], "other")


def test_scorer_mode(spark, pages):
    got = discovery.page_by_intent(pages, INTENT, "ai", scorer=lambda t: t.str.contains("pdf").map({True: 0.9, False: None}).where(lambda s: s.notna(), None))
    assert {r["relevance_score"] for r in got["links"].collect()} == {0.9, 0.5}
    assert discovery.first_pdfs(pages).count() == 2


def test_company_documents(spark):
    rows = [(0, "A", 0, 0, "https://a/files/doc_1.pdf?x", "10-Q Q3 2023"), (0, "A", 0, 1, "https://a/files/doc_1.pdf", "again"), (0, "A", 1, 0, "https://a/10-q_2.pdf", "10-Q Q1 2024 "), (1, "B", 0, 0, "https://a/files/doc_1.pdf", "B"), (1, "B", 0, 1, "https://b/My-File.xlsx", "x"), (1, "B", 0, 2, "https://b/page", "no file")]
    links = spark.createDataFrame(rows, "company_ord int, ticker string, page_ord int, ord int, url string, text string")
    whole, latest, quarterly = discovery.company_documents(links, 2025)
    got = {r["url"]: r for r in whole.collect()}
    assert set(got) == {"https://a/files/doc_1.pdf?x", "https://a/10-q_2.pdf", "https://b/My-File.xlsx"}
    assert got["https://b/My-File.xlsx"]["title"] == "My File.xlsx" or got["https://b/My-File.xlsx"]["title"] == "My File"
    assert [(r["ticker"], r["extracted_year"], r["extracted_quarter"]) for r in latest.where("document_type = '10-Q Quarterly Report'").collect()] == [("A", 2024, 1)]
    assert {r["ticker"]: r["document_type"] for r in quarterly.collect()} == {"A": "10-Q Quarterly Report", "B": "Excel Data"}


def test_index_companies(spark, pages):
    links = spark.createDataFrame([("AB", 0, "https://www.ab.com/about", "About", ""), ("AB", 1, "https://ab.com/investors", "Investors", ""), ("AB", 2, "https://twitter.com/ab", "T", "")], "ticker string, ord int, url string, text string, title string")
    whole, report = discovery.index_companies(pages, "https://site.com", spark.createDataFrame([], "url string, html string"), links)
    assert [(r["ticker"], r["company_website"], r["investor_relations_url"], r["extraction_method"]) for r in whole.collect()] == [("AB", "https://www.ab.com/about", "https://ab.com/investors", "known")]
    assert report.first()["success_rate"] == 1.0


def test_refined_links(spark):
    links = spark.createDataFrame([(1, i, f"https://a/{i}", f"T{i}") for i in range(7)], "page_id int, ord int, url string, text string")
    got = [r["refined_intent"] for r in discovery.refined_links(links, [], "root", ["page_id"], lambda t: "asked " + t.astype(str)).orderBy("ord").collect()]
    assert got[4] == "asked T4 https://a/4" and got[5] == "Explore 't5' to find content relevant to: root"
    assert discovery.refined_links(links, ["documents"], "root", ["page_id"]).count() == 7


def test_no_keywords_change_nothing(spark):
    df = spark.createDataFrame([(1, 0, "u", "t", "", "internal")], "page_id int, ord int, url string, text string, title string, category string")
    assert filters.links(df, [], ["page_id"]).columns == df.columns and filters.enhanced_links(df, [], ["page_id"]).count() == 1


def test_document_prefilter(spark):
    rows = [(1, i, "k" if i % 3 == 0 else "n", "") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id int, ord int, url string, text string")
    assert [r["ord"] for r in scorers.documents(df, ["k"], ["page_id"]).orderBy("rank").collect()] == list(range(0, 30, 3))
    assert scorers.summaries(df, df["url"], lambda t: pd.Series(["s"] * len(t))).first()["summary"] == "s"


def test_path_search(spark):
    edges = spark.createDataFrame([(0, 1, 3, 0), (0, 2, 5, 1), (0, 3, 1, 2), (0, 4, 2, 3), (1, 5, 4, 0), (1, 0, 9, 1), (4, 6, 6, 0)], "src int, dst int, score int, ord int")
    got = {tuple(r["path"]): r["confidence"] for r in ranking.path_search(edges, spark.createDataFrame([(0,)], "node int")).collect()}
    assert got == {(0, 2): 5, (0, 1, 5): 4, (0, 4, 6): 6}


def test_empty_reports(spark):
    companies = spark.createDataFrame([("A", None, None)], "ticker string, company_website string, investor_relations_url string")
    none = spark.createDataFrame([], "ticker string, file_extension string, extracted_year int")
    assert summaries.extraction(companies, none, 2025).first()["documents"] == 0 and summaries.resolution(companies.where("false")).first()["success_rate"] == 0
    pages = spark.createDataFrame([], "url string, html string")
    links = spark.createDataFrame([], "ticker string, ord int, url string, text string, title string")
    assert resolve.resolve(companies, pages, links).first()["extraction_method"] == "none" and resolve.to_review(companies).count() == 1
