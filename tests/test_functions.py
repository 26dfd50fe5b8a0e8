"""Golden values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from filingloom.functions import documents as D
from filingloom.functions import intents as I
from filingloom.functions import urls as U
from filingloom.operators import filters, ranking, resolve


def values(spark, column, rows, *names):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    ("build", "cases"),
    [
        (lambda c: D.year(c, 2025), {"Q3 2024 Results": 2024, "Annual Report 2012 restated 2023": None, "FY25 outlook": 2025, "fy 199": None, "20240131 filing": None, "report_20240131.pdf": 2024, "abcdef2024fade": None, "Data 2030 plan FY24": 2024, "": None}),
        (D.quarter, {"Q3 2024": 3, "Q3-2024": None, "q3_2024": None, "4Q 2023 Q1": 1, "10-Q": None, "form-2 x": 2, "ends q4": 4, "Q12 ": None}),
        (D.date_text, {"July 25, 2024 and q3 2024": "q3 2024", "2024Q1 x": "2024Q1", "FY2024 report": "FY20", "Mar 3 2021": "Mar 3 2021", "none": None}),
        (D.revenue, {"Total revenue: $81.4 billion": "81.4", "revenue, which grew": ",", "revenue grew 5": None}),
        (D.profit, {"Net income $1,234.5 million, profit 9": "1,234.5", "profit 7": "7"}),
        (U.canonical, {"HTTPS://Ex.COM/a/b/?b=2&a=1#top": "https://ex.com/a/b?a=1&b=2", "https://ex.com": "https://ex.com/", "https://ex.com/A/?x=&y=1 2": "https://ex.com/A?y=1+2", "https://ex.com/p;v=1?z=%20&z=a": "https://ex.com/p;v=1?z=+&z=a", "http://h/?b=2&a=1&c=&a=0": "http://h/?a=1&a=0&b=2", "MAILTO:a@b.c": "mailto:a@b.c", "/x/?b=&a=1": "/x?a=1"}),
        (U.without_query, {"https://a/B/?x=1#y": "https://a/B/", "https://a#y?z": "https://a"}),
        (U.host, {"https://A.com:80/x": "a.com:80", "nothing": ""}),
        (U.extension, {"https://a/b.XLSX": ".xlsx", "https://a/b.xls?x": ".xls", "https://a/b": ".unknown"}),
        (lambda c: U.root_domain(U.bare_host(c)), {"https://www.ir.apple.com/x": "apple.com", "https://localhost/": "localhost"}),
        (D.name_from_url, {"https://a/My-Report_2024.PDF?x": "My Report 2024", "https://a/": "Financial Document", "https://a/q%20one+two.pdf": "q one+two"}),
        (D.safe_name, {" .a<b>:c  d. ": "a_b__c d", "": "document", "x" * 160 + ".pdf": "x" * 146 + ".pdf"}),
        (D.safe_company, {"A/B \\ C*, Inc.": "A_B _ C Inc.", "***": "Unknown_Company"}),
        (D.file_name_type, {"FORM 10-K.pdf": "10-K Annual Report", "x": "Other PDF Document"}),
        (D.bracketed_ticker, {"Apple (AAPL) x": "AAPL", "Apple": None}),
        (D.result_bucket, {"PDF": "documents", "video": "media", "News Item": "press_releases", "odd": "documents"}),
        (lambda c: I.section(c, "KEYWORDS", "NEXT"), {"keywords: a, b \nNEXT: c": "a, b", "nothing": None}),
        (lambda c: F.array_join(I.content_words(c), ","), {"The Übergang of reports and Reports": "übergang,reports"}),
        (I.is_complex, {"short": False, "a, b, c, d": True, "when it rains": True}),
        (U.profile_ticker, {"https://x/quotes/ab?c": "AB", "https://x/symbol/q/r": "Q", "https://x/": None}),
        (lambda c: D.year_extended(c, 2025), {"x/2024/y": 2024, "a-2022-b": 2022, "4Q23 call": 2023, "results 24": 2024, "nothing": None}),
    ],
)
def test_golden(spark, build, cases):
    assert dict(zip(cases, values(spark, build(F.col("t")), list(cases), "t"), strict=True)) == cases


def test_resolve_reference(spark):
    rows = [("https://a.com/x/y", "../z"), ("https://a.com/x", "//b.com/q"), ("https://a.com/x", "?k=1"), ("http://[bad", "x"), ("https://a.com", None)]
    assert values(spark, U.resolve("base", "href"), rows, "base", "href")[:3] == ["https://a.com/z", "https://b.com/q", "https://a.com/x?k=1"]


def test_link_scores(spark):
    rows = [("https://ex.com/investor-relations", "Investor Relations"), ("https://ir.ex.com/", "Home"), ("https://ex.com/first", "First aid"), ("https://ex.com/docs/10-k.pdf", "Annual Report 10-K"), ("https://ex.com/investors", "Investors")]
    df = spark.createDataFrame([(1, i, "internal", u, t, "") for i, (u, t) in enumerate(rows)], "page_id int, ord int, category string, url string, text string, title string")
    assert {r["ord"]: r["ir_score"] for r in filters.weighted_links(df, [], ["page_id"]).collect()} == {0: 150, 1: 80, 3: 65, 4: 135}


def test_priorities(spark):
    rows = [(0, "internal", "https://a.com/x", None), (1, "external", "https://a.com/k1/k2/pdf", 2.0), (2, "navigation", "https://a.com/a/k1/login/pdf", 1.0), (3, "navigation", "https://a.com/x", None)]
    df = spark.createDataFrame([(1, i, c, u, "", "", r) for i, c, u, r in rows], "page_id int, ord int, category string, url string, text string, title string, relevance_score double")
    got = {r["ord"]: r["final_priority"] for r in filters.priorities(df, ["k1", "k2"], ["documents"], ["page_id"]).collect()}
    assert got == {0: 1.0, 1: 2.4, 2: 0.63}


def test_latest_per_type(spark):
    rows = [(0, 2023, 4), (1, 2024, None), (2, 2024, 2), (3, None, 4)]
    df = spark.createDataFrame([("T", "K", *r, 1.0) for r in rows], "ticker string, document_type string, ord int, extracted_year int, extracted_quarter int, relevance_score double")
    assert [r["ord"] for r in ranking.latest_per_type(df).collect()] == [2]
    assert [r["ord"] for r in ranking.latest_per_type(df.where("extracted_year is null or ord < 0").unionByName(df.where("ord = 3").withColumn("ord", F.lit(9)))).collect()] == [3]


def test_candidates(spark):
    df = spark.createDataFrame([("AAPL", "https://www.apple.com/")], "ticker string, company_website string")
    got = [r["url"] for r in resolve.candidates(df).orderBy("ord").collect()]
    assert len(got) == 19 and got[0] == "https://investor.apple.com" and got[14] == "https://s2.q4cdn.com/aapl/" and got[-1] == "https://irapple.com"
