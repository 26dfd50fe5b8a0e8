"""What callers inject: strategists, decoders, extractors, goal scores, throttles; and the writers of whole results."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingloom.functions import documents as D
from filingloom.functions import intents as I
from filingloom.operators import html
from filingloom.sources import files, providers
from filingloom.streaming import crawl as C

REPLY = """EXPANDED_INTENT: Find all annual reports.
KEYWORDS: annual, report, 10-K
TARGET_CONTENT_TYPES: Documents, links
FILTERING_STEPS:
- by year
- by type
RELEVANCE_CRITERIA: names the company
NEXT_ACTIONS:
* download"""
LONG = "Find the annual reports and download them, then read the tables of all years"


def test_strategist(spark):
    df = spark.createDataFrame([(1, LONG), (2, "find reports"), (3, LONG + " now")], "id long, intent string")

    def propose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t.endswith("now") else REPLY)

    got = {r["id"]: r["strategy"] for r in I.with_strategy(df, "intent", propose).collect()}
    assert got[1]["expanded_intent"] == "Find all annual reports." and got[1]["keywords"] == ["annual", "report", "10-K"] and got[1]["target_content_types"] == ["documents", "links"]
    assert got[1]["filtering_steps"] == ["by year", "by type"] and got[1]["relevance_criteria"] == "names the company" and got[1]["next_actions"] == ["download"]
    rules = {r["id"]: r["strategy"] for r in I.with_strategy(df, "intent").collect()}
    assert got[2] == rules[2] and got[3] == rules[3] and got[2]["keywords"] == ["find", "reports"]
    many = spark.createDataFrame([(1, LONG)], "id long, intent string").select(I.parsed_strategy(F.lit("KEYWORDS: " + ", ".join(f"w{k}" for k in range(30))), F.col("intent")).alias("s")).first()["s"]
    assert len(many["keywords"]) == 15 and many["expanded_intent"] == LONG


def test_rule_based_intent(spark):
    got = spark.createDataFrame([(" Find the annual report ",)], "t string").select(I.rule_based(F.col("t")).alias("x")).first()["x"]
    assert got["original_intent"] == " Find the annual report " and got["expanded_intent"] == "Find the annual report" and "annual" in got["keywords"] and "links" in got["target_content_types"]
    assert got["filtering_steps"] == ["keyword_matching", "pattern_matching"] and got["next_actions"] == ["follow_relevant_links", "extract_documents"]


@pytest.mark.parametrize(("text", "year"), [("Report 2024", 2024), ("20240131 deadbeef2023", 2024), ("FY25 results", 2025), ("Report 2015, FY2023", 2023), ("x/2021/y", 2021), ("0001234567-22-000001", 2022), ("4Q23 call", 2023), ("results 24", 2024), ("results 31", None), ("2019", None), ("", None)])
def test_year_unguarded(spark, text, year):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(D.year_extended(F.col("t"), 2025, guarded=False).alias("y")).first()["y"] == year


def test_steps_are_the_rules(spark):
    """The columns that are made in steps equal the column functions."""
    texts = ["Q3 2024 Results", "FY25 outlook", "a1b2c3d4e5 2023 report", "abcdef2021abcdef", "", "x" * 200 + ".pdf 2022", "/2020/a", "4q21"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = D.with_year_extended(D.with_year(df, "a", F.col("t"), 2025), "b", F.col("t"), 2025).select("*", D.year(F.col("t"), 2025).alias("c"), D.year_extended(F.col("t"), 2025).alias("d"))
    assert all(r["a"] == r["c"] and r["b"] == r["d"] for r in whole.collect())
    typed = D.with_document_type(df, "a", F.col("t"), F.col("t"), F.lit("")).withColumn("b", D.document_type(F.col("t"), F.col("t"), F.lit("")))
    assert all(r["a"] == r["b"] for r in typed.collect())


def test_goal_scores_steer_the_crawl(spark):
    urls = [f"https://h{k}.example.com/{k}" for k in range(6)]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    links = spark.createDataFrame([(urls[0], 0, urls[1], 0.3), (urls[0], 1, urls[2], 0.9), (urls[2], 0, urls[3], 0.9), (urls[3], 0, urls[4], 0.9)], "url string, ord int, child_url string, priority double")
    none = spark.createDataFrame([], "url string, ord int, file_url string, type string, title string")
    goal = spark.createDataFrame([(urls[0], 0.6), (urls[3], 0.9)], "url string, goal double")

    def visited(**more):
        return {r["url"] for r in C.Crawl(spark, pages, links, none, C.CrawlConfig(), **more).seed(urls[0]).run().visited.collect()}

    assert visited() == {urls[k] for k in (0, 2, 3, 4)}  # 0.3 is below the threshold
    assert visited(goal=goal) == {urls[k] for k in (0, 1, 2, 3)}  # the first page's links gain 0.3; the page at depth 2 is an end


def test_index_cells(spark):
    page = "<table><tr><th>Symbol</th><th>Name</th></tr><tr><td><a href='/q/AB'>AB</a></td><td>Ab Inc</td></tr><tr><td>CD</td><td><a href='/q/CD'>Cd Co</a></td></tr><tr><td>only</td></tr><tr><td>EF</td><td>No link</td></tr></table>"
    got = html.index_cells(spark.createDataFrame([(1, "https://a.com/", page), (2, "https://a.com/", None)], "page_id long, url string, html string")).collect()
    assert [(r["page_id"], r["symbol"], r["company"], r["url"]) for r in got] == [(1, "AB", "Ab Inc", "https://a.com/q/AB"), (1, "CD", "Cd Co", "https://a.com/q/CD")]


def test_decoders_in_turn(spark):
    def broken(content: bytes) -> dict:
        raise RuntimeError("backend missing" if content.startswith(b"a") else "bad file")

    decode = providers.first_of(broken, providers.plain_text, falls_back=lambda e: "backend" in str(e))
    df = spark.createDataFrame([(1, bytearray(b"abc")), (2, bytearray(b"xyz"))], "id long, content binary")
    got = {r["id"]: r["result"] for r in providers.extracted(df, decode).collect()}
    assert got[1]["success"] and got[1]["text_content"] == "abc" and not got[2]["success"] and "bad file" in got[2]["error"]


def test_company_info(spark):
    df = spark.createDataFrame([("Acme (ACME) Inc",), ("Known Co (KNW)",), ("None",)], "text string")
    assert [r["ticker"] for r in providers.company_info(df, "text").collect()] == ["ACME", "KNW", None]
    assert [r["ticker"] for r in providers.company_info(df, "text", lambda s: s.map(lambda t: "ASKED" if "Known" in t else None)).collect()] == ["ACME", "ASKED", None]


def test_throttle():
    waits = []
    work = providers.throttled(lambda x: x + 1, 1.0, 3.0, wait=waits.append, draw=lambda a, b: (a + b) / 2)
    assert [work(k) for k in range(3)] == [1, 2, 3] and waits == [2.0, 2.0]


def test_fetch_by_few_workers(spark):
    df = spark.range(20).selectExpr("concat('u', id) AS url").repartition(8)
    got = providers.fetched(df, lambda u: u.upper(), pause=0.001, workers=2)
    assert got.rdd.getNumPartitions() == 2 and {r["html"] for r in got.collect()} == {f"U{k}" for k in range(20)}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(k, f"c{k}", k // 2) for k in range(5)], "ord long, ticker string, batch int")
    files.by_batch_and_whole(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/batches/batch=1")).count() == 2 and spark.read.json(str(tmp_path / "out/combined")).count() == 5
    files.write_dated(df, df.limit(1), str(tmp_path / "dated"), "20250101_000000")
    assert spark.read.json(str(tmp_path / "dated/ir_pages_20250101_000000")).count() == 1
    with pytest.raises(Exception, match="(?i)exist"):
        files.write_dated(df, df, str(tmp_path / "dated"), "20250101_000000")


def test_object_store_round_trip(spark, tmp_path):
    """Create, upload, list, fetch, compare, remove, on any file system that Spark writes to."""
    import shutil

    root = f"file://{tmp_path}/store"
    df = spark.createDataFrame([(k, "x" * k) for k in range(9)], "k long, v string")
    files.upload(df, root, "20250101")
    names = {r["path"].rsplit("/", 2)[1] for r in files.listed(spark, root, "*.json").collect()}
    assert names == {"20250101", "latest"} and files.listed(spark, root, "*.json").agg(F.sum("size")).first()[0] > 0
    lines = b"".join(bytes(r["content"]) for r in files.fetched_objects(spark, f"{root}/latest", "*.json").collect()).splitlines()
    assert len(lines) == 9 and sorted(map(tuple, spark.read.schema(df.schema).json(f"{root}/20250101").collect())) == sorted(map(tuple, df.collect()))
    shutil.rmtree(tmp_path / "store")


def test_crawl_state(spark, tmp_path):
    (tmp_path / "state.json").write_text('{"visited_urls": ["a"], "queued_urls": [], "queue_items": [{"priority": -1.0, "url": "b", "depth": 1}], "results": {}, "statistics": {"pages_crawled": 3}}')
    row = files.crawl_state(spark, str(tmp_path / "state.json")).first()
    assert row["visited_urls"] == ["a"] and row["queue_items"][0]["url"] == "b" and row["statistics"]["pages_crawled"] == 3
