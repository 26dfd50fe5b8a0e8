"""The crawl as a stream of hosts: what it visits, its pace, and a restart."""

import time

from test_crawl import graph, plain

from filingloom.sources.stage import Files
from filingloom.streaming import crawl as C
from filingloom.streaming import host_crawl as H

LINKS, FILES = "url string, ord int, child_url string, priority double", "url string, ord int, file_url string, type string, title string"


def test_visits_of_the_rounds(spark, tmp_path):
    pages, links, files = graph(1)
    config = C.CrawlConfig(max_documents=10**6, max_depth=50, max_queue_size=10**6, timeout_seconds=10**6, rate_limit_delay=0.3)
    tables = (spark.createDataFrame([(p,) for p in pages], "url string"), spark.createDataFrame(links, LINKS), spark.createDataFrame(files, FILES))
    root, starts = str(tmp_path / "crawl"), [("a", "https://h0.example.com/0"), ("b", "https://h2.example.com/7")]
    H.request(spark.createDataFrame(starts, "crawl string, url string"), root)
    query = H.start(spark, root, *tables, config, every="200 milliseconds")
    until = time.monotonic() + 120
    while H.table(spark, root, "visits").count() < 6 and time.monotonic() < until:
        time.sleep(0.5)
    query.stop()
    before = H.table(spark, root, "visits").count()
    query = H.start(spark, root, *tables, config, every="200 milliseconds")  # from the checkpoint
    H.until_quiet(query, 1.0, most=240)
    query.stop()
    seen = H.table(spark, root, "visits").collect()
    found = H.table(spark, root, "files").collect()
    assert 6 <= before < len(seen)
    for k, u in starts:
        results, visited = plain(pages, links, files, config, u)
        assert sorted(r["url"] for r in seen if r["crawl"] == k) == sorted(visited)
        assert sorted((r["url"], r["found_on_page"]) for r in found if r["crawl"] == k) == sorted((a, b) for a, b, _ in results)
    for host in {r["host"] for r in seen}:
        at = sorted(r["at"] for r in seen if r["host"] == host)
        assert all(y - x >= 300 for x, y in zip(at, at[1:]))
    assert Files(spark, root).names(f"{root}/checkpoint")


def test_best_lane_first(spark, tmp_path):
    root = str(tmp_path / "crawl")
    spark.createDataFrame([("a", f"https://h.example.com/{k}", 0, None, p) for k, p in enumerate([-0.5, -1.0, -0.7, -1.0, -0.5])], H.REQUEST).coalesce(1).write.parquet(f"{root}/requests/seeds")
    none = (spark.createDataFrame([], "url string"), spark.createDataFrame([], LINKS), spark.createDataFrame([], FILES))
    query = H.start(spark, root, *none, C.CrawlConfig(rate_limit_delay=0.05), every="100 milliseconds")
    H.until_quiet(query, 1.0, most=120)
    query.stop()
    seen = sorted(H.table(spark, root, "visits").collect(), key=lambda r: r["at"])
    assert [r["url"][-1] for r in seen] == ["1", "3", "2", "0", "4"]


def test_without_a_delay_as_many_batches_as_it_is_deep(spark, tmp_path):
    root, urls = str(tmp_path / "crawl"), [f"https://h.example.com/{k}" for k in range(60)]
    pages = spark.createDataFrame([(u,) for u in urls[:40]], "url string")
    links = spark.createDataFrame([(urls[0], k, u, 0.4 if k > 50 else 0.5 + k / 200) for k, u in enumerate(urls)], LINKS)
    H.request(spark.createDataFrame([("a", urls[0]), ("b", urls[0])], "crawl string, url string"), root)
    query = H.start(spark, root, pages, links, spark.createDataFrame([], FILES), C.CrawlConfig(rate_limit_delay=0.0), every="0 seconds", tasks=2)
    H.until_quiet(query, 1.0, most=120)
    states = {p["stateOperators"][0]["numShufflePartitions"] for p in query.recentProgress}
    query.stop()
    seen = H.table(spark, root, "visits").collect()
    assert sorted((r["crawl"], r["url"], r["success"]) for r in seen) == sorted((c, u, u in urls[:40]) for c in "ab" for u in urls[:51])
    assert len({r["at"] for r in seen}) == 2  # the seeds, and all their links
    assert states == {2} and spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_a_batch_opens_the_drawers_of_its_visits(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('https://h.example.com/', id) url", "id")
    kept = H.filed(rows, str(tmp_path / "links"))
    own = kept.where("url = 'https://h.example.com/7'").first()
    some = kept.where(f"drawer in ({own['drawer']})")
    assert len(some.inputFiles()) >= 1 and sorted(r["id"] for r in kept.collect()) == list(range(2000))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and 7 in {r["id"] for r in some.collect()} and some.count() < 100
    assert H.filed(rows.where("false"), str(tmp_path / "links")).count() == 2000  # kept once
