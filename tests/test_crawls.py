"""Many crawls in one run against the plain crawl of each seed; the log that keeps their state."""

import pytest
from pyspark.sql import functions as F
from test_crawl import graph, plain

from filingloom.plans import queries
from filingloom.sources.log import Log
from filingloom.sources.stage import Files
from filingloom.streaming import crawl as C
from filingloom.streaming import crawls

LINKS, FILES = "url string, ord int, child_url string, priority double", "url string, ord int, file_url string, type string, title string"


def made(spark, seed, config, folder=None, **how):
    pages, links, files = graph(seed)
    return crawls.Crawls(spark, spark.createDataFrame([(p,) for p in pages], "url string"), spark.createDataFrame(links, LINKS), spark.createDataFrame(files, FILES), config, folder=folder, **how)


def same(done, seed, config, starts):
    pages, links, files = graph(seed)
    got, seen = {}, {}
    for r in done.results().collect():
        got.setdefault(r["crawl"], []).append((r["url"], r["found_on_page"], r["depth"]))
    for r in done.visited().collect():
        seen.setdefault(r["crawl"], []).append(r["url"])
    for k, u in starts:
        results, visited = plain(pages, links, files, config, u)
        assert sorted(got.get(k, [])) == results and sorted(seen.get(k, [])) == sorted(visited), k


@pytest.mark.parametrize("seed,config", [(1, C.CrawlConfig(batch=3, max_queue_size=6, max_depth=3)), (2, C.CrawlConfig(max_documents=5, rate_limit_delay=2.0))])
def test_each_crawl_is_the_single_one(spark, seed, config):
    starts = [(f"c{k}", f"https://h{k % 5}.example.com/{k}") for k in (0, 1, 7, 13)] + [("none", "https://nowhere.example.com/")]
    done = made(spark, seed, config, fold_every=3).seed(spark.createDataFrame(starts, "crawl string, url string")).run()
    same(done, seed, config, starts)
    tally = {r["crawl"]: r for r in done.tally().collect()}
    assert all(tally[k]["queued"] == n for k, n in ((r["crawl"], r["count"]) for r in done.queue().groupBy("crawl").count().collect()))


def test_a_run_that_is_killed_goes_on(spark, tmp_path, monkeypatch):
    config, starts = C.CrawlConfig(batch=3, max_depth=4), [("a", "https://h0.example.com/0"), ("b", "https://h2.example.com/7")]
    own = made(spark, 1, config, str(tmp_path / "log"), fold_every=2).seed(spark.createDataFrame(starts, "crawl string, url string"))
    add, at = Log.add, iter((2, 7, 9, 99))
    left = [next(at)]

    def killed(self, table, rows):
        left[0] -= 1
        if left[0] < 0:
            raise KeyboardInterrupt
        return add(self, table, rows)

    monkeypatch.setattr(Log, "add", killed)
    for _ in range(3):  # between two writes of a round, each time another
        with pytest.raises(KeyboardInterrupt):
            own.run()
        left[0] = next(at)
        own = made(spark, 1, config, str(tmp_path / "log"), fold_every=2).resume()
    left[0] = 10**6
    same(own.run(), 1, config, starts)


def test_a_round_writes_what_it_changes(spark, tmp_path):
    """A chain of pages with one link each: whatever has been visited, a round writes as much as the one before."""
    n = 30
    pages = spark.range(n).select(F.concat(F.lit("https://h.example.com/"), F.col("id").cast("string")).alias("url"))
    links = spark.range(n - 1).select(F.concat(F.lit("https://h.example.com/"), F.col("id").cast("string")).alias("url"), F.lit(0).alias("ord"), F.concat(F.lit("https://h.example.com/"), (F.col("id") + 1).cast("string")).alias("child_url"), F.lit(0.9).alias("priority"))
    own = crawls.Crawls(spark, pages, links, spark.createDataFrame([], FILES), C.CrawlConfig(max_depth=n), folder=str(tmp_path / "log"), fold_every=50)
    own.seed(spark.createDataFrame([("x", "https://h.example.com/0")], "crawl string, url string"))
    own.log.fan = 50
    written, before = [], 0
    for _ in range(8):
        own.step()
        total = Files(spark, str(tmp_path)).size(str(tmp_path / "log"))
        written.append(total - before)
        before = total
    assert max(written[2:]) < 1.2 * min(written[2:]), written
    assert own.visited().count() == 8
    longest = max(own.paths().collect(), key=lambda r: len(r["path"]))
    assert longest["path"] == [f"https://h.example.com/{k}" for k in range(8)]


def test_log(spark, tmp_path):
    log = Log(spark, str(tmp_path), {"t": "x int", "u": "x int"}, fan=3)
    for k in range(20):
        log.add("t", spark.createDataFrame([(k,)], "x int"))
        log.merge("t")
        if k == 10:
            log.add("u", spark.createDataFrame([(1,), (2,)], "x int"))
            log.fold("u", log.read("u").where("x > 1"))
        log.commit(k=k)
    log.add("t", spark.createDataFrame([(99,)], "x int"))  # never committed
    again = Log(spark, str(tmp_path), log.schemas, fan=3).resume()
    assert again.notes == {"k": 19} and sorted(r["x"] for r in again.read("t").collect()) == list(range(20)) and [r["x"] for r in again.read("u").collect()] == [2]
    assert [k for k, _ in again.segments["t"]] == [2, 2, 0, 0] and len(Files(spark, str(tmp_path)).names(str(tmp_path / "commits"))) == 2
    assert len(list((tmp_path / "t").iterdir())) == 5  # what was merged is gone
    with pytest.raises(FileExistsError):
        Files(spark, str(tmp_path)).put(str(tmp_path / "commits" / f"{again.number:010d}"), "x")


@pytest.mark.parametrize("depth", [0, 1, 5, 64])
def test_ancestry(spark, depth):
    rows = [(c, k, None if k == 0 else (k - 1 if c == "chain" else (k - 1) // 2), f"{c}{k}") for c in ("chain", "tree") for k in range(depth + 1)]
    want = {}
    for c, k, up, u in rows:
        want[c, k] = [*want.get((c, up), []), u]
    got = crawls.ancestry(spark.createDataFrame(rows, "c string, seq long, parent long, url string"), depth, "c").collect()
    assert {(r["c"], r["seq"]): r["path"] for r in got} == want


def test_query(spark, tmp_path):
    """Each crawl of the query is the plain crawl from its part."""
    import random

    rng = random.Random(5)
    rows = [(k, 1 + k % 7, rng.randint(1, 40), rng.randint(1, 12), float(rng.choice([3, 4, 5, 6]))) for k in range(160)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))

    def address(n):
        return f"https://h{n % 997}.example.com/{n}"

    links = {}
    for k, line, a, b, q in rows:
        if a != b:
            at = links.setdefault((a, b), [10**9, 0])
            at[0], at[1] = min(at[0], k * 10 + line), max(at[1], q % 7)
    edges = [(address(a), o, address(b), w / 6) for (a, b), (o, w) in sorted(links.items(), key=lambda x: x[1][0])]
    pages = sorted({u for u, *_ in edges if len(u) % 5})
    got = {}
    for r in queries.many_crawls(spark, str(tmp_path)).collect():
        got.setdefault(r["crawl"], []).append((r["url"], r["found_on_page"], r["depth"]))
        path = r["path"].split(" ")
        assert path[0] == address(int(r["crawl"])) and path[-1] == r["found_on_page"] and len(path) == r["depth"] + 1
    for part in {a for _, _, a, _, _ in rows if a * 20 <= max(x[2] for x in rows)}:
        results, _ = plain(pages, edges, [(u, 0, u + ".pdf") for u in pages], C.CrawlConfig(max_documents=30, max_depth=3), address(part))
        assert sorted(got.get(str(part), [])) == results


def test_no_join_is_by_broadcast(spark, capsys):
    """The driver gets no table, however small the tables of a test are."""
    queue = spark.createDataFrame([("a", 0, -1.0, "https://x.com/1", 0, None)], crawls.TABLES["queue"])
    visited = spark.createDataFrame([("a", "https://x.com/2")], "crawl string, url string")
    asked = spark.createDataFrame([("a", "x.com", 0.0)], "crawl string, host string, last double")
    room = spark.createDataFrame([("a", 5, 1)], "crawl string, room long, next long")
    children = queue.select("crawl", "url", "priority", "depth", "parent").selectExpr("*", "1 as page_ord", "0 as ord")
    nodes = queue.select("crawl", "seq", "parent", "url")
    for df in (crawls.fates(queue, visited, asked, 0.0, C.CrawlConfig()), crawls.admitted(children, queue, visited, room)):
        df.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert crawls.ancestry(nodes, 1, "crawl").count() == 1
