"""The crawl against a plain restatement of its rules, and stream windows."""

import random
from urllib.parse import urlsplit

from filingloom.plans import queries
from filingloom.streaming import crawl as C
from filingloom.streaming import events


def graph(seed):
    rng = random.Random(seed)
    urls = [f"https://h{i % 5}.example.com/{i}" for i in range(30)]
    links = [(u, k, rng.choice(urls), rng.choice([0.2, 0.6, 0.9, 1.1])) for u in urls for k in range(4)]
    files = [(u, 0, u + ".pdf", "PDF", "t") for u in urls if rng.random() < 0.6]
    return [u for u in urls if rng.random() < 0.8], links, files


def plain(pages, links, files, c, seed):
    queue, visited, results, hosts, clock, seq = [(-1.0, 0, 0, seed)], [], [], {}, 0.0, 1
    while queue and len(results) < c.max_documents and clock < c.timeout_seconds and min(queue)[0] <= -c.priority_threshold:
        queue.sort()
        taken, gone, asked = [], [], set()
        for item in queue[: c.batch]:
            host = urlsplit(item[3]).netloc
            if item[3] in visited:
                gone.append(item)
                continue
            if host in asked or clock - hosts.get(host, -1e9) < c.rate_limit_delay:
                break
            asked.add(host)
            taken.append(item)
        queue = [q for q in queue if q not in taken and q not in gone]
        for q in taken:
            visited.append(q[3])
            hosts[urlsplit(q[3]).netloc] = clock
        new = []
        for p, d, s, u in taken:
            if u in pages:
                results += [(f[2], u, d) for f in files if f[0] == u]
                if d < c.max_depth:
                    new += [(-w, d + 1, v) for a, _, v, w in links if a == u and w >= c.priority_threshold]
        known = {q[3] for q in queue} | set(visited)
        for p, d, v in new:
            if v not in known and len(queue) < c.max_queue_size:
                known.add(v)
                queue.append((p, d, seq, v))
                seq += 1
        clock += 1.0
    return sorted(results), visited


def test_crawl_matches_rules(spark, tmp_path):
    for seed, config in ((1, C.CrawlConfig(batch=3, max_queue_size=6, max_depth=3)), (2, C.CrawlConfig(max_documents=5, rate_limit_delay=2.0))):
        pages, links, files = graph(seed)
        start = links[0][0]
        crawl = C.Crawl(spark, spark.createDataFrame([(p,) for p in pages], "url string"), spark.createDataFrame(links, "url string, ord int, child_url string, priority double"), spark.createDataFrame(files, "url string, ord int, file_url string, type string, title string"), config)
        crawl.seed(start)
        if seed == 2:
            crawl.step()
            crawl.save(str(tmp_path))
            crawl = C.Crawl(spark, crawl.pages, crawl.links, crawl.files, config).resume(str(tmp_path))
        crawl.run()
        results, visited = plain(pages, links, files, config, start)
        assert sorted((r["url"], r["found_on_page"], r["depth"]) for r in crawl.results.collect()) == results
        assert sorted(r["url"] for r in crawl.visited.collect()) == sorted(visited)


def test_frontier_takes_all_edges(spark, tmp_path):
    rng = random.Random(5)
    hops = [(1, 3), (3, 5), (5, 7), (7, 9)] + [(rng.choice([1, 3, 5, 7, 9]), n) for n in range(10, 34)]
    rows = [(k, 1 + k % 7, a, b, float(rng.choice([3, 4, 5, 6]))) for k, (a, b) in enumerate(hops)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))

    def address(n):
        return f"https://h{n % 17}.example.com/{n}"

    links = [(address(a), k * 10 + line, address(b), q / 6) for k, line, a, b, q in rows]
    pages = sorted({u for u, *_ in links if len(u) % 5})
    results, visited = plain(pages, links, [(u, 0, u + ".pdf") for u in pages], C.CrawlConfig(), address(1))
    got = queries.crawl_frontier_exact(spark, str(tmp_path)).collect()
    assert sorted((r["url"], r["found_on_page"], r["depth"]) for r in got) == results and max(r["depth"] for r in got) == 4


def test_tables_are_read_once(spark):
    from pyspark.sql import functions as F

    pages, links, files = graph(2)
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(priority):
        read.add(1)
        return priority

    rows = spark.createDataFrame(links, "url string, ord int, child_url string, priority double").withColumn("priority", seen("priority"))
    crawl = C.Crawl(spark, spark.createDataFrame([(p,) for p in pages], "url string"), rows, spark.createDataFrame(files, "url string, ord int, file_url string, type string, title string"), C.CrawlConfig(batch=3, max_documents=8))
    crawl.seed(links[0][0]).run()
    assert crawl.rounds > 3 and read.value == len(links)


def test_config_text():
    c = C.CrawlConfig(max_depth=7)
    assert C.CrawlConfig.from_json(c.to_json()) == c


def test_goal_scores(spark):
    links = spark.createDataFrame([("a", 2, 0.6), ("b", 3, 0.9), ("c", 1, 0.3), ("d", 1, 0.6)], "url string, depth int, priority double")
    goal = spark.createDataFrame([("a", 0.9), ("b", 0.1), ("c", 0.7)], "url string, goal double")
    assert {r["url"]: round(r["priority"], 2) for r in C.children_by_score(links, goal, C.CrawlConfig()).collect()} == {"c": 0.6, "d": 0.6}


def test_stream_of_windows(spark, tmp_path):
    spark.sql("select timestamp'2024-01-01 00:10:00' ts, 'a' event_type, 1.0D value, 'u' url union all select timestamp'2024-01-01 00:20:00', 'a', 2.0D, 'u' union all select timestamp'2024-01-01 09:00:00', 'b', 3.0D, 'w'").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("ts timestamp, event_type string, value double, url string").parquet(str(tmp_path / "in"))
    for name, df in (("windows", events.tumbling(source, late="1 hour")), ("firsts", events.first_seen(source).select("url"))):
        query = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).start()
        query.processAllAvailable()
        query.stop()
    assert [(r["event_type"], r["n"], r["total"]) for r in spark.table("windows").collect()] == [("a", 2, 3.0)]
    assert sorted(r["url"] for r in spark.table("firsts").collect()) == ["u", "w"]
