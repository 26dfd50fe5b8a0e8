"""A crawl as a stream, keyed by host, so that no task holds a crawl and no host is asked by two tasks.

Requests (crawl, url, depth, parent, priority) arrive in a folder. The state of a host is the addresses that it has been
asked for, its waiting requests and the time from which it may be asked again. A host that may be asked lets one request
out, the best that waits, and sets a timer for the next `delay` seconds later; without a delay requests don't wait. What
is let out is visited in the batch's writer: the page is looked up, its files are written, and its links are new requests in
the folder, where the stream finds them. So without a delay a crawl takes as many batches as it is deep.

Waiting requests stand in lanes, one for each hundredth of priority: a lane has a head and a tail, so that letting one out
reads one request, however many wait. Within a lane the first to arrive is the first out.

A batch writes folders named by its number, so one that runs again writes them again; a request that comes twice is known.
From the same checkpoint folder the stream goes on where it was. Unlike the crawl by rounds it has no limit of documents
or queue; what it visits is what that crawl visits without limits.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..functions import urls
from ..sources.stage import Files, saved
from .crawl import CrawlConfig, children_by_score, drawer, filed

REQUEST = "crawl string, url string, depth int, parent string, priority double"
VISIT = "host string, crawl string, url string, depth int, parent string, priority double, at long"
#: Lanes a unit of priority.
LANES = 100


class Host(StatefulProcessor):
    """The requests of one host, let out one at a time."""

    def __init__(self, delay: float) -> None:
        self.delay = int(delay * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getMapState("known", "crawl string, url string", "depth int")
        self.lanes = handle.getMapState("lanes", "lane int", "head long, tail long")
        self.waiting = handle.getMapState("waiting", "lane int, place long", "crawl string, url string, depth int, parent string, priority double")
        self.free = handle.getValueState("free", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        for part in rows:
            out = []
            for r in part.itertuples(index=False):
                if self.known.containsKey((r.crawl, r.url)):
                    continue
                self.known.updateValue((r.crawl, r.url), (int(r.depth),))
                item, lane = (r.crawl, r.url, int(r.depth), r.parent, float(r.priority)), round(r.priority * LANES)
                if self.delay == 0:
                    out.append((lane, item))
                    continue
                head, tail = self.lanes.getValue((lane,)) if self.lanes.containsKey((lane,)) else (0, 0)
                self.waiting.updateValue((lane, tail), item)
                self.lanes.updateValue((lane,), (head, tail + 1))
            if out:
                yield self._visits(key, [item for _, item in sorted(out, key=lambda x: x[0])], now)
        if self.lanes.exists() and not any(True for _ in self.handle.listTimers()):
            free = self.free.get()[0] if self.free.exists() else 0
            if free > now:
                self.handle.registerTimer(free)
            else:
                yield self._let_out(key, now)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.lanes.exists():
            yield self._let_out(key, timerValues.getCurrentProcessingTimeInMs())

    def _let_out(self, key, now: int) -> pd.DataFrame:
        """The best that waits; the host is free again after the delay."""
        lane = min(k[0] for k in self.lanes.keys())
        head, tail = self.lanes.getValue((lane,))
        item = self.waiting.getValue((lane, head))
        self.waiting.removeKey((lane, head))
        if head + 1 < tail:
            self.lanes.updateValue((lane,), (head + 1, tail))
        else:
            self.lanes.removeKey((lane,))
        self.free.update((now + self.delay,))
        if self.lanes.exists():
            self.handle.registerTimer(now + self.delay)
        return self._visits(key, [item], now)

    @staticmethod
    def _visits(key, items: list[tuple], now: int) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *x, now) for x in items], columns=["host", "crawl", "url", "depth", "parent", "priority", "at"])

    def close(self) -> None:
        pass


def visits(requests: DataFrame, delay: float) -> DataFrame:
    """A stream of requests (REQUEST) to a stream of visits (VISIT), each host's at least `delay` seconds apart."""
    keyed = requests.withColumn("host", urls.host(F.col("url"))).groupBy("host")
    return keyed.transformWithStateInPandas(statefulProcessor=Host(delay), outputStructType=VISIT, outputMode="Append", timeMode="ProcessingTime")


def request(seeds: DataFrame, root: str) -> None:
    """Put seeds (crawl, url) among the requests below root."""
    first = seeds.select(F.col("crawl").cast("string").alias("crawl"), "url", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"), F.lit(-1.0).alias("priority"))
    first.write.mode("append").parquet(f"{root}/requests/seeds")


def follow(root: str, pages: DataFrame, links: DataFrame, files: DataFrame, config: CrawlConfig) -> Callable[[DataFrame, int], None]:
    """What a batch of visits leads to: its visits, files and new requests, each in the batch's own folder. Pages, links
    and files are filed by address, and a batch opens the drawers of its visits. Links below the threshold are never
    followed, as no page has a goal score here, and aren't filed."""
    goal = pages.sparkSession.createDataFrame([], "url string, goal double")
    followed = links.where(F.col("priority") >= config.priority_threshold).select("url", "child_url", "priority")
    all_there, all_links, all_files = (filed(df, f"{root}/graph/{name}") for name, df in (("pages", pages.select("url").distinct()), ("links", followed), ("files", files)))

    def run(batch: DataFrame, number: int) -> None:
        batch = saved(batch)
        opened = [r[0] for r in batch.select(drawer(F.col("url"))).distinct().collect()]  # as many rows as there are drawers at most
        if not opened:
            return
        there, links, files = (df.where(F.col("drawer").isin(opened)).drop("drawer") for df in (all_there, all_links, all_files))
        got = batch.join(there.withColumn("success", F.lit(True)), "url", "left").withColumn("success", F.coalesce("success", F.lit(False)))
        got.select("crawl", "url", "depth", "parent", "host", "at", "success").write.mode("overwrite").parquet(f"{root}/visits/batch={number}")
        went = batch.sparkSession.read.parquet(f"{root}/visits/batch={number}")
        ok = went.where("success")
        ok.withColumnRenamed("url", "found_on_page").join(files.withColumnRenamed("url", "found_on_page"), "found_on_page").select("crawl", F.col("file_url").alias("url"), "type", "title", "found_on_page", "depth").write.mode("overwrite").parquet(f"{root}/files/batch={number}")
        deeper = children_by_score(ok.join(links, "url"), goal, config)
        new = deeper.select("crawl", F.col("child_url").alias("url"), (F.col("depth") + 1).alias("depth"), F.col("url").alias("parent"), (-F.col("priority")).alias("priority"))
        new.groupBy("crawl", "url").agg(F.min_by(F.struct(*new.columns), F.struct("priority", "depth", "parent")).alias("x")).select("x.*").write.mode("overwrite").parquet(f"{root}/requests/batch={number}")

    return run


def start(spark: SparkSession, root: str, pages: DataFrame, links: DataFrame, files: DataFrame, config: CrawlConfig = CrawlConfig(), every: str = "1 second", tasks: int | None = None) -> StreamingQuery:  # noqa: B008
    """The stream over the requests below root, which is on a file system that driver and executors share. pages, links and
    files as `Crawl` has them. Keyed state needs the RocksDB store, which is set for the session. tasks: those that share the
    hosts, fixed by the first start from a checkpoint folder; each opens its state in each batch, however few rows come, so
    without a number there are no more of them than cores."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    requests = spark.readStream.schema(REQUEST).option("recursiveFileLookup", "true").parquet(f"{root}/requests")
    writer = visits(requests, config.rate_limit_delay).writeStream.outputMode("append").foreachBatch(follow(root, pages, links, files, config))
    writer = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(processingTime=every)
    given = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks or min(int(given), spark.sparkContext.defaultParallelism))
    try:
        return writer.start()  # the stream has its own copy of the settings
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", given)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The visits or files so far."""
    schema = {"visits": "crawl string, url string, depth int, parent string, host string, at long, success boolean", "files": "crawl string, url string, type string, title string, found_on_page string, depth int"}[name]
    folders = [f"{root}/{name}/{f}" for f in Files(spark, root).names(f"{root}/{name}") if f.startswith("batch=")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def until_quiet(query: StreamingQuery, seconds: float, batches: int = 3, most: float = 3600.0) -> None:
    """Wait until for `seconds` (more than the delay) and some batches no request has come and no timer has been set or met.
    A stream without timers has no batches when nothing comes: it is quiet when it has taken in all that is there."""
    since, quiet, last, until = time.monotonic(), 0, -1, time.monotonic() + most
    while quiet < batches or time.monotonic() - since < seconds:
        if e := query.exception():
            raise e
        if time.monotonic() > until:
            raise TimeoutError(f"requests still wait after {most} seconds")
        p = query.lastProgress
        if p is not None and not any("numRegisteredTimers" in s["customMetrics"] for s in p["stateOperators"]):
            return query.processAllAvailable()
        if p is not None and p["batchId"] != last:
            last, quiet = p["batchId"], quiet + 1
            timers = (s["customMetrics"].get(f"num{what}Timers", 0) for s in p["stateOperators"] for what in ("Registered", "Deleted"))
            if p["numInputRows"] or any(timers):
                since, quiet = time.monotonic(), 0
        time.sleep(0.1)
