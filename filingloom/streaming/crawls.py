"""Many bounded crawls in one run of rounds, each by the rules of `crawl.Crawl`, with its state in a log.

A crawl is a key. A round takes the front of each crawl's queue, cuts it at the first host that the crawl has asked too
lately, visits what is left, and admits the links found by rank within the room of that crawl's queue. All of it is keyed
by crawl: a group holds at most a batch of its queue, or the links of a batch of pages.

What a round writes is what it changes: the items at the front with their fate, the files found, the items admitted, and a
line of counts for each crawl that goes on. An item's fate is the tombstone in the queue, the entry among the visited and the
time its host was asked, all in one row. So a round's bytes follow the batch, not the visited; every `fold_every` rounds the
queue is written without what has left it. No join is by broadcast, so what the driver gets is counts. Items know their parent's number only; paths() puts navigation paths together.
"""

from __future__ import annotations

import math
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..sources.log import Log
from ..sources.stage import merged, saved, scratch
from .crawl import CrawlConfig, children_by_score

TABLES = {
    "queue": "crawl string, seq long, priority double, url string, depth int, parent long",
    "front": "crawl string, seq long, url string, host string, depth int, parent long, fate string, success boolean, page_ord int, clock double",
    "files": "crawl string, seq long, ord long, url string, type string, title string, found_on_page string, depth int",
    "tally": "crawl string, queued long, next long, files long, pages long, deepest int, round int",
}
#: What becomes of an item at the front: its page is asked for, it has been visited before, it waits for its host.
VISIT, DROP, WAIT = "visit", "drop", "wait"
_ORDER = ("priority", "depth", "seq")


def fates(queue: DataFrame, visited: DataFrame, asked: DataFrame, now: float, config: CrawlConfig) -> DataFrame:
    """The first `batch` items of each crawl's queue with their fate. visited: crawl, url; asked: crawl, host, last."""
    own = Window.partitionBy("crawl").orderBy(*_ORDER)
    front = queue.withColumn("_k", F.row_number().over(own)).where(F.col("_k") <= config.batch).withColumn("host", urls.host(F.col("url")))
    best = F.min("priority").over(Window.partitionBy("crawl"))
    front = front.withColumn("_best", best).where(F.col("_best") <= -config.priority_threshold)
    marked = front.join(merged(visited.select("crawl", "url").withColumn("_seen", F.lit(True))), ["crawl", "url"], "left").join(merged(asked), ["crawl", "host"], "left")
    live = F.col("_seen").isNull()
    again = F.count_if(live).over(Window.partitionBy("crawl", "host").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)) > 0
    soon = F.coalesce(F.lit(now) - F.col("last") < config.rate_limit_delay, F.lit(False))
    blocked = F.max(live & (again | soon)).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("fate", F.when(blocked, WAIT).when(live, VISIT).otherwise(DROP)).select("crawl", "seq", "url", "host", "depth", "parent", "priority", "fate")


def admitted(children: DataFrame, queue: DataFrame, visited: DataFrame, room: DataFrame) -> DataFrame:
    """The children (crawl, url, page_ord, ord, others) that are new to their crawl, each address once, in order, as far as
    room (crawl, room, next) goes; seq counts on from next."""
    new = children.join(merged(visited.select("crawl", "url")), ["crawl", "url"], "left_anti").join(merged(queue.select("crawl", "url")), ["crawl", "url"], "left_anti")
    once = new.groupBy("crawl", "url").agg(F.min_by(F.struct(*new.columns), F.struct("page_ord", "ord")).alias("x")).select("x.*")
    rank = F.row_number().over(Window.partitionBy("crawl").orderBy("page_ord", "ord"))
    return once.join(merged(room), "crawl").withColumn("_k", rank).where(F.col("_k") <= F.col("room")).withColumn("seq", F.col("next") + F.col("_k") - 1)


class Crawls:
    """links: url, ord, child_url, priority. files: url, ord, file_url, type, title. pages: url. goal: url, goal; as `Crawl`
    has them. folder: where the log is kept; a new one below the checkpoint folder if none is given."""

    def __init__(self, spark: SparkSession, pages: DataFrame, links: DataFrame, files: DataFrame, config: CrawlConfig = CrawlConfig(), goal: DataFrame | None = None, folder: str | None = None, fold_every: int = 8) -> None:  # noqa: B008
        self.spark, self.config, self.fold_every = spark, config, fold_every
        self.goal = spark.createDataFrame([], "url string, goal double") if goal is None else goal
        self.pages, self.links, self.files = pages.select("url").distinct().withColumn("success", F.lit(True)), links, files
        self.log = Log(spark, folder or scratch(spark, "crawls"), TABLES)
        self.rounds, self.clock, self.over = 0, 0.0, False

    def seed(self, seeds: DataFrame) -> Crawls:
        """seeds: crawl, url; one address a crawl."""
        first = seeds.groupBy(F.col("crawl").cast("string").alias("crawl")).agg(F.min("url").alias("url"))
        first = first.select("crawl", F.lit(0).alias("seq"), F.lit(-1.0).alias("priority"), "url", F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent"))
        rows = self.log.add("queue", first)
        self.log.add("tally", rows.select("crawl", F.lit(1).alias("queued"), F.lit(1).alias("next"), *(F.lit(0).alias(c) for c in ("files", "pages", "deepest", "round"))))
        self._commit()
        return self

    def resume(self) -> Crawls:
        """Go on from the last commit in the folder."""
        notes = self.log.resume().notes
        self.rounds, self.clock, self.over = notes["rounds"], notes["clock"], notes["over"]
        return self

    def _commit(self) -> None:
        self.log.commit(rounds=self.rounds, clock=self.clock, over=self.over, config=asdict(self.config))

    def queue(self) -> DataFrame:
        """The items that wait."""
        return self.log.read("queue").join(merged(self.log.read("front").where(F.col("fate") != WAIT).select("crawl", "seq")), ["crawl", "seq"], "left_anti")

    def visited(self) -> DataFrame:
        return self.log.read("front").where(F.col("fate") == VISIT)

    def results(self) -> DataFrame:
        return self.log.read("files")

    def tally(self) -> DataFrame:
        """The last counts of each crawl: queued, next, files, pages, deepest, round."""
        rows = self.log.read("tally")
        return rows.groupBy("crawl").agg(F.max_by(F.struct(*rows.columns), "round").alias("x")).select("x.*")

    def step(self) -> None:
        c, log = self.config, self.log
        tally = saved(self.tally())
        queue = self.queue().join(merged(tally.where(F.col("files") < c.max_documents).select("crawl")), "crawl", "left_semi")
        asked = self.visited().where(F.col("clock") > self.clock - c.rate_limit_delay).groupBy("crawl", "host").agg(F.max("clock").alias("last"))
        marked = fates(queue, self.visited(), asked, self.clock, c).join(merged(self.pages), "url", "left")
        order = F.row_number().over(Window.partitionBy("crawl", "fate").orderBy(*_ORDER))
        front = log.add("front", marked.withColumns({"success": F.coalesce("success", F.lit(False)), "page_ord": order, "clock": F.lit(self.clock)}))
        self.rounds, self.clock = self.rounds + 1, self.clock + 1.0
        self.over = front.isEmpty()
        if not self.over:
            self._visit(front, tally)
        self._commit()

    def _visit(self, front: DataFrame, tally: DataFrame) -> None:
        c, log = self.config, self.log
        ok = front.where((F.col("fate") == VISIT) & F.col("success")).withColumnRenamed("url", "page")
        found = log.add("files", ok.join(merged(self.files.withColumnRenamed("url", "page")), "page").withColumnsRenamed({"page": "found_on_page", "file_url": "url"}))
        links = ok.withColumnRenamed("page", "url").join(merged(self.links), "url")
        deeper = children_by_score(links, self.goal, c).select("crawl", F.col("child_url").alias("url"), (-F.col("priority")).alias("priority"), (F.col("depth") + 1).alias("depth"), F.col("seq").alias("parent"), "page_ord", "ord")
        gone = front.where(F.col("fate") != WAIT).groupBy("crawl").agg(F.count("*").alias("gone"), F.count_if((F.col("fate") == VISIT) & F.col("success")).alias("went"), F.max(F.when((F.col("fate") == VISIT) & F.col("success"), F.col("depth"))).alias("depth"))
        counts = saved(tally.join(merged(front.select("crawl").distinct()), "crawl", "left_semi").join(merged(gone), "crawl", "left").join(merged(found.groupBy("crawl").agg(F.count("*").alias("found"))), "crawl", "left"))
        left = F.col("queued") - F.coalesce("gone", F.lit(0))
        room = counts.select("crawl", (F.lit(c.max_queue_size) - left).alias("room"), "next")
        new = log.add("queue", admitted(deeper, self.queue(), self.visited(), room))
        added = new.groupBy("crawl").agg(F.count("*").alias("added"))
        some = lambda name: F.coalesce(name, F.lit(0))
        log.add("tally", counts.join(merged(added), "crawl", "left").select("crawl", (left + some("added")).alias("queued"), (F.col("next") + some("added")).alias("next"), (F.col("files") + some("found")).alias("files"),
                                                                    (F.col("pages") + some("went")).alias("pages"), F.greatest("deepest", "depth").alias("deepest"), F.lit(self.rounds).alias("round")))
        if self.rounds % self.fold_every == 0:
            log.fold("queue", self.queue())
            log.fold("tally", self.tally())
        for table in ("front", "files"):
            log.merge(table)

    def run(self) -> Crawls:
        """Rounds until every crawl has stopped. All crawls share a clock, so its limit ends them together."""
        while not self.over and self.clock < self.config.timeout_seconds:
            self.step()
        return self

    def paths(self) -> DataFrame:
        """crawl, seq and path: the addresses from the seed to each visited page."""
        deepest = self.tally().agg(F.max("deepest")).first()[0] or 0
        return ancestry(self.visited().select("crawl", "seq", "parent", "url"), deepest, "crawl")


def ancestry(nodes: DataFrame, depth: int, *keys: str) -> DataFrame:
    """keys, seq and path of each node (keys, seq, parent, url): the urls from its root to itself. Each join doubles how far
    a node's path reaches, so paths of `depth` edges take the logarithm of that in joins. A parent that isn't there is a root."""
    whole = saved(nodes.select(*keys, "seq", F.col("parent").alias("up"), F.array("url").alias("path")))
    for _ in range(math.ceil(math.log2(depth + 1))):
        above = whole.select(*keys, F.col("seq").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.lit(True).alias("_there"))
        far = whole.where(F.col("up").isNotNull()).join(merged(above), [*keys, "up"], "left").select(*keys, "seq", F.col("_up").alias("up"), F.concat(F.coalesce("_path", F.array().cast("array<string>")), "path").alias("path"))
        whole = saved(whole.where(F.col("up").isNull()).unionByName(far))
    return whole.select(*keys, "seq", "path")


