"""A bounded, checkpointed crawl of stored pages by a priority queue.

The queue's order is priority (negated score, so the smallest is first), depth, then order of arrival. A round takes at
most `batch` items from the front; visited ones are dropped, and the round ends before an item whose host the round has
asked already or asked less than `delay` seconds ago. Each item is visited whether its page is stored or not. A round is
one second of the crawl's clock. Stop tests come before a round, so limits may be passed by one round.

Pages, links and files are filed by address once; a round opens the drawers of its batch only, so its work follows the batch
and not the tables. To the driver go the batch (at most `batch` items) and counts.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls
from ..sources.stage import Files, saved, scratch

#: Drawers that pages, links and files are filed in; rounds after which the growing state is written as one.
DRAWERS, FOLD = 256, 16


@dataclass(frozen=True)
class CrawlConfig:
    max_depth: int = 4
    batch: int = 10
    max_documents: int = 200
    timeout_seconds: float = 600
    priority_threshold: float = 0.5
    rate_limit_delay: float = 1.0
    max_queue_size: int = 500
    save_every: int = 10

    def to_json(self) -> str:
        import json

        return json.dumps(asdict(self), indent=2)

    @classmethod
    def from_json(cls, text: str) -> CrawlConfig:
        import json

        return cls(**json.loads(text))


QUEUE = "priority double, url string, depth int, parent_url string, path array<string>, seq long"
RESULT = "url string, type string, title string, found_on_page string, path array<string>, depth int"
FRONT = "url string, depth int, host string, path array<string>, success boolean, page_ord int"


def drawer(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(DRAWERS)).cast("int")


def filed(df: DataFrame, path: str) -> DataFrame:
    """df (url and others) as it is kept below path, a folder for each drawer of addresses, in it by address, so that an
    address is stored and read once for all its rows; kept once."""
    spark = df.sparkSession
    if "_SUCCESS" not in Files(spark, path).names(path):
        df.withColumn("drawer", drawer(F.col("url"))).repartition(DRAWERS, "drawer").sortWithinPartitions("drawer", "url").write.mode("overwrite").partitionBy("drawer").parquet(path)
    schema = T.StructType([*df.schema, T.StructField("drawer", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def _local(spark: SparkSession, schema: str, rows: list[tuple] = ()) -> DataFrame:
    """A few rows of the driver as a DataFrame that needs no task of its own."""
    kind = T.StructType.fromDDL(schema)
    table = pa.table({f.name: pa.array([r[k] for r in rows], _ARROW[f.dataType.simpleString()]) for k, f in enumerate(kind)})
    return spark.createDataFrame(table, kind)


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def take_batch(queue: DataFrame, visited: DataFrame, hosts: DataFrame, now: float, config: CrawlConfig) -> DataFrame:
    """The first items of the queue with `taken`: true to visit, false to drop; the rest of the queue isn't returned.
    hosts: host, last (when it was asked)."""
    front = queue.orderBy("priority", "depth", "seq").limit(config.batch).withColumn("host", urls.host(F.col("url")))
    seen = visited.select("url").distinct().withColumn("_seen", F.lit(True))
    marked = front.join(seen, "url", "left").join(hosts.groupBy("host").agg(F.max("last").alias("_last")), "host", "left")
    order = Window.partitionBy().orderBy("priority", "depth", "seq")  # at most `batch` rows
    live = F.col("_seen").isNull()
    again = F.count_if(live).over(Window.partitionBy("host").orderBy("priority", "depth", "seq").rowsBetween(Window.unboundedPreceding, -1)) > 0
    soon = F.coalesce(F.lit(now) - F.col("_last") < config.rate_limit_delay, F.lit(False))
    blocked = F.max((live & (again | soon)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_blocked", blocked).where("_blocked = 0").withColumn("taken", live).drop("_blocked", "_seen", "_last")


def admit(children: DataFrame, queue: DataFrame, visited: DataFrame, room: int) -> DataFrame:
    """The children (url, page_ord, ord, others) that still fit, in order: not visited, not queued, each address once."""
    new = children.join(visited.select("url").distinct(), "url", "left_anti").join(queue.select("url").distinct(), "url", "left_anti")
    first = new.withColumn("_k", F.row_number().over(Window.partitionBy("url").orderBy("page_ord", "ord"))).where("_k = 1").drop("_k")
    return first.orderBy("page_ord", "ord").limit(max(0, room))


class Crawl:
    """links: url, ord, child_url, priority. files: url, ord, file_url, type, title. pages: url. Addresses are canonical.
    goal (url, goal): scores of pages by which children are chosen (children_by_score); without it the rule chooses."""

    def __init__(self, spark: SparkSession, pages: DataFrame, links: DataFrame, files: DataFrame, config: CrawlConfig = CrawlConfig(), goal: DataFrame | None = None) -> None:  # noqa: B008
        self.spark, self.config = spark, config
        self.goal = _local(spark, "url string, goal double") if goal is None else goal
        self.pages, self.links, self.files = pages.select("url").distinct(), links, files
        self.clock, self.rounds, self.next = 0.0, 0, 0
        self.queue, self.visited, self.results, self.hosts = (_local(spark, x) for x in (QUEUE, "url string, depth int, success boolean", RESULT, "host string, last double"))
        self._graph: list[DataFrame] = []
        self._counts: tuple[int, float | None, int] | None = None

    def seed(self, url: str) -> Crawl:
        self.queue = _local(self.spark, QUEUE, [(-1.0, url, 0, None, [], self.next)])
        self.next, self._counts = self.next + 1, None
        return self

    def counts(self) -> tuple[int, float | None, int]:
        """The items that wait, the least of their priorities, and the files found."""
        if self._counts is None:
            self._counts = (*self.queue.agg(F.count("*"), F.min("priority")).first(), self.results.count())
        return self._counts

    def stops(self) -> str | None:
        """Why the crawl is over, or None."""
        queued, best, found = self.counts()
        if not queued:
            return "queue empty"
        if found >= self.config.max_documents:
            return "documents"
        if self.clock >= self.config.timeout_seconds:
            return "timeout"
        return "priority" if best > -self.config.priority_threshold else None

    def _opened(self, of: list) -> list[DataFrame]:
        """Pages, links and files of the items (url, drawer)."""
        if not self._graph:
            root = scratch(self.spark, "crawl")
            self._graph = [filed(df, f"{root}/{name}") for name, df in (("pages", self.pages), ("links", self.links), ("files", self.files))]
        return [df.where(F.col("drawer").isin([r["drawer"] for r in of]) & F.col("url").isin([r["url"] for r in of])).drop("drawer") for df in self._graph]

    def step(self) -> None:
        c, (queued, _, found) = self.config, self.counts()
        front = take_batch(self.queue, self.visited, self.hosts, self.clock, c).withColumn("drawer", drawer(F.col("url"))).orderBy("priority", "depth", "seq").collect()  # at most `batch` rows
        taken = [r for r in front if r["taken"]]
        left, queued, new = self.queue.where(~F.col("seq").isin([r["seq"] for r in front])), queued - len(front), None
        if taken:
            pages, links, files = self._opened(taken)
            there = {r[0] for r in pages.select("url").collect()}
            got = [(r["url"], r["depth"], r["host"], [*r["path"], r["url"]], r["url"] in there, k + 1) for k, r in enumerate(taken)]
            self.visited = self.visited.unionByName(_local(self.spark, "url string, depth int, success boolean", [(r[0], r[1], r[4]) for r in got]))
            self.hosts = self.hosts.unionByName(_local(self.spark, "host string, last double", [(r[2], self.clock) for r in got]))
            if there:
                ok = F.broadcast(_local(self.spark, FRONT, [r for r in got if r[4]]))
                more = saved(files.join(ok, "url").select(F.col("file_url").alias("url"), "type", "title", F.col("url").alias("found_on_page"), "path", "depth").coalesce(1 + len(taken) // 4))
                self.results, found = self.results.unionByName(more), found + more.count()
                deeper = children_by_score(links.join(ok, "url"), self.goal, c)
                children = deeper.select(F.col("child_url").alias("url"), (-F.col("priority")).alias("priority"), (F.col("depth") + 1).alias("depth"), F.col("url").alias("parent_url"), "path", "page_ord", "ord")
                new = admit(children, left, self.visited, c.max_queue_size - queued)
                new = new.withColumn("seq", F.lit(self.next) + F.row_number().over(Window.partitionBy().orderBy("page_ord", "ord")) - 1).select(*self.queue.columns)  # at most max_queue_size rows
        self.queue = saved((left if new is None else left.unionByName(new)).coalesce(2))
        now, best = self.queue.agg(F.count("*"), F.min("priority")).first()
        self.next, self._counts = self.next + now - queued, (now, best, found)
        self.clock, self.rounds = self.clock + 1.0, self.rounds + 1
        if self.rounds % FOLD == 0:
            self.visited, self.results = (saved(df.coalesce(8)) for df in (self.visited, self.results))
            self.hosts = saved(self.hosts.groupBy("host").agg(F.max("last").alias("last")).coalesce(8))

    def run(self, state: str | None = None) -> Crawl:
        """Rounds until a stop test holds; with a folder, the state is written to it every save_every rounds and at the end."""
        while not self.stops():
            self.step()
            if state and self.rounds % self.config.save_every == 0:
                self.save(state)
        if state:
            self.save(state)
        return self

    def save(self, folder: str) -> None:
        """Each state in a folder of its own; the row that names it comes last, so a state counts once it is whole. A folder is
        for one crawl."""
        for name in ("queue", "visited", "results", "hosts"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder}/round={self.rounds}/{name}")
        self.spark.createDataFrame([(self.clock, self.rounds, self.next, self.config.to_json())], "clock double, rounds int, next long, config string").coalesce(1).write.mode("append").parquet(f"{folder}/clock")

    def resume(self, folder: str) -> Crawl:
        """Go on from the last whole state; the clock counts from the first start."""
        row = self.spark.read.parquet(f"{folder}/clock").orderBy(F.desc("rounds")).first()
        for name in ("queue", "visited", "results", "hosts"):
            setattr(self, name, saved(self.spark.read.parquet(f"{folder}/round={row['rounds']}/{name}")))
        self.clock, self.rounds, self.next, self._counts = row["clock"], row["rounds"], row["next"], None
        return self


def children_by_score(links: DataFrame, goal: DataFrame, config: CrawlConfig) -> DataFrame:
    """links (url, depth, priority, …) of pages with a goal score (url, goal): a page above 0.8 from depth 2 on is an end,
    one below 0.3 beyond depth 2 is given up; links of pages above 0.5 gain 0.3. No score leaves the rule."""
    whole = links.join(goal, "url", "left")
    ends = ((F.col("goal") > 0.8) & (F.col("depth") >= 2)) | ((F.col("goal") < 0.3) & (F.col("depth") > 2))
    raised = F.col("priority") + F.when(F.col("goal") > 0.5, 0.3).otherwise(0.0)
    return whole.where(~F.coalesce(ends, F.lit(False)) & (F.col("depth") < config.max_depth)).withColumn("priority", raised).where(F.col("priority") >= config.priority_threshold).drop("goal")


def depths(edges: DataFrame, start: int, most: int) -> DataFrame:
    """node and the least number of edges (src, dst) to it from start, up to `most`."""
    reached = saved(edges.sparkSession.createDataFrame([(start, 0)], "node long, depth int"))
    front = reached
    for d in range(1, most + 1):
        front = saved(front.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(reached, "node", "left_anti").withColumn("depth", F.lit(d)))
        reached = reached.unionByName(front)
    return reached
