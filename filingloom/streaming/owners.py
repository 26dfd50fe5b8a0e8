"""First owners of addresses, and the latest document of each type, kept up to date by a stream of documents.

The stream is keyed by address. An address's state is the owner so far and the batches (by time) that it and the last
document came in; a document goes on only if it is the first of its address, or comes earlier in the order (company, page,
link) than the owner so far. State is of a period of `keep`, after which it expires; a document that comes after that goes on
once more, and the sink sorts it out. It is an aggregate of built-in functions: no Python runs for an address.

The sink keeps two tables in a log. Owners: of an address the document with the least order counts, so a document that
comes twice, or late, changes nothing. Latest: the rows of the groups (company and type) that a batch touches, by the owner
that comes or the one that goes, are worked out anew and put above the old ones; a group that is left without documents
gets an empty row. A batch that runs again finds its number committed and does nothing. So after any order of arrival the
tables are those of the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import urls
from ..operators import ranking
from ..sources.log import Log
from ..sources.stage import saved

ORDER = ("company_ord", "page_ord", "ord")
DOCUMENT = "ticker string, document_type string, ord long, company_ord long, page_ord long, title string, url string, relevance_score double, extracted_year int, extracted_quarter int"
GROUP = ("ticker", "document_type")
#: How far the clock of a driver that takes the stream over may be behind.
_LATE = "1 day"
TABLES = {"owners": f"address string, {DOCUMENT}", "latest": f"version long, there boolean, {DOCUMENT}"}


def first_owners(documents: DataFrame, keep: str = "30 days") -> DataFrame:
    """A stream of documents (DOCUMENT) to a stream of owners: address, then the document."""
    files = documents.where(urls.is_direct_file(F.col("url"))).withColumn("address", urls.without_query(F.col("url")))
    names = [c.strip().split()[0] for c in TABLES["owners"].split(",")]
    came = files.select(*names, F.current_timestamp().alias("_at")).withWatermark("_at", _LATE)
    owner = F.min_by(F.struct(*names, "_at"), F.struct(*ORDER, "_at"))
    state = came.groupBy("address", F.window("_at", keep).alias("_period")).agg(owner.alias("x"), F.max("_at").alias("_last"))
    return state.where(F.col("x._at") == F.col("_last")).select(*(f"x.{c}" for c in names))


class Sink:
    """The tables of owners and latest documents in a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.log = spark, Log(spark, folder, TABLES).resume()

    def owners(self) -> DataFrame:
        rows = self.log.read("owners")
        return rows.groupBy("address").agg(F.min_by(F.struct(*rows.columns), F.struct(*ORDER)).alias("x")).select("x.*")

    def latest(self) -> DataFrame:
        """The latest document of each company and type."""
        rows = self.log.read("latest")
        last = rows.groupBy(*GROUP).agg(F.max_by(F.struct(*rows.columns), "version").alias("x")).select("x.*")
        return last.where("there").drop("version", "there")

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Take in a batch of owners; one that has been taken in already changes nothing."""
        if self.log.number and number <= self.log.notes["batch"]:
            return
        before = self.owners()
        came = self.log.add("owners", batch)
        gone = before.join(came.select("address").distinct(), "address", "left_semi").select(*GROUP)
        touched = came.select(*GROUP).unionByName(gone).distinct()
        rows = ranking.latest_per_type(self.owners().drop("address").join(touched, list(GROUP), "left_semi"))
        whole = touched.join(rows.withColumn("there", F.lit(True)), list(GROUP), "left")
        self.log.add("latest", whole.withColumns({"version": F.lit(number), "there": F.coalesce("there", F.lit(False))}))
        for table in TABLES:
            self.log.merge(table)
        self.log.commit(batch=number)


def start(documents: DataFrame, folder: str, keep: str = "30 days", every: str = "0 seconds") -> StreamingQuery:
    """The stream of documents into the tables of a folder that driver and executors share. Keyed state needs the RocksDB
    store, which is set for the session. host_crawl.until_quiet() tells when all are in."""
    spark = documents.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    writer = first_owners(documents, keep).writeStream.outputMode("update").foreachBatch(_into(folder))
    return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime=every).start()


def _into(folder: str) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, number: int) -> None:
        came = saved(batch)
        if not came.isEmpty():
            Sink(batch.sparkSession, folder).upsert(came, number)

    return run
