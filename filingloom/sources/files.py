"""Readers of company lists, document files, report folders and crawl state; writers of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import documents as D
from . import json_ranges, stores

METADATA = "struct<ticker:string,company_name:string,cnbc_url:string,company_website:string,extraction_method:string,timestamp:string>"
COMPANY = f"ticker string, company_name string, investor_relations_url string, cnbc_url string, company_website string, url string, type string, title string, metadata {METADATA}"
DOCUMENT = (
    "struct<title:string,url:string,normalized_url:string,document_type:string,publication_date:string,file_extension:string,relevance_score:double,section:string,subsection:string,"
    "content_preview:string,metadata:struct<ticker:string,company:string>,is_direct_file:boolean,extracted_year:int,extracted_quarter:int>"
)
STATE = (
    "visited_urls array<string>, queued_urls array<string>, queue_items array<struct<priority:double,url:string,intent:string,depth:int,parent_url:string,context:map<string,string>,timestamp:double>>, "
    "results map<string,array<struct<url:string,type:string,title:string,metadata:string>>>, "
    "statistics struct<pages_crawled:int,max_depth_reached:int,total_documents_found:int,crawl_start_time:double,last_save_time:double>"
)


def companies(spark: SparkSession, path: str, start: int = 0, end: int | None = None) -> DataFrame:
    """A JSON list of companies, however large, read in ranges: ord, ticker, company_name, investor_relations_url, cnbc_url,
    company_website. A record with metadata takes its values from there and its url, another one from its own fields; no
    ticker is UNKNOWN. Only objects are records."""
    raw = json_ranges.objects(spark, path).select(F.col("ord"), F.from_json("value", T.StructType.fromDDL(COMPANY)).alias("c"))
    nested = F.col("c.metadata").isNotNull()

    def pick(a: str, b: str) -> Column:
        return F.when(nested, F.col(a)).otherwise(F.col(b))

    rows = raw.select("ord", F.coalesce(pick("c.metadata.ticker", "c.ticker"), F.lit("UNKNOWN")).alias("ticker"), pick("c.metadata.company_name", "c.company_name").alias("company_name"),
                      pick("c.url", "c.investor_relations_url").alias("investor_relations_url"), pick("c.metadata.cnbc_url", "c.cnbc_url").alias("cnbc_url"), pick("c.metadata.company_website", "c.company_website").alias("company_website"))
    return rows.where((F.col("ord") >= start) & (F.lit(True) if end is None else F.col("ord") < end))


def documents(spark: SparkSession, path: str, tickers: list[str] | None = None, wrapped: bool | None = None, together: bool = False) -> DataFrame:
    """A JSON object of documents by ticker, however large, read in ranges: ticker, ord, then the document's fields.
    wrapped: the object stands within all_documents; unless it is said, the file is looked at. together: the parts of a
    folder are one text, as write_document_map() leaves them."""
    found = None
    if wrapped is not False:
        found = json_ranges.objects(spark, path, 3, together).where(F.get("keys", F.lit(1)) == '"all_documents"')
        if wrapped is None and found.isEmpty():
            found = None
    key = F.lit(1 if found is None else 2)
    found = json_ranges.objects(spark, path, 2, together) if found is None else found
    rows = found.select(json_ranges.key_text(F.get("keys", key)).alias("ticker"), (F.col("ord") - F.col("first")).alias("ord"), F.from_json("value", DOCUMENT).alias("d")).select("ticker", "ord", "d.*")
    return rows if tickers is None else rows.where(F.col("ticker").isin(*tickers))


def report_folder(spark: SparkSession, path: str, content: bool = False, numbered: bool = False) -> DataFrame:
    """The PDF files below `<ticker> - <company>` folders, listed and read in tasks, with the folder's metadata file and what
    the names say; content: with the files themselves. numbered: names begin with a number and a blank, which tell files
    apart and say nothing of year or quarter."""
    found = stores.registered(spark).read.format("reports").option("path", path).option("content", str(content).lower()).load()
    company, name = F.trim(F.regexp_extract("folder", "^.*? - (.*)$", 1)), F.col("file_name")
    if numbered:
        name = F.regexp_replace(name, r"^\d+ ", "")
    return found.select("file_path", "file_name", (F.col("size") / (1024 * 1024)).alias("file_size_mb"), "ticker", F.when(company == "", F.col("folder")).otherwise(company).alias("company_name"), "metadata",
                        D.file_name_type(name).alias("document_type"), D.file_year(name).alias("extracted_year"), D.file_quarter(name).alias("extracted_quarter"), *(["content"] if content else []))


def write_reports(df: DataFrame, path: str, mode: str = "append") -> None:
    """df (folder, file_name, content, metadata) as folders of files; all of them appear, or none."""
    stores.registered(df.sparkSession)
    df.select("folder", "file_name", "content", "metadata").repartition("folder").write.format("reports").option("path", path).mode(mode).save()


def write_pages(df: DataFrame, path: str, mode: str = "append") -> None:
    """df as one more write of a page store; it counts as a whole or not at all."""
    stores.registered(df.sparkSession)
    df.write.format("pages").option("path", path).mode(mode).save()


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of a store."""
    return stores.registered(spark).read.format("pages").option("path", path).load()


def crawl_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).option("multiLine", True).json(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def document_map(documents: DataFrame, latest: DataFrame) -> DataFrame:
    """One JSON text of all documents by ticker and the latest quarterly report of each. For files the size of a report;
    larger results belong in `by_ticker`."""
    fields = [c for c in documents.columns if c not in ("ticker", "ord")]
    whole = documents.groupBy("ticker").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", *fields))), lambda x: F.struct(*(x[c].alias(c) for c in fields))).alias("docs"))
    last = latest.select("ticker", F.struct(*(c for c in latest.columns if c not in ("ticker", "ord"))).alias("doc"))
    joined = whole.join(last, "ticker", "left")
    entries = F.array_sort(F.collect_list(F.struct("ticker", "docs")))
    lasts = F.array_sort(F.collect_list(F.when(F.col("doc").isNotNull(), F.struct("ticker", "doc"))))
    return joined.agg(F.to_json(F.struct(F.map_from_entries(entries).alias("all_documents"), F.map_from_entries(lasts).alias("latest_quarterly_reports"))).alias("value"))


def write_document_map(documents: DataFrame, latest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The text of document_map() as lines over many parts, which make it in the order of their names; no task or row has all
    of it. documents (ticker, ord, fields), latest (ticker, fields), neither with a null ticker."""

    def body(df: DataFrame) -> Column:
        return F.to_json(F.struct(*(c for c in df.columns if c not in ("ticker", "ord"))))

    def lines(df: DataFrame, section: int, kind: int, ord_: Column, line: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.col("ticker"), F.lit(kind).alias("kind"), ord_.cast("long").alias("ord"), line.alias("line"))

    none, name = F.lit(None), F.regexp_replace(F.to_json(F.struct(F.col("ticker").alias("k"))), r'^\{"k":|\}$', "")
    first = documents.groupBy("ticker").agg(F.min("ord").alias("low"))
    lowest = [df.agg(F.min("ticker")).first()[0] for df in (first, latest)]
    comma = [F.when(F.col("ticker") == (low if low is not None else ""), "").otherwise(",") for low in lowest]
    docs = documents.join(first, "ticker")
    edge = documents.sparkSession.createDataFrame([(0, '{"all_documents": {'), (2, '}, "latest_quarterly_reports": {'), (4, "}}")], "section int, line string")
    whole = lines(first, 1, 0, none, F.concat(comma[0], name, F.lit(": ["))).unionByName(lines(first, 1, 2, none, F.lit("]")))
    whole = whole.unionByName(lines(docs, 1, 1, F.col("ord"), F.concat(F.when(F.col("ord") == F.col("low"), "").otherwise(","), body(documents))))
    whole = whole.unionByName(lines(latest, 3, 0, none, F.concat(comma[1], name, F.lit(": "), body(latest))))
    whole = whole.unionByName(edge.select("section", none.cast("string").alias("ticker"), F.lit(0).alias("kind"), none.cast("long").alias("ord"), "line"))
    order = ("section", "ticker", "kind", "ord")
    whole.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode(mode).text(path)


def by_ticker(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of JSON lines for each ticker."""
    df.repartition("ticker").write.mode(mode).partitionBy("ticker").json(path)


def by_batch(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy("batch").json(path)


def by_batch_and_whole(df: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """A folder of JSON lines for each batch, and one of all rows."""
    by_batch(df, f"{root}/batches", mode)
    write_json(df.drop("batch"), f"{root}/combined", mode)


def write_dated(companies: DataFrame, investor_pages: DataFrame, root: str, stamp: str) -> None:
    """The two results of a crawl of companies, under a date; neither may be there yet."""
    write_json(companies, f"{root}/companies_{stamp}")
    write_json(investor_pages, f"{root}/ir_pages_{stamp}")


def listed(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below a folder of any file system that Spark reads: path, size, modified."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def fetched_objects(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """The files themselves: path, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root).select("path", "content")


def upload(df: DataFrame, root: str, stamp: str) -> None:
    """A dated copy, which must be new, and the latest one, which is replaced. root: any file system Spark writes to."""
    df.write.mode("errorifexists").json(f"{root}/{stamp}")
    df.write.mode("overwrite").json(f"{root}/latest")


def manifests(documents: DataFrame, log: DataFrame) -> DataFrame:
    """ticker, its documents and its download counts, as a JSON text for each ticker's folder."""
    fields = [c for c in documents.columns if c not in ("ticker", "ord")]
    docs = documents.groupBy("ticker").agg(F.count("*").alias("total_documents"), F.transform(F.array_sort(F.collect_list(F.struct("ord", *fields))), lambda x: F.struct(*(x[c].alias(c) for c in fields))).alias("documents"))
    counts = log.groupBy("ticker").agg(F.struct(*(F.count_if(F.col("status") == s).alias(s) for s in ("downloaded", "failed", "skipped"))).alias("download_stats"))
    return docs.join(counts, "ticker", "left").select("ticker", F.to_json(F.struct("ticker", "total_documents", "documents", "download_stats")).alias("manifest"))


def target_paths(documents: DataFrame) -> DataFrame:
    """documents (company_name, document_type, title, url, …) with the folder and file that a download gets."""
    named = D.with_target_name(documents, "file_name", F.col("document_type"), F.col("title"), F.col("extracted_year"), F.col("extracted_quarter"), F.col("file_extension"))
    return named.withColumn("folder", F.concat_ws(" - ", "ticker", D.safe_company(F.col("company_name"))))
