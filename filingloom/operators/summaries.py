"""Aggregates that report on crawls, documents, downloads and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extraction(companies: DataFrame, documents: DataFrame, as_of: int) -> DataFrame:
    """One row: documents, companies with any, PDF and Excel files, old documents, average a company."""
    whole = companies.select("ticker").join(documents.select("ticker", "file_extension", "extracted_year"), "ticker", "left")
    per = whole.groupBy("ticker").agg(
        F.count("file_extension").alias("n"), F.count_if(F.col("file_extension").contains(".pdf")).alias("pdf"), F.count_if(F.col("file_extension").contains(".xls")).alias("excel"), F.count_if(F.col("extracted_year") < as_of - 1).alias("old"))
    return per.agg(
        F.count("*").alias("companies"), F.coalesce(F.sum("n"), F.lit(0)).alias("documents"), F.count_if(F.col("n") > 0).alias("with_documents"), F.coalesce(F.sum("pdf"), F.lit(0)).alias("pdf_files"),
        F.coalesce(F.sum("excel"), F.lit(0)).alias("excel_files"), F.coalesce(F.sum("old"), F.lit(0)).alias("old_documents"), F.coalesce(F.sum("n") / F.count("*"), F.lit(0.0)).alias("average"))


def by_type(documents: DataFrame, kind: str = "document_type") -> DataFrame:
    return documents.groupBy(kind).agg(F.count("*").alias("n")).orderBy(F.desc("n"), kind)


def by_depth(results: DataFrame) -> DataFrame:
    return results.groupBy(F.coalesce("depth", F.lit(0)).alias("depth")).agg(F.count("*").alias("n")).orderBy("depth")


def crawl(pages: DataFrame, results: DataFrame, seconds: float) -> DataFrame:
    """pages: url, depth, success. One row."""
    done = pages.agg(F.count_if("success").alias("pages_crawled"), F.max(F.when(F.col("success"), F.col("depth"))).alias("max_depth"))
    return done.join(results.agg(F.count("*").alias("results"))).withColumn("pages_per_second", F.when(F.lit(seconds) > 0, F.col("pages_crawled") / F.lit(seconds)).otherwise(0.0))


def resolution(companies: DataFrame) -> DataFrame:
    """Companies, those with an investor page of its own, and their share."""
    found = (F.coalesce("investor_relations_url", F.lit("")) != "") & ~F.col("investor_relations_url").eqNullSafe(F.col("company_website"))
    return companies.agg(F.count("*").alias("companies"), F.count_if(found).alias("found")).withColumn("success_rate", F.when(F.col("companies") > 0, F.col("found") / F.col("companies")).otherwise(0.0))


def downloads(log: DataFrame) -> DataFrame:
    """log: ticker, status (downloaded, failed, skipped), size_mb. A row for each ticker and one (null ticker) for all."""
    counted = log.rollup("ticker").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("downloaded", "failed", "skipped")), F.round(F.sum(F.when(F.col("status") == "downloaded", F.col("size_mb")).otherwise(0.0)), 6).alias("size_mb"))
    return counted.withColumn("success_percent", F.when(F.col("downloaded") > 0, F.col("downloaded") * 100.0 / (F.col("downloaded") + F.col("failed"))))


def files(summary: DataFrame) -> DataFrame:
    """summary: extraction_success, text_length, table_count. One row."""
    return summary.agg(F.count("*").alias("files"), F.count_if("extraction_success").alias("succeeded"), F.coalesce(F.sum("text_length"), F.lit(0)).alias("text_length"), F.coalesce(F.sum("table_count"), F.lit(0)).alias("tables"))
