"""What needs a network or a decoder, as functions that a caller injects; each default works offline.

A provider fails by row: its row gets success false and an error text, and the job goes on.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import urls

FETCHED = "html string, success boolean, error string, tries int"
EXTRACTED = "struct<success:boolean,text_content:string,tables:array<struct<caption:string,content:string,bbox:string>>,metadata:struct<title:string,page_count:int,language:string,creation_date:string>,elements:array<struct<type:string,label:string,text:string,bbox:string>>,error:string>"


def retried(work: Callable, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> Callable:
    """work, tried again after 1, 2, 4 … seconds; returns (result, error, tries)."""

    def run(x):
        for i in range(tries):
            try:
                return work(x), None, i + 1
            except Exception as e:  # a provider may fail in any way; the row says how
                error = f"{type(e).__name__}: {e}"
                if i + 1 < tries:
                    wait(2.0**i)
        return None, error, tries

    return run


def stored(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Fetch from stored pages (url, html): requests with html, success, error."""
    known = pages.select(urls.canonical(F.col("url")).alias("_u"), "html").dropDuplicates(["_u"])
    whole = requests.withColumn("_u", urls.canonical(F.col("url"))).join(known, "_u", "left").drop("_u")
    return whole.withColumns({"success": F.col("html").isNotNull(), "error": F.when(F.col("html").isNull(), "not stored")})


def throttled(work: Callable, least: float, most: float | None = None, wait: Callable[[float], None] = time.sleep, draw: Callable[[float, float], float] = random.uniform) -> Callable:
    """work, with a pause of `least` to `most` seconds between calls, none before the first."""
    began = False

    def run(x):
        nonlocal began
        if began:
            wait(least if most is None else draw(least, most))
        began = True
        return work(x)

    return run


def fetched(requests: DataFrame, fetch: Callable[[str], str], tries: int = 3, wait: Callable[[float], None] = time.sleep, pause: float = 0.0, workers: int | None = None) -> DataFrame:
    """Fetch by an injected function, by at most `workers` tasks at once, each with a pause between its calls."""
    from pyspark.sql import types as T

    requests = requests if workers is None else requests.coalesce(workers)

    def run(batches):
        one = throttled(retried(fetch, tries, wait), pause, wait=wait) if pause else retried(fetch, tries, wait)
        for b in batches:
            got = [one(u) for u in b.column("url").to_pylist()]
            more = {"html": pa.array([g[0] for g in got], pa.string()), "success": pa.array([g[1] is None for g in got]), "error": pa.array([g[1] for g in got], pa.string()), "tries": pa.array([g[2] for g in got], pa.int32())}
            yield pa.record_batch({n: b.column(n) for n in b.schema.names} | more)

    return requests.mapInArrow(run, T.StructType([*requests.schema, *T.StructType.fromDDL(FETCHED)]))


def downloaded(documents: DataFrame, existing: DataFrame, save: Callable[[str, str, str], int], tries: int = 3, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """documents (url, folder, file_name) with status and size_mb. What existing (folder, file_name) has is skipped; save
    gets address, folder and name and returns the bytes written."""
    from pyspark.sql import types as T

    marked = documents.join(existing.select("folder", "file_name").distinct().withColumn("_there", F.lit(True)), ["folder", "file_name"], "left")
    kept = T.StructType([f for f in marked.schema if f.name != "_there"])

    def run(batches):
        one = retried(lambda x: save(*x), tries, wait)
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("url", "folder", "file_name", "_there")), strict=True)
            got = [("skipped", 0.0) if there else ("downloaded", r[0] / 2**20) if (r := one((u, f, n)))[1] is None else ("failed", 0.0) for u, f, n, there in rows]
            yield pa.record_batch({n: b.column(n) for n in kept.names} | {"status": pa.array([g[0] for g in got]), "size_mb": pa.array([g[1] for g in got], pa.float64())})

    return marked.mapInArrow(run, T.StructType([*kept, T.StructField("status", T.StringType()), T.StructField("size_mb", T.DoubleType())]))


def plain_text(content: bytes) -> dict:
    """The offline decoder: the file's own text, without tables."""
    return {"text_content": content.decode("utf-8", "replace"), "tables": [], "metadata": {}, "elements": []}


def first_of(*decoders: Callable[[bytes], dict], falls_back: Callable[[Exception], bool] = lambda e: True) -> Callable[[bytes], dict]:
    """A decoder that tries the given ones in turn; an error for which falls_back is false ends it."""

    def run(content: bytes) -> dict:
        for k, decode in enumerate(decoders):
            try:
                return decode(content)
            except Exception as e:
                if k + 1 == len(decoders) or not falls_back(e):
                    raise
        raise ValueError("no decoder")

    return run


def company_info(df: DataFrame, text: str, ask: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """df with ticker: as an injected function of the text has it; by the rule where there is none or it returns null."""
    rule = D.bracketed_ticker(F.col(text))
    if ask is None:
        return df.withColumn("ticker", rule)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return ask(texts)

    return df.withColumn("ticker", F.coalesce(run(F.col(text)), rule))


def extracted(files: DataFrame, decode: Callable[[bytes], dict] = plain_text) -> DataFrame:
    """files (content and others) with result: the decoded document, or success false and an error."""

    @F.pandas_udf(EXTRACTED)
    def run(content: pd.Series) -> pd.DataFrame:
        rows = []
        for c in content:
            try:
                rows.append({"success": True, "error": None, **decode(bytes(c))})
            except Exception as e:
                rows.append({"success": False, "text_content": "", "tables": [], "metadata": {}, "elements": [], "error": f"{type(e).__name__}: {e}"})
        return pd.DataFrame(rows, columns=["success", "text_content", "tables", "metadata", "elements", "error"])

    return files.withColumn("result", run("content")).drop("content")


def document_summary(results: DataFrame) -> DataFrame:
    """A row for each file, as the summary file has it."""
    return results.select("ticker", "document_type", F.col("extracted_year").alias("year"), F.col("extracted_quarter").alias("quarter"), "file_name", "file_size_mb", F.col("result.success").alias("extraction_success"),
                          F.length("result.text_content").alias("text_length"), F.size("result.tables").alias("table_count"), F.col("result.error").alias("error"))


def financial_metrics(results: DataFrame) -> DataFrame:
    """A row for each decoded file with the amounts that its text names."""
    text = F.col("result.text_content")
    return results.where("result.success").select("ticker", "document_type", F.col("extracted_year").alias("year"), F.col("extracted_quarter").alias("quarter"), D.revenue(text).alias("revenue"), D.profit(text).alias("profit"), F.length(text).alias("text_length"))
