"""From documents to a training mix: each stage works on what the stage before it kept.

1. language: documents whose language can't be told go.
2. near_duplicates: one document of each group of similar ones stays, the one with the smallest doc_id.
3. repeated_passages: words of passages that stand earlier go from the texts.
4. benchmark: documents that leak a benchmark item go.
5. mix: all documents, once each, with the copies that bring each source to its target. Whoever reads the mix has to
   apply `copies`: leave out rows with 0 and repeat those with 2; the rows as they stand have the input's distribution.

The first four return the columns of documents. Rows that share a doc_id count as separate documents. Rows of equal
doc_id and text count once from the second stage on; if they differ elsewhere, the one with the smallest hash of all
columns stays. Each stage's result is written before the next reads it. Columns beside those in CORE stand aside while a
stage works, so their names clash with nothing; `mix` replaces those that are named like its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm import common, decontaminate, jaccard_join, language_id, mixing, substring_dedup


#: Columns that stages read or write.
CORE = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(stage: Stage) -> Stage:
    """The stage, with private names for columns that it doesn't know."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"__fl_aside{k}" for k, c in enumerate(docs.columns) if c.lower() not in CORE}
        return stage(spark, docs.withColumnsRenamed(names), sf_dir).withColumnsRenamed({v: k for k, v in names.items()})

    return run


@_aside
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs, F.lit(True))
    return language_id.predict(docs, model).where("not rejected").select(*docs.columns)


@_aside
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.groups(docs.select("doc_id", "text"))
    best = found.groupBy("group_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("x"))
    kept = best.select(F.col("x.doc_id").alias("__fl_id"), F.col("x.text_key").alias("__fl_kept"))
    keyed = common.shrunk(docs.withColumns({"__fl_key": F.xxhash64("text"), "__fl_row": common.row_key(docs)}))
    kept = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("__fl_id")) & (F.col("__fl_key") == F.col("__fl_kept")), "left_semi")
    once = kept.groupBy(F.col("doc_id").alias("__fl_id"), "__fl_key").agg(F.min_by(F.struct(*docs.columns), "__fl_row").alias("x"))
    return common.unshrunk(once.select("x.*"))


@_aside
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_words")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


@_aside
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _aside(lambda _, rest, __: mixing.mix(rest))(spark, docs.drop(*mixing.RESULT), sf_dir)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark", benchmark),
    ("mix", mix),
]
#: The trained and balanced stages have no SQL; tests/llm/test_pipeline.py holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, common.cut(docs) if k else docs, sf_dir)
    return docs
