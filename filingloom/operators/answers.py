"""Answers of a paid function, each asked for once.

A prompt's key is the hash of its text and of the asker's name. The different prompts of a table that the store doesn't hold
are asked, in batches in the tasks, and what comes back is one more segment of the store's log, committed before any row
gets its answer. So later runs, and rows that share a prompt, ask nothing; a run that dies in between has asked what it
asked, and the next one asks only what no commit names.

Prompts that very many rows share are joined back over `salts` tasks each: a prompt counts as such from a quarter of a
partition's share on, so there are at most four of them a partition. A null prompt has no answer and isn't asked; an error
leaves no answer, and the prompt is asked again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.log import Log
from ..sources.stage import saved, scratch

Ask = Callable[[pd.Series], pd.Series]
TABLES = {"answers": "key binary, asker string, prompt string, answer string"}


class Answers:
    def __init__(self, spark: SparkSession, folder: str | None = None, salts: int = 16) -> None:
        """folder: where the store is kept; a new one below the checkpoint folder if none is given."""
        self.spark, self.salts = spark, salts
        self.log = Log(spark, folder or scratch(spark, "answers"), TABLES).resume()

    def known(self, asker: str) -> DataFrame:
        return self.log.read("answers").where(F.col("asker") == asker)

    def ask(self, prompts: DataFrame, asker: str, ask: Ask) -> None:
        """Ask for the prompts (key, prompt; different ones) that the store doesn't hold. ask gets texts and returns texts or
        numbers; a batch that fails is tried text by text."""

        def run(batches):
            for b in batches:
                texts = b.column("prompt").to_pandas()
                try:
                    found = ask(texts).astype("string")
                except Exception:  # which of them it was: the others have their answers
                    found = pd.Series([_one(ask, t) for t in texts], index=texts.index, dtype="string")
                whole = pa.table({"key": b.column("key"), "prompt": b.column("prompt"), "answer": pa.array([None if pd.isna(x) else x for x in found], pa.string())})
                yield from whole.filter(whole.column("answer").is_valid()).to_batches()

        new = prompts.join(self.known(asker).select("key"), "key", "left_anti").select("key", "prompt")
        # a function of batches, as an expression might be worked out more than once
        got = new.mapInArrow(run, "key binary, prompt string, answer string").withColumn("asker", F.lit(asker))
        self.log.add("answers", got)
        self.log.merge("answers")
        self.log.commit()

    def answered(self, df: DataFrame, prompt: Column, asker: str, ask: Ask, name: str = "answer") -> DataFrame:
        """df with the answers to its prompts as a column of text."""
        columns = df.columns
        keyed = df.withColumns({"__prompt": prompt, "__key": F.when(prompt.isNotNull(), F.unhex(F.sha2(F.concat_ws("\n", F.lit(asker), prompt), 256)))})
        counts = saved(keyed.where(F.col("__key").isNotNull()).groupBy(F.col("__key").alias("key")).agg(F.first("__prompt").alias("prompt"), F.count("*").alias("n")))
        self.ask(counts.select("key", "prompt"), asker, ask)
        total, parts = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        hot = F.broadcast(counts.where(F.col("n") * 4 * parts > total).select(F.col("key").alias("__key"), F.lit(True).alias("__hot")))
        salted = keyed.join(hot, "__key", "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*(c for c in columns)), F.lit(self.salts))).otherwise(0))
        every = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(self.salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
        mine = self.known(asker).join(counts.select("key"), "key", "left_semi").select(F.col("key").alias("__key"), F.col("answer").alias("__answer"))
        spread = mine.join(hot, "__key", "left").select("__key", "__answer", F.explode(every).alias("__salt"))
        return salted.drop("__hot").join(spread, ["__key", "__salt"], "left").select(*columns, F.col("__answer").alias(name))


def _one(ask: Ask, text: str) -> str | None:
    try:
        got = ask(pd.Series([text])).iloc[0]
        return None if pd.isna(got) else str(got)
    except Exception:
        return None


def scored(df: DataFrame, text: Column, store: Answers, asker: str, scorer: Ask) -> DataFrame:
    """relevance_score from 0 to 1 by a scorer whose answers are kept; what it can't tell is 0.5."""
    got = store.answered(df, text, asker, scorer, "__score")
    return got.withColumn("relevance_score", F.least(F.greatest(F.coalesce(F.col("__score").try_cast("double"), F.lit(0.5)), F.lit(0.0)), F.lit(1.0))).drop("__score")
