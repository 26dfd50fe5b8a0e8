"""Filters by a scorer: an injected function from texts to numbers. The default is deterministic keyword overlap."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hits, joined
from .filters import ranked

Scorer = Callable[[pd.Series], pd.Series]


def overlap(text: Column, words: list[str]) -> Column:
    """Share of the words that are in the text, from 0 to 1; 0.5 without words."""
    return hits(F.lower(text), words) / len(words) if words else F.lit(0.5)


def scored(df: DataFrame, text: Column, words: list[str], scorer: Scorer | None = None) -> DataFrame:
    """relevance_score from 0 to 1; what a scorer can't tell is 0.5."""
    if scorer is None:
        return df.withColumn("relevance_score", overlap(text, words))

    @F.pandas_udf("double")
    def run(t: pd.Series) -> pd.Series:
        return pd.to_numeric(scorer(t), errors="coerce").fillna(0.5).clip(0, 1).astype("float64")

    return df.withColumn("relevance_score", run(text))


def documents(df: DataFrame, words: list[str], keys: list[str], scorer: Scorer | None = None, most: int = 20, least: float = 0.3) -> DataFrame:
    """A group of more than `most` is first cut to the best by keywords; then those above `least` by score."""
    found = hits(joined("url", "text"), words)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    cut = ranked(df.withColumn("_hits", found).join(sizes, keys).where((F.col("_n") <= most) | (F.col("_hits") > 0)), keys, F.desc(F.when(F.col("_n") > most, F.col("_hits")).otherwise(0)), F.asc("ord"), most=most, name="_k").drop("_hits", "_n", "_k")
    kept = scored(cut, joined("url", "text"), words, scorer).where(F.col("relevance_score") > least)
    return ranked(kept, keys, F.desc("relevance_score"), F.asc("ord"))


def links(df: DataFrame, words: list[str], keys: list[str], scorer: Scorer | None = None, most: int = 30, least: float = 0.4) -> DataFrame:
    """Only internal links, the first `most` of a group, above `least`."""
    cut = ranked(df.where(F.col("category") == "internal"), keys, F.asc("ord"), most=most, name="_k").drop("_k")
    kept = scored(cut, joined("url", "text", "title"), words, scorer).where(F.col("relevance_score") > least)
    return ranked(kept, keys, F.desc("relevance_score"), F.asc("ord"))


def tables(df: DataFrame, words: list[str], keys: list[str], scorer: Scorer | None = None, most: int = 10, least: float = 0.4) -> DataFrame:
    cut = ranked(df, keys, F.asc("ord"), most=most, name="_k").drop("_k")
    kept = scored(cut, F.lower(F.concat_ws(" ", F.flatten("headers"), F.col("row_count").cast("string"))), words, scorer).where(F.col("relevance_score") > least)
    return ranked(kept, keys, F.desc("relevance_score"), F.asc("ord"))


def by_scorer(kinds: dict[str, DataFrame], intent: dict, keys: list[str], scorer: Scorer | None = None) -> dict[str, DataFrame]:
    """Links are always filtered, documents and tables if they are targets; other kinds pass if they are targets."""
    words, types, out = intent["keywords"], intent["target_content_types"], {}
    for kind, df in kinds.items():
        rule = {"links": links, "documents": documents, "tables": tables}.get(kind)
        if kind != "links" and kind not in types:
            out[kind] = df.limit(0)
        else:
            out[kind] = rule(df, words, keys, scorer) if rule else df
    return out


def summaries(df: DataFrame, text: Column, summarize: Callable[[pd.Series], pd.Series] | None = None, most: int = 2000, words: int = 150) -> DataFrame:
    """summary of the first `most` characters, by an injected function, else their first `words` words."""
    head = F.substring(text, 1, most)
    if summarize is None:
        return df.withColumn("summary", F.array_join(F.slice(F.split(F.trim(head), r"\s+"), 1, words), " "))

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return summarize(t)

    return df.withColumn("summary", run(head))
