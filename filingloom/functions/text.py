"""Column builders over word lists and weights. All stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined(*parts: Column | str) -> Column:
    """The parts as lower-case text with blanks between; a null part counts as empty."""
    return F.lower(F.concat_ws(" ", *(F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row however often it is used: repeated in place, long rules outgrow what
    one generated method may hold."""
    return F.element_at(F.transform(F.array(value), use), 1)


def any_in(text: Column, words: list[str]) -> Column:
    """Whether any word is a substring; an empty list is never."""
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words), F.lit(False)) if len(words) != 1 else text.contains(words[0])


def hits(text: Column, words: list[str]) -> Column:
    """How many of the words are substrings."""
    return let(text, lambda t: sum((t.contains(w.lower()).cast("int") for w in words), F.lit(0))) if words else F.lit(0)


def matched(text: Column, words: list[str]) -> Column:
    """The words that are substrings, in the list's order."""
    return let(text, lambda t: F.filter(F.array(*map(F.lit, words)), lambda w: t.contains(F.lower(w)))) if words else F.array().cast("array<string>")


def weight(text: Column, weights: list[tuple[str, int]]) -> Column:
    """Sum of the weights of the patterns that are substrings."""
    return let(text, lambda t: sum((F.when(t.contains(p), w).otherwise(0) for p, w in weights), F.lit(0)))


def matched_weights(text: Column, weights: list[tuple[str, int]], label: str = "") -> Column:
    listed = F.array(*(F.lit(p) for p, _ in weights))
    return let(text, lambda t: F.transform(F.filter(listed, lambda p: t.contains(p)), lambda p: F.concat(F.lit(label), p)))


def first_class(text: Column, classes: list[tuple[str, list[str]]], other: Column | str) -> Column:
    """The name of the first class with a word in the text."""
    return let(text, lambda t: _case(t, classes, other))


def _case(t: Column, classes: list[tuple[str, list[str]]], other: Column | str) -> Column:
    out = None
    for name, words in classes:
        out = F.when(any_in(t, words), name) if out is None else out.when(any_in(t, words), name)
    return out.otherwise(F.lit(other) if isinstance(other, str) else other)


def with_class(df: DataFrame, name: str, text: Column, classes: list[tuple[str, list[str]]], other: Column | str) -> DataFrame:
    """df with first_class() as a column; the text is a step of its own, so all runs as generated code."""
    return df.withColumn("__text", text).withColumn(name, _case(F.col("__text"), classes, other)).drop("__text")


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))
