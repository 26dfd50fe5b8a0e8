"""Rules that read an intent text or shape one."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from .text import any_in, first_class, joined, let


def keywords(intent: Column) -> Column:
    """The listed words in the text and their variants, sorted."""
    low = F.lower(intent)
    found = [F.when(low.contains(w), F.array(F.lit(w))) for w in R.INTENT_KEYWORDS]
    found += [F.when(any_in(low, when), F.array(*map(F.lit, more))) for when, more in R.INTENT_VARIANTS]
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.flatten(F.array(*(F.coalesce(x, none) for x in found)))))


def target_types(intent: Column) -> Column:
    low = F.lower(intent)
    return F.filter(F.array(F.lit("links"), *(F.when(any_in(low, words), name) for name, words in R.INTENT_TARGETS)), lambda x: x.isNotNull())


def rule_based(intent: Column) -> Column:
    """The intent record of exact mode."""
    return F.struct(
        intent.alias("original_intent"), F.trim(intent).alias("expanded_intent"), keywords(intent).alias("keywords"), target_types(intent).alias("target_content_types"),
        F.array(F.lit("keyword_matching"), F.lit("pattern_matching")).alias("filtering_steps"), F.lit("keyword_presence").alias("relevance_criteria"), F.array(F.lit("follow_relevant_links"), F.lit("extract_documents")).alias("next_actions"),
    )


def content_words(text: Column, most: int = 10) -> Column:
    """Words of over 3 letters that are no stop words, distinct, in order of appearance."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w+\b"), 0)
    return F.slice(F.array_distinct(F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(*R.STOP_WORDS))), 1, most)


def actions(intent: Column) -> Column:
    low = F.lower(intent)
    found = F.filter(F.array(*(F.when(any_in(low, words), name) for name, words in R.ACTION_WORDS)), lambda x: x.isNotNull())
    return let(found, lambda x: F.when(F.size(x) == 0, F.array(F.lit("find"))).otherwise(x))


def targets(intent: Column) -> Column:
    low = F.lower(intent)
    found = F.filter(F.array(*(F.when(low.rlike(p), name) for name, p in R.TARGET_PATTERNS)), lambda x: x.isNotNull())
    return let(found, lambda x: F.when(F.size(x) == 0, F.array(F.lit("content"))).otherwise(x))


def domain(intent: Column) -> Column:
    low = F.lower(intent)
    return F.coalesce(*(F.when(any_in(low, words), name) for name, words in R.DOMAIN_WORDS))


def is_complex(intent: Column) -> Column:
    low = F.lower(intent)
    commas = F.length(intent) - F.length(F.replace(intent, F.lit(","), F.lit("")))
    return (F.length(intent) > 50) | (low.contains(" and ") & low.contains(" then ")) | any_in(low, R.COMPLEX_WORDS) | (commas > 2)


def strategy_types(intent: Column) -> Column:
    """Content types that the rules aim at."""
    return let(F.struct(actions(intent).alias("a"), targets(intent).alias("t")), lambda x: _types(x["a"], x["t"]))


def _types(a: Column, t: Column) -> Column:
    return F.filter(
        F.array(*(F.when(F.array_contains(t, name) | (F.array_contains(a, verb) if verb else F.lit(False)), name) for name, verb in (("documents", "download"), ("links", "find"), ("tables", None), ("content", "extract")))), lambda x: x.isNotNull()
    )


def strategy(intent: Column, has_documents: Column, has_tables: Column, internal_links: Column) -> Column:
    """The rules' strategy: expanded intent, steps in order, next actions."""
    read = F.struct(actions(intent).alias("a"), targets(intent).alias("t"), content_words(intent).alias("words"))
    known = let(read, lambda x: F.struct(x["a"].alias("a"), x["t"].alias("t"), x["words"].alias("words"), _types(x["a"], x["t"]).alias("types"), F.array_join(F.slice(x["words"], 1, 5), ", ").alias("listed")))
    return let(known, lambda x: _strategy(x, has_documents, has_tables, internal_links))


def _strategy(known: Column, has_documents: Column, has_tables: Column, internal_links: Column) -> Column:
    types, listed = known["types"], known["listed"]
    steps = {
        "documents": F.when(has_documents, F.concat(F.lit("filter_documents: Document URL or text contains keywords: "), listed)).otherwise(F.concat(F.lit("search_links_for_documents: Find links that might lead to documents (containing: "), listed, F.lit(")"))),
        "links": F.concat(F.lit("filter_links: Link URL or text contains keywords: "), listed),
        "tables": F.concat(F.lit("extract_tables: Tables with headers or content related to: "), listed),
        "content": F.concat(F.lit("extract_content: Text content containing keywords: "), listed),
    }
    chosen = F.filter(F.array(*(F.when(F.array_contains(types, k), v) for k, v in steps.items())), lambda x: x.isNotNull())
    numbered = F.transform(chosen, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x))
    nexts = F.filter(
        F.array(
            F.when(has_documents, "Download and analyze documents"), F.when(internal_links > 0, "Follow internal links for more content"),
            F.when(~has_documents & ~has_tables, "Navigate to linked pages to find target content"),
        ), lambda x: x.isNotNull())
    whole = F.concat(F.lit("Action: "), F.array_join(known["a"], ", "), F.lit(". Targets: "), F.array_join(known["t"], ", "), F.lit(". Focus on: "), listed)
    return F.struct(whole.alias("expanded_intent"), known["words"].alias("keywords"), types.alias("target_content_types"), numbered.alias("filtering_steps"), nexts.alias("next_actions"))


SECTIONS = ("EXPANDED_INTENT", "KEYWORDS", "TARGET_CONTENT_TYPES", "FILTERING_STEPS", "RELEVANCE_CRITERIA", "NEXT_ACTIONS")


def parsed_strategy(reply: Column, intent: Column, most: int = 15) -> Column:
    """The strategy that a reply of six labelled sections states; a section that is missing is taken from the rules."""

    def part(k: int) -> Column:
        return section(reply, SECTIONS[k], SECTIONS[k + 1] if k + 1 < len(SECTIONS) else None)

    def listed(text: Column, by: str) -> Column:
        return F.filter(F.transform(F.split(text, by), lambda x: F.trim(F.regexp_replace(x, r"^[\s\-*]+", ""))), lambda x: x != "")

    return F.struct(
        F.coalesce(part(0), F.trim(intent)).alias("expanded_intent"), F.slice(F.coalesce(listed(part(1), "[,\n]"), content_words(intent)), 1, most).alias("keywords"), F.coalesce(listed(F.lower(part(2)), "[,\n]"), strategy_types(intent)).alias("target_content_types"),
        F.coalesce(listed(part(3), "\n"), F.array(F.lit("keyword_matching"))).alias("filtering_steps"), F.coalesce(part(4), F.lit("keyword_presence")).alias("relevance_criteria"), F.coalesce(listed(part(5), "\n"), F.array(F.lit("follow_relevant_links"))).alias("next_actions"),
    )


def with_strategy(df: DataFrame, intent: str, propose: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """df with strategy: of complex intents as an injected function replies (six labelled sections), of others, and where it
    returns null, by the rules."""
    rules = parsed_strategy(F.lit(None).cast("string"), F.col(intent))
    if propose is None:
        return df.withColumn("strategy", rules)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return propose(texts)

    asked = df.withColumn("__reply", F.when(is_complex(F.col(intent)), run(F.col(intent))))
    return asked.withColumn("strategy", F.when(F.col("__reply").isNotNull(), parsed_strategy(F.col("__reply"), F.col(intent))).otherwise(rules)).drop("__reply")


def is_investor_intent(words: Column, expanded: Column) -> Column:
    low = F.lower(expanded)
    return F.arrays_overlap(F.transform(words, F.lower), F.array(*map(F.lit, R.INVESTOR_INTENT))) | any_in(low, R.INVESTOR_INTENT)


def refined(url: Column, text: Column) -> Column:
    """The intent that a link gets by rules."""

    def case(x: Column) -> Column:
        out = None
        for where, words, says in R.REFINED_INTENTS:
            out = F.when(any_in(x[where], words), says) if out is None else out.when(any_in(x[where], words), says)
        return out.otherwise(R.REFINED_OTHER)

    return let(F.struct(F.lower(url).alias("url"), F.lower(text).alias("text")), case)


def heuristic(url: Column, text: Column, types: list[str], root: str) -> Column:
    other = F.concat(F.lit("Explore '"), F.lower(text), F.lit(f"' to find content relevant to: {root}"))
    rules = [(says + root, words) for kind, words, says in R.HEURISTIC_INTENTS if kind in types]
    return first_class(F.concat(F.lower(text), F.lower(url)), rules, other) if rules else other


def section(text: Column, marker: str, end: str | None = None) -> Column:
    """What follows a marker, up to the end marker or the end of the text; null if it isn't there."""
    found = F.regexp_extract(text, rf"(?is){marker}:\s*(.+?)(?:{end + ':|' if end else ''}$)", 1)
    return F.nullif(F.regexp_replace(found, r"^\s+|\s+$", ""), F.lit(""))


def page_type(title: Column, headings: Column, documents: Column, tables: Column, internal: Column) -> Column:
    """headings: array of text; the last three are counts."""
    by_count = F.when(documents > 5, "document_library").when(tables > 3, "data_page").when(internal > 20, "navigation_hub").otherwise("content_page")
    return first_class(joined(title, F.array_join(headings, " ")), R.PAGE_TYPES, by_count)
