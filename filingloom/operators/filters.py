"""Filters by keywords and weights. Each takes and returns DataFrames; an ordinal column breaks ties as the input's order.

An empty keyword list is the identity. Words match as substrings of lower-cased text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls
from ..functions.text import any_in, hits, joined, matched, matched_weights, weight


def ranked(df: DataFrame, keys: list[str], *order: Column, most: int | None = None, name: str = "rank") -> DataFrame:
    """Rank within keys; only the first `most` stay."""
    df = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return df if most is None else df.where(F.col(name) <= most)


def by_keywords(df: DataFrame, text: Column, words: list[str], keys: list[str], most: int | None = None, ordinal: str = "ord", reorder: bool = True) -> DataFrame:
    """Rows with a keyword in text, with relevance_score, matched_keywords and rank: best first, or in input order."""
    if not words:
        return df
    found = df.withColumn("_text", text).withColumns({"relevance_score": hits(F.col("_text"), words), "matched_keywords": matched(F.col("_text"), words)}).where("relevance_score > 0").drop("_text")
    return ranked(found, keys, *([F.desc("relevance_score")] if reorder else []), F.asc(ordinal), most=most)


def documents(df: DataFrame, words: list[str], keys: list[str]) -> DataFrame:
    return by_keywords(df, joined("url", "text"), words, keys)


def links(df: DataFrame, words: list[str], keys: list[str]) -> DataFrame:
    return by_keywords(df, joined("url", "text", "title"), words, [*keys, "category"])


def tables(df: DataFrame, words: list[str], keys: list[str]) -> DataFrame:
    """headers and body are arrays of rows of cells; the first five body rows count."""
    caption = F.col("caption") if "caption" in df.columns else F.lit("")
    cells = F.concat_ws(" ", caption, F.flatten("headers"), F.flatten(F.slice("body", 1, 5)))
    return by_keywords(df, F.lower(cells), words, keys)


def paragraphs(df: DataFrame, words: list[str], keys: list[str], most: int = 20) -> DataFrame:
    return by_keywords(df, joined("text"), words, keys, most)


def images(df: DataFrame, words: list[str], keys: list[str], most: int = 10) -> DataFrame:
    return by_keywords(df, joined("alt", "title"), words, keys, most)


def headings(df: DataFrame, words: list[str], keys: list[str]) -> DataFrame:
    return by_keywords(df, joined("text"), words, keys, reorder=False)


def exact(kinds: dict[str, DataFrame], words: list[str], types: list[str], keys: list[str]) -> dict[str, DataFrame]:
    """Exact mode: content types that aren't targets are emptied, the others filtered; content also gates structure."""
    rules = {"links": links, "documents": documents, "tables": tables, "content": paragraphs, "images": images, "structure": headings}
    gate = {"structure": "content"}
    return {k: rules[k](df, words, keys) if gate.get(k, k) in types else df.limit(0) for k, df in kinds.items()}


def exact_investor(kinds: dict[str, DataFrame], words: list[str], types: list[str], keys: list[str], table_links: DataFrame | None = None) -> dict[str, DataFrame]:
    """Exact mode for investor intents: links by tiers, documents by weights."""
    out = exact(kinds, words, types, keys)
    if "links" in kinds:
        out["links"] = tiered_links(kinds["links"], words, keys, table_links) if "links" in types or not types else kinds["links"]
    if "documents" in kinds and "documents" in types:
        out["documents"] = weighted_documents(kinds["documents"], words, keys)
    return out


def by_intent(kinds: dict[str, DataFrame], intent: dict, keys: list[str], mode: str = "exact", **more) -> dict[str, DataFrame]:
    """Dispatch: exact rules (for investor intents the weighted ones), or a scorer's."""
    words, types = intent["keywords"], intent["target_content_types"]
    if mode == "exact":
        listed = R.INVESTOR_INTENT
        investor = any(w in [k.lower() for k in words] for w in listed) or any(w in intent["expanded_intent"].lower() for w in listed)
        return (exact_investor if investor else exact)(kinds, words, types, keys)
    if mode in ("guidance", "ai"):
        from .scorers import by_scorer

        return by_scorer(kinds, intent, keys, **more)
    raise ValueError(f"unknown mode {mode}")


def weighted_links(df: DataFrame, words: list[str], keys: list[str], least: int = 15) -> DataFrame:
    """Links whose weights (URL, text, document words) and ten times the keywords exceed `least`."""
    df = df.withColumns({"_url": F.lower("url"), "_text": joined("text", "title"), "_all": joined("text", "title", "url")})
    scored = df.withColumn("ir_score", weight(F.col("_url"), R.LINK_URL_WEIGHTS) + weight(F.col("_text"), R.LINK_TEXT_WEIGHTS) + weight(F.col("_all"), R.LINK_DOCUMENT_WEIGHTS))
    scored = scored.withColumn("keyword_score", hits(joined("url", "text", "title"), words)).withColumn("relevance_score", F.col("ir_score") + 10 * F.col("keyword_score"))
    shown = F.concat(matched_weights(F.col("_url"), R.LINK_URL_WEIGHTS, "URL:"), matched_weights(F.col("_text"), R.LINK_TEXT_WEIGHTS, "TEXT:"))
    kept = scored.where(F.col("relevance_score") > least).withColumn("matched_patterns", shown).drop("_url", "_text", "_all")
    return ranked(kept, [*keys, "category"], F.desc("relevance_score"), F.asc("ord"))


def company_links(df: DataFrame) -> DataFrame:
    """Profile links with a ticker of at most 5 characters."""
    return df.withColumn("ticker", urls.profile_ticker(F.col("url"))).where((F.length("ticker") > 0) & (F.length("ticker") <= 5))


def tiered_links(df: DataFrame, words: list[str], keys: list[str], table_links: DataFrame | None = None) -> DataFrame:
    """A page's profile links from tables if it has any; else its links to known profiles; else weighted links."""
    low = F.lower("url")
    columns = [*keys, "ord", "category", "url", "text", "title", "relevance_score", "tier", "ticker"]
    marked = company_links(df.where((low.contains("/quotes/") | low.contains("/symbol/")) & low.contains("cnbc.com"))).withColumns({"category": F.lit("internal"), "relevance_score": F.lit(0.95), "tier": F.lit(2)})
    plain = weighted_links(df, words, keys).withColumns({"tier": F.lit(3), "ticker": F.lit(None).cast("string"), "relevance_score": F.col("relevance_score").cast("double")})
    whole = marked.select(columns).unionByName(plain.select(columns))
    if table_links is not None:
        first = company_links(table_links.where("is_company_profile")).withColumns({"category": F.lit("internal"), "relevance_score": F.lit(0.95), "tier": F.lit(1)})
        whole = whole.unionByName(first.select(columns))
    best = whole.groupBy(*keys).agg(F.min("tier").alias("tier"))
    return whole.join(best, [*keys, "tier"])


def weighted_documents(df: DataFrame, words: list[str], keys: list[str]) -> DataFrame:
    """Documents by twice their weights and the keywords, if positive."""
    scored = df.withColumn("_text", joined("url", "text")).withColumn("relevance_score", 2 * weight(F.col("_text"), R.DOCUMENT_WEIGHTS) + hits(F.col("_text"), words))
    scored = scored.withColumns({"matched_patterns": matched_weights(F.col("_text"), R.DOCUMENT_WEIGHTS), "matched_keywords": matched(F.col("_text"), words)})
    return ranked(scored.where("relevance_score > 0").drop("_text"), keys, F.desc("relevance_score"), F.asc("ord"))


def site_score(url: Column, text: Column, title: Column) -> Column:
    return weight(F.lower(url), R.SITE_URL_WEIGHTS) + weight(joined(text, title), R.SITE_TEXT_WEIGHTS)


def site_links(df: DataFrame, keys: list[str], least: int = 15) -> DataFrame:
    kept = df.withColumn("relevance_score", site_score(F.col("url"), F.col("text"), F.col("title"))).where(F.col("relevance_score") > least)
    return ranked(kept, [*keys, "category"], F.desc("relevance_score"), F.asc("ord"))


def enhanced_links(df: DataFrame, words: list[str], keys: list[str]) -> DataFrame:
    """Site weights if the keywords speak of investors; all links without keywords; else by keywords."""
    if {w.lower() for w in words} & {"investor", "relations", "ir", "financial"}:
        return site_links(df, keys)
    return links(df, words, keys)


def priorities(df: DataFrame, words: list[str], types: list[str], keys: list[str], least: float = 0.5, limit: int | None = None) -> DataFrame:
    """Links with final_priority of at least `least`, best first. A relevance_score column raises it, if there is one."""
    base = F.when(F.col("category") == "internal", 1.0).when(F.col("category") == "external", 0.6).otherwise(0.3)
    df = df.withColumns({"base_priority": base, "_text": joined("url", "text", "title")})
    score = F.col("base_priority")
    if "relevance_score" in df.columns:
        score = score + F.coalesce("relevance_score", F.lit(0)) * 0.5
    slashes = F.length("url") - F.length(F.replace("url", F.lit("/"), F.lit("")))
    score = score + hits(F.col("_text"), words) * 0.2 + F.when(slashes > 3, 0.1).otherwise(0.0)
    score = F.when(any_in(F.lower("url"), R.PENALTY_WORDS), score * 0.3).otherwise(score)
    if "documents" in types:
        score = score + F.when(any_in(F.col("_text"), R.DOCUMENT_BONUS), 0.3).otherwise(0.0)
    if "tables" in types:
        score = score + F.when(any_in(F.col("_text"), R.TABLE_BONUS), 0.3).otherwise(0.0)
    kept = df.withColumn("final_priority", F.round(score, 3)).drop("_text").where(F.col("final_priority") >= least)
    return ranked(kept, keys, F.desc("final_priority"), F.asc("ord"), most=limit)


def sections(df: DataFrame, base_url: str = "base_url", keys: tuple[str, ...] = ("page_id",), most: int = 20) -> DataFrame:
    """Likely sections among a page's anchors (ord, href, text, url: resolved), one for each address, best first."""
    text, href = F.lower(F.trim("text")), F.lower("href")
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    likely = words.between(1, 6) & (urls.path_depth(F.col("href")) <= 3) & (any_in(text, R.SECTION_WORDS) | any_in(href, R.SECTION_WORDS)) & ~any_in(text, R.SECTION_STOPS)
    usable = (F.col("href") != "") & ~F.col("href").startswith("#") & ~F.col("href").startswith("javascript:") & (F.length(F.trim("text")) >= 3)
    same = urls.host(F.col("url")) == urls.host(F.col(base_url))
    score = sum(((text.contains(w) | href.contains(w)).cast("int") for w in R.SECTION_PRIORITY), F.lit(0))
    kept = df.where(usable & same & likely).withColumns({"priority": score, "address": urls.without_query(F.col("url"))}).where(F.col("address") != urls.without_query(F.col(base_url)))
    first = ranked(kept, [*keys, "address"], F.desc("priority"), F.asc("ord"), name="_first").where("_first = 1").drop("_first")
    return ranked(first, list(keys), F.desc("priority"), F.asc("ord"), most=most)


def sample(df: DataFrame, ticker: str | None = None, types: list[str] | None = None, size: int = 2) -> DataFrame:
    """The first `size` documents of all, by ticker, type and file name."""
    df = df if ticker is None else df.where(F.col("ticker") == ticker)
    df = df if not types else df.where(F.col("document_type").isin(*types))
    return df.orderBy("ticker", "document_type", "file_name").limit(size)
