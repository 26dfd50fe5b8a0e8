"""Whole chains: a page by intent, a company's documents, an index page's companies."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import intents as I
from ..functions import urls
from . import filters, html, ranking, resolve, summaries


def document_info(links: DataFrame, as_of: int) -> DataFrame:
    """links (url, text, others) with what they say as documents; a text of under 5 characters gives way to the file's name."""
    text = F.trim(F.coalesce("text", F.lit("")))
    title = F.when(F.length(text) < 5, D.name_from_url(F.col("url"))).otherwise(text)
    whole = F.concat_ws(" ", "_title", "url")
    info = D.with_document_type(links.withColumn("_title", title), "document_type", F.col("url"), F.col("_title"), F.lit(""))
    info = D.with_year(info, "extracted_year", whole, as_of).withColumns({
        "normalized_url": urls.without_query(F.col("url")), "publication_date": D.date_text(whole), "file_extension": urls.extension(F.col("url")),
        "relevance_score": F.lit(100.0), "content_preview": F.substring("_title", 1, 150), "is_direct_file": F.lit(True), "extracted_quarter": D.quarter(whole), "title": F.substring("_title", 1, 200),
    })
    return info.withColumn("subsection", F.col("document_type")).drop("_title")


def page_files(links: DataFrame, as_of: int) -> DataFrame:
    """Direct files among the links (company_ord, page_ord, ord, url, text, section), each under its first owner, as documents."""
    return document_info(ranking.owner_of_address(links), as_of)


def company_documents(links: DataFrame, as_of: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All documents of companies' links (ticker and those of page_files), the latest of each type, the latest quarterly report."""
    found = page_files(links, as_of)
    return found, ranking.latest_per_type(found), ranking.latest_quarterly(found)


def page_by_intent(pages: DataFrame, intent: dict, mode: str = "exact", **more) -> dict[str, DataFrame]:
    """pages (page_id, url, html) parsed, filtered by the intent and ranked: the filtered kinds, and next_links with refined intents."""
    got = html.parsed(pages)
    kinds = {k: html.exploded(got, k, "page_id") for k in ("links", "documents", "images", "tables")}
    kinds["structure"] = html.exploded(got, "headings", "page_id")
    kinds["content"] = html.exploded(got.select("page_id", F.col("content.paragraphs").alias("p")), "p", "page_id")
    out = filters.by_intent(kinds, intent, ["page_id"], mode, **more)
    ranked = filters.priorities(out["links"].drop("rank"), intent["keywords"], intent["target_content_types"], ["page_id"])
    return out | {"next_links": ranked.withColumn("refined_intent", I.refined(F.col("url"), F.col("text")))}


def refined_links(links: DataFrame, types: list[str], root: str, keys: list[str], refine: Callable[[pd.Series], pd.Series] | None = None, most: int = 5) -> DataFrame:
    """links (ord, url, text) with refined_intent and root_intent: the first `most` of a group by an injected function of
    their text and address, the others by rules."""
    by_rule = I.heuristic(F.col("url"), F.col("text"), types, root)
    if refine is None:
        return links.withColumns({"refined_intent": by_rule, "root_intent": F.lit(root)})

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return refine(t)

    first = filters.ranked(links, keys, F.asc("ord"), name="_k")
    asked = F.when(F.col("_k") <= most, run(F.concat_ws(" ", "text", "url")))
    return first.withColumns({"refined_intent": F.coalesce(asked, by_rule), "root_intent": F.lit(root)}).drop("_k")


def index_companies(pages: DataFrame, origin: str, stored: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies of index pages, with their website and investor page from stored pages and links (ticker, ord, url, text,
    title), and one row on how many were found."""
    rows = ranking.distinct_companies(html.index_rows(pages, origin), "ticker", "url")
    named = rows.select("ticker", F.col("text").alias("company_name"), F.col("url").alias("cnbc_url"))
    sites = resolve.best_sites(links.join(named.select("ticker", "company_name"), "ticker"))
    whole = resolve.resolve(named.join(sites, "ticker", "left"), stored, links)
    return whole, summaries.resolution(whole)


def first_pdfs(pages: DataFrame, most: int = 10) -> DataFrame:
    """The first anchors of each page whose address names a PDF."""
    links = html.exploded(html.parsed(pages, "links"), "links", "page_id").where(F.lower("href").contains(".pdf"))
    return filters.ranked(links, ["page_id"], F.asc("ord"), most=most)
