"""From a company to its investor page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls
from ..functions.text import any_in, hits, let


def name_words(name: Column) -> Column:
    """The words of a company's name that aren't legal forms."""
    words = F.split(F.trim(F.regexp_replace(F.lower(name), r"[^\w\s]", "")), r"\s+")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*R.COMPANY_SUFFIXES))


def website_score(url: Column, text: Column, name: Column, ticker: Column) -> Column:
    """How likely a link is the company's own site; -1000 for hosts of others."""
    return let(F.lower(urls.bare_host(url)), lambda domain: _site_score(domain, url, text, name, ticker))


def _site_score(domain: Column, url: Column, text: Column, name: Column, ticker: Column) -> Column:
    dots = F.length(domain) - F.length(F.replace(domain, F.lit("."), F.lit("")))
    named = F.size(F.filter(name_words(name), lambda w: (F.length(w) > 3) & domain.contains(w)))
    score = F.when(domain.contains(F.lower(ticker)), 100).otherwise(0) + 50 * named + F.when(any_in(F.lower(url), R.SITE_URL_HINTS), 30).otherwise(0)
    score = score + F.when(any_in(F.lower(text), R.SITE_TEXT_HINTS), 20).otherwise(0) + F.when(dots <= 2, 10).otherwise(0)
    return F.when((domain == "") | any_in(domain, R.IGNORED_HOSTS), -1000).otherwise(score)


def best_sites(links: DataFrame, key: str = "ticker") -> DataFrame:
    """links (key, ord, url, text, company_name, ticker): each company's best website and best investor page; without a
    website, the last two labels of the investor page's host."""
    score = website_score(F.col("url"), F.col("text"), F.col("company_name"), F.col("ticker"))
    is_ir = any_in(F.lower("url"), R.SITE_URL_HINTS) | any_in(F.lower("text"), R.SITE_TEXT_HINTS)
    scored = links.withColumns({"score": score, "is_ir": is_ir}).where("score > 0")
    rank = F.struct("score", -F.col("ord"))
    best = scored.groupBy(key).agg(F.max_by(F.when(F.col("is_ir"), F.col("url")), F.when(F.col("is_ir"), rank)).alias("investor_relations_url"), F.max_by(F.when(~F.col("is_ir"), F.col("url")), F.when(~F.col("is_ir"), rank)).alias("company_website"))
    base = F.concat(F.lit("https://"), urls.root_domain(F.lower(urls.bare_host(F.col("investor_relations_url")))))
    return best.withColumn("company_website", F.coalesce("company_website", F.when(F.col("investor_relations_url").isNotNull(), base)))


def candidates(companies: DataFrame) -> DataFrame:
    """The addresses at which a company's investor page may be, in order. companies: ticker, company_website."""
    root = urls.root_domain(urls.bare_host(F.col("company_website")))
    base = F.substring_index(root, ".", 1)

    def filled(template: str) -> Column:
        out = F.lit(template)
        for name, value in (("root", root), ("ticker", F.lower("ticker")), ("base", base)):
            out = F.replace(out, F.lit("{" + name + "}"), value)
        return out

    return companies.select("*", F.posexplode(F.array(*map(filled, R.CANDIDATE_SITES))).alias("ord", "url"))


def is_investor_page(html: Column, least: int = 2) -> Column:
    return hits(F.lower(html), R.INVESTOR_PHRASES) >= least


def resolve(companies: DataFrame, pages: DataFrame, links: DataFrame) -> DataFrame:
    """companies (ticker, company_website, investor_relations_url) with investor_relations_url and extraction_method.

    A known page stays unless it is the website itself. Else the first candidate whose stored page (url, html) speaks of
    investors; else the best link of the website (ticker, ord, url, text, title) on the company's domain; else the website."""
    from .filters import site_score

    known = F.col("investor_relations_url").isNotNull() & (F.col("investor_relations_url") != "") & ~F.col("investor_relations_url").eqNullSafe(F.col("company_website"))
    reachable = pages.where(is_investor_page(F.col("html"))).select("url").distinct()
    probed = candidates(companies.select("ticker", "company_website")).join(reachable, "url", "left_semi").groupBy("ticker").agg(F.min_by("url", "ord").alias("probed"))
    root = urls.root_domain(urls.bare_host(F.col("company_website")))
    scored = links.join(companies.where("company_website is not null").select("ticker", "company_website"), "ticker").withColumn("score", site_score(F.col("url"), F.col("text"), F.col("title")))
    scored = scored.where((F.col("score") > 0) & urls.on_company_site(F.col("url"), root)).groupBy("ticker").agg(F.max_by("url", F.struct("score", -F.col("ord"))).alias("scored"))
    whole = companies.join(probed, "ticker", "left").join(scored, "ticker", "left")
    found = F.when(known, F.col("investor_relations_url")).otherwise(F.coalesce("probed", "scored", "company_website"))
    method = F.when(known, "known").when(F.col("probed").isNotNull(), "candidate").when(F.col("scored").isNotNull(), "link").when(F.col("company_website").isNotNull(), "website").otherwise("none")
    return whole.withColumns({"investor_relations_url": found, "extraction_method": method}).drop("probed", "scored")


def investor_pages(companies: DataFrame) -> DataFrame:
    """Companies whose investor page is known and isn't the website."""
    return companies.where((F.coalesce("investor_relations_url", F.lit("")) != "") & ~F.col("investor_relations_url").eqNullSafe(F.col("company_website")))


def to_review(companies: DataFrame) -> DataFrame:
    return companies.where((F.coalesce("investor_relations_url", F.lit("")) == "") | F.col("investor_relations_url").eqNullSafe(F.col("company_website")))


def enriched(companies: DataFrame, sites: DataFrame) -> DataFrame:
    """companies with the sites found for them; blanks don't overwrite."""
    found = sites.select("ticker", *(F.nullif(F.col(c), F.lit("")).alias("_" + c) for c in ("company_website", "investor_relations_url")))
    whole = companies.join(found, "ticker", "left")
    for c in ("company_website", "investor_relations_url"):
        whole = whole.withColumn(c, F.coalesce("_" + c, *([c] if c in companies.columns else []))).drop("_" + c)
    return whole


def first_reachable(probes: DataFrame, pages: DataFrame) -> DataFrame:
    """Of each ticker the first probe whose page is stored and speaks of investors."""
    there = pages.where(is_investor_page(F.col("html"))).select("url").distinct()
    return probes.join(there, "url", "left_semi").withColumn("k", F.row_number().over(Window.partitionBy("ticker").orderBy("ord"))).where("k = 1").drop("k")
