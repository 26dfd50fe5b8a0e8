"""One row or a few rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls
from ..functions.text import any_in, let
from .filters import ranked


def latest_per_type(df: DataFrame, group: tuple[str, ...] = ("ticker", "document_type"), year: str = "extracted_year", quarter: str = "extracted_quarter", score: str = "relevance_score") -> DataFrame:
    """Of each group the latest row (pass only the columns that are wanted: all of them travel): dated rows first, by year, quarter (none is lowest) and score; undated ones and ties by ord."""
    dated = F.col(year).isNotNull()
    key = F.max_by(F.struct(*df.columns), F.struct(dated, F.coalesce(F.col(year), F.lit(0)), F.when(dated, F.coalesce(F.col(quarter), F.lit(-1))).otherwise(-1), F.when(dated, F.col(score)).otherwise(0), -F.col("ord")))
    return df.groupBy(*group).agg(key.alias("_x")).select("_x.*")


def latest_quarterly(df: DataFrame, group: tuple[str, ...] = ("ticker",), year: str = "extracted_year", quarter: str = "extracted_quarter", score: str = "relevance_score") -> DataFrame:
    """Of each group the latest quarterly report: rows with a quarter first, by year, quarter, type and score; ties by ord."""
    order = F.element_at(F.create_map(*(F.lit(x) for pair in R.QUARTERLY_PRIORITY for x in pair)), F.col("document_type"))
    df = df.withColumn("__order", order)  # null for other types; a filter would take the type's long rule into the scan
    key = F.struct(F.col(quarter).isNotNull(), F.coalesce(F.col(year), F.lit(0)), F.coalesce(F.col(quarter), F.lit(0)), -F.col("__order"), F.col(score), -F.col("ord"))
    best = df.groupBy(*group).agg(F.max_by(F.struct(*df.drop("__order").columns), F.when(F.col("__order").isNotNull(), key)).alias("_x"))
    return best.where(F.col("_x").isNotNull()).select("_x.*")


def first_seen(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """The first row of each key, by the order columns: one owner of each address over all pages and companies."""
    names = df.columns
    return df.withColumn("_key", key).groupBy("_key").agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_x")).select("_x.*")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("_x")).select("_x.*")


def batches(df: DataFrame, size: int, ordinal: str = "ord") -> DataFrame:
    """Batch number of each row, by its ordinal from 0."""
    return df.withColumn("batch", F.floor(F.col(ordinal) / size).cast("int"))


def sliced(df: DataFrame, start: int = 0, end: int | None = None, ordinal: str = "ord") -> DataFrame:
    return df.where((F.col(ordinal) >= start) & (F.lit(True) if end is None else F.col(ordinal) < end))


def per_group(df: DataFrame, group: str, groups: int, rows: int, *order: str) -> DataFrame:
    """The first rows of the first groups."""
    firsts = df.select(group).distinct().orderBy(group).limit(groups)
    return ranked(df.join(F.broadcast(firsts), group, "left_semi"), [group], *(F.asc(c) for c in order), most=rows)


def absent(df: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those of `there`: files to fetch, addresses to visit."""
    return df.join(there.select(key).distinct(), key, "left_anti")


def present(df: DataFrame, there: DataFrame, key: str) -> DataFrame:
    return df.join(there.select(key).distinct(), key, "left_semi")


def regrouped(df: DataFrame, key: str, *columns: str, ordinal: str = "ord") -> DataFrame:
    """A row for each key with its rows in order."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(ordinal, *columns))), lambda x: F.struct(*(x[c].alias(c) for c in columns))).alias("rows"))


def without_empty(df: DataFrame, companies: DataFrame) -> DataFrame:
    """companies with the rows that belong to them; none gives an empty array."""
    return companies.join(df, "ticker", "left").withColumn("rows", F.coalesce("rows", F.array()))


def distinct_companies(df: DataFrame, *keys: str, ordinal: str = "ord") -> DataFrame:
    """The first row of each key; rows whose first key is empty go."""
    kept = df.where(F.coalesce(F.col(keys[0]), F.lit("")) != "")
    return kept.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.col(ordinal)).alias("_x")).select("_x.*")


def path_search(edges: DataFrame, starts: DataFrame, depth: int = 3, branch: int = 3) -> DataFrame:
    """Paths from starts (node) along the best `branch` edges (src, dst, score, ord) of each node: a score of 4 or more ends
    a path and emits it, 2 or 3 goes on, up to `depth` edges and never back to a node of the path. confidence is the last score."""
    best = ranked(edges.where("score > 0"), ["src"], F.desc("score"), F.asc("ord"), most=branch).select("src", "dst", "score")
    at = starts.select(F.col("node"), F.array("node").alias("path"))
    out = None
    for _ in range(depth):
        step = at.join(best, F.col("node") == F.col("src")).where(~F.array_contains("path", F.col("dst"))).select(F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path"), "score")
        found = step.where("score >= 4").select("path", F.col("score").alias("confidence"))
        out = found if out is None else out.unionByName(found)
        at = step.where("score between 2 and 3").select("node", "path")
    return out


def link_value(url: Column, text: Column, company: Column, ticker: Column) -> Column:
    """How much following a link is worth on the way to a company's investor page."""
    return let(F.struct(F.lower(url).alias("u"), F.lower(text).alias("t")), lambda x: _link_value(x["u"], x["t"], (F.lower(company), F.lower(ticker))))


def _link_value(u: Column, t: Column, names: tuple[Column, Column]) -> Column:
    def either(words):
        return any_in(u, words) | any_in(t, words)

    own = u.contains(names[0]) | u.contains(names[1])
    investor = either(["investor", "ir/", "investors", "investor-relations", "stockholder"])
    score = F.when(investor, F.when(own, 4.0).otherwise(2.0)).otherwise(0.0) + F.when(own, 1.0).otherwise(0.0)
    score = score + F.when(either(["about", "corporate", "company", "finance"]), 0.5).otherwise(0.0) - F.when(either(["products", "shop", "cart", "login", "careers", "news"]), 1.0).otherwise(0.0)
    return F.greatest(F.lit(0.0), score)


def search_score(url: Column, text: Column, company: Column, ticker: Column) -> Column:
    """Score of a link for the path search."""
    lows = F.struct(F.lower(url).alias("u"), F.lower(text).alias("t"), url.alias("url"), text.alias("text"))
    return let(lows, lambda x: _search_score(x["u"], x["t"], x["url"], x["text"], company, ticker))


def _search_score(u: Column, t: Column, url: Column, text: Column, company: Column, ticker: Column) -> Column:
    score = F.lit(0)
    for w in ["investor", "investors", "ir", "shareholders", "financials", "stock"]:
        score = score + F.when(u.contains(w), 3).otherwise(0) + F.when(t.contains(w), 2).otherwise(0)
    for w in ["about", "company", "corporate", "menu", "navigation"]:
        score = score + F.when(u.contains(w) | t.contains(w), 1).otherwise(0)
    name, low, up = F.lower(company), F.lower(ticker), F.upper(ticker)
    score = score + F.when(u.contains(name) | t.contains(name), 1).otherwise(0)
    score = score + F.when(url.contains(up) | text.contains(up), 2).otherwise(0) + F.when(u.contains(low) | t.contains(low), 2).otherwise(0)
    for p in (F.concat(F.lit("stock/"), ticker), F.concat(F.lit("quote/"), ticker), F.lit("nyse:"), F.lit("nasdaq:"), F.concat(low, F.lit("-stock")), F.concat(up, F.lit("-stock"))):
        score = score + F.when(u.contains(p), 2).otherwise(0)
    return score


def owner_of_address(df: DataFrame) -> DataFrame:
    """Direct files, each under the first company, page and link that names it."""
    return first_seen(df.where(urls.is_direct_file(F.col("url"))), urls.without_query(F.col("url")), "company_ord", "page_ord", "ord")
