"""URL functions. Built-in expressions, but for exact reference resolution (`resolve`, an Arrow UDF)."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import rules as R
from .text import any_in, first_class, let


def without_query(url: Column) -> Column:
    """The URL up to `?` or `#`; case and trailing slash stay."""
    return F.regexp_replace(url, "[?#].*$", "")


def host(url: Column) -> Column:
    """Lower-case authority with port; empty if there is none."""
    return F.lower(F.regexp_extract(url, "^[^:/?#]+://([^/?#]*)", 1))


def bare_host(url: Column) -> Column:
    """Host after http(s)://, without www."""
    return F.regexp_extract(url, r"https?://(?:www\.)?([^/]+)", 1)


def root_domain(full: Column) -> Column:
    """The last two labels of a host."""
    return F.regexp_extract(full, r"([^.]*\.)?[^.]*$", 0)


def path(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)


def path_depth(url: Column) -> Column:
    return F.size(F.filter(F.split(path(F.lower(url)), "/"), lambda p: p != ""))


def decoded(text: Column) -> Column:
    """Percent escapes resolved and `+` as a blank; what is no valid escape stays as it is."""
    return F.coalesce(F.try_url_decode(text), text)


def unquoted(text: Column) -> Column:
    """As decoded, but `+` stays."""
    return decoded(F.replace(text, F.lit("+"), F.lit("%2B")))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, path without trailing slashes (`/` if empty), parameters sorted by name with blank
    ones dropped and values re-encoded, no fragment. A parameter's values keep their order. An address without host, or
    without scheme, gets none."""
    scheme = F.lower(F.regexp_extract(url, "^([^:/?#]+:)", 1))
    start = F.concat(scheme, F.when(url.rlike("^[^:/?#]+://"), F.concat(F.lit("//"), host(url))).otherwise(""))
    place = F.regexp_replace(path(url), "/+$", "")
    place = F.when(place == "", "/").otherwise(place)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.+"))
    keyed = F.transform(pairs, lambda p, i: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), i.alias("i"), decoded(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))
    text = F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")
    return F.concat(start, place, F.when(text == "", "").otherwise(F.concat(F.lit("?"), text)))


def prefixed(href: Column, origin: str) -> Column:
    """An index page's link made absolute by its first characters."""
    return F.when(href.startswith("http"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(F.lit(origin), href)).otherwise(F.concat(F.lit(origin + "/"), href))


def sanitized(href: Column, domain: str) -> Column:
    return F.when(href.startswith("http"), href).when(href.contains(domain), F.concat(F.lit("https:"), href)).otherwise(F.concat(F.lit(f"https://{domain}/"), href))


def appended(company_url: Column, href: Column) -> Column:
    """A relative link joined to a company's URL as text."""
    joined = F.concat(F.rtrim(company_url, F.lit("/")), F.when(href.startswith("/"), href).otherwise(F.concat(F.lit("/"), href)))
    return F.when(href.startswith("http"), href).otherwise(joined)


@F.pandas_udf(StringType())
def resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    """The reference resolved against the page's address (RFC 3986); null if it can't be."""

    def one(b, h):
        try:
            return None if h is None else urljoin(b or "", h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def is_direct_file(url: Column) -> Column:
    low = F.lower(url)
    return any_in(low, R.FILE_EXTENSIONS) | low.rlike("|".join(f"(?:{p})" for p in R.DELIVERY_PATTERNS))


def is_investor_site(url: Column) -> Column:
    low = F.lower(url)
    return ~any_in(low, R.BAD_SITE_WORDS) & any_in(low, R.GOOD_SITE_WORDS)


def on_company_site(url: Column, root: Column) -> Column:
    """Whether a link is on the company's domain, an investor host, or one of the names built from the domain."""
    base = F.substring_index(root, ".", 1)

    def test(low: Column) -> Column:
        ok = low.contains(root) | any_in(low, R.INVESTOR_HOSTS)
        for pattern in R.OTHER_SITES:
            before, after = pattern.split("{base}")
            ok = ok | low.contains(F.concat(F.lit(before), base, F.lit(after)))
        return ok

    return let(F.lower(url), test)


def profile_ticker(url: Column) -> Column:
    """Ticker after /quotes/ or /symbol/, upper case; null if there is none."""
    last = F.when(url.contains("/quotes/"), F.element_at(F.split(url, "/quotes/"), -1)).when(url.contains("/symbol/"), F.element_at(F.split(url, "/symbol/"), -1))
    return F.upper(F.substring_index(F.substring_index(last, "?", 1), "/", 1))


def extension(url: Column) -> Column:
    """The first listed extension that the URL contains, else .unknown."""
    return first_class(F.lower(url), [(e, [e]) for e in R.FILE_EXTENSIONS], ".unknown")


def file_extension(url: Column, mime: Column | None = None) -> Column:
    """The path's suffix of at most 6 characters, else by MIME type, else .bin."""
    name = F.element_at(F.split(unquoted(path(url)), "/"), -1)
    suffix = F.regexp_extract(name, r"^.*[^.].*(\.[^.]*)$", 1)
    kind = F.trim(F.substring_index(mime if mime is not None else F.lit(""), ";", 1))
    by_mime = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in R.MIME_EXTENSIONS for x in pair)), kind), F.lit(".bin"))
    return F.when((suffix != "") & (F.length(suffix) <= 6), F.lower(suffix)).otherwise(F.coalesce(by_mime, F.lit(".bin")))
