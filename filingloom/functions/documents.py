"""What a document's address, title and text say: type, date, year, quarter, names, amounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from . import urls
from .text import first_class, joined, squeezed, with_class

def _other_type(url: Column) -> Column:
    return F.when(url.contains(".pdf"), "PDF Document").otherwise("Financial Document")


def document_type(url: Column, text: Column, title: Column) -> Column:
    return first_class(joined(url, text, title), R.DOCUMENT_TYPES, _other_type(url))


def with_document_type(df: DataFrame, name: str, url: Column, text: Column, title: Column) -> DataFrame:
    return with_class(df, name, joined(url, text, title), R.DOCUMENT_TYPES, _other_type(url))


def file_name_type(name: Column) -> Column:
    return first_class(F.lower(name), R.FILE_NAME_TYPES, R.OTHER_FILE)


def name_from_url(url: Column) -> Column:
    name = F.element_at(F.split(urls.unquoted(urls.path(url)), "/"), -1)
    name = F.regexp_replace(F.regexp_replace(name, "[-_]", " "), r"(?i)\.(pdf|xlsx?|pptx?|docx?)$", "")
    name = squeezed(F.regexp_replace(name, r"(?i)\b[a-f0-9]{32,}\b", ""))
    return F.when(name == "", "Financial Document").otherwise(name)


def date_text(text: Column) -> Column:
    """The text that the first of the date patterns, in their order, matches."""
    return F.coalesce(*(F.regexp_substr(text, F.lit("(?i)" + p)) for p in R.DATE_PATTERNS))


def _cleaned(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "(?i)" + R.HEX_NAME, ""), "(?i)" + R.HEX_WORD, "")


def _fiscal(clean: Column, as_of: int) -> Column:
    digits = F.regexp_extract(clean, "(?i)" + R.FISCAL_YEAR, 1)
    year = F.when(F.length(digits) == 2, digits.try_cast("int") + 2000).when(F.length(digits) == 4, digits.try_cast("int"))
    return F.when(year.between(2020, as_of + 2), year)


def _around(clean: Column, at: Column) -> Column:
    start = F.greatest(at - 10, F.lit(1))
    return F.substr(clean, start, at + 14 - start)


def _year(clean: Column, at: Column, around: Column, as_of: int) -> Column:
    letters = F.length(around) - F.length(F.regexp_replace(around, "(?i)[a-f]", ""))
    number = F.when(at > 0, F.substr(clean, at, F.lit(4)).try_cast("int"))
    ok = number.between(2015, as_of) & (letters * 10 <= F.length(around) * 4)  # at most four tenths
    return F.coalesce(F.when(ok, number), _fiscal(clean, as_of))


def year(text: Column, as_of: int) -> Column:
    """The first 201x or 202x outside hexadecimal names if it is from 2015 to as_of and not amid hexadecimal letters,
    else a fiscal year from 2020 to as_of + 2."""
    clean = _cleaned(text)
    at = F.regexp_instr(clean, F.lit(R.FULL_YEAR))
    return _year(clean, at, _around(clean, at), as_of)


def with_year(df: DataFrame, name: str, text: Column, as_of: int) -> DataFrame:
    """df with year() as a column, in steps: each is computed once, as generated code."""
    clean, at, around = (F.col(c) for c in ("__clean", "__at", "__around"))
    df = df.withColumn("__clean", _cleaned(text)).withColumn("__at", F.regexp_instr(clean, F.lit(R.FULL_YEAR))).withColumn("__around", _around(clean, at))
    return df.withColumn(name, _year(clean, at, around, as_of)).drop("__clean", "__at", "__around")


def year_extended(text: Column, as_of: int, guarded: bool = True) -> Column:
    """`year`, then a year between slashes, between separators, in a filing number, and a short year. Not guarded: the
    first two without the clean-up and the check of letters around, from 2020 on."""
    clean = _cleaned(text) if guarded else text
    first = year(text, as_of) if guarded else F.coalesce(_within(_digits(clean, f"({R.FULL_YEAR})"), as_of), _fiscal(text, as_of))
    return F.coalesce(first, _later_year(clean, as_of))


def with_year_extended(df: DataFrame, name: str, text: Column, as_of: int) -> DataFrame:
    """df with year_extended() as a column, in steps."""
    df = with_year(df.withColumn("__whole", text), "__first", F.col("__whole"), as_of).withColumn("__clean", _cleaned(F.col("__whole")))
    return df.withColumn(name, F.coalesce("__first", _later_year(F.col("__clean"), as_of))).drop("__whole", "__first", "__clean")


def _within(c: Column, as_of: int) -> Column:
    return F.when(c.between(2020, as_of + 2), c)


def _digits(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def _later_year(clean: Column, as_of: int) -> Column:
    """The forms that come after a full and a fiscal year."""
    slashes, separators, filing, quarter_first, last = (_digits(clean, p) for p in R.LATER_YEARS)
    short = F.coalesce(quarter_first, last)
    found = (slashes, separators, filing + 2000, F.when(short.between(15, 30), short + 2000))
    return F.coalesce(*(_within(x, as_of) for x in found))


def quarter(text: Column) -> Column:
    return F.regexp_extract(text, "(?i)" + R.QUARTER, 1).try_cast("int")


def file_year(name: Column) -> Column:
    return F.regexp_extract(name, r"20(\d{2})", 1).try_cast("int") + 2000


def file_quarter(name: Column) -> Column:
    return F.regexp_extract(name, "[Qq]([1-4])", 1).try_cast("int")


def _tidy_name(name: Column) -> Column:
    return squeezed(F.regexp_replace(F.translate(name, '<>:"/\\|?*', "_" * 9), r"^[. ]+|[. ]+$", ""))


def _cut_name(clean: Column, longest: int) -> Column:
    suffix = F.regexp_extract(clean, r"^.*[^.].*(\.[^.]*)$", 1)
    cut = F.concat(F.substr(clean, F.lit(1), F.lit(longest) - F.length(suffix)), suffix)
    return F.when(clean == "", "document").when(F.length(clean) > longest, cut).otherwise(clean)


def safe_name(name: Column, longest: int = 150) -> Column:
    """A file name: reserved characters to `_`, no dots or blanks at the ends, blanks squeezed, cut before its suffix."""
    return _cut_name(_tidy_name(name), longest)


def safe_company(name: Column) -> Column:
    clean = squeezed(F.regexp_replace(F.translate(name, "/\\", "__"), r"(?U)[^\p{Alnum} .\-_&]", ""))
    return F.when(clean == "", "Unknown_Company").otherwise(clean)


def with_target_name(df: DataFrame, name: str, kind: Column, title: Column, year_: Column, quarter_: Column, suffix: Column, longest: int = 150) -> DataFrame:
    """df with the name that a downloaded document gets, in steps."""
    at = {c: F.col(c) for c in ("__short", "__title", "__named", "__full", "__tidy")}
    dated = F.when(year_.isNull() | (year_ == 0), None).when(quarter_.isNull() | (quarter_ == 0), year_.cast("string")).otherwise(F.concat(year_.cast("string"), F.lit("_Q"), quarter_.cast("string")))
    df = df.withColumn("__short", _tidy_name(F.substring(title, 1, 50))).withColumn("__title", _cut_name(at["__short"], longest))
    df = df.withColumn("__named", F.concat_ws(" - ", kind, dated, F.when((F.length(title) > 10) & ~kind.contains(at["__title"]), at["__title"])))
    df = df.withColumn("__full", F.when(at["__named"].endswith(suffix), at["__named"]).otherwise(F.concat(at["__named"], suffix))).withColumn("__tidy", _tidy_name(at["__full"]))
    return df.withColumn(name, _cut_name(at["__tidy"], longest)).drop(*at)


def amount(text: Column, names: list[str]) -> Column:
    """The number after the first of the names that one follows, as text."""
    found = [F.nullif(F.regexp_extract(text, "(?i)" + n + R.AMOUNT, 1), F.lit("")) for n in names]
    return reduce(lambda a, b: F.coalesce(a, b), found)


def revenue(text: Column) -> Column:
    return amount(text, R.REVENUE_NAMES)


def profit(text: Column) -> Column:
    return amount(text, R.PROFIT_NAMES)


def bracketed_ticker(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, R.BRACKETED_TICKER, 1), F.lit(""))


def without_ticker(text: Column) -> Column:
    """A company's name without a ticker in brackets."""
    return F.trim(F.regexp_replace(text, R.BRACKETED_TICKER, ""))


def result_bucket(kind: Column) -> Column:
    """The bucket of a crawl's result by its type."""
    up = F.upper(kind)
    return F.when(up.isin("VIDEO", "IMAGE", "MEDIA"), "media").when(~up.isin("PDF", "DOC", "DOCX", "XLS", "XLSX", "PPT", "PPTX", "CSV", "DOCUMENT") & (up.contains("PRESS_RELEASE") | up.contains("NEWS")), "press_releases").otherwise("documents")
