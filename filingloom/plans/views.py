"""Views that give the tables the vocabulary which the operators read. Each is one SELECT that Spark and other SQL engines
read alike: a list of (column, expression) and a FROM clause."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stage import spread

AS_OF = 2025
TITLES = [
    "Form 10-K Annual Filing", "10-Q Quarterly Report", "8-K Current Report", "Proxy Statement", "Earnings Release", "CFO Commentary", "Webcast Audio", "Call Transcript", "Investor Presentation", "Quarterly Revenue Trend",
    "Supplemental Data", "Annual Report", "Data Workbook", "Fact Sheet",
]
_SEGMENT = "lower(c_mktsegment)"
_KEY = "CAST(o_orderkey AS STRING)"


def _case(key: str, n: int, values: list[str], quoted: bool = True) -> str:
    return f"CASE {key} % {n} " + " ".join(f"WHEN {i} THEN " + (f"'{v}'" if quoted else v) for i, v in enumerate(values)) + " END"


_TITLE = "concat(" + ", ".join([
    _case("o_orderkey", 14, TITLES),
    "CASE WHEN o_orderkey % 5 < 3 THEN concat(' Q', CAST(o_orderkey % 4 + 1 AS STRING)) ELSE '' END",
    "CASE WHEN o_orderkey % 7 < 5 THEN concat(' ', CAST(year(o_orderdate) + 20 AS STRING)) WHEN o_orderkey % 7 = 5 THEN ' FY24' ELSE '' END",
    "CASE WHEN o_orderkey % 11 = 0 THEN ' ref 20240131' WHEN o_orderkey % 11 = 1 THEN ' (draft/final)' ELSE '' END",
]) + ")"
_EXT = _case("o_orderkey", 6, [".pdf", ".xlsx", ".pptx", ".mp3", "", ".PDF"])
_QUERY = "CASE WHEN o_orderkey % 8 = 0 THEN '?b=2&a=1&c=' WHEN o_orderkey % 8 = 1 THEN '#page-2' WHEN o_orderkey % 8 = 2 THEN '?x=1&x=0' ELSE '' END"
_LINK = _case("o_orderkey", 16, [
    f"concat('https://ir.', {_SEGMENT}, '.com/')", f"concat('https://www.', {_SEGMENT}, '.com/investor-relations')", f"concat('https://www.', {_SEGMENT}, '.com/first')", f"concat('HTTPS://WWW.', {_SEGMENT}, '.com/financial/reports/', {_KEY}, '/')",
    f"concat('https://www.', {_SEGMENT}, '.com/login?next=', {_KEY})", "'https://www.cnbc.com/quotes/ab?tab=news'", f"concat('https://www.', {_SEGMENT}, '.com/docs/10-k.pdf?v=', {_KEY})", f"concat('https://www.', {_SEGMENT}, '.com/news/press')",
    f"concat('https://www.', {_SEGMENT}, '.com/earnings')", f"concat('https://www.', {_SEGMENT}, '.com/newsletter/data')", f"concat('https://shop.', {_SEGMENT}, '.com/iphone')", f"concat('https://s2.q4cdn.com/', {_KEY}, '/files/doc_a')",
    f"concat('https://www.', {_SEGMENT}, '.com/a/b/c/statistics')", "'https://www.cnbc.com/symbol/TOOLONG/'", f"concat('https://investor.', {_SEGMENT}, '.com/sec-filings')", "'mailto:someone@example.com'",
], quoted=False)
_TEXT = _case("o_orderkey", 10, ["Investor Relations", "Annual Report", "Contact us", "Quarterly earnings presentation", "Stock information", "Press", "Download PDF", "Financial data table", "First aid", "SEC Filings"])

_PART = "CAST(p_partkey AS STRING)"
#: A part's own page: its words in meta tags, headings, a paragraph, tables, images and links to files.
_PAGE = "concat(" + ", ".join([
    "'<html><head><title>', p_name, '</title><meta name=\"description\" content=\"', p_type, ' ', p_brand, '\"><meta property=\"og:title\" content=\"', p_name, '\"><meta name=\"theme\" content=\"none\">'",
    "CASE WHEN p_partkey % 2 = 0 THEN concat('<meta name=\"description\" content=\"later ', p_name, '\">') ELSE '' END",
    "'</head><body><nav><a href=\"/home\">Home</a></nav><main><h1>', p_name, '</h1><p>All there is to say of <b>', p_name, '</b> by ', p_brand, '</p><p>', p_type, '</p>'",
    f"'<table><thead><tr><th>Name</th><th>Brand</th></tr></thead><tbody>', repeat(concat('<tr><td><a href=\"/quotes/', {_PART}, '\">', p_name, '</a></td><td> ', p_brand, ' </td></tr>'), CAST(p_partkey % 4 AS INT)), '</tbody><tfoot><tr><td>Sum</td><td>', {_PART}, '</td></tr></tfoot></table>'",
    "CASE WHEN p_partkey % 3 = 0 THEN concat('<table><tr><th>Type</th></tr><tr><td>', p_type, '</td></tr></table>') ELSE '' END",
    f"repeat(concat('<img src=\"i/', {_PART}, '.png\" alt=\"', p_name, '\" title=\"', p_brand, '\">'), CAST(p_partkey % 25 AS INT))",
    f"'<a href=\"/files/', {_PART}, '.pdf\">Report on ', p_name, '</a><a href=\"data/', {_PART}, '.CSV\">Data</a><a href=\"/files/', {_PART}, '.pdf?v=1\">Other</a><a href=\"https://other.example.org/\">Out</a><a href=\"mailto:a@example.org\">Mail</a></main></body></html>'",
]) + ")"

#: name -> (columns, FROM clause)
VIEWS: dict[str, tuple[list[tuple[str, str]], str]] = {
    "v_docs": ([
        ("ord", "o_orderkey"), ("company_ord", "c_custkey"), ("page_ord", "o_orderkey % 3"), ("ticker", "concat('C', CAST(c_custkey AS STRING))"), ("company_name", "c_name"), ("title", _TITLE),
        ("url", f"concat('https://investor.', {_SEGMENT}, '.com/', CASE WHEN o_orderkey % 10 = 7 THEN 'shared' ELSE {_KEY} END, '/doc_', CAST(o_orderkey % 50 AS STRING), {_EXT}, {_QUERY})"), ("relevance_score", "CAST(o_orderkey % 101 AS DOUBLE)"),
    ], "orders JOIN customer ON o_custkey = c_custkey"),
    "v_links": ([
        ("page_id", "o_custkey"), ("ord", "o_orderkey"), ("category", _case("o_orderkey", 3, ["internal", "external", "navigation"])), ("url", _LINK), ("text", _TEXT), ("title", "CASE WHEN o_orderkey % 4 = 0 THEN 'Investors' ELSE '' END"),
        ("ticker", "concat('C', CAST(c_custkey AS STRING))"), ("company_name", f"concat(upper({_SEGMENT}), ' Group, Inc.')"),
    ], "orders JOIN customer ON o_custkey = c_custkey"),
    "v_company": ([
        ("ticker", "concat('S', CAST(s_suppkey AS STRING))"), ("company_name", "concat(n_name, ' & Co./', s_name)"), ("company_website", "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat('https://www.', lower(replace(n_name, ' ', '')), '.com') END"),
        ("investor_relations_url", "CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('https://www.', lower(replace(n_name, ' ', '')), '.com') ELSE concat('https://investor.', lower(replace(n_name, ' ', '')), '.com/') END"),
    ], "supplier JOIN nation ON s_nationkey = n_nationkey"),
    "v_metrics": ([
        ("ord", "(l_orderkey * 10 + l_linenumber) * 100000000 + l_partkey * 1000 + l_suppkey"), ("text", "concat(" + _case("l_orderkey", 6, ["Total revenue: $", "Net income $", "Revenue ", "Earnings: ", "revenue, which grew, profit ", "Nothing about "]) + ", CAST(CAST(l_quantity AS BIGINT) AS STRING), ',500.25 million. ', " + _case("l_linenumber", 4, ["Profit 7.5", "net income: $1,234", "EARNINGS 9", "end"]) + ")"),
    ], "lineitem"),
    "v_files": ([
        ("file_name", "concat(" + _case("p_partkey", 7, ["Form_10-K_", "quarterly-", "Proxy ", "press_", "Presentation Q", "other_", "10-q_"]) + ", CASE WHEN p_partkey % 3 = 0 THEN '2023' ELSE '' END, '_Q', CAST(p_partkey % 6 AS STRING), '.pdf')"),
        ("ticker", "concat('P', CAST(p_partkey % 40 AS STRING))"), ("size_mb", "CAST(p_size AS DOUBLE) / 8"), ("ord", "p_partkey"), ("status", _case("p_partkey", 5, ["downloaded", "failed", "skipped", "downloaded", "downloaded"])),
    ], "part"),
    "v_intents": ([
        ("ord", "p_partkey"), ("intent", "concat(" + _case("p_partkey", 8, ["Find the investor relations page", "Download annual report documents", "Extract financial data tables", "Collect 10-K and 10-Q filings", "Get earnings transcript", "Read page", "locate news article, then summarize, and parse, text", "contact information"]) + ", ' for ', lower(p_brand))"),
    ], "part"),
    "v_wrapped": ([
        ("page_id", "p_partkey + 1000000000"), ("part_key", "p_partkey"), ("name", "p_name"), ("brand", "p_brand"), ("type", "p_type"), ("origin", "concat('https://shop', CAST(p_size % 5 AS STRING), '.example.com')"),
        ("url", f"concat('https://shop', CAST(p_size % 5 AS STRING), '.example.com/parts/', {_PART}, '/index.html')"), ("html", _PAGE),
    ], "part"),
    "v_edges": ([("src", "l_partkey"), ("dst", "l_suppkey"), ("ord", "l_orderkey * 10 + l_linenumber"), ("score", "CAST(l_quantity AS BIGINT) % 7")], "lineitem"),
}


def view_sql(name: str) -> str:
    columns, source = VIEWS[name]
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns) + " FROM " + source


def view(spark: SparkSession, sf_dir: str, name: str, rows: int | None = None) -> DataFrame:
    """The view over the tables of a folder; rows: what is read is spread over tasks of so many rows."""
    columns, source = VIEWS[name]
    tables = source.partition(" WHERE ")
    names = [w for w in tables[0].replace(" JOIN ", " ").split() if w in ("orders", "customer", "supplier", "nation", "lineitem", "part")]
    df = spark.read.parquet(f"{sf_dir}/{names[0]}.parquet")
    if len(names) == 2:
        df = df.join(spark.read.parquet(f"{sf_dir}/{names[1]}.parquet"), F.expr(tables[0].split(" ON ")[1]))
    if tables[2]:
        df = df.where(tables[2])
    if rows:
        df = spread(df, rows)
    return df.select(*(F.expr(e).alias(c) for c, e in columns))
