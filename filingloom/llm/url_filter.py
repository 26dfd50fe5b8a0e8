"""URL block and allow rules, indexed by each rule's rarest literal token; DataFrame functions only.

A rule is a host and a path; it fits that host and its subdomains if the address's path starts with the rule's path.
The longest fitting rule (host and path together) decides; of equal lengths the smallest text. An address that no rule
fits gets the default verdict.

A rule's literal tokens are its host labels and the path segments that a slash ends; an address that it fits has them
all. Tokens are counted over all addresses, each rule is listed under its rarest one, an address fetches the rules
listed under its own tokens by a join, and only these run their regular expression. The rule index is broadcast if its
rows are few, else the join deals both sides by token; nothing else depends on the number of rules.

Defined cases: a null url, or one without `://`, has an empty host and path and fits no rule. Rows are judged one by
one, so repeats and null ids stay as they are. No rules: all rows get the default. Of rules with the same host and path
the last one given counts, whatever the verdicts. A rule's host is compared without A-Z case; one without a host fits
nothing. Columns of pages are kept; one named host, path, rule or verdict is replaced.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of the rule index that are broadcast; more are joined by a shuffle.
BROADCAST = 200_000
#: Stands between host and path where a rule's pattern runs; neither can hold it.
_END = "?"
_RULES = "rank:long,host:string,path:string,rule:string,verdict:string,pattern:string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def tokens(host: Column, path: Column) -> Column:
    """Literal tokens: `label.` for each host label, `/segment/` for each path segment that a slash ends."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(x, F.lit(".")))
    pieces = F.split(path, "/")
    closed = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 2, F.lit(0))), lambda x: F.concat(F.lit("/"), x, F.lit("/")))
    return F.array_distinct(F.concat(labels, closed))


def pattern(host: str, path: str) -> str:
    """Runs over host, `?` and path: the host or a subdomain, whole, then a path that starts so."""
    return r"(?s)^(?:[^?]*\.)?" + re.escape(host + _END + path)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """The rules as rows that the JVM reads from one literal; of those that fit an address, the lowest rank decides."""
    lowered = str.maketrans(_UPPER, _LOWER)
    last = {(h.translate(lowered), p): v for v, h, p in rules if h}
    order = sorted(last, key=lambda x: (-len(x[0] + x[1]), x[0] + x[1], last[x]))
    rows = [{"rank": k, "host": h, "path": p, "rule": h + p, "verdict": last[h, p], "pattern": pattern(h, p)} for k, (h, p) in enumerate(order)]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{_RULES}>>")))


def rule_index(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """rules (rank, host, path, rule, verdict, pattern) under the token that fewest of the addresses (tokens) have."""
    listed = rules.withColumn("token", F.explode(tokens(F.col("host"), F.col("path"))))
    seen = addresses.select(F.explode("tokens").alias("token")).join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rank = Window.partitionBy("rank").orderBy(F.coalesce("count", F.lit(0)), "token")
    return listed.join(seen, "token", "left").withColumn("k", F.row_number().over(rank)).where("k = 1").select("token", "rank", "rule", "verdict", "pattern")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", most: int = BROADCAST) -> DataFrame:
    """pages with host, path, rule and verdict; rules: (verdict, host, path). most: rules whose index is broadcast."""
    host, path = host_and_path(F.col("url"))
    pages = pages.drop("rule", "verdict").withColumns({"host": host, "path": path})
    address = pages.where("host <> ''").select("host", "path").distinct().withColumn("tokens", tokens(F.col("host"), F.col("path")))
    index = C.cut(rule_index(rule_table(pages.sparkSession, rules), address))
    index = F.broadcast(index) if len(rules) <= most else index
    fetched = address.select("host", "path", F.explode("tokens").alias("token")).join(index, "token")
    fits = fetched.where(F.regexp_like(F.concat("host", F.lit(_END), "path"), F.col("pattern")))
    best = fits.groupBy("host", "path").agg(F.min("rank").alias("__fl_rank")).withColumn("__fl_salt", F.lit(0).cast("long"))
    # rows without host fit nothing, and meet nowhere
    salt = F.when(F.col("host") == "", C.row_key(pages.select(*pages.columns))).otherwise(0)
    chosen = index.select(F.col("rank").alias("__fl_rank"), "rule", "verdict")
    judged = pages.withColumn("__fl_salt", salt).join(best, ["host", "path", "__fl_salt"], "left").join(F.broadcast(chosen) if len(rules) <= most else chosen, "__fl_rank", "left")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(*pages.columns, "rule", "verdict")
