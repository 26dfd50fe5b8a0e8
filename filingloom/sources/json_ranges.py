"""Records of one large JSON text, read by many tasks.

The file is read in byte ranges, split further at each `}`; no range has to begin where a record does. What a piece does to
the state "within a string" is the parity of its quotes (but escaped ones), so the state at its start is a sum over the
pieces before it: first over whole ranges, a few numbers each, then within a range. With that known, a piece's brackets
outside of strings give its change of depth, and the depth at its start is a sum in the same way. A piece that comes back to
the wanted depth ends a record, and the number of such ends before a piece is the number of its record, whatever range it
was read in; the pieces of a record are put together by that number.

`depth` is that of the container whose objects are wanted: 1 for the objects of a list, 2 for those of the lists of an
object, and so on. Objects count that stand in a list; other values don't. Each comes with its number in the file, the keys
that lead to it (one a level, empty for a list's), and its text. What is broadcast has a row a range or a run of records.
A record is put together in one row with what stands between it and the record before; text after the last record is left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stage import saved

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]', re.S)
#: Records that are put in order together where keys are carried on.
RUN = 100_000


def _count(text: Column, of: str) -> Column:
    return F.length(text) - F.length(F.translate(text, of, ""))


def pieces(spark: SparkSession, path: str, together: bool = False) -> DataFrame:
    """file, at (the file and place where the piece's range begins), k (its place in the range), value (its text, without
    the `}` at its end), quotes, and turn0, turn1: the change of depth before its end if it begins outside of strings, or
    within one. together: the files of a folder, in the order of their names, are one text."""
    file = F.col("_metadata.file_path")
    raw = spark.read.option("lineSep", "}").text(path).select("value", file.alias("part"), F.struct(file.alias("file"), F.col("_metadata.file_block_start").alias("start")).alias("at"), F.monotonically_increasing_id().alias("k"))
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    cut = raw.withColumn("parts", F.split(plain, '"')).withColumn("file", F.lit("") if together else F.col("part"))

    def turn(start: int) -> Column:
        outside = F.array_join(F.filter("parts", lambda _, i: i % 2 == start), "")
        return _count(outside, "{[") - _count(outside, "]")

    return cut.select("file", "at", "k", "value", (F.size("parts") - 1).alias("quotes"), turn(0).alias("turn0"), turn(1).alias("turn1"))


def _before(sums: DataFrame, *names: str) -> DataFrame:
    """sums (file, at, names, others): a row a range; each named sum over the ranges before instead."""
    order = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumns({f"{n}_before": F.coalesce(F.sum(n).over(order), F.lit(0)) for n in names}).drop(*names)


def _states(spark: SparkSession, path: str, depth: int, together: bool) -> DataFrame:
    """The pieces, each with the `}` that it ends in, level (the depth at their start) and ends (whether the piece ends a
    record)."""
    read = pieces(spark, path, together)
    sums = read.groupBy("file", "at").agg(F.sum("quotes").alias("quotes"), F.max("k").alias("last"))
    # what is left of a part after its last `}` has none at its end
    final = F.row_number().over(Window.partitionBy("at.file").orderBy(F.desc("at.start"))) == 1
    quotes = saved(_before(sums.withColumn("last", F.when(final, F.col("last"))), "quotes"))
    own = Window.partitionBy("file", "at").orderBy("k")
    upto, past = own.rowsBetween(Window.unboundedPreceding, Window.currentRow), own.rowsBetween(Window.unboundedPreceding, -1)

    def turned(df: DataFrame) -> DataFrame:
        within = (F.col("quotes_before") + F.coalesce(F.sum("quotes").over(past), F.lit(0))) % 2
        state = df.join(F.broadcast(quotes), ["file", "at"]).withColumn("within", within)
        closes = ((F.col("within") + F.col("quotes")) % 2 == 0) & ~F.col("k").eqNullSafe(F.col("last"))
        return state.withColumn("closes", closes).withColumn("turn", F.when(F.col("within") == 0, F.col("turn0")).otherwise(F.col("turn1")) - F.col("closes").cast("int"))

    depths = saved(_before(turned(read.drop("value")).groupBy("file", "at").agg(F.sum("turn").alias("turn")), "turn"))
    state = turned(read).join(F.broadcast(depths), ["file", "at"]).withColumn("after", F.col("turn_before") + F.sum("turn").over(upto))
    text = F.concat("value", F.when(F.col("k").eqNullSafe(F.col("last")), "").otherwise("}"))
    return state.select("file", "at", "k", text.alias("value"), (F.col("after") - F.col("turn")).alias("level"), (F.col("closes") & (F.col("after") == depth)).alias("ends"))


def _opening(text: str, level: int, depth: int) -> tuple[int, list[str | None], bool]:
    """Where the object at `depth` begins in the text of a record, the keys that are set on the way (one for each level
    below depth), and whether it stands in a list."""
    keys: list[str | None] = [None] * depth
    key, before, brackets = None, "," if level == depth else "", []
    for m in _TOKEN.finditer(text):
        t = m[0]
        if t[0] == '"':
            key = t
        elif t in "{[":
            if t == "{" and level == depth:
                return m.start(), keys, before in ",["
            if level < depth:
                keys[level] = key if before == ":" else ""
                keys[level + 1 :] = [""] * (depth - level - 1)
            brackets.append(t)
            level += 1
        elif t in "}]":
            level -= 1
        before = t if t[0] != '"' else before
    return -1, keys, False


def objects(spark: SparkSession, path: str, depth: int = 1, together: bool = False) -> DataFrame:
    """file, ord (from 0, over the objects of the file), first (the ord at which the last of the keys began), keys (array of
    the quoted keys of the levels above, the outermost first; a list's values and the whole text have empty ones), value."""
    state = _states(spark, path, depth, together)
    sums = state.groupBy("file", "at").agg(F.count_if("ends").alias("ended"))
    ended = saved(_before(sums.withColumn("records", F.sum("ended").over(Window.partitionBy("file"))), "ended"))
    own = Window.partitionBy("file", "at").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    numbered = state.join(F.broadcast(ended), ["file", "at"]).withColumn("record", F.col("ended_before") + F.coalesce(F.count_if("ends").over(own), F.lit(0)))
    numbered = numbered.where(F.col("record") < F.col("records"))  # what follows the last record, however long, belongs to none
    parts = F.array_sort(F.collect_list(F.struct("at", "k", "value", "level")))
    whole = numbered.groupBy("file", "record").agg(parts.alias("p"))
    joined = whole.select("file", "record", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("text"), F.get("p", F.lit(0))["level"].cast("int").alias("level"))

    def located(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            found = [_opening(t, level, depth) for t, level in zip(texts, b.column("level").to_pylist(), strict=True)]
            yield pa.record_batch([b.column("file"), b.column("record"), pa.array([k for _, k, _ in found], pa.list_(pa.string())), pa.array([t[at:] if own else None for t, (at, _, own) in zip(texts, found, strict=True)], pa.string())], names=["file", "record", "keys", "value"])

    return _carried(saved(joined.mapInArrow(located, "file string, record long, keys array<string>, value string")), depth)


def _carried(rows: DataFrame, depth: int) -> DataFrame:
    """Keys that a record doesn't set are those of the record before; objects outside of lists go, and the rest is numbered."""
    names = [f"k{i}" for i in range(depth)]
    own = Window.partitionBy("file", "run").orderBy("record").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flat = rows.select("file", "record", F.floor(F.col("record") / RUN).alias("run"), "value", *(F.get("keys", F.lit(i)).alias(c) for i, c in enumerate(names)))
    flat = flat.withColumn("n", F.count("value").over(own)).withColumn("first", F.when(F.col(names[-1]).isNotNull(), F.col("n") - F.col("value").isNotNull().cast("int")))
    kept = [*names, "first"]
    sums = flat.groupBy("file", "run").agg(F.count("value").alias("n"), *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("record"))).alias(c) for c in kept))
    past = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.withColumn("n_before", F.coalesce(F.sum("n").over(past), F.lit(0))).withColumn("first", F.col("first") + F.col("n_before"))
    known = saved(known.select("file", "run", "n_before", *(F.last(c, ignorenulls=True).over(past).alias(f"{c}_before") for c in kept)))
    whole = flat.join(F.broadcast(known), ["file", "run"]).withColumn("first", F.col("first") + F.col("n_before"))
    whole = whole.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(own), F.col(f"{c}_before")) for c in kept})
    return whole.where(F.col("value").isNotNull()).select("file", (F.col("n_before") + F.col("n") - 1).alias("ord"), "first", F.array(*names).alias("keys"), "value")


def key_text(key: Column) -> Column:
    """A quoted key as text."""
    return F.from_json(F.concat(F.lit('{"k":'), key, F.lit("}")), "k string")["k"]
