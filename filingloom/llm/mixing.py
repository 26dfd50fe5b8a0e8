"""Mixing sources to target word counts by entropy balancing; DataFrame functions only.

Each document gets a rate of copies from 0 to `most`. Among all rates that meet a source's target, entropy balancing takes
those that stay closest, in relative entropy, to one copy each: rate = exp(lambda * size), an exponential tilt with one
multiplier a source, bounded by `most`. The multipliers solve a convex dual problem; each Newton iteration is one
aggregation over a table of (source, size, documents), kept inside a bracket that is halved when a step leaves it. Rates
become whole copies by systematic rounding from the largest document down within chunks of about `chunk` documents of a
source: the copies so far never differ by one from the rates so far, and a large source is never one task's work.

Targets: `share` of all sizes, dealt by the weights; a source stops at `most` times its size, and the excess is dealt
again until none is above.

Defined cases: a null text has size 0; null sources are one source, the last. Sizes of 0 take nothing. Repeated rows and
null doc_ids are documents of their own. No rows give none. Columns of docs are kept; those named as in RESULT are
replaced. Chunks and order come from a hash of all columns (maps aside), so equal inputs give equal results in whatever
order rows come: only between rows that are equal in all columns is it open which one gets a copy.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Sources whose table is broadcast; more are joined by a shuffle.
BROADCAST = 10_000
_ONE = 1 << 32
RESULT = ("size", "source_size", "target", "rate", "copies", "taken")


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with rank, from 0 in order of source, nulls last; sorted by range, so no task sees them all."""
    table = C.cut(sources.orderBy(F.col("source").asc_nulls_last())).withColumn("part", F.spark_partition_id())
    before = table.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return table.withColumn("k", within).join(before, "part").withColumn("rank", F.col("before") + F.col("k") - 1).drop("part", "k", "before")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sources (source, source_size, documents) with target."""
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = C.cut(_ranked(sources).withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    whole = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        free = F.lit(True) if level is None else F.col("cap") > F.col("weight") * level
        row = table.agg(F.sum(F.when(free, F.col("weight"))).alias("w"), F.coalesce(F.sum(F.when(~free, F.col("cap"))), F.lit(0.0)).alias("full")).first()
        now = (whole - row["full"]) / row["w"] if row["w"] else level or 0.0
        if now == level:
            break
        level = now
    return table.withColumn("target", F.least("cap", F.col("weight") * level)).drop("rank", "weight")


def _tilts(sizes: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """s (source), tilt (lambda, by scale) and scale of each source whose target lies between 0 and its cap. sizes: source, size, n."""
    scale = sizes.groupBy("source").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale")).withColumnRenamed("source", "s")
    inner = sources.where("target > 0 and target < cap")
    none = F.lit(None).cast("double")
    state = C.cut(inner.join(scale, F.col("source").eqNullSafe(F.col("s"))).select("s", "target", "scale", F.lit(0.0).alias("tilt"), none.alias("lo"), none.alias("hi"), F.lit(1.0).alias("off")))
    for _ in range(80):
        x = F.col("size") / F.col("scale")
        rate, free = _rate(most), F.col("tilt") * x < F.lit(math.log(most))
        mass = F.col("n") * F.col("size") * rate
        sums = sizes.join(state, F.col("source").eqNullSafe(F.col("s"))).groupBy("s", "target", "scale", "tilt", "lo", "hi").agg(F.sum(mass).alias("got"), F.sum(F.when(free, mass * x).otherwise(0.0)).alias("slope"))
        over = F.col("got") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("hi"))
        far = F.abs("tilt") + 4  # no step goes further
        newton = F.coalesce(F.try_divide(F.col("target") - F.col("got"), F.col("slope")), F.when(over, -far).otherwise(far))
        step = F.col("tilt") + F.least(F.greatest(newton, -far), far)
        off = F.abs(F.col("got") / F.col("target") - 1)
        moved = sums.select("s", "target", "scale", "tilt", lo.alias("lo"), hi.alias("hi"), step.alias("step"), off.alias("off"))
        outside = (F.col("step") <= F.col("lo")) | (F.col("step") >= F.col("hi"))
        tilt = F.when(F.col("off") < 1e-9, F.col("tilt")).when(F.coalesce(outside, F.lit(False)), (F.col("lo") + F.col("hi")) / 2).otherwise(F.col("step"))
        state = C.cut(moved.select("s", "target", "scale", tilt.alias("tilt"), "lo", "hi", "off"))
        if (state.agg(F.max("off")).first()[0] or 0) < 1e-9:
            break
    return state.select("s", "tilt", "scale")


def _rate(most: float) -> Column:
    """The tilted rate of a row with tilt, size and scale."""
    return F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(math.log(most))))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, chunk: int = 4096) -> DataFrame:
    """docs (source, text, other columns) with size, source_size, target, rate, copies and taken (size times copies)."""
    docs = docs.drop(*RESULT)
    sized = docs.withColumns({"__fl_key": C.row_key(docs), "size": C.n_words(F.col("text"))})
    sizes = C.cut(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"))
    goal = C.cut(targets(sources, weights, share, most))
    tilts = _tilts(sizes, goal, most)
    plan = C.cut(goal.join(tilts, F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("__fl_source"), "source_size", F.col("documents").alias("__fl_documents"), "target", F.col("cap").alias("__fl_cap"), F.col("tilt").alias("__fl_tilt"), F.col("scale").alias("__fl_scale")))
    small = plan.count() <= BROADCAST
    rows = sized.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("__fl_source"))).drop("__fl_source")
    tilted = F.exp(F.least(F.col("__fl_tilt") * F.col("size") / F.col("__fl_scale"), F.lit(math.log(most))))
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("target") >= F.col("__fl_cap"), float(most)).otherwise(tilted)
    rows = rows.withColumns({"rate": rate, "__fl_chunk": F.pmod(F.xxhash64("__fl_key", F.lit("chunk")), F.ceil(F.col("__fl_documents") / chunk))})
    rows = rows.withColumn("__fl_r", F.round(F.col("rate") * _ONE).cast("long")).drop("__fl_documents", "__fl_cap", "__fl_tilt", "__fl_scale")
    upto = F.sum("__fl_r").over(Window.partitionBy("source", "__fl_chunk").orderBy(F.desc("size"), "__fl_key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.when(F.col("__fl_chunk") == 0, F.lit(_ONE // 2)).otherwise(F.pmod(F.xxhash64("source", "__fl_chunk"), F.lit(_ONE)))
    rows = rows.withColumn("__fl_upto", upto + start)
    rows = rows.withColumn("copies", F.shiftright("__fl_upto", 32) - F.shiftright(F.col("__fl_upto") - F.col("__fl_r"), 32))
    return rows.withColumn("taken", F.col("copies") * F.col("size")).select(*docs.columns, *RESULT)
