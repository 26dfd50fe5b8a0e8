"""Windows over event tables, batch or streaming, and first-seen addresses of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(df: DataFrame, late: str | None) -> DataFrame:
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df if late is None else df.withWatermark("ts", late)


def tumbling(df: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Events and sum of values of each window and type."""
    return _timed(df, late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(df: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """Each user's sessions: runs of events no further apart than gap."""
    return _timed(df, late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_seen(df: DataFrame, key: str = "url", late: str = "1 day") -> DataFrame:
    """The first event of each address within the watermark: the visited set of a stream."""
    return _timed(df, late).dropDuplicatesWithinWatermark([key])
