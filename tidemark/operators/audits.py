"""Audits of raw events: silence, repeated edges, what follows errors, changing dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import END, ERROR, START


def gap_histogram(events: DataFrame, edges: tuple[int, ...] = (40_000, 50_000, 60_000)) -> DataFrame:
    """Number of gaps between neighbouring instants of a session in each bucket (edge, next edge]; gaps outside aren't counted."""
    at = events.select("session_id", "ts_ms").distinct()
    gap = at.withColumn("gap", F.col("ts_ms") - F.lag("ts_ms").over(Window.partitionBy("session_id").orderBy("ts_ms")))
    bucket = None
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        inside = (F.col("gap") > low) & (F.col("gap") <= high)
        bucket = F.when(inside, f"{low}-{high}") if bucket is None else bucket.when(inside, f"{low}-{high}")
    return gap.withColumn("bucket", bucket).where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count("*").alias("n"))


def repeated_edges(events: DataFrame) -> DataFrame:
    """For starts and for ends, the number of sessions that have more than one."""
    n = events.where(F.col("event_type").isin(START, END)).groupBy("session_id", "event_type").agg(F.count("*").alias("n"))
    return n.groupBy("event_type").agg(F.count_if(F.col("n") > 1).alias("sessions_with_repeats"))


def after_errors(events: DataFrame, error: str = ERROR) -> DataFrame:
    """Sessions with an error, and those of them that go on with another kind of event later. One pass by session, no self-join."""
    first = F.min(F.when(F.col("event_type") == error, F.col("ts_ms")))
    last = F.max(F.when(F.col("event_type") != error, F.col("ts_ms")))
    by_session = events.groupBy("session_id").agg(first.alias("first_error"), last.alias("last_other")).where(F.col("first_error").isNotNull())
    return by_session.agg(F.count("*").alias("sessions_with_error"), F.count_if(F.col("last_other") > F.col("first_error")).alias("sessions_going_on"))


def changing(events: DataFrame, dim: str = "platform") -> DataFrame:
    """Sessions with more than one value of a dimension."""
    return events.groupBy("session_id").agg(F.countDistinct(dim).alias("n_values")).where("n_values > 1")
