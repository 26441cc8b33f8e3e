"""Raw tables from files, in batch and as streams, and the layouts that they are written in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import month_of
from tidemark.sources.schema import CONTENT, EVENTS


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files with headers, as schema: columns are found by the names in the header, in any order, those that it lacks are null and
    others are left out. All files under path share a header; only its line is read to plan."""
    names = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema}
    found = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])
    rows = spark.read.schema(found).option("header", True).csv(path)
    return rows.select(*[F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_csv_events(spark: SparkSession, path: str) -> DataFrame:
    """Events from CSV files, of either version of the schema: the first one has broker metadata and no video_resolution."""
    return _read_csv(spark, path, EVENTS)


def read_csv_content(spark: SparkSession, path: str) -> DataFrame:
    """Catalog from CSV files, with or without show_name."""
    return _read_csv(spark, path, CONTENT)


def append_events(events: DataFrame, path: str) -> None:
    """Append-only event table: duplicates stay; parts by the date of the session's start; Bloom filters for the rare dimensions."""
    writer = events.withColumn("start_date", F.to_date(F.timestamp_millis("session_start_epoch"))).write.mode("append").partitionBy("start_date")
    for name in ("app_version", "audio_language", "subtitle_language", "player_version", "video_resolution"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("start_date")


def stream_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Events as a stream of arriving Parquet files. With a broker, use its connector in place of this source."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def write_minutes(gold: DataFrame, path: str, sort: Iterable[str] = ("country", "video_type", "platform", "content_id", "minute_id")) -> None:
    """Minute table, one part for each UTC date, rows sorted so that column statistics prune. It replaces the dates that gold holds."""
    dated = gold.withColumn("minute_date", F.to_date(F.timestamp_seconds(F.col("minute_id") * 60)))
    order = [c for c in sort if c in gold.columns]
    # the date leads, as the writer sorts by it unless the rows are so already
    dated.repartition("minute_date").sortWithinPartitions("minute_date", *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("minute_date").parquet(path)


def read_minutes(spark: SparkSession, path: str, first_minute: int | None = None, last_minute: int | None = None) -> DataFrame:
    """Minute table within a range of minutes. A range of minutes prunes no parts by itself, so the range of dates is added."""
    gold = spark.read.parquet(path)
    for bound, low in ((first_minute, True), (last_minute, False)):
        if bound is not None:
            date = F.to_date(F.timestamp_seconds(F.lit(bound * 60)))
            gold = gold.where((F.col("minute_date") >= date) & (F.col("minute_id") >= bound) if low else (F.col("minute_date") <= date) & (F.col("minute_id") <= bound))
    return gold


def write_intervals(intervals: DataFrame, path: str) -> None:
    """Interval table, one part for each UTC month of the start, rows sorted by start so that column statistics prune. It replaces the
    months that intervals holds."""
    dated = intervals.withColumn("start_month", month_of(F.col("start_ms")))
    dated.repartition("start_month").sortWithinPartitions("start_month", "start_ms").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("start_month").parquet(path)


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("start_month")
