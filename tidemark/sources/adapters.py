"""The sample tables as raw events and catalog.

A user's events of a day are a session. Kinds of events map to session edges, and the number in props chooses the content and, by its
remainders, the other dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import BACKGROUND, END, FOREGROUND, HEARTBEAT, START

GAP_MS = 7_200_000
KINDS = {"signup": START, "purchase": END, "error": BACKGROUND, "click": FOREGROUND, "view": HEARTBEAT}
PLATFORMS = ("ANDROID_PHONE", "IPHONE", "Android_Tab ", "FIRE_TV", "Mweb", "MWEB", "Web", "WEB", "HTML_TV", "ANDROID_TV")
SUB_EVENTS = ("beat", "pause", "resume", "AdPause", "AdResume", "BufferStart", "BufferEnd")
LANGUAGES = ("en-US", "hi-IN", "TA", "", None)
RESOLUTIONS = ("1920*1080", "1280 * 720", "0-854*480", "NA-426*240", "DataSaver-256*144", "3840*2160", "960*540", "NA", "", None, "0*0")


def _pick(values: tuple, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (number % len(values) + 1).cast("int"))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds of a time without zone, whatever the session's zone is."""
    gap = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.extract(F.lit("DAY"), gap) * 86_400 + F.extract(F.lit("HOUR"), gap) * 3600 + F.extract(F.lit("MINUTE"), gap) * 60
    return seconds.cast("long") * 1000 + F.floor(F.extract(F.lit("SECOND"), gap) * 1000).cast("long")


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.col("n_name").alias("country"))
    k = F.regexp_extract("props", r"(\d+)", 1).try_cast("long")
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    ts = F.col("ts").cast("timestamp_ntz")
    rows = raw.select(
        k.alias("content_id"), F.concat_ws("-", F.col("user_id").cast("string"), F.date_format(F.to_date(ts), "yyyyMMdd")).alias("video_session_id"), F.col("user_id").cast("string").alias("user_id"),
        kind[F.col("event_type")].alias("event_type"), F.when(F.col("event_type") == "view", _pick(SUB_EVENTS, k)).otherwise(F.col("event_type")).alias("event"), epoch_ms(ts).alias("event_timestamp"),
        _pick(PLATFORMS, k).alias("platform"), F.concat(F.lit("v"), (k % 3).cast("string")).alias("app_version"), _pick(LANGUAGES, k).alias("audio_language"), _pick(LANGUAGES, k + 2).alias("subtitle_language"),
        F.concat(F.lit("p"), (k % 4).cast("string")).alias("player_version"), _pick(RESOLUTIONS, k).alias("video_resolution"), (F.col("user_id") % 25).alias("n_nationkey"),
    )
    # 25 nations, whatever the scale
    return rows.join(F.broadcast(nation), "n_nationkey", "left").drop("n_nationkey").withColumn("session_start_epoch", F.col("event_timestamp"))


def sample_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(F.col("p_partkey").alias("content_id"), F.col("p_name").alias("title"), F.col("p_type").alias("video_type"), F.lit("all").alias("category"), F.col("p_brand").alias("show_name"))
