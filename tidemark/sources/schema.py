"""Schemas of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("content_id", T.LongType()),
        T.StructField("video_session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("platform", T.StringType()),
        T.StructField("app_version", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("audio_language", T.StringType()),
        T.StructField("subtitle_language", T.StringType()),
        T.StructField("player_version", T.StringType()),
        T.StructField("video_resolution", T.StringType()),
        T.StructField("session_start_epoch", T.LongType()),
    ]
)

CONTENT = T.StructType(
    [
        T.StructField("content_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("video_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("show_name", T.StringType()),
    ]
)
