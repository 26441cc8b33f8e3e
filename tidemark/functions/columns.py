"""Column expressions of the domain: states, signals, minutes and normalised dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import MINUTE_MS

# Names of events and sub-events.
START, END = "VideoSessionStart", "VideoSessionEnd"
BACKGROUND, FOREGROUND = "AppBackgrounded", "AppForegrounded"
HEARTBEAT, ERROR, PLAY = "VideoHeartbeat", "VideoError", "Play"
PAUSES = ("pause", "speed-pause", "AdPause")
RESUMES = ("resume", "speed-resume", "AdResume", "Play")

# Lower bounds of the smaller side of a picture, and their tiers.
TIERS = ((2160, "4K"), (1080, "1080p"), (720, "720p"), (540, "540p"), (480, "480p"), (360, "360p"), (240, "240p"), (1, "below_240p"))


def state_code(definition: str, event_type: Column, event: Column) -> Column:
    """1 active, 0 inactive, -1 closed; null for events that only show that the session lives."""
    edge = F.when(event_type == START, 1).when(event_type == END, -1)
    if definition == "FG":
        return edge.when(event_type == BACKGROUND, 0).when(event_type == FOREGROUND, 1).when(event == PLAY, 1)
    paused, resumed = event.isin(*PAUSES), event.isin(*RESUMES)
    return F.when(paused, 0).when(resumed, 1).when(event_type == BACKGROUND, 0).when(event_type == FOREGROUND, 1).when(event_type == START, 1).when(event_type == END, -1)


def signal(event_type: Column, event: Column) -> Column:
    """Class of an event; the sub-event decides before the event does."""
    return (
        F.when(event.isin(*PAUSES), "STATE_INACTIVE").when(event.isin(*RESUMES), "STATE_ACTIVE")
        .when(event_type == BACKGROUND, "STATE_INACTIVE").when(event_type == FOREGROUND, "STATE_ACTIVE")
        .when(event_type == START, "SESSION_OPEN").when(event_type == END, "SESSION_CLOSE").otherwise("LIVENESS")
    )


def buffer_marker(event: Column) -> Column:
    return F.when(event == "BufferStart", 1).when(event == "BufferEnd", 2).otherwise(0)


def floor_minute(ms: Column) -> Column:
    """Minute that holds an instant, in integers."""
    return F.call_function("div", ms, F.lit(MINUTE_MS)).cast("long")


def ceil_minute(ms: Column) -> Column:
    return floor_minute(ms + (MINUTE_MS - 1))


def minute_time(minute: Column) -> Column:
    return F.timestamp_seconds(minute * 60)


def month_of(ms: Column) -> Column:
    """UTC month of an instant, as a number such as 202401."""
    return F.date_format(F.timestamp_millis(ms), "yyyyMM").cast("int")


def filled(value: Column) -> Column:
    """value, or unk where it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("unk"))


def normal_platform(platform: Column) -> Column:
    return F.upper(F.trim(platform))


def normal_language(language: Column) -> Column:
    """Primary subtag in lower case, or unk."""
    return filled(F.split_part(F.lower(language), F.lit("-"), F.lit(1)))


def resolution_tier(resolution: Column) -> Column:
    """Tier by the smaller side of the first `w*h` in the string; unk where there is none or no positive side."""

    def side(i: int) -> Column:
        return F.nullif(F.regexp_extract(resolution, r"(\d+)\s*\*\s*(\d+)", i).try_cast("int"), F.lit(0))

    smaller = F.least(side(1), side(2))
    out = F.when(smaller >= TIERS[0][0], TIERS[0][1])
    for bound, name in TIERS[1:]:
        out = out.when(smaller >= bound, name)
    return out.otherwise("unk")
