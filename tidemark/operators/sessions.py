"""From raw events to active intervals.

The events of a session meet in one exchange, by session; all windows after it share that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.config import EngineConfig
from tidemark.functions import columns as C


def by_time() -> WindowSpec:
    return Window.partitionBy("session_id").orderBy("ts_ms")


def whole() -> WindowSpec:
    return by_time().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)



def normalize_events(events: DataFrame, content: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Typed events with normalised dimensions, enriched by the catalog, with the state code st of config's definition.

    The catalog is reduced to one row per content first, so that no event is multiplied; Spark broadcasts it if it is small.
    """
    one = content.groupBy("content_id").agg(*[F.min(c).alias(c) for c in ("video_type", "show_name", "category", "title")])
    return events.join(one, "content_id", "left").select(
        F.col("video_session_id").alias("session_id"), "user_id", "content_id", F.col("event_timestamp").alias("ts_ms"), C.normal_platform(F.col("platform")).alias("platform"), "country",
        C.filled(F.col("video_type")).alias("video_type"), C.filled(F.col("show_name")).alias("show_name"), C.filled(F.col("category")).alias("category"), "app_version",
        C.normal_language(F.col("audio_language")).alias("audio_language"), C.normal_language(F.col("subtitle_language")).alias("subtitle_language"), "player_version",
        F.nullif(F.replace(F.col("video_resolution"), F.lit(" "), F.lit("")), F.lit("")).alias("video_resolution"), C.resolution_tier(F.col("video_resolution")).alias("resolution_tier"),
        "event", "event_type", C.state_code(config.definition, F.col("event_type"), F.col("event")).alias("st"), C.signal(F.col("event_type"), F.col("event")).alias("signal"), C.buffer_marker(F.col("event")).alias("buffer"),
    )


def _earliest(name: str) -> Column:
    """Value of the earliest event that has one; the least of those at the same instant."""
    return F.min(F.when(F.col(name).isNotNull(), F.struct("ts_ms", name)))[name].alias(name)


def session_dim(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """A row for each session: dimensions pinned to its earliest event, first and last instant, whether it has a close and a start."""
    return events.groupBy("session_id").agg(
        *[_earliest(d) for d in (*config.dims, "user_id")], F.min("ts_ms").alias("session_start_ms"), F.max("ts_ms").alias("last_seen_ms"),
        F.max((F.col("event_type") == C.END).cast("int")).alias("has_close"), F.max((F.col("event_type") == C.START).cast("int")).alias("has_start"),
    )


def pulses(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """A row for each instant of each session, with what the session's other instants say of it."""
    flag = lambda kind: F.max((F.col("event_type") == kind).cast("int"))
    at = events.repartition("session_id").groupBy("session_id", "ts_ms").agg(F.min("st").alias("st"), flag(C.END).alias("ends"), flag(C.START).alias("starts"), *[F.min(d).alias(d) for d in config.dims])
    return at.select(
        "session_id", "ts_ms", "st", *[F.first(d, ignorenulls=True).over(whole()).alias(d) for d in config.dims],
        F.coalesce(F.max("ends").over(whole()), F.lit(0)).alias("has_close"), F.coalesce(F.max("starts").over(whole()), F.lit(0)).alias("has_start"),
        F.lag("ts_ms").over(by_time()).alias("prev_ts"), F.lead("ts_ms").over(by_time()).alias("next_ts"),
    )


def transitions(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """All state changes of each session: at most one at an instant, the least code there.

    Besides the explicit ones: an instant after silence opens and one before silence closes the session for a while; the first instant of a
    session without start opens it, and gap_ms after the last one of a session without close it is closed. Columns: session_id, ts_ms,
    st, kind (explicit or inferred at the instant; gap_close; watermark_close), dims and has_close.
    """
    gap, at = config.gap_ms, pulses(events, config)
    opens = F.when(F.lit(config.watermark_open) & F.col("prev_ts").isNull() & (F.col("has_start") == 0), F.lit(1))
    base = F.least(F.col("st"), opens)
    after_gap = F.when(F.col("ts_ms") - F.col("prev_ts") > gap, F.lit(1))
    if config.gap_reopen_requires_active:
        before = F.last("base", ignorenulls=True).over(by_time().rowsBetween(Window.unboundedPreceding, -1))
        at = at.withColumn("base", base).withColumn("before", before)
        base, after_gap = F.col("base"), F.when(F.col("before") == 1, after_gap)
    code = F.least(base, after_gap)
    silent = F.when(F.col("next_ts") - F.col("ts_ms") > gap, F.lit(0)).when(F.col("next_ts").isNull() & (F.col("has_close") == 0), F.lit(-1))
    row = lambda ts, st, kind: F.struct(ts.alias("ts_ms"), st.alias("st"), kind.alias("kind"))
    own = F.when(F.col("st").isNotNull(), "explicit").otherwise("inferred")
    both = F.array(row(F.col("ts_ms"), code, own), row(F.col("ts_ms") + gap, silent, F.when(silent == 0, "gap_close").otherwise("watermark_close")))
    out = at.select("session_id", *config.dims, "has_close", F.inline(F.filter(both, lambda x: x["st"].isNotNull())))
    if config.strict_close:
        closed = F.min("st").over(by_time().rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn("closed", closed).where(F.coalesce(F.col("closed"), F.lit(0)) > -1).drop("closed")
    return out


def active_intervals(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Half-open intervals [start_ms, end_ms) in which each session is active, with its dims.

    is_open marks all intervals of a session without close; is_provisional only the one that a synthetic close ends.
    """
    steps = transitions(events, config).withColumn("before", F.lag("st").over(by_time())).where(~F.col("st").eqNullSafe(F.col("before")))
    spans = steps.withColumns({"end_ms": F.lead("ts_ms").over(by_time()), "end_kind": F.lead("kind").over(by_time())})
    spans = spans.where((F.col("st") == 1) & (F.col("end_ms") > F.col("ts_ms")))
    return spans.select(
        "session_id", F.col("ts_ms").alias("start_ms"), "end_ms", *config.dims,
        (1 - F.col("has_close")).alias("is_open"), (F.col("end_kind") == "watermark_close").cast("int").alias("is_provisional"),
    )


def active_intervals_by_definition(events: DataFrame, config: EngineConfig = EngineConfig(), definitions: tuple[str, ...] = ("FG", "ENG")) -> DataFrame:
    """Active intervals under several definitions at once, with the column defn. Each definition of a session goes through the same pass as
    a session of its own, so the events meet in one exchange."""
    codes = [F.struct(F.lit(d).alias("defn"), C.state_code(d, F.col("event_type"), F.col("event")).alias("code")) for d in definitions]
    each = events.drop("st").select("*", F.inline(F.array(*codes))).withColumnRenamed("code", "st")
    each = each.withColumn("session_id", F.struct("defn", "session_id")).drop("defn")
    found = active_intervals(each, config)
    return found.select(F.col("session_id.defn").alias("defn"), F.col("session_id.session_id").alias("session_id"), *[c for c in found.columns if c != "session_id"])


def alive_windows(events: DataFrame, gap_ms: int) -> DataFrame:
    """Spans of each session without silence longer than gap_ms, by Spark's session windows: first and last instant and number of events.
    They cross-check the gaps that transitions close."""
    window = F.session_window(F.timestamp_millis("ts_ms"), F.lit(f"{gap_ms} milliseconds"))
    spans = events.groupBy("session_id", window.alias("span")).agg(F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"), F.count("*").alias("n"))
    return spans.drop("span")


def gap_transitions(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """The changes that silence alone implies: 0 at gap_ms after the last instant before it, 1 at the first after it."""
    at = events.select("session_id", "ts_ms").distinct().withColumn("prev_ts", F.lag("ts_ms").over(by_time())).where(F.col("ts_ms") - F.col("prev_ts") > config.gap_ms)
    off = F.struct((F.col("prev_ts") + config.gap_ms).alias("ts_ms"), F.lit(0).alias("st"))
    return at.select("session_id", F.inline(F.array(off, F.struct(F.col("ts_ms"), F.lit(1).alias("st")))))


def watermark_close(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    dim = session_dim(events, config).where("has_close = 0")
    return dim.select("session_id", (F.col("last_seen_ms") + config.gap_ms).alias("ts_ms"), F.lit(-1).alias("st"))


def watermark_open(events: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    return session_dim(events, config).where("has_start = 0").select("session_id", F.col("session_start_ms").alias("ts_ms"), F.lit(1).alias("st"))


def session_state_arrays(events: DataFrame) -> DataFrame:
    """The array form of a session's state: its distinct instants and its explicit changes, both sorted."""
    return events.groupBy("session_id").agg(
        F.array_sort(F.collect_set("ts_ms")).alias("live_ts"),
        F.sort_array(F.collect_set(F.when(F.col("st").isNotNull(), F.struct("ts_ms", "st")))).alias("changes"),
    )
