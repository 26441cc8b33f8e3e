"""The queries of the engine over the sample tables, and DuckDB SQL for each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import EngineConfig
from tidemark.functions import columns as C
from tidemark.operators import audits, minutes, sessions, tables
from tidemark.plans import query as Q
from tidemark.plans.served import refresh, served
from tidemark.plans.sql import ORACLES
from tidemark.sources.adapters import GAP_MS, sample_content, sample_events

CONFIG = EngineConfig(gap_ms=GAP_MS)
DIMS = CONFIG.dims
#: Parameters that the SQL repeats.
FROM_MS, TO_MS, INSTANT_MS = 1_705_000_000_000, 1_705_600_000_000, 1_705_000_000_000
FIRST, LAST = FROM_MS // 60_000, TO_MS // 60_000
LISTED = (28_416_700, 28_417_000, 28_420_000)


def events(spark: SparkSession, sf_dir: str, config: EngineConfig = CONFIG) -> DataFrame:
    return sessions.normalize_events(sample_events(spark, sf_dir), sample_content(spark, sf_dir), config)


def intervals(spark: SparkSession, sf_dir: str, config: EngineConfig = CONFIG) -> DataFrame:
    return sessions.active_intervals(events(spark, sf_dir, config), config)


def built_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minutes.occupancy(intervals(spark, sf_dir), DIMS)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served minute table."""
    return served(spark, sf_dir, CONFIG).minutes(spark)


def gold_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of the served minute table that hold FIRST to LAST."""
    return served(spark, sf_dir, CONFIG).minutes(spark, FIRST, LAST)


def kept_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served interval table."""
    return served(spark, sf_dir, CONFIG).intervals(spark)


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = refresh(spark, sf_dir, CONFIG).minutes(spark)
    return table.agg(F.count("*").alias("n_rows"), F.sum("cnt_a").alias("a"), F.sum("cnt_b").alias("b"), F.max("minute_id").alias("last_minute"))


def _state_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads the array form of the sessions through a view, which stores nothing."""
    _arrays(events(spark, sf_dir)).createOrReplaceTempView("session_state")
    return spark.sql("SELECT session_id, live_ts, changes FROM session_state WHERE changes <> ''")


def _routed(iv: DataFrame) -> DataFrame:
    log = minutes.deltas(iv, DIMS, "a").unionByName(minutes.deltas(iv, DIMS, "b"))
    targets = tables.routed(log, "delta_kind", ("a", "b"))
    sums = [targets[k].groupBy("platform").agg(F.sum(F.abs("delta")).alias("moves")).withColumn("target", F.lit(k)) for k in targets]
    return sums[0].unionByName(sums[1])


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    instants = spark.range(FROM_MS, TO_MS, 7_200_000).select(F.col("id").alias("instant_ms"))
    return Q.active_at_each(kept_intervals(spark, sf_dir), instants)


def _on(source: Callable[[SparkSession, str], DataFrame], use: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: use(source(spark, sf_dir))


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",")


def _arrays(ev: DataFrame) -> DataFrame:
    at = sessions.session_state_arrays(ev)
    changes = F.transform("changes", lambda x: F.concat_ws(":", x["ts_ms"].cast("string"), x["st"].cast("string")))
    return at.select("session_id", _joined(F.col("live_ts")).alias("live_ts"), F.array_join(changes, ",").alias("changes"))


def _minutes(kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda iv: minutes.session_minutes(iv, kind).select("session_id", "minute_id", *DIMS)


def _delta(kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda iv: minutes.deltas(iv, DIMS, kind)


def _crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.crosscheck(gold(spark, sf_dir), minutes.deltas(kept_intervals(spark, sf_dir), DIMS, "a"))


def _bounded_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.exact_peak_bounded(kept_intervals(spark, sf_dir), served(spark, sf_dir, CONFIG).totals(spark))


def _hours(iv: DataFrame) -> DataFrame:
    delta = minutes.deltas(iv, DIMS, "a").select("platform", F.floor(F.col("minute_id") / 60).cast("long").alias("hour_id"), "delta")
    return tables.folded(delta, ["platform", "hour_id"], "delta")


def _touched(ev: DataFrame) -> DataFrame:
    part = ev.where(F.col("ts_ms") >= FROM_MS)
    return tables.touched(ev, part, "session_id").groupBy("session_id").agg(F.count("*").alias("n"))


def _latest(ev: DataFrame) -> DataFrame:
    return tables.latest(ev, ["user_id"], "ts_ms", ["content_id", "event_type"]).select("user_id", "session_id", "ts_ms", "content_id", "event_type")


def _pins(ev: DataFrame) -> DataFrame:
    first, last = F.min(F.struct("ts_ms", "platform")), F.max(F.struct("ts_ms", "platform"))
    return ev.groupBy("session_id").agg(first["platform"].alias("first_platform"), last["platform"].alias("last_platform"))


def _resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample_events(spark, sf_dir)
    return raw.groupBy("video_resolution", C.resolution_tier(F.col("video_resolution")).alias("tier")).agg(F.count("*").alias("n"))


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample_events(spark, sf_dir)
    return raw.groupBy(C.normal_language(F.col("audio_language")).alias("audio"), C.normal_language(F.col("subtitle_language")).alias("subtitle")).agg(F.count("*").alias("n"))


def _raw_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = replace(CONFIG, dims=(*DIMS, "video_resolution"))
    iv = sessions.active_intervals(events(spark, sf_dir, config), config)
    return iv.where(F.col("video_resolution") == "1920*1080").agg(F.countDistinct("session_id").alias("sessions"))


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = replace(CONFIG, dims=("platform", "resolution_tier"))
    iv = sessions.active_intervals(events(spark, sf_dir, config), config)
    return minutes.occupancy(iv, config.dims)


def _strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(spark, sf_dir, replace(CONFIG, strict_close=True)).select("session_id", "start_ms", "end_ms")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ask = Q.ConcurrencyQuery
    engaged = replace(CONFIG, definition="ENG")
    shown = ("session_id", "start_ms", "end_ms", *DIMS, "is_open", "is_provisional")
    normal = ("session_id", "user_id", "content_id", "ts_ms", "platform", "country", "video_type", "show_name", "event", "event_type", "st")
    return {
        "normalize_events": _on(events, lambda ev: ev.select(*normal)),
        "session_dim": _on(events, lambda ev: sessions.session_dim(ev, CONFIG)),
        "gap_transitions": _on(events, lambda ev: sessions.gap_transitions(ev, CONFIG)),
        "transitions_all": _on(events, lambda ev: sessions.transitions(ev, CONFIG).select("session_id", "ts_ms", "st")),
        "watermark_close": _on(events, lambda ev: sessions.watermark_close(ev, CONFIG)),
        "watermark_open": _on(events, lambda ev: sessions.watermark_open(ev, CONFIG)),
        "active_intervals": _on(intervals, lambda iv: iv.select(*shown)),
        "active_intervals_eng": lambda spark, sf_dir: intervals(spark, sf_dir, engaged).select(*shown),
        "active_intervals_strict": _strict,
        "session_state_arrays": _on(events, _arrays),
        "session_minutes_a": _on(intervals, _minutes("a")),
        "session_minutes_b": _on(intervals, _minutes("b")),
        "merged_runs": _on(intervals, lambda iv: minutes.merged_runs(iv, DIMS)),
        "g1_minute": built_gold,
        "g1_refresh": _refreshed,
        "g1_minute_fullouter": _on(intervals, lambda iv: minutes.occupancy_by_join(iv, DIMS)),
        "g1_minute_by_tier": _tiers,
        "g2_delta_a": _on(intervals, _delta("a")),
        "g2_delta_b": _on(intervals, _delta("b")),
        "g2_curve": _on(kept_intervals, lambda iv: minutes.curve(minutes.deltas(iv, DIMS, "a"))),
        "g1_g2_crosscheck": _crosscheck,
        "peak_avg": _on(gold, lambda g: ask().peak(g)),
        "peak_avg_filtered": _on(gold_within, lambda g: ask("cnt_b", {"platform": ["MWEB", "WEB"]}, {"country": "%A%"}, FIRST, LAST).peak(g)),
        "peak_last_hour": _on(gold, lambda g: ask(like={"platform": "%ANDROID%"}, last_minutes=60).peak(g)),
        "peak_hour_grain": _on(gold_within, lambda g: ask(first_minute=FIRST, last_minute=LAST).peak_by_grain(g, 60)),
        "peak_day_grain": _on(gold, lambda g: ask().peak_by_grain(g, 1440, 330)),
        "peak_by_platform": _on(gold, lambda g: ask().peak(g, "platform")),
        "peak_by_content": _on(gold, lambda g: ask().peak(g, "content_id")),
        "concurrency_curve": _on(gold, lambda g: ask().by_minute(g)),
        "dense_curve": _on(gold, lambda g: Q.dense_curve(g)),
        "avg_filled": _on(gold, lambda g: ask().average_filled(g)),
        "reach_range": _on(kept_intervals, lambda iv: Q.reach(iv, FROM_MS, TO_MS, platform="WEB")),
        "exact_peak": _on(kept_intervals, Q.exact_peak),
        "exact_peak_bounded": _bounded_served,
        "bucket_sensitivity": _on(kept_intervals, Q.bucket_sensitivity),
        "open_sessions": _on(kept_intervals, lambda iv: Q.open_sessions(iv).select("session_id", "platform", "content_id", "start_ms", "end_ms", "is_open")),
        "decline_alerts": _on(gold, lambda g: ask().declines(g)),
        "gap_histogram": _on(events, lambda ev: audits.gap_histogram(ev, (3_600_000, 5_400_000, GAP_MS, 14_400_000))),
        "range_peak_listed": _on(gold, lambda g: ask(minutes=LISTED).peak(g)),
        "g2_windowed_read": _on(kept_intervals, lambda iv: Q.windowed_read(minutes.deltas(iv, DIMS, "a"), FIRST, LAST)),
        "drilldown_at": _on(kept_intervals, lambda iv: Q.active_at(iv, INSTANT_MS).select("session_id", "start_ms", "end_ms", "platform")),
        "dup_boundary_audit": _on(events, audits.repeated_edges),
        "error_audit": _on(events, lambda ev: audits.after_errors(ev, C.BACKGROUND)),
        "platform_switch_audit": _on(events, audits.changing),
        "time_range": _on(gold, Q.time_range),
        "resolution_tier": _resolutions,
        "raw_resolution_sessions": _raw_resolution,
        "lang_normalize": _languages,
        "signal_classify": _on(events, lambda ev: ev.groupBy("signal", "buffer").agg(F.count("*").alias("n"))),
        "replacing_latest": _on(events, _latest),
        "summing_fold": _on(kept_intervals, _hours),
        "semi_touched": _on(events, _touched),
        "minmax_by_pins": _on(events, _pins),
        "active_intervals_both": _on(events, lambda ev: sessions.active_intervals_by_definition(ev, CONFIG).select("defn", "session_id", "start_ms", "end_ms")),
        "peak_report": _on(gold, lambda g: ask().report(g)),
        "peak_from_intervals": _on(kept_intervals, lambda iv: (q := ask(filters={"platform": ["MWEB", "WEB"]})).without_dims().peak(q.on_intervals(iv, "country"), "country")),
        "alive_windows": _on(events, lambda ev: sessions.alive_windows(ev, GAP_MS)),
        "active_at_each": _instants,
        "session_state_view": _state_view,
        "routed_deltas": _on(kept_intervals, _routed),
        "events_by_month": _on(events, lambda ev: ev.groupBy(C.month_of(F.col("ts_ms")).alias("month")).agg(F.count("*").alias("n"))),
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
