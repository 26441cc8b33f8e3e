"""Questions about concurrency, each compiled to one DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import MINUTE_MS
from tidemark.functions.columns import floor_minute, minute_time
from tidemark.operators.minutes import curve, occupancy, running


@dataclass(frozen=True)
class ConcurrencyQuery:
    """A question to a minute table (minute_id, dims, cnt_a, cnt_b).

    metric: cnt_a or cnt_b. filters: equality by dimension; a list means any of them. like: SQL patterns by dimension. first_minute
    and last_minute are inclusive; minutes lists single ones; last_minutes goes back from the last minute of the whole table.
    """

    metric: str = "cnt_a"
    filters: dict[str, object] = field(default_factory=dict)
    like: dict[str, str] = field(default_factory=dict)
    first_minute: int | None = None
    last_minute: int | None = None
    minutes: tuple[int, ...] | None = None
    last_minutes: int | None = None

    def rows(self, gold: DataFrame) -> DataFrame:
        out = gold
        if self.last_minutes is not None:
            newest = gold.agg(F.max("minute_id").alias("newest"))  # one row
            out = out.crossJoin(F.broadcast(newest)).where(F.col("minute_id") >= F.col("newest") - self.last_minutes).drop("newest")
        if self.first_minute is not None:
            out = out.where(F.col("minute_id") >= self.first_minute)
        if self.last_minute is not None:
            out = out.where(F.col("minute_id") <= self.last_minute)
        if self.minutes is not None:
            out = out.where(F.col("minute_id").isin(*self.minutes))
        for name, value in self.filters.items():
            out = out.where(F.col(name).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
        for name, pattern in self.like.items():
            out = out.where(F.col(name).like(pattern))
        return out

    def on_intervals(self, intervals: DataFrame, *dims: str) -> DataFrame:
        """A minute table of dims alone that answers this question, from intervals: filters of dimensions are applied to the intervals
        first, and minutes are counted for the asked dims only. Ask it with without_dims(), as its filters are applied."""
        own = {**dict.fromkeys(self.filters), **dict.fromkeys(self.like)}
        some = replace(self, first_minute=None, last_minute=None, minutes=None, last_minutes=None).rows(intervals) if own else intervals
        return occupancy(some, dims)

    def without_dims(self) -> ConcurrencyQuery:
        return replace(self, filters={}, like={})

    def by_minute(self, gold: DataFrame, *dims: str) -> DataFrame:
        """The concurrency curve: minute_id, dims and c."""
        return self.rows(gold).groupBy("minute_id", *dims).agg(F.sum(self.metric).alias("c"))

    def peak(self, gold: DataFrame, *dims: str) -> DataFrame:
        """Peak, its earliest minute, and the average over the minutes that have a row, for all or for each value of dims."""
        return self.by_minute(gold, *dims).groupBy(*dims).agg(F.max("c").alias("peak"), F.avg("c").alias("avg_observed"), _argmax("c", "minute_id").alias("peak_minute"))

    def peak_by_grain(self, gold: DataFrame, minutes: int, tz_offset_minutes: int = 0) -> DataFrame:
        """Peak and average of the minutes of each bucket of so many minutes, an hour or a day, in the time zone of the offset."""
        bucket = F.floor((F.col("minute_id") + tz_offset_minutes) / minutes).cast("long")
        return self.by_minute(gold).groupBy(bucket.alias("bucket")).agg(F.max("c").alias("peak"), F.avg("c").alias("avg_observed"))

    def average_filled(self, gold: DataFrame) -> DataFrame:
        """Average over all minutes from the first to the last row, minutes without a row counting 0."""
        span = F.max("minute_id") - F.min("minute_id") + 1
        return self.by_minute(gold).agg((F.sum("c") / span).alias("avg_filled"), span.alias("n_minutes"))

    def report(self, gold: DataFrame) -> DataFrame:
        """Peak, its time in UTC as text, and the average over the minutes that have a row, to two digits."""
        found = self.peak(gold)
        return found.select("peak", F.round("avg_observed", 2).alias("avg_rounded"), F.date_format(minute_time(F.col("peak_minute")), "yyyy-MM-dd HH:mm").alias("peak_time"))

    def declines(self, gold: DataFrame, drop: float = 0.3) -> DataFrame:
        """Minutes that fall by more than this share against the row before. The window runs over one row for each minute."""
        at = self.by_minute(gold).withColumn("prev_c", F.lag("c").over(Window.orderBy("minute_id")))
        change = (F.col("c") - F.col("prev_c")) / F.col("prev_c")
        return at.where((F.col("prev_c") > 0) & (change < -drop)).withColumn("change", change)


def _argmax(value: str, minute: str) -> Column:
    """Earliest minute of the largest value."""
    return -F.max(F.struct(F.col(value), -F.col(minute)))["col2"]


def time_range(gold: DataFrame) -> DataFrame:
    return gold.agg(F.min("minute_id").alias("first_minute"), F.max("minute_id").alias("last_minute"))


def crosscheck(gold: DataFrame, delta: DataFrame) -> DataFrame:
    """Peaks of both models, and the number of minutes where they differ; delta is of kind a. The delta model is unfolded from each of
    its changes to the next."""
    counted = gold.groupBy("minute_id").agg(F.sum("cnt_a").alias("counted"))
    net = delta.groupBy("minute_id").agg(F.sum("delta").alias("delta"))
    level = running(net, "minute_id", "delta", "level", following="next_minute").where("level <> 0")
    level = level.select(F.explode(F.sequence("minute_id", F.coalesce("next_minute", F.col("minute_id") + 1) - 1)).alias("minute_id"), "level")
    both = counted.join(level, "minute_id", "full")
    zero = F.lit(0).cast("long")
    differ = F.count_if(F.coalesce("counted", zero) != F.coalesce("level", zero))
    return both.agg(F.max("counted").alias("g1_peak"), F.max("level").alias("g2_peak"), differ.alias("n_differ"))


def windowed_read(delta: DataFrame, first_minute: int, last_minute: int) -> DataFrame:
    """Levels of the delta model within a range: the running sum starts before all data and is cut afterwards."""
    return curve(delta).where(F.col("minute_id").between(first_minute, last_minute)).select("minute_id", "live")


def reach(intervals: DataFrame, from_ms: int, to_ms: int, **filters: object) -> DataFrame:
    """Distinct sessions that are active at some instant of [from_ms, to_ms)."""
    for name, value in filters.items():
        intervals = intervals.where(F.col(name) == value)
    return intervals.where((F.col("start_ms") < to_ms) & (F.col("end_ms") > from_ms)).agg(F.countDistinct("session_id").alias("sessions"))


def active_at(intervals: DataFrame, instant_ms: int) -> DataFrame:
    return intervals.where((F.col("start_ms") <= instant_ms) & (F.col("end_ms") > instant_ms))


def active_at_each(intervals: DataFrame, instants: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """Number of sessions active at each of instants (instant_ms). Both sides meet by buckets of time, so it is a join on equal keys, and an
    interval is repeated only for the buckets that it lasts."""
    low, high = (F.floor(F.col(c) / bucket_ms).cast("long") for c in ("start_ms", "end_ms"))
    spans = intervals.select("start_ms", "end_ms", F.explode(F.sequence(low, high)).alias("bucket"))
    at = instants.select("instant_ms", F.floor(F.col("instant_ms") / bucket_ms).cast("long").alias("bucket"))
    met = spans.join(at, "bucket").where((F.col("start_ms") <= F.col("instant_ms")) & (F.col("end_ms") > F.col("instant_ms")))
    return at.select("instant_ms").distinct().join(met.groupBy("instant_ms").agg(F.count("*").alias("n")), "instant_ms", "left").select("instant_ms", F.coalesce("n", F.lit(0).cast("long")).alias("sessions"))


def open_sessions(intervals: DataFrame, k: int = 50) -> DataFrame:
    """The k last ending intervals of open sessions."""
    return intervals.where("is_open = 1").orderBy(F.col("end_ms").desc(), "session_id", "start_ms").limit(k)


def exact_peak(intervals: DataFrame) -> DataFrame:
    """Largest number of sessions active at the same instant, and the first such instant: a sweep over net changes."""
    ends = F.array(F.struct(F.col("start_ms").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end_ms").alias("t"), F.lit(-1).alias("d")))
    net = intervals.select(F.inline(ends)).groupBy("t").agg(F.sum("d").alias("d"))
    level = running(net, "t", "d", "live", 3_600_000)
    return level.agg(F.max("live").alias("exact_peak"), (-F.max(F.struct(F.col("live"), -F.col("t")))["col2"]).alias("at_ms"))


def exact_peak_bounded(intervals: DataFrame, gold: DataFrame) -> DataFrame:
    """The same peak, by bounds: no level is below the largest cnt_a, which is the level at some instant, and none within a minute is
    above its cnt_b. So only minutes whose cnt_b is above the largest cnt_a are swept, in one pass, and of the intervals only what lies
    in them is shuffled."""
    bounds = gold.groupBy("minute_id").agg(F.sum("cnt_a").alias("a"), F.sum("cnt_b").alias("b"))
    lower = bounds.agg(F.coalesce(F.max("a"), F.lit(0).cast("long")).alias("lower"))  # one row
    wanted = bounds.crossJoin(F.broadcast(lower)).where("b > lower").select("minute_id")
    span = wanted.agg(F.min("minute_id").alias("from_minute"), F.max("minute_id").alias("to_minute"))  # one row
    first, last = floor_minute(F.col("start_ms")), floor_minute(F.col("end_ms") - 1)
    near = intervals.select("start_ms", "end_ms").crossJoin(F.broadcast(span)).where((first <= F.col("to_minute")) & (last >= F.col("from_minute")))
    near = near.select("start_ms", "end_ms", F.explode(F.sequence(F.greatest(first, "from_minute"), F.least(last, "to_minute"))).alias("minute_id"))
    at = near.join(wanted, "minute_id")
    begin = F.col("minute_id") * MINUTE_MS
    ends = F.array(F.struct(F.greatest("start_ms", begin).alias("t"), F.lit(1).alias("d")), F.struct(F.col("end_ms").alias("t"), F.lit(-1).alias("d")))
    net = at.select("minute_id", F.inline(ends)).groupBy("minute_id", "t").agg(F.sum("d").alias("d"))
    live = F.sum("d").over(Window.partitionBy("minute_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    best = net.withColumn("live", live).agg(F.max("live").alias("best"))
    return best.crossJoin(F.broadcast(lower)).select(F.greatest("best", "lower").alias("exact_peak"))


def bucket_sensitivity(intervals: DataFrame, widths_ms: Iterable[int] = (1_000, 60_000, 300_000)) -> DataFrame:
    """Peaks of both counts for several widths of the bucket, from signed changes alone. The intervals are computed once; all widths and
    counts go through the same sums."""
    floor = lambda c, w: F.call_function("div", c, w)
    width = F.col("bucket_ms")
    each = intervals.select("session_id", "start_ms", "end_ms", F.explode(F.array(*[F.lit(w).cast("long") for w in widths_ms])).alias("bucket_ms"))
    # a session that touches a bucket twice counts once: later spans begin where the earlier ones end
    by_start = Window.partitionBy("session_id", "bucket_ms").orderBy("start_ms")
    each = each.withColumns({"high_b": floor(F.col("end_ms") - 1, width) + 1})
    each = each.withColumn("low_b", F.greatest(floor(F.col("start_ms"), width), F.lag("high_b").over(by_start)))
    spans = [("cnt_a", floor(F.col("start_ms") + width - 1, width), floor(F.col("end_ms") + width - 1, width)), ("cnt_b", F.col("low_b"), F.col("high_b"))]
    ends = [F.when(low < high, F.struct(F.lit(m).alias("metric"), t.alias("t"), F.lit(d).alias("d"))) for m, low, high in spans for t, d in ((low, 1), (high, -1))]
    net = each.select("bucket_ms", F.inline(F.filter(F.array(*ends), lambda x: x.isNotNull()))).groupBy("bucket_ms", "metric", "t").agg(F.sum("d").alias("d"))
    # prefix sums in two levels: within hours, and over hours
    keys = ("bucket_ms", "metric")
    net = net.withColumn("hour", floor(F.col("t") * width, F.lit(3_600_000)))
    within = Window.partitionBy(*keys, "hour").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    hours = net.withColumn("live", F.sum("d").over(within)).groupBy(*keys, "hour").agg(F.max("live").alias("most"), F.sum("d").alias("total"))
    before = F.sum("total").over(Window.partitionBy(*keys).orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")
    return hours.withColumn("peak", F.col("most") + before).groupBy(*keys).agg(F.max("peak").alias("peak"))


def dense_curve(gold: DataFrame, metric: str = "cnt_a") -> DataFrame:
    """The curve with a row for every minute between the first and the last."""
    at = ConcurrencyQuery(metric).by_minute(gold)
    spine = time_range(gold).select(F.explode(F.sequence("first_minute", "last_minute")).alias("minute_id"))
    return spine.join(at, "minute_id", "left").select("minute_id", F.coalesce("c", F.lit(0).cast("long")).alias("c"))
