"""Minute models of active intervals: occupancy counts and signed deltas."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ceil_minute, floor_minute


def session_minutes(intervals: DataFrame, kind: str) -> DataFrame:
    """A row for each session and minute. Kind a: the session is active at the minute's first instant. Kind b: it is active at some
    instant of the minute. Kind a has no repeats, as a session's intervals are disjoint; kind b may touch a minute twice."""
    low, high = (ceil_minute(F.col("start_ms")), ceil_minute(F.col("end_ms"))) if kind == "a" else (floor_minute(F.col("start_ms")), floor_minute(F.col("end_ms") - 1) + 1)
    some = intervals.withColumns({"low": low, "high": high}).where("high > low")
    out = some.withColumn("minute_id", F.explode(F.sequence("low", F.col("high") - 1))).drop("low", "high", "start_ms", "end_ms", "is_provisional")
    return out if kind == "a" else out.distinct()


def merged_runs(intervals: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """Runs [start_minute, end_minute) of consecutive minutes that each session touches, from its intervals without unfolding them."""
    by_start = Window.partitionBy("session_id").orderBy("start_ms")
    at = intervals.withColumns({"first": floor_minute(F.col("start_ms")), "last": floor_minute(F.col("end_ms") - 1)})
    new = F.coalesce((F.col("first") > F.lag("last").over(by_start) + 1).cast("int"), F.lit(1))
    run = at.withColumn("new", new).withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("session_id", "run", *dims).agg(F.min("first").alias("start_minute"), (F.max("last") + 1).alias("end_minute")).drop("run")


def touched_spans(intervals: DataFrame) -> DataFrame:
    """intervals with the minutes [low_a, high_a) at whose first instant they are active, and the minutes [low_b, high_b) that they are
    the first of their session to touch. Spans may be empty; those of a session don't overlap, so sums over them are distinct counts."""
    by_start = Window.partitionBy("session_id").orderBy("start_ms")
    last = floor_minute(F.col("end_ms") - 1)
    spans = {"low_a": ceil_minute(F.col("start_ms")), "high_a": ceil_minute(F.col("end_ms")), "low_b": floor_minute(F.col("start_ms")), "high_b": last + 1}
    return intervals.withColumns(spans).withColumn("low_b", F.greatest("low_b", F.lag("high_b").over(by_start)))


def changes(intervals: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """Changes (change_a, change_b) of both counts by minute and dims. Partial sums meet in one exchange, of at most a row for each
    minute and dims that each task has."""
    ends = []
    for kind in "ab":
        some = F.col(f"low_{kind}") < F.col(f"high_{kind}")
        for edge, sign in (("low", 1), ("high", -1)):
            own = [F.lit(sign if k == kind else 0).alias(f"change_{k}") for k in "ab"]
            ends.append(F.when(some, F.struct(F.col(f"{edge}_{kind}").alias("minute_id"), *own)))
    rows = touched_spans(intervals).select(*dims, F.inline(F.filter(F.array(*ends), lambda x: x.isNotNull())))
    return rows.groupBy("minute_id", *dims).agg(F.sum("change_a").alias("change_a"), F.sum("change_b").alias("change_b"))


def _unfolded(net: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """Minute table from net changes (change_a, change_b; one row for each minute and dims)."""
    if dims:
        order = Window.partitionBy(*dims).orderBy("minute_id")
        so_far = order.rowsBetween(Window.unboundedPreceding, 0)
        net = net.withColumns({f"cnt_{k}": F.sum(f"change_{k}").over(so_far) for k in "ab"} | {"next_minute": F.lead("minute_id").over(order)})
    else:
        net = running(running(net, "minute_id", "change_a", "cnt_a"), "minute_id", "change_b", "cnt_b", following="next_minute")
    net = net.where((F.col("cnt_a") > 0) | (F.col("cnt_b") > 0))
    return net.select(F.explode(F.sequence("minute_id", F.col("next_minute") - 1)).alias("minute_id"), *dims, "cnt_a", "cnt_b")


def occupancy(intervals: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """Minute table: cnt_a and cnt_b of each minute and dims, for minutes that some session touches.

    It comes from changes alone: their running sums by dims are the counts from one change to the next, and only the result is unfolded
    to minutes. So what is shuffled grows with the intervals, not with the minutes that they last. Of fewer dims it is the sum over
    the others, as a session has one value of each.
    """
    return _unfolded(changes(intervals, dims), dims)


def occupancy_by_join(intervals: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """The same table from a full outer join of the signed changes of both kinds, each from a pass of its own: a from the intervals, b from
    merged runs. Kept as a cross-check of touched_spans. A count is the running sum of its changes, so the changes meet before minutes are
    unfolded, and what is shuffled doesn't grow with the minutes that sessions last. Dims may be null."""
    keys = ["minute_id", *dims]
    a, b = (deltas(intervals, dims, k).alias(k) for k in "ab")
    same = reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    change = [F.coalesce(f"{k}.delta", F.lit(0)).alias(f"change_{k}") for k in "ab"]
    net = a.join(b, same, "full").select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], *change)
    return _unfolded(net, dims)


def deltas(intervals: DataFrame, dims: tuple[str, ...], kind: str) -> DataFrame:
    """Signed changes of the number of sessions, by minute and dims; kind a from intervals, kind b from merged runs."""
    if kind == "a":
        spans = intervals.select(*dims, ceil_minute(F.col("start_ms")).alias("low"), ceil_minute(F.col("end_ms")).alias("high"))
    else:
        spans = merged_runs(intervals, dims).select(*dims, F.col("start_minute").alias("low"), F.col("end_minute").alias("high"))
    ends = F.array(F.struct(F.col("low").alias("minute_id"), F.lit(1).alias("change")), F.struct(F.col("high").alias("minute_id"), F.lit(-1).alias("change")))
    return spans.select(*dims, F.inline(ends)).groupBy("minute_id", *dims).agg(F.sum("change").alias("delta")).withColumn("delta_kind", F.lit(kind))


def running(rows: DataFrame, order: str, change: str, out: str, chunk: int = 1440, following: str | None = None) -> DataFrame:
    """rows (order, change; one row for each value of order) with the running sum of change and, if named, the following value of order.

    Prefix sums in two levels: within chunks of order, and over the chunks' totals, of which there is one row for each chunk.
    """
    part = rows.withColumn("chunk", F.floor(F.col(order) / chunk).cast("long"))
    totals = part.groupBy("chunk").agg(F.sum(change).alias("total"), F.min(order).alias("head"))
    by_chunk, within = Window.orderBy("chunk"), Window.partitionBy("chunk").orderBy(order)
    before = (F.sum("total").over(by_chunk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("carried")
    carried = totals.select("chunk", before, F.lead("head").over(by_chunk).alias("next_head"))
    part = part.withColumn(out, F.sum(change).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    if following:
        part = part.withColumn(following, F.lead(order).over(within))
    part = part.join(carried, "chunk").withColumn(out, F.col(out) + F.col("carried"))
    if following:
        part = part.withColumn(following, F.coalesce(following, "next_head"))
    return part.drop("chunk", "carried", "next_head")


def curve(delta: DataFrame) -> DataFrame:
    """Number of live sessions from each minute with a change on. The changes of a minute are summed before the running sum."""
    return running(delta.groupBy("minute_id").agg(F.sum("delta").alias("delta")), "minute_id", "delta", "live")
