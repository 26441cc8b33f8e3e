"""Tables of a stream of events, which late and repeated events correct.

Each micro-batch refreshes three tables in order: the intervals of the touched sessions, the minute counts and the signed deltas. The
latter two get signed changes: what the touched sessions have now, less what they had before. The sum of all changes is the batch
result over the events so far, in whatever order they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.config import EngineConfig
from tidemark.functions.columns import END, START
from tidemark.operators.minutes import deltas, occupancy
from tidemark.operators.sessions import active_intervals
from tidemark.operators.tables import touched
from tidemark.sources.folders import exists, file_system, remove
from tidemark.streaming.machine import intervals_of, minutes_of


class LiveMinutes:
    """Keeps events, intervals, signed minute counts and deltas under a folder that all nodes reach.

    Events lie in parts by a hash of the session, so a batch reads only the parts that it touches. Each batch writes files of its own
    number, and writes them again if it is repeated, so every event counts once. No state is held between batches. Every compact_every
    batches the files of older batches become one.
    """

    def __init__(self, spark: SparkSession, folder: str, config: EngineConfig = EngineConfig(), parts: int = 64, compact_every: int = 100):
        self.spark, self.folder, self.config, self.parts, self.compact_every = spark, folder.rstrip("/"), config, parts, compact_every

    def _folders(self, kind: str) -> list[tuple[int, int, str]]:
        """First and last batch of each folder of a table, and its path; a folder that a larger one holds is left out."""
        path = f"{self.folder}/{kind}"
        if not exists(self.spark, path):
            return []
        system, where = file_system(self.spark, path)
        names = [x.getPath().getName() for x in system.listStatus(where) if x.isDirectory()]
        names = [n for n in names if n.startswith("batch=") and exists(self.spark, f"{path}/{n}/_SUCCESS")]
        spans = [(*map(int, n.removeprefix("batch=").split("-")), f"{path}/{n}") for n in names if "-" in n]
        spans += [(int(n.removeprefix("batch=")),) * 2 + (f"{path}/{n}",) for n in names if "-" not in n]
        held = lambda x: any(y[0] <= x[0] and x[1] <= y[1] and (y[1] - y[0]) > (x[1] - x[0]) for y in spans)
        return sorted(x for x in spans if not held(x))

    def _read(self, kind: str, before: int | None = None) -> DataFrame | None:
        paths = [path for first, _, path in self._folders(kind) if before is None or first < before]
        out = None
        for path in paths:
            one = self.spark.read.parquet(path)
            out = one if out is None else out.unionByName(one)
        return out

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{kind}/batch={number}")

    def _changes(self, now: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        dims = self.config.dims
        counts, moves = [], []
        for sign, some in ((1, now), (-1, before)):
            g = occupancy(some, dims)
            counts.append(g.select("minute_id", *dims, (sign * F.col("cnt_a")).alias("cnt_a"), (sign * F.col("cnt_b")).alias("cnt_b")))
            moves += [deltas(some, dims, kind).withColumn("delta", sign * F.col("delta")) for kind in "ab"]
        moved = moves[0]
        for more in moves[1:]:
            moved = moved.unionByName(more)
        return self._counts(counts[0].unionByName(counts[1])), self._moves(moved)

    def _counts(self, rows: DataFrame) -> DataFrame:
        counts = rows.groupBy("minute_id", *self.config.dims).agg(F.sum("cnt_a").alias("cnt_a"), F.sum("cnt_b").alias("cnt_b"))
        return counts.where("cnt_a <> 0 OR cnt_b <> 0")

    def _moves(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("minute_id", *self.config.dims, "delta_kind").agg(F.sum("delta").alias("delta")).where("delta <> 0")

    @staticmethod
    def _latest(intervals: DataFrame) -> DataFrame:
        """The intervals of each session's last batch; a session whose intervals have gone has a row without times there."""
        last = intervals.groupBy("session_id").agg(F.max("version").alias("version"))
        return intervals.join(last, ["session_id", "version"])

    def add(self, batch: DataFrame, number: int) -> None:
        """Takes in a batch of normalised events; number is the batch's, the same when it is repeated."""
        if any(first <= number <= last and first < last for first, last, _ in self._folders("events")):
            return  # it was taken in and compacted
        rows = batch.withColumns({"part": F.pmod(F.xxhash64("session_id"), F.lit(self.parts)).cast("int"), "batch": F.lit(number).cast("long")})
        rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.folder}/events/batch={number}")
        new = self.spark.read.parquet(f"{self.folder}/events/batch={number}").select("session_id", "part")
        parts = [r["part"] for r in new.select("part").distinct().collect()]  # at most self.parts rows
        if not parts:
            return
        own = touched(self._read("events", number + 1).where(F.col("part").isin(*parts)), new, "session_id")
        now = active_intervals(own, self.config)
        now = new.select("session_id").distinct().join(now, "session_id", "left").withColumn("version", F.lit(number).cast("long"))
        old = self._read("intervals", number)
        self._write(now, "intervals", number)
        now = self.spark.read.parquet(f"{self.folder}/intervals/batch={number}")
        before = now.where("false") if old is None else self._latest(touched(old, new, "session_id"))
        counts, moves = self._changes(now.where("start_ms IS NOT NULL"), before.where("start_ms IS NOT NULL").select(now.columns))
        self._write(counts, "minutes", number)
        self._write(moves, "deltas", number)
        if self.compact_every and (number + 1) % self.compact_every == 0:
            self.compact(number)

    def compact(self, last: int) -> None:
        """Puts the files of all batches up to last into one folder of each table; sums and latest versions are taken on the way. The
        old folders go only when the new one is complete, and are ignored from then on."""
        for kind in ("minutes", "deltas", "intervals", "events"):
            held = [x for x in self._folders(kind) if x[1] <= last]
            if len(held) < 2:
                continue
            rows = None
            for _, _, path in held:
                one = self.spark.read.parquet(path)
                rows = one if rows is None else rows.unionByName(one)
            rows = {"minutes": self._counts, "deltas": self._moves, "intervals": self._latest}.get(kind, lambda x: x)(rows)
            writer = rows.repartition("part").write.partitionBy("part") if kind == "events" else rows.write
            writer.mode("overwrite").parquet(f"{self.folder}/{kind}/batch={held[0][0]}-{last}")
            for _, _, path in held:
                remove(self.spark, path)

    def minutes(self) -> DataFrame:
        """The minute table so far."""
        kept = self._read("minutes")
        return self._counts(kept) if kept is not None else self._none("cnt_a long, cnt_b long")

    def deltas(self) -> DataFrame:
        """The delta table so far, of both kinds."""
        kept = self._read("deltas")
        return self._moves(kept) if kept is not None else self._none("delta_kind string, delta long")

    def intervals(self) -> DataFrame:
        """The current intervals of all sessions; None before the first batch."""
        kept = self._read("intervals")
        return None if kept is None else self._latest(kept).where("start_ms IS NOT NULL").drop("version")

    def _none(self, values: str) -> DataFrame:
        dims = ", ".join(f"{d} {'long' if d == 'content_id' else 'string'}" for d in self.config.dims)
        return self.spark.createDataFrame([], f"minute_id long, {dims}, {values}")

    def start(self, stream: DataFrame, interval: str | None = "15 seconds") -> StreamingQuery:
        """Runs on a stream of normalised events; without an interval it takes what is there and stops."""
        writer = stream.writeStream.foreachBatch(self.add).option("checkpointLocation", f"{self.folder}/progress")
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


CHANGE = "session_id string, minute_id long, cnt_a long, cnt_b long"
HELD = "ts array<bigint>, st array<int>, closes array<boolean>, starts array<boolean>"


def session_changes(stream: DataFrame, config: EngineConfig = EngineConfig(), idle_ms: int | None = None) -> DataFrame:
    """Signed session minutes of a stream of normalised events, by a stateful operator that keeps each session's distinct events.

    In update mode every trigger emits, for each session that it touches, the minutes that the session gains (1) and loses (-1) of either
    kind. Sums of them over sessions are the counts of the batch plan without dimensions. With idle_ms, a session is forgotten when the
    watermark, which follows the latest event by idle_ms, has passed its last event by idle_ms; its minutes stay as they are, and an event
    that comes later still starts it anew. Without, sessions are kept for good.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame(columns=["session_id", "minute_id", "cnt_a", "cnt_b"])
            return
        held = set(zip(*state.get, strict=True)) if state.exists else set()
        before = minutes_of(intervals_of(held, config)) if held else (set(), set())
        for frame in frames:
            for ts, st, kind in zip(frame["ts_ms"], frame["st"], frame["event_type"], strict=True):
                held.add((int(ts), None if pd.isna(st) else int(st), kind == END, kind == START))
        state.update(tuple(map(list, zip(*sorted(held, key=str), strict=True))))
        if idle_ms:
            last = max(e[0] for e in held)
            state.setTimeoutTimestamp(max(last + idle_ms, state.getCurrentWatermarkMs() + 1))
        after = minutes_of(intervals_of(held, config))
        rows = []
        for minute in sorted(before[0] | before[1] | after[0] | after[1]):
            a, b = (minute in after[0]) - (minute in before[0]), (minute in after[1]) - (minute in before[1])
            if a or b:
                rows.append((key[0], minute, a, b))
        yield pd.DataFrame(rows, columns=["session_id", "minute_id", "cnt_a", "cnt_b"])

    slim = stream.select("session_id", "ts_ms", "st", "event_type")
    timeout = GroupStateTimeout.NoTimeout
    if idle_ms:
        slim = slim.withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", f"{idle_ms} milliseconds")
        timeout = GroupStateTimeout.EventTimeTimeout
    return slim.groupBy("session_id").applyInPandasWithState(step, CHANGE, HELD, "update", timeout)
