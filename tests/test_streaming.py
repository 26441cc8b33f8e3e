import random

from cases import CASES, rows
from pyspark.sql import functions as F
from test_engine import DIMS, normal

from tidemark.operators import minutes, sessions
from tidemark.sources import files
from tidemark.sources.schema import CONTENT, EVENTS
from tidemark.streaming.live import LiveMinutes, session_changes


def _batches(spark, path, cases, n=3, seed=1):
    raw = rows(cases)
    random.Random(seed).shuffle(raw)
    raw += raw[:10]
    for i in range(n):
        spark.createDataFrame(raw[i::n], EVENTS).coalesce(1).write.mode("append").parquet(path)


def _same(df, whole, columns):
    return sorted(df.select(columns).collect(), key=str) == sorted(whole.select(columns).collect(), key=str)


def _is_batch_result(live, ev):
    whole = sessions.active_intervals(ev)
    assert _same(live.minutes(), minutes.occupancy(whole, DIMS), ["minute_id", *DIMS, "cnt_a", "cnt_b"])
    both = minutes.deltas(whole, DIMS, "a").unionByName(minutes.deltas(whole, DIMS, "b")).where("delta <> 0")
    assert _same(live.deltas(), both, ["minute_id", *DIMS, "delta_kind", "delta"])
    assert _same(live.intervals(), whole, ["session_id", "start_ms", "end_ms", *DIMS, "is_open", "is_provisional"])


def test_batches_converge(spark, tmp_path):
    ev = normal(spark, CASES)
    live = LiveMinutes(spark, f"{tmp_path}/live", parts=4, compact_every=0)
    assert live.minutes().count() == 0 and live.deltas().count() == 0 and live.intervals() is None
    at = F.pmod(F.xxhash64("ts_ms", "session_id"), F.lit(3))
    ev = ev.withColumn("third", at).persist()
    for i in range(3):
        live.add(ev.where(F.col("third") == i).drop("third"), i)
    live.add(ev.where("third = 2").drop("third"), 2)  # a repeated batch counts once
    _is_batch_result(live, ev)
    live.compact(1)
    assert len(live._folders("minutes")) == 2 and len(live._folders("events")) == 2
    _is_batch_result(live, ev)
    live.add(ev.where("third = 0").drop("third"), 0)  # and so does one that is compacted
    live.compact(2)
    assert [x[:2] for x in live._folders("intervals")] == [(0, 2)]
    _is_batch_result(live, ev)


def test_stream_survives_restarts(spark, tmp_path):
    raw = rows(CASES)
    random.Random(4).shuffle(raw)
    halves = [raw[::2], raw[1::2] + raw[:5]]
    catalog = spark.createDataFrame([(1, "t", "", "c", "s")], CONTENT)
    for half in halves:
        for i in range(2):
            spark.createDataFrame(half[i::2], EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        # a new object and a new query go on where the last one stopped
        live = LiveMinutes(spark, f"{tmp_path}/live", parts=4, compact_every=3)
        live.start(sessions.normalize_events(files.stream_events(spark, f"{tmp_path}/in"), catalog), None).awaitTermination()
    _is_batch_result(live, normal(spark, CASES))
    assert [x[:2] for x in live._folders("minutes")] == [(0, 2), (3, 3)]


CODE = "CASE event_type WHEN 'VideoSessionStart' THEN 1 WHEN 'VideoSessionEnd' THEN -1 WHEN 'AppBackgrounded' THEN 0 WHEN 'AppForegrounded' THEN 1 END"


def _stateful(spark, tmp_path, idle_ms=None):
    """Minute counts that the stateful operator gives, and the sessions that it holds at the end."""
    stream = files.stream_events(spark, f"{tmp_path}/in")
    stream = stream.select(F.col("video_session_id").alias("session_id"), F.col("event_timestamp").alias("ts_ms"), "event_type", F.expr(CODE).alias("st"))
    out = session_changes(stream, idle_ms=idle_ms).writeStream.outputMode("update")
    out = out.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"))
    query = out.option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("minute_id").agg(F.sum("cnt_a").alias("a"), F.sum("cnt_b").alias("b")).where("a <> 0 OR b <> 0")
    return sorted(map(tuple, got.collect())), query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]


def _expected(spark, cases):
    gold = minutes.occupancy(sessions.active_intervals(normal(spark, cases)), DIMS)
    return sorted(map(tuple, gold.groupBy("minute_id").agg(F.sum("cnt_a").alias("a"), F.sum("cnt_b").alias("b")).collect()))


def test_stateful_stream_converges(spark, tmp_path):
    _batches(spark, f"{tmp_path}/in", CASES)
    got, held = _stateful(spark, tmp_path)
    assert got == _expected(spark, CASES) and held == len(CASES)


def test_stateful_stream_forgets_idle_sessions(spark, tmp_path):
    cases = {f"s{i}": (f"S{i * 1000} H{i * 1000 + 30} E{i * 1000 + 50}", None) for i in range(6)}
    for name, case in cases.items():
        spark.createDataFrame(rows({name: case}), EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got, held = _stateful(spark, tmp_path, idle_ms=300_000)
    assert got == _expected(spark, cases) and held < len(cases)
