from dataclasses import replace

import pytest
from cases import BASE, CASES, KINDS, SUB, events, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.config import EngineConfig
from tidemark.functions import columns as C
from tidemark.operators import audits, minutes, sessions, tables
from tidemark.plans import query as Q
from tidemark.plans import registry
from tidemark.sources import files
from tidemark.sources.schema import CONTENT, EVENTS
from tidemark.streaming.machine import intervals_of, minutes_of

CONFIG = EngineConfig()
DIMS = CONFIG.dims


def normal(spark, cases, config=CONFIG):
    raw = spark.createDataFrame(rows(cases), EVENTS)
    return sessions.normalize_events(raw, spark.createDataFrame([(1, "t", "", "c", "s"), (1, "t", "", "c", "s")], CONTENT), config)


def found(spark, cases, config=CONFIG):
    out = {name: [] for name in cases}
    for r in sessions.active_intervals(normal(spark, cases, config), config).orderBy("start_ms").collect():
        out[r["session_id"]].append(((r["start_ms"] - BASE) / 1000, (r["end_ms"] - BASE) / 1000))
    return out


@pytest.fixture(scope="module")
def intervals(spark):
    return sessions.active_intervals(normal(spark, CASES), CONFIG).persist()


def test_golden_intervals(spark):
    assert found(spark, CASES) == {k: [(float(a), float(b)) for a, b in v] for k, (_, v) in CASES.items()}


def test_definitions(spark):
    case = {"F20": ("S0 p20 r40 E60", None)}
    assert found(spark, case)["F20"] == [(0, 60)]
    assert found(spark, case, replace(CONFIG, definition="ENG"))["F20"] == [(0, 20), (40, 60)]


def test_flags(spark):
    strict = found(spark, CASES, replace(CONFIG, strict_close=True))
    assert strict["F11"] == [(0, 40)] and strict["F08"] == [(0, 20), (40, 70)]
    assert found(spark, CASES, replace(CONFIG, gap_reopen_requires_active=True))["F19"] == [(0, 30)]
    assert found(spark, CASES, replace(CONFIG, gap_reopen_requires_active=True))["F03"] == [(0, 540), (660, 720)]
    assert found(spark, CASES, replace(CONFIG, watermark_open=False))["F17"] == []


def test_order_and_repeats_do_not_matter(spark):
    shuffled = {k: (" ".join(reversed(text.split() * 2)), v) for k, (text, v) in CASES.items()}
    assert found(spark, shuffled) == found(spark, CASES)


def test_open_flags(spark, intervals):
    flags = {(r["session_id"], r["is_open"], r["is_provisional"]) for r in intervals.collect()}
    assert ("F16", 1, 0) in flags and ("F17", 1, 1) in flags and ("F06", 0, 0) in flags


def test_minutes(intervals):
    base = BASE // 60_000
    for kind, name, expected in (("a", "F05A", [1, 2, 3]), ("b", "F05A", [1, 2, 3]), ("a", "F05B", [3]), ("b", "F05B", [2, 3]), ("a", "F09", []), ("b", "F09", [0]), ("b", "F01", [1, 2, 3, 10, 11, 14, 22, 23]), ("a", "F01", [1, 2, 3, 11, 14, 22, 23])):
        got = minutes.session_minutes(intervals, kind).where(F.col("session_id") == name).collect()
        assert sorted(r["minute_id"] - base for r in got) == expected, (kind, name)


def test_models_agree(intervals):
    gold = minutes.occupancy(intervals, DIMS)
    assert sorted(gold.collect()) == sorted(minutes.occupancy_by_join(intervals, DIMS).select(gold.columns).collect())
    for metric, kind, peak, average in (("cnt_a", "a", 15, 4.2142857), ("cnt_b", "b", 17, 4.5714286)):
        r = Q.ConcurrencyQuery(metric).peak(gold).first()
        assert r["peak"] == peak and abs(r["avg_observed"] - average) < 1e-6
        assert minutes.curve(minutes.deltas(intervals, DIMS, kind)).agg(F.max("live")).first()[0] == peak
    assert Q.crosscheck(gold, minutes.deltas(intervals, DIMS, "a")).first().asDict() == {"g1_peak": 15, "g2_peak": 15, "n_differ": 0}
    assert Q.exact_peak(intervals).first()["exact_peak"] == 16
    assert Q.exact_peak_bounded(intervals, gold).first()["exact_peak"] == 16
    assert minutes.deltas(intervals, DIMS, "b").agg(F.sum("delta")).first()[0] == 0


def test_full_outer_join_meets_before_minutes_are_unfolded(intervals):
    some = intervals.withColumn("country", F.when(F.col("session_id") != "F01", F.col("country")))
    for dims in (DIMS, ("country",), ()):
        a, b = (minutes.session_minutes(some, k).groupBy("minute_id", *dims).count() for k in "ab")
        want = {tuple(r)[:-1]: [0, r["count"]] for r in b.collect()}
        for r in a.collect():
            want[tuple(r)[:-1]][0] = r["count"]
        got = minutes.occupancy_by_join(some, dims)
        assert sorted(map(str, got.collect())) == sorted(str(Row(**dict(zip(got.columns, [*k, *n], strict=True)))) for k, n in want.items())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(sequence(") == 1 and plan.index("explode(sequence(") < plan.index("FullOuter")


def test_sensitivity(intervals):
    peaks = {(r["bucket_ms"], r["metric"]): r["peak"] for r in Q.bucket_sensitivity(intervals).collect()}
    assert peaks[60_000, "cnt_a"] == 15 and peaks[60_000, "cnt_b"] == 17 and peaks[1_000, "cnt_a"] <= 16 <= peaks[1_000, "cnt_b"]


def test_resolution_tiers(spark):
    cases = {"1920*1080": "1080p", "1920 * 1080": "1080p", "1080*1920": "1080p", "640*360": "360p", "0-1280*720": "720p", "Auto-854*480": "480p", "NA-426*240": "240p", "DataSaver-256*144": "below_240p", "3840*2160": "4K", "960*540": "540p", "NA": "unk", "": "unk", "0*0": "unk", "0*720": "720p"}
    df = spark.createDataFrame([*[(k,) for k in cases], (None,)], "r string").select("r", C.resolution_tier(F.col("r")).alias("t"))
    assert {r["r"]: r["t"] for r in df.collect()} == {**cases, None: "unk"}


def test_empty(spark):
    none = normal(spark, {"F02": CASES["F02"]}).where("false")
    assert sessions.active_intervals(none).count() == 0
    gold = minutes.occupancy(sessions.active_intervals(none), DIMS)
    assert gold.count() == 0 and Q.ConcurrencyQuery().peak(gold).first()["peak"] is None
    assert Q.exact_peak_bounded(sessions.active_intervals(none), gold).first()["exact_peak"] == 0


def test_one_exchange(spark):
    plan = sessions.active_intervals(spark.createDataFrame([("s", 1, 1, "VideoSessionStart", "a", "b", "c", "d", 1)], "session_id string, ts_ms long, st int, event_type string, platform string, country string, video_type string, show_name string, content_id long"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_audits(spark):
    ev = normal(spark, CASES)
    assert {r["event_type"]: r["sessions_with_repeats"] for r in audits.repeated_edges(ev).collect()} == {KINDS["S"]: 1, KINDS["E"]: 1}
    assert tuple(audits.after_errors(ev).first()) == (1, 1)
    assert audits.changing(ev).count() == 0
    assert audits.gap_histogram(ev).where("bucket = '50000-60000'").first()["n"] > 0


def test_tables(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, v int, x string")
    assert sorted(r["x"] for r in tables.latest(df, ["k"], "v", ["x"]).collect()) == ["b", "c"]
    assert sorted(map(tuple, tables.folded(df, ["k"], "v").collect())) == [(1, 3), (2, 1)]


def test_files(spark, intervals, tmp_path):
    raw = spark.createDataFrame(rows(CASES), EVENTS)
    files.append_events(raw, f"{tmp_path}/events")
    files.append_events(raw, f"{tmp_path}/events")
    assert files.read_events(spark, f"{tmp_path}/events").count() == 2 * raw.count()
    raw.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{tmp_path}/csv")
    assert sorted(files.read_csv_events(spark, f"{tmp_path}/csv").collect(), key=repr) == sorted(raw.collect(), key=repr)
    gold = minutes.occupancy(intervals, DIMS)
    files.write_minutes(gold, f"{tmp_path}/gold")
    base = BASE // 60_000
    part = files.read_minutes(spark, f"{tmp_path}/gold", base + 1, base + 3)
    assert part.count() == gold.where(F.col("minute_id").between(base + 1, base + 3)).count()
    assert "PartitionFilters: [isnotnull(minute_date" in part._jdf.queryExecution().executedPlan().toString()


def test_first_version_of_csv(spark, tmp_path):
    (tmp_path / "old.csv").write_text("content_id,video_session_id,event_type,event,event_timestamp,platform,session_start_epoch,_offset\n1,s,VideoHeartbeat,x,1700000000000,web,1700000000000,7\n")
    (tmp_path / "new.csv").write_text("video_resolution,video_session_id,content_id\n1920*1080,s,2\n")
    old, new = (files.read_csv_events(spark, f"{tmp_path}/{n}.csv") for n in ("old", "new"))
    assert old.schema == new.schema == EVENTS
    assert old.first().asDict() | {"video_resolution": None, "content_id": 1, "event_timestamp": 1_700_000_000_000} == old.first().asDict()
    assert (new.first()["video_resolution"], new.first()["content_id"], new.first()["event"]) == ("1920*1080", 2, None)
    (tmp_path / "content.csv").write_text("content_id,title,video_type,category\n1,t,v,c\n")
    assert files.read_csv_content(spark, f"{tmp_path}/content.csv").first().asDict() == {"content_id": 1, "title": "t", "video_type": "v", "category": "c", "show_name": None}


def test_layouts(spark, intervals, tmp_path):
    import pyarrow.parquet as pq

    gold = minutes.occupancy(intervals, DIMS).withColumn("country", F.concat("country", F.pmod("minute_id", F.lit(7)).cast("string")))
    files.write_minutes(gold, f"{tmp_path}/gold")
    for path in (tmp_path / "gold").rglob("*.parquet"):  # sorted, and the statistics say so
        rows = pq.read_table(path).to_pylist()
        order = [(r["country"], r["video_type"], r["platform"], r["content_id"], r["minute_id"]) for r in rows]
        assert order == sorted(order)
        meta = pq.ParquetFile(path).metadata
        column = next(meta.row_group(0).column(i) for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "country")
        assert (column.statistics.min, column.statistics.max) == (order[0][0], order[-1][0])
    raw = spark.range(50_000).selectExpr("1L AS content_id", "concat('v', id) AS app_version", "1700000000000 AS session_start_epoch").withColumns({f.name: F.lit(None).cast(f.dataType) for f in EVENTS if f.name not in ("content_id", "app_version", "session_start_epoch")})
    files.append_events(raw.select(EVENTS.names), f"{tmp_path}/events")
    # a value between the least and the largest one that isn't there: the Bloom filter keeps all rows from being read
    read = spark.read.option("parquet.filter.dictionary.enabled", "false").parquet(f"{tmp_path}/events")
    scanned = []
    for column, value in (("app_version", "v123"), ("app_version", "v12345x")):
        execution = read.where(F.col(column) == value)._jdf.queryExecution()
        execution.toRdd().count()
        scanned.append(execution.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value())
    assert scanned[0] > 0 and scanned[1] == 0


def test_shared_folders(spark, tmp_path):
    from types import SimpleNamespace as N

    from tidemark.sources import folders

    # a cluster without a shared folder: it fails rather than take a folder of one machine
    sc = N(isLocal=lambda: False, getCheckpointDir=lambda: N(isEmpty=lambda: True))
    far = N(sparkContext=N(_jsc=N(sc=lambda: sc), getConf=lambda: N(get=lambda key: None)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        folders.checkpoint_folder(far)
    path = folders.shared_folder(spark, "x")
    assert path.startswith(folders.checkpoint_folder(spark)) and folders.exists(spark, path)
    folders.remove(spark, path)
    assert not folders.exists(spark, path)


def test_served_tables(spark, sf_dir):
    from tidemark.plans import served

    first = served.served(spark, sf_dir, registry.CONFIG)
    assert served.served(spark, sf_dir, registry.CONFIG) is first
    gold = first.minutes(spark)
    totals = gold.groupBy("minute_id").agg(F.sum("cnt_a").alias("cnt_a"), F.sum("cnt_b").alias("cnt_b"))
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, first.totals(spark).select("minute_id", "cnt_a", "cnt_b").collect()))
    part = first.minutes(spark, registry.FIRST, registry.LAST)
    assert "PartitionFilters: [isnotnull(minute_date" in part._jdf.queryExecution().executedPlan().toString()
    assert served.refresh(spark, sf_dir, registry.CONFIG).folder != first.folder


def test_shuffles_grow_with_intervals_not_minutes(spark):
    """The exchanges of the minute table come before minutes are unfolded."""
    plan = minutes.occupancy(spark.createDataFrame([("s", 0, 10**9, "a")], "session_id string, start_ms long, end_ms long, platform string"), ("platform",))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("explode(sequence(") < text.index("Exchange")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("SEBGHX"), st.integers(0, 400)), min_size=1, max_size=12))
def test_machine_properties(session):
    code = {"S": 1, "E": -1, "B": 0, "G": 1}
    ev = [(t * 1000, code.get(k), k == "E", k == "S") for k, t in session]
    spans = intervals_of(ev)
    assert spans == intervals_of([*reversed(ev), *ev])
    assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans[:-1], spans[1:], strict=True))
    a, b = minutes_of(spans)
    assert a <= b


def test_machine_is_the_batch_plan(spark):
    import random

    r = random.Random(5)
    cases = {f"s{i}": (" ".join(f"{r.choice('SEBGHHHXpr')}{r.randrange(500)}" for _ in range(r.randrange(1, 14))), None) for i in range(400)}
    for config in (CONFIG, replace(CONFIG, definition="ENG", strict_close=True), replace(CONFIG, gap_reopen_requires_active=True, watermark_open=False)):
        got = found(spark, cases, config)
        for name, (text, _) in cases.items():
            ev = []
            for k, ms in events(text):
                sub = SUB.get(k, "x")
                code = {"S": 1, "E": -1, "B": 0, "G": 1}.get(k)
                if config.definition == "ENG" and sub != "x":
                    code = 0 if sub == "pause" else 1
                ev.append((ms, code, k == "E", k == "S"))
            assert got[name] == [((x - BASE) / 1000, (y - BASE) / 1000) for x, y in intervals_of(ev, config)], (text, config)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_against_sql(spark, sf_dir, name):
    from oracle import same

    same(spark, sf_dir, registry.queries()[name], registry.oracle_sql()[name])
