"""DuckDB SQL for the engine's queries, over the sample tables."""

_SOURCE = r"""
WITH src AS (
  SELECT CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k, user_id, event_type AS et, epoch_us(ts) // 1000 AS ts_ms,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id
  FROM events),
raw AS (
  SELECT k AS content_id, session_id, CAST(user_id AS VARCHAR) AS user_id, ts_ms,
         CASE et WHEN 'signup' THEN 'VideoSessionStart' WHEN 'purchase' THEN 'VideoSessionEnd' WHEN 'error' THEN 'AppBackgrounded'
                 WHEN 'click' THEN 'AppForegrounded' WHEN 'view' THEN 'VideoHeartbeat' END AS event_type,
         CASE WHEN et = 'view' THEN ['beat', 'pause', 'resume', 'AdPause', 'AdResume', 'BufferStart', 'BufferEnd'][k % 7 + 1] ELSE et END AS event,
         ['ANDROID_PHONE', 'IPHONE', 'Android_Tab ', 'FIRE_TV', 'Mweb', 'MWEB', 'Web', 'WEB', 'HTML_TV', 'ANDROID_TV'][k % 10 + 1] AS platform0,
         n.n_name AS country, ['en-US', 'hi-IN', 'TA', '', NULL][k % 5 + 1] AS audio, ['en-US', 'hi-IN', 'TA', '', NULL][(k + 2) % 5 + 1] AS subtitle,
         ['1920*1080', '1280 * 720', '0-854*480', 'NA-426*240', 'DataSaver-256*144', '3840*2160', '960*540', 'NA', '', NULL, '0*0'][k % 11 + 1] AS resolution
  FROM src LEFT JOIN nation n ON n.n_nationkey = src.user_id % 25),
ev AS (
  SELECT raw.*, upper(trim(platform0)) AS platform, coalesce(nullif(p.p_type, ''), 'unk') AS video_type, coalesce(nullif(p.p_brand, ''), 'unk') AS show_name,
         CASE event_type WHEN 'VideoSessionStart' THEN 1 WHEN 'VideoSessionEnd' THEN -1 WHEN 'AppBackgrounded' THEN 0 WHEN 'AppForegrounded' THEN 1
              ELSE CASE WHEN event = 'Play' THEN 1 END END AS fg,
         CASE WHEN event IN ('pause', 'speed-pause', 'AdPause') THEN 0 WHEN event IN ('resume', 'speed-resume', 'AdResume', 'Play') THEN 1
              WHEN event_type = 'AppBackgrounded' THEN 0 WHEN event_type IN ('AppForegrounded', 'VideoSessionStart') THEN 1
              WHEN event_type = 'VideoSessionEnd' THEN -1 END AS eng,
         nullif(replace(resolution, ' ', ''), '') AS video_resolution,
         least(nullif(try_cast(regexp_extract(resolution, '(\d+)\s*\*\s*(\d+)', 1) AS INT), 0), nullif(try_cast(regexp_extract(resolution, '(\d+)\s*\*\s*(\d+)', 2) AS INT), 0)) AS side,
         CASE WHEN side >= 2160 THEN '4K' WHEN side >= 1080 THEN '1080p' WHEN side >= 720 THEN '720p' WHEN side >= 540 THEN '540p' WHEN side >= 480 THEN '480p'
              WHEN side >= 360 THEN '360p' WHEN side >= 240 THEN '240p' WHEN side >= 1 THEN 'below_240p' ELSE 'unk' END AS tier
  FROM raw LEFT JOIN part p ON p.p_partkey = raw.content_id),
dim AS (
  SELECT session_id, min({'t': ts_ms, 'v': platform}).v AS platform, min({'t': ts_ms, 'v': country}).v AS country, min({'t': ts_ms, 'v': video_type}).v AS video_type,
         min({'t': ts_ms, 'v': show_name}).v AS show_name, min({'t': ts_ms, 'v': content_id}).v AS content_id, min({'t': ts_ms, 'v': user_id}).v AS user_id,
         min({'t': ts_ms, 'v': tier}).v AS resolution_tier, (min({'t': ts_ms, 'v': video_resolution}) FILTER (video_resolution IS NOT NULL)).v AS video_resolution,
         min(ts_ms) AS session_start_ms, max(ts_ms) AS last_seen_ms,
         CAST(bool_or(event_type = 'VideoSessionEnd') AS INT) AS has_close, CAST(bool_or(event_type = 'VideoSessionStart') AS INT) AS has_start
  FROM ev GROUP BY session_id),
beat AS (
  SELECT session_id, ts_ms, min(CODE) AS st, lag(ts_ms) OVER s AS prev_ts, lead(ts_ms) OVER s AS next_ts
  FROM ev GROUP BY session_id, ts_ms WINDOW s AS (PARTITION BY session_id ORDER BY ts_ms)),
step AS (
  SELECT b.session_id, ts_ms, least(st, CASE WHEN ts_ms - prev_ts > 7200000 THEN 1 END, CASE WHEN prev_ts IS NULL AND has_start = 0 THEN 1 END) AS st, false AS synthetic_end
  FROM beat b JOIN dim USING (session_id)
  UNION ALL
  SELECT b.session_id, ts_ms + 7200000, CASE WHEN next_ts - ts_ms > 7200000 THEN 0 WHEN next_ts IS NULL AND has_close = 0 THEN -1 END, next_ts IS NULL
  FROM beat b JOIN dim USING (session_id)),
turn AS (SELECT * FROM (SELECT *, lag(st) OVER (PARTITION BY session_id ORDER BY ts_ms) AS before FROM step WHERE st IS NOT NULL) WHERE st IS DISTINCT FROM before),
iv AS (
  SELECT t.session_id, t.ts_ms AS start_ms, t.stop AS end_ms, platform, country, video_type, show_name, content_id, resolution_tier, video_resolution,
         1 - has_close AS is_open, CAST(last_synthetic AS INT) AS is_provisional
  FROM (SELECT *, lead(ts_ms) OVER s AS stop, lead(synthetic_end) OVER s AS last_synthetic FROM turn WINDOW s AS (PARTITION BY session_id ORDER BY ts_ms)) t
  JOIN dim USING (session_id) WHERE st = 1 AND stop > t.ts_ms),
ma AS (SELECT * EXCLUDE (m), m AS minute_id FROM (SELECT *, unnest(range((start_ms + 59999) // 60000, (end_ms + 59999) // 60000)) AS m FROM iv)),
mb AS (
  SELECT DISTINCT session_id, m AS minute_id, platform, country, video_type, show_name, content_id, resolution_tier
  FROM (SELECT *, unnest(range(start_ms // 60000, (end_ms - 1) // 60000 + 1)) AS m FROM iv)),
isle AS (SELECT *, minute_id - row_number() OVER (PARTITION BY session_id ORDER BY minute_id) AS isle FROM mb),
runs AS (
  SELECT session_id, platform, country, video_type, show_name, content_id, min(minute_id) AS start_minute, max(minute_id) + 1 AS end_minute
  FROM isle GROUP BY session_id, isle, platform, country, video_type, show_name, content_id),
g AS (
  SELECT minute_id, platform, country, video_type, show_name, content_id, count(DISTINCT session_id) FILTER (kind = 'a') AS cnt_a, count(DISTINCT session_id) FILTER (kind = 'b') AS cnt_b
  FROM (SELECT 'a' AS kind, session_id, minute_id, platform, country, video_type, show_name, content_id FROM ma
        UNION ALL SELECT 'b', session_id, minute_id, platform, country, video_type, show_name, content_id FROM mb)
  GROUP BY minute_id, platform, country, video_type, show_name, content_id),
c AS (SELECT minute_id, CAST(sum(cnt_a) AS BIGINT) AS c FROM g GROUP BY minute_id),
da AS (SELECT unnest([(start_ms + 59999) // 60000, (end_ms + 59999) // 60000]) AS minute_id, unnest([1, -1]) AS d, platform, country, video_type, show_name, content_id FROM iv),
db AS (SELECT unnest([start_minute, end_minute]) AS minute_id, unnest([1, -1]) AS d, platform, country, video_type, show_name, content_id FROM runs),
net AS (SELECT minute_id, CAST(sum(d) AS BIGINT) AS delta FROM da GROUP BY minute_id),
cur AS (SELECT minute_id, delta, CAST(sum(delta) OVER (ORDER BY minute_id) AS BIGINT) AS live FROM net)
"""
_FG, _ENG = _SOURCE.replace("CODE", "fg"), _SOURCE.replace("CODE", "eng")
_DIMS = "platform, country, video_type, show_name, content_id"
_IV = f"SELECT session_id, start_ms, end_ms, {_DIMS}, is_open, is_provisional FROM iv"
_RANGE = "minute_id BETWEEN 28416666 AND 28426666"


def _peak(where: str = "true", by: str = "", metric: str = "cnt_a") -> str:
    first, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {first}max(c) AS peak, avg(c) AS avg_observed, max({{'c': c, 'm': -minute_id}}).m * -1 AS peak_minute
    FROM (SELECT {first}minute_id, CAST(sum({metric}) AS BIGINT) AS c FROM g WHERE {where} GROUP BY {first}minute_id) {group}"""


def _sensitivity() -> str:
    parts = []
    for w in (1000, 60000, 300000):
        for metric, low, high in (("cnt_a", f"(start_ms + {w - 1}) // {w}", f"(end_ms + {w - 1}) // {w}"), ("cnt_b", f"start_ms // {w}", f"(end_ms - 1) // {w} + 1")):
            touch = f"SELECT DISTINCT session_id, m FROM (SELECT session_id, unnest(range({low}, {high})) AS m FROM iv)"
            if w == 1000:  # too many seconds to unfold
                span = f"SELECT session_id, greatest({low}, coalesce(max({high}) OVER (PARTITION BY session_id ORDER BY start_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lo, {high} AS hi FROM iv"
                sweep = f"SELECT t, sum(d) AS d FROM (SELECT unnest([lo, hi]) AS t, unnest([1, -1]) AS d FROM ({span}) WHERE hi > lo) GROUP BY t"
                parts.append(f"SELECT CAST({w} AS BIGINT) AS bucket_ms, '{metric}' AS metric, CAST(max(live) AS BIGINT) AS peak FROM (SELECT sum(d) OVER (ORDER BY t) AS live FROM ({sweep}))")
            else:
                parts.append(f"SELECT CAST({w} AS BIGINT) AS bucket_ms, '{metric}' AS metric, max(n) AS peak FROM (SELECT m, count(*) AS n FROM ({touch}) GROUP BY m)")
    return " UNION ALL ".join(parts)


_SWEEP = "SELECT t, CAST(sum(sum(d)) OVER (ORDER BY t) AS BIGINT) AS live FROM (SELECT unnest([start_ms, end_ms]) AS t, unnest([1, -1]) AS d FROM iv) GROUP BY t"
_LANGUAGE = "coalesce(nullif(split_part(lower({0}), '-', 1), ''), 'unk')"

_BODIES = {
    "normalize_events": "SELECT session_id, user_id, content_id, ts_ms, platform, country, video_type, show_name, event, event_type, fg AS st FROM ev",
    "session_dim": f"SELECT session_id, {_DIMS}, user_id, session_start_ms, last_seen_ms, has_close, has_start FROM dim",
    "gap_transitions": "SELECT session_id, prev_ts + 7200000 AS ts_ms, 0 AS st FROM beat WHERE ts_ms - prev_ts > 7200000 UNION ALL SELECT session_id, ts_ms, 1 FROM beat WHERE ts_ms - prev_ts > 7200000",
    "transitions_all": "SELECT session_id, ts_ms, st FROM step WHERE st IS NOT NULL",
    "watermark_close": "SELECT session_id, last_seen_ms + 7200000 AS ts_ms, -1 AS st FROM dim WHERE has_close = 0",
    "watermark_open": "SELECT session_id, session_start_ms AS ts_ms, 1 AS st FROM dim WHERE has_start = 0",
    "active_intervals": _IV,
    "active_intervals_strict": """SELECT session_id, start_ms, end_ms FROM (
        SELECT *, min(ts_ms) FILTER (st = -1) OVER (PARTITION BY session_id) AS closed, ts_ms AS start_ms, lead(ts_ms) OVER (PARTITION BY session_id ORDER BY ts_ms) AS end_ms FROM turn)
        WHERE st = 1 AND end_ms > start_ms AND (closed IS NULL OR start_ms < closed)""",
    "session_state_arrays": """SELECT session_id, string_agg(DISTINCT CAST(ts_ms AS VARCHAR), ',' ORDER BY CAST(ts_ms AS VARCHAR)) AS live_ts,
        coalesce(string_agg(DISTINCT CAST(ts_ms AS VARCHAR) || ':' || CAST(fg AS VARCHAR), ',' ORDER BY CAST(ts_ms AS VARCHAR) || ':' || CAST(fg AS VARCHAR)) FILTER (fg IS NOT NULL), '') AS changes
        FROM ev GROUP BY session_id""",
    "session_minutes_a": f"SELECT session_id, minute_id, {_DIMS} FROM ma",
    "session_minutes_b": f"SELECT session_id, minute_id, {_DIMS} FROM mb",
    "merged_runs": f"SELECT session_id, {_DIMS}, start_minute, end_minute FROM runs",
    "g1_minute": "SELECT * FROM g",
    "g1_minute_fullouter": "SELECT * FROM g",
    "g1_minute_by_tier": """SELECT minute_id, platform, resolution_tier, CAST(sum(a) AS BIGINT) AS cnt_a, CAST(sum(b) AS BIGINT) AS cnt_b
        FROM (SELECT minute_id, platform, resolution_tier, 1 AS a, 0 AS b FROM ma UNION ALL SELECT minute_id, platform, resolution_tier, 0, 1 FROM mb) GROUP BY ALL""",
    "g2_delta_a": f"SELECT minute_id, {_DIMS}, CAST(sum(d) AS BIGINT) AS delta, 'a' AS delta_kind FROM da GROUP BY minute_id, {_DIMS}",
    "g2_delta_b": f"SELECT minute_id, {_DIMS}, CAST(sum(d) AS BIGINT) AS delta, 'b' AS delta_kind FROM db GROUP BY minute_id, {_DIMS}",
    "g2_curve": "SELECT minute_id, delta, live FROM cur",
    "g1_g2_crosscheck": """SELECT (SELECT max(c) FROM c) AS g1_peak, (SELECT max(live) FROM cur) AS g2_peak,
        (SELECT count(*) FROM (SELECT unnest(range((SELECT min(minute_id) FROM cur), (SELECT max(minute_id) + 1 FROM cur))) AS m) s
         ASOF LEFT JOIN cur ON s.m >= cur.minute_id LEFT JOIN c ON c.minute_id = s.m WHERE coalesce(c.c, 0) <> coalesce(cur.live, 0)) AS n_differ""",
    "peak_avg": _peak(),
    "peak_avg_filtered": _peak(f"{_RANGE} AND platform IN ('MWEB', 'WEB') AND country LIKE '%A%'", metric="cnt_b"),
    "peak_last_hour": _peak("minute_id >= (SELECT max(minute_id) - 60 FROM g) AND platform LIKE '%ANDROID%'"),
    "peak_hour_grain": f"SELECT minute_id // 60 AS bucket, max(c) AS peak, avg(c) AS avg_observed FROM c WHERE {_RANGE} GROUP BY bucket",
    "peak_day_grain": "SELECT (minute_id + 330) // 1440 AS bucket, max(c) AS peak, avg(c) AS avg_observed FROM c GROUP BY bucket",
    "peak_by_platform": _peak(by="platform"),
    "peak_by_content": _peak(by="content_id"),
    "concurrency_curve": "SELECT minute_id, c FROM c",
    "dense_curve": "SELECT m AS minute_id, coalesce(c, 0) AS c FROM (SELECT unnest(range((SELECT min(minute_id) FROM g), (SELECT max(minute_id) + 1 FROM g))) AS m) LEFT JOIN c ON minute_id = m",
    "avg_filled": "SELECT CAST(sum(c) AS BIGINT) / (max(minute_id) - min(minute_id) + 1) AS avg_filled, max(minute_id) - min(minute_id) + 1 AS n_minutes FROM c",
    "reach_range": "SELECT count(DISTINCT session_id) AS sessions FROM iv WHERE start_ms < 1705600000000 AND end_ms > 1705000000000 AND platform = 'WEB'",
    "exact_peak": f"SELECT max(live) AS exact_peak, max({{'l': live, 't': -t}}).t * -1 AS at_ms FROM ({_SWEEP})",
    "exact_peak_bounded": f"SELECT max(live) AS exact_peak FROM ({_SWEEP})",
    "bucket_sensitivity": _sensitivity(),
    "open_sessions": "SELECT session_id, platform, content_id, start_ms, end_ms, is_open FROM iv WHERE is_open = 1 ORDER BY end_ms DESC, session_id, start_ms LIMIT 50",
    "decline_alerts": "SELECT minute_id, c, prev_c, (c - prev_c) / prev_c AS change FROM (SELECT *, lag(c) OVER (ORDER BY minute_id) AS prev_c FROM c) WHERE prev_c > 0 AND (c - prev_c) / prev_c < -0.3",
    "gap_histogram": """SELECT CASE WHEN gap <= 5400000 THEN '3600000-5400000' WHEN gap <= 7200000 THEN '5400000-7200000' ELSE '7200000-14400000' END AS bucket, count(*) AS n
        FROM (SELECT ts_ms - prev_ts AS gap FROM beat) WHERE gap > 3600000 AND gap <= 14400000 GROUP BY bucket""",
    "range_peak_listed": _peak("minute_id IN (28416700, 28417000, 28420000)"),
    "g2_windowed_read": f"SELECT minute_id, live FROM cur WHERE {_RANGE}",
    "drilldown_at": "SELECT session_id, start_ms, end_ms, platform FROM iv WHERE start_ms <= 1705000000000 AND end_ms > 1705000000000",
    "dup_boundary_audit": """SELECT event_type, count(*) FILTER (n > 1) AS sessions_with_repeats FROM (
        SELECT session_id, event_type, count(*) AS n FROM ev WHERE event_type IN ('VideoSessionStart', 'VideoSessionEnd') GROUP BY session_id, event_type) GROUP BY event_type""",
    "error_audit": """SELECT count(*) AS sessions_with_error, count(*) FILTER (l > e) AS sessions_going_on FROM (
        SELECT min(ts_ms) FILTER (event_type = 'AppBackgrounded') AS e, max(ts_ms) FILTER (event_type <> 'AppBackgrounded') AS l FROM ev GROUP BY session_id) WHERE e IS NOT NULL""",
    "platform_switch_audit": "SELECT session_id, count(DISTINCT platform) AS n_values FROM ev GROUP BY session_id HAVING count(DISTINCT platform) > 1",
    "time_range": "SELECT min(minute_id) AS first_minute, max(minute_id) AS last_minute FROM g",
    "resolution_tier": "SELECT resolution AS video_resolution, tier, count(*) AS n FROM ev GROUP BY ALL",
    "raw_resolution_sessions": "SELECT count(DISTINCT session_id) AS sessions FROM iv WHERE video_resolution = '1920*1080'",
    "lang_normalize": f"SELECT {_LANGUAGE.format('audio')} AS audio, {_LANGUAGE.format('subtitle')} AS subtitle, count(*) AS n FROM ev GROUP BY ALL",
    "signal_classify": """SELECT CASE WHEN event IN ('pause', 'AdPause') THEN 'STATE_INACTIVE' WHEN event IN ('resume', 'AdResume') THEN 'STATE_ACTIVE'
        WHEN event_type = 'AppBackgrounded' THEN 'STATE_INACTIVE' WHEN event_type = 'AppForegrounded' THEN 'STATE_ACTIVE'
        WHEN event_type = 'VideoSessionStart' THEN 'SESSION_OPEN' WHEN event_type = 'VideoSessionEnd' THEN 'SESSION_CLOSE' ELSE 'LIVENESS' END AS signal,
        CASE event WHEN 'BufferStart' THEN 1 WHEN 'BufferEnd' THEN 2 ELSE 0 END AS buffer, count(*) AS n FROM ev GROUP BY ALL""",
    "replacing_latest": "SELECT user_id, session_id, ts_ms, content_id, event_type FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, content_id, event_type) = 1",
    "summing_fold": "SELECT platform, minute_id // 60 AS hour_id, CAST(sum(d) AS BIGINT) AS delta FROM da GROUP BY ALL",
    "semi_touched": "SELECT session_id, count(*) AS n FROM ev WHERE session_id IN (SELECT session_id FROM ev WHERE ts_ms >= 1705000000000) GROUP BY session_id",
    "g1_refresh": "SELECT count(*) AS n_rows, CAST(sum(cnt_a) AS BIGINT) AS a, CAST(sum(cnt_b) AS BIGINT) AS b, max(minute_id) AS last_minute FROM g",
    "peak_report": f"SELECT peak, round(avg_observed, 2) AS avg_rounded, strftime(make_timestamp(peak_minute * 60000000), '%Y-%m-%d %H:%M') AS peak_time FROM ({_peak()})",
    "peak_from_intervals": _peak("platform IN ('MWEB', 'WEB')", by="country"),
    "alive_windows": """SELECT session_id, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT b.session_id, b.ts_ms, e.n, count(*) FILTER (b.ts_ms - b.prev_ts > 7200000) OVER (PARTITION BY b.session_id ORDER BY b.ts_ms) AS island
        FROM beat b JOIN (SELECT session_id, ts_ms, count(*) AS n FROM ev GROUP BY ALL) e ON b.session_id = e.session_id AND b.ts_ms = e.ts_ms) GROUP BY session_id, island""",
    "active_at_each": """SELECT t AS instant_ms, count(iv.session_id) AS sessions FROM (SELECT unnest(range(1705000000000, 1705600000000, 7200000)) AS t)
        LEFT JOIN iv ON iv.start_ms <= t AND iv.end_ms > t GROUP BY t""",
    "routed_deltas": """SELECT platform, target, CAST(sum(abs(d)) AS BIGINT) AS moves FROM (
        SELECT 'a' AS target, platform, sum(d) AS d FROM da GROUP BY minute_id, platform, country, video_type, show_name, content_id
        UNION ALL SELECT 'b', platform, sum(d) FROM db GROUP BY minute_id, platform, country, video_type, show_name, content_id) GROUP BY platform, target""",
    "events_by_month": "SELECT CAST(strftime(make_timestamp(ts_ms * 1000), '%Y%m') AS INT) AS month, count(*) AS n FROM ev GROUP BY ALL",
    "minmax_by_pins": "SELECT session_id, min({'t': ts_ms, 'v': platform}).v AS first_platform, max({'t': ts_ms, 'v': platform}).v AS last_platform FROM ev GROUP BY session_id",
}
_BODIES["session_state_view"] = f"SELECT * FROM ({_BODIES['session_state_arrays']}) WHERE changes <> ''"
_DEFINED = "SELECT '{0}' AS defn, session_id, start_ms, end_ms FROM iv"
ORACLES = {name: f"{_FG} {body}" for name, body in _BODIES.items()} | {"active_intervals_eng": f"{_ENG} {_IV}"}
ORACLES["active_intervals_both"] = f"SELECT * FROM ({_FG} {_DEFINED.format('FG')}) UNION ALL SELECT * FROM ({_ENG} {_DEFINED.format('ENG')})"
