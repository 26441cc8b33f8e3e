"""The state machine of one session in plain Python, for stateful streams; the batch plan gives the same intervals."""

from __future__ import annotations

from collections.abc import Iterable

from tidemark.config import MINUTE_MS, EngineConfig

#: Instant of an event, its state code or None, and whether it is a close or a start.
Event = tuple[int, "int | None", bool, bool]


def intervals_of(events: Iterable[Event], config: EngineConfig = EngineConfig()) -> list[tuple[int, int]]:
    """Active intervals of a session; the order of events and repeats don't matter."""
    codes: dict[int, int | None] = {}
    closes = starts = False
    for ts, code, is_close, is_start in events:
        old = codes.get(ts)
        codes[ts] = code if old is None else old if code is None else min(old, code)
        closes, starts = closes or is_close, starts or is_start
    steps: list[tuple[int, int]] = []
    times = sorted(codes)
    before: int | None = None
    for i, ts in enumerate(times):
        base = [c for c in (codes[ts], 1 if i == 0 and config.watermark_open and not starts else None) if c is not None]
        silent = i > 0 and ts - times[i - 1] > config.gap_ms
        code = base + ([1] if silent and (before == 1 or not config.gap_reopen_requires_active) else [])
        if code:
            steps.append((ts, min(code)))
        before = min(base) if base else before
        if i + 1 < len(times) and times[i + 1] - ts > config.gap_ms:
            steps.append((ts + config.gap_ms, 0))
        elif i + 1 == len(times) and not closes:
            steps.append((ts + config.gap_ms, -1))
    out, state, since = [], None, 0
    for ts, code in steps:
        if code == state:
            continue
        if state == 1 and ts > since:
            out.append((since, ts))
        if code == 1:
            since = ts
        state = code
        if code == -1 and config.strict_close:
            break
    return out


def minutes_of(intervals: Iterable[tuple[int, int]]) -> tuple[set[int], set[int]]:
    """Minutes of kind a and of kind b of a session's intervals."""
    a: set[int] = set()
    b: set[int] = set()
    for start, end in intervals:
        a.update(range(-(-start // MINUTE_MS), -(-end // MINUTE_MS)))
        b.update(range(start // MINUTE_MS, (end - 1) // MINUTE_MS + 1))
    return a, b
