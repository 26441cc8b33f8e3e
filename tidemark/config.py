"""Parameters of the engine."""

from __future__ import annotations

from dataclasses import dataclass, field

MINUTE_MS = 60_000


@dataclass(frozen=True)
class EngineConfig:
    """gap_ms: silence beyond which a session counts as inactive. definition: FG (foreground; a pause is active) or ENG (engaged; a
    pause is inactive). watermark_open: a session without a start event opens at its first event. strict_close: nothing
    reopens a session after its close. gap_reopen_requires_active: an event after silence reopens a session only if it was active
    before the silence. dims: dimensions pinned to each session. tz_offset_minutes: of hours and days."""

    gap_ms: int = 60_000
    definition: str = "FG"
    watermark_open: bool = True
    strict_close: bool = False
    gap_reopen_requires_active: bool = False
    dims: tuple[str, ...] = field(default=("platform", "country", "video_type", "show_name", "content_id"))
    tz_offset_minutes: int = 0

    def __post_init__(self) -> None:
        if self.definition not in ("FG", "ENG"):
            raise ValueError(f"definition must be FG or ENG, not {self.definition}")
        if self.gap_ms <= 0:
            raise ValueError("gap_ms must be positive")
