"""The business constants, as parameters with their usual values."""

from __future__ import annotations

from dataclasses import dataclass

FIRST_CLICK = "first_click"
LAST_CLICK = "last_click"
MODELS = (FIRST_CLICK, LAST_CLICK)
# Width of the pieces that a user's time line is scanned in.
SLICE_SECONDS = 60


@dataclass(frozen=True)
class Params:
    """One place for every value a user may want to change."""

    conversion_event: str = "purchase"
    lookback_days: int = 30
    slice_seconds: int = SLICE_SECONDS
    report_days: int = 14
    live_rows: int = 25
    stream_pattern: str = "stream_user%"
    warn_minutes: int = 15
    error_minutes: int = 60
