"""Parameters of the event-time report."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ReportRules:
    """Window size, watermark delay and allowed lateness in milliseconds; how times are read.

    ``zone`` is that of the time texts; without one it is the session's.
    """

    window_ms: int = 60_000
    delay_ms: int = 10_000
    lateness_ms: int = 30_000
    lenient_time: bool = True
    zone: str | None = None
