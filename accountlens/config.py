"""Every tunable number of the pipeline in one place."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Time windows. ``as_of_date`` is an ISO date or "today".
    as_of_date: str = "2026-07-27"
    lookback_days: int = 30
    trend_days: int = 7

    # Thresholds a signal has to pass before it is actionable.
    min_vendor_confidence: float = 0.70
    min_attribution_confidence: float = 0.70
    usage_surge_threshold: float = 0.25

    # Org links: what an unknown link source is worth, and the low-confidence cut.
    unknown_link_confidence: float = 0.30
    unknown_link_precedence: int = 99
    low_confidence_below: float = 0.70

    # Company matches: how agreement and contradiction move the base confidence.
    corroboration_bonus: float = 0.05
    contradiction_penalty: float = 0.20
    confidence_cap: float = 0.99
    specific_token_length: int = 4

    # Confidence of signals that carry none of their own.
    default_vendor_confidence: float = 0.80
    automation_signal_confidence: float = 0.90
    intent_signal_confidence: float = 0.30

    def as_of(self) -> dt.date | None:
        """The frozen as-of date, or None when it is the current date."""
        if self.as_of_date.lower() in ("today", "current_date"):
            return None
        return dt.date.fromisoformat(self.as_of_date)


DEFAULTS = Settings()
