"""Limits of a run, checked when they are built."""

from __future__ import annotations

from dataclasses import dataclass, fields

# Allowed range of every limit.
_RANGES = {
    "max_request_bytes": (1024, 50 * 1024 * 1024),
    "max_batch_items": (1, 10_000),
    "max_json_depth": (1, 32),
    "max_lookup_depth": (1, 10),
    "max_requests_per_second": (1, 5000),
    "rate_limit_retry_delay_seconds": (5, 900),
    "failure_min_calls": (3, 100),
    "failure_window_seconds": (10, 300),
    "max_deliveries": (1, 1000),
}


@dataclass(frozen=True)
class Options:
    max_request_bytes: int = 10 * 1024 * 1024
    max_batch_items: int = 1000
    max_json_depth: int = 32
    max_lookup_depth: int = 3
    max_requests_per_second: int = 300
    rate_limit_retry_delay_seconds: int = 300
    failure_min_calls: int = 10
    failure_window_seconds: int = 60
    failure_ratio: float = 0.5
    # How often a queued message is tried before it is set aside.
    max_deliveries: int = 10

    def __post_init__(self) -> None:
        for f in fields(self):
            if f.name not in _RANGES:
                continue
            low, high = _RANGES[f.name]
            value = getattr(self, f.name)
            if not low <= value <= high:
                raise ValueError(f"{f.name} must be between {low} and {high}, got {value}")
        if not 0 < self.failure_ratio <= 1:
            raise ValueError(f"failure_ratio must be in (0, 1], got {self.failure_ratio}")
