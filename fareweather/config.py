"""Settings shared by every job. Frozen, so a plan can never change them."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta


@dataclass(frozen=True)
class Settings:
    """Zones, valid window, thresholds and size limits of one run."""

    # Time-zone contract: declared once, passed everywhere.
    trip_source_tz: str = "America/New_York"
    reporting_tz: str = "America/New_York"
    weather_source_tz: str = "UTC"

    # Valid pickup window [min, max), midnights in window_tz.
    min_valid_ts: str = "2024-01-01"
    max_valid_ts: str = "2024-02-01"
    window_tz: str = "UTC"

    # Plausibility window of the timestamp contract, UTC, [min, max).
    plausible_min: str = "2009-01-01"
    plausible_max: str = "2030-01-01"

    # Rule thresholds.
    max_duration_seconds: int = 86_400
    max_distance_miles: float = 500.0
    max_passengers: int = 6
    max_total_amount: float = 1000.0
    unknown_zones: tuple[int, ...] = (264, 265)
    fare_tolerance: float = 0.01

    # Hourly conditions.
    wet_from_mm: float = 0.5
    band_edges_mm: tuple[float, float, float] = (0.5, 2.5, 7.6)

    # Report filters.
    min_dry_baseline: float = 5.0
    min_observations: int = 10
    min_revenue_trips: int = 1000

    # Sizes. A side is broadcast only when it is known to have at most
    # broadcast_rows rows and broadcast_bytes; above that the join deals keys that hold
    # more than a task's share of the rows over as many tasks. A duplicate group above hot_group_rows unlike rows is
    # ranked by several tasks if groups are looked at, which takes a job before the plan. Up to task_rows
    # rows are one task's work, whatever their groups.
    broadcast_bytes: int = 64 * 1024 * 1024
    broadcast_rows: int = 500_000
    hot_keys: int = 1000
    task_rows: int = 500_000
    hot_group_rows: int = 2_000_000
    look_for_hot_groups: bool = False

    @property
    def zone_years(self) -> tuple[int, int]:
        """Years that the valid window, padded for any zone, can touch."""
        return (
            (date.fromisoformat(self.min_valid_ts) - timedelta(days=2)).year,
            (date.fromisoformat(self.max_valid_ts) + timedelta(days=2)).year,
        )

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


DEFAULTS = Settings()
