"""Parameters of the measures and of the corridor, with their usual values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MoeConfig:
    """gap_s: a longer pause starts a new trip. bin_minutes: None gives one period per link (the hourly measures). require_time: rows without a time are left out."""

    gap_s: float = 120.0
    slow_mph: float = 5.0
    bin_minutes: int | None = 5
    require_time: bool = True


FIVE_MINUTES = MoeConfig()
#: The hourly measures take one file as one period and don't ask for a time.
HOURLY = MoeConfig(bin_minutes=None, require_time=False)


@dataclass(frozen=True)
class CorridorConfig:
    """max_distance is in the units of the projection (metres), unless ``distance_unit`` is "us_ft"."""

    gap_s: float = 120.0
    max_links: int = 40
    max_distance: float = 100.0
    max_heading: float = 35.0
    start_link: str | None = None
    distance_unit: str = "crs"
