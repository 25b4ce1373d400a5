"""Zone offsets as comparisons.

``convert_timezone`` looks a zone's rules up for every row, which is the dearest
expression of the whole job. Within a given span of years a zone changes its
offset a few times only, so the span's changes, read from the zone database when
the plan is built, become a balanced tree of comparisons. Timestamps outside the
span still go through ``convert_timezone``; both give the same values.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

Years = tuple[int, int]  # first and last year, both inside


def literal(moment: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S}'")


@lru_cache(maxsize=256)
def offset_changes(tz: str, years: Years) -> tuple[int, tuple[tuple[datetime, int, int], ...]]:
    """Offset at the start of the span, and each change as (UTC, before, after), in seconds."""
    zone = ZoneInfo(tz)

    def at(utc: datetime) -> int:
        return int(utc.replace(tzinfo=timezone.utc).astimezone(zone).utcoffset().total_seconds())

    # Two days more on either side cover every zone's shift.
    moment = datetime(years[0], 1, 1) - timedelta(days=2)
    end = datetime(years[1] + 1, 1, 1) + timedelta(days=2)
    first = last = at(moment)
    changes = []
    while moment < end:
        following = moment + timedelta(hours=6)
        now = at(following)
        if now != last:
            low, high = moment, following
            while high - low > timedelta(seconds=1):
                middle = low + timedelta(seconds=int((high - low).total_seconds()) // 2)
                low, high = (middle, high) if at(middle) == last else (low, middle)
            changes.append((high, last, now))
        moment, last = following, now
    return first, tuple(changes)


def _tree(value: Column, bounds: list[datetime], offsets: list[int]) -> Column:
    """offsets[i] where bounds[i-1] <= value < bounds[i]."""
    if not bounds:
        return F.lit(offsets[0])
    middle = len(bounds) // 2
    return F.when(
        value < literal(bounds[middle]), _tree(value, bounds[:middle], offsets[: middle + 1])
    ).otherwise(_tree(value, bounds[middle + 1 :], offsets[middle + 1 :]))


def within(value: Column, years: Years) -> Column:
    return (value >= literal(datetime(years[0], 1, 1))) & (value < literal(datetime(years[1] + 1, 1, 1)))


def offset_at_utc(utc: Column, tz: str, years: Years) -> Column:
    """Local minus UTC in seconds at an instant inside the span."""
    first, changes = offset_changes(tz, years)
    return _tree(utc, [t for t, _, _ in changes], [first, *[after for _, _, after in changes]])


def offset_at_wall(wall: Column, tz: str, years: Years) -> Column:
    """The same at a wall clock: the earlier offset in an overlap and in a gap."""
    first, changes = offset_changes(tz, years)
    bounds = [t + timedelta(seconds=max(before, after)) for t, before, after in changes]
    return _tree(wall, bounds, [first, *[after for _, _, after in changes]])
