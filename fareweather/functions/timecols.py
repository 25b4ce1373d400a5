"""Time functions on naive timestamps.

Every instant is a ``timestamp_ntz`` that holds UTC and is named ``*_utc``; every
wall clock is a ``timestamp_ntz`` as well. Nothing here reads the session time
zone, so a job gives the same rows in any session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .offsets import Years, offset_at_utc, offset_at_wall, within

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ntz(text: str) -> Column:
    """A naive timestamp literal."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def local_to_utc(wall: Column | str, tz: str, years: Years | None = None) -> Column:
    """Wall clock in ``tz`` to UTC.

    An overlap hour gives its first occurrence; a skipped hour is shifted forward.
    ``years`` is the span that most values lie in, for which the offset needs no
    look-up; it never changes the result.
    """
    wall = as_column(wall)
    if tz == "UTC":
        return wall
    looked_up = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    if years is None:
        return looked_up
    return F.when(within(wall, years), add_seconds(wall, -offset_at_wall(wall, tz, years))).otherwise(looked_up)


def utc_to_local(utc: Column | str, tz: str, years: Years | None = None) -> Column:
    utc = as_column(utc)
    if tz == "UTC":
        return utc
    looked_up = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    if years is None:
        return looked_up
    return F.when(within(utc, years), add_seconds(utc, offset_at_utc(utc, tz, years))).otherwise(looked_up)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970, rounded down; built from parts, which no session zone moves."""
    ts = as_column(ts)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_micros(ts: Column | str) -> Column:
    ts = as_column(ts)
    fraction = F.extract(F.lit("SECOND"), ts) - F.second(ts)
    return epoch_seconds(ts) * 1_000_000 + (fraction * 1_000_000).cast("bigint")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from start to end (00.9 to 01.1 is 1)."""
    return epoch_seconds(end) - epoch_seconds(start)


def add_seconds(ts: Column | str, seconds: Column | int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds) if isinstance(seconds, int) else seconds, as_column(ts))


def floor_to(ts: Column | str, seconds: int) -> Column:
    """Start of the fixed-length slot (from the epoch) that holds ``ts``."""
    epoch = epoch_seconds(ts)
    return F.timestamp_add("SECOND", epoch - F.pmod(epoch, F.lit(seconds)), F.expr(_EPOCH))


def hour_floor(ts: Column | str) -> Column:
    ts = as_column(ts)
    hours = F.unix_date(ts.cast("date")) * 24 + F.hour(ts)
    return F.timestamp_add("HOUR", hours, F.expr(_EPOCH))


def day_floor(ts: Column | str) -> Column:
    return as_column(ts).cast("date").cast("timestamp_ntz")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(as_column(ts)).cast("int")


def day_of_week(ts: Column | str) -> Column:
    """Sunday is 0."""
    return (F.dayofweek(as_column(ts)) - F.lit(1)).cast("int")


def local_date(ts: Column | str) -> Column:
    return as_column(ts).cast("date")


def iso_minutes(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm`` text of a naive timestamp."""
    return F.substring(F.replace(as_column(ts).cast("string"), F.lit(" "), F.lit("T")), 1, 16)


def as_instant(utc: Column | str) -> Column:
    """UTC naive timestamp to ``timestamp``, which stream watermarks need."""
    return F.timestamp_micros(epoch_micros(utc))


def from_instant(instant: Column | str) -> Column:
    """``timestamp`` to a naive timestamp that holds UTC."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_column(instant)), F.expr(_EPOCH))


def window_bound(day: str, tz: str = "UTC") -> Column:
    """Midnight of ``day`` in ``tz`` as UTC, a constant of the plan."""
    return local_to_utc(ntz(f"{day} 00:00:00"), tz)


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Attach columns that later filters read instead of repeating their expressions.

    The optimizer moves a filter below a projection by writing the projection's
    expressions into it, as often as the filter names them. Zone conversions are
    too dear for that, and long ones outgrow the code generator. A one-element
    ``inline`` gives the same columns and keeps the filter above them.
    """
    parts = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(parts)))
