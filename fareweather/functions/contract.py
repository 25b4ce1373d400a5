"""The timestamp contract: any raw timestamp to UTC, local time and a reason.

Nothing raises and nothing is dropped. Each row gets one reason code, and only
``ok`` and ``ok_ambiguous_dst_fallback`` rows carry a UTC value:

* text that is no timestamp is ``unparseable``;
* text with an offset is converted, not read as local time;
* a wall clock that the zone skipped is ``nonexistent_local_time_dst_gap``;
* a wall clock that the zone showed twice is valid, takes the first occurrence
  and says so;
* a UTC value outside [min, max) is ``out_of_plausible_range``.

All of it is built-in column expressions in one projection: no Python worker and
no shuffle. Formats are decided row by row, so one column may mix them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULTS
from . import dateforms
from .offsets import Years
from .timecols import add_seconds, computed_once, from_instant, local_to_utc, ntz, utc_to_local

# Reason codes.
OK = "ok"
OK_AMBIGUOUS = "ok_ambiguous_dst_fallback"
UNPARSEABLE = "unparseable"
NONEXISTENT = "nonexistent_local_time_dst_gap"
OUT_OF_RANGE = "out_of_plausible_range"
NULL_INPUT = "null"

# Result parts, in order.
PARTS = ("utc", "local", "is_valid", "reason")

REASONS = (OK, OK_AMBIGUOUS, UNPARSEABLE, NONEXISTENT, OUT_OF_RANGE, NULL_INPUT)

# Usual text, in upper case. A slashed date is month first unless its first
# number can be no month. ``dateforms`` brings other forms to these.
_CLOCK = r"\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
_NAIVE = rf"^\d{{4}}([-/])\d{{1,2}}\1\d{{1,2}}([ T]{_CLOCK}( ?[AP]M)?)?$"
_AWARE = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[ T]{_CLOCK} ?(Z|UTC|[+-]\d{{2}}(:?\d{{2}})?)$"
_DAY_FIRST = r"^(1[3-9]|2\d|3[01])/(0?[1-9]|1[0-2])/"
_YEAR_LAST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"

# How far on either side of an instant its zone's offset is looked at. Changes are
# months apart, so three hours sees the one change and no other.
_PROBE_SECONDS = 3 * 3600


def _read(df: DataFrame, column: str, wall: str, aware: str) -> DataFrame:
    """Attach the naive reading of a column and, for what has an offset, its UTC; one of them at most."""
    raw, dtype = F.col(column), df.schema[column].dataType
    nothing = F.lit(None).cast("timestamp_ntz")
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return df.withColumns({wall: raw.cast("timestamp_ntz"), aware: nothing})
    if isinstance(dtype, T.TimestampType):
        return df.withColumns({wall: nothing, aware: from_instant(raw)})

    text, half, upper, shape = (F.col(f"{wall}_{x}") for x in ("text", "half", "upper", "shape"))
    out = df.withColumn(f"{wall}_upper", F.upper(F.trim(raw.cast("string"))))
    year_first = F.regexp_replace(F.regexp_replace(upper, _DAY_FIRST, "$2/$1/"), _YEAR_LAST, "$3-$1-$2")
    out = out.withColumn(f"{wall}_text", F.when(F.contains(upper, F.lit("/")), year_first).otherwise(upper))
    # Other written forms are looked up by their shape and rewritten; the usual ones have none.
    naive, zoned = F.col(f"{wall}_naive"), F.col(f"{wall}_zoned")
    out = out.withColumn(f"{wall}_naive", text.rlike(_NAIVE)).withColumn(f"{wall}_zoned", F.when(~naive, text.rlike(_AWARE)))
    out = computed_once(out, {f"{wall}_shape": F.when(~zoned, F.expr(dateforms.shaped(f"`{wall}_upper`")))})
    out = dateforms.with_iso_text(out, f"{wall}_other", f"`{wall}_upper`", f"`{wall}_shape`")
    other = F.col(f"{wall}_other")
    # An operator of its own, or the compiled code of all steps would be too long to be optimised.
    out = computed_once(out, {
        f"{wall}_text": F.when(shape.isNull(), text).otherwise(other),
        f"{wall}_naive": F.when(shape.isNull(), naive).otherwise(other.rlike(_NAIVE)),
        f"{wall}_zoned": F.when(shape.isNull(), zoned).otherwise(other.rlike(_AWARE)),
    })

    ending = F.right(text, F.lit(2))
    out = out.withColumn(f"{wall}_half", F.when(ending.isin("AM", "PM"), ending))
    clock = F.when(half.isNull(), text).otherwise(F.rtrim(F.substr(text, F.lit(1), F.length(text) - 2)))
    read = F.when(naive, F.replace(clock, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"))
    colon = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    out = out.withColumns({wall: read, aware: F.when(zoned, from_instant(colon.try_cast("timestamp")))})
    out = out.drop(*[f"{wall}_{x}" for x in ("shape", "other", "upper", "naive", "zoned")])

    # Twelve-hour clocks: 12 AM is midnight, 1 PM is thirteen, and 13 PM is nothing.
    hour = F.hour(wall)
    shift = F.when(half.isNull(), F.lit(0)).when(
        hour.between(1, 12), F.when(half == "PM", F.lit(12)).otherwise(F.lit(0)) - F.when(hour == 12, 12).otherwise(0)
    )
    return out.withColumn(wall, F.timestamp_add("HOUR", shift, F.col(wall))).drop(f"{wall}_text", f"{wall}_half")


def in_gap(wall: Column, utc: Column, tz: str, years: Years | None = None) -> Column:
    """True when the zone never showed this wall clock."""
    if tz == "UTC":
        return F.lit(False)
    return wall.isNotNull() & (utc_to_local(utc, tz, years) != wall)


def in_overlap(wall: Column, utc: Column, tz: str, years: Years | None = None) -> Column:
    """True when the zone showed this wall clock twice.

    Local time then runs less than six hours between three hours before and three
    hours after, and the instant later by what is missing has the same wall clock.
    """
    if tz == "UTC":
        return F.lit(False)
    expected = add_seconds(utc_to_local(add_seconds(utc, -_PROBE_SECONDS), tz, years), 2 * _PROBE_SECONDS)
    later = utc_to_local(add_seconds(utc, _PROBE_SECONDS), tz, years)
    second = utc + (expected - later)
    return wall.isNotNull() & (later < expected) & (utc_to_local(second, tz, years) == wall)


def reason_code(raw: Column, utc: Column, gap: Column, overlap: Column, low: Column, high: Column) -> Column:
    return (
        F.when(raw.isNull(), F.lit(NULL_INPUT))
        .when(utc.isNull(), F.lit(UNPARSEABLE))
        .when(gap, F.lit(NONEXISTENT))
        .when((utc < low) | (utc >= high), F.lit(OUT_OF_RANGE))
        .when(overlap, F.lit(OK_AMBIGUOUS))
        .otherwise(F.lit(OK))
    )


def add_normalised(
    df: DataFrame,
    column: str,
    source_tz: str,
    *,
    prefix: str | None = None,
    min_ts: str = DEFAULTS.plausible_min,
    max_ts: str = DEFAULTS.plausible_max,
    years: Years | None = DEFAULTS.zone_years,
) -> DataFrame:
    """Attach ``{prefix}_utc``, ``_local``, ``_is_valid`` and ``_reason``.

    Existing columns stay. The prefix defaults to the column's name.
    """
    name = prefix or column
    tmp = {k: f"__{name}_{k}" for k in ("wall", "aware", "u", "inside", "gap", "overlap")}
    wall, aware, u = F.col(tmp["wall"]), F.col(tmp["aware"]), F.col(tmp["u"])

    out = _read(df, column, tmp["wall"], tmp["aware"])
    out = out.withColumn(tmp["u"], F.coalesce(aware, local_to_utc(wall, source_tz, years)))
    # Columns of their own: one big expression would be too long for the JIT compiler.
    # An overlap matters for an instant in range only; the look-ups of others see null.
    low, high = ntz(min_ts), ntz(max_ts)
    out = out.withColumn(tmp["inside"], F.when((u >= low) & (u < high), u))
    out = out.withColumns(
        {
            tmp["gap"]: in_gap(wall, u, source_tz, years),
            tmp["overlap"]: in_overlap(wall, F.col(tmp["inside"]), source_tz, years),
        }
    )
    reason = reason_code(F.col(column), u, F.col(tmp["gap"]), F.col(tmp["overlap"]), low, high)
    out = computed_once(out, {tmp["u"]: u, f"{name}_reason": reason})
    valid = F.col(f"{name}_reason").isin(OK, OK_AMBIGUOUS)
    out = out.withColumns(
        {
            f"{name}_utc": F.when(valid, u),
            f"{name}_local": F.when(valid, utc_to_local(u, source_tz, years)),
            f"{name}_is_valid": valid,
        }
    )
    attached = [f"{name}_{part}" for part in PARTS]
    kept = [c for c in df.columns if c not in attached]
    return out.select(*kept, *attached)


def normalise(
    df: DataFrame,
    column: str,
    source_tz: str,
    *,
    min_ts: str = DEFAULTS.plausible_min,
    max_ts: str = DEFAULTS.plausible_max,
    years: Years | None = DEFAULTS.zone_years,
) -> DataFrame:
    """Only the four results, named ``utc``, ``local``, ``is_valid`` and ``reason``."""
    attached = add_normalised(df.select(column), column, source_tz, prefix="_n", min_ts=min_ts, max_ts=max_ts, years=years)
    return attached.select(*[F.col(f"_n_{part}").alias(part) for part in PARTS])


def add_utc(
    df: DataFrame, column: str, source_tz: str, name: str, years: Years | None = DEFAULTS.zone_years
) -> DataFrame:
    """Only the UTC value as ``name``: null where the contract finds no instant.

    Equal to the full contract without its plausibility window, at less work.
    """
    wall, aware, u = F.col("_wall"), F.col("_aware"), F.col("_u")
    shifted = _read(df, column, "_wall", "_aware").withColumn("_u", local_to_utc(wall, source_tz, years))
    exact = F.coalesce(aware, F.when(utc_to_local(u, source_tz, years) == wall, u))
    return shifted.withColumn(name, exact).drop("_wall", "_aware", "_u")


def reason_counts(df: DataFrame, reason_column: str) -> DataFrame:
    """Rows per reason code."""
    return df.groupBy(F.col(reason_column).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
