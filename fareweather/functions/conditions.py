"""Hourly-condition and trip expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from .timecols import as_column

# Precipitation bands from the mildest to the worst.
BANDS = ("dry", "trace", "light", "moderate", "heavy")


def precipitation_band(mm: Column | str, settings: Settings = DEFAULTS) -> Column:
    """Band of an hour; an unknown amount counts as dry."""
    known = F.coalesce(as_column(mm), F.lit(0.0))
    trace, light, moderate = settings.band_edges_mm
    return (
        F.when(known == 0, F.lit(BANDS[0]))
        .when(known < trace, F.lit(BANDS[1]))
        .when(known < light, F.lit(BANDS[2]))
        .when(known < moderate, F.lit(BANDS[3]))
        .otherwise(F.lit(BANDS[4]))
    )


def _place(value: Column, names: tuple[str, ...]) -> Column:
    """0-based place of a text in ``names``, null for none."""
    place = F.lit(None).cast("int")
    for i, name in enumerate(names):
        place = F.when(value == name, F.lit(i)).otherwise(place)
    return place


def _name(place: Column, names: tuple[str, ...]) -> Column:
    name = F.lit(None).cast("string")
    for i, text in enumerate(names):
        name = F.when(place == i, F.lit(text)).otherwise(name)
    return name


def band_severity(band: Column | str) -> Column:
    """0 (dry) to 4 (heavy), null for no band."""
    return _place(as_column(band), BANDS)


def greatest_band(band: Column | str) -> Column:
    """Aggregate: the greatest band name by text order, not by severity.

    A place in that order is an int, which the hash aggregate can hold and text cannot.
    """
    by_text = tuple(sorted(BANDS))
    return _name(F.max(_place(as_column(band), by_text)), by_text)


def worst_band(band: Column | str) -> Column:
    """Aggregate: the most severe band."""
    return _name(F.max(band_severity(band)), BANDS)


def is_wet(mm: Column | str, settings: Settings = DEFAULTS) -> Column:
    return F.coalesce(as_column(mm), F.lit(0.0)) >= F.lit(settings.wet_from_mm)


def is_snowing(cm: Column | str) -> Column:
    return F.coalesce(as_column(cm), F.lit(0.0)) > 0


def speed_mph(miles: Column | str, seconds: Column | str) -> Column:
    """Null unless the trip lasted."""
    seconds = as_column(seconds)
    return F.when(seconds > 0, as_column(miles) / (seconds / F.lit(3600.0)))


def percent_of(part: Column, total: Column, digits: int = 2) -> Column:
    """100 * part / total, 0 when the total is 0."""
    return F.round(F.coalesce(F.try_divide(F.lit(100.0) * part, total), F.lit(0.0)), digits)


def amount_parts(amount: Column | str, name: str) -> dict[str, Column]:
    """What a row adds to sums and means of an amount: columns that may be merged by ``merged_parts`` any number of times.

    Amounts are added up as decimals, so that a result on the edge of two roundings does not
    depend on the order in which tasks finish. Those that are not finite or have over twelve digits
    before the point are odd: a group with one gets the result of its doubles.
    """
    value = as_column(amount).cast("double")
    fits = F.abs(value) < F.lit(1e12)
    return {
        f"{name}_exact": F.when(fits, value.cast("decimal(24,8)")),
        f"{name}_plain": value,
        f"{name}_known": value.isNotNull().cast("bigint"),
        f"{name}_odd": F.coalesce(~fits, F.lit(False)),
    }


def merged_parts(name: str) -> list[Column]:
    """Aggregates: the parts of a group from those of its members."""
    return [
        F.sum(f"{name}_exact").cast("decimal(30,8)").alias(f"{name}_exact"), F.sum(f"{name}_plain").alias(f"{name}_plain"),
        F.sum(f"{name}_known").alias(f"{name}_known"), F.bool_or(f"{name}_odd").alias(f"{name}_odd"),
    ]


def sum_of_parts(name: str, digits: int = 2) -> Column:
    """Aggregate: rounded sum of an amount."""
    exact = F.round(F.sum(f"{name}_exact"), digits).cast("double")
    return F.when(F.bool_or(f"{name}_odd"), F.round(F.sum(f"{name}_plain"), digits)).otherwise(exact)


def mean_of_parts(name: str, digits: int = 2) -> Column:
    """Aggregate: rounded mean of an amount."""
    known = F.sum(f"{name}_known")
    exact = F.round(F.try_divide(F.sum(f"{name}_exact").cast("decimal(30,8)"), known.cast("decimal(20,0)")), digits).cast("double")
    return F.when(F.bool_or(f"{name}_odd"), F.round(F.try_divide(F.sum(f"{name}_plain"), known), digits)).otherwise(exact)


def mean_amount(amount: Column | str, digits: int = 2) -> Column:
    """Aggregate: rounded mean of an amount, the same in whatever order its rows come; see ``amount_parts``."""
    value = as_column(amount).cast("double")
    fits = F.abs(value) < F.lit(1e12)
    exact = F.round(F.avg(F.when(fits, value).cast("decimal(24,8)")), digits).cast("double")
    return F.when(F.bool_or(~fits), F.round(F.avg(value), digits)).otherwise(exact)


def sum_amount(amount: Column | str, digits: int = 2) -> Column:
    """Aggregate: rounded sum of an amount, the same in whatever order its rows come; see ``amount_parts``."""
    value = as_column(amount).cast("double")
    fits = F.abs(value) < F.lit(1e12)
    exact = F.round(F.sum(F.when(fits, value).cast("decimal(24,8)")), digits).cast("double")
    return F.when(F.bool_or(~fits), F.round(F.sum(value), digits)).otherwise(exact)


def short_label(text: Column | str, length: int = 20) -> Column:
    return F.substring(as_column(text), 1, length)


def rounded_int(value: Column | str) -> Column:
    """To int, rounding a fraction half to even; null for what is no number.

    Infinity and NaN go through a string cast so that ANSI mode does not raise.
    """
    return F.rint(as_column(value).try_cast("double")).try_cast("int")
