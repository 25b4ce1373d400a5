"""Months: parameters, padded windows, what is still to land, the hourly spine."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import add_seconds, hour_floor, iso_minutes
from . import files

# Fixed value: the month format.
MONTH_FORMAT = r"^\d{4}-\d{2}$"
#: Days of an hourly spine at most, some ninety years.
MOST_DAYS = 33_000


def parse_months(text: str) -> list[str]:
    """A comma list of ``YYYY-MM``; any other form is an error."""
    months = [m.strip() for m in text.split(",")]
    for m in months:
        if not re.match(MONTH_FORMAT, m) or not 1 <= int(m[5:]) <= 12:
            raise ValueError(f"invalid month {m!r}, expected YYYY-MM")
    return months


def month_frame(spark: SparkSession, months: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(m,) for m in months], "month STRING")


def months_of(df: DataFrame, ts: str) -> DataFrame:
    """Distinct months of a column as ``YYYY-MM``."""
    return df.where(F.col(ts).isNotNull()).select(F.substring(F.col(ts).cast("string"), 1, 7).alias("month")).distinct()


def padded_window(months: DataFrame) -> DataFrame:
    """Month to the day before it starts and the first day after it, both inclusive.

    The padding keeps a zone's offset from clipping an edge. Rows that are no
    month are left out.
    """
    first = F.concat("month", F.lit("-01")).try_cast("date")
    return months.where(F.col("month").rlike(MONTH_FORMAT) & first.isNotNull()).select(
        "month",
        F.date_sub(first, 1).alias("start_date"),
        F.add_months(first, 1).alias("end_date"),
    )


def missing_months(requested: DataFrame, landed: DataFrame, force: bool = False) -> DataFrame:
    """Requested months still to land; all of them when forced."""
    wanted = requested.select("month").distinct()
    return wanted if force else wanted.join(landed.select("month").distinct(), "month", "left_anti")


def land(spark: SparkSession, months: Sequence[str], files_of: str, landing: str, force: bool = False) -> list[str]:
    """Requested months from their files to the landing folder; the folders of all of them.

    ``files_of`` is a path with ``{month}`` in it. A month that landed before is left as it is, its files
    unread, unless forced.
    """
    asked = month_frame(spark, list(dict.fromkeys(months)))
    landed = month_frame(spark, [m for m in months if files.has_landed(spark, landing, m)])
    for row in missing_months(asked, landed, force).orderBy("month").collect():  # a row for each month asked for
        files.land_month(files.scan_union_by_name(spark, [files_of.format(month=row.month)], row="_ingested_row"), landing, row.month, force=True)
    return [f"{landing.rstrip('/')}/month={m}" for m in dict.fromkeys(months)]


def valid_window(months: Sequence[str]) -> tuple[str, str]:
    """The first day of the first month and the first day after the last, as texts."""
    last = date.fromisoformat(f"{max(months)}-01")
    after = date(last.year + last.month // 12, last.month % 12 + 1, 1)
    return f"{min(months)}-01", after.isoformat()


def in_padded_months(df: DataFrame, day: Column, months: Sequence[str]) -> DataFrame:
    """Rows whose day is in the padded window of any of the months, which reaches a scan as a range."""
    low, high = valid_window(months)
    return df.where((day >= F.date_sub(F.lit(low).cast("date"), 1)) & (day <= F.lit(high).cast("date")))


def hour_spine(bounds: DataFrame, low: str, high: str, most_days: int = MOST_DAYS) -> DataFrame:
    """Every hour from ``low`` to ``high`` of a one-row frame, with its text form.

    Days are made by a range over tasks, hours by each. A spine of more than ``most_days`` is refused: that is a wrong clock
    among the bounds, to be left out by the valid window first.
    """
    days = bounds.select(F.col(low).alias("_low"), F.col(high).alias("_high"), F.datediff(F.col(high).cast("date"), F.col(low).cast("date")).alias("_days"))
    wrong = F.raise_error(F.concat(F.lit("hour spine of "), F.col("_days").cast("string"), F.lit(" days")))
    steps = F.when(F.col("_days") > most_days, wrong.cast("int")).otherwise(F.col("_days"))
    each = days.select("_low", "_high", F.explode(F.sequence(F.lit(0), steps)).alias("_day"))
    start = F.date_add(F.col("_low").cast("date"), F.col("_day")).cast("timestamp_ntz")
    hours = each.repartition("_day").select("_low", "_high", F.explode(F.sequence(start, add_seconds(start, 23 * 3600), F.expr("INTERVAL 1 HOUR"))).alias("hour_utc"))
    hours = hours.where((F.col("hour_utc") >= hour_floor("_low")) & (F.col("hour_utc") <= F.col("_high"))).select("hour_utc")
    return hours.withColumn("observed_at_raw", iso_minutes("hour_utc"))


def fill_hours(spine: DataFrame, counted: DataFrame, hour: str, count: str) -> DataFrame:
    """The spine with a count per hour, 0 where nothing happened."""
    matched = counted.select(F.col(hour).alias("hour_utc"), F.col(count))
    return spine.join(matched, "hour_utc", "left").withColumn(count, F.coalesce(F.col(count), F.lit(0)).cast("bigint"))
