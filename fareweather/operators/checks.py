"""Table checks. Each returns the violations, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from .joins import sized_for_broadcast


class CheckFailed(ValueError):
    """A table breaks a check that later tables rely on."""


def is_missing(column: str, where: str | None = None) -> Column:
    """Condition of a violation: null, in the rows that ``where`` is true of."""
    return _where(where) & F.col(f"`{column}`").isNull()


def is_outside(column: str, low: float | None, high: float | None, where: str | None = None) -> Column:
    """Condition of a violation: not in [low, high]; null passes."""
    value, outside = F.col(f"`{column}`"), F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return _where(where) & F.coalesce(outside, F.lit(False))


def is_future(column: str, as_of: Column, where: str | None = None) -> Column:
    """Condition of a violation: later than ``as_of``."""
    return _where(where) & F.coalesce(F.col(f"`{column}`") > as_of, F.lit(False))


def _where(where: str | None) -> Column:
    return F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))


def counted(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(check_name, violations) of any number of checks, in one pass over the rows."""
    one_row = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(conditions)])
    return one_row.select(F.inline(pairs))


class Gate:
    """Checks counted while a table is written, by the write's own pass.

    ``watched`` is the table with its counters attached; after the write ``violations`` has
    them and ``demand`` raises if there are any. ``measures`` are further aggregates to keep.
    """

    def __init__(self, df: DataFrame, conditions: dict[str, Column], measures: dict[str, Column] | None = None):
        self.names, self.measured = list(conditions), list(measures or {})
        self.observation = Observation()
        counters = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())]
        kept = [m.alias(f"m{i}") for i, m in enumerate((measures or {}).values())]
        self.watched = df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *counters, *kept)

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    @property
    def violations(self) -> dict[str, int]:
        found = self.observation.get
        return {n: found[f"c{i}"] for i, n in enumerate(self.names)}

    @property
    def measures(self) -> dict:
        found = self.observation.get
        return {n: found[f"m{i}"] for i, n in enumerate(self.measured)}

    def demand(self, table: str) -> None:
        broken = {n: v for n, v in self.violations.items() if v}
        if broken:
            raise CheckFailed(f"{table}: " + ", ".join(f"{n} in {v} rows" for n, v in broken.items()))


def _scoped(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def unique(df: DataFrame, key: str, where: Column | str | None = None) -> DataFrame:
    """Keys that occur more than once, with their row count. Null keys are ignored."""
    return (
        _scoped(df, where).where(F.col(key).isNotNull())
        .groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    )


def not_null(df: DataFrame, columns: Sequence[str], where: Column | str | None = None) -> DataFrame:
    """(column_name, nulls) for each column that has nulls; all columns in one pass."""
    counted = _scoped(df, where).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    return counted.select(F.inline(pairs)).where(F.col("nulls") > 0)


def accepted_range(
    df: DataFrame, column: str, low: float | None, high: float | None, where: Column | str | None = None
) -> DataFrame:
    """Rows whose value is outside [low, high]; null passes."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return _scoped(df, where).where(outside)


def no_future(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Rows later than ``as_of``."""
    return df.where(F.col(column) > as_of)


def unmatched_hours(trips: DataFrame, weather: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Valid trips inside the observed span whose hour was not observed, per hour.

    Trips are counted per hour first: the anti-join then sees one row per hour.
    """
    hours, _ = sized_for_broadcast(
        weather.where("observed_hour_utc IS NOT NULL").select(F.col("observed_hour_utc").alias("pickup_hour_utc")),
        settings,
    )
    first = hours.agg(F.min("pickup_hour_utc")).scalar()
    last = hours.agg(F.max("pickup_hour_utc")).scalar()
    per_hour = trips.where("is_valid").groupBy("pickup_hour_utc").agg(F.count(F.lit(1)).alias("unmatched_trips"))
    inside = per_hour.where((F.col("pickup_hour_utc") >= first) & (F.col("pickup_hour_utc") <= last))
    return inside.join(hours, "pickup_hour_utc", "left_anti")


def freshness(
    df: DataFrame, loaded_at: str, as_of: Column, warn_hours: float = 24, error_hours: float = 48
) -> DataFrame:
    """One row: the latest load, its age in seconds, and pass, warn or error.

    A table without a load time is an error.
    """
    from ..functions.timecols import seconds_between

    age = seconds_between(F.col("latest"), as_of)
    status = (
        F.when(F.col("age_seconds") <= warn_hours * 3600, F.lit("pass"))
        .when(F.col("age_seconds") <= error_hours * 3600, F.lit("warn"))
        .otherwise(F.lit("error"))
    )
    return df.agg(F.max(loaded_at).alias("latest")).withColumn("age_seconds", age).withColumn("status", status)


def join_fanout(facts: DataFrame, dim: DataFrame, on: list[str], settings: Settings = DEFAULTS) -> DataFrame:
    """One row: rows before and after a left join, and how many the join added.

    Both counts come from keys grouped on each side, so a hot key is one row and
    the join itself is never run over the facts.
    """
    left = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_facts"))
    right = dim.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_matches"))
    matched = left.join(right, on, "left")
    return matched.agg(
        F.coalesce(F.sum("_facts"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum(F.col("_facts") * F.coalesce(F.col("_matches"), F.lit(1))), F.lit(0))
        .cast("bigint").alias("rows_after"),
    ).withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))


def violation_count(violations: DataFrame, check: str) -> DataFrame:
    """(check_name, violations), so that a pass is a row too."""
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check).alias("check_name"), "violations"
    )


def require_unique_hour(weather: DataFrame) -> DataFrame:
    """Hours that would multiply trips in the hour join."""
    return unique(weather, "observed_hour_utc")


__all__ = [
    "CheckFailed", "Gate", "accepted_range", "counted", "is_future", "is_missing", "is_outside", "freshness", "join_fanout", "no_future", "not_null",
    "require_unique_hour", "unique", "unmatched_hours", "violation_count",
]
