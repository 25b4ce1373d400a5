"""Data-quality rules as data: flags, validity, quarantine, counts.

A rule is a name, a predicate and whether it is hard. Flags are added and rows
are never dropped; a row is valid when no hard rule holds. SQL's three-valued
logic is kept: a hard rule that cannot be decided makes validity unknown, and
unknown rows are quarantined as ``dq_undetermined``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions.conditions import sum_amount
from ..functions.timecols import window_bound

UNDETERMINED = "dq_undetermined"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Callable[[Settings], Column]
    hard: bool = False


def _outside_window(s: Settings) -> Column:
    low, high = window_bound(s.min_valid_ts, s.window_tz), window_bound(s.max_valid_ts, s.window_tz)
    return (F.col("pickup_utc") < low) | (F.col("pickup_utc") >= high)


def _either_zone_unknown(s: Settings) -> Column:
    return F.col("pickup_zone_id").isin(*s.unknown_zones) | F.col("dropoff_zone_id").isin(*s.unknown_zones)


# Flag names and their meaning.
TRIP_RULES: tuple[Rule, ...] = (
    Rule("dq_pickup_unparseable", lambda s: F.col("pickup_utc").isNull(), hard=True),
    Rule("dq_dropoff_unparseable", lambda s: F.col("dropoff_utc").isNull(), hard=True),
    Rule("dq_non_positive_duration", lambda s: F.col("dropoff_utc") <= F.col("pickup_utc"), hard=True),
    Rule("dq_duration_exceeds_24h", lambda s: F.col("duration_seconds") > s.max_duration_seconds, hard=True),
    Rule("dq_pickup_out_of_range", _outside_window, hard=True),
    Rule("dq_zero_distance_paid", lambda s: (F.col("trip_distance_miles") <= 0) & (F.col("fare_amount") > 0)),
    Rule("dq_implausible_distance", lambda s: F.col("trip_distance_miles") > s.max_distance_miles, hard=True),
    Rule("dq_no_passengers", lambda s: F.coalesce(F.col("passenger_count"), F.lit(0)) == 0),
    Rule("dq_negative_total", lambda s: F.col("total_amount") < 0),
    Rule("dq_unknown_zone", _either_zone_unknown),
    Rule("dq_duplicate_row", lambda s: F.col("_dupe_rank") > 1, hard=True),
)


def add_flags(df: DataFrame, rules: Sequence[Rule] = TRIP_RULES, settings: Settings = DEFAULTS) -> DataFrame:
    """One nullable boolean column per rule."""
    return df.withColumns({r.name: r.predicate(settings) for r in rules})


def add_validity(df: DataFrame, rules: Sequence[Rule] = TRIP_RULES, name: str = "is_valid") -> DataFrame:
    """True when no hard rule holds, null when that cannot be decided."""
    broken = F.lit(False)
    for rule in rules:
        if rule.hard:
            broken = broken | F.col(rule.name)
    return df.withColumn(name, ~broken)


def failure_reason(rules: Sequence[Rule] = TRIP_RULES) -> Column:
    """Names of the hard rules that hold, joined by commas; null for a valid row."""
    held = F.concat_ws(",", *[F.when(F.col(r.name), F.lit(r.name)) for r in rules if r.hard])
    return F.when(held != "", held).when(F.col("is_valid").isNull(), F.lit(UNDETERMINED))


def quarantine(df: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """Every row that is not valid, with its ``failure_reason``."""
    return df.where(~F.col("is_valid").eqNullSafe(F.lit(True))).withColumn("failure_reason", failure_reason(rules))


def long_form(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """A one-row frame of counters as (name, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(c).cast("bigint").alias(value)) for c in columns]
    )
    return one_row.select(F.inline(pairs))


def rule_counters(rules: Sequence[Rule] = TRIP_RULES) -> dict[str, Column]:
    """Aggregates: rows of every flag, the valid rows and the undecided rows."""
    counters = {r.name: F.count_if(F.col(r.name)) for r in rules}
    return counters | {"is_valid": F.count_if("is_valid"), UNDETERMINED: F.count_if(F.col("is_valid").isNull())}


def rule_counts(df: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """(rule, rows) for every flag, the valid rows and the undecided rows, in one pass."""
    counters = rule_counters(rules)
    one_row = df.agg(*[c.alias(n) for n, c in counters.items()])
    return long_form(one_row, list(counters), "rule", "rows")


def run_metrics(df: DataFrame, run_id: str, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """(run_id, metric, rows) of one run: rows in, passed, quarantined, and rows per rule; one pass."""
    passed = F.count_if("is_valid")
    counters = {
        "rows_in": F.count(F.lit(1)),
        "rows_passed": passed,
        "rows_quarantined": F.count(F.lit(1)) - passed,
        **{r.name: F.count_if(F.col(r.name)) for r in rules},
    }
    one_row = df.agg(*[c.alias(n) for n, c in counters.items()])
    return long_form(one_row, list(counters), "metric", "rows").select(F.lit(run_id).alias("run_id"), "*")


def revenue_by_reason(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Rows and amount per failure reason; ``valid`` and the reasons add up to all rows."""
    reason = F.coalesce(failure_reason(), F.lit("valid"))
    return df.groupBy(reason.alias("failure_reason")).agg(
        F.count(F.lit(1)).alias("rows"), sum_amount(amount).alias("revenue")
    )


def run_drift(runs: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Change of each run's row count against the run before, per layer.

    ``runs`` has ``layer``, ``run_date`` and ``rows_in``, one small row per run. An
    alert is a drop of at least ``threshold``.
    """
    before = F.lag("rows_in").over(Window.partitionBy("layer").orderBy("run_date"))
    change = F.try_divide(F.col("rows_in") - F.col("rows_before"), F.col("rows_before"))
    return (
        runs.withColumn("rows_before", before)
        .withColumn("relative_change", F.round(change, 4))
        .withColumn("is_alert", F.coalesce(change <= -threshold, F.lit(False)))
    )
