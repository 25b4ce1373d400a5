"""Full refresh of all layers into a folder, each layer read back from its files.

Writing a layer before the next reads it cuts lineage, gives the optimizer real
sizes, and lets every later question prune files by date. Checks are counted by the pass
that writes a table and judged before the table takes the place of the one before: a check that
fails stops the build there, and the layers after it stay as they were.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..operators import checks, rules
from ..operators.checks import CheckFailed, Gate, is_future, is_missing, is_outside
from ..sources import files, months
from . import marts, reports, staging

# Table names per layer.
TABLES = {
    "bronze": ("trips", "weather", "taxi_zones", "dq_report_header", "dq_report_findings"),
    "silver": ("stg_trips", "stg_weather", "silver_trips_quarantine", "dq_rule_counts"),
    "gold": ("fct_trips", "agg_zone_hour_demand"),
}

Conditions = dict[str, Column]

#: Columns that must not be null, by table.
KNOWN_FACTS = ("pickup_utc", "pickup_local", "pickup_hour_utc", "duration_seconds", "total_amount", "pickup_date_local")
KNOWN_CELLS = ("pickup_zone", "pickup_date_local", "trips", "revenue")


def table_checks(name: str, settings: Settings = DEFAULTS, as_of: Column | None = None) -> Conditions:
    """What violates a row check of a table, by check. ``as_of`` adds the check of times to come."""
    if name == "stg_weather":
        return {"observed_hour_utc not_null": is_missing("observed_hour_utc"), "temperature_c range": is_outside("temperature_c", -40, 55)}
    if name == "stg_trips":
        found = {
            "pickup_utc not_null": is_missing("pickup_utc", "is_valid"),
            "duration_seconds range": is_outside("duration_seconds", 1, settings.max_duration_seconds, "is_valid"),
        }
        return found if as_of is None else found | {"pickup_utc no_future": is_future("pickup_utc", as_of, "is_valid")}
    if name == "fct_trips":
        return {f"{c} not_null": is_missing(c) for c in KNOWN_FACTS}
    if name == "agg_zone_hour_demand":
        return {f"{c} not_null": is_missing(c) for c in KNOWN_CELLS}
    return {}


def _store(
    df: DataFrame, folder: str, layer: str, name: str, partition_by: Sequence[str] = (), conditions: Conditions | None = None,
    measures: Conditions | None = None, verify: Callable[[DataFrame, Gate], None] | None = None,
) -> tuple[DataFrame, Gate]:
    """The table written, with its checks counted on the way, and read back."""
    path = f"{folder.rstrip('/')}/{layer}/{name}"
    gate = Gate(df, conditions or {}, measures)
    watched = gate.watched
    if partition_by:
        # Even files per partition value; a hot value is split over several tasks.
        watched = watched.hint("rebalance", *partition_by)

    def judge(fresh: DataFrame) -> None:
        gate.demand(name)
        if verify is not None:
            verify(fresh, gate)

    files.write_table(watched, path, partition_by, judge)
    return df.sparkSession.read.parquet(path), gate


def build_bronze(
    spark: SparkSession, trip_files: Sequence[str], weather_files: Sequence[str], zones_csv: str, folder: str,
    settings: Settings = DEFAULTS, as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """Raw files as tables: trips with lineage, weather with the contract applied, zones; and the report on the raw trips.

    With ``as_of``, a source whose latest row is older than the freshness limit stops the build.
    """
    raw = files.scan_union_by_name(spark, trip_files, row="_ingested_row")
    weather = staging.bronze_weather(files.scan_union_by_name(spark, weather_files), settings)

    def fresh_enough(column: str) -> Callable[[DataFrame, Gate], None]:
        def verify(fresh: DataFrame, gate: Gate) -> None:
            if as_of is not None and checks.freshness(fresh, column, as_of).first().status == "error":
                raise CheckFailed(f"{column} of the latest row is too old")

        return verify

    trips, _ = _store(raw, folder, "bronze", "trips", verify=fresh_enough("tpep_pickup_datetime"))
    hours, _ = _store(weather, folder, "bronze", "weather", verify=fresh_enough("observed_at_utc"))
    return {
        "trips": trips, "weather": hours,
        "taxi_zones": _store(files.read_zones_csv(spark, zones_csv), folder, "bronze", "taxi_zones")[0],
        "dq_report_header": _store(reports.header(trips, hours, settings), folder, "bronze", "dq_report_header")[0],
        "dq_report_findings": _store(reports.findings(trips, settings), folder, "bronze", "dq_report_findings")[0],
    }


def _unique_hours(fresh: DataFrame, gate: Gate) -> None:
    if not checks.require_unique_hour(fresh).isEmpty():
        raise CheckFailed("stg_weather repeats an hour, so the hour join would multiply trips")


def build_silver(
    bronze: dict[str, DataFrame], folder: str, settings: Settings = DEFAULTS, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """Weather and trips of all rows, flagged; the rows that aren't valid with their reason; rows per rule."""
    spark = bronze["trips"].sparkSession
    weather, _ = _store(
        staging.stage_weather(bronze["weather"], settings), folder, "silver", "stg_weather",
        conditions=table_checks("stg_weather"), verify=_unique_hours,
    )
    staged = staging.stage_trips(staging.conform_trips(bronze["trips"]), settings.with_(look_for_hot_groups=True))
    trips, gate = _store(
        staged, folder, "silver", "stg_trips", conditions=table_checks("stg_trips", settings, as_of), measures=rules.rule_counters(),
    )
    counted = spark.createDataFrame([(n, int(v)) for n, v in gate.measures.items()], "rule string, rows bigint")
    hours = checks.unmatched_hours(trips, weather, settings)
    if not hours.isEmpty():
        raise CheckFailed("valid trips inside the observed span have no weather hour")
    return {
        "stg_weather": weather, "stg_trips": trips,
        "silver_trips_quarantine": _store(rules.quarantine(trips), folder, "silver", "silver_trips_quarantine")[0],
        "dq_rule_counts": _store(counted.coalesce(1), folder, "silver", "dq_rule_counts")[0],
    }


def build_gold(
    bronze: dict[str, DataFrame], silver: dict[str, DataFrame], folder: str, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    """Facts by local date, one for each valid trip, then the mart on the stored facts."""
    valid = Gate(silver["stg_trips"].where("is_valid"), {})

    def as_many(fresh: DataFrame, gate: Gate) -> None:
        if gate.rows != valid.rows:
            raise CheckFailed(f"fct_trips has {gate.rows} rows for {valid.rows} valid trips")

    facts = marts.trip_facts(valid.watched, silver["stg_weather"], bronze["taxi_zones"], settings)
    stored, _ = _store(facts, folder, "gold", "fct_trips", ["pickup_date_local"], table_checks("fct_trips"), verify=as_many)
    mart, _ = _store(marts.zone_hour_demand(stored), folder, "gold", "agg_zone_hour_demand", conditions=table_checks("agg_zone_hour_demand"))
    return {"fct_trips": stored, "agg_zone_hour_demand": mart}


def build_all(
    spark: SparkSession, trip_files: Sequence[str], weather_files: Sequence[str], zones_csv: str, folder: str,
    settings: Settings = DEFAULTS, as_of: Column | None = None,
) -> dict[str, DataFrame]:
    bronze = build_bronze(spark, trip_files, weather_files, zones_csv, folder, settings, as_of)
    silver = build_silver(bronze, folder, settings, as_of)
    return {**bronze, **silver, **build_gold(bronze, silver, folder, settings)}


def build_months(
    spark: SparkSession, asked: str, trips_of: str, weather_of: str, zones_csv: str, landing: str, folder: str,
    settings: Settings = DEFAULTS, as_of: Column | None = None, force: bool = False,
) -> dict[str, DataFrame]:
    """From a list of months to the tables: what hasn't landed is landed, then all layers are built for these months.

    ``asked`` is a comma list of YYYY-MM. ``trips_of`` and ``weather_of`` are paths with ``{month}`` in them. The
    valid window is that of the months.
    """
    wanted = months.parse_months(asked)
    low, high = months.valid_window(wanted)
    trips = months.land(spark, wanted, trips_of, f"{landing.rstrip('/')}/trips", force)
    weather = months.land(spark, wanted, weather_of, f"{landing.rstrip('/')}/weather", force)
    return build_all(spark, trips, weather, zones_csv, folder, settings.with_(min_valid_ts=low, max_valid_ts=high), as_of)


def layer_checks(tables: dict[str, DataFrame], settings: Settings = DEFAULTS, as_of: Column | None = None) -> DataFrame:
    """(check_name, violations) for every check on the built tables: one pass a table, and keys."""
    stg, hours = tables["stg_trips"], tables["stg_weather"]
    passes = []
    for name in ("stg_weather", "stg_trips", "fct_trips", "agg_zone_hour_demand"):
        conditions = table_checks(name, settings, as_of)
        passes.append(checks.counted(tables[name], {f"{name}.{check}": c for check, c in conditions.items()}))
    unique = checks.violation_count(checks.unique(hours, "observed_hour_utc"), "stg_weather.observed_hour_utc unique")
    unmatched = checks.violation_count(checks.unmatched_hours(stg, hours, settings), "valid trips without a weather hour")
    found = [*passes, unique, unmatched]
    if as_of is not None:
        for name, column in (("trips", "tpep_pickup_datetime"), ("weather", "observed_at_utc")):
            stale = checks.freshness(tables[name], column, as_of).where("status = 'error'")
            found.append(checks.violation_count(stale, f"{name} freshness"))
    return files.union_by_name(found)


def register_views(tables: dict[str, DataFrame]) -> None:
    """The tables under their names for SQL users."""
    for name, df in tables.items():
        files.as_view(df, name)
