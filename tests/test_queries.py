"""Every registered query against its SQL, in two session zones, and the plans that matter at scale."""

import re

import pytest

import __spark_entry__ as entry_points
import compare
from fareweather import oracle, registry
from fareweather.sources import bindings
from fareweather.sources.bindings import Tables

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con(small):
    return compare.connection(small)


def test_registry():
    rows_only = set(registry.queries()) - set(oracle.oracle_sql())
    assert rows_only == set()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, con, small, name):
    assert compare.difference(spark, con, small, name) is None


@pytest.mark.parametrize("name", ["zone_hour_demand", "normalise_attach", "scalar_time_parts", "fraud_features_sliding", "telemetry_downsample", "hour_spine"])
def test_session_zone_does_not_matter(spark, zone, con, small, name):
    zone("America/New_York")
    assert compare.difference(spark, con, small, name) is None


# With nothing known to be small: dimensions are written, measured and joined by
# salt, duplicate groups are looked at and ranked in slices.
LARGE = bindings.SETTINGS.with_(broadcast_bytes=0, hot_group_rows=1, look_for_hot_groups=True, task_rows=0)


@pytest.mark.parametrize(
    "name",
    ["dedupe_rank", "trips_flagged", "trip_facts", "zone_hour_demand", "join_zone_roles", "check_unmatched_weather",
     "hotspot_candidates", "erase_tokens"],
)
def test_large_input_ways_give_the_same(spark, con, small, name):
    wide = Tables(spark, small, LARGE)
    assert compare.difference(spark, con, small, name, registry.JOBS[name](wide)) is None


def test_entry_has_rows(spark, small):
    assert entry_points.entry(spark).count() > 0


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_flagship_plan(spark, small):
    text = plan(Tables(spark, small).mart)
    # One scan of trips, filtered by the window padded by two days, and narrow.
    assert "GreaterThanOrEqual(ts,2023-12-31T00:00)" in text and "LessThan(ts,2024-02-01T00:00)" in text
    assert "CartesianProduct" not in text
    # Duplicate groups are cut to one row before the shuffle; cells are hash-aggregated.
    assert "Partial" in text and "WindowGroupLimit" in text
    assert "SortAggregate" not in text


def below(text, node):
    """The part of a plan's tree under the first line that names a node."""
    lines = text[:text.index("\n\n\n")].splitlines()
    at = next(i for i, line in enumerate(lines) if node in line)
    return "\n".join(lines[at:])


def test_trips_are_grouped_before_they_are_joined(spark, small):
    t = Tables(spark, small)
    tree = below(plan(t.mart), "Join")
    assert tree.index("HashAggregate") < tree.index("WindowGroupLimit")  # the join's input is grouped trips
    assert "Join" not in tree[tree.index("WindowGroupLimit"):tree.index("Scan parquet")]
    for name in ("demand_heatmap", "demand_heatmap_long", "trip_length_distribution"):
        assert "Join" not in plan(entry_points.queries()[name](spark, small))
    for name in ("demand_by_band", "fleet_metrics", "max_band_by_severity", "dry_baseline"):
        assert "dropoff_borough" not in plan(entry_points.queries()[name](spark, small))


def test_plans_of_the_mart_run_no_job(spark, small):
    tracker = spark.sparkContext.statusTracker()
    for name in ("zone_hour_demand", "hotspot_candidates", "fleet_metrics", "demand_by_band"):
        spark.sparkContext.setJobGroup(name, name)
        entry_points.queries()[name](spark, small)
        assert not tracker.getJobIdsForGroup(name)
    spark.sparkContext._jsc.clearJobGroup()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_and_no_cross_product(spark, small, name):
    text = plan(entry_points.queries()[name](spark, small))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|Pandas", text)


def test_report_is_one_pass_plus_keys(spark, small):
    text = plan(entry_points.queries()["dq_report_findings"](spark, small))
    assert text.count("ReadSchema") == 2
