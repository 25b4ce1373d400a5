from datetime import date, datetime, timedelta

from fareweather import DEFAULTS
from fareweather.functions.conditions import band_severity, precipitation_band
from fareweather.plans import insights, marts

FACT = (
    "pickup_zone string, pickup_borough string, pickup_date_local date, pickup_hour_of_day int, "
    "pickup_day_of_week int, precipitation_band string, is_wet_hour boolean, temperature_c double, "
    "total_amount double, duration_seconds long, trip_distance_miles double"
)


def facts(spark, cells):
    """cells: (zone, borough, day offset, band, wet, trips)."""
    rows = []
    for zone, borough, offset, band, wet, n in cells:
        day = date(2024, 1, 1) + timedelta(days=7 * offset)
        rows += [(zone, borough, day, 9, 1, band, wet, 5.0, 10.0, 600, 2.0)] * n
    return spark.createDataFrame(rows, FACT)


def test_baseline_and_lift(spark):
    cells = [
        ("A", "X", 0, "dry", False, 4), ("A", "X", 1, "dry", False, 6), ("A", "X", 2, "light", True, 10),
        ("A", "X", 3, None, None, 3),  # no weather: in neither average
        ("B", "X", 0, "heavy", True, 2),  # never dry: no baseline
        (None, "X", 0, "dry", False, 9),  # no zone: not a cell
        ("C", "X", 0, "dry", False, 1), ("C", "Y", 1, "dry", False, 3),  # one name in two boroughs
    ]
    mart = marts.zone_hour_demand(facts(spark, cells))
    got = {(r.pickup_zone, r.pickup_borough, r.pickup_date_local.day): r for r in mart.collect()}
    assert len(got) == 7
    wet = got["A", "X", 15]
    assert (wet.trips, wet.dry_baseline_trips, wet.demand_lift_vs_dry, wet.revenue) == (10, 5.0, 1.0, 100.0)
    assert (wet.avg_duration_seconds, wet.avg_speed_mph, wet.temperature_c) == (600.0, 12.0, 5.0)
    assert got["A", "X", 22].is_wet_hour is None and got["A", "X", 22].precipitation_band is None
    assert got["B", "X", 1].dry_baseline_trips is None and got["B", "X", 1].demand_lift_vs_dry is None
    assert got["C", "X", 1].dry_baseline_trips == got["C", "Y", 8].dry_baseline_trips == 2.0
    base = {r.pickup_zone: r.dry_baseline_trips for r in marts.dry_baseline(marts.observed_cells(facts(spark, cells))).collect()}
    assert base == {"A": 5.0, "B": None, "C": 2.0}


def test_window_form_equals_self_join(spark):
    cells = [(z, "X", d, "dry" if (z + d) % 3 else "light", bool((z + d) % 3 == 0), z + d + 1) for z in range(4) for d in range(5)]
    cells = [(f"Z{c[0]}", *c[1:]) for c in cells]
    df = facts(spark, cells)
    observed = marts.observed_cells(df)
    keys = ["pickup_zone", "pickup_day_of_week", "pickup_hour_of_day"]
    joined = observed.join(marts.dry_baseline(observed), keys, "left")
    pick = [*marts.CELL, "trips", "dry_baseline_trips"]
    assert sorted(map(str, joined.select(pick).collect())) == sorted(map(str, marts.zone_hour_demand(df).select(pick).collect()))


def test_greatest_name_is_not_the_worst_band(spark):
    df = facts(spark, [("A", "X", 0, "moderate", True, 1), ("A", "X", 0, "heavy", True, 1), ("A", "X", 0, None, None, 1)])
    r = marts.worst_band(df).collect()[0]
    assert (r.max_band_name, r.worst_band) == ("moderate", "heavy")
    empty = marts.worst_band(facts(spark, [("A", "X", 0, None, None, 2)])).collect()[0]
    assert (empty.max_band_name, empty.worst_band) == (None, None)


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 0.01, 0.49, 0.5, 2.49, 2.5, 7.59, 7.6, 90.0)], "mm double")
    got = [tuple(r) for r in df.select(precipitation_band("mm"), band_severity(precipitation_band("mm"))).collect()]
    names = ["dry", "dry", "trace", "trace", "light", "light", "moderate", "moderate", "heavy", "heavy"]
    assert [g[0] for g in got] == names and [g[1] for g in got] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def lift_mart(spark):
    rows = []
    for zone, lifts, base in (("up", [0.5] * 12, 6.0), ("down", [-0.4] * 11, 6.0), ("few", [9.0] * 10, 6.0),
                              ("thin", [9.0] * 12, 5.0), ("tie", [0.5004] * 12, 6.0)):
        rows += [(zone, "X", True, base, v, 100, 10.0, 20.0) for v in lifts]
        rows += [(zone, "X", False, base, 0.0, 600, 60.0, 25.0), (zone, "X", None, base, 0.0, 1, 1.0, None)]
    return spark.createDataFrame(
        rows, "pickup_zone string, pickup_borough string, is_wet_hour boolean, dry_baseline_trips double, "
        "demand_lift_vs_dry double, trips long, revenue double, avg_speed_mph double",
    )


def test_lift_lists(spark):
    mart = lift_mart(spark)
    top = [(r.pickup_zone, r.avg_lift, r.observations) for r in insights.top_wet_lift(mart).collect()]
    # Ranked by the rounded lift, so equal ones follow their names.
    assert top == [("tie", 0.5, 12), ("up", 0.5, 12), ("down", -0.4, 11)]
    assert [r.pickup_zone for r in insights.bottom_wet_lift(mart, top=1).collect()] == ["down"]
    head = [(r.pickup_zone, r.lift_pct) for r in insights.headline(mart).collect()]
    assert head == [("tie", 50.0), ("up", 50.0), ("down", -40.0)]
    assert [r.pickup_zone for r in insights.headline(mart, top=1).collect()] == ["tie"]


def test_revenue_and_speed(spark):
    mart = lift_mart(spark)
    rows = insights.revenue_wet_dry(mart).collect()
    assert all(r.trips > 1000 for r in rows) and {r.pickup_zone for r in rows} == {"up", "down", "thin", "tie"}
    low = insights.revenue_wet_dry(mart, DEFAULTS.with_(min_revenue_trips=0)).collect()
    assert len(low) == 15 and [r.is_wet_hour for r in low[:3]] == [False, True, None]
    speed = {r.is_wet_hour: (r.cells, r.avg_speed_mph) for r in insights.speed_wet_dry(mart).collect()}
    assert speed == {True: (57, 20.0), False: (5, 25.0), None: (5, None)}


def test_demand_matrix(spark):
    df = spark.createDataFrame([(9, 0, 10.0), (9, 0, 20.0), (9, 6, 5.0), (10, 3, 1.0)],
                               "pickup_hour_of_day int, pickup_day_of_week int, total_amount double")
    long = [tuple(r) for r in insights.demand_by_hour_of_week(df).collect()]
    assert long == [(0, 9, 2, 15.0), (3, 10, 1, 1.0), (6, 9, 1, 5.0)]
    wide = {r.pickup_hour_of_day: r for r in insights.demand_matrix(df).collect()}
    assert (wide[9].dow_0, wide[9].dow_6, wide[9].dow_1, wide[10].dow_3) == (2.0, 1.0, None, 1.0)


def test_time_parts_are_local(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 14, 23, 59),)], "pickup_local timestamp_ntz")
    r = marts.add_time_parts(df).collect()[0]
    assert (r.pickup_hour_of_day, r.pickup_day_of_week, r.pickup_date_local) == (23, 0, date(2024, 1, 14))


def test_fact_columns():
    assert len(marts.FACT_COLUMNS) == len(set(marts.FACT_COLUMNS)) == 23
