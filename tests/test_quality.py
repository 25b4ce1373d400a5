from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareweather import DEFAULTS
from fareweather.functions.timecols import ntz
from fareweather.operators import checks, profile, rules
from fareweather.plans import reports, staging

RAW = (
    "trip_id long, VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, PULocationID long, DOLocationID long, fare_amount double, "
    "extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, Airport_fee double, payment_type long"
)
START = datetime(2024, 1, 15, 8)


def trip(i, pickup=START, minutes=15, dropoff="", passengers=1.0, miles=2.0, pu=1, do=2, fare=10.0, total=None, **kw):
    base = {"extra": 0.5, "mta": 0.5, "tip": 1.0, "tolls": 0.0, "improvement": 0.3, "congestion": 2.5, "airport": None}
    base.update(kw)
    if dropoff == "":
        dropoff = pickup + timedelta(minutes=minutes) if pickup else None
    parts = fare + sum(v or 0.0 for v in base.values()) if fare is not None else None
    return (
        i, 1, pickup, dropoff, passengers, miles, pu, do, fare, base["extra"], base["mta"], base["tip"], base["tolls"],
        base["improvement"], parts if total is None else total, base["congestion"], base["airport"], 1,
    )


def staged(spark, rows, settings=DEFAULTS):
    return staging.stage_trips(staging.conform_trips(spark.createDataFrame(rows, RAW)), settings)


def flags_of(row):
    return {r.name for r in rules.TRIP_RULES if row[r.name]}


EDGES = [
    (trip(1), set(), True),
    (trip(2, pickup=None, dropoff=START, fare=11.0), {"dq_pickup_unparseable"}, False),
    (trip(3, dropoff=None, fare=12.0), {"dq_dropoff_unparseable"}, False),
    (trip(4, pickup=datetime(2024, 1, 15, 9), minutes=0), {"dq_non_positive_duration"}, False),
    (trip(5, pickup=datetime(2024, 1, 15, 9, 1), minutes=-5), {"dq_non_positive_duration"}, False),
    (trip(6, pickup=datetime(2024, 1, 15, 9, 2), minutes=1440), set(), True),
    (trip(7, pickup=datetime(2024, 1, 15, 9, 3), dropoff=datetime(2024, 1, 16, 9, 3, 1)), {"dq_duration_exceeds_24h"}, False),
    # The window is in UTC: 19:00 in New York on the last day is already outside.
    (trip(8, pickup=datetime(2023, 12, 31, 18, 59, 59)), {"dq_pickup_out_of_range"}, False),
    (trip(9, pickup=datetime(2023, 12, 31, 19)), set(), True),
    (trip(10, pickup=datetime(2024, 1, 31, 18, 59, 59)), set(), True),
    (trip(11, pickup=datetime(2024, 1, 31, 19)), {"dq_pickup_out_of_range"}, False),
    (trip(12, pickup=datetime(2024, 1, 15, 10), miles=0.0), {"dq_zero_distance_paid"}, True),
    (trip(13, pickup=datetime(2024, 1, 15, 11), miles=500.0), set(), True),
    (trip(14, pickup=datetime(2024, 1, 15, 12), miles=500.01), {"dq_implausible_distance"}, False),
    (trip(15, pickup=datetime(2024, 1, 15, 13), passengers=None), {"dq_no_passengers"}, True),
    (trip(16, pickup=datetime(2024, 1, 15, 14), passengers=0.0), {"dq_no_passengers"}, True),
    (trip(17, pickup=datetime(2024, 1, 15, 15), fare=-20.0), {"dq_negative_total"}, True),
    (trip(18, pickup=datetime(2024, 1, 15, 16), pu=264), {"dq_unknown_zone"}, True),
    (trip(19, pickup=datetime(2024, 1, 15, 17), do=265), {"dq_unknown_zone"}, True),
    # A distance that is not known leaves validity open.
    (trip(20, pickup=datetime(2024, 1, 15, 18), miles=None), set(), None),
    # Copies: the longest stays.
    (trip(21, pickup=datetime(2024, 1, 15, 19), miles=1.0), {"dq_duplicate_row"}, False),
    (trip(22, pickup=datetime(2024, 1, 15, 19), miles=3.0), set(), True),
    (trip(23, pickup=datetime(2024, 1, 15, 19), miles=None), {"dq_duplicate_row"}, False),
]


def test_each_rule(spark):
    rows = {r.trip_id: r for r in staged(spark, [e[0] for e in EDGES]).collect()}
    assert len(rows) == len(EDGES)
    for raw, flags, valid in EDGES:
        assert (flags_of(rows[raw[0]]), rows[raw[0]].is_valid) == (flags, valid), raw[0]


def test_a_skipped_wall_clock_is_unparseable(spark):
    march = DEFAULTS.with_(min_valid_ts="2024-03-01", max_valid_ts="2024-04-01")
    got = staged(spark, [trip(1, pickup=datetime(2024, 3, 10, 2, 30), minutes=60)], march).collect()[0]
    assert flags_of(got) == {"dq_pickup_unparseable"} and got.pickup_utc is None


def test_window_may_be_local(spark):
    local = DEFAULTS.with_(window_tz="America/New_York")
    edge = [trip(1, pickup=datetime(2024, 1, 31, 20)), trip(2, pickup=datetime(2023, 12, 31, 20))]
    rows = {r.trip_id: r.is_valid for r in staged(spark, edge, local).collect()}
    assert rows == {1: True, 2: False}


def test_quarantine_accounts_for_every_row(spark):
    df = staged(spark, [e[0] for e in EDGES])
    held = {r.trip_id: r.failure_reason for r in rules.quarantine(df).collect()}
    assert set(held) == {e[0][0] for e in EDGES if e[2] is not True}
    assert held[20] == "dq_undetermined" and held[4] == "dq_non_positive_duration"
    counts = {r.rule: r.rows for r in rules.rule_counts(df).collect()}
    assert counts["is_valid"] + len(held) == len(EDGES)
    assert counts["dq_undetermined"] == 1 and counts["dq_duplicate_row"] == 2
    money = rules.revenue_by_reason(df).collect()
    assert sum(r.rows for r in money) == len(EDGES)
    assert round(sum(r.revenue for r in money), 2) == round(sum(e[0][14] for e in EDGES), 2)


def test_valid_trips_equal_staged_and_filtered(spark):
    conformed = staging.conform_trips(spark.createDataFrame([e[0] for e in EDGES], RAW))
    direct = staging.valid_trips(conformed)
    via = staging.stage_trips(conformed).where("is_valid")
    assert direct.columns == via.columns
    assert sorted(map(str, direct.collect())) == sorted(map(str, via.collect()))


def test_text_times_and_odd_numbers(spark):
    df = spark.createDataFrame(
        [("2", "01/15/2024 09:00:00 AM", "2024-01-15T14:30:00Z", "1.5", "x", "1", "2", "1", "0", "5", "1")],
        "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count string, "
        "trip_distance string, PULocationID string, DOLocationID string, fare_amount string, tip_amount string, "
        "total_amount string, payment_type string",
    )
    r = staging.stage_trips(staging.conform_trips(df)).collect()[0]
    assert (r.vendor_id, r.passenger_count, r.trip_distance_miles, r.duration_seconds) == (2, 2, None, 1800)
    assert r.is_valid is None, "a distance that is no number leaves validity open"
    broken = df.withColumns({"tpep_pickup_datetime": F.lit("not a date"), "trip_distance": F.lit("1")}).unionByName(
        df.withColumn("trip_distance", F.lit("1"))
    )
    valid = staging.valid_trips(staging.conform_trips(broken)).collect()
    assert [v.duration_seconds for v in valid] == [1800]


def test_fourteen_findings(spark):
    extra = [
        trip(30, pickup=datetime(2023, 12, 31, 23), fare=5.0),
        trip(31, pickup=datetime(2024, 2, 1), fare=5.0),
        trip(32, pickup=datetime(2024, 1, 16), passengers=7.0),
        trip(33, pickup=datetime(2024, 1, 17), fare=2000.0),
        trip(34, pickup=datetime(2024, 1, 18), total=99.0),
        trip(35, pickup=datetime(2024, 1, 19), fare=-20.0, total=-99.0),
    ]
    raw = spark.createDataFrame([e[0] for e in EDGES] + extra, RAW)
    got = {r.rule: r for r in reports.findings(raw).collect()}
    assert len(got) == 14 and all(r.total == len(EDGES) + len(extra) for r in got.values())
    counts = {rule: r["count"] for rule, r in got.items()}
    assert counts == {
        "pickup_before_window": 3, "pickup_after_window": 1, "non_positive_duration": 2, "duration_exceeds_24h": 1,
        "no_passengers": 2, "too_many_passengers": 1, "zero_distance_paid": 1, "implausible_distance": 1,
        "negative_fare": 2, "negative_total": 2, "large_total": 1, "unknown_zone": 2,
        "total_not_sum_of_components": 1, "duplicate_rows": 2,
    }
    assert {r.action for r in got.values()} == {"quarantine", "flag (keep)"}
    assert got["duplicate_rows"].pct == round(100 * 2 / 29, 2)
    empty = reports.findings(raw.where("false")).collect()
    assert len(empty) == 14 and all(r["count"] == 0 and r.pct == 0.0 for r in empty)


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([(1, 5.0, "2024-01-01"), (2, None, "2024-01-02"), (2, 90.0, "2024-01-03")], "k int, v double, at string")
    df = df.withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert checks.unique(df, "k").collect() == [(2, 2)]
    assert checks.unique(df, "k", where="v is not null").isEmpty()
    assert checks.not_null(df, ["k", "v"]).collect() == [("v", 1)]
    assert checks.not_null(df, ["k"]).isEmpty()
    assert [r.v for r in checks.accepted_range(df, "v", -40, 55).collect()] == [90.0]
    assert checks.accepted_range(df, "v", None, 100).isEmpty()
    assert checks.no_future(df, "at", ntz("2024-01-02 12:00:00")).count() == 1
    for as_of, status in (("2024-01-03 20:00:00", "pass"), ("2024-01-04 12:00:00", "warn"), ("2024-01-09 00:00:00", "error")):
        assert checks.freshness(df, "at", ntz(as_of)).collect()[0].status == status
    assert checks.freshness(df.where("false"), "at", ntz("2024-01-01 00:00:00")).collect()[0].status == "error"


def test_unmatched_hours(spark):
    hours = [datetime(2024, 1, 1, h) for h in (5, 6, 9)]
    weather = spark.createDataFrame([(h,) for h in hours], "observed_hour_utc timestamp_ntz")
    trips = spark.createDataFrame(
        [(datetime(2024, 1, 1, h), v) for h, v in ((4, True), (5, True), (7, True), (7, True), (8, False), (8, None), (10, True))],
        "pickup_hour_utc timestamp_ntz, is_valid boolean",
    )
    assert checks.unmatched_hours(trips, weather).collect() == [(datetime(2024, 1, 1, 7), 2)]


def test_drift(spark):
    runs = spark.createDataFrame(
        [("bronze", d, n) for d, n in (("2024-01-01", 100), ("2024-01-02", 80), ("2024-01-03", 79), ("2024-01-04", 0), ("2024-01-05", 5))],
        "layer string, run_date string, rows_in long",
    )
    got = {r.run_date[-2:]: (r.relative_change, r.is_alert) for r in rules.run_drift(runs).collect()}
    assert got == {"01": (None, False), "02": (-0.2, True), "03": (-0.0125, False), "04": (-1.0, True), "05": (None, False)}


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (3, "c", 3.0)], "i int, s string, d double")
    exact = {r.column_name: r for r in profile.profile_exact(df).collect()}
    assert (exact["s"].nulls, exact["s"].null_pct, exact["s"]["min"], exact["s"]["max"], exact["s"]["mean"]) == (1, 33.33, "a", "c", None)
    assert exact["d"]["mean"] == 2.0 and exact["i"].rows == 3
    approx = {r.column_name: r for r in profile.profile_approximate(df).collect()}
    assert approx["i"].approx_distinct == 3 and approx["i"].q50 == 2.0 and approx["s"].std is None


def test_sketches_merge(spark, tmp_path):
    """Summaries stored per day and merged in any order are within the bounds of the whole, for odd names and values too."""
    df = spark.range(30_000).selectExpr(
        "id % 7 AS day", "id AS `a.b`", "CASE WHEN id % 5 > 0 THEN (id * 7919 % 10007) / 3D END AS v", "concat('k', id % 321) AS s", "cast(null as double) AS none",
        "CASE WHEN id % 100 = 0 THEN double('NaN') ELSE 1e9 + id % 11 END AS odd")
    fields = df.schema.fields
    profile.column_sketches(df, ["day"]).write.parquet(str(tmp_path / "days"))
    stored = spark.read.parquet(str(tmp_path / "days"))
    assert stored.count() == 7
    got = {r.column_name: r for r in profile.profile_of_sketches(profile.merged_sketches(stored.repartition(3), fields), fields).collect()}
    assert abs(got["a.b"].q50 - 15_000) < 30_000 * profile.RANK_ERROR and abs(got["a.b"].approx_distinct / 30_000 - 1) < profile.DISTINCT_ERROR
    exact = df.agg(F.stddev_samp("v").alias("v"), F.stddev_samp("`a.b`").alias("i")).first()
    assert abs(got["v"].std / exact.v - 1) < 1e-9 and abs(got["a.b"].std / exact.i - 1) < 1e-9
    assert (got["none"].approx_distinct, got["none"].std, got["none"].q50, got["s"].q50) == (0, None, None, None)
    judged = {r.column_name: r for r in profile.profile_verified(df.drop("none", "odd"), ["day"]).collect()}
    assert all(r.distinct_within for r in judged.values()) and judged["s"].distinct_values == 321
    assert judged["v"].q25_within and judged["v"].q50_within and judged["v"].q75_within and judged["s"].q25_within is None
    empty = profile.profile_approximate(df.limit(0)).collect()
    assert [r.approx_distinct for r in empty] == [0] * 6


def test_verified_profile_makes_no_row_for_each_column(spark):
    """No row is written once for each column, and odd values count as they do in one aggregate."""
    df = spark.range(900).selectExpr(
        "id % 3 AS day", "CASE id % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN -0D WHEN 2 THEN 0D END AS odd", "cast(null as int) AS none", "concat('k', id % 21) AS `a.b`")
    judged = profile.profile_verified(df, ["day"])
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    got = {r.column_name: r for r in judged.collect()}
    assert list(got) == ["day", "odd", "none", "a.b"] and all(r.rows == 900 and r.distinct_within for r in got.values())
    assert [r.distinct_values for r in got.values()] == [3, 2, 0, 21]
    assert got["day"].q50_within and got["none"].q50_within and got["a.b"].q50_within is None and got["none"]["std"] is None
    empty = profile.profile_verified(df.limit(0), ["day"]).collect()
    assert [(r.rows, r.distinct_values, r.distinct_within, r.q25_within) for r in empty] == [(0, 0, None, True)] * 3 + [(0, 0, None, None)]


@pytest.mark.parametrize("value, want", [(None, 0.0), (1, 50.0)])
def test_percent(spark, value, want):
    from fareweather.functions.conditions import percent_of

    df = spark.createDataFrame([(value, 2 if value else 0)], "n int, t int")
    assert df.select(percent_of(F.col("n"), F.col("t")).alias("p")).collect()[0].p == want
