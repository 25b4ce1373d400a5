"""Duplicate ranks: the split way must equal brute force, whatever the groups look like."""

import random

from pyspark.sql import functions as F

from fareweather import DEFAULTS
from fareweather.operators import ranking
from fareweather.sources import files

KEYS = ["a", "b"]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), []).append(r)
    ranks = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[3]))
        ranks.update({r[3]: i + 1 for i, r in enumerate(members)})
    return ranks


def make(n=4000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third in one group, a sixth in a group with a null key, many equal distances.
        pick = rng.random()
        key = ("hot", 1) if pick < 0.33 else (None, 2) if pick < 0.5 else (f"k{rng.randrange(400)}", rng.randrange(3))
        rows.append((*key, rng.choice([None, 1.0, 1.0, 2.5, rng.random() * 9]), i))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b int, d double, id long").repartition(5)


def ranks(df):
    return {r["id"]: r["_dupe_rank"] for r in df.collect()}


def test_plain_rank(spark):
    rows = make()
    assert ranks(ranking.duplicate_rank(frame(spark, rows), KEYS, "d", ["id"], settings=DEFAULTS)) == brute(rows)


def test_split_rank_of_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(ranking, "EQUAL_ROWS", 50)
    rows = make()
    hot = DEFAULTS.with_(look_for_hot_groups=True, hot_group_rows=100)
    out = ranking.duplicate_rank(frame(spark, rows), KEYS, "d", ["id"], settings=hot)
    assert out.columns == ["a", "b", "d", "id", "_dupe_rank"]
    got = out.collect()
    assert len(got) == len(rows)
    assert {r["id"]: r["_dupe_rank"] for r in got} == brute(rows)


def test_every_group_hot_and_none_hot(spark, monkeypatch):
    monkeypatch.setattr(ranking, "EQUAL_ROWS", 1)
    rows = make(1500, seed=2)
    for hot_rows in (0, 10**6):
        settings = DEFAULTS.with_(look_for_hot_groups=True, hot_group_rows=hot_rows)
        assert ranks(ranking.duplicate_rank(frame(spark, rows), KEYS, "d", ["id"], settings=settings)) == brute(rows)


def test_hot_groups_are_found(spark):
    rows = make()
    found = ranking.hot_groups(frame(spark, rows), KEYS, 500)
    assert found.count() == 2
    assert ranking.hot_groups(frame(spark, rows), KEYS, 10**6) is None


def test_slices_spread_a_hot_group(spark):
    """No slice may hold most of the hot group, even when all its distances are equal."""
    df = frame(spark, [("hot", 1, float(i % 2), i) for i in range(4000)])
    hot = ranking.hot_groups(df, KEYS, 400)
    slices = ranking.slices_for(hot, 400)
    assert slices == 10
    spread = df.repartitionByRange(slices, *KEYS, *ranking.rank_order("d", ["id"]))
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1000


def test_only_rows_that_repeat_are_shuffled(spark, tmp_path):
    """One row in fifty repeats: the plan's row shuffles see those, the keys' shuffle sees two numbers a row."""
    df = spark.range(20_000).selectExpr("id - id % 50 * cast(id % 50 = 1 as bigint) AS a", "id AS b", "1.0D AS d", "id", "repeat('x', 50) AS wide").withColumn("b", F.lit(0))
    out = ranking.duplicate_rank(df, KEYS, "d", ["id"])
    assert out.agg(F.sum(F.expr("cast(_dupe_rank = 1 as int)")), F.count("*")).first() == (20_000 - 400, 20_000)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    # Nothing but the key hashes is grouped of all rows; the window stands over filtered rows.
    window = text[text.index("Window ["):]
    assert "Filter" in window and "_mask" in window and text.count("Window [") == 2
    marks = ranking.repeat_marks(df, KEYS)
    assert marks.count() <= 400


def test_many_equal_rows_take_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "EQUAL_ROWS", 1_000)
    df = spark.range(60_000).selectExpr("'k' AS a", "cast(null as int) AS b", "1.0D AS d", "7L AS id").unionAll(spark.sql("SELECT 'k', cast(null as int), 2.0D, 8L"))
    out = ranking.duplicate_rank(df, KEYS, "d", ["id"])
    found = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("_dupe_rank").alias("low"), F.max("_dupe_rank").alias("high")).collect()
    assert sum(r.n for r in found) == 60_001 and min(r.low for r in found) == 1 and max(r.high for r in found) == 60_001
    assert len(found) > 2 and max(r.n for r in found) < 40_000
    assert out.select("_dupe_rank").distinct().count() == 60_001 and out.where("id = 8").first()._dupe_rank == 1


def test_few_rows_are_told_by_footers(spark, tmp_path):
    """By their number and not by their bytes: equal rows take few."""
    spark.range(60_000).selectExpr("'k' AS a", "1 AS b", "1.0D AS d", "7L AS id").coalesce(2).write.parquet(str(tmp_path / "t x"))
    df = spark.read.parquet(str(tmp_path / "t x"))
    assert files.rows_in_files(df) == 60_000 and files.rows_in_files(spark.range(3)) is None
    plans = {n: ranking.duplicate_rank(df, KEYS, "d", ["id"], settings=DEFAULTS.with_(task_rows=n))._jdf.queryExecution().optimizedPlan().toString() for n in (59_999, 60_000)}
    assert "_mask" in plans[59_999] and "_mask" not in plans[60_000]


def test_ranking_runs_no_job_before_its_plan(spark):
    spark.sparkContext.setJobGroup("ranking", "plan only")
    df = frame(spark, make(500))
    ranking.duplicate_rank(df, KEYS, "d", ["id"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranking")
    spark.sparkContext._jsc.clearJobGroup()


def test_duplicate_count_equals_ranks(spark):
    rows = make()
    assert ranking.duplicate_count(frame(spark, rows), KEYS).collect()[0][0] == sum(v > 1 for v in brute(rows).values())
    assert ranking.duplicate_count(frame(spark, []), KEYS).collect()[0][0] == 0


def test_first_per_key(spark):
    rows = make(500)
    first = ranking.first_per_key(frame(spark, [(r[0] or "none", r[1], r[2], r[3]) for r in rows]), ["a"], "id")
    want = {}
    for a, _, _, i in rows:
        want[a or "none"] = min(i, want.get(a or "none", i))
    assert first.columns == ["a", "b", "d", "id"]
    assert {r["a"]: r["id"] for r in first.collect()} == want
