import random
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fareweather import DEFAULTS
from fareweather.operators import checks, joins
from fareweather.sources import shared


def facts(spark, n=3000):
    rng = random.Random(3)
    rows = [(i, None if rng.random() < 0.05 else 7 if rng.random() < 0.4 else rng.randrange(40)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k int")


def dimension(spark):
    rows = [(k, f"name{k}") for k in range(30)]
    return dict(rows), spark.createDataFrame(rows, "k int, name string")


def test_salted_join_equals_plain_join(spark):
    rows, df = facts(spark)
    names, dim = dimension(spark)
    left = joins.salted_join(df, dim, ["k"], "left", 8).collect()
    assert Counter((r.id, r.k, r.name) for r in left) == Counter((i, k, names.get(k)) for i, k in rows)
    kinds = {
        "inner": lambda k: k in names, "left_semi": lambda k: k in names, "left_anti": lambda k: k not in names,
    }
    for how, keep in kinds.items():
        got = joins.salted_join(df, dim, ["k"], how, 8).collect()
        assert sorted(r.id for r in got) == sorted(i for i, k in rows if keep(k)), how


def test_attach_takes_each_way(spark):
    rows, df = facts(spark, 400)
    names, dim = dimension(spark)
    want = Counter((i, names.get(k)) for i, k in rows)
    ways = {"small": DEFAULTS, "too many rows": DEFAULTS.with_(broadcast_rows=5), "too large": DEFAULTS.with_(broadcast_bytes=0)}
    for name, settings in ways.items():
        joined = joins.attach(df, dim, ["k"], settings)
        assert Counter((r.id, r.name) for r in joined.collect()) == want, name
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert ("approx_top_k" not in plan) == (name == "small"), name


def test_only_hot_keys_are_salted(spark):
    """A key with a third of the rows gets a third of the tasks, other keys one, and so does the missing key if it is hot."""
    df = spark.range(9_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 AND id % 2 = 0 THEN null ELSE cast(id % 900 as int) + 100 END AS k")
    hot = {r["_key"]: r["_salts"] for r in joins.hot_keys(df, ["k"], 30).collect()}
    of = lambda k: spark.range(1).select(F.xxhash64(F.lit(k).cast("int"))).first()[0]
    assert hot == {of(7): 10, of(None): 5}
    dim = spark.range(1_500).selectExpr("cast(id as int) AS k", "'n' || id AS name")
    joined = joins.salted_join(df, dim, ["k"], "left", 30)
    assert joined.where("k IS NOT NULL AND name != 'n' || k OR k IS NULL AND name IS NOT NULL").count() == 0 and joined.count() == 9_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = joins.salted_join(df, dim, ["k"], "inner", 30).where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) == 4  # all tasks of this session
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_shared_folder_comes_from_the_session():
    def session(folder, master="yarn"):
        conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared.shared_folder(session("hdfs:///scratch")) == "hdfs:///scratch"
    with pytest.raises(ValueError):
        shared.shared_folder(session(None))


def test_zone_roles_and_unknown_ids(spark):
    trips = spark.createDataFrame([(1, 10, 11), (2, 10, None), (3, 99, 10)], "id int, pickup_zone_id int, dropoff_zone_id int")
    zones = spark.createDataFrame([(10, "B1", "Z1", "s"), (11, "B2", "Z2", "s")], "LocationID int, Borough string, Zone string, service_zone string")
    got = {r.id: (r.pickup_zone, r.pickup_borough, r.dropoff_zone, r.dropoff_borough) for r in joins.attach_zone_roles(trips, zones).collect()}
    assert got == {1: ("Z1", "B1", "Z2", "B2"), 2: ("Z1", "B1", None, None), 3: (None, None, "Z1", "B1")}


def test_fanout_is_counted_without_joining(spark):
    trips = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, h string")
    hours = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "h string, v int")
    r = checks.join_fanout(trips, hours, ["h"]).collect()[0]
    assert (r.rows_before, r.rows_after, r.rows_added) == (4, 6, 2)
    assert trips.join(hours, "h", "left").count() == 6
    assert [tuple(x) for x in checks.unique(hours, "h").collect()] == [("a", 2)]


def test_primary_with_backfill(spark):
    p = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 5), (None, 7.0, 1)], "k int, v double, n int")
    b = spark.createDataFrame([(1, 9.0, 4), (3, 3.0, 6)], "k int, v double, n int")
    got = {r.k: (r.v, r.n, r.filled_from) for r in joins.primary_with_backfill(p, b, ["k"], ["v", "n"]).collect()}
    assert got == {1: (1.0, 4, "both"), 2: (2.0, 5, "primary"), 3: (3.0, 6, "backfill"), None: (7.0, 1, "primary")}
