"""Cases in which rows, columns or whole tables could be lost."""

import pytest
from pyspark.sql import functions as F

from fareweather import Settings
from fareweather.functions.conditions import mean_amount
from fareweather.operators.joins import salted_join, sized_for_broadcast
from fareweather.plans import fleet
from fareweather.sources import files


def test_a_drifted_folder_keeps_every_column_and_row(spark, tmp_path):
    folder, other = tmp_path / "a" / "day=1", tmp_path / "b"
    for i, shape in enumerate(("1 AS x", "2 AS x, 'k' AS y", "2.5D AS x, 7L AS z")):
        spark.sql(f"SELECT {shape}").coalesce(1).write.parquet(str(folder / f"hour={i}"))
    spark.sql("SELECT 3L AS x, 'm' AS Y").write.parquet(str(other))
    df = files.scan_union_by_name(spark, [str(tmp_path / "a"), str(other)], row="n")
    assert {c.lower() for c in df.columns} == {"x", "y", "z", "day", "hour", "_ingested_from", "n"}
    got = {(r.x, r.y, r.z, r.day, r.hour) for r in df.select("x", "y", "z", "day", "hour").collect()}
    assert got == {(1.0, None, None, 1, 0), (2.0, "k", None, 1, 1), (2.5, None, 7, 1, 2), (3.0, "m", None, None, None)}


def test_drifted_files_of_any_name_are_read(spark, tmp_path):
    """What Spark reads of a folder without drift it reads of one with drift: names without an ending, and not hidden ones."""
    for i, kind in enumerate(("bigint", "double", "string")):
        spark.range(3 * i, 3 * i + 3).select(F.col("id").cast(kind).alias("x")).coalesce(1).write.parquet(str(tmp_path / "w" / str(i)))
    folder = tmp_path / "in"
    folder.mkdir()
    for i, name in enumerate(("plain", "a b%20.parq", "part-1.snappy.parquet")):
        next((tmp_path / "w" / str(i)).glob("*.parquet")).rename(folder / name)
    (folder / "_hidden").write_bytes(b"no table")
    got = files.scan_union_by_name(spark, [str(folder)], row="n")
    assert sorted(r.x for r in got.collect()) == sorted(["0", "1", "2", "3.0", "4.0", "5.0", "6", "7", "8"])
    assert got.select("_ingested_from", "n").distinct().count() == 9
    single = files.scan_union_by_name(spark, [str(folder / "plain"), str(tmp_path / "in" / "a*")])
    assert sorted(r.x for r in single.collect()) == [0, 1, 2, 3, 4, 5]


def test_alternating_drift_takes_a_scan_per_schema(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = (pa.int64(), pa.float64(), pa.string())
    for i in range(300):
        pq.write_table(pa.table({"x": pa.array([i], pa.int64()).cast(kinds[i % 3]), "i": pa.array([i])}), tmp_path / f"f{i:04}")
    got = files.scan_union_by_name(spark, [str(tmp_path)])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3
    assert got.agg(F.count("x"), F.count_distinct("i")).first() == (300, 300)


def test_a_failed_refresh_keeps_the_table_before(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="stop here"):
        files.write_table(spark.range(5).select(F.raise_error(F.lit("stop here")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    files.write_table(spark.range(5).withColumn("p", F.col("id") % 2), path, ["p"])
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_a_half_landed_month_is_landed_again(spark, tmp_path):
    (tmp_path / "month=2024-01" / "_temporary").mkdir(parents=True)
    files.land_month(spark.range(3), str(tmp_path), "2024-01")
    assert spark.read.parquet(str(tmp_path / "month=2024-01")).count() == 3


@pytest.mark.parametrize(("amounts", "mean"), [([2e15, 0.0], 1e15), ([1.005, 1.005], 1.01), ([None, 3.0], 3.0), ([None], None)])
def test_mean_of_any_amount(spark, amounts, mean):
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert df.agg(mean_amount("a").alias("m")).first().m == mean


def test_mean_with_nan_is_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "a double")
    assert df.agg(F.isnan(mean_amount("a")).alias("m")).first().m


def test_salted_join_takes_map_columns(spark):
    facts = spark.sql("SELECT id % 2 AS k, map('a', id) AS m FROM range(8)")
    dim = spark.sql("SELECT id AS k, 'd' || id AS name FROM range(2)")
    assert salted_join(facts, dim, ["k"], "left", 4).where("name = 'd' || k").count() == 8


def test_many_rows_in_few_bytes_are_not_broadcast(spark, tmp_path):
    spark.range(50_000).select(F.lit(1).alias("k")).write.parquet(str(tmp_path / "d"))
    dim = spark.read.parquet(str(tmp_path / "d"))
    assert not sized_for_broadcast(dim, Settings(broadcast_rows=10_000))[1]
    assert sized_for_broadcast(dim, Settings(broadcast_rows=50_000))[1]


def test_dead_letter_schema_with_a_comma_in_a_type(spark):
    df = spark.createDataFrame([('{"k": 1, "amt": 2.50}',), ("{",)], "payload string")
    out = fleet.with_parse_lane(df, schema="k INT, amt DECIMAL(10,2)").select("k", F.col("amt").cast("string"), "lane").collect()
    assert {tuple(r) for r in out} == {(1, "2.50", "accepted"), (None, None, "dead_letter")}
