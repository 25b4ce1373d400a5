"""Scans and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hourly variables of the served weather payload.
HOURLY_VARIABLES = (
    ("temperature_2m", "double"),
    ("apparent_temperature", "double"),
    ("precipitation", "double"),
    ("rain", "double"),
    ("snowfall", "double"),
    ("wind_speed_10m", "double"),
    ("weather_code", "int"),
)
#: Footers that the driver reads at a time, where files drifted.
FOOTERS_AT_ONCE = 32
ZONE_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
PAYLOAD_SCHEMA = (
    "latitude DOUBLE, longitude DOUBLE, hourly STRUCT<time: ARRAY<STRING>, "
    + ", ".join(f"{n}: ARRAY<{t}>" for n, t in HOURLY_VARIABLES)
    + ">"
)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    order = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if type(a) in order and type(b) in order:
        # A long does not fit a float, so any mix with a fraction is a double.
        pick = max(a, b, key=lambda t: order.index(type(t)))
        return T.DoubleType() if isinstance(pick, T.FloatType) else pick
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    return T.StringType()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns match by name without regard to case.

    A column that a frame lacks is null there. Types that differ are widened, to
    text if nothing else holds both. The first spelling of a name is kept.
    """
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            key = f.name.lower()
            names.setdefault(key, f.name)
            types[key] = _wider(types[key], f.dataType) if key in types else f.dataType
    aligned = []
    for df in frames:
        own = {f.name.lower(): f.name for f in df.schema.fields}
        aligned.append(
            df.select(
                *[
                    (F.col(f"`{own[k]}`") if k in own else F.lit(None)).cast(types[k]).alias(names[k])
                    for k in names
                ]
            )
        )
    return reduce(DataFrame.unionAll, aligned)


def _merged_scan(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame | None:
    """One scan whose schema Spark merges from all footers, in parallel; None where types drifted
    or some paths are partitioned in another way than others."""
    try:
        return spark.read.options(mergeSchema=True, **options).parquet(*paths)
    except Py4JJavaError as error:  # Spark raises this one unconverted
        condition = getattr(error.java_exception, "getCondition", None)
        if condition is None or condition() != "CANNOT_MERGE_SCHEMAS":
            raise
    except PySparkException as error:
        if error.getCondition() != "CONFLICTING_DIRECTORY_STRUCTURES" or len(paths) < 2:
            raise
    return None


def _files(spark: SparkSession, path: str) -> list[tuple[str, str | None]]:
    """The files that Spark reads for a path, whatever their names, and the folder that their partition columns count from."""
    fs, at = file_system(spark, path)
    files: list[tuple[str, str | None]] = []
    for found in fs.globStatus(at(path)) or ():
        root = found.getPath().toString()
        if found.isFile():
            files.append((root, None))
            continue
        # Any format lists a folder alike; this one opens no file for it.
        listed = spark.read.format("binaryFile").load(root).select("path")
        for row in listed.toLocalIterator():
            below = row["path"].removeprefix(root).strip("/").split("/")[:-1]
            files.append((row["path"], root if any("=" in part for part in below) else None))
    return files


def _footer(spark: SparkSession, path, read: Callable):
    """What ``read`` takes from the footer of a Parquet file."""
    hadoop = spark._jvm.org.apache.parquet.hadoop
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(at, spark._jsparkSession.sessionState().newHadoopConf()))
    try:
        return read(reader)
    finally:
        reader.close()


def _footer_schema(spark: SparkSession, path: str) -> str:
    return _footer(spark, path, lambda reader: reader.getFileMetaData().getSchema().toString())


def rows_in_files(df: DataFrame, most_files: int = 8) -> int | None:
    """Rows of the Parquet files that a frame reads, by their footers and without a job; None if there are none,
    more than ``most_files``, or others."""
    spark, found = df.sparkSession, df.inputFiles()
    if not 0 < len(found) <= most_files:
        return None
    try:
        return sum(_footer(spark, spark._jvm.java.net.URI(f), lambda reader: reader.getRecordCount()) for f in found)
    except Py4JJavaError:
        return None


def _scan_per_schema(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """One scan for each schema that the files have, and each folder their partition columns count from.

    Each footer is read once, several at a time. The number of scans is that of the
    schemas, in whatever order the files come.
    """
    found = sorted({f for path in paths for f in _files(spark, path)}, key=lambda f: f[0])
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = pool.map(lambda f: _footer_schema(spark, f[0]), found)
    groups: dict[tuple[str, str | None], list[str]] = {}
    for (path, base), schema in zip(found, schemas):
        groups.setdefault((schema, base), []).append(path)
    return [spark.read.options(**({"basePath": base} if base else {})).parquet(*files) for (_, base), files in groups.items()]


def scan_union_by_name(
    spark: SparkSession, paths: Iterable[str], lineage: str = "_ingested_from", row: str | None = None
) -> DataFrame:
    """Parquet files of drifting schemas as one table, each row with its file's path.

    ``row`` names a further column with the row's number in its file; path and
    number together identify a row for good. Landed files that have these columns keep them. Where all types agree Spark merges the
    schemas itself, reading the footers in parallel, and one scan is enough. Where a
    type drifted, as from whole numbers to fractions, the files are grouped by the
    schema in their footer, and the scans, one for each schema, are widened.
    """
    paths = list(paths)
    origin = {lineage: F.col("_metadata.file_path")} | ({row: F.col("_metadata.row_index")} if row else {})
    scan = _merged_scan(spark, paths)
    scans = [scan] if scan is not None else _scan_per_schema(spark, paths)
    frames = [x.select("*", *[c.alias(n) for n, c in origin.items() if n not in x.columns]) for x in scans]
    return frames[0] if len(frames) == 1 else union_by_name(frames)


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup: a header and four columns, read with a fixed schema."""
    return spark.read.csv(path, header=True, schema=ZONE_SCHEMA)


def read_weather_json(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Landed payloads, one JSON document per file, as hourly rows."""
    texts = spark.read.text(path, wholetext=True)
    return flatten_weather_json(texts, "value", source)


def flatten_weather_json(df: DataFrame, column: str, source: str) -> DataFrame:
    """Columnar JSON (an object of parallel arrays) to one row per hour."""
    parsed = df.select(F.from_json(F.col(column), PAYLOAD_SCHEMA).alias("p"))
    arrays = [F.col("p.hourly.time").alias("observed_at_raw")]
    arrays += [F.col(f"p.hourly.{n}").alias(n) for n, _ in HOURLY_VARIABLES]
    named = parsed.select(F.col("p.latitude").alias("latitude"), F.col("p.longitude").alias("longitude"), *arrays)
    columns = ["observed_at_raw", *[n for n, _ in HOURLY_VARIABLES]]
    return named.select("latitude", "longitude", F.inline(F.arrays_zip(*columns))).select(
        *columns, F.lit(source).alias("source"), "latitude", "longitude"
    )


def with_lineage(df: DataFrame, origin: Column | str, name: str = "_ingested_from") -> DataFrame:
    """A constant or computed provenance column."""
    return df.withColumn(name, F.lit(origin) if isinstance(origin, str) else origin)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), verify: Callable[[DataFrame], None] | None = None
) -> None:
    """Full refresh: written beside the table, swapped in after success.

    ``verify`` gets the written rows before the swap and may raise. A write that fails or isn't verified leaves the table before as it was. Between the two renames of the
    swap the table is under ``<path>.old-...``; nothing is removed before the new one is in place.
    """
    path = path.rstrip("/")
    mark = uuid.uuid4().hex
    fresh, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    fs, at = file_system(df.sparkSession, path)
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(fresh)
        if verify is not None:
            verify(df.sparkSession.read.schema(df.schema).parquet(fresh))
    except Exception:
        fs.delete(at(fresh), True)
        raise
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(old)):
        raise OSError(f"{path} could not be set aside; the new table is in {fresh}")
    if not fs.rename(at(fresh), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"{fresh} could not be moved to {path}")
    if had:
        fs.delete(at(old), True)


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, as Spark sees it, and how it names paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def append_by_region_and_day(df: DataFrame, path: str, region: str, ts: str) -> None:
    """Append-only landing under ``region/year/month/day``."""
    at = F.col(ts)
    parted = df.withColumns(
        {"region": F.col(region), "year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}
    )
    keys = ("region", "year", "month", "day")
    # Even files per day; a hot day is split over several tasks.
    parted.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(path)


def has_landed(spark: SparkSession, path: str, month: str) -> bool:
    """If a month landed whole; a folder without ``_SUCCESS`` is what a crash left."""
    done = f"{path.rstrip('/')}/month={month}/_SUCCESS"
    fs, at = file_system(spark, done)
    return fs.exists(at(done))


def land_month(df: DataFrame, path: str, month: str, force: bool = False) -> None:
    """One month into its folder: a month that landed whole is kept unless forced."""
    folder = f"{path.rstrip('/')}/month={month}"
    if force or not has_landed(df.sparkSession, path, month):
        df.write.mode("overwrite").parquet(folder)


def named_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Written tables by name."""
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in names}


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a view for SQL users."""
    df.createOrReplaceTempView(name)
    return df
