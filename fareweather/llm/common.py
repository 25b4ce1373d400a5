"""Reading the given tables, cutting lineage, and small column helpers."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a class for a regular expression.
SPACE = r"[\x20\x09-\x0D]"
#: Bytes of a batch of rows for Python tasks, about, in ``small_batches``.
BATCH_BYTES = 8_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all executors share. Only a session without
    one, as in tests on one machine, gets a temporary folder."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder, so that nothing below is computed again and no
    lost executor takes them along. Shuffle files of earlier steps are let go: Spark removes
    them once the driver has collected the plans that nothing refers to any more."""
    shared_folder(df.sparkSession)
    done = df.checkpoint()
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return done


def let_go(spark: SparkSession) -> None:
    """Shuffle files that no living plan needs are removed; ``cut`` can't do so for the plan it is given."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run in here hand rows to Python in batches of few bytes, whatever the length of texts: an executor holds a batch
    for each core outside its heap, and more while it grows. The session's own limit holds again afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that the table doesn't have yet, in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def held_out(doc_id: Column) -> Column:
    """The fifth of the rows whose labels are never learnt from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def once(key: tuple, make: Callable):
    """What ``make`` returns, made once in a Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("llm_worker_values", types.ModuleType("llm_worker_values")).__dict__.setdefault("values", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def give_back() -> None:
    """Memory that a Python worker has freed goes back to the system. Arrow's pool and the C library keep it otherwise, and a
    worker lives on after its task: what it keeps counts against its executor while other steps run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's ``work`` on batches, after each of which and at the end freed memory is given back."""
    def done(batches: Iterator) -> Iterator:
        def each() -> Iterator:
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from work(each())
        give_back()

    return done
