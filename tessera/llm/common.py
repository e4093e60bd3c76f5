"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.storage import delete, written  # noqa: F401 - the operators take both from here

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space of the word definitions: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sweep(spark: SparkSession, *done: DataFrame) -> None:
    """Delete written tables that nothing reads any more, and let Spark remove the shuffle files of finished jobs."""
    delete(*done)
    gc.collect()
    spark._jvm.System.gc()  # noqa: SLF001 - the cleaner acts on what the driver has let go


#: Rows and bytes that a Python worker holds at a time, unless the session says otherwise: setting, Spark's default, value. Texts may be long.
BATCHES = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4194304b"))


def bounded_batches(spark: SparkSession) -> None:
    """Lower Arrow's batches from their defaults; a value that the user chose stays."""
    for name, default, value in BATCHES:
        if spark.conf.get(name, None) == default:
            spark.conf.set(name, value)


def release() -> None:
    """Give freed memory back to the system, since a worker process outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_map(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, forget: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow with bounded batches, whose workers release their memory after each task; forget empties a module's caches."""
    bounded_batches(df.sparkSession)

    def tidy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            release()

    return df.mapInArrow(tidy, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)  # then lower() does the same, faster
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than BLANKS, as long; 0 for null."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")
