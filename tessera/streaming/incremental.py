"""Incremental forms: first-seen deduplication, log windows and resumable batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.functions import text as X


def chunks(spark: SparkSession, path: str, schema: StructType, files: int = 1, kind: str = "parquet") -> DataFrame:
    """A folder as a bounded stream, so many files at a time."""
    return spark.readStream.schema(schema).format(kind).option("maxFilesPerTrigger", files).load(path)


def first_seen(stream: DataFrame, key: str, event_time: str | None = None, late: str = "7 days") -> DataFrame:
    """Each key once across all batches. With an event time, keys are forgotten after the watermark, which bounds the state."""
    if event_time:
        timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, late)
        return timed.dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def new_titles(stream: DataFrame) -> DataFrame:
    """Records whose light title key has not been seen; empty titles go."""
    return first_seen(stream.withColumn("title_key", X.light_title_key(F.col("title"))).where("title_key <> ''"), "title_key")


def log_windows(stream: DataFrame, size: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """Entries and mean duration by window and level; entries later than the watermark are left out."""
    timed = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    span = F.window("timestamp", size, slide) if slide else F.window("timestamp", size)
    return timed.groupBy(span.alias("window"), "level").agg(F.count(F.lit(1)).alias("n"), F.sum("duration").alias("total"))


def log_sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Runs of a module's entries without a pause of gap."""
    timed = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    return timed.groupBy(F.session_window("timestamp", gap).alias("session"), "module").agg(F.count(F.lit(1)).alias("n"))


def run_to_end(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """All that is there now, written as Parquet; a second run goes on where the first ended."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return query


def batches(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """process for each micro-batch. A batch that is repeated after a failure overwrites its own folder, so that each counts once."""

    def one(df: DataFrame, number: int) -> None:
        process(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def isolated(df: DataFrame, process: Callable[[pd.DataFrame], pd.DataFrame], schema: str, parts: int = 4) -> DataFrame:
    """process over batches, with a column error added to schema.

    A batch that fails is split into parts and tried again, down to single rows; a row that fails by itself gives one row of nulls with its error,
    and costs no other row.
    """
    names = StructType.fromDDL(schema).names

    def tried(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        try:
            yield process(batch)[names].assign(error=None)
        except Exception as e:  # noqa: BLE001
            if len(batch) == 1:
                yield pd.DataFrame([[None] * len(names) + [f"{type(e).__name__}: {e}"]], columns=[*names, "error"])
                return
            step = -(-len(batch) // parts)
            for at in range(0, len(batch), step):
                yield from tried(batch.iloc[at : at + step])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield from tried(batch)

    return df.mapInPandas(run, f"{schema}, error string")
