"""Resumable batch jobs: rows, errors and progress of a batch become visible together, once."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.store import Conflict, Log
from tessera.streaming.incremental import isolated

PROGRESS = "job_id string, batch_id int, status string, n_rows long, n_errors long, seconds double"


class Job:
    """A job's folder: a data folder per batch, and a log whose newest version lists the batches that are done.

    A batch is written first and published then, with its counts. A run that dies between leaves a folder that no version names; the next run
    does that batch again, and each row counts once. Runs may share the batches: who publishes one first has done it.
    """

    def __init__(self, spark: SparkSession, path: str, job_id: str) -> None:
        self.spark, self.job_id = spark, job_id
        self.log = Log(spark, f"{path.rstrip('/')}/{job_id}")

    def done(self) -> dict[str, dict]:
        return (self.log.latest()[1] or {}).get("batches", {})

    def _publish(self, batch: int, said: dict) -> bool:
        while True:
            number, before = self.log.latest()
            batches = (before or {}).get("batches", {})
            if str(batch) in batches:
                self.log.forget(said["folder"])
                return False
            try:
                self.log.publish(number + 1, {"batches": batches | {str(batch): said}})
                return True
            except Conflict:
                continue

    def run(self, rows: DataFrame, key: str, process: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batches: int, after: Callable[[int], None] | None = None) -> int:
        """process over the batches that aren't done; how many this run did. Batches are dealt by the hash of key, so that each run deals alike.

        A row that fails gives a row of nulls with its error and costs no other. after: called with each batch that this run has published.
        """
        n = 0
        for batch in range(batches):
            if str(batch) in self.done():
                continue
            began, folder = time.time(), f"batch-{batch}-{uuid.uuid4().hex}"
            own = rows.where(F.pmod(F.xxhash64(key), F.lit(batches)) == batch)
            isolated(own, process, schema).write.parquet(f"{self.log.path}/{folder}")
            kept = self.spark.read.schema(f"{schema}, error string").parquet(f"{self.log.path}/{folder}").agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("e")).first()
            if self._publish(batch, {"folder": folder, "rows": kept["n"] - kept["e"], "errors": kept["e"], "seconds": round(time.time() - began, 3)}):
                n += 1
                if after:
                    after(batch)
        return n

    def output(self, schema: str) -> DataFrame:
        """Rows and errors of all batches that are done, with batch_id."""
        full = T.StructType.fromDDL(f"{schema}, error string")
        done = self.done()
        if not done:
            return self.spark.createDataFrame([], full).withColumn("batch_id", F.lit(None).cast("int"))
        read = self.spark.read.schema(full).parquet(*[f"{self.log.path}/{x['folder']}" for x in done.values()])
        return read.withColumn("batch_id", F.regexp_extract(F.input_file_name(), r"/batch-(\d+)-", 1).cast("int"))

    def progress(self) -> DataFrame:
        """A row per batch that is done; partial where rows failed."""
        rows = [(self.job_id, int(b), "partial" if x["errors"] else "completed", x["rows"], x["errors"], x["seconds"]) for b, x in self.done().items()]
        return self.spark.createDataFrame(rows, PROGRESS)
