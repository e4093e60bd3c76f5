"""The folder that driver and executors share, and tables written there to end lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a temporary folder of a local session. On a cluster it must be set."""
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, _own_dirs[context.applicationId], ignore_errors=True)
    return _own_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def delete(*done: DataFrame) -> None:
    """Delete written tables that nothing reads any more.

    What was derived from them must be written itself, so that a lost executor needs none of them.
    """
    for df in done:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)  # noqa: SLF001
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)  # noqa: SLF001
