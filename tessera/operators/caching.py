"""Caches as tables: what is missing, valid, too old, and how entries are replaced."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def older_than(column: str, days: int, now: Column | None = None) -> Column:
    """Whether a time is more than so many days before now (the query's own time unless given)."""
    return F.col(column) < (F.current_timestamp() if now is None else now) - F.make_dt_interval(F.lit(days))


def valid(entries: DataFrame, files: DataFrame, days: int = 90, now: Column | None = None) -> DataFrame:
    """Entries (file_path, file_hash, created_at) that are young enough and whose file is there with the hash on record.

    files: path, sha256, as extraction.binary_files reads them.
    """
    young = entries.where(~older_than("created_at", days, now))
    here = files.select(F.col("path").alias("file_path"), F.col("sha256").alias("file_hash"))
    return young.join(here, ["file_path", "file_hash"], "left_semi")


def kept(entries: DataFrame, days: int | None = None, content_type: str | None = None, now: Column | None = None) -> DataFrame:
    """Entries that a cleanup leaves: those not older than days and not of the type; a bound that isn't given removes nothing, and none removes all."""
    if days is None and content_type is None:
        return entries.limit(0)
    gone = F.lit(True)
    gone = gone & older_than("created_at", days, now) if days is not None else gone
    gone = gone & (F.col("content_type") == content_type) if content_type is not None else gone
    return entries.where(~F.coalesce(gone, F.lit(False)))


def get_or_fetch(wanted: DataFrame, entries: DataFrame, fetch: Callable[[DataFrame], DataFrame], days: int = 90, now: Column | None = None) -> DataFrame:
    """wanted (paper_id, content_type) with the entries' columns: fresh entries as they are, counted once more, and the others fetched.

    fetch: rows of wanted -> entries. Each missing key is fetched once, however often it is wanted.
    """
    keys = ["paper_id", "content_type"]
    fresh = entries.where(~older_than("created_at", days, now))
    asked = wanted.select(*keys).distinct()
    hits = fresh.join(asked, keys, "left_semi").withColumn("access_count", F.coalesce("access_count", F.lit(0)) + 1)
    return hits.unionByName(fetch(asked.join(fresh.select(*keys), keys, "left_anti")), allowMissingColumns=True)


def upserted(table: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """table with rows put in: of each key the first by order, new rows before old where order ties. Null is a key like any other."""
    both = rows.withColumn("__new", F.lit(1)).unionByName(table.withColumn("__new", F.lit(0)), allowMissingColumns=True)
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order, F.desc("__new")))
    return both.withColumn("__r", first).where("__r = 1").drop("__r", "__new")
