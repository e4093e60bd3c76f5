"""Places in a total order, running sums and exact quantiles, without putting all rows into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.storage import new_path, written


def _dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """df sorted by range, with __part and __at (place within it, from 0), written once.

    A sort that runs twice may cut its ranges differently; what is counted and what is numbered must be one run.
    """
    ranged = written(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()), "ordered")
    return ranged.withColumn("__part", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND((1 << 33) - 1)).drop("__id")


def _starts(dealt: DataFrame, amount: Column, kind: str) -> DataFrame:
    """What all earlier parts hold, a row per part."""
    counts = sorted((r["__part"], r["n"]) for r in dealt.groupBy("__part").agg(amount.alias("n")).collect())
    starts, start = [], 0
    for part, n in counts:
        starts.append((part, start))
        start += n or 0
    return F.broadcast(dealt.sparkSession.createDataFrame(starts, f"__part long, __start {kind}"))


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """df with each row's place in the total order, from 1, gapless.

    Rows are sorted by range; each part counts its rows, and the counts before it shift its numbers.
    order should make rows unique, else ties are numbered as they come.
    """
    dealt = _dealt(df, order)
    placed = dealt.join(_starts(dealt, F.count(F.lit(1)), "long"), "__part")
    return placed.withColumn(name, F.col("__start") + F.col("__at") + 1).drop("__part", "__at", "__start")


class Pages:
    """A sorted, written table whose pages are found by the row counts of its parts: a page, however deep, reads the parts that it lies in."""

    def __init__(self, df: DataFrame, order: Sequence[Column]) -> None:
        self.columns = df.columns
        self.path = new_path(df.sparkSession, "pages")
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        placed.write.partitionBy("__part").parquet(self.path)
        self.table = df.sparkSession.read.schema(placed.schema).parquet(self.path)
        self.starts, at = [], 0  # a row per part
        for r in sorted(self.table.groupBy("__part").count().collect(), key=lambda r: r["__part"]):
            self.starts.append((r["__part"], at, r["count"]))
            at += r["count"]

    def page(self, start: int, rows: int) -> DataFrame:
        """Rows start to start + rows, in order."""
        held = [(p, max(0, start - at), min(n, start + rows - at)) for p, at, n in self.starts if at < start + rows and start < at + n]
        chosen = reduce(lambda x, y: x | y, [(F.col("__part") == p) & (F.col("__at") >= a) & (F.col("__at") < b) for p, a, b in held], F.lit(False))
        return self.table.where(F.col("__part").isin([p for p, _, _ in held])).where(chosen).orderBy("__part", "__at").select(*self.columns)


def running(df: DataFrame, order: Sequence[Column], amount: str, name: str = "before") -> DataFrame:
    """df with the sum of a whole-number column over all earlier rows."""
    dealt = _dealt(df, order)
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(_starts(dealt, F.sum(amount), "long"), "__part").withColumn(name, F.col("__start") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return placed.drop("__part", "__at", "__start")


def quantiles(values: DataFrame, value: str, count: str, probabilities: Sequence[float]) -> list[float]:
    """Exact quantiles, linearly interpolated, of values with their counts (a row per different value)."""
    placed = written(running(values, [F.col(value)], count, "__before"), "quantiles")
    total = placed.agg(F.sum(count)).first()[0] or 0
    if not total:
        return []
    at = [p * (total - 1) for p in probabilities]
    wanted = sorted({f(h) for h in at for f in (math.floor, math.ceil)})
    rank = F.explode(F.array(*map(F.lit, wanted)))  # two per probability
    found = placed.withColumn("__rank", rank).where((F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__before") + F.col(count)))
    by_rank = {r["__rank"]: float(r[value]) for r in found.select("__rank", value).collect()}
    return [by_rank[math.floor(h)] + (by_rank[math.ceil(h)] - by_rank[math.floor(h)]) * (h - math.floor(h)) for h in at]
