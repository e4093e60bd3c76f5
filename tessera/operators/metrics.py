"""Statistics and summaries as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, *by: Column | str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, by: str, limit: int = 10) -> DataFrame:
    """The most frequent values, ties by value."""
    return counts(df.where(F.coalesce(F.col(by).cast("string"), F.lit("")) != ""), by).orderBy(F.desc("n"), by).limit(limit)


def top_members(df: DataFrame, column: str, separator: str = ";", limit: int = 10) -> DataFrame:
    """The most frequent members of a delimited list."""
    members = df.select(F.explode(F.split(F.coalesce(F.col(column), F.lit("")), separator)).alias("value")).select(F.trim("value").alias("value"))
    return top(members, "value", limit)


def shares(df: DataFrame, by: str) -> DataFrame:
    """Counts and percentages of a column's values; the window is over one row per value."""
    return counts(df, by).withColumn("percentage", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def trend(df: DataFrame, year: str = "year") -> DataFrame:
    """Records per year with a linear trend over the years' positions 0, 1, ... (null for two years or fewer)."""
    by_year = counts(df.where(F.col(year) > 0), year).withColumn("position", F.row_number().over(Window.orderBy(year)) - 1)  # a row per year
    every = Window.partitionBy()
    slope, start = F.regr_slope(F.col("n").cast("double"), F.col("position").cast("double")), F.regr_intercept(F.col("n").cast("double"), F.col("position").cast("double"))
    enough = F.count(F.lit(1)).over(every) > 2
    return by_year.select(year, "n", F.when(enough, F.round(slope.over(every), 6)).alias("slope"), F.when(enough, F.round(start.over(every) + slope.over(every) * F.col("position"), 6)).alias("fitted"))


def histogram(df: DataFrame, value: str, first: int, last: int) -> DataFrame:
    """A count for each integer from first to last, zeros included."""
    grid = df.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(value))
    own = df.where(F.col(value).between(first, last)).groupBy(F.col(value).cast("int").alias(value)).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(grid).join(own, value, "left").select(value, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Count, mean, median and extremes by group."""
    return df.groupBy(by).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.median(value), 6).alias("median"), F.min(value).alias("least"), F.max(value).alias("most"))


def quality(df: DataFrame) -> DataFrame:
    """One row: records, with abstract, with DOI, years, sources."""
    some = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return df.agg(F.count(F.lit(1)).alias("records"), some("abstract").alias("with_abstract"), some("doi").alias("with_doi"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("source_db").alias("sources"))


def examples(df: DataFrame, by: str, order: Sequence[Column], per_group: int = 2, groups: int = 5) -> DataFrame:
    """The first rows of each of the most frequent groups."""
    most = top(df, by, groups).select(by)
    return df.join(F.broadcast(most), by, "left_semi").withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= per_group)


def cross_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of two columns with their share of all rows."""
    return counts(df, a, b).withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def log_summary(df: DataFrame, start: str, end: str) -> DataFrame:
    """By module and level: entries, mean and longest duration, in a time range pushed to the scan."""
    kept = df.where((F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))
    return kept.groupBy("module", "level").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("duration"), 6).alias("mean"), F.max("duration").alias("longest"))


def latest(df: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """The latest row of each key: an append-only table read as an upserted one. Of rows of one time the greatest by its other columns, in order."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max(F.struct(F.col(at).alias("__at"), *rest)).alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def quotas(df: DataFrame, total: int, weights: dict[str, float], default: float = 0.2) -> DataFrame:
    """Per source its share of total by weight, with a floor, scaled back if the sum is above total; whole numbers by truncation."""
    n = df.count()
    floor = max(100.0, total / (10 * max(1, n)))
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.lit(None)
    weight = F.coalesce(table[F.col("source_db")], F.lit(default)) if weights else F.lit(default)
    raised = df.withColumn("q", F.greatest(F.lit(floor), weight * total)).withColumn("all", F.sum("q").over(Window.partitionBy()))
    return raised.select("source_db", F.when(F.col("all") > total, F.col("q") * total / F.col("all")).otherwise(F.col("q")).cast("long").alias("quota"))
