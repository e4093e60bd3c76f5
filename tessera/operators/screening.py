"""The screening sheet: order, ids, scores, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import pairwise
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scores as S
from tessera.operators.ordering import numbered, quantiles
from tessera.storage import written

# The sheet's exclusion reasons, code, reason, stage.
REASONS = (
    ("E1", "Not a wargame/conflict simulation", "Title/Abstract"),
    ("E2", "No LLM or LLM <100M params", "Title/Abstract"),
    ("E3", "No natural language interaction", "Title/Abstract"),
    ("E4", "Not empirical (opinion/editorial)", "Title/Abstract"),
    ("E5", "Wrong publication type", "Title/Abstract"),
    ("E6", "Full text not available", "Full Text"),
    ("E7", "Not in English (no translation)", "Full Text"),
    ("E8", "Duplicate publication", "Any"),
)
# The sheet's instructions, step, instruction, note.
INSTRUCTIONS = (
    ("Title/Abstract Screening", 'Review title and abstract. Mark include_ta as "yes", "no", or "maybe".', 'If "no", provide reason in reason_ta column'),
    ("Inclusion Criteria", "Paper must: (1) Use LLM ≥100M params, (2) Involve wargaming/conflict simulation, (3) Have natural language interaction", "See review protocol for detailed criteria"),
    ("Full-Text Screening", 'For papers marked "yes" or "maybe" in title/abstract, review full text', 'Mark include_ft as "yes" or "no" with reason'),
    ("Quality Scoring", "Rate relevance (1-5) and quality (1-5) for included papers", "5 = highly relevant/excellent quality"),
)
# The words that raise a record in the screening order.
PRIORITY = ("wargame", "war game", "crisis simulation", "llm", "large language model", "gpt", "claude")
DECISIONS = ("include_ta", "reason_ta", "notes_ta", "include_ft", "reason_ft", "notes_ft", "screener_ta", "screened_ta_date", "screener_ft", "screened_ft_date", "relevance_score", "quality_score")
#: Columns that a sheet begins with, as far as it has them.
FIRST = ("screening_id", "title", "authors", "year", "venue", "abstract", "doi", "url", "source_db", "include_ta", "reason_ta", "notes_ta", "include_ft", "reason_ft", "notes_ft", "relevance_score", "quality_score", "pdf_path", "pdf_status")


def bucketed(df: DataFrame, value: str, buckets: int = 5, name: str = "bucket") -> DataFrame:
    """df with a bucket, 1 to buckets, of each row's value; null counts as 0.

    Edges are exact quantiles, as many as there are buckets, or different values if these are fewer; an edge belongs to
    the bucket below it. Where edges coincide, the dense rank is scaled to 1 .. buckets, halves to even. A single value
    is in the middle bucket. The different values are a table, however many; only the edges come to the driver.
    """
    filled = F.coalesce(F.col(value), F.lit(0))
    values = written(df.groupBy(filled.alias("__value")).agg(F.count(F.lit(1)).alias("__count")), "bucket-values")
    different = values.count()
    if different <= 1:
        return df.withColumn(name, F.lit((buckets + 1) // 2))
    q = min(buckets, different)
    edges = quantiles(values, "__value", "__count", [i / q for i in range(q + 1)])
    if all(a < b for a, b in pairwise(edges)):
        return df.withColumn(name, reduce(add, [F.when(filled > e, 1).otherwise(0) for e in edges[1:-1]], F.lit(1)))
    ranks = numbered(values, [F.col("__value")], "__rank")
    scaled = F.bround((F.col("__rank") - 1) / (different - 1) * (buckets - 1) + 1).cast("int")
    keyed = df.withColumn("__value", filled)
    return keyed.join(ranks.select("__value", scaled.alias(name)), "__value").drop("__value")


def order_score(keywords: Sequence[str], as_of_year: int, citation_bucket: Column) -> Column:
    """Title hits count 2, abstract hits 1, up to 5 for recent years, and the citation bucket."""
    title, abstract = F.lower(F.coalesce(F.col("title"), F.lit(""))), F.lower(F.coalesce(F.col("abstract"), F.lit("")))
    words = reduce(add, [F.when(F.contains(title, F.lit(k)), 2).otherwise(0) + F.when(F.contains(abstract, F.lit(k)), 1).otherwise(0) for k in keywords], F.lit(0))
    return words + F.greatest(F.lit(0), F.lit(5) - (F.lit(as_of_year) - F.col("year"))) + citation_bucket


def sheet(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in screening order with SCREEN_ ids; decision columns empty, and source, duplicate and language flags set, where they are missing."""
    out = numbered(df, order)
    out = out.withColumn("screening_id", F.format_string("SCREEN_%04d", F.col("position")))
    missing = dict.fromkeys(DECISIONS, "") | {"source_db": "unknown", "potential_duplicate": "", "language_detected": "en"}
    out = out.select("*", *[F.lit(v).alias(c) for c, v in missing.items() if c not in out.columns])
    first = [c for c in FIRST if c in out.columns]
    return out.select(*first, *[c for c in out.columns if c not in first])


def by_id(df: DataFrame, screening_id: str) -> DataFrame:
    """The row of a screening id."""
    return df.where(F.col("screening_id") == screening_id)


def statistics(df: DataFrame, decision: str, reason: str) -> DataFrame:
    """Counts by decision, and of reasons, in one table: kind, value, n. Empty decisions count as unscreened."""
    value = F.coalesce(F.nullif(F.lower(F.trim(F.col(decision))), F.lit("")), F.lit("unscreened"))
    by_decision = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("decision").alias("kind"), "value", "n")
    by_reason = df.where(F.coalesce(F.trim(F.col(reason)), F.lit("")) != "").groupBy(F.col(reason).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return by_decision.unionByName(by_reason.select(F.lit("reason").alias("kind"), "value", "n"))


def reasons_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REASONS), "code string, reason string, stage string")


def instructions_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(INSTRUCTIONS), "step string, instructions string, notes string")


def asreview(df: DataFrame) -> DataFrame:
    """The seven columns of a screening tool's import, included as 1, 0 or -1."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return df.select("title", "abstract", "authors", "year", blank("doi"), blank("url"), S.included_code(F.col("include_ta")).alias("included"))
