"""Filters and rule tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import scores as S


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def text_of(title: str = "title", abstract: str = "abstract") -> Column:
    return F.lower(F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(abstract), F.lit(""))))


def in_years(df: DataFrame, first: int, last: int) -> DataFrame:
    return df.where((F.col("year") != 0) & F.col("year").between(first, last))


def valid(df: DataFrame, first: int, last: int, abstract_chars: int = 50) -> DataFrame:
    """With a title, a year in range and an abstract of more than so many characters."""
    return df.where((F.coalesce(F.trim("title"), F.lit("")) != "") & F.col("year").between(first, last) & (F.length("abstract") > abstract_chars))


def by_keywords(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (), least: int = 1) -> DataFrame:
    """Without any excluded keyword and with at least so many included ones; without keywords all stay."""
    if not include and not exclude:
        return df
    text = text_of()
    out = df.where(F.coalesce(F.col("abstract"), F.lit("")) != "")
    if exclude:
        out = out.where(S.hits(text, [k.lower() for k in exclude]) == 0)
    return out.where(S.hits(text, [k.lower() for k in include]) >= least) if include else out


def disambiguated(df: DataFrame, rules: dict[str, tuple[Sequence[str], Sequence[str]]], needs_positive: Sequence[str] = ()) -> DataFrame:
    """df with excluded and reason: the first rule of which a negative term occurs.

    rules: name -> (positive terms, negative terms). A rule in needs_positive excludes only texts without its positive terms.
    """
    text = text_of()
    reason = F.coalesce(*[F.when(any_of([F.contains(text, F.lit(t.lower())) for t in bad]) & (~any_of([F.contains(text, F.lit(t.lower())) for t in good]) if name in needs_positive else F.lit(True)), F.lit(name)) for name, (good, bad) in rules.items()], F.lit(None).cast("string"))
    return df.withColumn("reason", reason).withColumn("excluded", F.col("reason").isNotNull())


def grey_literature(df: DataFrame, domains: Sequence[str]) -> DataFrame:
    """df with grey_lit_flag: a domain occurs in url or source."""
    where = F.concat_ws(" ", F.lower("url"), F.lower("source_db"))
    return df.withColumn("grey_lit_flag", any_of([F.contains(where, F.lit(d.lower())) for d in domains]))


def auto_included(df: DataFrame, score: Column, threshold: int = 6) -> DataFrame:
    yes = F.col("auto_relevance_score") >= threshold
    return df.withColumn("auto_relevance_score", score).withColumn("auto_include", yes).withColumn("auto_include_reason", F.when(yes, F.concat(F.lit("score "), F.col("auto_relevance_score").cast("string"))).otherwise(F.lit("below threshold")))


def selected(df: DataFrame) -> DataFrame:
    """Included rows by the latest decision that anyone has taken: full text, title and abstract, automatic; else all."""
    yes = lambda c: F.lower(F.col(c).cast("string")).isin("yes", "1", "true")
    known = [c for c in ("include_ft", "include_ta", "auto_include") if c in df.columns]
    if not known:
        return df
    taken = df.agg(*[F.max(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "").alias(c) for c in known]).first()
    column = next((c for c in known if taken[c]), None)
    return df.where(yes(column)) if column else df


def ready_for_extraction(df: DataFrame, with_arxiv: bool = False) -> DataFrame:
    """With a fetched file, or, if allowed, an arXiv id to fetch one by."""
    fetched = (F.coalesce(F.col("pdf_path"), F.lit("")) != "") & (F.col("pdf_status").startswith("downloaded") | (F.col("pdf_status") == "cached"))
    return df.where(fetched | (F.coalesce(F.col("arxiv_id"), F.lit("")) != "")) if with_arxiv else df.where(fetched)
