"""Deduplication of records, exact and by similarity. "First" is always by an explicit order column."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.ordering import numbered
from tessera.operators.titles import greedily_dropped, indel_at_least, indel_ratio, matcher_above
from tessera.storage import written


def keep_first(df: DataFrame, key: Column, *order: Column, blanks: bool = True) -> DataFrame:
    """The first row of each key; rows whose key is null or empty all stay, or go if not blanks.

    The rank is limited to one per key on the map side, so copies don't travel.
    """
    keyed = df.withColumn("__key", key)
    empty = F.coalesce(F.col("__key"), F.lit("")) == ""
    ranked = keyed.where(~empty).withColumn("__rank", F.row_number().over(Window.partitionBy("__key").orderBy(*order))).where("__rank = 1").drop("__rank", "__key")
    return ranked.unionByName(keyed.where(empty).drop("__key")) if blanks else ranked


def by_doi(df: DataFrame) -> DataFrame:
    """Of records with one DOI, the one that tells most."""
    return keep_first(df, X.doi_key(F.col("doi")), X.info_score(F.col("abstract"), F.col("authors"), F.col("citations")).desc(), F.col("ord"))


def by_doi_first(df: DataFrame) -> DataFrame:
    """Of records with one DOI, as it is written, the first."""
    return keep_first(df, F.col("doi"), F.col("ord"))


def by_arxiv(df: DataFrame) -> DataFrame:
    return keep_first(df, X.arxiv_parts(F.col("arxiv_id"))[0], F.col("ord"))


def by_url(df: DataFrame) -> DataFrame:
    return keep_first(df, F.col("url"), F.col("ord"))


def by_content(df: DataFrame) -> DataFrame:
    return keep_first(df, X.content_hash(F.col("title"), F.col("authors"), F.col("year")), F.col("ord"))


def by_source_key(df: DataFrame) -> DataFrame:
    """Within a harvest: arXiv id, else title and year."""
    return keep_first(df, F.coalesce(F.nullif(F.col("arxiv_id"), F.lit("")), F.concat_ws("_", "title", "year")), F.col("ord"))


def by_light_title(df: DataFrame) -> DataFrame:
    """DOI first; records without one by their light title key, newest and most cited first. Empty titles go."""
    has_doi = F.coalesce(F.col("doi"), F.lit("")) != ""
    titled = keep_first(df.where(~has_doi), X.light_title_key(F.col("title")), F.col("year").desc(), F.col("citations").desc(), F.col("ord"), blanks=False)
    return keep_first(df.where(has_doi), F.col("doi"), F.col("ord")).unionByName(titled)


def by_similar_title(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Among titles of one slug, a title goes if an earlier kept one is at least so similar. Rows without a slug stay; equal titles fold first."""
    titled = df.withColumn("__title", X.title_key(F.col("title"))).withColumn("__slug", X.title_slug(F.col("title")))
    with_slug = keep_first(titled.where("__slug <> ''"), F.col("__title"), F.col("ord"))
    gone = greedily_dropped(with_slug.select(F.col("ord").alias("place"), F.col("__title").alias("t"), "__slug"), threshold, indel_at_least(threshold), [F.col("__slug")])
    kept = with_slug.join(gone.withColumnRenamed("place", "ord"), "ord", "left_anti")
    return kept.select(*df.columns).unionByName(titled.where("__slug = ''").select(*df.columns))


def by_similar_titles_anywhere(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Greedy over all records, newest first: a title goes if it is similar to any kept one. Equal titles keep the first; empty titles go."""
    low = F.lower(F.trim("title"))
    titled = keep_first(df, low, F.col("year").desc(), F.col("ord"), blanks=False)
    placed = numbered(titled, [F.col("year").desc(), F.col("ord")], "place")
    gone = greedily_dropped(placed.select("place", low.alias("t")), threshold, matcher_above(threshold))
    return placed.join(gone, "place", "left_anti").select(*df.columns)


def production_chain(df: DataFrame) -> DataFrame:
    """DOI, then similar titles among records without one, then arXiv id, then URL; the first of each stays.

    Records with a DOI come before the others, and those newest first; after the third step records with an arXiv id come first.
    """
    has = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0)
    with_doi = keep_first(df.where(has("doi") == 1), X.doi_key(F.col("doi")), F.col("ord"))
    titled = by_similar_titles_anywhere(df.where(has("doi") == 0))
    order = [has("doi").desc(), F.when(has("doi") == 0, F.col("year")).desc_nulls_first(), F.col("ord")]
    both = keep_first(with_doi.unionByName(titled), X.arxiv_parts(F.col("arxiv_id"))[0], *order)
    return keep_first(both, F.col("url"), has("arxiv_id").desc(), *order)


METHODS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "doi_exact": by_doi,
    "arxiv_exact": by_arxiv,
    "arxiv_id_exact": by_arxiv,
    "title_fuzzy": by_similar_title,
    "content_hash": by_content,
    "url_based": by_url,
    "title_global": by_similar_titles_anywhere,
    "production": production_chain,
}


def chain(df: DataFrame, methods: list[str]) -> DataFrame:
    """The methods one after the other; an unknown name is an error."""
    for name in methods:
        if name not in METHODS:
            raise ValueError(f"unknown deduplication method {name!r}")
        df = METHODS[name](df)
    return df


def similar_titles(df: DataFrame, title: str, threshold: float = 0.8, limit: int = 10) -> DataFrame:
    """The limit most similar titles, of these those that reach the threshold.

    A title shares at most as many characters with the wanted one as both have of each; that bounds its similarity in built-in expressions.
    The titles of the highest bounds are compared first, and then only those whose bound reaches the threshold and the last of the best.
    Keys and bounds are written first, as a condition on them would make the key anew for each character that it counts. df is written with them, so give only columns that are wanted.
    """

    @F.pandas_udf("double")
    def ratio(titles: pd.Series) -> pd.Series:
        return titles.map(lambda t: indel_ratio(wanted, t))

    wanted = df.sparkSession.range(1).select(X.title_key(F.lit(title)).alias("t")).first()["t"]
    keyed = df.withColumn("__t", X.title_key(F.col("title")))
    n = F.length("__t")
    shared = sum((F.least(F.lit(wanted.count(c)), n - F.length(F.replace("__t", F.lit(c), F.lit("")))) for c in sorted(set(wanted))), F.lit(0))
    bound = F.when(n + len(wanted) == 0, 1.0).otherwise(2 * shared / (n + len(wanted)))
    near = written(keyed.withColumn("__bound", bound), "titles-bounds").where(F.col("__bound") >= threshold - 1e-9)
    best = near.orderBy(F.desc("__bound"), "ord").limit(limit).withColumn("similarity", ratio("__t")).select("similarity").collect()
    least = min((r["similarity"] for r in best), default=0.0) if len(best) == limit else 0.0
    scored = near.where(F.col("__bound") >= least - 1e-9).withColumn("similarity", ratio("__t"))
    return scored.where(F.col("similarity") >= threshold).orderBy(F.desc("similarity"), "ord").limit(limit).drop("__t", "__bound")
