"""The tables as records of a review: documents as papers, events as a log, labels as decisions.

documents has no years, DOIs and so on; they are synthetic here, functions of doc_id that SQL can repeat.
DOIs, arXiv ids and URLs repeat on purpose, so that deduplication has work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    mod = lambda n: (i % n).cast("string")
    return table(spark, sf_dir, "documents").select(
        i.alias("ord"),
        F.split("text", "\n", 2)[0].alias("title"),
        F.col("text").alias("abstract"),
        text("Dr. Ann Lee", mod(50), "; Prof Bob  Ray", mod(20)).alias("authors"),
        (2018 + i % 8).cast("int").alias("year"),
        F.col("source").alias("source_db"),
        text("https://Example.org/p/", mod(600), "/?ref=", i.cast("string"), "#top").alias("url"),
        F.when(i % 3 == 0, F.lit("")).otherwise(text("https://doi.org/10.1234/AB.", mod(700))).alias("doi"),
        F.when(i % 5 == 0, text("2301.", F.lpad(mod(400), 5, "0"), "v", (1 + i % 3).cast("string"))).otherwise(F.lit("")).alias("arxiv_id"),
        ((i * 7919) % 97).alias("citations"),
        F.col("lang"),
        F.col("n_chars"),
    )


PAPERS = """papers AS (
  SELECT doc_id AS ord, split_part(text, chr(10), 1) AS title, text AS abstract,
         'Dr. Ann Lee' || (doc_id % 50) || '; Prof Bob  Ray' || (doc_id % 20) AS authors, (2018 + doc_id % 8)::INT AS year, source AS source_db,
         'https://Example.org/p/' || (doc_id % 600) || '/?ref=' || doc_id || '#top' AS url,
         CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'https://doi.org/10.1234/AB.' || (doc_id % 700) END AS doi,
         CASE WHEN doc_id % 5 = 0 THEN '2301.' || lpad((doc_id % 400)::VARCHAR, 5, '0') || 'v' || (1 + doc_id % 3) ELSE '' END AS arxiv_id,
         (doc_id * 7919) % 97 AS citations, lang, n_chars
  FROM documents)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), F.concat(F.lit("module"), (F.col("user_id") % 10).cast("string")).alias("module"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"), F.concat(F.col("event_type"), F.lit(" done")).alias("message"), F.col("value").alias("duration"), F.col("props").alias("metadata"),
    )


LOG = """log AS (
  SELECT event_id AS id, ts AS timestamp, 'module' || (user_id % 10) AS module, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
         event_type || ' done' AS message, value AS duration, props AS metadata FROM events)"""


def screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with decisions of their labels; those without a label are unscreened."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"), F.when(F.col("quality") == 1, "yes").otherwise("no").alias("include_ta"), F.when(F.col("toxic") == 1, "E8").when(F.col("quality") == 0, "E3").alias("reason_ta"))
    return papers(spark, sf_dir).join(labels, "ord", "left")


SCREENED = """screened AS (
  SELECT p.*, CASE WHEN l.doc_id IS NULL THEN NULL WHEN quality = 1 THEN 'yes' ELSE 'no' END AS include_ta,
         CASE WHEN toxic = 1 THEN 'E8' WHEN quality = 0 THEN 'E3' END AS reason_ta
  FROM papers p LEFT JOIN labels l ON p.ord = l.doc_id)"""
