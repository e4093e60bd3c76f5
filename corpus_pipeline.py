"""The corpus pipeline: language ID, exact deduplication, near-duplicate removal, source mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. The first four return
the columns of docs, whatever they are beyond doc_id, text, lang and source; the last returns what a trainer's manifest
needs of each row. No rows give no rows. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, exact_dedup, langid, mixing, ngram_join
from tessera.llm.common import read, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that no learned language explains: no letter, or a cross-entropy beyond all calibration.

    Null and empty texts go. Repeated rows are judged alike; where no row has a language, nothing can be learned and all go.
    """
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest doc_id. Null counts as empty, a null id ranks last; repetitions of the row that stays stay."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of five-word shingles, the one with the least doc_id.

    Texts without words and rows without an id stay; of rows that repeat an id each goes or stays by its own text.
    """
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0, 1 or 2 times. Texts without words are taken 0 times; a null source is a source."""
    return mixing.sample_mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of the mix; a null text has no tokens."""
    return bpe.digests(docs, *bpe.installed())


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Character models and tokens have no SQL form; tests/llm/test_brute_force.py holds the run against plain stages.
ORACLE_SQL = None
