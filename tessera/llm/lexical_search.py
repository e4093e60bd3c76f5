"""Ranked lexical search by Fagin's threshold algorithm over blocks of the collection.

A first pass keeps, of every document, its length and its counts of the queries' terms: the forward index, a written
table. Document frequencies, N and L are sums over it. Each task of the second pass cuts its part of the forward index into
blocks of bounded size and sorts each block's postings by impact. An item reads its terms' lists in step, from the greatest
impact down, looks every new document up in the block's forward index for its whole score, and leaves the block once the score that an
unseen document could still reach, the threshold, is strictly below its k-th best. The k best go on to the task's next block,
where the bar is then high from the start. The best of all tasks are ranked by a window, so nothing but k rows an item and task moves.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, arrow_map, read, written
from .licenses import words_of as terms_of

#: Of the length norm, in hundredths; term frequency saturation is in the integer formula of impact().
SLOPE = 75
#: Postings and documents of a block in a task's memory: about 100 MB with its sorted copies.
BLOCK_POSTINGS, BLOCK_DOCS = 1_000_000, 100_000
#: Bytes of item texts that one pass serves; more items take more passes, each with its own index.
PASS_BYTES = 4_000_000
#: Entries of each list that the first round reads; every round doubles what was read.
FIRST_DEPTH = 8


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


def norms(lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    return 100 - SLOPE + (SLOPE * lengths * n_docs) // max(total, 1)


class Item:
    """A query as its distinct terms' numbers with their weights, repeats included."""

    def __init__(self, number: int, counts: dict[int, int], weights: np.ndarray) -> None:
        self.number = number
        self.terms = np.array(sorted(t for t in counts if weights[t] > 0), np.int64)
        self.weights = np.array([counts[int(t)] * int(weights[t]) for t in self.terms], np.int64)


class Block:
    """Documents with their forward index, and its postings by term and falling impact."""

    def __init__(self, ids: list, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, total: int) -> None:
        self.ids = ids
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.terms = terms
        owners = np.repeat(np.arange(len(ids)), sizes)
        self.impacts = impact(tfs, norms(lengths, n_docs, total)[owners])
        order = np.lexsort((-self.impacts, terms))
        self.by_impact, self.owners = self.impacts[order], owners[order]
        self.list_terms, self.list_starts = np.unique(terms[order], return_index=True)
        self.list_ends = np.append(self.list_starts[1:], len(terms))

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Whole scores of the documents, from the forward index. weights: by term number, 0 where the item lacks it."""
        lo, sizes = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        before = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(lo - before, sizes)
        return np.add.reduceat(weights[self.terms[at]] * self.impacts[at], before)

    def search(self, item: Item, weights: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """best, (score, id) with the ranking order of better(), brought up to date with this block's documents."""
        at = np.searchsorted(self.list_terms, item.terms)
        at[at == len(self.list_terms)] = 0
        held = self.list_terms[at] == item.terms
        starts, ends, own = self.list_starts[at[held]], self.list_ends[at[held]], item.weights[held]
        if not len(starts):
            return best
        weights[item.terms] = item.weights
        seen = np.zeros(len(self.ids), bool)
        depth, more = 0, FIRST_DEPTH
        while True:
            upto = np.minimum(starts + depth + more, ends)
            new = np.unique(np.concatenate([self.owners[a:b] for a, b in zip(np.minimum(starts + depth, ends), upto, strict=True)]))
            new = new[~seen[new]]
            seen[new] = True
            depth += more
            more = depth
            if len(new):
                found = self.scores(new, weights)
                if len(best) == k:
                    keep = found >= best[-1][0]
                    new, found = new[keep], found[keep]
                elif len(new) > k:  # ties of the k-th score stay
                    keep = found >= np.partition(found, len(found) - k)[len(found) - k]
                    new, found = new[keep], found[keep]
                best = heapq.nsmallest(k, best + [(int(s), self.ids[d]) for s, d in zip(found, new, strict=True)], key=better)
            live = upto < ends
            # A document not seen yet stands, in each list, behind what was read; where a list has ended, it isn't in it.
            threshold = int((own[live] * self.by_impact[upto[live] - 1]).sum())
            if not live.any() or len(best) == k and threshold < best[-1][0]:
                weights[item.terms] = 0
                return best


def better(found: tuple) -> tuple:
    """Sort key: highest score first, then ascending id, no id last."""
    score, name = found
    return -score, name is None, name or 0


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms, with repeats), terms and tfs: numbers and counts of the vocabulary's terms in the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(1):
                own = terms_of(text.as_py())
                met = Counter(filter(vocabulary.__contains__, own))
                n.append(len(own))
                terms.append([vocabulary[t] for t in met])
                tfs.append(list(met.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return arrow_map(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, tfs array<long>")


def _blocks(batches: Iterable[pa.RecordBatch], n_docs: int, total: int) -> Iterator[Block]:
    held: list[tuple] = []

    def built() -> Block:
        ids, lengths, sizes, terms, tfs = zip(*held, strict=True)
        return Block([x for own in ids for x in own], *map(np.concatenate, (lengths, sizes, terms, tfs)), n_docs, total)

    for batch in batches:
        full = batch.filter(pa.array(np.diff(batch.column(2).offsets.to_numpy()) > 0))
        if full.num_rows:
            terms, tfs = full.column(2), full.column(3)
            held.append((full.column(0).to_pylist(), full.column(1).to_numpy(), np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()))
        if sum(len(h[3]) for h in held) >= BLOCK_POSTINGS or sum(len(h[0]) for h in held) >= BLOCK_DOCS:
            yield built()
            held = []
    if held:
        yield built()


def _pass(docs: DataFrame, asked: list[tuple[object, str | None]], k: int) -> DataFrame:
    """The k best documents of each asked (item_id, text)."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    counts = [Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text)) for _, text in asked]
    forward = written(forward_index(docs, vocabulary), "search-forward")
    n_docs, total = forward.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(vocabulary) + 1, np.int64)
    for row in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term of the items
        frequency[row["t"]] = row["count"]
    weights = np.array([weight(n_docs, int(f)) for f in frequency], np.int64)
    items = [Item(i, c, weights) for i, c in enumerate(counts)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        scratch = np.zeros(len(weights), np.int64)
        for block in _blocks(batches, n_docs, total):
            for item in items:
                best[item.number] = block.search(item, scratch, best[item.number], k)
        out = [(i, score, name) for i, own in enumerate(best) for score, name in own if score > 0]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[2] for x in out], kind), pa.array([x[1] for x in out], pa.int64())], names=["item", "doc_id", "score"])

    kind = pa.int32() if docs.schema["doc_id"].dataType.simpleString() == "int" else pa.int64()
    found = arrow_map(forward, run, f"item int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    few = found.withColumn("lane", F.spark_partition_id() % 64)  # so that no task gets the rows of all tasks
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item", "lane").orderBy(*order))).where(F.col("rank") <= k).drop("lane", "rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    kinds = docs.schema["doc_id"].dataType
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(asked)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc_id").cast(kinds).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item with a score above 0, equal scores by ascending doc_id.

    docs has doc_id (an integer) and text, items item_id (an integer) and text; other columns aren't read. Null and empty texts have no terms:
    such documents count neither in N nor in any result, such items have no rows. Whole texts are read, of any length. Each
    row of docs is a document of its own and each row of items an item, so repeated rows repeat; a null doc_id ranks behind equal scores.
    No documents or no items give no rows. Items are served in passes of about PASS_BYTES of text, so that what tasks get of them is bounded.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    passes = 1 + (asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // PASS_BYTES)
    out = None
    for p in range(passes):
        rows = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).collect()]  # PASS_BYTES of text, by the hash
        if rows:
            found = _pass(own, rows, k)
            out = found if out is None else out.unionByName(found)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return out if out is not None else spark.createDataFrame([], f"item_id long, rank int, doc_id {kind}, score long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item; search() says what nulls, ties and repeated rows give."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: Every document of every item scored whole.
SQL = rf"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM terms GROUP BY doc_id, t),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS l FROM lengths),
weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, whole GROUP BY t, docs),
asked AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - {SLOPE} + (({SLOPE} * n * docs) // l)))))::BIGINT AS score
  FROM asked JOIN tfs USING (t) JOIN weights USING (t) JOIN lengths USING (doc_id), whole GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
