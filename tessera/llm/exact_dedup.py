"""Exact deduplication with an extendible-hash index on shared files.

Texts are equal when their bytes agree after A-Z became a-z; null counts as empty.

1. Every text gets a 64-bit key. Copies fold before they move, by (key, bytes of the text), so that a text
   which makes up a third of all rows costs one row per map task; one entry per different text remains.
2. The directory starts with one cell and one bucket. A bucket with more than ``bucket_entries`` entries is
   overfull and splits by the next bit of the key; where its depth is the directory's, the directory doubles
   first, up to ``max_depth``. At most 2**max_depth cells (65,536), however large the input is.
3. Owner tasks hold ranges of buckets and keys. Entries with one key but different bytes (collisions) are
   chained there, by the order of their SHA-256; a chain's entries have positions 0, 1, ... The index is
   written to the shared folder, so lost executors cost a re-read, not a rebuild.
4. Rows probe the index: the directory's cell of the key names the bucket, bucket and key the chain, and the
   256 bits of the text's SHA-256 are compared with each entry of the chain. What an entry says is the answer. Entries of
   hot texts (more than one row in HOT of all; fewer than HOT entries, whatever the input) are probed where
   the rows are, so that no task receives all rows of a text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, partitions, read, sweep, written

MAX_DEPTH = 16
BUCKET_ENTRIES = 100_000
#: An entry is hot if it stands for more than one in so many rows.
HOT = 1000


def _keyed(docs: DataFrame, text_col: str, hash_bits: int) -> DataFrame:
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    key = F.xxhash64("__xd_norm")
    if hash_bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - hash_bits), 64 - hash_bits)
    return docs.withColumn("__xd_norm", norm).withColumn("__xd_key", key)


def split_buckets(held: dict[int, int], bucket_entries: int, max_depth: int) -> list[tuple[int, int, int]]:
    """The directory as (first cell, cells, local depth) of each bucket, by splitting overfull buckets.

    held: entries under each cell of a directory of max_depth. Cells are numbered at that depth, so that a bucket
    of local depth d spans 2 ** (max_depth - d) of them. A bucket that is overfull at max_depth stays so.
    """
    cells = sorted(held)
    sums = [0]
    for cell in cells:
        sums.append(sums[-1] + held[cell])
    out, todo, depth = [], [(0, 0)], 0  # depth: of the directory, which doubles when a bucket outgrows it
    while todo:
        first, local = todo.pop()
        span = 1 << (max_depth - local)
        entries = sums[bisect_left(cells, first + span)] - sums[bisect_left(cells, first)]
        if entries <= bucket_entries or local == max_depth:
            out.append((first, span, local))
            continue
        depth = max(depth, local + 1)
        todo += [(first, local + 1), (first + span // 2, local + 1)]
    return sorted(out)


def directory(entries: DataFrame, bucket_entries: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """cell -> depth and first cell of its bucket, for each cell that holds entries (at most 2 ** max_depth rows)."""
    cells = entries.groupBy(_cell(max_depth).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    held = {r["cell"]: r["n"] for r in cells.collect()}
    buckets = split_buckets(held, bucket_entries, max_depth)
    firsts = [b[0] for b in buckets]
    rows = [(cell, buckets[i][2], buckets[i][0]) for cell in held for i in (bisect_right(firsts, cell) - 1,)]
    return entries.sparkSession.createDataFrame(rows, "cell long, depth int, first long")


def _cell(max_depth: int) -> Column:
    return F.shiftrightunsigned("__xd_key", 64 - max_depth)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64, bucket_entries: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """The index: bucket, depth, key, chain_pos, chain_len, digest, keep_id, group_size, one row per different text; and its directory."""
    keyed = _keyed(docs.select(F.col(id_col).alias("__xd_id"), F.col(text_col).alias("__xd_text")), "__xd_text", hash_bits)
    entries = keyed.groupBy("__xd_key", "__xd_norm").agg(F.max("__xd_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = written(entries.select("__xd_key", F.unhex(F.sha2("__xd_norm", 256)).alias("digest"), "keep_id", "group_size"), "dedup-entries")
    cells = written(directory(entries, bucket_entries, max_depth), "dedup-directory")
    owned = entries.withColumn("cell", _cell(max_depth)).join(F.broadcast(cells), "cell").drop("cell")
    n = partitions(docs.sparkSession)
    chain = Window.partitionBy("first", "__xd_key")
    owned = owned.repartitionByRange(n, "first", "__xd_key").withColumn("chain_pos", F.row_number().over(chain.orderBy("digest")) - 1).withColumn("chain_len", F.count(F.lit(1)).over(chain))
    index = written(owned.select(F.col("first").alias("bucket"), "depth", F.col("__xd_key").alias("key"), "chain_pos", "chain_len", "digest", "keep_id", "group_size"), "dedup-index")
    sweep(docs.sparkSession, entries)
    return index, cells


def _placed(docs: DataFrame, cells: DataFrame, text_col: str, hash_bits: int, max_depth: int) -> DataFrame:
    """docs with __xd_key, __xd_own (digest) and __xd_bucket; without the text that was compared."""
    rows = _keyed(docs, text_col, hash_bits).withColumn("__xd_own", F.unhex(F.sha2("__xd_norm", 256))).drop("__xd_norm")
    named = F.broadcast(cells.select(F.col("cell").alias("__xd_cell"), F.col("first").alias("__xd_bucket")))
    return rows.withColumn("__xd_cell", _cell(max_depth)).join(named, "__xd_cell").drop("__xd_cell")


def probe(docs: DataFrame, index: DataFrame, cells: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64, max_depth: int = MAX_DEPTH) -> DataFrame:
    """docs with __xd_digest, __xd_keep_id, __xd_group_size and __xd_kept, as the index answers; rows that it doesn't know are left out."""
    total = index.agg(F.sum("group_size")).first()[0] or 0
    entry = lambda prefix, rows: rows.select(*[F.col(c).alias(f"__xd_{prefix}_{c}") for c in ("bucket", "key", "digest", "keep_id", "group_size")])
    met = lambda prefix: (F.col(f"__xd_{prefix}_bucket") == F.col("__xd_bucket")) & (F.col(f"__xd_{prefix}_key") == F.col("__xd_key")) & (F.col(f"__xd_{prefix}_digest") == F.col("__xd_own"))
    hot = written(entry("hot", index.where(F.col("group_size") * HOT > total)), "dedup-hot")  # fewer than HOT rows
    rows = _placed(docs, cells, text_col, hash_bits, max_depth).join(F.broadcast(hot), met("hot"), "left")
    # Rows that are answered go on under keys of their own, which no entry has.
    done = F.col("__xd_hot_digest").isNotNull()
    rows = rows.withColumn("__xd_bucket", F.when(done, F.lit(-1).cast("long")).otherwise(F.col("__xd_bucket"))).withColumn("__xd_key", F.when(done, F.xxhash64(id_col)).otherwise(F.col("__xd_key")))
    found = rows.join(entry("cold", index), met("cold"), "left").where(done | F.col("__xd_cold_digest").isNotNull())
    found = found.withColumns({f"__xd_{c}": F.when(done, F.col(f"__xd_hot_{c}")).otherwise(F.col(f"__xd_cold_{c}")) for c in ("keep_id", "group_size")} | {"__xd_digest": F.col("__xd_own")})
    found = found.withColumn("__xd_kept", F.col(id_col).eqNullSafe(F.col("__xd_keep_id")))
    return found.select(*docs.columns, "__xd_digest", "__xd_keep_id", "__xd_group_size", "__xd_kept")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index_options) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal. Of equal texts the row with the largest id stays; a null id ranks
    below all others and stays only in a group of nulls. Repetitions of one row (same id, equal text)
    are one document: all of them get the same answer, and group_size counts each. An empty table gives
    an empty result. Other columns, of whatever name, are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__xd_text"))
    index, cells = build_index(rows, "doc_id", "__xd_text", **index_options)
    out = probe(rows, index, cells, "doc_id", "__xd_text", **_probing(index_options))
    return out.select("doc_id", F.col("__xd_keep_id").alias("keep_id"), F.col("__xd_group_size").alias("group_size"), F.col("__xd_kept").alias("kept"), F.lower(F.hex("__xd_digest")).alias("text_sha256"))


def _probing(index_options: dict) -> dict:
    return {k: v for k, v in index_options.items() if k != "bucket_entries"}


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index_options) -> DataFrame:
    """The rows of docs that stay, with docs' columns: those whose id is the one that their text's entry keeps.

    The id is part of what is looked up, so rows of one text don't meet in one task. Nulls, ties, repeated rows and
    empty tables as in exact_dedup.
    """
    index, cells = build_index(docs, id_col, text_col, **index_options)
    rows = _placed(docs, cells, text_col, **({"hash_bits": 64, "max_depth": MAX_DEPTH} | _probing(index_options)))
    entries = index.select(*[F.col(c).alias(f"__xd_e_{c}") for c in ("bucket", "key", "digest", "keep_id")])
    same = (F.col("__xd_bucket") == F.col("__xd_e_bucket")) & (F.col("__xd_key") == F.col("__xd_e_key")) & (F.col("__xd_own") == F.col("__xd_e_digest"))
    return rows.join(entries, same & F.col(id_col).eqNullSafe(F.col("__xd_e_keep_id")), "left_semi").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
