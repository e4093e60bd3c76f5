"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards; a node weighs as much as the shards below it. A document descends
from the root: at each level every child draws ``-ln(u) / weight`` from a hash of the document's id and
the child, and the least draw wins, so a child gets a share in proportion to its weight. A draw depends
on nothing but the id, the child's name and its own weight. When weights change, documents therefore
move only into or out of the subtrees whose weights changed; one more shard that opens a region of its
own takes documents from all others and moves none between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read

#: Sub-ranges of a shard within which slots are counted; each shard's slots are dealt over as many tasks.
SLOT_BUCKETS = 512


def grow(tree: dict, shard: int, weight: float = 1.0) -> dict:
    """The tree with one more shard, in a region and rack of its own."""
    return {**tree, f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}}


def balanced_tree(n_shards: int, racks_per_region: int = 4, shards_per_rack: int = 5) -> dict:
    """Shards 0 to n_shards - 1 of weight 1, dealt to racks and regions in order."""
    tree: dict = {}
    for shard in range(n_shards):
        rack = shard // shards_per_rack
        tree.setdefault(f"region{rack // racks_per_region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def weight_of(node: dict | float) -> float:
    return sum(map(weight_of, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, child: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, child["path"]), 11).cast("double") + F.lit(0.5)) / F.lit(float(2**53))
    return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["path"].alias("path"), child["shard"].alias("shard"))


def descend(key: Column, tree: dict, seed: int = 0) -> Column:
    """The shard (int) that key reaches from the tree's root; nodes without weight are never reached."""
    children: dict[str, list[tuple[str, float, int | None]]] = {}

    def walk(path: str, node: dict) -> int:
        alive = [(f"{path}/{name}", child) for name, child in node.items() if weight_of(child) > 0]
        if not alive:
            raise ValueError(f"no weight below {path}")
        children[path] = [(at, weight_of(child), None if isinstance(child, dict) else int(at.rpartition("/")[2])) for at, child in alive]
        depths = {walk(at, child) + 1 if isinstance(child, dict) else 1 for at, child in alive}
        if len(depths) > 1:
            raise ValueError(f"shards at different depths below {path}")
        return depths.pop()

    root = f"seed{seed}"
    depth = walk(root, tree)
    listed = {path: F.array(*[F.struct(F.lit(at).alias("path"), F.lit(weight).alias("weight"), F.lit(leaf).cast("int").alias("shard")) for at, weight, leaf in nodes]) for path, nodes in children.items()}
    table = F.create_map(*[x for path, nodes in listed.items() for x in (F.lit(path), nodes)])
    winner = None
    for _ in range(depth):
        nodes = listed[root] if winner is None else F.element_at(table, winner["path"])
        winner = F.array_min(F.transform(nodes, lambda child: _draw(key, child)))
    return winner["shard"]


def shard(docs: DataFrame, tree: dict, grown: dict | None = None, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The id alone decides the shard (law ``key``): rows of one id, repeated ones included, and all rows
    without an id go to one shard each. A null text counts no bytes and has the checksum of no bytes.
    Slots number a shard's rows from 0 without gaps; equal rows (same id and text) may swap theirs. An
    empty table gives no rows. Other columns are not read.
    """
    key = F.col("doc_id")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("__bytes"))
    rows = rows.select("doc_id", (F.octet_length("__bytes") + 16).cast("long").alias("size"), F.crc32("__bytes").cast("long").alias("text_crc32"))
    rows = rows.withColumn("shard", descend(key, tree, seed=seed).cast("int"))
    rows = rows.withColumn("grown_shard", descend(key, grown, seed=seed).cast("int") if grown else F.lit(None).cast("int"))
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = rows.groupBy("shard", "__part").agg(F.count(F.lit(1)).alias("__n"))  # at most shards x SLOT_BUCKETS rows
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("shard", "__part").orderBy("doc_id", "text_crc32", "size")) - 1
    slotted = rows.withColumn("__in", within).join(F.broadcast(starts), ["shard", "__part"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("__start") + F.col("__in")).cast("long").alias("slot"), "grown_shard")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = balanced_tree(40)
    return shard(read(spark, sf_dir, "documents").select("doc_id", "text"), tree, grow(tree, 40))
