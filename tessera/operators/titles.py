"""Similar titles found in tiles of neighbouring lengths, and the greedy choice among what is linked.

A ratio of 2 LCS / (a + b) above a threshold leaves at most (1 - threshold) (a + b) insertions and deletions, so the
lengths of a pair are near each other. Titles are sorted by scope and length and cut into blocks; each two blocks whose
lengths can meet are a tile, which a task compares whole (`tiling.py`): first by counts of characters, then by the longest common
subsequence, 63 characters of one title at a time, until too many are left over. Only titles move, as often as a block has tiles that
they can have a partner in; pairs never do. There are BLOCKS blocks however many titles or tasks there are, so what moves grows as the titles.

Near copies come in groups, of which no pairs are listed: before that each title is compared with the first title of a few
buckets (least hashes of its pieces). Titles similar to such a first one wait outside while the rest is compared and
decided; where their first one stays, they go. Where it goes, they wait for a title for which it goes, if they are similar to
that, too; only the others join the rest and are compared with it. As the greedy choice is the only set in which a title stays exactly if no earlier similar one does, the result is the greedy one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordering import running
from tessera.operators.tiling import close_pairs, common, counted
from tessera.storage import new_path, written

#: What a title weighs in its block: one for each so many characters, as long ones take longer, and very long ones as many times that as they hold LENGTHY characters. A block holds LEAST or more and no more than BLOCK, as a task holds two.
WEIGHED, LENGTHY, LEAST, BLOCK = 128, 4000, 256, 65536
#: Blocks, unless those would be too large: a title meets a tenth of them or so, as lengths of one language's titles are spread.
BLOCKS = 64
#: Least hashes by which a title meets the first title of a bucket.
BUCKETS = 2
#: Groups of characters that are counted in each title: an insertion or deletion changes one count by one.
COUNTED = (*"etaoinshrdlu ", "cmf", "pgwy", "bvkxjqz", "éèêàâçñóíáúäöüß")


def indel_ratio(a: str, b: str) -> float:
    """2 LCS / (len a + len b)."""
    return 2 * common(a, b) / (len(a) + len(b)) if a or b else 1.0


def reaches(a: str, b: str, threshold: float, strictly: bool) -> bool:
    """Whether indel_ratio is at least (or above) the threshold."""
    if (a or b) and 2 * min(len(a), len(b)) / (len(a) + len(b)) < threshold:
        return False
    ratio = indel_ratio(a, b)
    return ratio > threshold if strictly else ratio >= threshold


def indel_at_least(threshold: float) -> Callable[[str, str], bool]:
    return lambda new, kept: reaches(kept, new, threshold, strictly=False)


def matcher_above(threshold: float) -> Callable[[str, str], bool]:
    """By the standard library's matcher, whose ratio never exceeds indel_ratio; that one is tried first."""
    return lambda new, kept: reaches(kept, new, threshold, strictly=True) and matched_above(new, kept, threshold)


def matched_above(a: str, b: str, threshold: float) -> bool:
    """Whether SequenceMatcher(None, a, b).ratio() is above the threshold: its blocks, those of the largest stretches first, until they suffice or what is left can't."""
    if not a and not b:
        return threshold < 1.0
    matcher, length = SequenceMatcher(None, a, b), len(a) + len(b)
    matched, left = 0, min(len(a), len(b))
    stretches = [(-left, 0, len(a), 0, len(b))]
    while stretches and 2.0 * matched / length <= threshold < 2.0 * (matched + left) / length:
        least, a_start, a_stop, b_start, b_stop = heappop(stretches)
        left += least
        i, j, size = matcher.find_longest_match(a_start, a_stop, b_start, b_stop)
        if not size:
            continue
        matched += size
        for stretch in ((a_start, i, b_start, j), (i + size, a_stop, j + size, b_stop)):
            most = min(stretch[1] - stretch[0], stretch[3] - stretch[2])
            if most > 0:
                left += most
                heappush(stretches, (-most, *stretch))
    return 2.0 * matched / length > threshold


def _verified(pairs: DataFrame, rows: DataFrame, similar: Callable[[str, str], bool], most: float) -> DataFrame:
    """Those of the pairs (a before b, by place) whose titles are similar. Counts of characters rule most others out before Python sees them."""

    @F.pandas_udf(T.BooleanType())
    def alike(new: pd.Series, kept: pd.Series) -> pd.Series:
        return pd.Series([similar(x, y) for x, y in zip(new, kept, strict=True)], dtype=bool)

    side = lambda s, *columns: rows.select(F.col("place").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    edits = most * (F.col("n_a") + F.col("n_b")) + 1e-9
    apart = sum((F.abs(F.col("counts_a")[i] - F.col("counts_b")[i]) for i in range(len(COUNTED))), F.lit(0))
    possible = pairs.join(side("a", "n", "counts"), "a").join(side("b", "n", "counts"), "b").where(apart <= edits).select("a", "b")
    dealt = possible.repartition(_width(pairs), "a", "b")  # few bytes, much work
    return dealt.join(side("a", "t"), "a").join(side("b", "t"), "b").where(alike("t_b", "t_a")).select("a", "b")


def _width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spelled(titles: DataFrame, scope: Sequence[Column] = ()) -> DataFrame:
    """place, t, scope, n, counts and least of the titles, as a written table. least: least hashes of a title's pieces, one for each bucket."""
    dealt = titles.select("place", "t", F.xxhash64(*scope, F.lit(0)).alias("scope")).repartition(_width(titles), "place").select("*", F.length("t").alias("n"))
    counts, least = pa.list_(pa.int32()), pa.list_(pa.int64())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                by_group, by_bucket = counted(batch["t"].to_pylist(), COUNTED, BUCKETS)
                columns = [pa.array(by_group.tolist(), counts), pa.array(by_bucket.tolist(), least)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "counts", "least"])

    schema = T.StructType([*dealt.schema.fields, T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("least", T.ArrayType(T.LongType()))])
    return written(dealt.mapInArrow(measured, schema), "titles")


def first_links(rows: DataFrame, similar: Callable[[str, str], bool], most: float) -> DataFrame:
    """place, first: titles that are similar to the first title of one of their buckets, which is earlier. rows: as spelled() gives them."""
    met = rows.select("place", "scope", F.posexplode("least").alias("k", "h"))
    firsts = met.groupBy("scope", "k", "h").agg(F.min("place").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = met.join(firsts, ["scope", "k", "h"]).where("a < place").select("a", F.col("place").alias("b")).distinct()
    return _verified(pairs, rows, similar, most).groupBy(F.col("b").alias("place")).agg(F.min("a").alias("first"))


def candidate_pairs(rows: DataFrame, most: float, similar: Callable[[str, str], bool] | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """Pairs (a before b) of one scope that differ by at most most (len a + len b) insertions and deletions. rows: as spelled() gives them.

    Of these only what similar(b, a) accepts, if it is given, and only pairs with one of the places of fresh, if that is given.
    A few pairs more may come where rare characters count as one (see tiling.py).
    """
    marked = rows.withColumn("fresh", F.lit(True)) if fresh is None else rows.join(fresh.select("place", F.lit(True).alias("fresh")), "place", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    weight = (F.greatest(F.lit(1), F.floor(F.col("n") / WEIGHED)) * F.greatest(F.lit(1), F.floor(F.col("n") / LENGTHY))).cast("long")
    sorted_ = written(running(marked.select("place", "t", "scope", "n", "fresh", weight.alias("w")), [F.col("scope"), F.col("n"), F.col("place")], "w"), "titles-sorted")
    total = sorted_.agg(F.sum("w")).first()[0] or 0
    block = min(BLOCK, max(LEAST, total // BLOCKS + 1))
    placed = sorted_.withColumn("block", F.floor(F.col("before") / block))
    ends = placed.groupBy("block").agg(F.min(F.struct("scope", "n")).alias("low"), F.max(F.struct("scope", "n")).alias("high"), F.max("fresh").alias("fresh"))
    tiles = written(_seats(ends, most, fresh is None), "titles-tiles")
    tasks = max(_width(rows), min(tiles.select("i", "j").distinct().count(), 4 * _width(rows)))
    near = F.abs(F.col("n") - F.col("n_met")) <= most * (F.col("n") + F.col("n_met")) + 1e-9
    seated = placed.join(F.broadcast(tiles), "block").where(F.col("scope_met").isNull() | (F.col("fresh") | ~F.col("guests")) & (F.col("scope") == F.col("scope_met")) & near)
    dealt = seated.select("place", "t", "scope", "fresh", "block", "i", "j").repartition(tasks, "i", "j")  # few bytes, much work: not to be put together

    def compared(table: pa.Table) -> pa.Table:
        pairs = close_pairs(table, most, similar)
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    kind = rows.schema["place"].dataType
    out = dealt.groupBy("i", "j").applyInArrow(compared, "a long, b long")
    return out.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"))


def _seats(ends: DataFrame, most: float, every: bool) -> DataFrame:
    """i, j, block: a row for each tile in which titles of a block are compared, and what a title there must be near to: scope_met and n_met, the nearest end of the block that it meets; null where the block meets itself.

    If every title is compared, two blocks meet in a tile (i, j). Else a tile is a block (i, i) whose titles stay, and the fresh ones of all blocks near it are its guests.
    """
    x, y = ends.alias("x"), ends.alias("y")
    met = (F.col("x.high.scope") == F.col("y.low.scope")) & (F.col("y.low.n") - F.col("x.high.n") <= most * (F.col("y.low.n") + F.col("x.high.n")) + 1e-9)
    two = x.join(y, (F.col("x.block") < F.col("y.block")) & met)

    def seat(i: str, j: str, block: str, end: str) -> Column:
        return F.struct(F.col(i).alias("i"), F.col(j).alias("j"), F.col(block).alias("block"), F.col(f"{end}.scope").alias("scope_met"), F.col(f"{end}.n").alias("n_met"), F.lit(not every).alias("guests"), F.col(f"{block.split('.')[0]}.fresh").alias("fresh"))

    of = (lambda k: ("x.block", "y.block")) if every else (lambda k: (k, k))
    seats = two.select(F.explode(F.array(seat(*of("x.block"), "y.block", "x.high"), seat(*of("y.block"), "x.block", "y.low"))).alias("s")).select("s.*").where("fresh").drop("fresh")
    homes = ends.select("block") if every else ends.where("fresh").select("block").unionByName(seats.select(F.col("i").alias("block"))).distinct()
    alone = homes.select(F.col("block").alias("i"), F.col("block").alias("j"), "block", F.lit(None).cast("long").alias("scope_met"), F.lit(None).cast("int").alias("n_met"), F.lit(False).alias("guests"))
    return alone.unionByName(seats)


def greedy_losers(links: DataFrame, name: str) -> DataFrame:
    """place of what goes, if each place in turn stays unless it is linked to an earlier one that stays. links: a before b.

    In rounds: what has no undecided earlier neighbour stays, and its later neighbours go. What goes is added to one table.
    """
    spark = links.sparkSession
    path = new_path(spark, f"{name}-gone")
    kind = links.schema["a"].dataType.simpleString()
    spark.createDataFrame([], f"place {kind}").write.parquet(path)
    left = links
    while True:
        stay = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        gone = written(left.join(stay, "a", "left_semi").select(F.col("b").alias("place")).distinct(), f"{name}-round")
        if gone.isEmpty():
            return spark.read.schema(f"place {kind}").parquet(path)
        gone.write.mode("append").parquet(path)
        for side in ("a", "b"):
            left = left.join(gone.withColumnRenamed("place", side), side, "left_anti").select("a", "b")
        left = written(left, f"{name}-links")


def greedily_dropped(titles: DataFrame, threshold: float, similar: Callable[[str, str], bool], scope: Sequence[Column] = ()) -> DataFrame:
    """place of the titles that go: in order of place, a title goes if it is similar to an earlier one of its scope that stays.

    titles: place (unique), t (neither null nor empty). similar(new, kept) implies an indel_ratio of threshold or more.
    """
    most = 1.0 - threshold
    rows = spelled(_accompanied(titles, scope), scope)
    linked = written(first_links(rows, similar, most), "titles-first")
    # One that hangs on a title which hangs itself is decided with the rest.
    waiting = written(linked.join(linked.select(F.col("place").alias("first")), "first", "left_anti").select("place", "first"), "titles-waiting")
    rest = rows.join(waiting.select("place"), "place", "left_anti")
    links = written(candidate_pairs(rest, most, similar), "titles-links")
    while True:
        gone = greedy_losers(links, "titles")
        loose = written(waiting.join(gone.withColumnRenamed("place", "first"), "first", "left_semi").select("place", "first"), "titles-loose")
        if loose.isEmpty():
            return gone.unionByName(waiting.select("place"))
        hung = written(_hung_again(loose, links, gone, rows, similar, most), "titles-hung")
        fresh = written(loose.join(hung, "place", "left_anti").select("place"), "titles-fresh")
        waiting = written(waiting.join(loose, "place", "left_anti").unionByName(hung), "titles-waiting")
        if fresh.isEmpty():
            return gone.unionByName(waiting.select("place"))
        rest = rows.join(waiting.select("place"), "place", "left_anti")
        links = written(links.unionByName(candidate_pairs(rest, most, similar, fresh)), "titles-links")


def _hung_again(loose: DataFrame, links: DataFrame, gone: DataFrame, rows: DataFrame, similar: Callable[[str, str], bool], most: float) -> DataFrame:
    """place, first: of the loose titles those that are similar to a title for which their first one goes, too. It is earlier and stays, so they wait for that one.

    Only the first and the last such title is tried, so there are at most two pairs a title.
    """
    stay = links.join(gone.withColumnRenamed("place", "a"), "a", "left_anti")
    tried = stay.groupBy(F.col("b").alias("first")).agg(F.array_distinct(F.array(F.min("a"), F.max("a"))).alias("tried"))
    pairs = loose.join(tried, "first").select(F.explode("tried").alias("a"), F.col("place").alias("b"))
    return _verified(pairs, rows, similar, most).groupBy(F.col("b").alias("place")).agg(F.min("a").alias("first"))


def _accompanied(titles: DataFrame, scope: Sequence[Column]) -> DataFrame:
    """The titles whose scope holds another one; the others have nothing to be similar to. Numbers of scopes move, not titles, before that is known."""
    if not scope:
        return titles
    of = F.xxhash64(*scope)
    shared = titles.groupBy(of.alias("__of")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__of")
    return titles.withColumn("__of", of).join(shared, "__of", "left_semi").drop("__of")
