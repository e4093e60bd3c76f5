"""Mixing sources to target weights: a min-cost flow over membership patterns.

Documents may belong to several sources at once. They are aggregated by membership pattern; the flow
network then has a node per pattern and per source, so its size depends on the patterns and not on the
documents. A pattern offers its words once at cost 0, a second time at cost 1, and so on (convex costs:
nothing is repeated while something unused could serve). Sources demand their quota. The cheapest flow
says how many words each pattern gives to each source; within a pattern, documents are chosen in the
order of a seeded hash until its words are reached.

All choices reduce to a per-pattern cut in hash order, found from a histogram by hash range and a
refinement of the one range that the cut falls in; no task orders a whole source.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordering import running

from .common import delete, read, word_count, written

#: Weights of the sources in code point order, null last, repeating.
CYCLE = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
#: Up to so many patterns the flow is solved on the driver, beyond it on the executors; both find the same flow.
MAX_PATTERNS = 65_536
#: Ranges of the hash in which a pattern's words are first summed.
RANGES = 4096
KEY_BITS = 60
SEED = "mix-1"


def targets(sizes: dict[str | None, int], cycle: tuple[int, ...] = CYCLE, share: float = SHARE, most: float = MAX_COPIES) -> dict[str | None, float]:
    """Share of all words by weight; a target above most times its source's words stops there, and the
    excess is dealt again by weight among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), list(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


@dataclass
class Edge:
    to: int
    room: int
    cost: int
    back: int


class Network:
    """Successive shortest paths with potentials; capacities and costs are integers."""

    def __init__(self) -> None:
        self.edges: list[list[Edge]] = []

    def node(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def link(self, a: int, b: int, room: int, cost: int) -> Edge:
        self.edges[a].append(Edge(b, room, cost, len(self.edges[b])))
        self.edges[b].append(Edge(a, 0, -cost, len(self.edges[a]) - 1))
        return self.edges[a][-1]

    def run(self, start: int, end: int) -> None:
        height = [0] * len(self.edges)  # all costs begin at 0 or more
        while True:
            far: list[float] = [float("inf")] * len(self.edges)
            by: list[tuple[int, Edge] | None] = [None] * len(self.edges)
            far[start], queue = 0, [(0, start)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.edges[a]:
                    step = d + e.cost + height[a] - height[e.to]
                    if e.room > 0 and step < far[e.to]:
                        far[e.to], by[e.to] = step, (a, e)
                        heapq.heappush(queue, (step, e.to))
            if by[end] is None:
                return
            height = [h + (int(f) if f != float("inf") else 0) for h, f in zip(height, far, strict=True)]
            path, at = [], end
            while at != start:
                a, e = by[at]
                path.append(e)
                at = a
            amount = min(e.room for e in path)
            for e in path:
                e.room -= amount
                self.edges[e.to][e.back].room += amount


def route(patterns: dict[tuple, int], quotas: dict[str | None, float], copies: int = MAX_COPIES) -> dict[tuple, dict[str | None, int]]:
    """Words that each membership pattern gives to each of its sources, at the least total repetition: what the ways in order are held against."""
    net = Network()
    start, end = net.node(), net.node()
    source = {s: net.node() for s in quotas}
    for s, q in quotas.items():
        net.link(source[s], end, round(q), 0)
    ways: dict[tuple, dict] = {}
    for p, words in patterns.items():
        node = net.node()
        for copy in range(copies):
            net.link(start, node, words, copy)
        ways[p] = {s: (net.link(node, source[s], words * copies, 0), words * copies) for s in p}
    net.run(start, end)
    return {p: {s: room - e.room for s, (e, room) in w.items()} for p, w in ways.items()}


def route_in_order(patterns: list[tuple[str, int, list[int]]], quotas: list[int], copies: int = MAX_COPIES) -> dict[str, int]:
    """The flow of route_at_scale, augmentation by augmentation, for patterns (__p, words, numbers of sources) that the driver can hold.

    Both take the same paths, by the same amounts, from patterns in the byte order of __p, so where the flow is solved doesn't show in the mix.
    """
    state = [(p, words, of, [0] * len(of)) for p, words, of in sorted(patterns, key=lambda x: x[0].encode())]
    open_quota = list(quotas)

    def moved(amount: int, room: Callable[[tuple, int], int], changes: list[tuple[int, int]]) -> None:
        for row in state:
            take = min(amount, room(row, row[1]))
            if take > 0:
                for source, sign in changes:
                    row[3][row[2].index(source)] += sign * take
                amount -= take

    for level in range(1, copies + 1):
        while any(q > 0 for q in open_quota):
            entry: dict[int, int] = {}
            edges: dict[tuple[int, int], int] = {}
            for _, words, of, flows in state:
                spare = level * words - sum(flows)
                for a, held in zip(of, flows, strict=True):
                    entry[a] = entry.get(a, 0) + spare
                    for b in of if held else ():
                        if a != b:
                            edges[a, b] = edges.get((a, b), 0) + held
            path = _shortest(sorted(a for a, n in entry.items() if n > 0), edges, {s for s, q in enumerate(open_quota) if q > 0})
            if not path:
                break
            amount = min(entry[path[0]], open_quota[path[-1]], *(edges[e] for e in pairwise(path)))
            moved(amount, lambda row, words: level * words - sum(row[3]) if path[0] in row[2] else 0, [(path[0], 1)])  # noqa: B023
            for a, b in pairwise(path):
                moved(amount, lambda row, _, a=a, b=b: row[3][row[2].index(a)] if a in row[2] and b in row[2] else 0, [(b, 1), (a, -1)])
            open_quota[path[-1]] -= amount
    return {p: sum(flows) for p, _, _, flows in state}


def route_at_scale(patterns: DataFrame, quotas: list[int], copies: int = MAX_COPIES) -> DataFrame:
    """patterns with __flow, the words that each gives, at the least total repetition; patterns stay on the executors.

    patterns: __p, __words, __of (array of numbers of sources). As moving words of a pattern from one of its sources to
    another costs nothing, successive shortest paths take the first copies before the second: for each level the
    flow grows along shortest paths over a network of the sources only, whose edges hold what patterns could move.
    The driver has a row for each pair of sources that share a pattern.
    """
    zeros = F.transform("__of", lambda _: F.lit(0).cast("long"))
    state = written(patterns.select("__p", "__words", "__of", zeros.alias("__f")), "mix-flow")
    open_quota = list(quotas)

    def moved(state: DataFrame, at: Column, room: Column, amount: int, change: Callable[[Column, Column, Column], Column]) -> DataFrame:
        """state after amount words, taken from its rows in order as they have room, changed each row's flows by change(flow, source, words)."""
        placed = running(state.withColumn("__room", F.when(at, room).otherwise(0)), [F.col("__p")], "__room", "__before")
        take = F.greatest(F.lit(0), F.least(F.col("__room"), F.lit(amount) - F.col("__before")))
        flows = F.transform("__f", lambda f, i: change(f, F.get("__of", i), F.col("__take")))
        out = written(placed.withColumn("__take", take).withColumn("__f", flows).select("__p", "__words", "__of", "__f"), "mix-flow")
        delete(state)
        return out

    has = lambda source: F.array_contains("__of", source)
    flow_to = lambda source: F.get("__f", (F.array_position("__of", F.lit(source)) - 1).cast("int"))
    for level in range(1, copies + 1):
        spare = F.lit(level) * F.col("__words") - F.aggregate("__f", F.lit(0).cast("long"), lambda a, x: a + x)
        while any(q > 0 for q in open_quota):
            pairs = state.withColumn("__spare", spare).select("__of", "__f", "__spare", F.posexplode("__of").alias("__i", "a")).select("a", "__spare", F.get("__f", F.col("__i")).alias("__held"), F.explode("__of").alias("b"))
            rooms = pairs.groupBy("a", "b").agg(F.sum("__spare").alias("spare"), F.sum("__held").alias("held")).collect()
            entry = {r["a"]: r["spare"] for r in rooms if r["a"] == r["b"] and r["spare"] > 0}
            edges = {(r["a"], r["b"]): r["held"] for r in rooms if r["a"] != r["b"] and r["held"] > 0}
            path = _shortest(sorted(entry), edges, {s for s, q in enumerate(open_quota) if q > 0})
            if not path:
                break
            amount = min(entry[path[0]], open_quota[path[-1]], *(edges[e] for e in pairwise(path)))
            first = path[0]
            state = moved(state, has(first), spare, amount, lambda f, source, n, s=first: f + F.when(source == s, n).otherwise(0))
            for a, b in pairwise(path):
                state = moved(state, has(a) & has(b), flow_to(a), amount, lambda f, source, n, a=a, b=b: f + F.when(source == b, n).when(source == a, -n).otherwise(0))
            open_quota[path[-1]] -= amount
    return state.select("__p", "__words", F.aggregate("__f", F.lit(0).cast("long"), lambda a, x: a + x).alias("__flow"))


def _shortest(starts: list[int], edges: dict[tuple[int, int], int], ends: set[int]) -> list[int]:
    """A path of fewest edges from a start to an end; empty if there is none."""
    after: dict[int, list[int]] = {}
    for a, b in sorted(edges):
        after.setdefault(a, []).append(b)
    by: dict[int, int | None] = dict.fromkeys(starts)
    queue = deque(starts)
    while queue:
        at = queue.popleft()
        if at in ends:
            path = [at]
            while by[path[-1]] is not None:
                path.append(by[path[-1]])
            return path[::-1]
        for b in after.get(at, ()):
            if b not in by:
                by[b] = at
                queue.append(b)
    return []


def seeded_key(doc_id: Column, seed: str = SEED) -> Column:
    """60 bits of md5 of the seed and the id; null ids share one key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")



def _cuts(sized: DataFrame, quota: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Per pattern: base copies, the cut (key, id, size up to which documents get one more) and the closing document.

    sized: __p, __key, __id, __size. quota: __p, __words, __flow, a row per pattern; small marks such tables for joins.
    """
    base = F.when((F.col("__flow") >= F.col("__words")) & (F.col("__words") > 0), F.floor(F.col("__flow") / F.col("__words"))).otherwise(F.lit(0)).cast("long")
    need = quota.withColumn("__base", base).withColumn("__rest", F.col("__flow") - F.col("__base") * F.col("__words"))
    width = F.lit(1 << (KEY_BITS - RANGES.bit_length() + 1))
    ranged = sized.withColumn("__range", F.floor(F.col("__key") / width).cast("int"))
    bars = ranged.groupBy("__p", "__range").agg(F.sum("__size").alias("__bar"))  # at most patterns x RANGES rows
    upto = Window.partitionBy("__p").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bars = bars.withColumn("__before", F.coalesce(F.sum("__bar").over(upto), F.lit(0)))
    hit = bars.join(small(need), "__p").where((F.col("__before") <= F.col("__rest")) & (F.col("__before") + F.col("__bar") > F.col("__rest")))
    hit = hit.select("__p", "__range", "__before", "__rest", "__base")
    inside = ranged.join(small(hit), ["__p", "__range"])
    run = F.col("__before") + F.sum("__size").over(Window.partitionBy("__p", "__range").orderBy("__key", "__id", "__size").rowsBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("__run", run).where(F.col("__run") <= F.col("__rest")).groupBy("__p").agg(F.max(F.struct("__run", "__key", "__id", "__size")).alias("l"))
    first = F.col("__range") * width
    cut = need.join(hit.select("__p", "__range", "__before"), "__p", "left").join(last, "__p", "left").select(
        "__p", "__base", "__rest",
        F.when(F.col("__range").isNull(), F.when(F.col("__rest") > 0, F.lit(1 << KEY_BITS)).otherwise(F.lit(-1))).otherwise(F.coalesce(F.col("l.__key"), first - 1)).alias("__cut_key"),
        F.when(F.col("__range").isNotNull(), F.col("l.__id")).alias("__cut_id"),
        F.when(F.col("__range").isNotNull(), F.col("l.__size")).alias("__cut_size"),
        (F.col("__rest") - F.when(F.col("__range").isNull(), F.when(F.col("__rest") > 0, F.col("__words")).otherwise(F.lit(0))).otherwise(F.coalesce(F.col("l.__run"), F.col("__before")))).alias("__gap"),
    )
    cut = written(cut, "mix-cuts")
    outside = sized.join(small(cut), "__p").where(~_inside() & (F.col("__size") > 0) & (F.abs(F.col("__size") - F.col("__gap")) < F.col("__gap")))
    closing = outside.groupBy("__p").agg(F.min(F.struct(F.abs(F.col("__size") - F.col("__gap")).alias("miss"), "__key", "__id", "__size")).alias("c"))
    return written(cut.join(closing, "__p", "left").select(*cut.columns, F.col("c.__key").alias("__end_key"), F.col("c.__id").alias("__end_id"), F.col("c.__size").alias("__end_size")), "mix-cuts")


def _inside() -> Column:
    """Whether a document is within its pattern's cut; ids order with null first, as in the window."""
    here = F.struct(F.col("__key").alias("k"), F.col("__id").alias("i"), F.col("__size").alias("s"))
    cut = F.struct(F.col("__cut_key").alias("k"), F.col("__cut_id").alias("i"), F.col("__cut_size").alias("s"))
    return F.when(F.col("__cut_size").isNull(), F.col("__key") <= F.col("__cut_key")).otherwise(here <= cut)


def _copies() -> Column:
    end = (F.col("__key") == F.col("__end_key")) & F.col("__id").eqNullSafe(F.col("__end_id")) & (F.col("__size") == F.col("__end_size"))
    return F.when(F.col("__size") == 0, F.lit(0)).otherwise(F.col("__base") + F.when(_inside(), 1).otherwise(0) + F.when(F.coalesce(end, F.lit(False)), 1).otherwise(0)).cast("long")


def plan(docs: DataFrame, members: Column, id_col: str = "doc_id", text_col: str = "text", cycle: tuple[int, ...] = CYCLE, share: float = SHARE, most: int = MAX_COPIES, seed: str = SEED, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """docs, every row and column, with __size, __copies, __source_size and __target (of the first source of the row).

    members: array of the sources that a row belongs to; a null or empty array or a null element is the source null.
    Copies are whole: 0 to most. A row without words is taken 0 times. Rows that repeat an id are ordered
    by size; where all of it agrees they are cut together. No documents: no rows.
    """
    spark = docs.sparkSession
    distinct = F.array_sort(F.array_distinct(members))
    sets = F.when(F.size(distinct) > 0, distinct).otherwise(F.array(F.lit(None).cast("string")))
    tagged = docs.withColumn("__size", word_count(F.col(text_col))).withColumn("__members", sets).withColumn("__id", F.col(id_col)).withColumn("__key", seeded_key(F.col(id_col), seed))
    tagged = tagged.withColumn("__p", F.to_json("__members", {"ignoreNullFields": "false"}))
    sized = written(tagged.select("__p", "__members", "__key", "__id", "__size"), "mix-sizes")
    patterns = written(sized.groupBy("__p").agg(F.first("__members").alias("m"), F.sum("__size").alias("__words")), "mix-patterns")
    few = patterns.count() <= max_patterns
    per_source = patterns.select(F.explode("m").alias("s"), "__words").groupBy("s").agg(F.sum("__words").alias("n")).collect()  # a row per source
    size: dict[str | None, int] = {r["s"]: int(r["n"]) for r in sorted(per_source, key=lambda r: (r["s"] is None, r["s"] or ""))}
    whole = int(patterns.agg(F.sum("__words")).first()[0] or 0)
    goal = targets(size, cycle, share * (whole / max(1, sum(size.values()))), most)
    known = [(s, i, size[s], goal[s]) for i, s in enumerate(size)]
    named = F.broadcast(spark.createDataFrame(known, T.StructType([T.StructField("__s", T.StringType()), T.StructField("__i", T.IntegerType()), T.StructField("__source_size", T.LongType()), T.StructField("__target", T.DoubleType())])))
    if few:
        number = {s: i for i, s in enumerate(size)}
        found = [(r["__p"], int(r["__words"]), sorted(number[s] for s in r["m"])) for r in patterns.collect()]
        flow = route_in_order(found, [round(goal[s]) for s in size], most)
        routed = spark.createDataFrame([(p, n, flow[p]) for p, n, _ in found], "__p string, __words long, __flow long")
    else:
        members = patterns.select("__p", "__words", F.explode("m").alias("__m"))
        numbered = members.join(named, F.col("__m").eqNullSafe(F.col("__s"))).groupBy("__p", "__words").agg(F.array_sort(F.collect_list("__i")).alias("__of"))
        routed = route_at_scale(numbered, [round(goal[s]) for s in size], most)
    quota = patterns.select("__p", F.col("m")[0].alias("__m")).join(named, F.col("__m").eqNullSafe(F.col("__s"))).join(routed, "__p").select("__p", "__words", "__flow", "__source_size", "__target")
    quota = written(quota, "mix-quota")
    small = F.broadcast if few else lambda df: df
    cuts = _cuts(sized.select("__p", "__key", "__id", "__size"), quota.select("__p", "__words", "__flow"), small)
    cuts = cuts.join(quota.select("__p", "__source_size", "__target"), "__p")
    return tagged.join(small(cuts), "__p").withColumn("__copies", _copies())


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken (its size times its copies)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), F.col(source_col).alias("__source"))
    out = plan(rows, F.array("__source"), "doc_id", "__text", **options)
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


def sample_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: docs' rows as often as they are taken, with docs' columns."""
    out = plan(docs, F.array(F.col(source_col)), id_col, text_col, **options)
    out = out.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))


SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {KEY_BITS // 4}))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words, [{', '.join(map(str, CYCLE))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(CYCLE)} + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, sum({MAX_COPIES} * words) OVER u AS capped, sum(w) OVER u AS weight, {SHARE} * sum(words) OVER () AS whole, sum(w) OVER () AS weights FROM s
      WINDOW u AS (ORDER BY {MAX_COPIES} * words / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, (whole - (capped - {MAX_COPIES} * words)) / (weights - (weight - w)) * w AS fair FROM o),
q AS (SELECT *, bool_and(fair > {MAX_COPIES} * words) OVER (ORDER BY {MAX_COPIES} * words / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS full_up FROM p),
l AS (SELECT (max(whole) - coalesce(sum({MAX_COPIES} * words) FILTER (full_up), 0)) / sum(w) FILTER (NOT full_up) AS level FROM q),
t AS (SELECT source, words, CASE WHEN full_up THEN {MAX_COPIES}.0 * words ELSE level * w END AS target FROM q, l),
f AS (SELECT *, round(target)::BIGINT // greatest(words, 1) AS base, round(target)::BIGINT % greatest(words, 1) AS rest FROM t),
c AS (SELECT d.*, f.words, f.target, f.base, f.rest, sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS run
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
g AS (SELECT *, rest - coalesce(max(run) FILTER (run <= rest) OVER (PARTITION BY source), 0) AS gap FROM c),
e AS (SELECT source, arg_min(doc_id, (abs(size - gap), k, doc_id)) AS last_id FROM g WHERE run > rest AND size > 0 AND abs(size - gap) < gap GROUP BY source)
SELECT g.doc_id, size, words AS source_size, target,
       (size * (base + (run <= rest)::INT + coalesce(run > rest AND g.doc_id = e.last_id, false)::INT))::BIGINT AS taken
FROM g LEFT JOIN e ON g.source IS NOT DISTINCT FROM e.source
"""
