"""N-gram Jaccard self-join with PartEnum signatures, and the connected components of its links.

A document's set holds its distinct five-word shingles as 64-bit hashes. Equal sets fold into one.

Signatures. Sets whose sizes lie in one band (sizes from RATIO**b on; a set that may match the next
band's least set also takes part there) share a partition of the shingle domain into first-level parts
of two cells each. Two sets with a similarity of 0.8 or more differ in at most ``size // 4`` shingles,
and these touch at most as many cells. Of a part's subsets of cells PartEnum enumerates those of one
cell: a signature is a cell with all that the set has in it. Enough cells make some agree; so many that,
with one global order of signatures, two similar sets share one among the first ``size // 4 + 1`` of
each, the others need not be enumerated. The order puts signatures that are frequent in the corpus
last, and full cells before sparse ones; it decides what the join costs and never what it finds.

Candidates. Sets with a common signature form a bucket, however large; no task holds a bucket and no
step lists its pairs. The set that shares most signatures is the bucket's centre, and all others are
compared with it alone. Links then give components, and only pairs across components remain. They are
met in two ways, both exact:

* near the centre: ``a`` and ``b`` differ by what their differences from the centre don't share. A set
  that isn't linked to the centre can link only to sets that share half of their difference with it, so
  the differences are joined by prefix, added shingles before removed ones;
* far from it: by the triangle inequality of the distance, and by size, most pairs of a bucket can't be
  links; those that may be are compared.

Links between sets that are already in one component are not looked for, as they change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, UPPER, arrow_map, delete, read, sweep, written

WORDS = 5
#: Sizes of a band lie within this factor.
RATIO = 4
#: Shingles per cell of a band's largest set.
LOAD = 3
#: Signatures that occur at least so often within one task are counted as frequent, and so many of the
#: most frequent are held by each task (12 bytes each). Beyond it the order is less telling; results are the same.
FREQUENT, HELD = 2, 1 << 20
#: Filters that let pass what may be needed are bit maps of so many 64-bit words (8 MB); if they fill up, more passes, and joins decide.
_WORD_BITS = 20
FILTER_WORDS = 1 << _WORD_BITS
#: A member is far from its centre if it differs in more than so many times the most that a link may differ in.
FAR = 3

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))
#: For blocks of eight bytes with so many of a word: which bits are the word's.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _word_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each text, one text after the other, A-Z as a-z, and how many words each has.

    A word is cut into blocks of eight bytes. Each block is mixed with its place, which no sum of powers of a number can undo, and the
    mixed blocks are added up and mixed with the length: words of one block never share a hash with others of their length.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join([*raw, b" " * 8]), np.uint8)  # each text ends with a blank, and eight bytes can be read anywhere
    blank = np.concatenate(([True], _BLANK[data]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    begins = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    n = np.diff(np.searchsorted(starts, begins))
    if not len(starts):
        return np.zeros(0, np.uint64), n
    length = ends - starts
    blocks = (length + 7) // 8
    first = np.cumsum(blocks) - blocks
    of = np.repeat(np.arange(len(starts)), blocks)
    place = np.arange(len(of)) - first[of]
    held = np.lib.stride_tricks.sliding_window_view(data, 8)[starts[of] + 8 * place].view(np.uint64).ravel() & _KEEP[np.minimum(length[of] - 8 * place, 8)]
    with np.errstate(over="ignore"):
        mixed = _mixed(held ^ _mixed((place + 1).astype(np.uint64) * _ODD[3]))
        return _mixed(np.add.reduceat(mixed, first) + length.astype(np.uint64) * _ODD[4]), n


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, one text after the other, and where each begins
    (one more entry: the end). A text of fewer words is one shingle, an empty one none."""
    codes, n = _word_codes(texts)
    first = np.concatenate(([0], np.cumsum(n)))
    held = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    begins = np.concatenate(([0], np.cumsum(held)))
    with np.errstate(over="ignore"):
        mixed = np.concatenate((_mixed(codes + _ODD[1]), np.zeros(words, np.uint64)))
        rolled = np.zeros(len(codes) + 1, np.uint64)
        for i in range(words):  # over the words of all texts, one after the other
            rolled *= _ODD[0]
            rolled += mixed[i : i + len(rolled)]
        whole = np.ones(len(rolled), bool)  # where a shingle begins that stays within its text
        ends = np.minimum(words - 1, n)
        ends[(n > 0) & (n < words)] -= 1
        whole[np.arange(ends.sum()) + np.repeat(first[1:] - np.cumsum(ends), ends)] = False
        whole[-1] = False
        out = _mixed(rolled[whole])
        for i in np.flatnonzero((n > 0) & (n < words)):
            out[begins[i]] = xxhash.xxh3_64_intdigest(codes[first[i] : first[i + 1]].tobytes(), seed=int(n[i]))
    for i in np.flatnonzero(held > 1):
        out[begins[i] : begins[i + 1]].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[begins[:-1][held > 0]] = True
    return out[new], np.concatenate(([0], np.cumsum(new)))[begins]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of one text's distinct shingles."""
    return shingle_sets([text], words)[0]


def digest(own: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(own.tobytes())


class Names:
    """64-bit names of sets, 0 only for the empty one. Names that stand for several 128-bit digests are
    clashes; their sets are named by the other half of the digest. bits: of the first half, fewer in tests."""

    def __init__(self, clashes: frozenset[int] = frozenset(), bits: int = 64) -> None:
        self.clashes, self.bits = clashes, bits

    def halves(self, own: np.ndarray) -> tuple[int, int]:
        if not len(own):
            return 0, 0
        whole = digest(own)
        first, other = (int.from_bytes(whole[i : i + 8], "little", signed=True) for i in (0, 8))
        return first >> 64 - self.bits or 1, other or 1

    def of(self, own: np.ndarray) -> int:
        first, other = self.halves(own)
        return other if first in self.clashes else first


def bands(size: int) -> list[int]:
    """The set's band, and the next one if its least set may be similar enough."""
    b = 0
    while RATIO ** (b + 1) <= size:
        b += 1
    return [b, b + 1] if 5 * size >= 4 * RATIO ** (b + 1) else [b]


def n_cells(band: int) -> int:
    return 2 * max(1, math.ceil(RATIO ** (band + 1) / LOAD / 2))


class Cells:
    """The non-empty cells of some sets, each in each of its bands: signatures, how many shingles they hold, and which (set, band) they are of."""

    def __init__(self, flat: np.ndarray, begins: np.ndarray) -> None:
        sizes = np.diff(begins)
        self.takes = [(i, band) for i in np.flatnonzero(sizes) for band in bands(int(sizes[i]))]
        owner, band = (np.array([t[x] for t in self.takes], np.int64) for x in (0, 1))
        self.sizes, self.bands, self.n = sizes[owner], band, np.array([n_cells(b) for b in band.tolist()], np.int64)
        ends = np.cumsum(self.sizes)
        total = int(ends[-1]) if len(ends) else 0
        pick = np.arange(total) + np.repeat(begins[:-1][owner] - (ends - self.sizes), self.sizes)
        self.base = np.concatenate(([0], np.cumsum(self.n)))
        with np.errstate(over="ignore"):
            mixed = _mixed(flat[pick] ^ (np.uint64(0x5851F42D4C957F2D) + np.repeat(band.astype(np.uint64), self.sizes)))
            cell = (mixed % np.repeat(self.n.astype(np.uint64), self.sizes)).astype(np.int64) + np.repeat(self.base[:-1], self.sizes)
            content = _mixed(mixed + _ODD[1])
            held = np.bincount(cell, minlength=self.base[-1])
            low, high = (np.bincount(cell, (content >> np.uint64(shift)) & np.uint64(0xFFFFFFFF), self.base[-1]).astype(np.uint64) for shift in (0, 32))  # sums of 32-bit halves are exact
            self.full = np.flatnonzero(held)
            self.of = np.searchsorted(self.base, self.full, side="right") - 1
            number = (self.full - self.base[self.of]).astype(np.uint64)
            self.held = held[self.full]
            self.signs = _mixed((low + (high << np.uint64(32)))[self.full] ^ _place(number, self.bands[self.of]))


def _place(cell: np.ndarray, band: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(cell.astype(np.uint64) * _ODD[2] + (band.astype(np.uint64) + np.uint64(1)) * _ODD[3])


def signatures(flat: np.ndarray, begins: np.ndarray, often: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """What each set enumerates; often: how frequent each signature is, coarsely (0 to 63)."""
    cells = Cells(flat, begins)
    rank = often(cells.signs).astype(np.uint64) << np.uint64(58) | (63 - np.minimum(cells.held, 63)).astype(np.uint64) << np.uint64(52) | cells.signs >> np.uint64(12)
    starts = np.searchsorted(cells.of, np.arange(len(cells.takes) + 1))
    out: list[list[np.ndarray]] = [[] for _ in range(len(begins) - 1)]
    for i, (owner, band) in enumerate(cells.takes):
        lo, hi, need = starts[i], starts[i + 1], int(cells.sizes[i]) // 4 + 1
        out[owner].append(cells.signs[lo:hi][np.argsort(rank[lo:hi], kind="stable")[:need]] if need < hi - lo else cells.signs[lo:hi])
        if need > hi - lo:  # empty cells come last in the order, by number
            empty = np.setdiff1d(np.arange(cells.n[i]), cells.full[lo:hi] - cells.base[i], assume_unique=True)[: need - (hi - lo)]
            out[owner].append(_mixed_once(_place(empty, np.full(len(empty), band))))
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def _mixed_once(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(x + np.uint64(1))


def _blocks(batch: pa.RecordBatch, column: int, chars: int = 200_000) -> Iterator[tuple[int, list]]:
    """Rows of a batch in blocks of about so many characters: where each begins, and its values."""
    start, held, values = 0, 0, []
    for i, value in enumerate(batch.column(column)):
        values.append(value.as_py())
        held += len(values[-1] or "")
        if held >= chars:
            yield start, values
            start, held, values = i + 1, 0, []
    if values:
        yield start, values


def _new_sets(texts: list[str | None], seen: set, name: Callable) -> tuple[np.ndarray, np.ndarray, list, list[int]]:
    """Shingle sets, their names, and which of them are not empty and not seen before."""
    flat, begins = shingle_sets(texts)
    names, new = [], []
    for i in range(len(texts)):
        own = flat[begins[i] : begins[i + 1]]
        names.append(name(own))
        if len(own) and names[-1] not in seen:
            seen.add(names[-1])
            new.append(i)
    return flat, begins, names, new


def _chosen(flat: np.ndarray, begins: np.ndarray, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
    if len(which) == len(begins) - 1:
        return flat, begins
    parts = [flat[begins[i] : begins[i + 1]] for i in which]
    return np.concatenate(parts) if parts else flat[:0], np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _sets(docs: DataFrame, names: Names) -> DataFrame:
    """Per row: row_key, row_key2, doc_id, n_shingles, set_id, other (both halves of the digest); and, in rows of
    kind 1, frequent signatures of a task (as row_key) with their counts."""
    columns = ["kind", "row_key", "row_key2", "doc_id", "n_shingles", "set_id", "other"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        signs: list[np.ndarray] = []
        held = 0

        def frequent(id_type: pa.DataType) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(signs) if signs else np.zeros(0, np.uint64), return_counts=True)
            found, n = found[n >= FREQUENT], n[n >= FREQUENT]
            none = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(n), np.int32)), _long(found), none, pa.nulls(len(n), id_type), pa.array(n.astype(np.int64)), none, none], names=columns)

        id_type = None
        for batch in batches:
            id_type = batch.column(2).type
            sizes, ids = [], []
            for _, texts in _blocks(batch, 3):
                flat, begins, names_of, new = _new_sets(texts, seen, names.halves)
                sizes += np.diff(begins).tolist()
                ids += names_of
                signs.append(Cells(*_chosen(flat, begins, new)).signs)
                held += len(signs[-1])
            halves = [pa.array([x[i] for x in ids], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(ids), np.int32)), *batch.columns[:3], pa.array(sizes, pa.int64()), *halves], names=columns)
            if held > 1_000_000:
                yield frequent(id_type)
                signs, held = [], 0
        if signs:
            yield frequent(id_type)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("row_key", "row_key2", "doc_id", "text"), run, f"kind int, row_key long, row_key2 long, doc_id {kind}, n_shingles long, set_id long, other long")


def _named(sets: DataFrame, bits: int) -> tuple[DataFrame, Names]:
    """The rows with a name for each different set, and the rule of the names.

    Of n different sets about n * n / 2**65 share a first half (3 of 10**10); only these are collected.
    """
    several = sets.groupBy("set_id").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo < hi")
    clashes = frozenset(r["set_id"] for r in several.select("set_id").collect())
    if clashes:
        sets = sets.withColumn("set_id", F.when(F.col("set_id").isin(list(clashes)), F.col("other")).otherwise(F.col("set_id")))
    return sets.drop("other"), Names(clashes, bits)


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The HELD most frequent signatures, sorted, and the logarithm of their counts."""
    counts = sets.where("kind = 1").groupBy(F.col("row_key").alias("sig")).agg(F.sum("n_shingles").alias("n")).where("n >= 8")
    top = counts.orderBy(F.desc("n"), "sig").limit(HELD).toArrow()  # at most HELD rows
    signs = top.column("sig").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(signs)
    return signs[order], np.log2(top.column("n").to_numpy().astype(np.float64)).astype(np.int8)[order]


def _enumerated(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], names: Names) -> DataFrame:
    """set_id and its signatures, once for each task that meets the set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, level = shared.value
        seen: set[int] = set()

        def often(signs: np.ndarray) -> np.ndarray:
            if not len(keys):
                return np.zeros(len(signs), np.int8)
            at = np.minimum(np.searchsorted(keys, signs), len(keys) - 1)
            return np.where(keys[at] == signs, level[at], 0)

        for batch in batches:
            ids, signs = [], []
            for _, texts in _blocks(batch, 0):
                flat, begins, names_of, new = _new_sets(texts, seen, names.of)
                ids += [names_of[i] for i in new]
                signs += [x.view(np.int64) for x in signatures(*_chosen(flat, begins, new), often)]
            ends = np.cumsum([0, *map(len, signs)])
            values = np.concatenate(signs) if signs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], names=["set_id", "sigs"])

    return arrow_map(docs.select("text"), run, "set_id long, sigs array<long>")


class Filter:
    """A bit map of hashed longs that lets pass all it was made of."""

    def __init__(self, values: DataFrame, column: str) -> None:
        bits = values.select(F.shiftrightunsigned(column, 64 - _WORD_BITS).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b"))
        got = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most FILTER_WORDS rows
        words = np.zeros(FILTER_WORDS, np.uint64)
        words[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
        self.words = values.sparkSession.sparkContext.broadcast(words)

    def test(self, values: np.ndarray) -> np.ndarray:
        s = values.astype(np.int64).view(np.uint64)
        return (self.words.value[s >> np.uint64(64 - _WORD_BITS)] >> (s & np.uint64(63))) & np.uint64(1) == 1

    def passes(self, column: Column) -> Column:
        @F.arrow_udf("boolean")
        def test(values: pa.Array) -> pa.Array:
            return pa.array(self.test(values.to_numpy(zero_copy_only=False)))

        return test(column)


def _buckets(enumerated: DataFrame) -> DataFrame:
    """sig, set_id, centre of all buckets with two sets or more; a row may repeat."""
    twice = enumerated.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sig")
    keep = Filter(twice, "sig")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, sigs = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy()
            ends, sigs = ends - ends[0], sigs[ends[0] : ends[-1]]
            kept = keep.test(sigs)
            degree = np.concatenate(([0], np.cumsum(kept)))
            degree = degree[ends[1:]] - degree[ends[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(sigs[kept]), pa.array(np.repeat(batch.column(0).to_numpy(), degree)), pa.array(np.repeat(degree, degree))], names=["sig", "set_id", "degree"])

    shared = written(arrow_map(enumerated, run, "sig long, set_id long, degree long"), "jaccard-shared")
    centres = shared.groupBy("sig").agg(F.max(F.struct("degree", "set_id")).alias("top"), F.min("set_id").alias("a"), F.max("set_id").alias("b")).where("a < b").select("sig", F.col("top.set_id").alias("centre"))
    buckets = written(shared.join(centres, "sig").select("sig", "set_id", "centre"), "jaccard-buckets")
    sweep(enumerated.sparkSession, enumerated, shared)
    return buckets


def _members(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id, shingles (sorted, as bytes) of the wanted sets, read from one row of each."""
    firsts = rows.groupBy("set_id").agg(F.min(F.struct("row_key", "row_key2")).alias("row"))  # copies fold before they move
    one = written(firsts.join(wanted, "set_id").select(F.col("set_id").alias("wanted_id"), "row.row_key", "row.row_key2"), "jaccard-rows")
    found = docs.where(Filter(one, "row_key").passes(F.col("row_key"))).join(one, ["row_key", "row_key2"])
    found = found.dropDuplicates(["row_key", "row_key2"])  # repeated rows; where the join dealt out by these, nothing moves

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for _, texts in _blocks(batch, 1):
                flat, begins = shingle_sets(texts)
                sets += [flat[begins[i] : begins[i + 1]].tobytes() for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["set_id", "shingles"])

    out = arrow_map(found.select("wanted_id", "text"), run, "set_id long, shingles binary")
    return written(out, "jaccard-sets")


def _compared(pairs: DataFrame, sets: DataFrame, differences: bool) -> DataFrame:
    """pairs (a, b) with n_a, n_b, apart (shingles in one of them only), linked; with differences, also what b
    adds to a and what it lacks, where it isn't far."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, apart, added, removed = [], [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)  # noqa: PLW2901
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = x[at] == y
                d = len(x) + len(y) - 2 * int(both.sum())
                n_a.append(len(x))
                n_b.append(len(y))
                apart.append(d)
                near = differences and 9 * d <= FAR * (len(x) + len(y))
                added.append(y[~both].view(np.int64) if near else None)
                removed.append(np.setdiff1d(x, y[both], assume_unique=True).view(np.int64) if near else None)
            n = [pa.array(v, pa.int64()) for v in (n_a, n_b, apart)]
            linked = pa.array([9 * d <= p + q for d, p, q in zip(apart, n_a, n_b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *n, linked, pa.array(added, pa.list_(pa.int64())), pa.array(removed, pa.list_(pa.int64()))], names=["a", "b", "n_a", "n_b", "apart", "linked", "added", "removed"])

    right = pairs.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("s_b")), "b")
    both = right.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("s_a")), "a")
    return arrow_map(both.select("a", "b", "s_a", "s_b"), run, "a long, b long, n_a long, n_b long, apart long, linked boolean, added array<long>, removed array<long>")


def components(links: DataFrame) -> DataFrame:
    """node -> component (its least node) over links (a, b), by alternating large and small stars; nodes without links are left out."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    state = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        before, edges = edges, written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "stars")
        delete(before, large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _labelled(frame: DataFrame, column: str, named: DataFrame, label: str) -> DataFrame:
    own = named.select(F.col("node").alias(column), F.col("component").alias(label))
    return frame.join(own, column, "left").withColumn(label, F.coalesce(label, column))


def _across_near(compared: DataFrame, named: DataFrame) -> DataFrame:
    """Links (a, b) between unlike components, both near one centre, by their differences from it."""
    near = _labelled(compared.where("added is not null").select(F.col("a").alias("centre"), F.col("b").alias("set_id"), "n_a", "n_b", "apart", "linked", "added", "removed"), "set_id", named, "component")
    mixed = near.groupBy("centre").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max((~F.col("linked")).cast("int")).alias("loose")).where("lo < hi and loose = 1").select("centre")
    near = written(near.where(Filter(mixed, "centre").passes(F.col("centre"))), "jaccard-near")  # what else passes meets nothing below
    # Of a pair's differences from the centre, (9 (apart_a + apart_b) - size_a - size_b) / 18 must be common, which is over 0 if a
    # isn't linked. In one order of shingles the first common one leaves so many behind it in both.
    ordered = F.concat(F.array_sort("added"), F.array_sort("removed"))
    side = lambda x, at: [F.col("centre").alias(f"centre_{x}"), F.col("set_id").alias(x), F.col("component").alias(f"of_{x}"), F.col("apart").alias(f"apart_{x}"), F.col("n_b").alias(f"size_{x}"), F.posexplode(F.slice(ordered, F.lit(1), at.cast("int"))).alias(f"at_{x}", f"e_{x}")]
    least = F.floor((9 * F.col("apart") + F.col("n_a") - F.col("n_b")) / 18) + 1  # of b's, whatever a is
    b = near.select(*side("b", F.greatest(F.lit(0), F.col("apart") - least + 1)))
    a = near.where("not linked").select(*side("a", F.floor(F.col("n_b") / 4) + 1))
    common = 9 * (F.col("apart_a") + F.col("apart_b")) - F.col("size_a") - F.col("size_b")
    early = (common <= 18 * (F.col("apart_a") - F.col("at_a"))) & (common <= 18 * (F.col("apart_b") - F.col("at_b")))
    met = a.join(b, F.expr("centre_a = centre_b and e_a = e_b and of_a <> of_b") & _possible() & early)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "centre_a").groupBy("a", "b").agg(F.min("centre_a").alias("centre"))
    # What a and b have apart from each other is what their differences from the centre have apart: no set moves again.
    own = lambda x: near.select("centre", F.col("set_id").alias(x), F.col("apart").alias(f"apart_{x}"), F.col("n_b").alias(f"size_{x}"), F.col("added").alias(f"added_{x}"), F.col("removed").alias(f"removed_{x}"))
    full = pairs.join(own("a"), ["centre", "a"]).join(own("b"), ["centre", "b"])
    both = F.size(F.array_intersect("added_a", "added_b")) + F.size(F.array_intersect("removed_a", "removed_b"))
    links = full.where(9 * (F.col("apart_a") + F.col("apart_b") - 2 * both) <= F.col("size_a") + F.col("size_b")).select("a", "b")
    out = written(links, "jaccard-links")
    delete(near)
    return out


def _possible() -> Column:
    """Whether the distances from the centre and the sizes leave room for a link."""
    most = F.col("size_a") + F.col("size_b")
    return (9 * F.abs(F.col("apart_a") - F.col("apart_b")) <= most) & (9 * F.abs(F.col("size_a") - F.col("size_b")) <= most)


def _across_far(buckets: DataFrame, compared: DataFrame, named: DataFrame) -> DataFrame:
    """Candidates (a, b) in unlike components of one bucket, of which one at least is far from the centre."""
    far = compared.where("added is null")
    if far.isEmpty():
        return compared.select("a", "b").limit(0)
    # Few buckets have such a member; bit maps leave the others where they are.
    held = buckets.where(Filter(far, "b").passes(F.col("set_id"))).join(far.select(F.col("a").alias("centre"), F.col("b").alias("set_id")), ["centre", "set_id"], "left_semi").select("sig").distinct()
    few = written(buckets.where(Filter(held, "sig").passes(F.col("sig"))), "jaccard-few")
    of = compared.select(F.col("a").alias("centre"), F.col("b").alias("set_id"), F.col("n_b").alias("size"), "apart", F.col("added").isNull().alias("far"))
    rows = _labelled(few.join(of, ["centre", "set_id"]), "set_id", named, "component")
    rows = written(rows.select("sig", "set_id", "size", "apart", "far", "component"), "jaccard-far")
    some = rows.groupBy("sig").agg(F.max("far").alias("far"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("far and lo < hi").select("sig")
    rows = rows.join(some, "sig")
    side = lambda x: [F.col("set_id").alias(x), F.col("component").alias(f"of_{x}"), F.col("size").alias(f"size_{x}"), F.col("apart").alias(f"apart_{x}"), F.col("far").alias(f"far_{x}")]
    a, b = rows.where("far").select(F.col("sig"), *side("a")), rows.select(F.col("sig").alias("sig_b"), *side("b"))
    met = a.join(b, (F.col("sig") == F.col("sig_b")) & (F.col("of_a") != F.col("of_b")) & (~F.col("far_b") | (F.col("a") < F.col("b"))) & _possible())
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _row_keys(id_col: str, text_col: str) -> list[Column]:
    """128 bits that stand for a row's id and text, as two longs."""
    return [F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias(name) for seed, name in ((0, "row_key"), (1, "row_key2"))]


def _components_of_rows(docs: DataFrame, id_col: str, text_col: str, name_bits: int = 64) -> DataFrame:
    """Per row of docs: row_key, row_key2, doc_id, n_shingles, set_id, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *_row_keys(id_col, text_col))
    all_sets = written(_sets(rows, Names(bits=name_bits)), "jaccard-all")
    sets, names = _named(all_sets.where("kind = 0").drop("kind"), name_bits)
    buckets = _buckets(written(_enumerated(rows, _frequent(all_sets), names), "jaccard-signatures"))
    stars = written(buckets.where("set_id <> centre").select(F.col("centre").alias("a"), F.col("set_id").alias("b")).distinct(), "jaccard-stars")
    wanted = stars.select(F.col("a").alias("set_id")).union(stars.select(F.col("b").alias("set_id"))).distinct()
    members = _members(rows.select("row_key", "row_key2", "text"), sets.select("set_id", "row_key", "row_key2"), wanted)
    sweep(spark)
    compared = written(_compared(stars, members, differences=True), "jaccard-compared")
    sweep(spark)
    links = compared.where("linked").select("a", "b")
    named = written(components(links), "jaccard-named")
    near = _across_near(compared, named)
    sweep(spark)
    far = written(_across_far(buckets, compared, named), "jaccard-across")
    sweep(spark, buckets)
    ends = far.select(F.explode(F.array("a", "b")).alias("set_id"))
    some = members.where(Filter(ends, "set_id").passes(F.col("set_id")))
    more = written(near.union(_compared(far, some, differences=False).where("linked").select("a", "b")), "jaccard-links")
    sweep(spark, members)
    if not more.isEmpty():
        named = written(components(links.union(more)), "jaccard-named")
    # Rows fold to their set and sets to their component before anything is joined; each result is a table of
    # its own, so that a join dealt by a hot set or component can be split.
    least = written(sets.where("set_id <> 0").groupBy("set_id").agg(F.min("doc_id").alias("least")), "jaccard-least")
    linked = least.join(named.withColumnRenamed("node", "set_id"), "set_id", "left")
    linked = written(linked.select("set_id", "least", F.coalesce("component", "set_id").alias("component")), "jaccard-labelled")
    of_component = written(linked.groupBy("component").agg(F.min("least").alias("component_id")), "jaccard-components")
    answers = written(linked.join(of_component, "component").select("set_id", "component_id"), "jaccard-answers")
    delete(least, linked, of_component)
    columns = ["row_key", "row_key2", "doc_id", "n_shingles", "set_id", "component_id"]
    return sets.where("set_id <> 0").join(answers, "set_id").select(*columns).unionAll(sets.where("set_id = 0").withColumn("component_id", F.col("doc_id")).select(*columns))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, set_id, component_id (the least doc_id reachable by links).

    Words are runs of characters other than ASCII white space, with A-Z lower-cased. Null and empty texts
    have no shingle and no link: their component is their own id. Equal sets are linked, whatever
    the number of copies. A null id is the least of no component unless all its ids are null, and then
    null; repeated rows get equal answers. No rows give no rows. Other columns are not read.
    """
    return _components_of_rows(docs, id_col, text_col, **options).select("doc_id", "n_shingles", "set_id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose component has a smaller id, with docs' columns; rows without an id stay.

    Decisions are by row (id and text): of rows that repeat an id, each goes or stays by its own text, and
    all rows with the least id of a component stay, as do repetitions of one row. No rows give no rows.
    """
    found = _components_of_rows(docs, id_col, text_col)
    dropped = written(found.where("component_id <> doc_id").select(F.col("row_key").alias("__nj_1"), F.col("row_key2").alias("__nj_2")).distinct(), "jaccard-dropped")
    one, two = _row_keys(id_col, text_col)
    maybe = Filter(dropped, "__nj_1").passes(one)
    kept = docs.where(maybe).join(dropped, (one == F.col("__nj_1")) & (two == F.col("__nj_2")), "left_anti")
    return docs.where(~maybe).unionAll(kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= {WORDS} THEN list_distinct(list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s), e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
sym AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, sym.y FROM r JOIN sym ON r.y = sym.x)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.n
"""
