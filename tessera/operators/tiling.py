"""One tile: all pairs of two blocks of titles, compared in columns of numbers. The caller's tasks each hold two bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of one title that are compared at a time: a 64-bit number, whose last bit takes the carry.
WORD = 63
#: Pairs that are compared at once, and fewer where titles are long (pairs times characters).
PAIRS, CELLS = 4096, 1 << 23
#: So few pairs are settled one by one.
FEW = 96
#: Numbers of characters. Frequent ones have their own; the rest share four, which can only bring two titles nearer. The last one ends a title.
_OWN = "abcdefghijklmnopqrstuvwxyz .,-0123456789àâçéèêíîïñóôöúûüäßáù"
_CODES, _END = 64, 63
_CODE = np.array([len(_OWN) + c % (_END - len(_OWN)) for c in range(256)], np.uint8)
_CODE[[ord(c) for c in _OWN]] = range(len(_OWN))
#: Groups of characters that are counted in each title; all others are one more.
_GROUPS = (*"etaoinshrdlu ", "cmf", "pgwy", "bvkxjqz")
_GROUP = np.full(_CODES, len(_GROUPS), np.uint8)
for _k, _group in enumerate(_GROUPS):
    _GROUP[_CODE[[ord(c) for c in _group]]] = _k
_GROUP[_END] = len(_GROUPS) + 1
#: Pieces of so many characters are looked for, by 2^PIECES hashes and ZONES stretches of a title; titles of LONG or more are met in parts, and places are looked up BATCH at a time.
SIZES, PIECES, ZONES, LONG, BATCH = (4, 3), 13, 32, 512, 1 << 15


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    get = where.get
    for c in b:
        met = row & get(c, 0)
        row = (row + met | row - met) & full
    return len(a) - row.bit_count()


def counted(texts: list[str], groups: Sequence[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Titles x groups: how many characters of each group a title has; and titles x buckets: least hashes of its pieces of four characters (a shorter title is one piece)."""
    end = "\x00\x00\x00\x00"  # no piece reaches into the next title
    points = np.frombuffer((end.join(texts) + 2 * end).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.array([len(t) for t in texts], np.int64)
    many = n + len(end)
    start, whole = np.concatenate(([0], np.cumsum(many)[:-1])).astype(np.int64), int(many.sum())
    group = np.full(256, len(groups), np.uint8)
    for k, characters in enumerate(groups):
        group[[ord(c) for c in characters]] = k
    which = np.where(points[:whole] < 256, group[points[:whole] & 255], len(groups))
    counts = np.stack([np.add.reduceat(which == k, start, dtype=np.int32) for k in range(len(groups))], axis=1)
    hashes = np.zeros(whole, np.uint64)
    for k in range(4):
        hashes = (hashes ^ points[k : k + whole]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    beyond = np.repeat(start + np.maximum(n - 4, 0), many) < np.arange(whole)
    least = np.empty((len(texts), buckets), np.int64)
    for k in range(buckets):
        mixed = (hashes ^ np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        mixed[beyond] = np.iinfo(np.uint64).max
        least[:, k] = np.minimum.reduceat(mixed, start).view(np.int64)
    return counts, least


class Spelled:
    """Titles as one array of character numbers with a closing one after each title."""

    def __init__(self, texts: list[str]) -> None:
        ends = "\x00".join(texts) + "\x00"
        points = np.frombuffer(ends.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = np.array([len(t) for t in texts], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.n + 1)[:-1])).astype(np.int64)
        self.end = self.start + self.n
        self.codes = _CODE[(points & 255).astype(np.uint8)]
        self.codes[self.end] = _END

        self.texts = texts

    def counts(self) -> np.ndarray:
        """Groups x titles: how many characters of each group a title has."""
        groups = _GROUP[self.codes]
        return np.array([np.add.reduceat(groups == k, self.start, dtype=np.int32) for k in range(len(_GROUPS) + 1)])

    def text(self, i: int) -> str:
        return self.texts[i]

    def pieces(self, size: int, first: int, last: int) -> np.ndarray:
        """Hashes of the pieces of size characters of titles first to last - 1, one for each character; those that reach over an end are no pieces."""
        start, stop = (int(self.start[first]), int(self.end[last - 1]) + 1) if last > first else (0, 0)
        codes = np.concatenate((self.codes[start:stop], np.full(size, _END, np.uint8)))
        hashes = np.zeros(stop - start, np.uint32)
        for k in range(size):
            hashes = (hashes << np.uint32(6)) | codes[k : k + stop - start]
        return ((hashes * np.uint32(2654435761)) >> np.uint32(32 - PIECES)).astype(np.int64)

    def apart(self, a: np.ndarray, b: np.ndarray, at: int) -> np.ndarray:
        """By how much the counts of characters from place at on differ, summed up: a lower bound of the edits there."""
        titles, row = np.unique(np.concatenate((a, b)), return_inverse=True)
        counts = np.zeros((len(titles), _CODES), np.int32)
        for k, i in enumerate(titles):
            counts[k] = np.bincount(self.codes[min(self.start[i] + at, self.end[i]) : self.end[i]], minlength=_CODES)
        return np.abs(counts[row[: len(a)]] - counts[row[len(a) :]]).sum(axis=1, dtype=np.int64)

    def masks(self, which: np.ndarray, at: int) -> np.ndarray:
        """For WORD characters from place at of some titles: a bit for each place at which a character stands, titles x characters, flat."""
        out = np.zeros((len(which), _CODES), np.uint64)
        every, start, end = np.arange(len(which)), self.start[which] + at, self.end[which]
        for k in range(WORD):
            out[every, self.codes[np.minimum(start + k, end)]] |= np.uint64(1 << k)
        out[:, _END] = 0
        return out.reshape(-1)


def within(s: Spelled, a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Which pairs differ by at most most (len a + len b) insertions and deletions.

    Rows of the common-subsequence table, WORD characters of a at a time, as bits; only places of b that so few edits can reach are
    looked at. After each row of words a pair goes if the edits so far, and those that the lengths and the counts of characters of what
    is left ask for, are too many. Few pairs are settled one by one.
    """
    n_a, n_b = s.n[a], s.n[b]
    edits = np.floor(most * (n_a + n_b) + 1e-9).astype(np.int64)
    gone, come = (edits + n_a - n_b) // 2, (edits + n_b - n_a) // 2  # characters of a and of b that a pair may lose
    left, base = np.arange(len(a)), np.zeros(len(a), np.int64)
    keep = np.flatnonzero((gone >= 0) & (come >= 0) & (s.apart(a, b, 0) <= edits))
    carried, first, at = None, 0, 0
    full, top = np.uint64((1 << WORD) - 1), np.uint64(WORD)
    out = np.zeros(len(a), bool)
    while True:
        left, a, b, n_a, n_b, edits, gone, come, base = (v[keep] for v in (left, a, b, n_a, n_b, edits, gone, come, base))
        if len(a) < max(1, FEW):
            for k, i, j, most_edits in zip(left.tolist(), a.tolist(), b.tolist(), edits.tolist(), strict=True):
                out[k] = s.n[i] + s.n[j] - 2 * common(s.text(i), s.text(j)) <= most_edits
            return out
        p = np.minimum(at + WORD, n_a)
        begin = max(first, int((at - gone).min()), 0)
        stop = max(begin, int(np.minimum(n_b, p + come).max()))
        if carried is not None:
            carried = carried[:, keep]
            base = base + carried[: begin - first].sum(axis=0, dtype=np.int64)
        titles, row = np.unique(a, return_inverse=True)
        masks, row = s.masks(titles, at), row.astype(np.int64) * _CODES
        v, length = np.full(len(a), full), base.copy()
        start, end = s.start[b], s.end[b]
        carries = np.zeros((stop - begin, len(a)), np.uint8)
        rest, checked = n_a - p, max(begin, int((p - gone).min()))
        unlike = s.apart(a, b, at + WORD)
        least = np.full(len(a), np.iinfo(np.int64).max)

        def asked(q: int) -> np.ndarray:
            """Edits if the first p characters of a stand against the first q of b."""
            return p + q - 2 * length + np.maximum(np.abs(rest - (n_b - q)), unlike - np.abs(q - at - WORD))  # noqa: B023

        if checked <= begin:
            least = asked(begin)
        total, u, where = np.empty_like(v), np.empty_like(v), np.empty_like(row)
        for q in range(begin, stop):
            np.add(start, q, out=where)
            np.minimum(where, end, out=where)
            np.add(row, s.codes[where], out=where)
            np.take(masks, where, out=u, mode="clip")
            u &= v
            np.add(v, u, out=total)
            if carried is not None and q - first < len(carried):
                total += carried[q - first]
            v ^= u
            np.right_shift(total, top, out=u)
            total &= full
            v |= total
            carries[q - begin] = u
            length += carries[q - begin]
            if q + 1 >= checked:
                np.minimum(least, asked(q + 1), out=least)
        alive = least <= edits
        out[left[alive & (n_a <= at + WORD)]] = True
        keep = np.flatnonzero(alive & (n_a > at + WORD))
        carried, first, at = carries, begin, at + WORD


def _near_in_parts(s: Spelled, scope: np.ndarray, fresh: np.ndarray, block: np.ndarray, home: int, own: bool, most: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one scope whose lengths, counts of characters and shared pieces allow so few edits: one fresh title with those of the home block, which come first, sorted by scope and length.

    Two fresh titles meet once: inside the home block, which is compared with itself if own, by the earlier one, and in the tile of the lower block.
    """
    n, by_count = s.n, s.counts()
    at_home = int(np.searchsorted(block != home, True))
    shared = Shared(s, at_home, most)
    scope_start, scope_end = (np.searchsorted(scope[:at_home], scope, side=side) for side in ("left", "right"))
    shortest, longest = (np.ceil(n * (1 - most) / (1 + most) - 1e-6), np.floor(n * (1 + most) / (1 - most) + 1e-6)) if most < 1 else (np.zeros(len(n)), np.full(len(n), np.inf))
    every = bool(fresh.all())
    for i in np.flatnonzero(fresh).tolist():
        if i < at_home and not own:
            continue
        start, stop = int(scope_start[i]), int(scope_end[i])
        stop = start + int(np.searchsorted(n[start:stop], longest[i], side="right"))
        start = i + 1 if every and i < at_home else start + int(np.searchsorted(n[start:stop], shortest[i], side="left"))
        if start >= stop:
            continue
        apart = by_count[:, start:stop] - by_count[:, i : i + 1]
        apart = np.abs(apart, out=apart).sum(axis=0, dtype=np.int32)
        found = apart <= most * (n[start:stop] + n[i]) + 1e-9
        if not every and i < at_home:
            found &= ~fresh[start:stop] | (np.arange(start, stop) > i)
        elif block[i] < home:
            found &= ~fresh[start:stop]
        j = shared.near(i, np.flatnonzero(found) + start)
        if len(j):
            yield np.full(len(j), i), j


class Shared:
    """How many pieces of the titles of the home block (the first at_home) another title can share with them, each near its place.

    Of pieces that don't overlap an edit destroys one at most. Of those at each place a lost character destroys size, and one that comes size - 1.
    A piece that stays moves by no more places than characters are lost or come before it. A title is cut into zones of 2^k places, ZONES at most.
    """

    def __init__(self, s: Spelled, at_home: int, most: float) -> None:
        self.s, self.most = s, most
        self.shift = np.maximum(np.frexp(s.n.astype(np.float64))[1].astype(np.int64) - ZONES.bit_length() + 1, 0)
        # Long titles are met in parts of near lengths, as their pieces have fewer places then.
        self.part = np.floor(np.log2(np.maximum(s.n, 1)) * np.where(s.n < LONG, 1, 8)).astype(np.int64)
        self.met = np.zeros(ZONES << PIECES, np.uint8)
        self.keys: dict[int, np.ndarray] = {}
        many = s.n[:at_home] + 1
        zones = np.arange(int(many.sum())) - np.repeat(s.start[:at_home], many) >> np.repeat(self.shift[:at_home], many)
        for size in SIZES:
            keys = (s.pieces(size, 0, at_home) * ZONES + np.minimum(zones, ZONES - 1)).astype(np.int32)
            self.keys[size] = np.concatenate((keys, np.zeros(int(s.n.max(initial=0)) + 2, np.int32)))  # titles of a batch are read on over the last end

    def near(self, i: int, j: np.ndarray) -> np.ndarray:
        """Those of the titles j (sorted by length) that can differ from title i by so few edits."""
        if not len(j):
            return j
        borders = np.flatnonzero(np.diff(self.part[j])) + 1
        return np.concatenate([self._near(i, part) for part in np.split(j, borders)]) if len(borders) else self._near(i, j)

    def _near(self, i: int, j: np.ndarray) -> np.ndarray:
        s, n, n_j = self.s, int(self.s.n[i]), self.s.n[j]
        edits = np.floor(self.most * (n + n_j) + 1e-9).astype(np.int64)
        lost, come = (edits + n_j - n) // 2, (edits + n - n_j) // 2  # characters that only j has, and only i
        shift, back, on = int(self.shift[j[0]]), int(come.max()), int(lost.max())
        for size in SIZES:
            each = n_j - size + 1 - size * lost - (size - 1) * come
            if max(int((n_j // size - edits).max()), int(each.max())) <= 0:
                continue
            hashes = s.pieces(size, i, i + 1)[: max(0, n - size + 1)] * ZONES
            place = np.arange(len(hashes))
            low, high = np.minimum(np.maximum(place - back, 0) >> shift, ZONES - 1), np.minimum(place + on >> shift, ZONES - 1)
            self.met.fill(0)
            if len(hashes):
                zones = low[:, None] + np.arange(int((high - low).max()) + 1)
                np.minimum(zones, high[:, None], out=zones)
                zones += hashes[:, None]
                self.met[zones] = 1
            for step in (size, 1):
                keep = self._count(size, step, j, n_j) >= (each if step == 1 else n_j // size - edits)
                j, n_j, edits, lost, come, each = (v[keep] for v in (j, n_j, edits, lost, come, each))
                if not len(j):
                    return j
        return j

    def _count(self, size: int, step: int, j: np.ndarray, n_j: np.ndarray) -> np.ndarray:
        """How many pieces of each j, every step places, are met. Shorter titles of a batch are read on over their end, which can only count more."""
        out, keys, start, at = np.empty(len(j), np.int64), self.keys[size], self.s.start[j], 0
        while at < len(j):
            stop = min(len(j), at + max(1, BATCH * step // max(1, int(n_j[at]))))
            places = np.arange(0, max(0, int(n_j[stop - 1]) - size + 1), step)
            out[at:stop] = self.met.take(keys.take(start[at:stop, None] + places)).sum(axis=1, dtype=np.int64)
            at = stop
        return out


def close_pairs(table: pa.Table, most: float, similar: Callable[[str, str], bool] | None = None) -> tuple[list[int], list[int]]:
    """Places (the earlier one first) of the pairs of a tile that differ by at most most (len a + len b) insertions and deletions and, if given, are similar(later, earlier).

    table: place, t, scope, fresh, block, i and j of a tile. Titles of block i are compared with each other, if j is i, and with the others. Pairs without a fresh title aren't looked at.
    """
    home, own = table["i"][0].as_py(), table["i"][0] == table["j"][0]
    table = table.append_column("guest", pc.not_equal(table["block"], home)).append_column("n", pc.utf8_length(table["t"]))
    table = table.sort_by([("guest", "ascending"), ("scope", "ascending"), ("n", "ascending"), ("place", "ascending")])
    texts, place = table["t"].to_pylist(), table["place"].to_numpy()
    scope, fresh, block = (table[c].to_numpy() for c in ("scope", "fresh", "block"))
    s = Spelled(texts)
    first, second = [], []

    def settle(a: np.ndarray, b: np.ndarray) -> None:
        order = np.argsort(s.n[a], kind="stable")
        a, b = a[order], b[order]
        at = 0
        while at < len(a):
            size = PAIRS
            while size > 1 and size * int(s.n[a[min(at + size, len(a)) - 1]]) > CELLS:
                size //= 2
            x, y = a[at : at + size], b[at : at + size]
            at += size
            near = within(s, x, y, most)
            for i, j in zip(x[near].tolist(), y[near].tolist(), strict=True):
                i, j = (i, j) if place[i] < place[j] else (j, i)
                if similar is None or similar(texts[j], texts[i]):
                    first.append(int(place[i]))
                    second.append(int(place[j]))

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for pair in _near_in_parts(s, scope, fresh, block, home, own, most):
        waiting.append(pair)
        held += len(pair[0])
        if held >= 16 * PAIRS:
            settle(*map(np.concatenate, zip(*waiting, strict=True)))
            waiting, held = [], 0
    if waiting:
        settle(*map(np.concatenate, zip(*waiting, strict=True)))
    return first, second
