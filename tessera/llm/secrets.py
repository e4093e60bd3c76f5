"""Secret scans with multipart credential linking.

Base findings stand by themselves: assignments of a value to a telling name, access identifiers with
their prefix, and long runs of hexadecimal digits. Weak candidates do not: a credential that is cut in
parts shows an identifier, a secret and an endpoint that each could be ordinary text. Scopes are
stretches of text without a blank line; within a scope an interval join pairs parts at any distance (or
at most ``reach`` characters apart), and a weak part is reported only where a complementary part, weak or
base, co-occurs. All candidates are linked, overlapping ones too; what overlaps is settled among those that
are completed. An endpoint may hold parts of its own: identifiers anywhere, secrets in its user part or
after its first ?, # or ;, as a long path is no secret. The join sweeps the parts in order of position, so it costs one pass and never lists pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, read

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")

#: Weak parts: an identifier, a secret or an endpoint of a credential.
WEAK = {
    "weak_id": re.compile(r"""(?:client|account|user|access|key)[_-]?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{4,}|(?<![A-Za-z0-9])(?-i:(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{8,})""", re.IGNORECASE | re.ASCII),
    "weak_secret": re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}"),
    "weak_endpoint": re.compile(r"(?:[a-z][a-z0-9+.-]{1,15}://|(?:endpoint|host|server)\x20*[:=]\x20*)[^\s\"'<>]{4,}", re.IGNORECASE | re.ASCII),
}
#: The part of a credential that a finding can be.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "weak_endpoint": "endpoint"}
#: What completes each role.
COMPLETES = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}
REACH = math.inf
#: A secret where an endpoint's credentials stand: the user part's beginning, or after a : or =.
INNER_SECRET = re.compile(r"(?:^|(?<=[:=]))" + WEAK["weak_secret"].pattern.split(")", 1)[1])
KINDS = (*BASE_KINDS, *WEAK)
SCOPE_END = re.compile(r"\n[ \t\r]*\n")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Base findings as (start, end, kind) by start, then kind; leftmost, non-overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def _credentials(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Where an endpoint's credentials may stand: its user part, and what follows its address."""
    scheme = text.find("://", start, stop)
    host = scheme + 3 if scheme >= 0 else start
    rest = min(i if i >= 0 else stop for i in (text.find(c, host, stop) for c in "?#;"))
    at = text.rfind("@", host, rest)
    if scheme >= 0 and at >= 0:
        yield host, at
    if rest < stop:
        yield rest, stop


def _candidates(text: str, base: list[Span]) -> tuple[list[Span], dict[Span, list[Span]]]:
    """Weak parts that are no base finding, overlaps among them included; and by endpoint the secrets, base ones too, that it holds."""
    weak = [(m.start(), m.end(), kind) for kind, pattern in WEAK.items() for m in pattern.finditer(text)]
    places = {span: list(_credentials(text, *span[:2])) for span in weak if span[2] == "weak_endpoint"}
    stretches = [*(x for within in places.values() for x in within), *(span[:2] for span in weak if span[2] == "weak_id")]  # an identifier's value may be the secret
    inner = {(at + m.start(), at + m.end(), "weak_secret") for at, stop in stretches for m in INNER_SECRET.finditer(text[at:stop])}
    cover: list[list[int]] = []  # stretches that base findings take, disjoint, in order
    for start, stop, _ in base:
        if cover and start < cover[-1][1]:
            cover[-1][1] = max(stop, cover[-1][1])
        else:
            cover.append([start, stop])
    starts = [c[0] for c in cover]
    parts, holds, held = [], {}, 0  # held: where the last endpoint ends
    for span in sorted({*weak, *inner}, key=_order):
        i = bisect_left(starts, span[1])
        within = places.get(span, [])
        inside = []
        while i and cover[i - 1][1] > span[0] and any(at <= cover[i - 1][0] and cover[i - 1][1] <= stop for at, stop in within):
            i -= 1
            inside.append((cover[i][0], cover[i][1], "assign"))
        if i and cover[i - 1][1] > span[0]:
            continue
        if span in places:
            parts.append(span)
            holds[span] = inside
            held = span[1]
        elif span[0] >= held or span[2] == "weak_id" or span in inner:
            parts.append(span)
    ends = sorted(holds)
    for span in parts:  # endpoints don't overlap one another
        i = bisect_right(ends, (span[0], math.inf, "")) - 1
        if span[2] == "weak_secret" and i >= 0 and span[1] <= ends[i][1]:
            holds[ends[i]].append(span)
    return parts, holds


def linked_spans(text: str, base: list[Span], reach: float = REACH) -> list[Span]:
    """Weak parts that a complementary part completes within one scope and reach.

    Parts are linked first, and overlaps are settled among those that are completed. Parts that overlap don't complete each
    other, but an endpoint and the secrets that it holds do. Of completed identifiers and secrets that overlap, the first stays; a weak part that
    overlaps a base finding is that finding.
    """
    parts, holds = _candidates(text, base)
    if not parts:
        return []
    scopes = [m.end() for m in SCOPE_END.finditer(text)]
    every = sorted([*base, *parts], key=_order)
    fits = {x for endpoint, secrets in holds.items() if secrets for x in (endpoint, *(s for s in secrets if s[2] in WEAK))}

    def link(ordered: list[Span], others: list[Span], met: Callable[[Span, Span], bool], gap: Callable[[Span, Span], int]) -> None:
        """others come nearer one by one; of those that a span has passed, the last of each role is the nearest."""
        nearest: dict[str, Span] = {}
        i = 0
        for span in ordered:
            while i < len(others) and met(others[i], span):
                nearest[ROLE[others[i][2]]] = others[i]
                i += 1
            if span[2] in WEAK and span not in fits:
                found = (nearest[role] for role in COMPLETES[ROLE[span[2]]] if role in nearest)
                if any(gap(x, span) <= reach and bisect_right(scopes, x[0]) == bisect_right(scopes, span[0]) for x in found):
                    fits.add(span)

    link(every, sorted(every, key=lambda x: x[1]), lambda x, span: x[1] <= span[0], lambda x, span: span[0] - x[1])
    link(sorted(every, key=lambda x: -x[1]), every[::-1], lambda x, span: x[0] >= span[1], lambda x, span: x[0] - span[1])
    out, taken = [], 0
    for span in sorted(fits, key=_order):
        if span[2] != "weak_endpoint":
            if span[0] < taken:
                continue
            taken = span[1]
        out.append(span)
    return out


def digest(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: float = REACH) -> DataFrame:
    """One row per row of docs: doc_id and findings, an array of (start, end, kind, found, weak).

    Positions count code points, end exclusive, in order of start, kind, end. Null and empty texts have
    no findings; texts of any length are scanned whole and row by row, so repeated rows repeat their
    findings and ties of position go by kind. No rows give no rows. Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("found", pa.string()), ("weak", pa.bool_())]))
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                spans = sorted([*base, *linked_spans(text, base, reach)], key=_order)
                rows.append([{"start": s, "end": e, "kind": k, "found": text[s:e], "weak": k in WEAK} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "findings"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, findings array<struct<start: long, end: long, kind: string, found: string, weak: boolean>>")


def summary(found: DataFrame) -> DataFrame:
    """The digest columns of scan()'s result: n_assign, n_access, n_hex, base_sha256, spans."""
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    base = joined(F.filter("findings", lambda f: ~f["weak"]))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(base, 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(digest(spans).encode()).hexdigest()
