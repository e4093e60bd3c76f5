"""The boolean search language: parsing, evaluation over the corpus, and other dialects.

Terms are ``"quoted phrases"``, ``wild*cards`` (``?`` is one character), ``a NEAR/n b`` (b may be a group of
alternatives) and plain words; AND, OR, NOT and parentheses combine them. NEAR stays NEAR, inside NOT too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Term:
    """kind: phrase, word, wildcard or near."""

    kind: str
    text: str
    options: tuple[str, ...] = ()
    distance: int = 0


@dataclass(frozen=True)
class Node:
    """op: and, or, not."""

    op: str
    parts: tuple


_TOKEN = re.compile(r'"([^"]*)"|(\()|(\))|\b(AND|OR|NOT)\b|NEAR/(\d+)|([^\s()"]+)')


def _tokens(text: str) -> list[tuple[str, str]]:
    out = []
    for m in _TOKEN.finditer(re.sub("[‑‒–—]", "-", text)):
        kind = ("phrase", "(", ")", "op", "near", "word")[m.lastindex - 1]
        out.append((kind, m[m.lastindex]))
    return out


def parse(text: str) -> Term | Node:
    tokens, at = _tokens(text), 0

    def peek() -> tuple[str, str]:
        return tokens[at] if at < len(tokens) else ("end", "")

    def take() -> tuple[str, str]:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def either() -> Term | Node:
        parts = [both()]
        while peek() == ("op", "OR"):
            take()
            parts.append(both())
        return parts[0] if len(parts) == 1 else Node("or", tuple(parts))

    def both() -> Term | Node:
        parts = [one()]
        while peek()[0] in ("phrase", "word", "(") or peek() in (("op", "AND"), ("op", "NOT")):
            if peek() == ("op", "AND"):
                take()
            parts.append(one())
        return parts[0] if len(parts) == 1 else Node("and", tuple(parts))

    def one() -> Term | Node:
        kind, value = peek()
        if (kind, value) == ("op", "NOT"):
            take()
            return Node("not", (one(),))
        if kind == "(":
            take()
            inner = either()
            if peek()[0] != ")":
                raise ValueError("missing )")
            take()
            return inner
        if kind not in ("phrase", "word"):
            raise ValueError(f"unexpected {value or 'end'}")
        take()
        if peek()[0] == "near":
            return Term("near", value, alternatives(distance := int(take()[1])), distance)
        return Term("wildcard" if kind == "word" and re.search(r"[*?]", value) else kind, value)

    def alternatives(_: int) -> tuple[str, ...]:
        if peek()[0] == "(":
            take()
            out = [take()[1]]
            while peek() == ("op", "OR"):
                take()
                out.append(take()[1])
            if take()[0] != ")":
                raise ValueError("missing )")
            return tuple(out)
        if peek()[0] not in ("phrase", "word"):
            raise ValueError("NEAR needs a term on its right")
        return (take()[1],)

    tree = either()
    if at < len(tokens):
        raise ValueError(f"unexpected {peek()[1]}")
    return tree


def near(text: str, first: str, options: tuple[str, ...], distance: int) -> bool:
    """Some occurrence of first and of an option with at most distance words from the start of one to the start of the other."""
    low = text.lower()
    starts = [m.start() for m in re.finditer(re.escape(first.lower()), low)]
    for option in options:
        for b in (m.start() for m in re.finditer(re.escape(option.lower()), low)):
            if any(len(low[min(a, b) : max(a, b)].split()) <= distance for a in starts):
                return True
    return False


def wildcard_pattern(text: str) -> str:
    return "".join(r"[\p{L}\p{N}_-]*" if c == "*" else r"[\p{L}\p{N}_-]" if c == "?" else re.escape(c) for c in text.lower())


#: White space as words are divided by it, and its opposite.
_GAP, _INK = r"[\p{IsWhite_Space}\x1C-\x1F]", r"[^\p{IsWhite_Space}\x1C-\x1F]"


def near_pattern(first: str, options: tuple[str, ...], distance: int) -> str:
    """A pattern that finds first and an option, in either order, if the text from the start of one to the start of the other has at most distance words.

    What a slice cuts off a word counts as a word. Each end of the slice has one division into words and gaps, so nothing is tried twice.
    """
    a, b = re.escape(first.lower()), "(?:" + "|".join(re.escape(o.lower()) for o in options) + ")"
    slice_ = f"{_GAP}*(?:{_INK}+(?:{_GAP}+{_INK}+){{0,{distance - 1}}}{_GAP}*)?" if distance else f"{_GAP}*"
    return f"(?={a}){slice_}(?={b})|(?={b}){slice_}(?={a})"


def term_condition(term: Term, low: Column) -> Column:
    """Whether a text in lower case, not null, holds the term."""
    if term.kind == "near":
        return F.contains(low, F.lit(term.text.lower())) & low.rlike(near_pattern(term.text, term.options, term.distance))
    if term.kind == "wildcard":
        return low.rlike(wildcard_pattern(term.text))
    return F.contains(low, F.lit(term.text.lower()))


def combined(tree: Term | Node, of: Callable[[Term], Column]) -> Column:
    """The tree's condition from those of its terms."""
    if isinstance(tree, Term):
        return of(tree)
    parts = [combined(p, of) for p in tree.parts]
    if tree.op == "not":
        return ~parts[0]
    return reduce(lambda x, y: x & y if tree.op == "and" else x | y, parts)


def terms_of(tree: Term | Node) -> list[Term]:
    return [tree] if isinstance(tree, Term) else [t for p in tree.parts for t in terms_of(p)]


def condition(tree: Term | Node, text: Column) -> Column:
    """Whether a text matches; text is compared in lower case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return combined(tree, lambda t: term_condition(t, low))


def hits(df: DataFrame, queries: Sequence[str], *columns: str) -> DataFrame:
    """place (from 0), query, hits: how many rows match each query. One scan serves all of them, and a term that several share is looked for once.

    Rows leave the scan as the places of the queries they match, counted before they move. Queries without hits have 0.
    """
    spark = df.sparkSession
    trees = [parse(q) for q in queries]
    terms = {t: i for i, t in enumerate(dict.fromkeys(t for tree in trees for t in terms_of(tree)))}
    low = df.select(F.lower(F.concat_ws(" ", *columns)).alias("low"))
    found = low.select(F.array(*[term_condition(t, F.col("low")) for t in terms]).alias("found"))
    met = F.array_compact(F.array(*[F.when(combined(tree, lambda t: F.col("found")[terms[t]]), F.lit(i)) for i, tree in enumerate(trees)]))
    counts = found.select(F.explode(met).alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("hits"))
    asked = spark.createDataFrame(list(enumerate(queries)), "place int, query string")
    return asked.join(counts, "place", "left").select("place", "query", F.coalesce("hits", F.lit(0)).alias("hits"))


def search(df: DataFrame, query: str, *columns: str) -> DataFrame:
    return df.where(condition(parse(query), F.concat_ws(" ", *columns)))


def printed(tree: Term | Node, dialect: str = "boolean") -> str:
    """The query in a remote service's dialect: boolean, scholar, arxiv, semantic or crossref."""
    if isinstance(tree, Node):
        parts = [printed(p, dialect) for p in tree.parts]
        if dialect in ("semantic", "crossref"):
            kept = [p for p in parts if p]
            return {"not": "-" + kept[0] if kept and dialect == "semantic" else ""}.get(tree.op, " ".join(kept))
        if tree.op == "not":
            return f"NOT {parts[0]}"
        return "(" + f" {tree.op.upper()} ".join(parts) + ")"
    bare = tree.text.replace("*", "").replace("?", "")
    if tree.kind == "near":
        if dialect == "boolean":
            return f'"{tree.text}" NEAR/{tree.distance} (' + " OR ".join(f'"{o}"' for o in tree.options) + ")"
        if dialect == "scholar":
            return "(" + " OR ".join(f'"{tree.text} {o}"' for o in tree.options) + ")"
        if dialect == "arxiv":
            return f'("{tree.text}" AND (' + " OR ".join(f'"{o}"' for o in tree.options) + "))"
        return tree.text if dialect == "crossref" else " ".join((tree.text, *tree.options))
    if dialect == "crossref":
        return bare
    if tree.kind == "phrase":
        return f'"{tree.text}"'
    return tree.text if dialect == "boolean" else bare


def for_arxiv(tree: Term | Node, category: str | None = "cs.*") -> str:
    """The query over abstracts and titles in arXiv's dialect, within a category."""
    text = printed(tree, "arxiv")
    both = f"abs:({text}) OR ti:({text})"
    return f"({both}) AND (cat:{category})" if category else both


def vocabulary_matches(vocabulary: DataFrame, column: str, pattern: str) -> DataFrame:
    """Words of a vocabulary that a wildcard term expands to."""
    return vocabulary.where(F.lower(column).rlike(f"^{wildcard_pattern(pattern)}$"))
