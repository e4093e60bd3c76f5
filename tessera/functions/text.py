"""Keys and clean forms of titles, identifiers, authors and URLs, as built-in expressions.

Empty strings stand for missing values in the keys, as the records have them on disk. Letter classes are
spelled out, since Java's short ones cover ASCII only.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that a title key leaves out.
STOP_WORDS = ("a", "an", "the", "of", "in", "on", "at", "to", "for", "with", "and", "or")
# Honorifics that author names lose.
HONORIFICS = ("Dr", "Prof", "Professor", "Mr", "Mrs", "Ms", "PhD", r"Ph\.D")

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: White space as text cleaning sees it, beyond ASCII too.
SPACE = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"


def blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def fold_accents(x: Column) -> Column:
    """Lower-case Latin letters without their marks; exact for the letters of ACCENTED."""
    return F.translate(x, ACCENTED, PLAIN)


@F.pandas_udf(T.StringType())
def fold_accents_exact(x: pd.Series) -> pd.Series:
    """Any script: compatibility decomposition without combining marks."""
    strip = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return x.map(strip, na_action="ignore")


def title_key(title: Column, exact: bool = False) -> Column:
    """Lower case, without marks and punctuation, single spaces, no stop words."""
    low = F.lower(blank(title))
    folded = fold_accents_exact(low) if exact else fold_accents(low)
    words = F.split(F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}_]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*STOP_WORDS)), " ")


def light_title_key(title: Column) -> Column:
    """Lower case, punctuation as single spaces."""
    return F.trim(F.regexp_replace(F.lower(blank(title)), r"[^\p{L}\p{N}_]+", " "))


def doi_key(doi: Column) -> Column:
    """Lower case without resolver or scheme; empty unless it begins with ``10.``."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(blank(doi))), r"^https?://(dx\.)?doi\.org/", ""), "^doi:", "")
    return F.when(bare.startswith("10."), bare).otherwise("")


def author_names(authors: Column, display: bool = False) -> Column:
    """Names of a ``;`` list without honorifics. For display, the dot that an honorific leaves behind goes too."""
    word = "|".join(HONORIFICS)
    pattern = rf"\b({word})\b\.?\s*" if display else rf"\b({word})\b"
    names = F.transform(F.split(blank(authors), ";"), lambda a: F.trim(F.regexp_replace(F.regexp_replace(F.trim(a), pattern, ""), r"\s+", " ")))
    return F.array_join(F.filter(names, lambda a: a != ""), "; ")


def url_key(url: Column) -> Column:
    """Scheme in lower case, ://, host and path, without the last segment's parameters, query, fragment and closing slashes.

    A text without a scheme is a path: ``a/b`` becomes ``://a/b``. Empty texts stay empty.
    """
    bare = F.regexp_replace(blank(url), r"(?s)[?#].*$", "")
    scheme = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    rest = F.when(scheme != "", F.substr(bare, F.length(scheme) + 2)).otherwise(bare)
    place = F.regexp_replace(F.regexp_replace(rest, r"^//", ""), r";[^/]*$", "")
    return F.when(blank(url) == "", "").otherwise(F.regexp_replace(F.concat(F.lower(scheme), F.lit("://"), place), "/+$", ""))


def clean_text(x: Column) -> Column:
    """Single spaces, no unprintable characters, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(blank(x), SPACE, " "), r"[\p{Cc}\p{Cf}\p{Co}\p{Cs}\p{Cn}]", ""))


def year_or_zero(x: Column) -> Column:
    return F.coalesce(x.try_cast("double"), F.lit(0.0)).cast("int")


def title_slug(title: Column) -> Column:
    """The first 50 ASCII letters and digits of the title's key."""
    return F.substring(F.regexp_replace(title_key(title), "[^a-z0-9]", ""), 1, 50)


def content_hash(title: Column, authors: Column, year: Column) -> Column:
    return F.sha2(F.concat(title_key(title), F.lit("|"), author_names(authors), F.lit("|"), blank(year.cast("string"))), 256)


def info_score(abstract: Column, authors: Column, citations: Column) -> Column:
    """How much a record tells: lengths of abstract and authors, and 100 if it is cited."""
    return F.length(blank(abstract)) + F.length(blank(authors)) + F.when(F.coalesce(citations, F.lit(0)) > 0, 100).otherwise(0)


def first_doi(x: Column) -> Column:
    return F.nullif(F.regexp_extract(blank(x), r"10\.[0-9]{4,}/[-._;()/:A-Za-z0-9]+", 0), F.lit(""))


def plain_dashes(x: Column) -> Column:
    return F.translate(x, "‑‒–—", "----")


def paper_id(doi: Column, arxiv_id: Column, title: Column, authors: Column, year: Column) -> Column:
    first = F.trim(F.element_at(F.split(blank(authors), ";"), 1))
    made = F.substring(F.md5(F.concat(blank(title), F.lit(":"), first, F.lit(":"), blank(year.cast("string")))), 1, 16)
    return F.coalesce(F.nullif(doi, F.lit("")), F.concat(F.lit("arxiv:"), F.nullif(arxiv_id, F.lit(""))), made)


def file_name(authors: Column, year: Column, title: Column) -> Column:
    """Last name of the first author, year and three title words, at most 100 characters."""
    first = F.trim(F.element_at(F.split(blank(authors), ";"), 1))
    last = F.regexp_replace(F.element_at(F.split(first, " "), -1), "[^A-Za-z0-9]", "")
    words = F.transform(F.slice(F.filter(F.split(blank(title), r"\s+"), lambda w: w != ""), 1, 3), lambda w: F.regexp_replace(w, "[^A-Za-z0-9]", ""))
    return F.concat(F.substring(F.concat_ws("_", last, blank(year.cast("string")), F.array_join(words, "_")), 1, 96), F.lit(".pdf"))


def arxiv_parts(arxiv_id: Column) -> tuple[Column, Column]:
    """Identifier and version; the version is null where none is given."""
    return F.regexp_replace(arxiv_id, r"v[0-9]+$", ""), F.nullif(F.regexp_extract(arxiv_id, r"v([0-9]+)$", 1), F.lit("")).try_cast("int")


def cache_key(x: Column) -> Column:
    return F.regexp_replace(x, "[^A-Za-z0-9_-]", "_")


def shortened(x: Column, n: int) -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def context(x: Column, most: int = 30_000, mark: str = "\n\n[... omitted ...]\n\n") -> Column:
    """A long text as its first and last half of most characters."""
    half = most // 2
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, half), F.lit(mark), F.substr(x, F.length(x) - half + 1))).otherwise(x)
