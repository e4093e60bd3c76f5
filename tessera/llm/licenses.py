"""License scans with a positional index of rare words.

Templates are licence names and notices as word sequences, each with mandatory key phrases. Document
frequencies of the templates' words are counted over all documents. Each template is indexed under its
ANCHORS words of highest IDF (a name under one), with their positions. A file's words are looked up by falling
IDF; an anchor found at position p puts the template's start near p minus the anchor's position. There the
postings of the template's words in the file are intersected by relative position: in the template's order,
each word at most SLACK words off the place that the start gives it, so that words put in or left out don't
break the match. A template that keeps enough of its words' IDF is verified by its key phrases, word by word,
and labels the file. A name's only key phrase is the whole name, so that names are found exactly, whatever the
frequencies.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, read

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further names in their usual spellings and their labels, which stand word by word wherever they occur.
NAMES = {
    "academic free license": "afl",
    "apache 2 0": "apache",
    "artistic license": "artistic",
    "boost software license": "bsl-1.0",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0 1 0 universal": "cc0",
    "common development and distribution license": "cddl",
    "creative commons attribution 2 5 generic": "cc-by",
    "creative commons attribution 3 0 unported": "cc-by",
    "creative commons attribution 4 0 international": "cc-by",
    "creative commons attribution license": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noderivs": "cc-by-nd",
    "creative commons attribution sharealike": "cc-by-sa",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "gnu affero general public license": "agpl",
    "gnu gpl": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu lgpl": "lgpl",
    "gnu library general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "open database license": "odbl",
    "python software foundation license": "psf",
    "sil open font license": "ofl",
    "zlib license": "zlib",
}
# Identifiers in SPDX tags as words, and their labels.
TAGS = {
    "agpl 3 0": "agpl", "apache 2 0": "apache", "artistic 2 0": "artistic", "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "bsl 1 0": "bsl-1.0", "cc by 4 0": "cc-by", "cc by nc 4 0": "cc-by-nc", "cc by nd 4 0": "cc-by-nd",
    "cc by sa 4 0": "cc-by-sa", "cc0 1 0": "cc0", "cddl 1 0": "cddl", "epl 2 0": "epl", "eupl 1 2": "eupl", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "isc": "isc", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "mit": "mit", "mpl 2 0": "mpl",
    "odbl 1 0": "odbl", "ofl 1 1": "ofl", "unlicense": "unlicense", "wtfpl": "wtfpl", "zlib": "zlib",
}
NAMES |= {f"spdx license identifier {tag}": label for tag, label in TAGS.items()}
#: Notices by label: the text, then phrases of it that must occur word by word.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ("shall be included in all copies or substantial portions of the software",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify", "with or without fee is hereby granted")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("may be used to endorse or promote products derived from this software",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("in no event will the authors be held liable",)),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("you may not use this file except in compliance with the license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("you can redistribute it and or modify it under the terms of the gnu general public license",)),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", ("any person or organization obtaining a copy of the software",)),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike international license", ("creative commons attribution sharealike",)),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial international license", ("creative commons attribution noncommercial",)),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain", ("dedicated the work to the public domain",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", ("changing it is allowed as long as the name is changed",)),
)
#: Share of a notice's IDF that must be found at the right relative positions.
OVERLAP = 0.7
#: Words of highest IDF under which a notice is indexed, and how many words its others may be off their places.
ANCHORS, SLACK = 3, 6
#: Bytes of words after lower-casing A-Z; all bytes of characters beyond ASCII count as word bytes.
_WORD = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]
    base: bool


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, letters and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_WORD).split()


def templates(base: dict[str, str] = BASE, notices: tuple = NOTICES, names: dict[str, str] = NAMES) -> list[Template]:
    cut = lambda phrase: tuple(words_of(phrase))
    exact = [Template(label, cut(p), (cut(p),), own is base) for own in (base, names) for p, label in own.items()]
    return exact + [Template(label, cut(t), tuple(map(cut, keys)), False) for label, t, keys in notices]


class Index:
    """Templates under their rarest words, with relative positions."""

    def __init__(self, known: list[Template], frequency: dict[bytes, int], n_docs: int) -> None:
        self.idf = {w: math.log((n_docs + 1) / (frequency.get(w, 0) + 1)) + 1e-3 for t in known for w in t.words}
        self.anchors: dict[bytes, list[tuple[Template, int]]] = {}
        for t in known:
            rare = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[: 1 if t.words in t.keys else ANCHORS]
            for place, word in enumerate(t.words):
                if word in rare:
                    self.anchors.setdefault(word, []).append((t, place))

    def find(self, words: list[bytes]) -> list[tuple[int, float, Template]]:
        """(start, share of IDF found, template) of each verified template, by start. A notice that several anchors find is found once."""
        places: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.anchors:
                places.setdefault(w, []).append(i)
        out: dict[tuple[int, Template], float] = {}
        taken: dict[Template, list[int]] = {}
        tried: set[tuple[int, Template]] = set()
        for w in sorted(places, key=lambda w: (-self.idf[w], w)):
            for p in places[w]:
                for t, place in self.anchors[w]:
                    start = p - place
                    if (start, t) in tried:
                        continue
                    tried.add((start, t))
                    if t.words in t.keys:
                        if start >= 0 and tuple(words[start : start + len(t.words)]) == t.words:
                            out[start, t] = 1.0
                    elif (met := self._aligned(words, start, t)) is not None:
                        first, share = met
                        if all(abs(first - other) > SLACK + ANCHORS for other in taken.get(t, ())):
                            taken.setdefault(t, []).append(first)
                            out[first, t] = share
        return sorted(((start, share, t) for (start, t), share in out.items()), key=lambda x: (x[0], x[2].label, x[2].words))

    def _aligned(self, words: list[bytes], start: int, t: Template) -> tuple[int, float] | None:
        """Where the notice's first word that is met stands, and the greatest share of IDF that an alignment in order keeps."""
        lo, hi = max(0, start - SLACK), min(len(words), start + len(t.words) + SLACK)
        near = words[lo:hi]
        postings: dict[bytes, list[int]] = {}
        for i, w in enumerate(near):
            postings.setdefault(w, []).append(lo + i)
        whole = sum(self.idf[w] for w in t.words)
        if sum(self.idf[w] for w in t.words if w in postings) < OVERLAP * whole:
            return None
        best = [(0.0, hi)] * (len(near) + 1)  # by the last place that is used: IDF met, and the first place
        for k, w in enumerate(t.words):
            for p in reversed(postings.get(w, ())):
                if abs(p - start - k) <= SLACK:
                    met, first = max(best[: p - lo + 1], key=lambda x: (x[0], -x[1]))
                    best[p - lo + 1] = max(best[p - lo + 1], (met + self.idf[w], min(first, p)), key=lambda x: (x[0], -x[1]))
        met, first = max(best, key=lambda x: (x[0], -x[1]))
        around = words[max(0, lo - len(t.words)) : hi + len(t.words)]
        return (first, min(1.0, met / whole)) if met >= OVERLAP * whole and all(_occurs(key, around) for key in t.keys) else None


def _occurs(phrase: tuple[bytes, ...], words: list[bytes]) -> bool:
    n = len(phrase)
    return any(w == phrase[0] and tuple(words[i : i + n]) == phrase for i, w in enumerate(words))


def frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many documents each word of the vocabulary occurs, and how many documents there are."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                found.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([b"", *found], pa.binary()), pa.array([n, *found.values()], pa.int64())], names=["word", "n"])

    rows = arrow_map(docs.select(text_col), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row per word of the vocabulary
    got = {bytes(r["word"]): r["n"] for r in rows}
    return got, got.pop(b"", 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[Template] | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, matches: array of (start, n_words, label, base, share).

    start counts words from 0; matches come by start, then label; share is the part of the template's
    IDF that stands at the right places. Null and empty texts have no words and no matches. Whole texts
    are read, of any length; repeated rows repeat their matches, and no rows give no rows. Other columns are not read.
    """
    known = known or templates()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    index = Index(known, *frequencies(rows, {w for t in known for w in t.words}))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("base", pa.bool_()), ("share", pa.float64())]))
        for batch in batches:
            n, matches = [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                n.append(len(words))
                matches.append([{"start": s, "n_words": len(t.words), "label": t.label, "base": t.base, "share": x} for s, x, t in index.find(words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(matches, kind)], names=["doc_id", "n_words", "matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, n_words long, matches array<struct<start: long, n_words: long, label: string, base: boolean, share: double>>")


def summary(scanned: DataFrame) -> DataFrame:
    """The digest columns: n_base, first_word, last_word, base_labels, labels, score (the best share, 0 without a match)."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"), F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan(read(spark, sf_dir, "documents").select("doc_id", "text")))
