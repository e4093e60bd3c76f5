"""Text and metadata of PDF files, for files whose text is plain or deflated and in a Latin encoding."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Content streams that are read of a file; most writers put a page into one.
PAGES = 50
_STREAM = re.compile(rb"<<((?:[^<>]|<<.*?>>|<[^<].*?>)*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_SHOWN = re.compile(rb"\[((?:\((?:[^()\\]|\\.)*\)|[^\]()])*)\]\s*TJ|\(((?:[^()\\]|\\.)*)\)\s*(?:Tj|'|\")|(T\*|Td|TD|ET)\b", re.DOTALL)
_PIECE = re.compile(rb"\(((?:[^()\\]|\\.)*)\)|(-?\d+(?:\.\d+)?)", re.DOTALL)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r?\n|.)", re.DOTALL)
_PLAIN = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _unescaped(raw: bytes) -> bytes:
    def one(m: re.Match) -> bytes:
        c = m[1]
        return bytes([int(c, 8) & 255]) if c[:1].isdigit() else b"" if c.endswith(b"\n") else _PLAIN.get(c, c)

    return _ESCAPE.sub(one, raw)


def _text(raw: bytes) -> str:
    value = _unescaped(raw)
    return value[2:].decode("utf-16-be", "replace") if value.startswith(b"\xfe\xff") else value.decode("cp1252", "replace")


def pdf_text(content: bytes, pages: int = PAGES) -> str | None:
    """Shown text, a line per text position, a blank line between content streams; None if the file is no PDF."""
    if not content.startswith(b"%PDF-"):
        return None
    out: list[str] = []
    for m in _STREAM.finditer(content):
        data = m[2]
        if b"FlateDecode" in m[1]:
            try:
                data = zlib.decompressobj().decompress(data)
            except zlib.error:
                continue
        if b"BT" not in data:
            continue
        line, lines = "", []
        for shown in _SHOWN.finditer(data):
            if shown[3]:
                lines.append(line)
                line = ""
            elif shown[2] is not None:
                line += _text(shown[2])
            else:  # a wide step back between pieces is a blank
                line += "".join(_text(p[1]) if p[1] is not None else " " if float(p[2]) < -200 else "" for p in _PIECE.finditer(shown[1]))
        out.append("\n".join(x.strip() for x in [*lines, line] if x.strip()))
        if len(out) == pages:
            break
    return "\n\n".join(x for x in out if x)


def pdf_field(content: bytes, name: str) -> str | None:
    """A field of the document's information, such as Title or Author."""
    m = re.search(rb"/" + name.encode() + rb"\s*\(((?:[^()\\]|\\.)*)\)", content, re.DOTALL)
    return _text(m[1]).strip() or None if m else None


def read_pdfs(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """path, title, author, text of each file."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [c.as_py() or b"" for c in batch.column(1)]
            columns = [[pdf_field(f, "Title") for f in files], [pdf_field(f, "Author") for f in files], [pdf_text(f) for f in files]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in columns]], names=["path", "title", "author", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return files.mapInArrow(run, T.StructType([T.StructField(c, T.StringType()) for c in ("path", "title", "author", "text")]))
