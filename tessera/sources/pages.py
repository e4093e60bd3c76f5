"""Saved pages of paged services as a Spark source: a partition a page, and filters on year, source and page decide which pages are read.

``spark.read.format("saved_pages").option("path", ...)`` gives source, year, page, payload. A page is a file of JSON texts, one a line, under
source=.../year=.../page=...; save() lays pages out so. Paths are opened with pyarrow's file systems (file, hdfs, s3, gs).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tessera.operators.ordering import numbered

PUSH_DOWN = "spark.sql.python.filterPushdown.enabled"
#: What a filter says of a column's value.
TESTS = {
    EqualTo: lambda have, want: have == want,
    In: lambda have, want: have in want,
    GreaterThan: lambda have, want: have > want,
    GreaterThanOrEqual: lambda have, want: have >= want,
    LessThan: lambda have, want: have < want,
    LessThanOrEqual: lambda have, want: have <= want,
}


@dataclass
class Page(InputPartition):
    file: str
    source: str
    year: int | None
    page: int


class SavedPages(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return "source string, year int, page long, payload string"

    def reader(self, schema: object) -> PageReader:
        return PageReader(self.options["path"])


class PageReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path
        self.pushed: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of a page's own columns with values; others stay with Spark."""
        for f in filters:
            if type(f) in TESTS and len(f.attribute) == 1 and f.attribute[0] in ("source", "year", "page"):
                self.pushed.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Page]:
        """A partition for each page whose columns pass the filters; a null year passes none."""
        at, root = pafs.FileSystem.from_uri(self.path)
        out = []
        for info in at.get_file_info(pafs.FileSelector(root, recursive=True)):
            own = dict(x.split("=", 1) for x in info.path[len(root) :].split("/") if "=" in x)
            if info.type != pafs.FileType.File or info.base_name.startswith(("_", ".")) or own.keys() < {"source", "year", "page"}:
                continue
            page = Page(info.path, unquote(own["source"]), None if own["year"].startswith("__") else int(own["year"]), int(own["page"]))
            if all(getattr(page, c) is not None and TESTS[kind](getattr(page, c), value) for c, kind, value in self.pushed):
                out.append(page)
        return sorted(out, key=lambda p: (p.page, p.file)) or [Page("", "", None, 0)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        at, _ = pafs.FileSystem.from_uri(self.path)
        with at.open_input_stream(partition.file) as stream:
            lines = [line.decode() for line in stream.read().split(b"\n") if line]
        n = len(lines)
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
        columns = ([partition.source] * n, [partition.year] * n, [partition.page] * n, lines)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["source", "year", "page", "payload"])


def save(records: DataFrame, path: str, order: list[Column], rows: int = 100) -> None:
    """Lay records (source, year, payload: JSON text) out as pages of at most rows records of one source and year, in the order given.

    Records are numbered over all of them, so no source is one task's; a page ends where its source or year does.
    """
    placed = numbered(records, [F.col("source"), F.col("year"), *order], "place")
    paged = placed.withColumn("page", F.floor((F.col("place") - 1) / rows)).repartitionByRange("page", "source", "year").sortWithinPartitions("place")
    paged.select("source", "year", "page", F.col("payload").alias("value")).write.partitionBy("source", "year", "page").text(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The saved pages as a DataFrame whose filters reach the source."""
    spark.conf.set(PUSH_DOWN, "true")
    spark.dataSource.register(SavedPages)
    return spark.read.format("saved_pages").option("path", path if ":/" in path else f"file://{path}").load()
