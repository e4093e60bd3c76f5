"""Tables that change: versions in a shared folder, published one after the other, each whole or not at all.

``log/<version>.json`` says which data folders make up a version. A writer puts its data down first and then publishes the next version,
which fails if another writer has it already; then it starts again from what that one published. Readers take
the newest version and never see data that isn't in one. Rows are dealt into buckets by key, and an upsert writes
anew only the buckets that its rows fall into.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import caching
from tessera.storage import written

RETRIES = 20


class Conflict(RuntimeError):
    """The version is published already."""


class Log:
    """Numbered JSON documents in a folder; a number is published once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm  # noqa: SLF001
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        self._fs.mkdirs(self._path("log"))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict | None]:
        """The newest version and what it says; 0 and None before the first."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path("log"))]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        last = max(numbers, default=0)
        return last, json.loads(self._text(f"log/{last:012d}.json")) if last else None

    def publish(self, number: int, said: dict) -> None:
        """Raises Conflict if another writer has published the number.

        The document is complete before it gets its name: by a hard link where the folder is local or mounted, elsewhere by a rename, which
        distributed file systems refuse where the name is taken.
        """
        draft, final = self._path(f"log/{uuid.uuid4().hex}.draft"), self._path(f"log/{number:012d}.json")
        stream = self._fs.create(draft, False)
        stream.write(json.dumps(said).encode())
        stream.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                at = lambda p: self._jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.String, 0))  # noqa: E731, SLF001
                try:
                    self._jvm.java.nio.file.Files.createLink(at(final), at(draft))
                except Exception as e:
                    if "FileAlreadyExists" in str(e):
                        raise Conflict(number) from e
                    raise
            elif self._fs.exists(final) or not self._fs.rename(draft, final):
                raise Conflict(number)
        finally:
            self._fs.delete(draft, False)

    def forget(self, folder: str) -> None:
        """Delete a data folder that no version names."""
        self._fs.delete(self._path(folder), True)


class Store:
    """A table with a key. schema: of its rows; key: column names; order: which row of a key stays, new before old where it ties."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], order: Sequence[Column] = (), buckets: int = 16) -> None:
        self.spark, self.key, self.order, self.buckets = spark, list(key), list(order), buckets
        self.schema = T.StructType.fromDDL(schema)
        self.log = Log(spark, path)

    def read(self, version: dict | None = None) -> DataFrame:
        """The newest version, or one that was given."""
        return self._of((version or self.log.latest()[1] or {}).get("buckets", {}).values())

    def _of(self, folders) -> DataFrame:
        paths = [f"{self.log.path}/{f}" for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame) -> int:
        """Put rows in; the version that has them. Writers that lose a race read the winner's version and try again, so that both survive."""
        return self.change(lambda _: rows)

    def change(self, rows_of: Callable[[DataFrame], DataFrame]) -> int:
        """Upsert what rows_of makes of the newest version, made again from a newer one if another writer is faster."""
        for _ in range(RETRIES):
            number, said = self.log.latest()
            rows = written(rows_of(self.read(said)).select(*self.schema.names), "store-rows").withColumn("__bucket", self._bucket())
            touched = sorted(r["__bucket"] for r in rows.select("__bucket").distinct().collect())  # at most one row per bucket
            if not touched:
                return number
            kept = dict((said or {}).get("buckets", {}))
            old = self._of([kept[str(b)] for b in touched if str(b) in kept]).withColumn("__bucket", self._bucket())
            merged = caching.upserted(old, rows, self.key, self.order)
            folder = f"data-{uuid.uuid4().hex}"
            merged.write.partitionBy("__bucket").parquet(f"{self.log.path}/{folder}")
            try:
                self.log.publish(number + 1, {"buckets": kept | {str(b): f"{folder}/__bucket={b}" for b in touched}})
            except Conflict:
                self.log.forget(folder)
                continue
            return number + 1
        raise Conflict(f"{RETRIES} times another writer was faster")


ENTRIES = "paper_id string, content_type string, file_path string, file_hash string, file_size long, created_at timestamp, access_count long"


def entries(spark: SparkSession, path: str) -> Store:
    """A store of cache entries: the newest of a key, and of one entry the count that is furthest."""
    return Store(spark, path, ENTRIES, ["paper_id", "content_type"], [F.col("created_at").desc(), F.col("access_count").desc()])


def get_or_fetch(store: Store, wanted: DataFrame, files: DataFrame, fetch: Callable[[DataFrame], DataFrame], now: Column, days: int = 90) -> tuple[DataFrame, dict[str, int]]:
    """The entries of wanted (paper_id, content_type), and how many were hits and misses.

    An entry is valid if it is young enough and its file is there with the hash on record; it is counted once more. Others are fetched (rows
    of wanted -> entries), each key once. If another writer has stored a key meanwhile, its entry is taken and the fetched one isn't stored.
    """
    keys = store.key
    asked = written(wanted.select(*keys).distinct(), "cache-asked")
    seen = store.read()
    found = written(caching.valid(seen, files, days, now).select(*keys), "cache-found")
    fetched = written(fetch(asked.join(found, keys, "left_anti")).withColumn("access_count", F.lit(0).cast("long")), "cache-fetched")

    def counted(current: DataFrame) -> DataFrame:
        others = current.join(seen.select(*keys, "file_hash", "created_at"), [*keys, "file_hash", "created_at"], "left_anti")
        good = caching.valid(current, files, days, now).unionByName(others).join(asked, keys, "left_semi").dropDuplicates(keys)
        hits = good.withColumn("access_count", F.col("access_count") + 1)
        return hits.unionByName(fetched.join(good.select(*keys), keys, "left_anti").select(*hits.columns))

    store.change(counted)
    misses = fetched.count()
    return store.read().join(asked, keys, "left_semi"), {"hits": asked.count() - misses, "misses": misses}
