"""Versioned tables, batch jobs that resume, and the paged source."""

from __future__ import annotations

import threading

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.sources import pages, store
from tessera.streaming.progress import Job


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_upserts_and_versions(spark, tmp_path):
    table = store.Store(spark, str(tmp_path / "t"), "k long, v string, at long", ["k"], [F.col("at").desc()], buckets=4)
    assert table.read().count() == 0
    put = lambda *rows: table.upsert(spark.createDataFrame(rows, "k long, v string, at long"))
    assert put((1, "a", 1), (2, "b", 1), (None, "n", 1)) == 1
    first = table.log.latest()[1]
    assert put((1, "c", 2), (2, "old", 0), (1, "d", 1)) == 2
    assert rows_of(table.read().where("k IS NOT NULL")) == [(1, "c", 2), (2, "b", 1)]
    assert table.read().count() == 3
    assert rows_of(table.read(first).where("k = 1")) == [(1, "a", 1)]
    assert table.upsert(spark.createDataFrame([], "k long, v string, at long")) == 2


def test_two_writers_both_survive(spark, tmp_path):
    """Each starts from the version that it reads, one loses the race, and still nothing is lost; an unpublished folder isn't seen."""
    path = str(tmp_path / "t")
    make = lambda: store.Store(spark, path, "k long, v long", ["k"], [F.col("v").desc()], buckets=2)
    together = threading.Barrier(2)
    failed = []

    def write(start):
        try:
            once = iter([True])

            def rows(current):
                if next(once, False):
                    together.wait(60)
                return spark.range(start, start + 50).select(F.col("id").alias("k"), F.lit(start).cast("long").alias("v"))

            make().change(rows)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(s,)) for s in (0, 30)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert not failed
    spark.range(5).write.parquet(f"{path}/data-stray/__bucket=0")
    assert make().log.latest()[0] == 2
    assert rows_of(make().read()) == [(k, 30 if k >= 30 else 0) for k in range(80)]
    with pytest.raises(store.Conflict):
        make().log.publish(2, {})


def test_get_or_fetch_checks_hashes_and_counts(spark, tmp_path):
    cache = store.entries(spark, str(tmp_path / "c"))
    now = F.lit("2024-06-01").cast("timestamp")
    asked = []

    def fetch(keys):
        asked.append(sorted(r["paper_id"] for r in keys.collect()))
        return keys.select("paper_id", "content_type", F.concat(F.lit("/f/"), "paper_id").alias("file_path"), F.concat(F.lit("h"), "paper_id").alias("file_hash"), F.lit(3).cast("long").alias("file_size"), now.alias("created_at"))

    wanted = spark.createDataFrame([("a", "pdf"), ("b", "pdf"), ("a", "pdf")], "paper_id string, content_type string")
    files = spark.createDataFrame([], "path string, sha256 string")
    got, counts = store.get_or_fetch(cache, wanted, files, fetch, now)
    assert counts == {"hits": 0, "misses": 2} and got.count() == 2
    files = spark.createDataFrame([("/f/a", "ha"), ("/f/b", "changed")], "path string, sha256 string")
    got, counts = store.get_or_fetch(cache, wanted, files, fetch, now)
    assert counts == {"hits": 1, "misses": 1} and asked == [["a", "b"], ["b"]]
    assert {r["paper_id"]: r["access_count"] for r in cache.read().collect()} == {"a": 1, "b": 0}


def test_jobs_resume_with_each_row_once(spark, tmp_path):
    rows = spark.range(40)

    def process(df):
        if (df["id"] == 13).any():
            raise ValueError("thirteen")
        return df.assign(double=df["id"] * 2)

    class Killed(Exception):
        pass

    def kill(batch):
        if batch == 1:
            raise Killed

    schema = "id long, double long"
    with pytest.raises(Killed):
        Job(spark, str(tmp_path), "j").run(rows, "id", process, schema, 4, kill)
    job = Job(spark, str(tmp_path), "j")
    spark.createDataFrame([(99, 99, None)], "id long, double long, error string").write.parquet(f"{job.log.path}/batch-2-died")  # of a run that died before publishing
    assert sorted(job.done()) == ["0", "1"]
    assert job.run(rows, "id", process, schema, 4) == 2
    assert job.run(rows, "id", process, schema, 4) == 0
    out = job.output(schema).toPandas()
    assert sorted(out["id"].dropna()) == [i for i in range(40) if i != 13]
    assert list(out["error"].dropna()) == ["ValueError: thirteen"]
    assert set(out["batch_id"]) <= {0, 1, 2, 3}
    seen = job.progress().agg(F.sum("n_rows"), F.sum("n_errors"), F.count_if(F.col("status") == "partial")).first()
    assert tuple(seen) == (39, 1, 1)
    assert Job(spark, str(tmp_path), "none").output(schema).count() == 0


def test_filters_reach_the_paged_source(spark, tmp_path):
    data = [("s1" if i % 3 else "s/2", 2000 + i % 5 if i % 11 else None, i, f'{{"n": {i}}}') for i in range(200)]
    path = str(tmp_path / "p")
    pages.save(spark.createDataFrame(data, "source string, year int, ord long, payload string"), path, [F.col("ord")], rows=20)
    every = pages.load(spark, path)
    assert sorted((r["source"], r["year"], r["payload"]) for r in every.collect() if r["year"]) == sorted((s, y, p) for s, y, _, p in data if y)
    assert every.count() == 200 and every.groupBy("page", "source", "year").count().agg(F.max("count")).first()[0] <= 20
    some = every.where("year >= 2003 AND source = 's/2'")
    assert sorted(r["payload"] for r in some.collect()) == sorted(p for s, y, _, p in data if y and y >= 2003 and s == "s/2")
    reader = pages.PageReader(f"file://{path}")
    kept = list(reader.pushFilters([pages.GreaterThanOrEqual(("year",), 2003), pages.EqualTo(("source",), "s/2"), pages.EqualTo(("payload",), "x")]))
    assert [f.attribute for f in kept] == [("payload",)]
    assert 0 < len(reader.partitions()) < len(pages.PageReader(f"file://{path}").partitions()) / 2
    assert some.rdd.getNumPartitions() == len(reader.partitions())
    assert every.where("year = 1900").count() == 0
    assert isinstance(some.toPandas(), pd.DataFrame)
