from __future__ import annotations

import json

from pyspark.sql import functions as F

from tessera.sources import records
from tessera.streaming import incremental


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A \"quoted\",\nline", ["x", "y"], 2020), (None, None, None)], "title string, authors array<string>, year int")
    records.write_csv(df, str(tmp_path / "c"))
    rows = records.read_csv(spark, str(tmp_path / "c")).orderBy(F.desc_nulls_last("title")).collect()
    assert (rows[0]["title"], rows[0]["authors"], rows[0]["year"], rows[0]["doi"]) == ('A "quoted",\nline', "x; y", 2020, None)
    assert rows[1]["title"] is None


def test_payloads(spark):
    cross = {"message": {"items": [{"DOI": "10.1/a", "title": ["T"], "author": [{"given": "A", "family": "B"}], "abstract": "<p>x</p>", "published-online": {"date-parts": [[2021, 2]]}, "is-referenced-by-count": 3, "link": [{"URL": "u.pdf", "content-type": "application/pdf"}]}, {}]}}
    rows = records.from_crossref(spark.createDataFrame([(json.dumps(cross),)], "json string")).collect()
    assert (rows[0]["title"], rows[0]["authors"], rows[0]["year"], rows[0]["abstract"], rows[0]["pdf_url"]) == ("T", "A B", 2021, "x", "u.pdf")
    assert rows[1]["year"] == 0
    s2 = {"data": [{"title": "T", "authors": [{"name": "A B"}], "year": 2020, "externalIds": {"ArXiv": "2301.1"}}]}
    row = records.from_semantic_scholar(spark.createDataFrame([(json.dumps(s2),)], "json string")).first()
    assert (row["arxiv_id"], row["pdf_url"]) == ("2301.1", "https://arxiv.org/pdf/2301.1.pdf")


def test_bibtex(spark):
    df = spark.createDataFrame([("Deep {Games} now", "Ann Lee; Bob Ray", 2020, "Journal X", "10.1/a", None, None, "journal")], "title string, authors string, year int, venue string, doi string, url string, abstract string, venue_type string")
    entry = records.bibtex(df).first()["entry"]
    assert entry.startswith("@article{Lee2020DeepGames,\n") and "author = {Ann Lee and Bob Ray}" in entry and r"\{Games\}" in entry and "url" not in entry


def test_html_and_tex(spark):
    df = spark.createDataFrame([("<body><nav>n</nav><article><h1>T</h1><p>x</p></article></body>", "a % c\n\\section{S} \\textbf{b} \\cite{k}")], "h string, t string")
    row = df.select(records.plain_html(F.col("h")).alias("h"), records.clean_tex(F.col("t")).alias("t")).first()
    assert row["h"] == "T\nx"
    assert row["t"] == "\n## S\n\nb [citation]"
    tex = "x\\section{A}\n one \\label{l}\\ref{r} 5\\% % no\n\\begin{table}a\nb\\end{table}\\section*{B}two\\end{document} gone"
    assert spark.createDataFrame([(tex,), ("plain",), (None,)], "t string").select(records.clean_tex(F.col("t"))).collect()[0][0] == "\n## A\n\none [ref] 5\\% \n[table]\n\n## B\n\ntwo"


def test_stream_of_titles_equals_batch_and_resumes(spark, tmp_path):
    schema = spark.createDataFrame([], "ord long, title string").schema
    src, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    spark.createDataFrame([(1, "A b"), (2, "a, B!"), (3, "")], schema).coalesce(1).write.parquet(src)
    incremental.run_to_end(incremental.new_titles(incremental.chunks(spark, src, schema)), out, at)
    spark.createDataFrame([(4, "a b"), (5, "c")], schema).coalesce(1).write.mode("append").parquet(src)
    incremental.run_to_end(incremental.new_titles(incremental.chunks(spark, src, schema)), out, at)
    assert sorted(r["title_key"] for r in spark.read.parquet(out).collect()) == ["a b", "c"]


def test_log_windows_stream(spark, tmp_path):
    schema = spark.createDataFrame([], "timestamp timestamp_ntz, level string, duration double").schema
    src = str(tmp_path / "in")
    spark.sql("SELECT timestamp_ntz'2024-01-01 00:10:00' AS timestamp, 'INFO' AS level, 1.0D AS duration UNION ALL SELECT timestamp_ntz'2024-01-01 00:50:00', 'INFO', 2.0D UNION ALL SELECT timestamp_ntz'2024-01-02 00:00:00', 'INFO', 4.0D").coalesce(1).write.parquet(src)
    incremental.run_to_end(incremental.log_windows(incremental.chunks(spark, src, schema)), str(tmp_path / "out"), str(tmp_path / "at"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["n"], r["total"]) for r in rows] == [(2, 3.0)]


def test_batches_count_once(spark, tmp_path):
    schema = spark.createDataFrame([], "v long").schema
    src = str(tmp_path / "in")
    spark.range(10).select(F.col("id").alias("v")).repartition(3).write.parquet(src)
    incremental.batches(incremental.chunks(spark, src, schema), lambda df: df.withColumn("w", F.col("v") * 2), str(tmp_path / "out"), str(tmp_path / "at"))
    assert sorted(r["w"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(0, 20, 2))
