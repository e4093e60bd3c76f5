from __future__ import annotations

import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import caching, dedup, extraction, planning, search, statistics
from tessera.sources import exports, harvest, pdf, records, workbook
from tessera.streaming import incremental

FEED = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2301.00234v2</id><published>2023-01-05T10:00:00Z</published><title>A  war
 game</title><summary> Text. </summary><author><name>Ann Lee</name></author><author><name>Bo Ray</name></author><category term="cs.AI"/><category term="cs.CL"/>
<arxiv:doi xmlns:arxiv="http://arxiv.org/schemas/atom">10.1/x</arxiv:doi><arxiv:journal_ref xmlns:arxiv="http://arxiv.org/schemas/atom">J 1</arxiv:journal_ref><link href="http://arxiv.org/abs/2301.00234v2" rel="alternate"/><link title="pdf" href="http://arxiv.org/pdf/2301.00234v2" rel="related"/></entry>
<entry><id>http://arxiv.org/abs/1</id><title></title></entry></feed>"""


def test_arxiv_feed(spark):
    rows = harvest.from_arxiv(spark.createDataFrame([(FEED,), ("<feed></feed>",), (None,)], "xml string")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["title"], r["authors"], r["year"], r["abstract"], r["arxiv_id"], r["venue"], r["keywords"], r["doi"]) == ("A war game", "Ann Lee; Bo Ray", 2023, "Text.", "2301.00234v2", "J 1", "cs.AI; cs.CL", "10.1/x")
    assert r["pdf_url"] == "http://arxiv.org/pdf/2301.00234v2.pdf" and str(r["published"]) == "2023-01-05"


def test_scholar_results(spark):
    saved = [
        {"bib": {"title": "T", "author": "Ann Lee and Bo Ray", "pub_year": "2021", "abstract": "see 10.1234/ab.c", "venue": "V"}, "pub_url": "u", "eprint_url": "https://arxiv.org/abs/2301.00234", "num_citations": 3},
        {"bib": {"title": "U", "author": ["A", "B"], "pub_year": "n/a"}, "description": "d", "eprint_url": "e"}, {"bib": {"title": ""}}, {},
    ]
    got = harvest.from_scholar(spark.createDataFrame([(json.dumps(s),) for s in saved], "json string")).orderBy("title").collect()
    assert [(r["title"], r["authors"], r["year"], r["doi"], r["arxiv_id"], r["url"], r["citations"], r["abstract"]) for r in got] == [
        ("T", "Ann Lee; Bo Ray", 2021, "10.1234/ab.c", "2301.00234", "u", 3, "see 10.1234/ab.c"), ("U", "A; B", 0, None, None, "e", 0, "d"),
    ]


def test_pages_end_at_a_short_one_the_total_or_the_cap():
    asked = []

    def fetch(n):
        def one(at, rows):
            asked.append((at, rows))
            return range(at, min(n, at + rows))

        return one

    assert list(harvest.paged(fetch(25), 100, 10)) == list(range(25)) and asked == [(0, 10), (10, 10), (20, 10)]
    asked.clear()
    assert list(harvest.paged(fetch(20), 100, 10, total=20)) == list(range(20)) and len(asked) == 2
    assert list(harvest.paged(fetch(99), 15, 10)) == list(range(15))


def _records(spark, *rows):
    return spark.createDataFrame([(t, y, c) for t, y, c in rows], "title string, year int, citations long")


def test_a_failing_source_costs_only_its_own_records(spark):
    sources = {
        "a": lambda q, n: _records(spark, ("x", 2020, 1), ("y", 2022, None), ("z", None, 5)), "late": lambda q, n: _records(spark, ("1", 1, 1)).select(F.raise_error(F.lit("while reading")).cast("string").alias("title")),
        "gone": lambda q, n: 1 / 0, "google_scholar": lambda q, n: _records(spark, (q, 2021, n)),
    }
    out, failed = harvest.fan_out(spark, sources, "q", 10)
    assert [r["title"] for r in out.collect()] == ["y", "q", "x", "z"]
    assert set(failed) == {"late", "gone"} and "ZeroDivisionError" in failed["gone"]
    capped, _ = harvest.fan_out(spark, {"a": sources["a"]}, "q", 2)
    assert capped.count() == 2
    more, _ = harvest.with_secondary(spark, {"a": sources["a"], "google_scholar": sources["google_scholar"]}, "q", ["x site:org", "other"], 10)
    assert sorted((r["title"], r["citations"]) for r in more.where("source_db = 'google_scholar'").collect()) == [("other", 5), ("q", 10), ("x site:org", 10)]
    assert harvest.fan_out(spark, {}, "q")[0].count() == 0


def test_retries_wait_longer_and_longer_and_only_where_it_helps():
    waits = []

    def failing(times, message):
        left = [times]

        def call():
            if left[0]:
                left[0] -= 1
                raise OSError(message)
            return "done"

        return call

    assert harvest.retried(failing(3, "429"), sleep=waits.append)() == "done" and waits == [1, 2, 4]
    with pytest.raises(OSError, match="no such"):
        harvest.retried(failing(1, "no such file"), sleep=waits.append)()
    with pytest.raises(OSError, match="timed out"):
        harvest.retried(failing(9, "timed out"), sleep=waits.append, base=10.0, longest=50.0)()
    assert waits[3:] == [1, 10, 50, 50, 50]


def test_a_session_goes_on_where_it_ended(spark, tmp_path):
    asked = []

    def run(query, quota):
        asked.append(query)
        if query == "bad" and asked.count("bad") == 1:
            raise OSError
        return _records(spark, *[(f"{query}{i}", 2020, i) for i in range(4)])

    args = (["a", "bad", "c"], 10, str(tmp_path), "s1")
    with pytest.raises(OSError):
        harvest.session_harvest(spark, "x", run, *args)
    got = harvest.session_harvest(spark, "x", run, *args)
    assert got.count() == 10 and asked == ["a", "bad", "bad", "c"]


def test_fetching(spark):
    answers = {"u1": (200, "application/pdf", b"%PDF-1"), "u2": (200, "text/html", b""), "u3": (404, "application/pdf", b""), "u4": (200, "application/pdf", b"x" * 99)}
    df = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, "u4"), (5, None), (6, "boom")], "i long, url string")
    got = {r["i"]: (r["fetch_status"], r["content"]) for r in harvest.fetched(df, "url", answers.__getitem__, most_bytes=50).collect()}
    assert {i: s for i, (s, _) in got.items()} == {1: "downloaded", 2: "wrong_type", 3: "failed", 4: "too_large", 5: "no_url", 6: "failed"}
    assert bytes(got[1][1]) == b"%PDF-1" and got[4][1] is None
    urls = spark.createDataFrame([("2301.1v2",), ("2301.1",)], "a string").select(harvest.version_urls(F.col("a"), 1)).collect()
    assert [[u.rsplit("/", 1)[1] for u in r[0]] for r in urls] == [["2301.1v2.pdf", "2301.1v1.pdf", "2301.1.pdf"], ["2301.1v1.pdf", "2301.1.pdf"]]
    saved = [{"doi": "1", "best_oa_location": {"url_for_pdf": "b"}}, {"doi": "2", "best_oa_location": {"url_for_pdf": None}, "oa_locations": [{"url_for_pdf": None}, {"url_for_pdf": "c"}]}, {"doi": "3"}]
    assert {r["doi"]: r["pdf_url"] for r in harvest.from_unpaywall(spark.createDataFrame([(json.dumps(s),) for s in saved], "json string")).collect()} == {"1": "b", "2": "c", "3": None}
    kinds = spark.createDataFrame([(b"% x\n\\documentclass{a}", 200, "text/html; x"), (b" " * 1000 + b"\\section", 200, "application/pdf")], "c binary, s int, t string").select(harvest.is_tex(F.col("c")), harvest.is_html(F.col("s"), F.col("t"))).collect()
    assert [tuple(r) for r in kinds] == [(True, True), (False, False)]


def test_sqlite_files_and_configuration(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER, name TEXT, v REAL)")
        db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, None if i == 3 else f"n{i}", i / 2) for i in range(50)])
        db.execute("CREATE TABLE none (id INTEGER)")
    df = harvest.read_sqlite(spark, path, "t", 4)
    assert df.schema.simpleString() == "struct<id:bigint,name:string,v:double>" and df.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, df.collect()))[3] == (3, None, 1.5) and df.count() == 50
    assert harvest.read_sqlite(spark, path, "none").count() == 0
    (tmp_path / "f").mkdir()
    for i, name in enumerate(("a.csv", "b.csv", "c.txt")):
        (tmp_path / "f" / name).write_text("x")
        import os

        os.utime(tmp_path / "f" / name, (1000 + i, 1000 + i))
    assert harvest.latest_file(spark, str(tmp_path / "f"), "*.csv").endswith("b.csv")
    assert harvest.latest_file(spark, str(tmp_path / "f"), "*.no") is None
    (tmp_path / "c.json").write_text('{"a": "${HERE}/x", "b": ["${NOT}", 1]}')
    config = harvest.read_config(str(tmp_path / "c.json"), {"HERE": "/r"})
    assert config == {"a": "/r/x", "b": ["${NOT}", 1]} and len(harvest.config_hash(config)) == 8
    assert [harvest.model_string(p, m) for p, m in (("openai", "m"), ("google", "m"), ("together", "together_ai/m"), ("anthropic", "m"), ("anthropic", "claude-x"))] == ["m", "vertex_ai/m", "together_ai/m", "claude-3-sonnet-20240229", "claude-x"]
    assert harvest.fallback_model("nobody") == harvest.fallback_model("openai")


def test_planning(spark):
    assert planning.vocabulary(["LLM", "gpt"], ["llm", "Bert"]) == ["LLM", "gpt", "Bert"]
    assert planning.group(["a b", "c-d", "e"]) == '"a b" OR "c-d" OR e'
    base = planning.base_query(["wargame", "war game"], ["llm*"], excluded=["chess", 'red NEAR/3 ("x" OR "y")'])
    assert base == '("wargame" OR "war game") AND (llm*) NOT "chess" NOT "red" NEAR/3 ("x" OR "y")'
    search.parse(base)
    assert planning.distinct_queries(["A  b", "a b", "c"]) == ["A  b", "c"] and planning.distinct_queries(["A", "a"], folded=False) == ["A", "a"]
    assert planning.best(["core", "a", "b", "c"], {"c": 2.0, "b": 2.0, "core": 9.0}, 3) == ["core", "b", "c"]
    assert len(planning.experimental_queries()) == 19
    assert [len(x) for x in planning.expanded(["WARGAMING", "x"], [], ["y"])] == [39, 47, 37]
    assert len(planning.source_queries("google_scholar", [], [])) == 8 + 28
    for source, n in (("arxiv", 12), ("semantic_scholar", 17), ("crossref", 14), ("google_scholar", 3), ("else", 0)):
        assert len(planning.source_queries(source, ["g"], ["m"], combinations=[("x", "y")], authors=["A"], concepts=["c", "d"])) == n
    assert planning.generated("arxiv", ["g"], ["m"], ["a"], most=3)[0] == "((g) AND (m)) OR ((g) AND (a))"
    assert planning.production_queries("arxiv", "q")[:2] == ["q", "(q) AND cat:cs.AI"] and planning.production_queries("crossref", "q") == ["q"]
    assert planning.from_templates([{"template": "x ({exclusion_terms})  {llm_terms}", "description": "d"}], ["a b", "c"], ["m"]) == [{"description": "d", "query": 'x ("a b" OR c) m'}]
    runs = spark.createDataFrame([("s", "q1", 10, 0.5), ("s", "q1", 20, None), ("t", "q1", 99, 1.0)], "source string, query_text string, papers_found long, relevance double")
    assert planning.history_of(runs, "s", ["q1", "q2"]) == pytest.approx({"q1": 0.6 * 15 + 0.3 * 0.5 + 0.2})


def test_caches(spark):
    now = F.lit("2024-06-30").cast("timestamp")
    entries = spark.sql("""SELECT * FROM VALUES ('p1', 'pdf', 'a', 'h1', timestamp'2024-06-01', 3), ('p1', 'html', 'b', 'h2', timestamp'2023-01-01', 0), ('p2', 'pdf', 'c', 'h3', timestamp'2024-06-20', CAST(NULL AS INT))
      t(paper_id, content_type, file_path, file_hash, created_at, access_count)""")
    files = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "other")], "path string, sha256 string")
    assert [r["file_path"] for r in caching.valid(entries, files, 90, now).collect()] == ["a"]
    paths = lambda df: sorted(r["file_path"] for r in df.collect())
    assert paths(caching.kept(entries, 20, None, now)) == ["c"]
    assert paths(caching.kept(entries, None, "pdf", now)) == ["b"]
    assert paths(caching.kept(entries, 20, "pdf", now)) == ["b", "c"] and paths(caching.kept(entries)) == []
    wanted = spark.createDataFrame([("p1", "pdf"), ("p1", "html"), ("p1", "html"), ("p9", "pdf")], "paper_id string, content_type string")
    got = caching.get_or_fetch(wanted, entries, lambda missing: missing.withColumn("file_path", F.lit("new")), 90, now)
    assert sorted((r["paper_id"], r["content_type"], r["file_path"], r["access_count"]) for r in got.collect()) == [("p1", "html", "new", None), ("p1", "pdf", "a", 4), ("p9", "pdf", "new", None)]
    table = spark.createDataFrame([("k", 1, "old"), ("l", 5, "old")], "k string, at long, v string")
    rows = spark.createDataFrame([("k", 1, "new"), ("l", 4, "new"), ("m", 1, "new")], "k string, at long, v string")
    assert sorted(map(tuple, caching.upserted(table, rows, ["k"], [F.desc("at")]).collect())) == [("k", 1, "new"), ("l", 5, "old"), ("m", 1, "new")]
    assert statistics.hit_rate(3, 1) == 75.0 and statistics.hit_rate(0, 0) == 0.0


def test_packages_and_logs(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", "a" if i else "", "d", 2020 + i, "s", "success" if i else "error", "x|y") for i in range(3)], "ord long, title string, abstract string, doi string, year int, source_db string, extraction_status string, failure_modes string")
    df = df.withColumns({c: F.lit("v") for c in ("venue_type", "game_type", "llm_family", "code_release")} | {"awscale": F.lit(3)})
    (tmp_path / "fig.txt").write_text("figure")
    out = exports.package(df, str(tmp_path / "p.zip"), {"model": "m"}, df.limit(1).withColumn("reason", F.lit("r")), {"figures/fig.txt": str(tmp_path / "fig.txt")})
    with zipfile.ZipFile(out) as z:
        assert set(z.namelist()) == {"papers.csv", "metadata.json", "summary.json", "excluded_papers/excluded_papers.csv", "excluded_papers/excluded_summary.json", "README.md", "figures/fig.txt"}
        about = json.loads(z.read("metadata.json"))
        assert about["quality_metrics"] == {"papers_with_abstracts": 2, "papers_with_dois": 3, "extraction_success_rate": pytest.approx(2 / 3, abs=1e-5)}
        assert json.loads(z.read("summary.json"))["failure_mode"] == {"x": 3, "y": 3}
        assert "1 papers, 25.0 %" in z.read("README.md").decode() and len(z.read("papers.csv").decode().splitlines()) == 4
    entries = spark.sql("SELECT id, timestamp'2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS timestamp, 'm' AS module, IF(id % 2 = 0, 'ERROR', 'INFO') AS level, 'a message' AS message FROM range(30)")
    exports.append_log(entries, str(tmp_path / "log"))
    exports.append_log(entries.withColumn("id", F.col("id") + 100), str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 60 and log.select("day").distinct().count() == 2
    exports.export_log(log, str(tmp_path / "csv"), 5, status="error", start="2024-01-01 10:00:00")
    got = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert sorted(int(r["id"]) for r in got.collect()) == [24, 26, 28, 126, 128]
    report = statistics.profile(spark.createDataFrame([(7, True), (3, False)], "s int, i boolean"), {"total": F.lit("all"), "score": F.col("s"), "outcome": F.when(F.col("i"), "included").otherwise("excluded")})
    assert "Auto-included: 1 (50.0%)" in exports.inclusion_text(report, 6)
    assert spark.read.text(exports.snapshot_config(spark, {"a": 1}, str(tmp_path), "r1")).first()[0] == '{"a": 1}'


def test_profile_counts_lists_and_cuts_kinds(spark):
    df = spark.createDataFrame([("a", "x| y"), ("a", "x"), ("b", None), (None, "")], "c string, l string")
    got = statistics.profile(df, {"c": F.col("c")}, {"l": F.split("l", r"\|")}, {"c": 1})
    assert sorted(map(tuple, got.collect())) == [("c", "a", 2), ("l", "x", 2), ("l", "y", 1)]
    assert statistics.profile(df.limit(0), {"c": F.col("c")}, {}, {"c": 1}).collect() == []


def test_production_chain_equals_its_steps(spark):
    from difflib import SequenceMatcher

    import random

    rng = random.Random(2)
    titles = [f"title number {i} of the kind {rng.choice('abc')}" for i in range(8)]
    rows = [(i, rng.choice(titles) + rng.choice(["", "x", " !"]), "", "", 2000 + rng.randrange(4), rng.choice(["", "", "10.1/a", "https://doi.org/10.1/B", "10.1/b"]), rng.choice(["", "2301.1v1", "2301.1v2", "2301.2"]), rng.choice(["", "u1", "u2", f"v{i}"]), 0) for i in range(80)]
    key = lambda d: d.lower().removeprefix("https://doi.org/")
    with_doi = list({key(r[5]): r for r in reversed([r for r in rows if r[5]])}.values())
    with_doi.sort(key=lambda r: r[0])
    kept = []
    for r in sorted([r for r in rows if not r[5]], key=lambda r: (-r[4], r[0])):
        if not any(r[1].lower().strip() == k[1].lower().strip() or SequenceMatcher(None, r[1].lower(), k[1].lower()).ratio() > 0.9 for k in kept):
            kept.append(r)
    step, seen = [], set()
    for r in with_doi + kept:
        bare = r[6].split("v")[0]
        if not bare or bare not in seen:
            step.append(r)
            seen.add(bare)
    seen, want = set(), []
    for r in [r for r in step if r[6]] + [r for r in step if not r[6]]:
        if not r[7] or r[7] not in seen:
            want.append(r[0])
            seen.add(r[7])
    df = spark.createDataFrame(rows, "ord long, title string, abstract string, authors string, year int, doi string, arxiv_id string, url string, citations long").repartition(3)
    assert sorted(r["ord"] for r in dedup.production_chain(df).collect()) == sorted(want)


def test_a_raising_provider_is_a_status(spark):
    def raising(_):
        raise OSError

    df = spark.createDataFrame([(1, "long text " * 20), (2, None)], "ord long, t string")
    assert {r["ord"]: r["extraction_status"] for r in extraction.extract(df, F.col("t"), raising).collect()} == {1: "error", 2: "pdf_not_found"}
    scale = spark.createDataFrame([("6 (strict)",), ("none",), (None,), ("9",)], "a string").select(extraction.scale_by_answer(F.col("a"), F.lit(4))).collect()
    assert [r[0] for r in scale] == [6, 4, 4, 4]


def test_seeds_and_months(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"seed_papers": [{"title": "T", "authors": ["A", "B"], "year": 2020}]}))
    assert [(r["title"], r["authors"]) for r in records.seeds(spark, str(tmp_path / "s.json")).collect()] == [("T", "A; B")]
    assert [tuple(r) for r in records.months(spark, "2024-01-10", "2024-03-01").collect()][0][1] == "20240131"
    assert records.months(spark, "2024-01-01", "2024-02-15").collect()[1]["to"] == "20240229"


def test_workbooks(spark, tmp_path):
    df = spark.createDataFrame([("SCREEN_0001", "a <b> & \x01c", 2020, 1.5, True), ("SCREEN_0002", None, None, None, False)], "screening_id string, title string, year int, v double, ok boolean")
    path = workbook.screening_workbook(str(tmp_path / "s.xlsx"), df)
    back = workbook.read_workbook(spark, path)
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == [("SCREEN_0001", "a <b> & c", "2020", "1.5", "true"), ("SCREEN_0002", None, None, None, "false")]
    assert workbook.read_workbook(spark, path, "Exclusion_Reasons").where("Code = 'E8'").first()["Reason"] == "Duplicate publication"
    assert workbook.read_workbook(spark, path, "Instructions").count() == 4
    with zipfile.ZipFile(path) as z:
        assert 'width="50"' in z.read("xl/worksheets/sheet2.xml").decode()
    wide = workbook.write_workbook(str(tmp_path / "w.xlsx"), {"W": ([f"c{i}" for i in range(60)], [list(range(60))])})
    assert list(workbook.read_rows(wide))[1] == [str(i) for i in range(60)]
    results = df.withColumns({c: F.lit(v) for c, v in (("pdf_status", "cached"), ("extraction_status", "success"), ("failure_modes", ""), ("llm_family", "x"))})
    summary = workbook.read_workbook(spark, workbook.results_workbook(str(tmp_path / "r.xlsx"), results), "Summary")
    assert {r["Metric"]: r["Value"] for r in summary.collect()} == {"Total Papers": "2", "Papers with PDFs": "2", "Papers Extracted": "2", "Papers with Failure Modes": "0", "Unique LLM Families": "1"}


def test_pdf_text(spark, tmp_path):
    import zlib

    page = b"BT /F1 12 Tf 72 700 Td (Hello \\(big\\) w\\366rld) Tj 0 -14 Td [(sec) -20 (ond) -300 (line)] TJ ET"
    packed = zlib.compress(b"BT (next page) Tj ET")
    content = b"%PDF-1.4\n1 0 obj <</Title (A title) /Author (Ann)>> endobj\n2 0 obj <</Length 9>>\nstream\n" + page + b"\nendstream endobj\n3 0 obj <</Filter /FlateDecode /Length 9>>\nstream\n" + packed + b"\nendstream endobj"
    (tmp_path / "a.pdf").write_bytes(content)
    (tmp_path / "b.pdf").write_bytes(b"no pdf")
    got = {r["path"].rsplit("/", 1)[1]: r for r in pdf.read_pdfs(spark, str(tmp_path)).collect()}
    assert got["a.pdf"]["text"] == "Hello (big) wörld\nsecond line\n\nnext page"
    assert (got["a.pdf"]["title"], got["a.pdf"]["author"], got["b.pdf"]["text"]) == ("A title", "Ann", None)
    assert pdf.pdf_text(content, 1) == "Hello (big) wörld\nsecond line"
    files = extraction.binary_files(spark, str(tmp_path))
    stats = statistics.file_statistics(files).first()
    assert stats["files"] == 2 and {r["is_pdf"] for r in files.collect()} == {True, False} and {len(r["md5"]) for r in files.collect()} == {32}


def test_a_failing_row_costs_no_other_row(spark):
    def process(batch):
        if (batch["i"] % 37 == 5).any():
            raise ValueError("bad row")
        return batch.assign(twice=batch["i"] * 2)

    got = incremental.isolated(spark.range(100).withColumnRenamed("id", "i"), process, "i long, twice long").collect()
    assert sorted(r["twice"] for r in got if r["error"] is None) == [2 * i for i in range(100) if i % 37 != 5]
    assert [r["error"] for r in got if r["error"]] == ["ValueError: bad row"] * 3
