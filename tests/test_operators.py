from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import scores
from tessera.operators import dedup, metrics, ordering, rules, screening, search, statistics, tagging, tiling, titles

PAPERS = "ord long, title string, abstract string, authors string, year int, doi string, arxiv_id string, url string, citations long"


def papers(spark, *rows):
    return spark.createDataFrame(rows, PAPERS)


def ords(df):
    return sorted(r["ord"] for r in df.collect())


def test_doi_keeps_the_fuller_record(spark):
    df = papers(spark, (1, "t", "short", "A", 2020, "10.1/x", "", "u", 0), (2, "t", "a longer one", "A", 2020, "https://doi.org/10.1/X", "", "u", 0), (3, "t", None, None, 2020, None, "", "u", 0), (4, "t", "", "", 2020, "", "", "u", 0))
    assert ords(dedup.by_doi(df)) == [2, 3, 4]


def test_similar_titles_are_greedy_not_transitive(spark):
    base = "x" * 50
    df = papers(spark, (1, base + "abcdefghij", "", "", 1, "", "", "", 0), (2, base + "abcdefgh", "", "", 1, "", "", "", 0), (3, base + "qrstuvwxyz0123456789", "", "", 1, "", "", "", 0), (4, "", "", "", 1, "", "", "", 0), (5, "!!", "", "", 1, "", "", "", 0))
    assert ords(dedup.by_similar_title(df, 0.95)) == [1, 3, 4, 5]


def test_chain_rejects_unknown_methods(spark):
    with pytest.raises(ValueError, match="unknown"):
        dedup.chain(papers(spark), ["nope"])


def test_indel_ratio():
    assert dedup.indel_ratio("abcd", "abcd") == 1.0
    assert dedup.indel_ratio("abcd", "") == 0.0
    assert dedup.indel_ratio("kitten", "sitting") == pytest.approx(2 * 4 / 13)


def test_rules(spark):
    df = papers(spark, (1, "Chess", "board game", "", 2020, "", "", "http://grey.org", 0), (2, "War", "chess wargame", "", 2020, "", "", "", 0), (3, "x", None, "", 0, "", "", "", 0))
    got = {r["ord"]: r["reason"] for r in rules.disambiguated(df, {"chess": (("wargame",), ("chess",))}, ("chess",)).collect()}
    assert got == {1: "chess", 2: None, 3: None}
    assert ords(rules.by_keywords(df, ["war"], [])) == [2]
    assert ords(rules.by_keywords(df)) == [1, 2, 3]
    assert ords(rules.in_years(df, 2018, 2025)) == [1, 2]


def test_selected_takes_the_latest_decision(spark):
    df = spark.createDataFrame([(1, "yes", None, "True"), (2, "1", None, "False"), (3, "no", None, "True")], "ord long, include_ta string, include_ft string, auto_include string")
    assert ords(rules.selected(df)) == [1, 2]
    assert ords(rules.selected(df.drop("include_ta", "include_ft"))) == [1, 3]
    assert ords(rules.selected(df.select("ord"))) == [1, 2, 3]


def test_tags(spark):
    text = "Hallucinations and biased GPT-4 output; code is available at github.com/a/b-c"
    row = tagging.tagged(spark.createDataFrame([(text,)], "t string"), F.col("t"), ("bias", "hallucination")).first()
    assert row["failure_modes"] == ["bias", "hallucination"]
    assert row["llm_detected"] == ["gpt4"]
    assert row["code_detected"] == "github.com/a/b-c"
    jail = tagging.tagged(spark.createDataFrame([("a jailbreak",), (None,)], "t string"), F.col("t"), ("bias",)).collect()
    assert [r["failure_modes"] for r in jail] == [["other"], []]


def test_numbered_is_gapless_over_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("ord"), (F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    got = ordering.numbered(df, [F.desc("v")]).select("v", "position").collect()
    assert sorted((r["position"], r["v"]) for r in got) == [(i + 1, 999 - i) for i in range(1000)]


@pytest.mark.parametrize(("values", "buckets"), [([1, 2, 3, 4, 5], [1, 2, 3, 4, 5]), ([1, 2, 3], [1, 2, 3]), ([1, 1, 2], [1, 1, 5]), ([7, 7], [3, 3]), ([None], [3]), ([None, 0, 4, 9, 9, 9, 9, 9, 1, 2], [1, 1, 4, 5, 5, 5, 5, 5, 2, 3])])
def test_bucketed(spark, values, buckets):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v long")
    assert [r["bucket"] for r in screening.bucketed(df, "v").orderBy("i").collect()] == buckets


def test_numbered_loses_no_row_of_many_partitions(spark):
    df = spark.range(0, 1_000_000, 1, 20).select((F.col("id") * 7919 % 1_000_003).alias("v"), F.repeat(F.lit("wide "), 20).alias("w"))
    got = ordering.numbered(df, [F.col("v")])
    n, first, last, different = got.agg(F.count("*"), F.min("position"), F.max("position"), F.countDistinct("position")).first()
    assert (n, first, last, different) == (1_000_000, 1, 1_000_000, 1_000_000)
    assert got.select("v", "position").orderBy("v").limit(3).collect() == got.select("v", "position").orderBy("position").limit(3).collect()


def test_running_sums_and_quantiles(spark):
    import numpy as np

    values = [(v, v % 3 + 1) for v in range(-20, 80, 3)]
    df = spark.createDataFrame(values, "v long, n long").repartition(5)
    before = {r["v"]: r["before"] for r in ordering.running(df, [F.col("v")], "n").collect()}
    assert before == {v: sum(n for w, n in values if w < v) for v, _ in values}
    at = [0, 0.2, 0.37, 0.5, 1]
    assert ordering.quantiles(df, "v", "n", at) == pytest.approx(list(np.quantile([v for v, n in values for _ in range(n)], at)))
    assert ordering.quantiles(df.limit(0), "v", "n", at) == []


def test_sheet_and_reference_tables(spark):
    df = spark.createDataFrame([(1, "b", "yes"), (2, "a", None)], "ord long, title string, include_ta string")
    got = screening.sheet(df, [F.col("title")])
    assert got.columns[:2] == ["screening_id", "title"]
    assert {r["screening_id"]: (r["ord"], r["include_ta"], r["source_db"], r["language_detected"]) for r in got.collect()} == {"SCREEN_0001": (2, None, "unknown", "en"), "SCREEN_0002": (1, "yes", "unknown", "en")}
    assert screening.by_id(got, "SCREEN_0002").first()["ord"] == 1
    assert [r["code"] for r in screening.reasons_table(spark).where("stage = 'Full Text'").collect()] == ["E6", "E7"]
    assert screening.instructions_table(spark).count() == 4


def test_log_status_and_error_class(spark):
    df = spark.createDataFrame([("a success", "ERROR"), ("run completed", "INFO"), ("x", "ERROR"), ("x", "WARNING"), ("warning", None), (None, "DEBUG")], "m string, l string")
    assert [r[0] for r in df.select(scores.log_status(F.col("m"), F.col("l"))).collect()] == ["success", "info", "error", "warning", "warning", "info"]
    df = spark.createDataFrame([("Too many requests",), ("timed out",), ("network down",), ("HTTP 503",), (None,)], "m string")
    assert [r[0] for r in df.select(scores.error_class(F.col("m"))).collect()] == ["rate_limit", "timeout", "connection_error", "server_error", "unknown"]


def test_trend_needs_three_years(spark):
    df = spark.createDataFrame([(2020,), (2021,)], "year int")
    assert {r["slope"] for r in metrics.trend(df).collect()} == {None}


def test_search_language(spark):
    df = spark.createDataFrame([(1, "An LLM plays a wargame"), (2, "red team exercise with many words and then the model"), (3, "red model team"), (4, None)], "ord long, t string")
    hits = lambda q: ords(search.search(df, q, "t"))
    assert hits("llm AND wargam*") == [1]
    assert hits('"red team" OR llm') == [1, 2]
    assert hits('red NEAR/2 ("model" OR "nothing")') == [3]
    assert hits('red NOT red NEAR/2 "model"') == [2]
    assert hits("m?del") == [2, 3]
    assert search.printed(search.parse('"red team" AND llm*'), "arxiv") == '("red team" AND llm)'
    assert search.for_arxiv(search.parse("llm* AND x")) == "(abs:((llm AND x)) OR ti:((llm AND x))) AND (cat:cs.*)"
    assert search.printed(search.parse('a NEAR/3 ("b" OR "c")'), "scholar") == '("a b" OR "a c")'
    for bad in ("(a", "AND", 'a NEAR/2', "a )"):
        with pytest.raises(ValueError):
            search.parse(bad)


def test_reaches_is_the_ratio_with_its_bound():
    rng = random.Random(3)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        b = "".join(c for c in a if rng.random() < 0.95) + rng.choice(["", "a", "bc"])
        for t in (0.8, 0.9, 1.0):
            assert titles.reaches(a, b, t, False) == (titles.indel_ratio(a, b) >= t)
            assert titles.reaches(a, b, t, True) == (titles.indel_ratio(a, b) > t)


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.95])
def test_candidate_pairs_lose_no_link(spark, threshold):
    """Short, long and shifted titles, characters beyond the basic plane, one very common beginning."""
    rng = random.Random(int(threshold * 100))
    made = ["a", "ab", "ba", "abc", "𝒜𝒷𝒸 title", "𝒜𝒷𝒸 titles"]
    while len(made) < 90:
        t = list(rng.choice(made)) if rng.random() < 0.6 else list("the study of " + "".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 120))))
        for _ in range(rng.randint(0, 4)):
            t.insert(rng.randrange(len(t) + 1), rng.choice("xyz")) if rng.random() < 0.5 else t.pop(rng.randrange(len(t)))
            t = t or ["q"]
        made.append("".join(t))
    made = list(dict.fromkeys(made))
    rows = titles.spelled(spark.createDataFrame(list(enumerate(made)), "place long, t string"))
    similar = titles.indel_at_least(threshold)
    pairs = titles.candidate_pairs(rows, 1 - threshold)
    got = {(r["a"], r["b"]) for r in titles._verified(pairs, rows, similar, 1 - threshold).collect()}
    assert got == {(i, j) for i in range(len(made)) for j in range(i + 1, len(made)) if titles.indel_ratio(made[i], made[j]) >= threshold}
    assert got and pairs.count() < len(made) * (len(made) - 1) / 2


def test_long_titles_of_one_language_are_no_candidates(spark):
    """Long titles share all their short pieces; only pairs within the edits come, and a later title is compared with all others."""
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    made = [" ".join(rng.choice(words) for _ in range(60))[: rng.randint(230, 300)] for _ in range(60)]
    made += [t[:100] + "zz" + t[110:] for t in made[:5]]
    rows = titles.spelled(spark.createDataFrame(list(enumerate(made)), "place long, t string"))
    want = {(i, j) for i in range(len(made)) for j in range(i + 1, len(made)) if titles.indel_ratio(made[i], made[j]) >= 0.9}
    assert {(r["a"], r["b"]) for r in titles.candidate_pairs(rows, 0.1).collect()} == want and len(want) >= 5
    fresh = spark.createDataFrame([(2,), (61,)], "place long")
    got = {(r["a"], r["b"]) for r in titles.candidate_pairs(rows, 0.1, titles.indel_at_least(0.9), fresh).collect()}
    assert got == {p for p in want if {2, 61} & set(p)}


@pytest.mark.parametrize("few", [0, 96])
def test_pairs_within_the_edits(few, monkeypatch):
    """Rows of words of 63 characters, and few pairs one by one; ends of words, characters that share a number, empty rests."""
    import numpy as np

    from tessera.operators import tiling

    monkeypatch.setattr(tiling, "FEW", few)
    rng = random.Random(9)
    made = ["a", "ab", "x" * 63, "x" * 64, "é" * 126]
    while len(made) < 120:
        t = list(rng.choice(made)) if rng.random() < 0.7 else [rng.choice("abcdefg ") for _ in range(rng.choice([1, 5, 62, 63, 64, 126, 127, 300]))]
        for _ in range(rng.randint(0, 1 + len(t) // 6)):
            t.insert(rng.randrange(len(t) + 1), rng.choice("abyz é𝒜")) if rng.random() < 0.5 or len(t) < 2 else t.pop(rng.randrange(len(t)))
        made.append("".join(t))
    spelled, (a, b) = tiling.Spelled(made), np.triu_indices(len(made), 1)
    for most in (0.02, 0.1, 0.5):
        want = [len(made[i]) + len(made[j]) - 2 * tiling.common(made[i], made[j]) <= most * (len(made[i]) + len(made[j])) + 1e-9 for i, j in zip(a, b, strict=True)]
        assert tiling.within(spelled, a, b, most).tolist() == want and any(want)


def test_groups_of_near_titles_hang_on_their_first(spark):
    """A large group of near copies: its pairs aren't listed, and the greedy result is the same."""
    base = "a rather long title about the very common subject of reviews in medicine"
    made = [base] + [base[:k] + "x" + base[k + 1 :] for k in range(0, 60)] + [base.replace("review", "survey"), "something else entirely"]
    rows = spark.createDataFrame(list(enumerate(made)), "place long, t string")
    gone = {r["place"] for r in titles.greedily_dropped(rows, 0.9, titles.indel_at_least(0.9)).collect()}
    kept, want = [], set()
    for i, t in enumerate(made):
        if any(titles.indel_ratio(made[k], t) >= 0.9 for k in kept):
            want.add(i)
        else:
            kept.append(i)
    assert gone == want


def test_titles_whose_first_goes_hang_on_what_stays(spark, monkeypatch):
    """The rest is compared with those only that aren't similar to the title for which their first one goes."""
    kept = "a rather long title about the very common subject of reviews"
    first = "xxx" + kept[3:]
    made = [kept, first] + [first[:k] + "z" + first[k + 1 :] for k in range(3, 30)] + [first[:40] + "yyyy" + first[44:], "yyyyyyy" + kept[7:]]
    rows = spark.createDataFrame(list(enumerate(made)), "place long, t string")
    monkeypatch.setattr(titles, "first_links", lambda *_: spark.createDataFrame([(i, 1) for i in range(2, len(made))], "place long, first long"))
    seen, pairs = [], titles.candidate_pairs
    monkeypatch.setattr(titles, "candidate_pairs", lambda rest, most, similar, fresh=None: seen.append(fresh and ords(fresh.withColumnRenamed("place", "ord"))) or pairs(rest, most, similar, fresh))
    gone = {r["place"] for r in titles.greedily_dropped(rows, 0.9, titles.indel_at_least(0.9)).collect()}
    stay: list[int] = []
    for i, t in enumerate(made):
        if not any(titles.indel_ratio(made[k], t) >= 0.9 for k in stay):
            stay.append(i)
    far = [i for i in range(2, len(made)) if titles.indel_ratio(kept, made[i]) < 0.9]
    assert gone == set(range(len(made))) - set(stay) and seen == [None, far] and len(stay) > 1 and len(far) < 3


def test_no_titles(spark):
    assert titles.greedily_dropped(spark.createDataFrame([], "place long, t string"), 0.9, titles.indel_at_least(0.9)).count() == 0


def test_similar_titles_anywhere_equal_the_greedy_scan(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(6)
    titles = []
    for _ in range(80):
        if titles and rng.random() < 0.6:
            t = list(rng.choice(titles))
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = rng.choice("abcdef ")
            titles.append("".join(t))
        else:
            titles.append("".join(rng.choice("abcdefghij ") for _ in range(rng.randint(6, 50))))
    rows = [(i, t, "", "", 2000 + i % 7, "", "", "", 0) for i, t in enumerate(titles)] + [(900, "", "", "", 1, "", "", "", 0)]
    kept: list[str] = []
    want = []
    for r in sorted(rows, key=lambda r: (-r[4], r[0])):
        t = r[1].lower().strip()  # as the reference compares titles
        if t and not any(t == k or SequenceMatcher(None, t, k).ratio() > 0.9 for k in kept):
            kept.append(t)
            want.append(r[0])
    assert ords(dedup.by_similar_titles_anywhere(papers(spark, *rows))) == sorted(want)


def test_extraction(spark):
    from tessera.operators import extraction

    long = "A conference paper: a seminar game with GPT-4 as player, open-ended, 40 % wins. " * 3
    df = spark.createDataFrame([(1, long), (2, "short"), (3, None)], "ord long, t string")
    got = {r["ord"]: r for r in extraction.extract(df, F.col("t")).collect()}
    assert (got[1]["extraction_status"], got[1]["llm_family"], got[1]["awscale"]) == ("success", "gpt-4", 2)
    assert (got[2]["extraction_status"], got[3]["extraction_status"]) == ("insufficient_text", "pdf_not_found")

    def broken(_):
        raise OSError

    assert extraction.first_answer([broken, lambda t: None, extraction.offline_provider])(long)
    assert extraction.extract(df, F.col("t"), lambda t: None).where("ord = 1").first()["extraction_status"] == "llm_extraction_failed"
    where = spark.createDataFrame([("", "2301.1", "10.1/a", "u.pdf"), ("", "", "", "http://x/y.PDF"), ("", "", "", "z")], "pdf_url string, arxiv_id string, doi string, url string").select(extraction.pdf_location().alias("p")).collect()
    assert [r["p"] and r["p"]["kind"] for r in where] == ["arxiv", "direct", None]


def test_near_is_the_slice_rule(spark):
    """Against offsets of all occurrences; words cut by a slice, gaps of several kinds, terms that overlap, either order."""
    rng = random.Random(11)
    texts = ["".join(rng.choice(["red ", "model", "mod", " ", "\n", "\x1d", "\u00a0", "x", "red model", "É", "."]) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["", "redmodel", "model red", "red", "x " * 3000 + "red model"]
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, title string")
    for first, options, distance in (("red", ("model", "mod"), 0), ("red", ("model",), 1), ("red", ("model", "x"), 2), ("red m", ("model",), 3), ("model", ("É",), 5)):
        term = search.Term("near", first, options, distance)
        got = ords(df.where(search.condition(term, F.col("title"))))
        assert got == [i for i, t in enumerate(texts) if search.near(t, first, options, distance)]
        assert 0 < len(got) < len(texts)


def test_hits_count_what_each_query_finds(spark):
    df = papers(spark, *[(i, t, a, "", 2020, "", "", "", 0) for i, (t, a) in enumerate([("red model", "b"), ("Red", None), (None, "big model"), ("", ""), (None, None)])])
    queries = ["red", "model", "red AND model", "red OR model", "NOT red", 'red NEAR/2 "model"', "mod*", "nothing"]
    got = {r["query"]: r["hits"] for r in search.hits(df, queries, "title", "abstract").collect()}
    assert got == {q: search.search(df, q, "title", "abstract").count() for q in queries}
    assert sum(r["hits"] for r in search.hits(df.limit(0), queries, "title", "abstract").collect()) == 0


def test_trailing_means_cross_stretches(spark):
    rows = [("a", i, float(i * i % 17)) for i in range(57)] + [("b", i, float(i)) for i in range(3)] + [("c", 5, 1.0)]
    df = spark.createDataFrame(rows, "job_id string, batch_id long, processing_time double")
    for stretch in (1, 7, 1000):
        got = {(r["job_id"], r["batch_id"]): r["recent_mean"] for r in statistics.trailing_mean(df, 10, stretch).collect()}
        for job, i, _ in rows:
            last = [x for j, k, x in rows if j == job and i - 10 < k <= i]
            assert got[job, i] == round(sum(last) / len(last), 6)
        assert len(got) == len(rows)


def test_near_over_documents_is_the_slice_rule(spark):
    from tessera.plans.papers import papers as table_of
    from tessera.plans.queries import QUERIES

    data = "/root/testdata/sf0.001"
    texts = {r["ord"]: " ".join(x for x in (r["title"], r["abstract"]) if x is not None).lower() for r in table_of(spark, data).select("ord", "title", "abstract").collect()}
    df = QUERIES["near_search"](spark, data)
    assert ords(df) == sorted(i for i, t in texts.items() if search.near(t, "this", ("with", "from"), 5))
    assert not any(w in df._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "InArrow"))


def test_similar_titles_equal_the_full_scan(spark):
    rng = random.Random(12)
    base = "a study of wargames with language models"
    made = [base[: rng.randint(0, 40)] + "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 30))) for _ in range(300)] + [base, base.upper(), "", base + "s"]
    df = papers(spark, *[(i, t, "", "", 2020, "", "", "", 0) for i, t in enumerate(made)], (9999, None, "", "", 2020, "", "", "", 0))
    keys = {r["ord"]: r["k"] for r in df.select("ord", dedup.X.title_key(F.col("title")).alias("k")).collect()}
    wanted = spark.range(1).select(dedup.X.title_key(F.lit(base)).alias("k")).first()["k"]
    for threshold, limit in ((0.8, 10), (0.5, 3), (0.99, 10), (0.0, 400)):
        every = sorted((-dedup.indel_ratio(wanted, k or ""), i) for i, k in keys.items() if k is not None)
        want = [(i, -s) for s, i in every[:limit] if -s >= threshold]
        got = [(r["ord"], r["similarity"]) for r in dedup.similar_titles(df, base, threshold, limit).collect()]
        assert [i for i, _ in got if i in keys and keys[i] is not None] == [i for i, _ in want]


def test_deep_pages_read_their_parts_only(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id")).repartition(8)
    pages = ordering.Pages(df, [F.col("k")])
    assert len(pages.starts) > 1
    for start, rows in ((0, 10), (245, 20), (990, 30), (1000, 5), (0, 1000)):
        assert [r["k"] for r in pages.page(start, rows).collect()] == list(range(start, min(1000, start + rows)))
    plan = pages.page(990, 5)._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert ordering.Pages(df.limit(0), [F.col("k")]).page(0, 5).count() == 0


def test_raw_dois_are_compared_as_written(spark):
    df = papers(spark, (1, "t", "", "", 1, "10.1/x", "", "", 0), (2, "t", "", "", 1, "10.1/X", "", "", 0), (3, "t", "", "", 1, "10.1/x", "", "", 0), (4, "t", "", "", 1, "", "", "", 0), (5, "t", "", "", 1, None, "", "", 0))
    assert ords(dedup.by_doi_first(df)) == [1, 2, 4, 5]


def test_an_answer_rates_before_the_estimate(spark):
    from tessera.operators import extraction

    def scale(text):
        if "raise" in text:
            raise ValueError
        return "6 of 7" if "six" in text else "none"

    df = spark.createDataFrame([(1, "six " + "x" * 120), (2, "y" * 120), (3, "raise " + "z" * 120), (4, "six"), (5, None)], "ord long, t string")
    got = {r["ord"]: (r["extraction_status"], r["awscale"]) for r in extraction.extract(df, F.col("t"), scale=scale).collect()}
    assert got == {1: ("success", 6), 2: ("success", 4), 3: ("success", 4), 4: ("insufficient_text", None), 5: ("pdf_not_found", None)}


def test_dedup_queries_write_no_texts(spark, monkeypatch):
    """What is numbered is written; of papers only the columns that the steps need."""
    from tessera.plans.reports import QUERIES

    seen, write = [], ordering.written
    monkeypatch.setattr(ordering, "written", lambda df, name: seen.append(df.columns) or write(df, name))
    for name in ("production_dedup", "global_title_dedup"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen and not any({"abstract", "authors"} & set(c) for c in seen)


def test_titles_alone_in_their_scope_are_not_spelled(spark, monkeypatch):
    seen, spell = [], titles.spelled
    monkeypatch.setattr(titles, "spelled", lambda rows, scope=(): seen.append(sorted(r["place"] for r in rows.collect())) or spell(rows, scope))
    rows = spark.createDataFrame([(1, "abcdefghijk", "x"), (2, "abcdefghijkl", "x"), (3, "abcdefghijk", "y"), (4, "else", None), (5, "else", None)], "place long, t string, s string")
    gone = titles.greedily_dropped(rows, 0.9, titles.indel_at_least(0.9), [F.col("s")])
    assert {r["place"] for r in gone.collect()} == {2, 5} and seen == [[1, 2, 4, 5]]


def test_similar_titles_make_each_key_once(spark):
    df = papers(spark, (1, "a study of wargames", "", "", 2020, "", "", "", 0), (2, "other", "", "", 2020, "", "", "", 0))
    found = dedup.similar_titles(df, "study of wargames", 0.5)
    assert ords(found) == [1]
    assert "regexp" not in found._jdf.queryExecution().executedPlan().toString().lower()


def test_titles_move_as_often_however_many_tasks_there_are(spark, monkeypatch):
    """Blocks were as many as four times the shuffle partitions, and a title moves to a tenth of the blocks or more."""
    monkeypatch.setattr(titles, "WEIGHED", 1)
    rng = random.Random(14)
    made = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randint(90, 110))) for _ in range(300)]
    rows, seen, write, before = titles.spelled(spark.createDataFrame(list(enumerate(made)), "place long, t string")), [], titles.written, spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(titles, "written", lambda df, name: seen.append(df.count()) or write(df, name) if name == "titles-tiles" else write(df, name))
    for partitions in ("4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        titles.candidate_pairs(rows, 0.1)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


@pytest.mark.parametrize("blocks", [1, 5, 40])
def test_pairs_of_many_blocks_come_once(spark, monkeypatch, blocks):
    """Blocks that hold ends of several scopes and scopes that reach over several blocks; all pairs, and those of later titles only."""
    for name, value in (("WEIGHED", 1), ("LEAST", 1), ("BLOCKS", blocks)):
        monkeypatch.setattr(titles, name, value)
    rng = random.Random(13)
    made: list[str] = []
    while len(made) < 110:
        t = list(rng.choice(made)) if made and rng.random() < 0.7 else [rng.choice("abcdefgh ") for _ in range(rng.randint(10, 90))]
        for _ in range(rng.randint(0, 6)):
            t.insert(rng.randrange(len(t) + 1), rng.choice("xyzé")) if rng.random() < 0.5 else t.pop(rng.randrange(len(t)))
        made.append("".join(t))
    scopes = [rng.choice("aaaab") for _ in made[10:]] + list("cdefghijkk")
    rows = titles.spelled(spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(zip(made, scopes, strict=True))], "place long, t string, s string"), [F.col("s")])
    want = [(i, j) for i in range(len(made)) for j in range(i + 1, len(made)) if scopes[i] == scopes[j] and titles.indel_ratio(made[i], made[j]) >= 0.9]
    similar = titles.indel_at_least(0.9)
    assert sorted((r["a"], r["b"]) for r in titles.candidate_pairs(rows, 0.1, similar).collect()) == want and len(want) > 40
    for later in ({3}, set(range(0, 110, 9)), set(range(50, 90)), set(range(110))):
        fresh = spark.createDataFrame([(i,) for i in sorted(later)], "place long")
        assert sorted((r["a"], r["b"]) for r in titles.candidate_pairs(rows, 0.1, similar, fresh).collect()) == [p for p in want if later & set(p)]


def _edited(rng, text, edits, letters):
    """edits insertions and deletions, spread evenly, half of each or all of one kind."""
    kinds = rng.choice(["both", "lost", "come"])
    out, every = list(text), max(1, len(text) // max(1, edits))
    for k in range(edits):
        at = min(len(out) - 1, k * every + rng.randrange(every))
        if kinds == "come" or kinds == "both" and k % 2:
            out.insert(at, rng.choice(letters))
        else:
            out.pop(at)
    return "".join(out)


def test_titles_that_share_few_pieces_are_not_compared(monkeypatch):
    """Long titles of one language have much the same counts of characters; every pair of them went into the rows of the common-subsequence table."""
    rng, seen, compare = random.Random(15), [], tiling.within
    syllables = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 4))) for _ in range(40)] + [" "] * 12
    made = ["".join(rng.choice(syllables) for _ in range(180))[: rng.randint(395, 405)] for _ in range(150)]
    made += [_edited(rng, made[k], 20, "etaoin") for k in range(10)]
    monkeypatch.setattr(tiling, "within", lambda s, a, b, most: seen.append(len(a)) or compare(s, a, b, most))
    zeros = [0] * len(made)
    table = pa.table({"place": list(range(len(made))), "t": made, "scope": zeros, "fresh": [True] * len(made), "block": zeros, "i": zeros, "j": zeros})
    assert sorted(zip(*tiling.close_pairs(table, 0.1), strict=True)) == [(k, 150 + k) for k in range(10)]
    assert sum(seen) < 60


def test_pieces_lose_no_pair_at_the_limit():
    """Pairs with as many edits as are allowed, short and long, with rare characters and repetitions, and titles of several scopes behind them."""
    rng, lost = random.Random(16), 0
    for length in (0, 1, 3, 5, 8, 20, 60, 150, 511, 700, 1300, 3000):
        for letters in ("ab", "etaoinshr ", "abcdefghijklmnopqrstuvwxyz éß漢字"):
            base = "".join(rng.choice(letters) for _ in range(length))
            made = sorted([base] + [_edited(rng, base, int(length * rng.choice([0.05, 0.1, 0.15, 0.19, 0.2, 0.21])), letters) for _ in range(12 if length else 0)], key=len)
            s = tiling.Spelled(made)
            shared = tiling.Shared(s, len(made), 0.1)
            for i in range(len(made)):
                near = [j for j in range(len(made)) if j != i and len(made[i]) + len(made[j]) - 2 * tiling.common(made[i], made[j]) <= 0.1 * (len(made[i]) + len(made[j]))]
                others = np.array([j for j in range(len(made)) if j != i], np.int64)
                assert set(near) <= set(shared.near(i, others).tolist())
                lost += len(near)
    assert lost > 1000


def test_the_matcher_ends_early_with_the_same_answer():
    rng, yes = random.Random(17), 0
    for _ in range(1500):
        letters = rng.choice(["ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz "])
        a = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 30, 150, 400])))
        b = _edited(rng, a, rng.randint(0, len(a) // rng.choice([4, 8, 20])), letters) if a else rng.choice(["", "a"])
        for threshold in (0.9, 0.5, 0.97):
            want = SequenceMatcher(None, a, b).ratio() > threshold
            assert titles.matched_above(a, b, threshold) == want
            yes += want
    assert 500 < yes < 4000


def test_counts_and_least_pieces_of_titles():
    made = ["", "a", "abc", "abcd", "xabcd", "été, ê漢😀", "see the Sea", "abcd"]
    counts, least = tiling.counted(made, titles.COUNTED, 2)
    assert counts.tolist() == [[sum(c in g for c in t) for g in titles.COUNTED] for t in made]
    assert least[3].tolist() == least[7].tolist() and len({tuple(r) for r in least.tolist()}) >= 6
    alone = [tiling.counted([t], titles.COUNTED, 2)[1][0].tolist() for t in made]
    assert alone == least.tolist() and all(least[4][k] in (least[3][k], tiling.counted(["xabc"], titles.COUNTED, 2)[1][0][k]) for k in range(2))
