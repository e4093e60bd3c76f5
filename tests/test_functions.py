from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions import scores as S
from tessera.functions import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("title", "key"), [("The Émergent  Art, of WAR!", "emergent art war"), ("", ""), (None, ""), ("and the", ""), ("A-B_c", "b_c")])
def test_title_key(spark, title, key):
    assert one(spark, X.title_key(F.lit(title).cast("string"))) == key


def test_title_key_of_any_script(spark):
    assert one(spark, X.title_key(F.lit("Ǻngström ﬁeld 机器"), exact=True)) == "angstrom field 机器"


@pytest.mark.parametrize(("doi", "key"), [(" https://doi.org/10.1/A ", "10.1/a"), ("http://dx.doi.org/10.1/a", "10.1/a"), ("doi:10.2/b", "10.2/b"), ("11.2/b", ""), (None, "")])
def test_doi_key(spark, doi, key):
    assert one(spark, X.doi_key(F.lit(doi).cast("string"))) == key


def test_author_names_keep_or_drop_the_dot_of_an_honorific(spark):
    assert one(spark, X.author_names(F.lit("Dr. John Smith;  Prof Ann  Lee;;"))) == ". John Smith; Ann Lee"
    assert one(spark, X.author_names(F.lit("Dr. John Smith;  Prof Ann  Lee;;"), display=True)) == "John Smith; Ann Lee"


def test_arxiv_parts_split_id_and_version(spark):
    assert one(spark, F.struct(*[p.alias(n) for p, n in zip(X.arxiv_parts(F.lit("2301.00234v2")), "ab", strict=True)])).asDict() == {"a": "2301.00234", "b": 2}


def test_url_key_equals_the_parsed_url(spark):
    from urllib.parse import urlparse

    for url in ("https://Example.org/p/1/?ref=2#top", "HTTP://a.b/x;p=1/y;q=2;r", "foo/bar/", "a.b/c?d", "ftp://u@h:21/x//", "http://a.b", "mailto:x@y", "//h/p", "http://a.b/x;p?q#f"):
        parts = urlparse(url)
        assert one(spark, X.url_key(F.lit(url))) == f"{parts.scheme}://{parts.netloc}{parts.path}".rstrip("/"), url
    assert one(spark, X.url_key(F.lit(None).cast("string"))) == ""


def test_raw_responses(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('say {"a": 1}!',), ("no",), (None,)], "t string")
    assert [r[0] for r in df.select(S.raw_response(F.col("t"))).collect()] == [None, None, "no", None]


def test_year_or_zero(spark):
    assert [one(spark, X.year_or_zero(F.lit(y).cast("string"))) for y in ("2024", "2024.9", "x", None)] == [2024, 2024, 0, 0]


def test_paper_id_prefers_doi_then_arxiv(spark):
    def made(doi, arxiv):
        return one(spark, X.paper_id(F.lit(doi), F.lit(arxiv), F.lit("T"), F.lit("A; B"), F.lit(2020)))

    assert made("10.1/x", "2301.1") == "10.1/x"
    assert made("", "2301.1") == "arxiv:2301.1"
    assert len(made("", "")) == 16


def test_context_keeps_both_ends(spark):
    got = one(spark, X.context(F.lit("a" * 50 + "b" * 50), 20, "|"))
    assert got == "a" * 10 + "|" + "b" * 10


def test_scores(spark):
    assert one(spark, S.topic_score(F.lit("A wargame"), F.lit("an LLM, GPT"))) == 10
    assert one(spark, S.topic_score(F.lit(None).cast("string"), F.lit(None).cast("string"))) == 3
    assert one(spark, S.scale_estimate(F.lit("Seminar"), F.lit("no"), F.lit("yes"))) == 1
    assert one(spark, S.confidence([F.lit("a"), F.lit("unknown")], [F.lit(None).cast("string")])) == pytest.approx(0.58)
    assert one(spark, S.error_class(F.lit("Read timed out"))) == "timeout"
    assert one(spark, S.log_status(F.lit("all completed"), F.lit("INFO"))) == "info"
    assert one(spark, S.json_or_raw(F.lit('text {"k": 3} more'), "k int"))["k"] == 3
