"""Queries of harvests, reports and bookkeeping, with the SQL that gives the same rows.

Like papers.py, this takes the tables as records of a review; fields that they lack are functions of their ids.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scores as S
from tessera.functions import text as X
from tessera.operators import caching, dedup, extraction, metrics, ordering, planning, rules, screening, search, statistics, tagging
from tessera.sources import harvest, pages, records, store
from tessera.storage import new_path
from tessera.streaming.progress import Job

from .papers import LOG, PAPERS, SCREENED, log, papers, screened, table
from .queries import CITE_KEY, LOW, QUERIES, RULES, SQL, register

__all__ = ["QUERIES", "SQL"]


def choose(index: Column, *values: str | None) -> Column:
    """The value at index modulo their number."""
    out = F.lit(values[0])
    for i, v in enumerate(values[1:], 1):
        out = F.when(index % len(values) == i, F.lit(v)).otherwise(out)
    return out


def choose_sql(index: str, *values: str | None) -> str:
    literal = lambda v: "NULL" if v is None else f"'{v}'"
    return f"[{', '.join(map(literal, values))}][{index} % {len(values)} + 1]"


FIELDS = {
    "extraction_status": ("insufficient_text", "error", "success", "success", "success"), "venue_type": ("conference", "journal", "workshop", None), "game_type": ("seminar", "matrix", "digital"),
    "llm_family": ("gpt-4", "gpt-4", "claude", "llama", None, "palm", "bert"), "failure_modes": ("", "bias|escalation", "bias", None, "hallucination| bias", "deception"), "code_release": (None, "none", "", "github.com/a/b"),
    "pdf_status": ("downloaded_arxiv", "cached", "failed", None, "downloaded"), "open_ended": ("yes", "no"), "quantitative": ("yes", "no", "no"), "venue": ("ICML", "", "NeurIPS", "arXiv", None), "include_ft": ("yes", "No ", "", None),
}


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).withColumns({c: choose(F.col("ord"), *v) for c, v in FIELDS.items()} | {"awscale": (F.col("ord") % 7 + 1).cast("int")})


EXTRACTED = f"{PAPERS}, extracted AS (SELECT *, {', '.join(f'{choose_sql("ord", *v)} AS {c}' for c, v in FIELDS.items())}, (ord % 7 + 1)::INT AS awscale FROM papers)"


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        i.alias("id"), F.concat(F.lit("s"), (u % 7).cast("string")).alias("session_id"), F.concat(F.lit("j"), (u % 5).cast("string")).alias("job_id"), i.alias("batch_id"), choose(i, "arxiv", "crossref", "semantic_scholar").alias("source"),
        F.when(i % 9 > 0, F.md5(F.concat(F.lit("query "), (i % 60).cast("string")))).alias("query_hash"), F.concat(F.lit("query "), (i % 60).cast("string")).alias("query_text"), (i % 50).alias("papers_found"), (i % 11 / 10).alias("relevance"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), (i % 97 / 4).alias("processing_time"), F.col("ts").alias("timestamp"),
    )


PROGRESS = f"""progress AS (
  SELECT event_id AS id, 's' || (user_id % 7) AS session_id, 'j' || (user_id % 5) AS job_id, event_id AS batch_id, {choose_sql('event_id', 'arxiv', 'crossref', 'semantic_scholar')} AS source,
         CASE WHEN event_id % 9 > 0 THEN md5('query ' || (event_id % 60)) END AS query_hash, 'query ' || (event_id % 60) AS query_text, event_id % 50 AS papers_found, event_id % 11 / 10 AS relevance,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, event_id % 97 / 4 AS processing_time, ts AS timestamp FROM events)"""
NOW = "2024-06-30"


def cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        (i % 300).cast("string").alias("paper_id"), choose(i, "pdf", "html", "tex").alias("content_type"), F.concat(F.lit("/cache/"), i.cast("string")).alias("file_path"), F.col("n_chars").cast("long").alias("file_size"),
        (i % 5).alias("access_count"), F.date_add(F.lit("2024-01-01").cast("date"), (i % 200).cast("int")).cast("timestamp_ntz").alias("created_at"), F.md5(F.col("text")).alias("file_hash"),
    )


CACHED = f"""cached AS (SELECT (doc_id % 300)::VARCHAR AS paper_id, {choose_sql('doc_id', 'pdf', 'html', 'tex')} AS content_type, '/cache/' || doc_id AS file_path, n_chars::BIGINT AS file_size, doc_id % 5 AS access_count,
  (DATE '2024-01-01' + (doc_id % 200)::INT)::TIMESTAMP AS created_at, md5(text) AS file_hash FROM documents)"""


def report_sql(source: str, columns: dict[str, str], lists: dict[str, str] | None = None, most: dict[str, int] | None = None) -> str:
    """The SQL of statistics.profile."""
    parts = [f"SELECT '{k}' AS kind, ({e})::VARCHAR AS value FROM {source}" for k, e in columns.items()] + [f"SELECT '{k}', trim(unnest({e})) FROM {source}" for k, e in (lists or {}).items()]
    limit = " ".join(f"WHEN '{k}' THEN {n}" for k, n in (most or {"": 0}).items())
    return f"""SELECT kind, value, n FROM (SELECT kind, value, count(*) AS n, row_number() OVER (PARTITION BY kind ORDER BY count(*) DESC, value) AS r FROM ({' UNION ALL '.join(parts)})
      WHERE value IS NOT NULL AND value <> '' GROUP BY kind, value) WHERE r <= CASE kind {limit} ELSE 1000000000 END"""


MODES = "string_split(failure_modes, '|')"

# ---- reports


@register(f"WITH {EXTRACTED} " + report_sql("extracted", {"total": "'all'", "year": "year", "source": "source_db", "venue": "venue"}, {"author": "string_split(authors, ';')"}, {"venue": 10, "author": 10}))
def paper_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.paper_statistics(extracted(spark, sf_dir))


_EXTRACTION = {"total": "'all'", "status": "extraction_status", "venue_type": "venue_type", "game_type": "game_type", "llm_family": "llm_family", "awscale": "awscale", "code": "CASE WHEN code_release IN ('', 'none') OR code_release IS NULL THEN 'not_available' ELSE 'available' END"}


@register(f"WITH {EXTRACTED} " + report_sql("extracted", _EXTRACTION, {"failure_mode": MODES}, {"llm_family": 10}))
def extraction_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.extraction_statistics(extracted(spark, sf_dir))


@register(f"WITH {EXTRACTED} " + report_sql("extracted", _EXTRACTION, {"failure_mode": MODES}, {"llm_family": 5, "failure_mode": 5}))
def extraction_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.extraction_statistics(extracted(spark, sf_dir), 5, 5)


@register(f"WITH {EXTRACTED} SELECT count(*) AS records, count(*) FILTER (extraction_status = 'success') AS extracted, round(100.0 * count(*) FILTER (extraction_status = 'success') / count(*), 1)::DOUBLE AS rate FROM extracted")
def extraction_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.extraction_rate(extracted(spark, sf_dir))


@register(f"WITH {EXTRACTED} SELECT count(*) AS papers, count(*) FILTER (pdf_status LIKE 'downloaded%' OR pdf_status LIKE 'cached%') AS with_pdf, count(*) FILTER (extraction_status = 'success') AS extracted, count(*) FILTER (failure_modes <> '') AS with_failure_modes, count(DISTINCT llm_family) AS llm_families FROM extracted")
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.export_summary(extracted(spark, sf_dir))


@register(f"WITH {EXTRACTED} SELECT count(*) AS total_papers, min(year) AS first_year, max(year) AS last_year, count(*) FILTER (abstract <> '') AS with_abstract, count(*) FILTER (doi <> '') AS with_doi, round(avg((coalesce(extraction_status, '') = 'success')::INT), 6) AS success_rate FROM extracted")
def package_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.package_metadata(extracted(spark, sf_dir))


@register(f"WITH {EXTRACTED} " + report_sql("extracted", {"year": "year", "source": "source_db", "game_type": "game_type", "llm_family": "llm_family", "awscale": "awscale", "open_ended": "open_ended", "quantitative": "quantitative"}, {"failure_mode": MODES}, {"llm_family": 10, "failure_mode": 10}))
def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.summary_report(extracted(spark, sf_dir))


@register(f"WITH {EXTRACTED} SELECT round(avg(awscale), 6) AS mean, median(awscale) AS median FROM extracted")
def scale_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.scale_summary(extracted(spark, sf_dir))


_said = lambda c: f"coalesce(nullif(lower(trim({c})), ''), 'unscreened')"
_FT = choose_sql("ord", *FIELDS["include_ft"])


@register(f"WITH {PAPERS}, {SCREENED}, decided AS (SELECT *, {_FT} AS include_ft, CASE WHEN ord % 11 = 0 THEN 'E6' END AS reason_ft FROM screened) " + report_sql("decided", {"total": "'all'", "title_abstract": _said("include_ta"), "full_text": _said("include_ft"), "reason_ta": "trim(reason_ta)", "reason_ft": "trim(reason_ft)"}))
def screening_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = screened(spark, sf_dir).withColumn("include_ft", choose(F.col("ord"), *FIELDS["include_ft"])).withColumn("reason_ft", F.when(F.col("ord") % 11 == 0, "E6"))
    return statistics.screening_report(rows)


_REASON = f"""coalesce(CASE WHEN contains({LOW}, '!!') OR contains({LOW}, '$$$') THEN 'junk' END, CASE WHEN (contains({LOW}, 'clown') OR contains({LOW}, 'moron')) AND NOT contains({LOW}, 'with') THEN 'surveys' END, CASE WHEN contains({LOW}, 'nicht') THEN 'german' END)"""
_JUDGED = f"{PAPERS}, judged AS (SELECT *, {_REASON} AS reason, contains(lower(url), '/p/1') OR contains(lower(source_db), '/p/1') AS grey FROM papers)"


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.grey_literature(rules.disambiguated(papers(spark, sf_dir), RULES, ("surveys",)), ["/p/1"])


@register(f"WITH {_JUDGED} " + report_sql("(SELECT * FROM judged WHERE reason IS NOT NULL)", {"total": "'all'", "reason": "reason", "year": "year", "source": "source_db"}))
def excluded_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.excluded_summary(_judged(spark, sf_dir).where("excluded"))


@register(f"WITH {_JUDGED} " + report_sql("judged", {"outcome": "CASE WHEN reason IS NULL THEN 'passed' ELSE 'excluded' END", "reason": "reason", "grey_source": "CASE WHEN grey THEN source_db END"}))
def disambiguation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.disambiguation_report(_judged(spark, sf_dir))


_any = lambda words: " OR ".join(f"contains(lower(abstract), '{w}')" for w in words)
FIRST, SECOND = ("clown", "moron"), ("license", "pour")


@register(f"WITH {PAPERS}, s AS (SELECT *, citations % 10 AS score FROM papers) " + report_sql("s", {"total": "'all'", "outcome": "CASE WHEN score >= 6 THEN 'included' ELSE 'excluded' END", "score": "score", "excluded_first": f"CASE WHEN score < 6 AND ({_any(FIRST)}) THEN 'yes' END", "excluded_second": f"CASE WHEN score < 6 AND ({_any(SECOND)}) THEN 'yes' END", "excluded_both": f"CASE WHEN score < 6 AND ({_any(FIRST)}) AND ({_any(SECOND)}) THEN 'yes' END"}))
def inclusion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.auto_included(papers(spark, sf_dir), F.col("citations") % 10)
    low = F.lower("abstract")
    return statistics.inclusion_report(rows, S.hits(low, FIRST) > 0, S.hits(low, SECOND) > 0)


_LOGGED = f"{LOG}, logged AS (SELECT *, CASE WHEN level = 'ERROR' OR contains(message, 'error') THEN 'error' ELSE 'info' END AS status FROM log)"


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).withColumn("status", S.log_status(F.col("message"), F.col("level")))


@register(f"WITH {_LOGGED} " + report_sql("logged", {"total": "'all'", "level": "level", "status": "status", "module": "module", "error": "CASE WHEN level = 'ERROR' OR status = 'error' THEN 'all' END"}, {}, {"module": 10}))
def log_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.log_profile(_logged(spark, sf_dir))


@register(f"WITH {LOG} SELECT min(timestamp) AS first, max(timestamp) AS last FROM log")
def log_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.log_extent(log(spark, sf_dir))


@register(f"WITH {_LOGGED} SELECT id, module, status FROM logged WHERE module LIKE '%module1%' AND level = 'INFO' AND status = 'info' AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp <= TIMESTAMP '2024-02-01'")
def log_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.log_filter(_logged(spark, sf_dir), "module1", "INFO", "info", "2024-01-05", "2024-02-01").select("id", "module", "status")


# ---- harvests, jobs, queries, caches


@register(f"WITH {PROGRESS} SELECT session_id, source, sum(papers_found)::BIGINT AS papers, max(timestamp) AS last_activity FROM progress WHERE query_hash IS NOT NULL GROUP BY ALL")
def session_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.session_progress(progress(spark, sf_dir))


@register(f"WITH {PROGRESS} SELECT session_id, min(timestamp) AS start_time, max(timestamp) AS end_time FROM progress GROUP BY session_id")
def sessions_by_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.sessions(progress(spark, sf_dir))


@register(f"""WITH {PROGRESS}, p AS (SELECT job_id, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, round(avg(processing_time), 6) AS mean_time, round(sum(processing_time), 6) AS total_time FROM progress GROUP BY job_id),
j AS (SELECT unnest(['j0', 'j1', 'j2', 'j3', 'j4', 'j5']) AS job_id)
SELECT job_id, coalesce(completed, 0) AS completed, coalesce(failed, 0) AS failed, mean_time, total_time, round(100.0 * coalesce(completed, 0) / 50, 6)::DOUBLE AS percentage FROM j LEFT JOIN p USING (job_id)""")
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = spark.createDataFrame([(f"j{i}", 495) for i in range(6)], "job_id string, total_items int")
    return statistics.job_status(progress(spark, sf_dir), jobs, 10)


@register(f"WITH {PROGRESS} SELECT job_id, batch_id, round(avg(processing_time) OVER (PARTITION BY job_id ORDER BY batch_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS recent_mean FROM progress")
def trailing_batch_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.trailing_mean(progress(spark, sf_dir)).select("job_id", "batch_id", "recent_mean")


@register(f"WITH {PROGRESS}, r AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY batch_id DESC) AS r FROM progress) SELECT job_id, round(avg(processing_time) FILTER (r <= 10) * greatest(0, 10000000 - count(*)), 6) AS seconds_left FROM r GROUP BY job_id")
def batch_time_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.time_left(progress(spark, sf_dir), 10_000_000)


@register(f"WITH {PROGRESS} SELECT source, count(*) AS queries, round(avg(papers_found), 6) AS mean_papers, round(avg(relevance), 6) AS mean_relevance FROM progress GROUP BY source")
def query_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.query_statistics(progress(spark, sf_dir))


@register(f"WITH {PROGRESS} SELECT source, query_text, papers_found FROM progress ORDER BY papers_found DESC, source, query_text LIMIT 10")
def best_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.best_queries(progress(spark, sf_dir)).select("source", "query_text", "papers_found")


@register(f"WITH {PROGRESS} SELECT source, query_text, round(0.6 * avg(papers_found) + 0.3 * coalesce(avg(relevance), 0.5) + 0.1 * least(10, count(*)), 6)::DOUBLE AS score FROM progress GROUP BY ALL")
def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.query_history(progress(spark, sf_dir))


@register(f"WITH {PROGRESS} SELECT source, query_hash, arg_max(id, (timestamp, id)) AS id FROM progress WHERE query_hash IS NOT NULL GROUP BY ALL")
def query_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = progress(spark, sf_dir).where("query_hash is not null").select("source", "query_hash", "id", "timestamp")
    empty = rows.limit(0)
    return caching.upserted(empty, rows, ["source", "query_hash"], [F.desc("timestamp"), F.desc("id")]).select("source", "query_hash", "id")


@register(f"WITH {CACHED} SELECT content_type, count(*) AS entries, round(sum(file_size) / 1048576, 6)::DOUBLE AS mb, sum(access_count)::BIGINT AS accesses FROM cached GROUP BY ROLLUP (content_type)")
def cache_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.cache_statistics(cached(spark, sf_dir))


@register(f"WITH {CACHED} SELECT file_path FROM cached WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 90 DAY AND file_path LIKE '%7'")
def valid_cache_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = cached(spark, sf_dir)
    files = entries.select(F.col("file_path").alias("path"), F.when(F.col("file_path").endswith("7"), F.col("file_hash")).otherwise("changed").alias("sha256"))
    return caching.valid(entries, files, 90, F.lit(NOW).cast("timestamp_ntz")).select("file_path")


@register(f"WITH {CACHED} SELECT content_type, count(*) AS n FROM cached WHERE NOT (created_at < TIMESTAMP '{NOW}' - INTERVAL 60 DAY AND content_type = 'pdf') GROUP BY content_type")
def cache_after_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counts(caching.kept(cached(spark, sf_dir), 60, "pdf", F.lit(NOW).cast("timestamp_ntz")), "content_type")


# ---- searches and plans

_BY_KEY = "row_number() OVER (PARTITION BY coalesce(nullif(arxiv_id, ''), title || '_' || year) ORDER BY ord) AS k"


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).withColumn("published", F.date_add(F.lit("2018-01-15").cast("date"), (F.col("ord") % 2000).cast("int"))).withColumn("keywords", choose(F.col("ord"), "cs.AI; cs.CL", "cs.LG", "cs.CL ;cs.GT", "math.CO", None))


_DATED = f"{PAPERS}, dated AS (SELECT *, DATE '2018-01-15' + (ord % 2000)::INT AS published, {choose_sql('ord', 'cs.AI; cs.CL', 'cs.LG', 'cs.CL ;cs.GT', 'math.CO', None)} AS keywords FROM papers)"


@register(f"""WITH {_DATED}, r AS (SELECT *, strftime(published, '%Y%m') AS m, row_number() OVER (PARTITION BY strftime(published, '%Y%m') ORDER BY ord) AS r FROM dated WHERE published >= DATE '2018-02-01' AND published < DATE '2022-01-01'),
c AS (SELECT *, row_number() OVER (ORDER BY m, r) AS place FROM r WHERE r <= 12), f AS (SELECT *, {_BY_KEY} FROM c WHERE place <= 300) SELECT ord, published FROM f WHERE k = 1""")
def month_split_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.month_split(_dated(spark, sf_dir), "published", [F.col("ord")], "2018-02-01", "2021-12-31", 300, 12).select("ord", "published")


@register(f"""WITH {_DATED}, e AS (SELECT *, trim(unnest(string_split(keywords, ';'))) AS c FROM dated), r AS (SELECT *, list_position(['cs.CL', 'cs.AI', 'cs.GT'], c) AS s, row_number() OVER (PARTITION BY c ORDER BY ord) AS r FROM e WHERE c IN ('cs.CL', 'cs.AI', 'cs.GT')),
p AS (SELECT *, row_number() OVER (ORDER BY s, r) AS place FROM r WHERE r <= 80), f AS (SELECT *, {_BY_KEY} FROM p WHERE place <= 150) SELECT ord FROM f WHERE k = 1""")
def category_split_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.category_split(_dated(spark, sf_dir), ["cs.CL", "cs.AI", "cs.GT"], [F.col("ord")], 150, 80).select("ord")


@register(f"WITH {_DATED} SELECT ord FROM dated WHERE list_contains(list_transform(string_split(keywords, ';'), lambda x: trim(x)), 'cs.GT')")
def category_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.in_category(_dated(spark, sf_dir), "cs.GT").select("ord")


@register(f"WITH {PAPERS} SELECT ord, year FROM papers ORDER BY year DESC, ord LIMIT 40 OFFSET 25")
def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the sorted, written papers; only the parts that it lies in are read."""
    return ordering.Pages(papers(spark, sf_dir).select("ord", "year"), [F.desc("year"), F.col("ord")]).page(25, 40)


@register(f"WITH {PAPERS} SELECT ord, doi FROM papers WHERE doi = 'https://doi.org/10.1234/AB.7'")
def doi_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.lookup(papers(spark, sf_dir), "doi", "https://doi.org/10.1234/AB.7").select("ord", "doi")


@register(f"WITH {PAPERS} SELECT ord, year FROM papers WHERE contains({LOW}, 'this') AND contains(lower(title), 'the') AND contains(lower(authors), 'lee1') AND year BETWEEN 2019 AND 2022 ORDER BY year DESC, citations DESC, title LIMIT 25")
def advanced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.advanced_search(papers(spark, sf_dir), "this", "the", "lee1", 2019, 2022, 25).select("ord", "year")


@register(f"""WITH {_DATED}, r AS (SELECT *, strftime(published, '%Y%m') AS m, row_number() OVER (PARTITION BY strftime(published, '%Y%m') ORDER BY ord) AS r FROM dated WHERE year(published) BETWEEN 2019 AND 2021 AND contains({LOW}, 'this')),
c AS (SELECT *, row_number() OVER (ORDER BY m, r) AS place FROM r WHERE r <= 5), f AS (SELECT *, {_BY_KEY} FROM c WHERE place <= 90) SELECT ord FROM f WHERE k = 1 AND year BETWEEN 2019 AND 2021""")
def arxiv_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.arxiv_search(_dated(spark, sf_dir), "this", "published", 2019, 2021, [F.col("ord")], 90, 5).select("ord")


@register(f"WITH {PAPERS}, f AS (SELECT * FROM papers WHERE contains({LOW}, 'this') ORDER BY citations DESC, ord LIMIT 100) SELECT ord, year FROM f WHERE year BETWEEN 2019 AND 2022")
def capped_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.capped_search(papers(spark, sf_dir), "this", 2019, 2022, [F.desc("citations"), F.col("ord")], 100).select("ord", "year")


@register(f"""WITH {PAPERS}, a AS (SELECT *, row_number() OVER (PARTITION BY source_db ORDER BY citations DESC, ord) AS r FROM papers WHERE source_db IN ('src0', 'src1')) SELECT source_db, count(*) AS n FROM a WHERE r <= 30 GROUP BY source_db""")
def capped_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources with a cap, of which one fails."""
    rows = papers(spark, sf_dir)

    def source(name: str) -> harvest.Source:
        return lambda query, most: rows.where(F.col("source_db") == name).orderBy(F.desc("citations"), "ord").limit(most)

    out, _ = harvest.fan_out(spark, {"src0": source("src0"), "broken": lambda query, most: rows.select("no such column"), "src1": source("src1")}, "this", 30)
    return metrics.counts(out, "source_db")


_GAMES, _MODELS, _PLACES = ("this", "from"), ("that", "with", "license"), ("the", "of", "clown", "password", "und", "les")
#: The same queries as lists of alternatives of which one each must be there.
_PLANNED = [(f'"{t}" AND "{j}"', [[t], [j]]) for j in _PLACES for t in (*_GAMES, *_MODELS)]
_CORE = f"({' OR '.join(_GAMES)}) AND ({' OR '.join(_MODELS)})"


@register(
    f"WITH {PAPERS}, t AS (SELECT {LOW} AS t FROM papers), q AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{q}', {groups})" for q, groups in [(_CORE, [[*_GAMES], [*_MODELS]]), *_PLANNED])
    + ") v(query, groups)), h AS (SELECT query, count(t) AS hits FROM q LEFT JOIN t ON len(list_filter(groups, lambda g: len(list_filter(g, lambda x: contains(t, x))) = 0)) = 0 GROUP BY query) "
    "SELECT query, hits, row_number() OVER (ORDER BY hits DESC, query)::INT AS rank FROM h"
)
def planned_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planned queries of one source by their hits in documents. The rank orders a row per query."""
    planned = planning.generated("crossref", _GAMES, _MODELS, most=100, experimental=False, places=_PLACES)
    counted = search.hits(papers(spark, sf_dir), planned, "title", "abstract")
    return counted.select("query", "hits", F.row_number().over(Window.orderBy(F.desc("hits"), "query")).alias("rank"))


@register(
    f"WITH {PAPERS}, p AS (SELECT *, (row_number() OVER (ORDER BY source_db, year, ord) - 1) // 100 AS page FROM papers) "
    "SELECT source_db AS source, year, count(*) AS records, count(DISTINCT page) AS pages, sum(length(title))::BIGINT AS title_chars FROM p WHERE year >= 2021 AND year < 2023 GROUP BY source_db, year"
)
def paged_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All papers saved as pages of a hundred, and of these the pages of two years read back by the paged source."""
    path = new_path(spark, "pages")
    payload = F.to_json(F.struct("ord", "title", "doi"))
    pages.save(papers(spark, sf_dir).select(F.col("source_db").alias("source"), "year", "ord", payload.alias("payload")), path, [F.col("ord")])
    found = pages.load(spark, path).where((F.col("year") >= 2021) & (F.col("year") < 2023))
    return found.groupBy("source", "year").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("page").alias("pages"), F.sum(F.coalesce(F.length(F.get_json_object("payload", "$.title")), F.lit(0))).alias("title_chars"))


@register(f"WITH {PAPERS}, r AS (SELECT *, row_number() OVER (PARTITION BY source_db, year ORDER BY citations DESC, ord) AS r FROM papers) SELECT source_db, year, ord, citations FROM r WHERE r = 1")
def stored_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most cited paper of each source and year, from a versioned store into which two halves were put."""
    table = store.Store(spark, new_path(spark, "store"), "source_db string, year int, ord long, citations long", ["source_db", "year"], [F.col("citations").desc(), F.col("ord")])
    for half in (0, 1):
        table.upsert(papers(spark, sf_dir).where(F.col("ord") % 2 == half))
    return table.read()


@register(f"WITH {PAPERS}, d AS (SELECT ord % 500 AS k, ord FROM papers), old AS (SELECT DISTINCT k FROM d WHERE k % 3 <> 0), want AS (SELECT DISTINCT k FROM d WHERE ord % 2 = 0) "
          "SELECT CASE WHEN k % 3 = 0 THEN 'new' WHEN k % 7 = 0 THEN 'fetched again' ELSE 'hit' END AS kind, count(*) AS entries, sum(CASE WHEN k % 3 <> 0 AND k % 7 <> 0 THEN 1 ELSE 0 END)::BIGINT AS accesses FROM want GROUP BY 1")
def cache_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers wanted from a stored cache, some of whose files are missing: hits are counted, the others fetched and stored."""
    k = (F.col("ord") % 500).cast("string")
    day = lambda n: F.lit(f"2024-01-{n:02d}").cast("timestamp")
    entry = lambda keys, at: keys.select("paper_id", F.lit("pdf").alias("content_type"), F.concat(F.lit("/c/"), "paper_id").alias("file_path"), F.sha2("paper_id", 256).alias("file_hash"), F.lit(1).cast("long").alias("file_size"), at.alias("created_at"))
    known = papers(spark, sf_dir).select(k.alias("paper_id")).distinct()
    cache = store.entries(spark, new_path(spark, "cache"))
    old = entry(known.where(F.col("paper_id").cast("int") % 3 != 0), day(1))
    cache.upsert(old.withColumn("access_count", F.lit(0).cast("long")))
    files = old.where(F.col("paper_id").cast("int") % 7 != 0).select(F.col("file_path").alias("path"), F.col("file_hash").alias("sha256"))
    wanted = papers(spark, sf_dir).where(F.col("ord") % 2 == 0).select(k.alias("paper_id"), F.lit("pdf").alias("content_type"))
    got, _ = store.get_or_fetch(cache, wanted, files, lambda keys: entry(keys, day(2)), day(3))
    number = F.col("paper_id").cast("int")
    kind = F.when(F.col("created_at") == day(1), "hit").when(number % 3 == 0, "new").otherwise("fetched again")
    return got.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("entries"), F.sum("access_count").alias("accesses"))


@register(f"WITH {PAPERS} SELECT 'titles' AS job_id, 4::BIGINT AS batches, count(*) FILTER (ord % 97 <> 13) AS n_rows, count(*) FILTER (ord % 97 = 13) AS n_errors, (sum(length(title)) FILTER (ord % 97 <> 13))::BIGINT AS title_chars FROM papers")
def job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over all papers in four batches, some of whose rows fail: what its progress table and its output say."""

    def process(df: pd.DataFrame) -> pd.DataFrame:
        if (df["ord"] % 97 == 13).any():
            raise ValueError("unlucky")
        return pd.DataFrame({"ord": df["ord"], "chars": df["title"].str.len()})

    job = Job(spark, new_path(spark, "jobs"), "titles")
    job.run(papers(spark, sf_dir).select("ord", F.coalesce("title", F.lit("")).alias("title")), "ord", process, "ord long, chars long", 4)
    done = job.progress().groupBy("job_id").agg(F.count(F.lit(1)).alias("batches"), F.sum("n_rows").alias("n_rows"), F.sum("n_errors").alias("n_errors"))
    return done.crossJoin(job.output("ord long, chars long").agg(F.sum("chars").alias("title_chars")))  # one row each


_RULES = {"venue_type": ("journal", "license"), "game_type": ("matrix", "password", "idiot"), "llm_family": ("gpt", "clown"), "llm_role": ("player", "apache")}
_first = lambda field: "CASE WHEN NOT ok THEN 'unknown' " + " ".join(f"WHEN contains(low, '{w}') THEN '{w}'" for w in _RULES[field]) + " ELSE 'unknown' END"


@register(
    f"""WITH t AS (SELECT doc_id AS ord, nullif(trim(text, ' '), '') AS t FROM documents),
c AS (SELECT ord, CASE WHEN length(t) > 30000 THEN substr(t, 1, 15000) || chr(10) || chr(10) || '[... omitted ...]' || chr(10) || chr(10) || right(t, 15000) ELSE t END AS t FROM t),
l AS (SELECT ord, t, lower(t) AS low, coalesce(length(t) >= 100, false) AS ok FROM c),
f AS (SELECT ord, CASE WHEN t IS NULL THEN 'pdf_not_found' WHEN NOT ok THEN 'insufficient_text' ELSE 'success' END AS extraction_status, ok, {', '.join(f'{_first(f)} AS {f}' for f in _RULES)},
             CASE WHEN ok AND contains(low, 'open-ended') THEN 'yes' ELSE 'no' END AS open_ended, CASE WHEN ok AND regexp_matches(low, '[0-9]+([.][0-9]+)?[ \t\n\r\f\v]*%') THEN 'yes' ELSE 'no' END AS quantitative, CASE WHEN ok THEN length(t) % 9 END AS rating FROM l),
b AS (SELECT *, greatest(1, least(7, (CASE WHEN contains(game_type, 'matrix') THEN 3 ELSE 4 END) + CASE WHEN quantitative = 'yes' THEN 1 ELSE -1 END)) AS one FROM f)
SELECT ord, extraction_status, venue_type, game_type, llm_family, llm_role, open_ended, quantitative,
       CASE WHEN ok THEN CASE WHEN rating BETWEEN 1 AND 7 THEN rating ELSE greatest(1, least(7, one + CASE WHEN open_ended = 'yes' THEN -1 ELSE 1 END)) END END::INT AS awscale,
       round(CASE WHEN ok THEN 0.5 + 0.08 * (2 + (venue_type <> 'unknown')::INT + (game_type <> 'unknown')::INT + (llm_family <> 'unknown')::INT + (llm_role <> 'unknown')::INT) ELSE 0 END, 6)::DOUBLE AS confidence FROM b"""
)
def extraction_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction over whole documents as PDF texts: the first provider never answers, the second one does, a third rates."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.lit(None).cast("string").alias("tex"), F.lit(" ").alias("html"), F.col("text").alias("pdf"))
    provider = extraction.first_answer([lambda text: None, extraction.word_provider(_RULES)])
    out = extraction.extract(docs, extraction.best_text(), provider, lambda text: f"{len(text) % 9} of 7")
    fields = ("venue_type", "game_type", "llm_family", "llm_role", "open_ended", "quantitative", "awscale")
    return out.select("ord", "extraction_status", *fields, F.round("extraction_confidence", 6).alias("confidence"))


_TEXTS = "t AS (SELECT 'documents' AS kind, text AS t FROM documents UNION ALL SELECT 'conversations', text FROM conversations), k AS (SELECT DISTINCT kind FROM t)"


@register(
    f"WITH {_TEXTS}, p AS (SELECT * FROM (VALUES {', '.join(f'($${c}$$, $${chr(124).join(ps)}$$)' for c, ps in {**tagging.FAILURES, **tagging.MODELS, **tagging.METRICS, 'insult': (chr(92) + 'b(?:idiot|clown|moron)' + chr(92) + 'b',)}.items())}) v(tag, pattern)) "
    "SELECT k.kind, tag, count(t.t) AS n FROM k CROSS JOIN p LEFT JOIN t ON t.kind = k.kind AND regexp_matches(t.t, '(?i)' || pattern) GROUP BY ALL"
)
def tags_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents and conversations by shipped tag and one of the tables' own words, zeros included."""
    patterns = {**tagging.FAILURES, **tagging.MODELS, **tagging.METRICS, "insult": (r"\b(?:idiot|clown|moron)\b",)}
    texts = [table(spark, sf_dir, kind).select(F.lit(kind).alias("kind"), "text") for kind in ("documents", "conversations")]
    both = texts[0].unionByName(texts[1])
    found = both.select("kind", F.explode(tagging.tags(F.col("text"), patterns)).alias("tag")).groupBy("kind", "tag").agg(F.count(F.lit(1)).alias("n"))
    names = both.select("kind").distinct().select("kind", F.explode(F.array(*map(F.lit, patterns))).alias("tag"))
    return names.join(found, ["kind", "tag"], "left").select("kind", "tag", F.coalesce("n", F.lit(0)).alias("n"))


_GROUPS = "(contains(t, 'this') OR contains(t, 'from')) AND (contains(t, 'that') OR contains(t, 'with')) AND NOT contains(t, 'clown')"


@register(f"WITH {PAPERS}, t AS (SELECT ord, {LOW} AS t FROM papers) SELECT ord FROM t WHERE {_GROUPS}")
def base_query_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(papers(spark, sf_dir), planning.base_query(["this", "from"], ["that", "with"], excluded=["clown"]), "title", "abstract").select("ord")


@register(f"WITH {PAPERS}, t AS (SELECT ord, {LOW} AS t FROM papers) SELECT ord FROM t WHERE contains(t, 'license') AND NOT (contains(t, 'clown') OR contains(t, 'moron'))")
def secondary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = planning.from_templates([{"description": "d", "template": "license NOT ({exclusion_terms})"}], ["clown", "moron"], [])[0]["query"]
    return search.search(papers(spark, sf_dir), query, "title", "abstract").select("ord")


# ---- scores and tags


@register(f"""WITH {PAPERS}, t AS (SELECT ord, {choose_sql('ord', 'seminar', 'Matrix', 'course of action', 'Digital', None)} AS a, {choose_sql('ord', 'referee', 'deterministic', None)} AS g, {choose_sql('ord', 'narrative', None, 'calculation', 'x')} AS p FROM papers),
b AS (SELECT *, CASE a WHEN 'seminar' THEN 2 WHEN 'Matrix' THEN 3 WHEN 'course of action' THEN 5 WHEN 'Digital' THEN 6 ELSE 4 END AS base FROM t),
c AS (SELECT *, CASE g WHEN 'referee' THEN least(base - 1, 3) WHEN 'deterministic' THEN greatest(base + 1, 5) ELSE base END AS one FROM b)
SELECT ord, greatest(1, least(7, CASE p WHEN 'narrative' THEN least(one - 1, 3) WHEN 'calculation' THEN greatest(one + 1, 5) ELSE one END))::INT AS awscale,
       round(least(1.0, 0.5 + 0.1 * ((a IS NOT NULL)::INT + (g IS NOT NULL)::INT + (p IS NOT NULL)::INT)), 6)::DOUBLE AS confidence FROM c""")
def free_text_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("ord")
    a, g, p = choose(i, "seminar", "Matrix", "course of action", "Digital", None), choose(i, "referee", "deterministic", None), choose(i, "narrative", None, "calculation", "x")
    return papers(spark, sf_dir).select("ord", S.scale_estimate_free(a, g, p).cast("int").alias("awscale"), F.round(S.confidence_by_fields([a, g, p]), 6).alias("confidence"))


@register(f"WITH {PAPERS}, m AS (SELECT ord, {choose_sql('ord', 'gpt-4o', 'gpt-4', 'unheard-of')} AS m, n_chars FROM papers) SELECT ord, round(n_chars / 1000 * CASE m WHEN 'gpt-4o' THEN 0.005 WHEN 'gpt-4' THEN 0.03 ELSE 0.0005 END + ord / 1000 * CASE m WHEN 'gpt-4o' THEN 0.015 WHEN 'gpt-4' THEN 0.06 ELSE 0.0015 END, 9)::DOUBLE AS cost, substr(md5(m), 1, 12) AS query_hash FROM m")
def token_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = choose(F.col("ord"), "gpt-4o", "gpt-4", "unheard-of")
    return papers(spark, sf_dir).select("ord", F.round(S.token_cost(model, F.col("n_chars"), F.col("ord")), 9).alias("cost"), S.query_hash(model, 12).alias("query_hash"))


@register(f"WITH {EXTRACTED} SELECT ord FROM extracted WHERE code_release IS NOT NULL AND code_release NOT IN ('', 'none')")
def code_released(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, sf_dir).where(S.code_available(F.col("code_release"))).select("ord")


#: Sentences in which the shipped patterns occur, since the invented texts have none of their words.
SAID = (
    "The model was biased and stereotypes rose.", "It would hallucinate; made-up facts, false claims.", "Outputs were factually incorrect and inaccurate.", "Answers contradict each other, an incoherent run.", "Escalation and an aggressive response followed.",
    "Deceptive, misleading replies.", "Prompt-injection and prompt engineering matter.", "A data leak, a privacy breach.", "Jailbreaks bypass safety guardrails.", "GPT-4 and gpt-3.5 beat Claude in a matrix game; win rate and F1-score.", "Llama, PaLM and BERT; seminar wargame, human evaluation.",
    "Code is available at github.com/Some-one/repo_1.", "An open-source digital simulation; accuracy.", "Nothing to tell.",
)
_SAID = f"{PAPERS}, said AS (SELECT ord, {choose_sql('ord', *SAID)} AS t FROM papers)"


def _said_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select("ord", choose(F.col("ord"), *SAID).alias("t"))


def _tag_sql(patterns: dict) -> str:
    cases = ", ".join(f"CASE WHEN regexp_matches(t, '(?i){'|'.join(p)}') THEN '{name}' END" for name, p in patterns.items())
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), '|')"


@register(f"WITH {_SAID} SELECT ord, {_tag_sql(tagging.FAILURES)} AS failures, {_tag_sql(tagging.MODELS)} AS models, {_tag_sql(tagging.GAMES)} AS games, {_tag_sql(tagging.METRICS)} AS metrics, coalesce(nullif(regexp_extract(t, '(?i)github\\.com/[\\w-]+/[\\w-]+'), ''), CASE WHEN regexp_matches(t, '(?i)\\bcode\\s+(?:is\\s+)?available\\b|\\bopen[\\s-]?source\\b') THEN 'mentioned' END, '') AS code FROM said")
def shipped_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    joined = lambda patterns: F.array_join(tagging.tags(t, patterns), "|")
    return _said_rows(spark, sf_dir).select("ord", joined(tagging.FAILURES).alias("failures"), joined(tagging.MODELS).alias("models"), joined(tagging.GAMES).alias("games"), joined(tagging.METRICS).alias("metrics"), tagging.code_link(t).alias("code"))


@register(f"WITH {_SAID}, p AS (SELECT * FROM (VALUES {', '.join(f'($${c}$$, $${p}$$)' for c, ps in tagging.FAILURES.items() for p in ps)}) v(category, pattern)) SELECT category, pattern, count(*) AS n FROM said, p WHERE regexp_matches(t, '(?i)' || pattern) GROUP BY ALL")
def pattern_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.pattern_hits(_said_rows(spark, sf_dir), F.col("t"), tagging.FAILURES)


_VOCABULARY = ("bias", "hallucination", "prompt_sensitivity", "other")
_FILED = {"bias": "bias", "hallucination": "hallucination", "factual_error": "hallucination", "inconsistency": "hallucination", "prompt_sensitivity": "prompt_sensitivity", "jailbreak": "prompt_sensitivity"}
_FILED_SQL = ", ".join(f"CASE WHEN regexp_matches(t, '(?i){'|'.join(p)}') THEN '{_FILED.get(name, 'other')}' END" for name, p in tagging.FAILURES.items())


@register(f"WITH {_SAID} SELECT ord, array_to_string(list_sort(list_distinct(list_concat(list_filter([{_FILED_SQL}], lambda x: x IS NOT NULL), CASE WHEN ord % 2 = 0 THEN ['earlier'] ELSE [] END))), '|') AS modes FROM said")
def vocabulary_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = F.when(F.col("ord") % 2 == 0, F.array(F.lit("earlier")))
    return tagging.tagged(_said_rows(spark, sf_dir), F.col("t"), _VOCABULARY, earlier).select("ord", F.array_join("failure_modes", "|").alias("modes"))


_topics = lambda terms: "(" + " + ".join(f"contains(t, '{w}')::INT" for w in terms) + ")"
TOPICS = ("A wargame with a large language model.", "Crisis simulation: GPT and reinforcement learning.", "Military, strategic, defense studies.", "A transformer only.", "Nothing of it.", "Red team and tabletop exercise, ChatGPT as LLM.")


@register(f"""WITH {PAPERS}, t AS (SELECT ord, lower({choose_sql('ord', *TOPICS)}) AS t FROM papers), x AS (SELECT *, {_topics(S.STRONG_TERMS)} > 0 OR {_topics(S.WEAK_TERMS)} >= 3 AS a, {_topics(S.MODEL_TERMS)} >= 2 AS b FROM t)
SELECT ord, least(10, CASE WHEN a AND b THEN 9 WHEN a OR b THEN 7 ELSE 3 END + (contains(t, 'war game') OR contains(t, 'wargame'))::INT)::INT AS score FROM x""")
def shipped_topic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select("ord", S.topic_score(choose(F.col("ord"), *TOPICS), F.lit("")).cast("int").alias("score"))


# ---- records


@register(f"SELECT * FROM (VALUES {', '.join(f'($${a}$$, $${b}$$, $${c}$$)' for a, b, c in screening.REASONS)}) v(code, reason, stage)")
def exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.reasons_table(spark)


@register(f"SELECT * FROM (VALUES {', '.join(f'($${a}$$, $${b}$$, $${c}$$)' for a, b, c in screening.INSTRUCTIONS)}) v(step, instructions, notes)")
def screening_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.instructions_table(spark)


@register(f"""WITH {PAPERS}, f AS (SELECT *, 1 + (citations > e[1])::INT + (citations > e[2])::INT + (citations > e[3])::INT + (citations > e[4])::INT AS b FROM papers, (SELECT quantile_cont(citations, [0.2, 0.4, 0.6, 0.8]) AS e FROM papers)),
v AS (SELECT ord, CASE WHEN ord % 3 = 0 THEN 0 ELSE ord % 4 END AS few FROM papers), r AS (SELECT few, dense_rank() OVER (ORDER BY few) AS d FROM (SELECT DISTINCT few FROM v))
SELECT f.ord, b::INT AS quintile, round((d - 1) / 3 * 4 + 1)::INT AS ranked, 3 AS single FROM f JOIN v ON v.ord = f.ord JOIN r ON r.few = v.few""")
def citation_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("ord")
    rows = papers(spark, sf_dir).withColumn("few", F.when(i % 3 == 0, F.lit(None).cast("long")).otherwise(i % 4)).withColumn("one", F.lit(7))
    rows = screening.bucketed(screening.bucketed(screening.bucketed(rows, "citations", name="quintile"), "few", name="ranked"), "one", name="single")
    return rows.select("ord", "quintile", F.col("ranked").cast("int").alias("ranked"), "single")


@register(f"""WITH {PAPERS} SELECT ord, CASE ord % 4 WHEN 0 THEN 'inproceedings' WHEN 1 THEN 'article' WHEN 2 THEN 'techreport' ELSE 'misc' END AS kind, {CITE_KEY} AS key FROM papers""")
def bibtex_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).withColumn("venue", F.lit("v")).withColumn("venue_type", choose(F.col("ord"), "Conference paper", "journal", "tech report", None))
    head = F.regexp_extract("entry", r"^@(\w+)\{([^,]*),", 1), F.regexp_extract("entry", r"^@(\w+)\{([^,]*),", 2)
    return records.bibtex(rows, "ord").select("ord", head[0].alias("kind"), head[1].alias("key"))


@register(f"WITH {PAPERS} SELECT ord, coalesce(try_cast(CASE WHEN ord % 3 = 0 THEN 'n/a' ELSE year || '.0' END AS DOUBLE), 0)::INT AS year_number, translate('a‑b–c' || ord, '‑‒–—', '----') AS plain, CASE WHEN ord % 2 = 0 THEN '10.1234/ab.' || ord END AS found_doi FROM papers")
def small_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("ord")
    year = F.when(i % 3 == 0, F.lit("n/a")).otherwise(F.concat(F.col("year").cast("string"), F.lit(".0")))
    noted = F.concat(F.lit("see "), F.when(i % 2 == 0, F.concat(F.lit("10.1234/ab."), i.cast("string"))).otherwise(F.lit("10.12/x")), F.lit(" for it"))
    return papers(spark, sf_dir).select("ord", X.year_or_zero(year).alias("year_number"), X.plain_dashes(F.concat(F.lit("a‑b–c"), i.cast("string"))).alias("plain"), X.first_doi(noted).alias("found_doi"))


@register(f"WITH {PAPERS}, y AS (SELECT * FROM papers WHERE year BETWEEN 2019 AND 2021) SELECT year, count(*) AS n FROM y GROUP BY year")
def years_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counts(rules.in_years(papers(spark, sf_dir), 2019, 2021), "year")


@register(f"WITH {EXTRACTED}, f AS (SELECT *, CASE WHEN ord % 2 = 0 THEN '/x.pdf' END AS pdf_path FROM extracted) SELECT ord, (pdf_path IS NOT NULL AND (pdf_status LIKE 'downloaded%' OR pdf_status = 'cached'))::INT AS fetched FROM f WHERE (pdf_path IS NOT NULL AND (pdf_status LIKE 'downloaded%' OR pdf_status = 'cached')) OR arxiv_id <> ''")
def extraction_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extracted(spark, sf_dir).withColumn("pdf_path", F.when(F.col("ord") % 2 == 0, "/x.pdf"))
    fetched = rules.ready_for_extraction(rows).select("ord", F.lit(1).alias("fetched"))
    return rules.ready_for_extraction(rows, with_arxiv=True).select("ord").join(fetched, "ord", "left").select("ord", F.coalesce("fetched", F.lit(0)).alias("fetched"))


@register(f"WITH {EXTRACTED} SELECT ord FROM extracted WHERE lower(trim(include_ft)) = 'yes'")
def included_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.selected(extracted(spark, sf_dir)).select("ord")


@register(f"WITH {PAPERS}, d AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY ord) AS r FROM papers) SELECT ord FROM d WHERE doi <> '' AND r = 1 OR doi = ''")
def doi_only_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_doi_first(papers(spark, sf_dir)).select("ord")


@register()
def global_title_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_similar_titles_anywhere(papers(spark, sf_dir).select("ord", "title", "year")).select("ord")  # what isn't asked for would be written too


@register()
def production_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.production_chain(papers(spark, sf_dir).select("ord", "title", "year", "doi", "arxiv_id", "url")).select("ord")
