"""Queries over the tables, with the SQL that gives the same rows.

The texts are invented, so vocabularies here are words that occur in them; the operators take any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scores as S
from tessera.functions import text as X
from tessera.operators import dedup, metrics, rules, screening, search, statistics, tagging
from tessera.sources import records
from tessera.storage import new_path
from tessera.streaming import incremental

from .papers import LOG, PAPERS, SCREENED, log, papers, screened, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


FOLD = f"translate(lower(coalesce(title, '')), '{X.ACCENTED}', '{X.PLAIN}')"
STOP = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
TITLE_KEY = f"array_to_string(list_filter(string_split(trim(regexp_replace({FOLD}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')), ' '), lambda w: w NOT IN ({STOP})), ' ')"
LIGHT_KEY = "trim(regexp_replace(lower(coalesce(title, '')), '[^\\p{L}\\p{N}_]+', ' ', 'g'))"
DOI_KEY = "CASE WHEN regexp_replace(lower(trim(doi)), '^(https?://(dx\\.)?doi\\.org/)', '') LIKE '10.%' THEN regexp_replace(lower(trim(doi)), '^(https?://(dx\\.)?doi\\.org/)', '') ELSE '' END"
NAME = "trim(regexp_replace(regexp_replace(trim(a), '\\b(Dr|Prof|Professor|Mr|Mrs|Ms|PhD|Ph\\.D)\\b', '', 'g'), '\\s+', ' ', 'g'))"
AUTHORS = f"array_to_string(list_filter(list_transform(string_split(authors, ';'), lambda a: {NAME}), lambda a: a <> ''), '; ')"
URL_KEY = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '')"
HASH = f"sha256({TITLE_KEY} || '|' || {AUTHORS} || '|' || year)"
INFO = "length(abstract) + length(authors) + CASE WHEN citations > 0 THEN 100 ELSE 0 END"


@register(f"WITH {PAPERS}, k AS (SELECT *, row_number() OVER (PARTITION BY {HASH} ORDER BY ord) AS r FROM papers) SELECT source_db, count(*) AS n FROM k WHERE r = 1 GROUP BY source_db")
def kept_per_source_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counts(dedup.by_content(papers(spark, sf_dir)), "source_db")


@register(f"WITH {PAPERS} SELECT ord, {TITLE_KEY} AS title_key, {LIGHT_KEY} AS light_key, substr(regexp_replace({TITLE_KEY}, '[^a-z0-9]', '', 'g'), 1, 50) AS slug FROM papers")
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select("ord", X.title_key(F.col("title")).alias("title_key"), X.light_title_key(F.col("title")).alias("light_key"), X.title_slug(F.col("title")).alias("slug"))


@register(f"WITH {PAPERS} SELECT ord, {DOI_KEY} AS doi_key, {AUTHORS} AS authors_key, {URL_KEY} AS url_key, {INFO} AS info, {HASH} AS content_hash FROM papers")
def record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    return p.select("ord", X.doi_key(F.col("doi")).alias("doi_key"), X.author_names(F.col("authors")).alias("authors_key"), X.url_key(F.col("url")).alias("url_key"), X.info_score(F.col("abstract"), F.col("authors"), F.col("citations")).cast("long").alias("info"), X.content_hash(F.col("title"), F.col("authors"), F.col("year")).alias("content_hash"))


@register(f"WITH {PAPERS} SELECT ord, trim(regexp_replace(title, '[\\x09-\\x0D\\x1C-\\x20]+', ' ', 'g')) AS clean_title, CASE WHEN length(title) > 60 THEN substr(title, 1, 60) || '...' ELSE title END AS short_title, regexp_replace(arxiv_id, '[^A-Za-z0-9_-]', '_', 'g') AS cache_key, coalesce(nullif(doi, ''), 'arxiv:' || nullif(arxiv_id, ''), substr(md5(title || ':' || trim(split_part(authors, ';', 1)) || ':' || year), 1, 16)) AS paper_id FROM papers")
def record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    return p.select("ord", X.clean_text(F.col("title")).alias("clean_title"), X.shortened(F.col("title"), 60).alias("short_title"), X.cache_key(F.col("arxiv_id")).alias("cache_key"), X.paper_id(F.col("doi"), F.col("arxiv_id"), F.col("title"), F.col("authors"), F.col("year")).alias("paper_id"))


@register(f"WITH {PAPERS}, k AS (SELECT *, row_number() OVER (PARTITION BY {DOI_KEY} ORDER BY {INFO} DESC, ord) AS r FROM papers) SELECT ord, {DOI_KEY} AS doi_key FROM k WHERE r = 1 OR {DOI_KEY} = ''")
def doi_dedup_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_doi(papers(spark, sf_dir)).select("ord", X.doi_key(F.col("doi")).alias("doi_key"))


@register(f"WITH {PAPERS}, k AS (SELECT *, row_number() OVER (PARTITION BY regexp_replace(arxiv_id, 'v[0-9]+$', '') ORDER BY ord) AS r FROM papers) SELECT ord, arxiv_id FROM k WHERE r = 1 OR arxiv_id = ''")
def arxiv_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_arxiv(papers(spark, sf_dir)).select("ord", "arxiv_id")


@register(f"""WITH {PAPERS}, a AS (SELECT *, row_number() OVER (PARTITION BY {DOI_KEY} ORDER BY {INFO} DESC, ord) AS r FROM papers),
b AS (SELECT * EXCLUDE r, row_number() OVER (PARTITION BY regexp_replace(arxiv_id, 'v[0-9]+$', '') ORDER BY ord) AS r FROM a WHERE r = 1 OR {DOI_KEY} = ''),
c AS (SELECT * EXCLUDE r, row_number() OVER (PARTITION BY url ORDER BY ord) AS r FROM b WHERE r = 1 OR arxiv_id = ''),
d AS (SELECT * EXCLUDE r, row_number() OVER (PARTITION BY {HASH} ORDER BY ord) AS r FROM c WHERE r = 1) SELECT ord, source_db FROM d WHERE r = 1""")
def dedup_method_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.chain(papers(spark, sf_dir), ["doi_exact", "arxiv_id_exact", "url_based", "content_hash"]).select("ord", "source_db")


@register(f"""WITH {PAPERS}, a AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY ord) AS r FROM papers WHERE doi <> ''),
b AS (SELECT *, row_number() OVER (PARTITION BY {LIGHT_KEY} ORDER BY year DESC, citations DESC, ord) AS r FROM papers WHERE doi = '' AND {LIGHT_KEY} <> '')
SELECT ord FROM a WHERE r = 1 UNION ALL SELECT ord FROM b WHERE r = 1""")
def chunked_title_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_light_title(papers(spark, sf_dir)).select("ord")


@register(f"WITH {PAPERS}, k AS (SELECT *, row_number() OVER (PARTITION BY coalesce(nullif(arxiv_id, ''), title || '_' || year) ORDER BY ord) AS r FROM papers) SELECT ord FROM k WHERE r = 1")
def source_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_source_key(papers(spark, sf_dir)).select("ord")


@register()
def fuzzy_title_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_similar_title(papers(spark, sf_dir)).select("ord", "title")


@register()
def similar_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_titles(papers(spark, sf_dir).select("ord", "title"), "The and attion to thanedble the, anea. Eriner thanea.", 0.5).select("ord", "title", "similarity")


INCLUDE, EXCLUDE = ("this", "with", "from"), ("clown",)
LOW = "lower(coalesce(title, '') || ' ' || coalesce(abstract, ''))"
_has = lambda text, words: " + ".join(f"contains({text}, '{w}')::INT" for w in words)


@register(f"WITH {PAPERS} SELECT source_db, count(*) AS n FROM papers WHERE abstract <> '' AND ({_has(LOW, EXCLUDE)}) = 0 AND ({_has(LOW, INCLUDE)}) >= 2 GROUP BY source_db")
def keyword_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counts(rules.by_keywords(papers(spark, sf_dir), INCLUDE, EXCLUDE, 2), "source_db")


@register(f"WITH {PAPERS} SELECT ord, year FROM papers WHERE trim(title) <> '' AND year BETWEEN 2020 AND 2023 AND length(abstract) > 50")
def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.valid(papers(spark, sf_dir), 2020, 2023).select("ord", "year")


RULES = {"junk": (("license",), ("!!", "$$$")), "surveys": (("with",), ("clown", "moron")), "german": ((), ("nicht",))}


@register(f"""WITH {PAPERS} SELECT ord, coalesce(CASE WHEN contains({LOW}, '!!') OR contains({LOW}, '$$$') THEN 'junk' END,
  CASE WHEN (contains({LOW}, 'clown') OR contains({LOW}, 'moron')) AND NOT contains({LOW}, 'with') THEN 'surveys' END, CASE WHEN contains({LOW}, 'nicht') THEN 'german' END) AS reason FROM papers""")
def disambiguation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.disambiguated(papers(spark, sf_dir), RULES, ("surveys",)).select("ord", "reason")


@register(f"""WITH {PAPERS}, d AS (SELECT *, CASE WHEN contains({LOW}, '!!') OR contains({LOW}, '$$$') THEN 'junk' WHEN (contains({LOW}, 'clown') OR contains({LOW}, 'moron')) AND NOT contains({LOW}, 'with') THEN 'surveys' WHEN contains({LOW}, 'nicht') THEN 'german' END AS reason FROM papers),
t AS (SELECT reason FROM d WHERE reason IS NOT NULL GROUP BY reason ORDER BY count(*) DESC, reason LIMIT 5),
e AS (SELECT reason, ord, title, row_number() OVER (PARTITION BY reason ORDER BY ord) AS place FROM d WHERE reason IN (FROM t)) SELECT reason, ord, title, place FROM e WHERE place <= 2""")
def disambiguation_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    excluded = rules.disambiguated(papers(spark, sf_dir), RULES, ("surveys",)).where("excluded")
    return metrics.examples(excluded, "reason", [F.col("ord")]).select("reason", "ord", "title", F.col("place").cast("long").alias("place"))


@register("SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url_key, contains(lower(url), 'spam-farm') OR contains(lower(url), 'blog.') AS grey_lit_flag FROM pages")
def grey_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = rules.grey_literature(table(spark, sf_dir, "pages").withColumn("source_db", F.lit("web")), ["spam-farm", "blog."])
    return flagged.select("page_id", X.url_key(F.col("url")).alias("url_key"), "grey_lit_flag")


STRONG, WEAK, MODEL = ("clown", "moron"), ("this", "with", "from", "nicht"), ("license", "that", "her", "pour")
_topic = f"(({_has(LOW, STRONG)}) > 0 OR ({_has(LOW, WEAK)}) >= 3)"
_other = f"(({_has(LOW, MODEL)}) >= 2)"
SCORE = f"least(10, CASE WHEN {_topic} AND {_other} THEN 9 WHEN {_topic} OR {_other} THEN 7 ELSE 3 END + (contains(lower(title), 'the'))::INT)"


@register(f"WITH {PAPERS}, s AS (SELECT ord, {SCORE} AS auto_relevance_score FROM papers) SELECT *, auto_relevance_score >= 6 AS auto_include, CASE WHEN auto_relevance_score >= 6 THEN 'score ' || auto_relevance_score ELSE 'below threshold' END AS auto_include_reason FROM s")
def auto_include_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = S.topic_score(F.col("title"), F.col("abstract"), STRONG, WEAK, MODEL, ("the",))
    return rules.auto_included(papers(spark, sf_dir), score).select("ord", "auto_relevance_score", "auto_include", "auto_include_reason")


PLAIN_FOUND = {"bias": ("stedness", "anlyer"), "hallucination": ("ingly", "from"), "jailbreak": ("clown",), "escalation": ("license",)}
TAGS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(abstract), '{'|'.join(p)}') THEN '{n}' END" for n, p in PLAIN_FOUND.items()) + "], lambda t: t IS NOT NULL)"


@register(f"WITH {PAPERS} SELECT ord, array_to_string({TAGS}, '|') AS tags FROM papers")
def failure_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select("ord", F.array_join(tagging.tags(F.col("abstract"), PLAIN_FOUND), "|").alias("tags"))


@register(f"""WITH {PAPERS}, t AS (SELECT {TAGS} AS tags FROM papers), e AS (SELECT unnest(tags) AS tag FROM t)
SELECT tag, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM t WHERE len(tags) > 0), 1) AS percentage FROM e GROUP BY tag""")
def tag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_summary(papers(spark, sf_dir).select(tagging.tags(F.col("abstract"), PLAIN_FOUND).alias("tags")), "tags")


BUCKET = "1 + (citations > e[1])::INT + (citations > e[2])::INT + (citations > e[3])::INT + (citations > e[4])::INT"
WORDS = ("this", "with", "for")
ORDER = " + ".join(f"2 * contains(lower(title), '{w}')::INT + contains(lower(abstract), '{w}')::INT" for w in WORDS) + " + greatest(0, 5 - (2025 - year))"


@register(f"""WITH {PAPERS}, q AS (SELECT quantile_cont(citations, [0.2, 0.4, 0.6, 0.8]) AS e FROM papers), s AS (SELECT ord, year, {BUCKET} AS bucket, {ORDER} + {BUCKET} AS score FROM papers, q)
SELECT ord, bucket::INT AS bucket, score::INT AS score, printf('SCREEN_%04d', row_number() OVER (ORDER BY score DESC, year DESC, ord)) AS screening_id FROM s""")
def screening_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = screening.bucketed(papers(spark, sf_dir), "citations")
    rows = rows.withColumn("score", screening.order_score(WORDS, 2025, F.col("bucket")))
    return screening.sheet(rows, [F.desc("score"), F.desc_nulls_last("year"), F.col("ord")]).select("ord", F.col("bucket").cast("int").alias("bucket"), F.col("score").cast("int").alias("score"), "screening_id")


@register(f"""WITH {PAPERS}, {SCREENED} SELECT 'decision' AS kind, coalesce(include_ta, 'unscreened') AS value, count(*) AS n FROM screened GROUP BY ALL
UNION ALL SELECT 'reason', reason_ta, count(*) FROM screened WHERE reason_ta IS NOT NULL GROUP BY ALL""")
def screening_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.statistics(screened(spark, sf_dir), "include_ta", "reason_ta")


@register(f"WITH {PAPERS}, {SCREENED} SELECT title, abstract, authors, year, doi, url, CASE include_ta WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE -1 END AS included FROM screened")
def asreview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.asreview(screened(spark, sf_dir))


@register(f"""WITH {PAPERS}, y AS (SELECT year, count(*) AS n, row_number() OVER (ORDER BY year) - 1 AS p FROM papers WHERE year > 0 GROUP BY year)
SELECT year, n, round(regr_slope(n, p) OVER (), 6) AS slope, round(regr_intercept(n, p) OVER () + regr_slope(n, p) OVER () * p, 6) AS fitted FROM y""")
def year_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.trend(papers(spark, sf_dir))


@register(f"WITH {PAPERS} SELECT lang, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM papers GROUP BY lang")
def lang_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.shares(papers(spark, sf_dir), "lang")


@register(f"WITH {PAPERS}, m AS (SELECT trim(unnest(string_split(authors, ';'))) AS value FROM papers) SELECT value, count(*) AS n FROM m WHERE value <> '' GROUP BY value ORDER BY n DESC, value LIMIT 10")
def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.top_members(papers(spark, sf_dir), "authors")


@register(f"WITH {PAPERS} SELECT source_db, count(citations) AS n, round(avg(citations), 6) AS mean, round(median(citations), 6) AS median, min(citations) AS least, max(citations) AS most FROM papers GROUP BY source_db")
def citation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.summary(papers(spark, sf_dir), "citations", "source_db")


@register(f"WITH {PAPERS} SELECT g.v::INT AS scale, count(p.ord) AS n FROM range(1, 8) g(v) LEFT JOIN papers p ON p.citations % 6 + 1 = g.v GROUP BY g.v")
def scale_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(papers(spark, sf_dir).withColumn("scale", F.col("citations") % 6 + 1), "scale", 1, 7)


@register(f"WITH {PAPERS} SELECT count(*) AS records, count(*) FILTER (abstract <> '') AS with_abstract, count(*) FILTER (doi <> '') AS with_doi, min(year) AS first_year, max(year) AS last_year, count(DISTINCT source_db) AS sources FROM papers")
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quality(papers(spark, sf_dir))


@register(f"WITH {PAPERS} SELECT lang, source_db, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM papers GROUP BY lang, source_db")
def lang_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cross_table(papers(spark, sf_dir), "lang", "source_db")


@register(f"WITH {LOG} SELECT module, level, count(*) AS n, round(avg(duration), 6) AS mean, max(duration) AS longest FROM log WHERE timestamp >= '2024-01-05' AND timestamp < '2030-01-01' GROUP BY module, level")
def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.log_summary(log(spark, sf_dir), "2024-01-05", "2030-01-01")


@register(f"WITH {LOG} SELECT id, module, level FROM log ORDER BY timestamp DESC, id LIMIT 100")
def log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).orderBy(F.desc("timestamp"), "id").limit(100).select("id", "module", "level")


@register(f"WITH {LOG} SELECT date_trunc('hour', timestamp) AS hour, level, count(*) AS n, round(sum(duration), 6) AS total FROM log GROUP BY ALL")
def log_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).groupBy(F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz").alias("hour"), "level").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("duration"), 6).alias("total"))


@register(f"WITH {LOG} SELECT (metadata->>'$.k')::INT AS k, count(*) AS n FROM log GROUP BY ALL")
def metadata_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counts(log(spark, sf_dir).select(S.json_or_raw(F.col("metadata"), "k int")["k"].alias("k")), "k")


@register(f"WITH {LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY module ORDER BY id DESC) AS r FROM log) SELECT module, id, duration FROM r WHERE r = 1")
def latest_per_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest(log(spark, sf_dir).select("module", "id", "duration").withColumn("at", F.col("id")), ["module"], "at").select("module", "id", "duration")


@register(f"""WITH {LOG} SELECT id, CASE WHEN contains(lower(message), 'success') THEN 'success' WHEN contains(lower(message), 'error') OR level = 'ERROR' THEN 'error'
  WHEN contains(lower(message), 'warning') OR level = 'WARNING' THEN 'warning' ELSE 'info' END AS status FROM log""")
def log_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).select("id", S.log_status(F.col("message"), F.col("level")).alias("status"))


@register(f"""WITH {PAPERS}, t AS (SELECT ord, CASE ord % 4 WHEN 0 THEN 'seminar' WHEN 1 THEN 'matrix game' WHEN 2 THEN 'Digital' ELSE 'other' END AS g, CASE ord % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'unknown' END AS q, CASE ord % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS o FROM papers),
b AS (SELECT *, CASE g WHEN 'seminar' THEN 2 WHEN 'matrix game' THEN 3 WHEN 'Digital' THEN 6 ELSE 4 END AS base FROM t),
c AS (SELECT *, greatest(1, least(7, base + CASE q WHEN 'yes' THEN 1 WHEN 'no' THEN -1 ELSE 0 END)) AS one FROM b)
SELECT ord, greatest(1, least(7, one + CASE o WHEN 'yes' THEN -1 WHEN 'no' THEN 1 ELSE 0 END))::INT AS awscale,
       round(least(1.0, 0.5 + 0.08 * (1 + (q <> 'unknown')::INT) + 0.03 * (o IS NOT NULL)::INT), 6)::DOUBLE AS confidence FROM c""")
def heuristic_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("ord")
    game = F.when(i % 4 == 0, "seminar").when(i % 4 == 1, "matrix game").when(i % 4 == 2, "Digital").otherwise("other")
    counted, opened = F.when(i % 3 == 0, "yes").when(i % 3 == 1, "no").otherwise("unknown"), F.when(i % 5 == 0, "yes").when(i % 5 == 1, "no")
    return papers(spark, sf_dir).select("ord", S.scale_estimate(game, counted, opened).cast("int").alias("awscale"), F.round(S.confidence([game, counted], [opened]), 6).alias("confidence"))


@register(f"WITH {PAPERS}, s AS (SELECT DISTINCT source_db FROM papers), w AS (SELECT source_db, greatest(100, 1000 * CASE source_db WHEN 'src0' THEN 0.35 WHEN 'src1' THEN 0.25 ELSE 0.2 END) AS q FROM s) SELECT source_db, (CASE WHEN sum(q) OVER () > 1000 THEN q * 1000 / sum(q) OVER () ELSE q END)::DECIMAL(20, 6)::VARCHAR.split_part('.', 1)::BIGINT AS quota FROM w")
def source_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quotas(papers(spark, sf_dir).select("source_db").distinct(), 1000, {"src0": 0.35, "src1": 0.25})


@register(f"WITH {PAPERS} SELECT ord FROM papers WHERE (contains({LOW}, 'this') OR regexp_matches({LOW}, 'inger[\\p{{L}}\\p{{N}}_-]*')) AND NOT contains({LOW}, 'clown') AND contains({LOW}, 'of the')")
def boolean_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(papers(spark, sf_dir), '(this OR inger*) AND "of the" NOT clown', "title", "abstract").select("ord")


@register()
def near_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(papers(spark, sf_dir), 'this NEAR/5 ("with" OR "from")', "title", "abstract").select("ord")


@register("SELECT b.item_id, count(d.doc_id) AS n FROM benchmark b LEFT JOIN (SELECT DISTINCT doc_id, lower(unnest(string_split(text, chr(10)))) AS line FROM documents) d ON d.line = lower(split_part(b.text, chr(10), 1)) GROUP BY b.item_id")
def seed_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many documents each benchmark item's first line is a line. Lines meet the seeds before anything is made distinct."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.lower("text"), "\n")).alias("line"))
    seeds = table(spark, sf_dir, "benchmark").select("item_id", F.lower(F.split("text", "\n", 2)[0]).alias("line"))
    hits = lines.join(seeds.select("line").distinct(), "line").distinct().groupBy("line").agg(F.count("doc_id").alias("n"))
    return seeds.join(hits, "line", "left").select("item_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


_part = lambda tag: f"nullif(regexp_extract(html, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1), '')"


@register(f"SELECT page_id, trim(regexp_replace(regexp_replace(coalesce({_part('main')}, {_part('article')}, html), '(?s)<[^>]+>', chr(10), 'g'), '\\s*\\n\\s*', chr(10), 'g'), ' ' || chr(10)) AS text FROM pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", records.plain_html(F.col("html")).alias("text"))


@register(f"""WITH {PAPERS} SELECT ord, round(least(1.0, 0.5 + least(0.3, 0.1 * ({_has('lower(title)', ('the', 'of'))})) + least(0.3, 0.1 * ({_has('lower(title)', ('with', 'from'))})) + least(0.2, 0.05 * ({_has('lower(title)', ('and', 'for'))})) + 0.1 * ({_has('lower(title)', ('this',))})), 6)::DOUBLE AS potential FROM papers""")
def query_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lower("title")
    return papers(spark, sf_dir).select("ord", F.round(S.query_potential(low, ("the", "of"), ("with", "from"), ("and", "for"), ("this",)), 6).alias("potential"))


@register(f"WITH {PAPERS}, k AS (SELECT *, {TITLE_KEY} AS k FROM papers) SELECT b.item_id, EXISTS (SELECT 1 FROM k WHERE k.k = s.k) AS found FROM benchmark b JOIN (SELECT item_id, {TITLE_KEY.replace('title', 't')} AS k FROM (SELECT item_id, split_part(text, chr(10), 1) AS t FROM benchmark)) s USING (item_id)")
def seed_titles_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", "\n", 2)[0].alias("title"))
    return records.coverage(seeds, papers(spark, sf_dir)).select("item_id", "found")


@register(f"WITH {PAPERS} SELECT DISTINCT {LIGHT_KEY} AS title_key FROM papers WHERE {LIGHT_KEY} <> ''")
def stream_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen titles of a stream over documents: as many as the batch finds."""
    folder = new_path(spark, "titles")
    schema = table(spark, sf_dir, "documents").schema
    stream = incremental.chunks(spark, f"{sf_dir}/documents.parquet*", schema).select(F.split("text", "\n", 2)[0].alias("title"))
    incremental.run_to_end(incremental.new_titles(stream).select("title_key"), f"{folder}/out", f"{folder}/state")
    return spark.read.schema("title_key string").parquet(f"{folder}/out")


_field = lambda name, column: f"CASE WHEN {column}::VARCHAR <> '' THEN '  {name} = {{' || regexp_replace({column}::VARCHAR, '([{{}}])', '\\\\\\1', 'g') || '}}' END"
CITE_KEY = "regexp_replace(list_last(string_split(trim(string_split(authors, ';')[1]), ' ')) || year || array_to_string(list_filter(regexp_split_to_array(title, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')[1:2], ''), '[^A-Za-z0-9]', '', 'g')"
_ENTRY = ", ".join((_field("title", "title"), "'  author = {' || regexp_replace(authors, ';\\s*', ' and ', 'g') || '}'", _field("year", "year"), _field("journal", "source_db"), _field("doi", "doi"), _field("url", "url"), _field("abstract", "abstract")))


@register(f"WITH {PAPERS} SELECT '@misc{{' || {CITE_KEY} || ',' || chr(10) || array_to_string(list_filter([{_ENTRY}], lambda x: x IS NOT NULL), ',' || chr(10)) || chr(10) || '}}' AS entry FROM papers")
def bibtex_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.bibtex(papers(spark, sf_dir).withColumn("venue", F.col("source_db")))


@register(f"WITH {LOG} SELECT module, count(*) AS sessions, sum(n)::BIGINT AS entries FROM (SELECT module, s, count(*) AS n FROM (SELECT module, sum(new::INT) OVER (PARTITION BY module ORDER BY timestamp, id) AS s FROM (SELECT *, coalesce(timestamp - lag(timestamp) OVER (PARTITION BY module ORDER BY timestamp, id) >= INTERVAL 30 MINUTE, true) AS new FROM log)) GROUP BY module, s) GROUP BY module")
def log_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.log_runs(log(spark, sf_dir))
