"""Harvests from saved payloads: mappings, capped and split searches, paging, several sources at once, files and databases.

Nothing here talks to a remote service; a caller that does passes a function that fetches.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sqlite3
import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.functions import scores as S
from tessera.functions import text as X
from tessera.operators import dedup, search
from tessera.sources.records import RECORD, conformed, months
from tessera.storage import written

# ---- mappings


def from_arxiv(payload: DataFrame, column: str = "xml") -> DataFrame:
    """Records of arXiv's Atom feeds, one feed a row; entries without a title are left out.

    The id keeps its version (see functions.text.arxiv_parts); categories are keywords, the journal reference is the venue.
    """
    entry = "struct<id: string, title: string, summary: string, published: string, author: array<struct<name: string>>, category: array<struct<_term: string>>, doi: string, journal_ref: string, link: array<struct<_href: string, _title: string>>>"
    feed = F.from_xml(F.col(column), f"struct<entry: array<{entry}>>", {"ignoreNamespace": "true"})
    rows = payload.select(F.explode(feed["entry"]).alias("e")).select("e.*").where(F.coalesce(F.trim("title"), F.lit("")) != "")
    pdf = F.get(F.filter("link", lambda x: x["_title"] == "pdf"), F.lit(0))["_href"]
    return conformed(rows.select(
        X.clean_text(F.col("title")).alias("title"), F.array_join(F.transform("author", lambda a: a["name"]), "; ").alias("authors"), F.coalesce(F.substring("published", 1, 4).try_cast("int"), F.lit(0)).alias("year"),
        X.clean_text(F.col("summary")).alias("abstract"), F.lit("arxiv").alias("source_db"), F.col("id").alias("url"), "doi", F.element_at(F.split("id", "/"), -1).alias("arxiv_id"), F.col("journal_ref").alias("venue"),
        F.when(pdf.endswith(".pdf"), pdf).otherwise(F.concat(pdf, F.lit(".pdf"))).alias("pdf_url"), F.array_join(F.transform("category", lambda c: c["_term"]), "; ").alias("keywords"), F.to_date(F.substring("published", 1, 10)).alias("published"),
    ))


def from_scholar(payload: DataFrame, column: str = "json") -> DataFrame:
    """Records of saved Scholar results, one a row. Authors are a list or one text joined by "and"; a DOI is sought in the abstract, an arXiv id in the e-print's URL."""
    schema = "struct<bib: struct<title: string, author: string, pub_year: string, abstract: string, venue: string>, description: string, pub_url: string, eprint_url: string, num_citations: bigint>"
    rows = payload.select(F.from_json(column, schema).alias("r")).select("r.*", "r.bib.*").where(F.coalesce("title", F.lit("")) != "")
    names = F.coalesce(F.from_json(F.when(F.col("author").startswith("["), F.col("author")), "array<string>"), F.transform(F.split("author", " and "), lambda a: F.trim(a)))
    abstract = F.coalesce(F.nullif("abstract", F.lit("")), F.col("description"))
    arxiv = F.nullif(F.regexp_extract(F.coalesce("eprint_url", F.lit("")), r"arxiv\.org/(?:abs|pdf)/(\d+\.\d+)", 1), F.lit(""))
    return conformed(rows.select(
        X.clean_text(F.col("title")).alias("title"), F.array_join(names, "; ").alias("authors"), X.year_or_zero(F.col("pub_year")).alias("year"), X.clean_text(abstract).alias("abstract"), F.lit("google_scholar").alias("source_db"),
        F.coalesce("pub_url", "eprint_url").alias("url"), "venue", F.coalesce("num_citations", F.lit(0)).alias("citations"), X.first_doi(abstract).alias("doi"), arxiv.alias("arxiv_id"),
        F.when(arxiv.isNotNull(), F.concat(F.lit("https://arxiv.org/pdf/"), arxiv, F.lit(".pdf"))).alias("pdf_url"),
    ))


# ---- searches


def split_search(df: DataFrame, split: str, order: Sequence[Column], most: int = 100, per_split: int = 100) -> DataFrame:
    """At most per_split rows of each split, splits in order until most rows are found, then the first of each record (see dedup.by_source_key).

    The rank is limited on the map side; where a split begins in the whole comes from one small row per split.
    """
    ranked = df.where(F.col(split).isNotNull()).withColumn("__r", F.row_number().over(Window.partitionBy(split).orderBy(*order))).where(F.col("__r") <= per_split)
    ranked = written(ranked, "split-search")
    sizes = ranked.groupBy(split).agg(F.count(F.lit(1)).alias("__n"))  # a row per split
    starts = sizes.select(split, F.coalesce(F.sum("__n").over(Window.orderBy(split).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    found = ranked.join(starts, split).where(F.col("__start") + F.col("__r") <= most)
    return dedup.by_source_key(found.drop("__r", "__start"))


def month_split(df: DataFrame, date: str, order: Sequence[Column], first: str, last: str, most: int = 100, per_month: int = 100) -> DataFrame:
    """split_search by the months of a range, none of them after today."""
    spans = F.broadcast(months(df.sparkSession, first, last).select(F.substring("from", 1, 6).alias("__month")))  # a row per month
    return split_search(df.withColumn("__month", F.date_format(date, "yyyyMM")).join(spans, "__month"), "__month", order, most, per_month).drop("__month")


def category_split(df: DataFrame, categories: Sequence[str], order: Sequence[Column], most: int = 100, per_category: int = 100) -> DataFrame:
    """split_search by categories, in the order given; a record stands under each of its categories."""
    named = F.array(*map(F.lit, categories))
    rows = df.withColumn("__category", F.explode(F.array_intersect(F.transform(F.split("keywords", ";"), lambda k: F.trim(k)), named))).withColumn("__at", F.array_position(named, F.col("__category")))
    return split_search(rows, "__at", order, most, per_category).drop("__category", "__at")


def in_category(df: DataFrame, category: str) -> DataFrame:
    return df.where(F.array_contains(F.transform(F.split(F.coalesce("keywords", F.lit("")), ";"), lambda k: F.trim(k)), category))


def page(df: DataFrame, order: Sequence[Column], start: int, rows: int) -> DataFrame:
    """Rows start to start + rows of an order that makes them unique."""
    return df.orderBy(*order).offset(start).limit(rows)


def lookup(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def doi_exists(df: DataFrame, doi: str) -> bool:
    return not df.where(X.doi_key(F.col("doi")) == X.doi_key(F.lit(doi))).isEmpty()


def advanced_search(df: DataFrame, query: str, title: str | None = None, author: str | None = None, first: int | None = None, last: int | None = None, most: int = 100) -> DataFrame:
    """A query with a title and an author; years are filtered before the cap."""
    found = search.search(df, query, "title", "abstract")
    for column, part in (("title", title), ("authors", author)):
        found = found.where(F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(part.lower()))) if part else found
    found = found.where(F.col("year") >= first) if first else found
    found = found.where(F.col("year") <= last) if last else found
    return found.orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("citations"), "title").limit(most)


def arxiv_search(df: DataFrame, query: str, date: str, first: int, last: int, order: Sequence[Column], most: int = 100, per_month: int = 100) -> DataFrame:
    """A query by months of the years first to last, at most per_month of a month and most of all; the first of each record."""
    found = search.search(df, query, "title", "abstract")
    return month_split(found, date, order, f"{first}-01-01", f"{last}-12-31", most, per_month).where(F.col("year").between(first, last))


def capped_search(df: DataFrame, query: str, first: int, last: int, order: Sequence[Column], most: int = 100) -> DataFrame:
    """The first rows of a query's result, of these the ones of the years first to last."""
    return search.search(df, query, "title", "abstract").orderBy(*order).limit(most).where(F.col("year").between(first, last))


def paged(fetch: Callable[[int, int], Sequence], most: int, rows: int = 100, total: int | None = None) -> Iterator:
    """Results of fetch(offset, rows) page by page, up to most; a short page is the last, and so is the one that reaches total."""
    at = 0
    while at < most and (total is None or at < total):
        wanted = min(rows, most - at)
        got = list(fetch(at, wanted))
        yield from got[:wanted]
        at += len(got)
        if len(got) < wanted:
            return


# ---- several sources

#: A source: a query and a cap -> records.
Source = Callable[[str, int], DataFrame]


def fan_out(spark: SparkSession, sources: Mapping[str, Source], query: str, most: int = 100, workers: int = 4) -> tuple[DataFrame, dict[str, str]]:
    """All sources' records, newest and most cited first, at most so many of each; and the failures by source.

    Each source is read to its end by itself, so that one that fails adds nothing and costs nobody else's records.
    """

    def one(name: str) -> tuple[str, DataFrame | None, str | None]:
        try:
            return name, written(conformed(sources[name](query, most).limit(most)).withColumn("source_db", F.coalesce("source_db", F.lit(name))), "harvest"), None
        except Exception as e:  # noqa: BLE001 - whatever a source does wrong is its own failure
            return name, None, f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max(1, workers)) as pool:
        done = list(pool.map(one, sources))
    frames = [df for _, df, _ in done if df is not None] or [spark.createDataFrame([], RECORD)]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("citations"), "title"), {name: e for name, _, e in done if e}


def with_secondary(spark: SparkSession, sources: Mapping[str, Source], query: str, secondary: Iterable[str], most: int = 100, scholar: str = "google_scholar") -> tuple[DataFrame, list[dict[str, str]]]:
    """fan_out of the query and of secondary ones: those with site: or filetype: go to Scholar alone, others to all sources at half the cap."""
    out, failed = fan_out(spark, sources, query, most)
    failures = [failed]
    for other in secondary:
        special = "site:" in other or "filetype:" in other
        chosen = {k: v for k, v in sources.items() if k == scholar} if special else sources
        if chosen:
            more, failed = fan_out(spark, chosen, other, most if special else most // 2)
            out, failures = out.unionByName(more, allowMissingColumns=True), [*failures, failed]
    return out.orderBy(F.desc_nulls_last("year"), F.desc_nulls_last("citations"), "title"), failures


RETRYABLE = ("rate_limit", "timeout", "connection_error", "server_error")


def error_class(message: str) -> str:
    """functions.scores.error_class for the driver's own errors."""
    low = message.lower()
    named = (("rate_limit", ("rate limit", "too many requests", "429")), ("timeout", ("timeout", "timed out")), ("connection_error", ("connection", "network")), ("server_error", ("500", "502", "503", "504")))
    return next((kind for kind, words in named if any(w in low for w in words)), "unknown")


def retried(fetch: Callable, retries: int = 5, base: float = 2.0, longest: float = 300.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """fetch, again after base ** attempt seconds (at most longest) where an error is worth it."""

    def call(*args: object, **kwargs: object) -> object:
        for attempt in range(retries + 1):
            try:
                return fetch(*args, **kwargs)
            except Exception as e:  # noqa: BLE001, PERF203
                if attempt == retries or error_class(str(e)) not in RETRYABLE:
                    raise
                sleep(min(base**attempt, longest))
        raise AssertionError

    return call


def session_harvest(spark: SparkSession, source: str, run: Source, queries: Sequence[str], quota: int, table: str, session: str) -> DataFrame:
    """A source's queries until its quota is full. Finished queries are kept in table, by session, source and hash, so that a second run reads them instead of asking again."""
    out, found = [], 0
    for query in queries:
        if found >= quota:
            break
        path = f"{table}/session={session}/source={source}/query={_hash(query)}"
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")  # noqa: SLF001
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):  # noqa: SLF001
            conformed(run(query, quota - found).limit(quota - found)).write.mode("overwrite").parquet(path)
        got = spark.read.parquet(path)
        found += got.count()
        out.append(got)
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], RECORD)


def _hash(query: str) -> str:
    return hashlib.md5(query.encode(), usedforsecurity=False).hexdigest()[:12]


# ---- documents

# What the beginning of a TeX source has.
TEX_MARKS = (r"\documentclass", r"\begin{document}", r"\section", r"\title")


def is_tex(content: Column) -> Column:
    """Whether the first 1000 bytes hold a TeX mark."""
    head = F.decode(F.substring(content, 1, 1000), "ISO-8859-1")
    return reduce(lambda a, b: a | b, [F.contains(head, F.lit(m)) for m in TEX_MARKS])


def is_html(status: Column, content_type: Column) -> Column:
    return (status == 200) & F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text/html"))


#: URL -> status, content type, content; None where there is nothing.
Fetcher = Callable[[str], tuple[int, str, bytes] | None]


def fetched(df: DataFrame, url: str, fetcher: Fetcher, accepted: str = "pdf", most_bytes: int = 50 << 20) -> DataFrame:
    """df with content and fetch_status: downloaded, no_url, failed, wrong_type or too_large. One row's failure is its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in batch.column(batch.schema.get_field_index(url)).to_pylist():
                try:
                    got = fetcher(at) if at else None
                except Exception:  # noqa: BLE001
                    got = None
                if not at or got is None or got[0] != 200:
                    out.append((None, "failed" if at else "no_url"))
                elif accepted not in got[1].lower():
                    out.append((None, "wrong_type"))
                else:
                    out.append((None, "too_large") if len(got[2]) > most_bytes else (got[2], "downloaded"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c for c, _ in out], pa.binary()), pa.array([s for _, s in out], pa.string())], names=[*batch.schema.names, "content", "fetch_status"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("fetch_status", T.StringType())]))


def version_urls(arxiv_id: Column, latest: int = 3) -> Column:
    """PDF URLs of an id's versions, the named one first and down to 1, then the latest without a number. Ids without a version begin at latest."""
    bare, version = X.arxiv_parts(arxiv_id)
    numbered = F.transform(F.sequence(F.coalesce(version, F.lit(latest)), F.lit(1), F.lit(-1)), lambda v: F.concat(F.lit("https://arxiv.org/pdf/"), bare, F.lit("v"), v.cast("string"), F.lit(".pdf")))
    return F.concat(numbered, F.array(F.concat(F.lit("https://arxiv.org/pdf/"), bare, F.lit(".pdf"))))


def from_unpaywall(payload: DataFrame, column: str = "json") -> DataFrame:
    """doi, pdf_url: the best open location's PDF, else the first location's that has one."""
    place = "struct<url_for_pdf: string>"
    rows = payload.select(F.from_json(column, f"struct<doi: string, best_oa_location: {place}, oa_locations: array<{place}>>").alias("r")).select("r.*")
    other = F.get(F.filter(F.transform("oa_locations", lambda x: x["url_for_pdf"]), lambda u: u.isNotNull()), F.lit(0))
    return rows.select("doi", F.coalesce("best_oa_location.url_for_pdf", other).alias("pdf_url"))


# ---- files, databases, configuration


def latest_file(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """The file of a folder that was changed last; only names and times are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "modificationTime")
    row = files.orderBy(F.desc("modificationTime"), F.desc("path")).limit(1).first()
    return row["path"] if row else None


class SqliteSource(DataSource):
    """A table of an SQLite file, which executors reach by its path, in ranges of rowid. Options: path, table, partitions."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        kinds = {"INT": "bigint", "INTEGER": "bigint", "REAL": "double", "BLOB": "binary"}
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            columns = db.execute("SELECT name, upper(type) FROM pragma_table_info(?)", (self.options["table"],)).fetchall()
        return ", ".join(f"`{name}` {kinds.get(kind, 'string')}" for name, kind in columns)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SqliteReader(dict(self.options), schema)


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.path, self.table, self.n, self.types = options["path"], options["table"].replace('"', '""'), int(options.get("partitions", 4)), [f.dataType for f in schema]

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            first, last = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()  # noqa: S608
        if first is None:
            return [InputPartition((0, 0))]
        step = max(1, -(-(last - first + 1) // self.n))
        return [InputPartition((at, min(at + step, last + 1))) for at in range(first, last + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for row in db.execute(f'SELECT * FROM "{self.table}" WHERE rowid >= ? AND rowid < ?', partition.value):  # noqa: S608
                yield tuple(str(v) if isinstance(kind, T.StringType) and v is not None else v for v, kind in zip(row, self.types, strict=True))


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 4) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").option("path", path).option("table", table).option("partitions", partitions).load()


def with_environment(value: object, environment: Mapping[str, str] = os.environ) -> object:
    """Texts of a nested configuration with ${NAME} replaced; a name that is not set stays as it is."""
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: environment.get(m[1], m[0]), value)
    if isinstance(value, Mapping):
        return {k: with_environment(v, environment) for k, v in value.items()}
    return [with_environment(v, environment) for v in value] if isinstance(value, list) else value


def read_config(path: str, environment: Mapping[str, str] = os.environ) -> dict:
    """A JSON or, where a YAML reader is installed, YAML file on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return with_environment(json.loads(text), environment)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs a YAML package; JSON needs none") from e
    return with_environment(yaml.safe_load(text) or {}, environment)


def config_hash(config: Mapping, chars: int = 8) -> str:
    return hashlib.md5(json.dumps(config, sort_keys=True, default=str).encode(), usedforsecurity=False).hexdigest()[:chars]


# ---- models


# Anthropic's model where another provider's is named.
ANTHROPIC_DEFAULT = "claude-3-sonnet-20240229"


def model_string(provider: str, model: str) -> str:
    """A model's name with the prefix by which a router knows its provider."""
    prefix = {"google": "vertex_ai/", "together": "together_ai/"}.get(provider, "")
    if provider == "anthropic":
        return model if "claude" in model else ANTHROPIC_DEFAULT
    return model if not prefix or prefix in model else prefix + model


# What a provider falls back to.
FALLBACKS = {"openai": "gpt-3.5-turbo", "anthropic": "claude-3-haiku-20240307", "google": "gemini-pro", "together": "Qwen/Qwen2.5-72B-Instruct-Turbo"}


def fallback_model(provider: str) -> str:
    return FALLBACKS.get(provider, S.PRICED_AS)
