"""Readers and writers of bibliographic records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scores as S
from tessera.functions import text as X

#: The columns of a harvested record; lists are "; "-joined on disk.
RECORD = T.StructType([T.StructField(n, t) for n, t in (
    ("title", T.StringType()), ("authors", T.StringType()), ("year", T.IntegerType()), ("abstract", T.StringType()), ("source_db", T.StringType()), ("url", T.StringType()),
    ("doi", T.StringType()), ("arxiv_id", T.StringType()), ("venue", T.StringType()), ("citations", T.LongType()), ("pdf_url", T.StringType()), ("keywords", T.StringType()),
)])


def nulled(df: DataFrame) -> DataFrame:
    """Blank strings as null, which is the rule inside the engine."""
    return df.select(*[F.when(F.trim(F.col(f.name)) != "", F.col(f.name)).alias(f.name) if f.dataType == T.StringType() else F.col(f.name) for f in df.schema])


def conformed(df: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """df with the schema's columns, missing ones null, then its others."""
    have = set(df.columns)
    rest = [c for c in df.columns if c not in schema.names]
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema], *rest)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """A CSV file with a header, quoted fields over several lines included; columns go by name."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return nulled(conformed(raw, schema))


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Lists "; "-joined, null as an empty field."""
    flat = df.select(*[F.array_join(f.name, "; ").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in df.schema])
    (flat.coalesce(1) if single else flat).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def union(sources: Sequence[DataFrame]) -> DataFrame:
    """All records of all sources, newest and most cited first; a source without records adds none."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources).orderBy(F.desc("year"), F.desc("citations"), "title")


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file with an array seed_papers."""
    schema = "seed_papers array<struct<title: string, authors: array<string>, year: int, venue: string, doi: string, arxiv_id: string, url: string, abstract: string>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.inline("seed_papers"))
    return rows.withColumn("authors", F.array_join("authors", "; "))


def months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """First and last day of each month of a range as YYYYMMDD, the last one not after today."""
    day = F.explode(F.sequence(F.lit(first).cast("date"), F.least(F.lit(last).cast("date"), F.current_date()), F.expr("interval 1 month")))
    return spark.range(1).select(day.alias("d")).select(F.date_format("d", "yyyyMMdd").alias("from"), F.date_format(F.least(F.last_day("d"), F.current_date()), "yyyyMMdd").alias("to"))


def from_crossref(payload: DataFrame, column: str = "json") -> DataFrame:
    """Records of Crossref responses, one response a row."""
    date = "struct<`date-parts`: array<array<int>>>"
    item = f"struct<DOI: string, title: array<string>, author: array<struct<given: string, family: string>>, abstract: string, URL: string, type: string, `container-title`: array<string>, `is-referenced-by-count`: bigint, link: array<struct<URL: string, `content-type`: string>>, `published-print`: {date}, `published-online`: {date}>"
    items = payload.select(F.inline(F.from_json(column, f"struct<message: struct<items: array<{item}>>>")["message"]["items"]))
    year = F.coalesce(F.col("published-print")["date-parts"][0][0], F.col("published-online")["date-parts"][0][0], F.lit(0))
    pdf = F.filter("link", lambda x: x["content-type"] == "application/pdf")
    names = F.transform("author", lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"])))
    return conformed(items.select(
        F.get("title", F.lit(0)).alias("title"), F.array_join(names, "; ").alias("authors"), year.alias("year"), F.regexp_replace("abstract", "<[^>]+>", "").alias("abstract"), F.lit("crossref").alias("source_db"), F.col("URL").alias("url"),
        F.col("DOI").alias("doi"), F.get("container-title", F.lit(0)).alias("venue"), F.col("is-referenced-by-count").alias("citations"), F.get(pdf, F.lit(0))["URL"].alias("pdf_url"), F.col("type").alias("keywords"),
    ))


def from_semantic_scholar(payload: DataFrame, column: str = "json") -> DataFrame:
    item = "struct<paperId: string, title: string, abstract: string, authors: array<struct<name: string>>, year: int, venue: string, citationCount: bigint, url: string, externalIds: struct<DOI: string, ArXiv: string>, publicationTypes: array<string>>"
    items = payload.select(F.inline(F.from_json(column, f"struct<data: array<{item}>>")["data"]))
    arxiv = F.col("externalIds")["ArXiv"]
    return conformed(items.select(
        "title", F.array_join(F.transform("authors", lambda a: a["name"]), "; ").alias("authors"), F.coalesce("year", F.lit(0)).alias("year"), "abstract", F.lit("semantic_scholar").alias("source_db"), "url", F.col("externalIds")["DOI"].alias("doi"),
        arxiv.alias("arxiv_id"), "venue", F.col("citationCount").alias("citations"), F.when(arxiv.isNotNull(), F.concat(F.lit("https://arxiv.org/pdf/"), arxiv, F.lit(".pdf"))).alias("pdf_url"), F.array_join("publicationTypes", "; ").alias("keywords"),
    ))


def bibtex(df: DataFrame, *keep: str) -> DataFrame:
    """One entry per row, column entry, after the columns to keep; fields without a value are left out."""
    present = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    last = F.element_at(F.split(F.trim(F.element_at(F.split(F.coalesce("authors", F.lit("unknown")), ";"), 1)), " "), -1)
    words = F.array_join(F.slice(F.filter(F.split(F.coalesce("title", F.lit("")), r"\s+"), lambda w: w != ""), 1, 2), "")
    key = F.regexp_replace(F.concat(last, F.coalesce(F.col("year").cast("string"), F.lit("")), words), "[^A-Za-z0-9]", "")
    fields = [F.when(present(c), F.concat(F.lit(f"  {name} = {{"), F.regexp_replace(F.col(c).cast("string"), r"([{}])", r"\\$1"), F.lit("}"))) for c, name in (("title", "title"), ("authors", "author"), ("year", "year"), ("venue", "journal"), ("doi", "doi"), ("url", "url"), ("abstract", "abstract"))]
    fields[1] = F.when(present("authors"), F.concat(F.lit("  author = {"), F.regexp_replace("authors", ";\\s*", " and "), F.lit("}")))
    kind = S.citation_type(F.col("venue_type")) if "venue_type" in df.columns else F.lit("misc")
    return df.select(*keep, F.concat(F.lit("@"), kind, F.lit("{"), key, F.lit(",\n"), F.array_join(F.array_compact(F.array(*fields)), ",\n"), F.lit("\n}")).alias("entry"))


def coverage(seed: DataFrame, corpus: DataFrame) -> DataFrame:
    """seed with found: its title key is one of the corpus'."""
    keys = corpus.select(X.title_key(F.col("title")).alias("__key")).distinct().withColumn("__hit", F.lit(True))
    return seed.withColumn("__key", X.title_key(F.col("title"))).join(keys, "__key", "left").withColumn("found", F.coalesce("__hit", F.lit(False))).drop("__key", "__hit")


def plain_html(html: Column) -> Column:
    """Text of main, else article, else all, without tags; tags become line breaks."""
    part = lambda tag: F.nullif(F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1), F.lit(""))
    return F.btrim(F.regexp_replace(F.regexp_replace(F.coalesce(part("main"), part("article"), html), r"(?s)<[^>]+>", "\n"), r"\s*\n\s*", "\n"), F.lit(" \n"))


def clean_tex(tex: Column) -> Column:
    """Bodies of a TeX source's sections under ## titles, without comments, markup, citations, labels and floats; what stands outside sections goes."""
    out = F.regexp_replace(tex, r"(?m)(?<!\\)%.*$", "")
    for pattern, by in (
        (r"\\(?:textbf|textit|emph)\{([^{}]+)\}", "$1"), (r"\\cite[a-z]*\*?(?:\[[^\]]*\])*\{[^{}]+\}", "[citation]"), (r"\\ref\{[^{}]+\}", "[ref]"), (r"\\label\{[^{}]+\}", ""),
        (r"(?s)\\begin\{(equation|figure|table)\*?\}.*?\\end\{\1\*?\}", "[$1]"),
    ):
        out = F.regexp_replace(out, pattern, by)
    section = F.lit(r"(?s)\\section\*?\{([^}]+)\}(.*?)(?=\\section|\\end\{document\}|\z)")
    titles, bodies = (F.regexp_extract_all(out, section, F.lit(i)) for i in (1, 2))
    blank = F.lit(" \t\n\x0b\x0c\r")
    return F.array_join(F.zip_with(titles, bodies, lambda t, b: F.concat(F.lit("\n## "), t, F.lit("\n\n"), F.btrim(b, blank))), "\n")
