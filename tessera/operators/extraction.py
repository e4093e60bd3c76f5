"""Full text and structured extraction with pluggable providers."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scores as S
from tessera.functions import text as X
from tessera.operators.caching import older_than

# Fields of an extraction, and the fewest characters of a text worth reading.
REQUIRED = ("venue_type", "game_type", "open_ended", "quantitative", "llm_family", "llm_role")
OPTIONAL = ("eval_metrics", "failure_modes", "code_release")
LEAST_CHARS = 100

#: Text of a paper -> a JSON object, or None where it can't answer.
Provider = Callable[[str], str | None]


#: What the offline provider looks for: the first word of a field that the text has is its value.
WORDS = {"venue_type": ("conference", "journal", "workshop"), "game_type": ("seminar", "matrix", "digital"), "llm_family": ("gpt-4", "gpt", "claude", "llama", "palm", "bert"), "llm_role": ("player", "adjudicator", "analyst")}


def word_provider(words: Mapping[str, Sequence[str]] = WORDS) -> Provider:
    """Answers by plain word rules, always the same for a text."""

    def answer(text: str) -> str:
        low = text.lower()
        first = {field: next((w for w in those if w in low), "unknown") for field, those in words.items()}
        return json.dumps(first | {"open_ended": "yes" if "open-ended" in low else "no", "quantitative": "yes" if re.search(r"\d+(\.\d+)?\s*%", low) else "no"})

    return answer


def offline_provider(text: str) -> str:
    return word_provider()(text)


def first_answer(providers: Iterable[Provider]) -> Provider:
    """The first provider that answers; errors count as no answer."""
    chain = list(providers)

    def ask(text: str) -> str | None:
        for provider in chain:
            try:
                if (answer := provider(text)) is not None:
                    return answer
            except Exception:  # noqa: BLE001, S112 - a failing provider leaves the question to the next
                continue
        return None

    return ask


def best_text(tex: str = "tex", html: str = "html", pdf: str = "pdf") -> Column:
    """TeX before HTML before PDF text."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in (tex, html, pdf)])


def extract(df: DataFrame, text: Column, provider: Provider = offline_provider, scale: Provider | None = None) -> DataFrame:
    """df with the fields, awscale, extraction_status and extraction_confidence.

    scale: asked for the scale of texts whose fields were found; where its answer doesn't begin with 1 to 7, and without it, the scale is estimated.

    Status: pdf_not_found without a text, insufficient_text for a short one, llm_extraction_failed without an answer,
    error where the provider raises, success. Missing required fields become unknown.
    """

    def answer(text: str | None) -> tuple[str | None, bool]:
        if text is None or len(text) < LEAST_CHARS:
            return None, False
        try:
            return provider(text), False
        except Exception:  # noqa: BLE001 - one text's error is its status, not the task's end
            return None, True

    def rating(text: str) -> str | None:
        try:
            return scale(text) if scale else None
        except Exception:  # noqa: BLE001 - then the scale is estimated
            return None

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            answers = [answer(t) for t in texts]
            rated = [rating(t) if a is not None else None for t, (a, _) in zip(texts, answers, strict=True)]
            columns = [pa.array([a for a, _ in answers], pa.string()), pa.array([e for _, e in answers], pa.bool_()), pa.array(rated, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "__answer", "__failed", "__rating"])

    rows = df.withColumn("__text", X.context(text))
    asked = rows.mapInArrow(ask, T.StructType([*rows.schema.fields, T.StructField("__answer", T.StringType()), T.StructField("__failed", T.BooleanType()), T.StructField("__rating", T.StringType())]))
    fields = S.json_or_raw(F.col("__answer"), ", ".join(f"{c} string" for c in (*REQUIRED, *OPTIONAL)))
    out = asked.withColumn("__f", fields)
    out = out.withColumns({c: F.coalesce(F.nullif(F.col(f"__f.{c}"), F.lit("")), F.lit("unknown")) for c in REQUIRED} | {c: F.col(f"__f.{c}") for c in OPTIONAL})
    out = out.withColumns({c: S.yes_no(F.col(c)) for c in ("open_ended", "quantitative")})
    status = F.when(F.col("__text").isNull(), "pdf_not_found").when(F.length("__text") < LEAST_CHARS, "insufficient_text").when(F.col("__failed"), "error").when(F.col("__answer").isNull(), "llm_extraction_failed").otherwise("success")
    good = F.col("extraction_status") == "success"
    out = out.withColumn("extraction_status", status)
    out = out.withColumn("awscale", F.when(good, scale_by_answer(F.col("__rating"), S.scale_estimate(F.col("game_type"), F.col("quantitative"), F.col("open_ended")))))
    out = out.withColumn("extraction_confidence", F.when(good, S.confidence([F.col(c) for c in REQUIRED], [F.col(c) for c in OPTIONAL])).otherwise(0.0))
    return out.drop("__text", "__answer", "__failed", "__rating", "__f")


def pdf_location() -> Column:
    """Where to fetch a PDF from: pdf_url, else arXiv, else a DOI lookup, else a URL that ends in .pdf. A branch that is present is the only one."""
    some = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return (
        F.when(some("pdf_url"), F.struct(F.lit("direct").alias("kind"), F.col("pdf_url").alias("at")))
        .when(some("arxiv_id"), F.struct(F.lit("arxiv").alias("kind"), F.concat(F.lit("https://arxiv.org/pdf/"), F.col("arxiv_id"), F.lit(".pdf")).alias("at")))
        .when(some("doi"), F.struct(F.lit("unpaywall").alias("kind"), X.doi_key(F.col("doi")).alias("at")))
        .when(F.lower("url").endswith(".pdf"), F.struct(F.lit("direct").alias("kind"), F.col("url").alias("at")))
    )


def extract_one(spark: SparkSession, text: str, provider: Provider = offline_provider) -> DataFrame:
    """The extraction of a single text, one row."""
    return extract(spark.createDataFrame([(text,)], "text string"), F.col("text"), provider)


def scale_by_answer(answer: Column, otherwise: Column) -> Column:
    """The scale as an answer's first character gives it, 1 to 7, else the estimate."""
    digit = F.substring(F.trim(answer), 1, 1).try_cast("int")
    return F.when(digit.between(1, 7), digit).otherwise(otherwise)


def missing(wanted: DataFrame, cache: DataFrame, days: int = 90) -> DataFrame:
    """Wanted (paper_id, content_type) without a cache entry that is young enough."""
    return wanted.join(cache.where(~older_than("created_at", days)), ["paper_id", "content_type"], "left_anti")


def binary_files(spark, path: str) -> DataFrame:  # noqa: ANN001
    """Files with their SHA-256 and MD5 and whether they begin as PDFs do."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"), (F.substring("content", 1, 5) == F.lit(b"%PDF-")).alias("is_pdf"))
