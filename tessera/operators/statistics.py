"""Reports as tables of kind, value and count, read in one pass, and the bookkeeping of harvests, jobs, queries and caches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import numbered

from tessera.functions import scores as S
from tessera.storage import written

MB = 1024 * 1024


def profile(df: DataFrame, columns: Mapping[str, Column], lists: Mapping[str, Column] | None = None, most: Mapping[str, int] | None = None) -> DataFrame:
    """kind, value, n: how often each value occurs, for all kinds in one scan and one aggregation.

    columns: one value a row; lists: an array a row, whose members are trimmed. Null and empty values are left out.
    most: kinds of which only the most frequent values stay, ties by value.
    """
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    single = [F.array(pair(k, c)) for k, c in columns.items()]
    each = lambda kind, values: F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: pair(kind, F.trim(v)))
    many = [each(k, c) for k, c in (lists or {}).items()]
    members = df.select(F.explode(F.concat(*single, *many)).alias("m")).select("m.kind", "m.value").where("value is not null and value <> ''")
    counted = members.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    if not most:
        return counted
    counted = written(counted, "profile")  # so that the kinds that are cut don't scan again
    out = counted.where(~F.col("kind").isin(*most))
    for kind, limit in most.items():
        out = out.unionByName(counted.where(F.col("kind") == kind).orderBy(F.desc("n"), "value").limit(limit))
    return out


def _modes(column: str) -> Column:
    return F.split(F.col(column), r"\|")


def paper_statistics(df: DataFrame) -> DataFrame:
    """Records, years, sources, and the ten most frequent venues and authors."""
    return profile(df, {"total": F.lit("all"), "year": F.col("year"), "source": F.col("source_db"), "venue": F.col("venue")}, {"author": F.split("authors", ";")}, {"venue": 10, "author": 10})


def extraction_statistics(df: DataFrame, families: int = 10, modes: int | None = None) -> DataFrame:
    """Records by extraction status, venue, game, model family, failure mode, scale and whether code is available."""
    code = F.when(S.code_available(F.col("code_release")), "available").otherwise("not_available")
    kinds = {"total": F.lit("all"), "status": F.col("extraction_status"), "venue_type": F.col("venue_type"), "game_type": F.col("game_type"), "llm_family": F.col("llm_family"), "awscale": F.col("awscale"), "code": code}
    return profile(df, kinds, {"failure_mode": _modes("failure_modes")}, {"llm_family": families} | ({"failure_mode": modes} if modes else {}))


def extraction_rate(df: DataFrame) -> DataFrame:
    """One row: records, extracted ones and their percentage."""
    return df.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("extraction_status") == "success").alias("extracted")).withColumn("rate", F.round(100 * F.col("extracted") / F.greatest(F.lit(1), F.col("records")), 1))


def export_summary(df: DataFrame) -> DataFrame:
    """One row: records, with a file, extracted, with failure modes, different model families."""
    fetched = F.col("pdf_status").startswith("downloaded") | F.col("pdf_status").startswith("cached")
    return df.agg(
        F.count(F.lit(1)).alias("papers"), F.count_if(fetched).alias("with_pdf"), F.count_if(F.col("extraction_status") == "success").alias("extracted"),
        F.count_if(F.coalesce(F.col("failure_modes"), F.lit("")) != "").alias("with_failure_modes"), F.countDistinct("llm_family").alias("llm_families"),
    )


def package_metadata(df: DataFrame) -> DataFrame:
    """One row of a package's totals, years and quality."""
    some = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    rate = F.avg((F.coalesce(F.col("extraction_status"), F.lit("")) == "success").cast("int")) if "extraction_status" in df.columns else F.lit(0.0)
    return df.agg(F.count(F.lit(1)).alias("total_papers"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), some("abstract").alias("with_abstract"), some("doi").alias("with_doi"), F.round(rate, 6).alias("success_rate"))


def summary_report(df: DataFrame) -> DataFrame:
    """Years, sources, games, the ten most frequent families and failure modes, the scale's values and the games' traits."""
    kinds = {"year": F.col("year"), "source": F.col("source_db"), "game_type": F.col("game_type"), "llm_family": F.col("llm_family"), "awscale": F.col("awscale"), "open_ended": F.col("open_ended"), "quantitative": F.col("quantitative")}
    return profile(df, kinds, {"failure_mode": _modes("failure_modes")}, {"llm_family": 10, "failure_mode": 10})


def scale_summary(df: DataFrame) -> DataFrame:
    """One row: mean and exact median of the scale. It has seven values, so that the median's aggregate holds seven entries."""
    return df.agg(F.round(F.avg("awscale"), 6).alias("mean"), F.median("awscale").alias("median"))


def screening_report(df: DataFrame) -> DataFrame:
    """Decisions and reasons of both stages; blank decisions are unscreened."""
    said = lambda c: F.coalesce(F.nullif(F.lower(F.trim(F.col(c))), F.lit("")), F.lit("unscreened"))
    return profile(df, {"total": F.lit("all"), "title_abstract": said("include_ta"), "full_text": said("include_ft"), "reason_ta": F.trim("reason_ta"), "reason_ft": F.trim("reason_ft")})


def excluded_summary(df: DataFrame, reason: str = "reason") -> DataFrame:
    return profile(df, {"total": F.lit("all"), "reason": F.col(reason), "year": F.col("year"), "source": F.col("source_db")})


def disambiguation_report(df: DataFrame) -> DataFrame:
    """Excluded and passed records, reasons, and grey literature by source."""
    return profile(df, {"outcome": F.when(F.col("excluded"), "excluded").otherwise("passed"), "reason": F.col("reason"), "grey_source": F.when(F.col("grey_lit_flag"), F.col("source_db"))})


def inclusion_report(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """Included and excluded records, scores, and which topics the excluded ones have (first, second, both)."""
    out = ~F.col("auto_include")
    return profile(df, {"total": F.lit("all"), "outcome": F.when(out, "excluded").otherwise("included"), "score": F.col("auto_relevance_score"), "excluded_first": F.when(out & first, "yes"), "excluded_second": F.when(out & second, "yes"), "excluded_both": F.when(out & first & second, "yes")})


def log_profile(df: DataFrame) -> DataFrame:
    """Entries by level and status, the ten most frequent modules, and errors by level or status."""
    error = F.when((F.col("level") == "ERROR") | (F.col("status") == "error"), "all")
    return profile(df, {"total": F.lit("all"), "level": F.col("level"), "status": F.col("status"), "module": F.col("module"), "error": error}, most={"module": 10})


def log_extent(df: DataFrame) -> DataFrame:
    return df.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def log_filter(df: DataFrame, module: str | None = None, level: str | None = None, status: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Entries whose module contains a text, of a level, a status and a time, both ends included."""
    kind = df.schema["timestamp"].dataType
    tests = [(module, lambda v: F.contains(F.lower("module"), F.lit(v.lower()))), (level, lambda v: F.col("level") == v), (status, lambda v: F.col("status") == v), (start, lambda v: F.col("timestamp") >= F.lit(v).cast(kind)), (end, lambda v: F.col("timestamp") <= F.lit(v).cast(kind))]
    for value, test in tests:
        df = df.where(test(value)) if value else df
    return df


def log_runs(df: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Per module how many runs of entries without a pause of gap_seconds there are, and how many entries.

    Entries of one stretch of gap_seconds are of one run, so they fold before anything is ordered: a module's task sees a row per stretch.
    """
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    gap = gap_seconds * 1_000_000
    stretches = df.groupBy("module", F.floor(at / gap).alias("stretch")).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n"))
    before = F.lag("last").over(Window.partitionBy("module").orderBy("stretch"))
    begins = stretches.withColumn("begins", F.coalesce((F.col("first") - before >= gap).cast("int"), F.lit(1)))
    return begins.groupBy("module").agg(F.sum("begins").alias("sessions"), F.sum("n").alias("entries"))


def session_progress(progress: DataFrame) -> DataFrame:
    """Papers by session and source, and when it was last active; only rows of a query count, as a source's checkpoint repeats them."""
    return progress.where(F.col("query_hash").isNotNull()).groupBy("session_id", "source").agg(F.sum("papers_found").alias("papers"), F.max("timestamp").alias("last_activity"))


def sessions(progress: DataFrame) -> DataFrame:
    """Sessions, the latest begun first."""
    return progress.groupBy("session_id").agg(F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time")).orderBy(F.desc("start_time"), "session_id")


def job_status(batches: DataFrame, jobs: DataFrame, batch_size: int) -> DataFrame:
    """Per job (job_id, total_items): completed and failed batches, mean and total time, and percentage; a last, smaller batch counts as one."""
    per = batches.groupBy("job_id").agg(F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), F.round(F.avg("processing_time"), 6).alias("mean_time"), F.round(F.sum("processing_time"), 6).alias("total_time"))
    planned = F.greatest(F.lit(1), F.ceil(F.col("total_items") / batch_size))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return jobs.join(per, "job_id", "left").select("job_id", zero("completed"), zero("failed"), "mean_time", "total_time", F.round(100.0 * F.coalesce("completed", F.lit(0)) / planned, 6).alias("percentage"))


#: Rows of one task when windows of few rows run over a long history.
STRETCH = 100_000


def trailing_mean(batches: DataFrame, rows: int = 10, stretch: int = STRETCH) -> DataFrame:
    """Per batch the mean time of the job's last batches, itself included.

    All batches are numbered by job and batch and cut into stretches; each stretch also gets the rows before it that its windows
    reach back to. So one job's long history is many tasks' work.
    """
    placed = numbered(batches, [F.col("job_id"), F.col("batch_id")], "__place")
    own = F.floor(F.col("__place") / stretch)
    reach = F.floor((F.col("__place") + rows - 1) / stretch)
    dealt = placed.withColumn("__own", own).withColumn("__stretch", F.explode(F.sequence(own, reach)))
    last = Window.partitionBy("__stretch", "job_id").orderBy("__place").rowsBetween(1 - rows, 0)
    means = dealt.withColumn("recent_mean", F.round(F.avg("processing_time").over(last), 6))
    return means.where("__own = __stretch").drop("__place", "__own", "__stretch")


def time_left(batches: DataFrame, planned: int, rows: int = 10) -> DataFrame:
    """Per job: mean of the last batches times the batches still to come. The rank is limited on the map side, and counts are added up there."""
    latest = batches.withColumn("__r", F.row_number().over(Window.partitionBy("job_id").orderBy(F.desc("batch_id")))).where(F.col("__r") <= rows)
    mean = latest.groupBy("job_id").agg(F.avg("processing_time").alias("mean"))
    done = batches.groupBy("job_id").agg(F.count(F.lit(1)).alias("done"))
    return done.join(mean, "job_id").select("job_id", F.round(F.col("mean") * F.greatest(F.lit(0), F.lit(planned) - F.col("done")), 6).alias("seconds_left"))


def query_statistics(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source").agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("papers_found"), 6).alias("mean_papers"), F.round(F.avg("relevance"), 6).alias("mean_relevance"))


def best_queries(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("papers_found"), "source", "query_text").limit(limit)


def query_history(runs: DataFrame) -> DataFrame:
    """Score of each query of a source by what it found, how relevant, and how often it ran (up to 10 times)."""
    per = runs.groupBy("source", "query_text").agg(F.avg("papers_found").alias("p"), F.avg("relevance").alias("r"), F.count(F.lit(1)).alias("k"))
    return per.select("source", "query_text", F.round(0.6 * F.col("p") + 0.3 * F.coalesce("r", F.lit(0.5)) + 0.1 * F.least(F.lit(10), F.col("k")), 6).alias("score"))


def cache_statistics(entries: DataFrame) -> DataFrame:
    """Per content type and for all (type null): entries, MB, accesses."""
    return entries.rollup("content_type").agg(F.count(F.lit(1)).alias("entries"), F.round(F.sum("file_size") / MB, 6).alias("mb"), F.sum("access_count").alias("accesses"))


def hit_rate(hits: int, misses: int) -> float:
    return 100.0 * hits / (hits + misses) if hits + misses else 0.0


def file_statistics(files: DataFrame) -> DataFrame:
    """Of binary files (path, length): how many, MB, mean MB."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.round(F.coalesce(F.sum("length"), F.lit(0)) / MB, 6).alias("mb"), F.round(F.coalesce(F.avg("length"), F.lit(0.0)) / MB, 6).alias("mean_mb"))


def pattern_hits(df: DataFrame, text: Column, patterns: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """category, pattern, n: in how many texts each pattern of a category occurs."""
    hits = F.array(*[F.when(F.coalesce(text, F.lit("")).rlike("(?iU)" + p), F.struct(F.lit(c).alias("category"), F.lit(p).alias("pattern"))) for c, ps in patterns.items() for p in ps])
    return df.select(F.explode(F.array_compact(hits)).alias("h")).groupBy("h.category", "h.pattern").agg(F.count(F.lit(1)).alias("n"))
