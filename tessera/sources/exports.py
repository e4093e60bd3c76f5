"""Packages for readers outside: tables, summaries, metadata and a README in one archive; log tables."""

from __future__ import annotations

import csv
import io
import json
import os
import zipfile
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scores as S
from tessera.operators import statistics

#: Rows that a log export holds at most.
LOG_ROWS = 10_000


def metadata(df: DataFrame, config: Mapping | None = None) -> dict:
    """Totals, columns, sources, years and quality of a package, as plain values."""
    row = statistics.package_metadata(df).first().asDict()
    by_source = statistics.profile(df, {"source": F.col("source_db")}).collect()  # a row per source
    return {
        "export_info": {"total_papers": row["total_papers"], "config_used": dict(config or {})},
        "data_summary": {"columns": df.columns, "sources": {r["value"]: r["n"] for r in by_source}, "year_range": {"min": row["first_year"], "max": row["last_year"]}},
        "quality_metrics": {"papers_with_abstracts": row["with_abstract"], "papers_with_dois": row["with_doi"], "extraction_success_rate": row["success_rate"]},
    }


def nested(report: DataFrame) -> dict[str, dict[str, int]]:
    """A report (kind, value, n) as counts by value by kind."""
    out: dict[str, dict[str, int]] = {}
    for r in report.orderBy("kind", F.desc("n"), "value").collect():
        out.setdefault(r["kind"], {})[r["value"]] = r["n"]
    return out


def exclusion_rate(kept: int, excluded: int) -> float:
    return 100.0 * excluded / (kept + excluded) if kept + excluded else 0.0


def readme(about: Mapping, excluded: int = 0) -> str:
    """What a package holds, in Markdown."""
    total, years = about["export_info"]["total_papers"], about["data_summary"]["year_range"]
    lines = ["# Review data", "", f"Papers: {total}", f"Years: {years['min']} to {years['max']}", "Scale: 1 (creative) to 7 (analytical)", "", "## Sources", ""]
    lines += [f"* {name}: {n}" for name, n in sorted(about["data_summary"]["sources"].items(), key=lambda x: (-x[1], x[0] or ""))]
    if excluded:
        lines += ["", "## Excluded", "", f"{excluded} papers, {exclusion_rate(total, excluded):.1f} %"]
    return "\n".join(lines) + "\n"


def inclusion_text(report: DataFrame, threshold: int) -> str:
    """The report of an automatic inclusion (statistics.inclusion_report) as text."""
    found = nested(report)
    total, outcome = found.get("total", {}).get("all", 0), found.get("outcome", {})
    share = lambda n: f"{n} ({100 * n / total:.1f}%)" if total else "0"
    lines = ["AUTO-INCLUSION REPORT", f"Total papers: {total}", f"Auto-included: {share(outcome.get('included', 0))}", f"Below threshold: {share(outcome.get('excluded', 0))}", f"Threshold used: {threshold}/10", "", "SCORES"]
    lines += [f"Score {s}: {n} papers" for s, n in sorted(found.get("score", {}).items(), key=lambda x: int(x[0]))]
    lines += ["", "EXCLUDED PAPERS"] + [f"With {name} topic{'s' if name == 'both' else ''}: {found.get(f'excluded_{name}', {}).get('yes', 0)}" for name in ("first", "second", "both")]
    return "\n".join(lines) + "\n"


def package(df: DataFrame, out: str, config: Mapping | None = None, excluded: DataFrame | None = None, files: Mapping[str, str] | None = None) -> str:
    """A ZIP archive on the driver: papers.csv, summary.json, metadata.json, README.md, excluded papers with their summary, and other files by name in the archive.

    Tables go to the archive row by row, so that the driver holds one partition at a time.
    """
    about = metadata(df, config)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        _csv(archive, "papers.csv", df)
        archive.writestr("metadata.json", json.dumps(about, indent=2, ensure_ascii=False))
        if {"game_type", "llm_family", "awscale", "failure_modes"} <= set(df.columns):
            archive.writestr("summary.json", json.dumps(nested(statistics.extraction_statistics(df)), indent=2, ensure_ascii=False))
        n = 0
        if excluded is not None:
            found = nested(statistics.excluded_summary(excluded))
            n = found.get("total", {}).get("all", 0)
            _csv(archive, "excluded_papers/excluded_papers.csv", excluded)
            archive.writestr("excluded_papers/excluded_summary.json", json.dumps(found, indent=2, ensure_ascii=False))
        archive.writestr("README.md", readme(about, n))
        for name, path in (files or {}).items():
            archive.write(path, name)
    return out


def _csv(archive: zipfile.ZipFile, name: str, df: DataFrame) -> None:
    with archive.open(name, "w") as raw, io.TextIOWrapper(raw, encoding="utf-8", newline="") as f:
        rows = csv.writer(f)
        rows.writerow(df.columns)
        for r in df.toLocalIterator():
            rows.writerow(["" if v is None else v for v in r])


def append_log(entries: DataFrame, table: str) -> None:
    """Entries with their status and day, appended to a log table that is cut by day."""
    out = entries.withColumn("status", S.log_status(F.col("message"), F.col("level"))).withColumn("day", F.to_date("timestamp"))
    out.write.mode("append").partitionBy("day").parquet(table)


def export_log(log: DataFrame, path: str, rows: int = LOG_ROWS, **filters: str) -> None:
    """The latest entries that pass the filters of statistics.log_filter, at most so many, as CSV."""
    found = statistics.log_filter(log, **filters).orderBy(F.desc("timestamp"), "id").limit(rows)
    found.write.mode("overwrite").option("header", True).csv(path)


def snapshot_config(spark: SparkSession, config: Mapping, folder: str, run: str) -> str:
    """The configuration beside a run's results, as one JSON text named by the run."""
    path = os.path.join(folder, f"config_{run}")
    spark.createDataFrame([(json.dumps(config, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
