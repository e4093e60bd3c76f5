"""Tags by pattern tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of failure categories, read without regard to case.
FAILURES: dict[str, Sequence[str]] = {
    "bias": (r"\bbias(?:ed)?\b", r"\bstereotyp\w+\b", r"\bdiscriminat\w+\b", r"\bunfair\w*\b", r"\bprejudic\w+\b"),
    "hallucination": (r"\bhallucinat\w+\b", r"\bconfabulat\w+\b", r"\bfabricat\w+\b", r"\bmade[\s-]?up\b", r"\bfalse\s+(?:information|facts?|claims?)\b"),
    "factual_error": (r"\bfactual(?:ly)?\s+(?:error|incorrect|wrong)\b", r"\binaccura\w+\b", r"\bincorrect\s+(?:facts?|information)\b", r"\bmisinformation\b"),
    "inconsistency": (r"\binconsisten\w+\b", r"\bcontradict\w+\b", r"\bincoher\w+\b", r"\bunstable\s+(?:behavior|output)\b"),
    "escalation": (r"\bescalat\w+\b", r"\bspiral(?:ing)?\b", r"\baggressive\s+(?:behavior|response)\b", r"\bconflict\s+(?:escalation|spiral)\b"),
    "deception": (r"\bdecept\w+\b", r"\bdeceiv\w+\b", r"\bmislead\w+\b", r"\bmanipulat\w+\b", r"\bdishonest\w*\b"),
    "prompt_sensitivity": (r"\bprompt[\s-]?(?:sensitiv|engineer|hack)\w*\b", r"\bprompt[\s-]?injection\b", r"\bsensitive\s+to\s+(?:prompt|input)\b", r"\bunstable\s+(?:to|with)\s+prompt\b"),
    "data_leakage": (r"\bdata[\s-]?leak\w*\b", r"\bprivacy[\s-]?(?:breach|violation|leak)\b", r"\bunauthorized\s+(?:access|disclosure)\b", r"\bexpos(?:e|ing)\s+(?:private|sensitive)\b"),
    "jailbreak": (r"\bjailbreak\w*\b", r"\bbypass\w*\s+(?:safety|security|guardrails)\b", r"\bcircumvent\w*\s+(?:restrictions|controls)\b", r"\bbreak\w*\s+(?:out|free)\b"),
}
MODELS: dict[str, Sequence[str]] = {"gpt4": (r"\bgpt-?4\b",), "gpt35": (r"\bgpt-?3\.5\b",), "claude": (r"\bclaude\b",), "palm": (r"\bpalm\b",), "llama": (r"\bllama\b",), "bert": (r"\bbert\b",)}
GAMES: dict[str, Sequence[str]] = {"matrix": (r"\bmatrix\s+(?:game|wargame)\b",), "seminar": (r"\bseminar\s+(?:game|wargame)\b",), "digital": (r"\bdigital\s+(?:game|wargame|simulation)\b",)}
METRICS: dict[str, Sequence[str]] = {"win_rate": (r"\bwin[\s-]?rate\b",), "accuracy": (r"\baccuracy\b",), "f1_score": (r"\bf1[\s-]?score\b",), "human_evaluation": (r"\bhuman\s+(?:evaluation|assessment|rating)\b",)}
#: Categories that a vocabulary without them files elsewhere.
ELSEWHERE = {"factual_error": "hallucination", "inconsistency": "hallucination", "jailbreak": "prompt_sensitivity"}


def tags(text: Column, patterns: Mapping[str, Sequence[str]]) -> Column:
    """Names of the patterns that the text matches, in the table's order; words as Unicode has them."""
    return F.array_compact(F.array(*[F.when(F.coalesce(text, F.lit("")).rlike("(?iU)" + "|".join(p)), F.lit(name)) for name, p in patterns.items()]))


def in_vocabulary(found: Column, vocabulary: Sequence[str]) -> Column:
    """Tags as the vocabulary names them: itself, its stand-in, or other."""
    names = {c: c if c in vocabulary else ELSEWHERE[c] if ELSEWHERE.get(c) in vocabulary else "other" for c in FAILURES}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.array_sort(F.array_distinct(F.transform(found, lambda t: F.coalesce(table[t], F.lit("other")))))


def search_text(*columns: str) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in columns])


def code_link(text: Column) -> Column:
    """The first repository link, else mentioned, else empty."""
    link = F.nullif(F.regexp_extract(text, r"(?i)github\.com/[\w-]+/[\w-]+", 0), F.lit(""))
    return F.coalesce(link, F.when(text.rlike(r"(?i)\bcode\s+(?:is\s+)?available\b|\bopen[\s-]?source\b"), F.lit("mentioned")), F.lit(""))


def tagged(df: DataFrame, text: Column, vocabulary: Sequence[str] = tuple(FAILURES), earlier: Column | None = None) -> DataFrame:
    """df with the tag columns; earlier: an array of tags to unite with."""
    found = in_vocabulary(tags(text, FAILURES), vocabulary)
    united = F.array_sort(F.array_union(found, F.coalesce(earlier, F.array().cast("array<string>")))) if earlier is not None else found
    return df.withColumns({"failure_modes_regex": found, "failure_modes": united, "llm_detected": tags(text, MODELS), "game_type_detected": tags(text, GAMES), "metrics_detected": tags(text, METRICS), "code_detected": code_link(text)})


def tag_summary(df: DataFrame, column: str) -> DataFrame:
    """Tag, count, and percentage of the rows that have any tag."""
    rows = df.where(F.size(column) > 0)
    counts = rows.select(F.explode(F.array_distinct(F.col(column))).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(rows.agg(F.count(F.lit(1)).alias("of")))).select("tag", "n", F.round(100.0 * F.col("n") / F.col("of"), 1).alias("percentage"))
