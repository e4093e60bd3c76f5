"""Scores and codes that rules derive from a record's fields."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# What tells the two topics of a review.
STRONG_TERMS = ("war game", "wargame", "wargaming", "war-game", "military simulation", "defense simulation", "crisis simulation", "strategic simulation", "red team", "blue team", "tabletop exercise")
WEAK_TERMS = ("strategic", "military", "defense", "crisis", "simulation", "game theory", "nash equilibrium")
MODEL_TERMS = ("large language model", "llm", "gpt", "chatgpt", "neural network", "deep learning", "transformer", "ai agent", "multi-agent", "reinforcement learning", "machine learning", "artificial intelligence")


def hits(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms the text contains."""
    return reduce(add, [F.when(F.contains(text, F.lit(t)), 1).otherwise(0) for t in terms], F.lit(0))


def topic_score(title: Column, abstract: Column, strong: Iterable[str] = STRONG_TERMS, weak: Iterable[str] = WEAK_TERMS, model: Iterable[str] = MODEL_TERMS, bonus: Iterable[str] = ("war game", "wargame"), least_weak: int = 3, least_model: int = 2) -> Column:
    """9 if both topics are present, 7 for one, 3 for none; one more, up to 10, for a telling title."""
    low = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract, F.lit(""))))
    first = (hits(low, strong) > 0) | (hits(low, weak) >= least_weak)
    second = hits(low, model) >= least_model
    score = F.when(first & second, 9).when(first | second, 7).otherwise(3)
    return F.least(F.lit(10), score + F.when(hits(F.lower(F.coalesce(title, F.lit(""))), bonus) > 0, 1).otherwise(0))


def scale_estimate(game_type: Column, quantitative: Column, open_ended: Column) -> Column:
    """1 (qualitative) to 7 (analytical): a base by type, one up or down for each trait, clamped at each step."""
    kind = F.lower(F.coalesce(game_type, F.lit("")))
    base = F.when(F.contains(kind, F.lit("seminar")), 2).when(F.contains(kind, F.lit("matrix")), 3).when(F.contains(kind, F.lit("digital")) | F.contains(kind, F.lit("computer")), 6).otherwise(4)
    clamp = lambda x: F.greatest(F.lit(1), F.least(F.lit(7), x))
    counted = clamp(base + F.when(quantitative == "yes", 1).when(quantitative == "no", -1).otherwise(0))
    return clamp(counted + F.when(open_ended == "yes", -1).when(open_ended == "no", 1).otherwise(0))


def confidence(required: Iterable[Column], optional: Iterable[Column]) -> Column:
    """0.5, 0.08 for each required field that is known and 0.03 for each optional one, at most 1."""
    known = lambda c: F.when((F.coalesce(c, F.lit("")) != "") & (F.lower(c) != "unknown"), 1).otherwise(0)
    return F.least(F.lit(1.0), F.lit(0.5) + reduce(add, map(known, required), F.lit(0)) * 0.08 + reduce(add, map(known, optional), F.lit(0)) * 0.03)


def yes_no(x: Column) -> Column:
    return F.when(F.lower(x.cast("string")).isin("true", "yes", "1"), "yes").otherwise("no")


def included_code(x: Column) -> Column:
    return F.when(F.lower(x) == "yes", 1).when(F.lower(x) == "no", 0).otherwise(-1)


def _has(text: Column, *words: str) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def log_status(message: Column, level: Column) -> Column:
    """success, error or warning by a word in the message, the last two by the level too; else info."""
    low, level = F.lower(F.coalesce(message, F.lit(""))), F.coalesce(level, F.lit(""))
    return F.when(_has(low, "success"), "success").when(_has(low, "error") | (level == "ERROR"), "error").when(_has(low, "warning") | (level == "WARNING"), "warning").otherwise("info")


def error_class(message: Column) -> Column:
    """Why a request failed; the first class whose words the message has."""
    low = F.lower(F.coalesce(message, F.lit("")))
    named = F.when(_has(low, "rate limit", "too many requests", "429"), "rate_limit").when(_has(low, "timeout", "timed out"), "timeout")
    return named.when(_has(low, "connection", "network"), "connection_error").when(_has(low, "500", "502", "503", "504"), "server_error").otherwise("unknown")


def citation_type(venue_type: Column) -> Column:
    low = F.lower(F.coalesce(venue_type, F.lit("")))
    has = lambda w: F.contains(low, F.lit(w))
    return F.when(has("conference") | has("workshop"), "inproceedings").when(has("journal"), "article").when(has("tech") & has("report"), "techreport").otherwise("misc")


def json_or_raw(x: Column, schema: str) -> Column:
    """A struct of the text as JSON, of the first object in it, or null fields."""
    span = F.regexp_extract(x, r"(?s)\{.*\}", 0)
    return F.from_json(F.when(F.try_parse_json(x).isNotNull(), x).otherwise(span), schema)


def raw_response(x: Column) -> Column:
    """A text that is neither JSON nor holds an object, else null: what an answer without structure says."""
    return F.when(F.try_parse_json(x).isNull() & F.try_parse_json(F.regexp_extract(x, r"(?s)\{.*\}", 0)).isNull(), x)


def query_potential(text: Column, core: Iterable[str], model: Iterable[str], action: Iterable[str], valued: Iterable[str]) -> Column:
    """0.5 and capped shares for terms that a query names, at most 1."""
    part = lambda terms, each, most: F.least(F.lit(most), hits(text, terms) * each)
    return F.least(F.lit(1.0), F.lit(0.5) + part(core, 0.1, 0.3) + part(model, 0.1, 0.3) + part(action, 0.05, 0.2) + hits(text, valued) * 0.1)


def scale_estimate_free(approach: Column, game_type: Column, interplay: Column) -> Column:
    """1 (creative) to 7 (analytical) from three free texts: a base by approach, then a step for who decides and for how people and models meet."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    a, g, p = low(approach), low(game_type), low(interplay)
    base = F.when(_has(a, "seminar", "red team"), 2).when(_has(a, "matrix", "tabletop"), 3).when(_has(a, "course of action", "coa"), 5).when(_has(a, "digital", "automated", "computer", "ai-only"), 6).otherwise(4)
    stepped = lambda score, freer, stricter: F.when(freer, F.least(score - 1, F.lit(3))).when(stricter, F.greatest(score + 1, F.lit(5))).otherwise(score)
    decided = stepped(base, _has(g, "referee", "facilitator"), _has(g, "algorithmic", "deterministic"))
    met = stepped(decided, _has(p, "storytelling", "narrative"), _has(p, "optimization", "calculation"))
    return F.greatest(F.lit(1), F.least(F.lit(7), met))


def confidence_by_fields(fields: Iterable[Column]) -> Column:
    """0.5 and 0.1 for each field that says anything but null, at most 1."""
    said = lambda c: F.when(~F.coalesce(c, F.lit("")).isin("", "null"), 1).otherwise(0)
    return F.least(F.lit(1.0), F.lit(0.5) + reduce(add, map(said, fields), F.lit(0)) * 0.1)


# Dollars per 1000 prompt and completion tokens; the model that prices unknown ones.
PRICES = {
    "gpt-4o": (0.005, 0.015),
    "gpt-4": (0.03, 0.06),
    "gpt-3.5-turbo": (0.0005, 0.0015),
    "claude-3-sonnet-20240229": (0.003, 0.015),
    "claude-3-haiku-20240307": (0.00025, 0.00125),
    "gemini-pro": (0.00025, 0.0005),
}
PRICED_AS = "gpt-3.5-turbo"


def token_cost(model: Column, prompt_tokens: Column, completion_tokens: Column, prices: dict[str, tuple[float, float]] = PRICES, unknown: str = PRICED_AS) -> Column:
    """Dollars for a completion; a model without a price costs what unknown does."""
    table = F.create_map(*[x for name, (p, c) in prices.items() for x in (F.lit(name), F.struct(F.lit(p).alias("p"), F.lit(c).alias("c")))])
    price = F.coalesce(table[model], table[F.lit(unknown)])
    return prompt_tokens / 1000 * price["p"] + completion_tokens / 1000 * price["c"]


def query_hash(query: Column, chars: int | None = None) -> Column:
    """MD5 of a query, whole or its first characters."""
    return F.md5(query) if chars is None else F.substring(F.md5(query), 1, chars)


def code_available(release: Column) -> Column:
    return ~F.coalesce(release, F.lit("")).isin("", "none")
