"""Queries that a harvest sends: term groups, templates, variants by source, and which of them to run."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from itertools import chain, product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import search, statistics

# Where a source is asked by category, field, journal or author unless the configuration says otherwise.
CATEGORIES = ("cs.AI", "cs.CL", "cs.LG", "cs.GT", "cs.MA", "cs.HC")
FIELDS = ("Computer Science", "Political Science", "Economics", "Psychology", "Mathematics")
JOURNALS = ("artificial intelligence", "machine learning", "natural language", "international security", "defense", "simulation", "games")
GAME_WORDS = ("game", "simulation", "exercise", "scenario", "strategy")
NEW_TERMS = ("prompt engineering", "in-context learning", "few-shot learning", "chain of thought", "constitutional AI")
GAME_VARIANTS = ("strategic exercise", "policy simulation", "crisis game")
RECENT_MODELS = ("GPT-4", "Claude-3", "Gemini", "GPT-4o")
COMBINATIONS = (
    ("wargame", "GPT", "analysis"), ("war game", "language model", "simulation"), ("crisis simulation", "AI", "decision"), ("tabletop exercise", "artificial intelligence", "scenario"),
    ("policy game", "ChatGPT", "strategy"), ("diplomatic simulation", "LLM", "negotiation"), ("red team", "large language model", "exercise"), ("defense simulation", "GPT-4", "planning"),
)
AUTHORS = ("Philip Tetlock", "Phillip Tetlock", "Reid Hoffman", "Dario Amodei", "Anthropic", "OpenAI", "DeepMind")
CONCEPTS = ("wargame", "simulation", "AI safety", "language model")
AI_TERMS = ("artificial intelligence", "machine learning", "NLP", "AI")
THEORY_TERMS = ("game theory", "simulation", "multi-agent")
# Terms that widen the configured ones.
MORE_GAMES = (
    "war game", "wargaming", "tabletop exercise", "TTX", "crisis simulation", "crisis game", "policy simulation", "strategic planning exercise", "scenario planning", "red team", "blue team", "red teaming",
    "military exercise", "defense simulation", "combat simulation", "operational planning", "strategic assessment", "threat assessment", "vulnerability assessment",
    "serious game", "serious gaming", "simulation game", "role-playing exercise", "role playing game", "RPG", "decision game", "strategy game",
    "diplomatic simulation", "negotiation simulation", "Model UN", "Model United Nations", "MUN", "international relations simulation",
    "Diplomacy game", "Risk analysis", "scenario analysis", "contingency planning", "strategic communication exercise",
)
MORE_MODELS = (
    "transformer", "attention mechanism", "neural language model", "autoregressive model", "seq2seq", "encoder-decoder",
    "GPT-3", "GPT-3.5", "GPT-4", "ChatGPT", "InstructGPT", "Claude-2", "Claude-3", "PaLM-2", "Gemini", "Bard", "LLaMA-2", "Llama-2", "Alpaca", "Vicuna", "WizardLM", "T5", "UL2", "PaLM", "LaMDA", "Chinchilla",
    "foundation model", "pre-trained model", "fine-tuned model", "prompt engineering", "in-context learning", "few-shot learning", "zero-shot learning", "chain of thought", "reasoning",
    "natural language generation", "NLG", "text generation", "conversational AI", "dialogue system", "chatbot",
    "language understanding", "text comprehension", "natural language inference", "NLI", "question answering", "summarization", "text summarization",
)
MORE_ACTIONS = (
    "AI player", "AI agent", "artificial player", "automated player", "AI participant", "virtual participant", "digital participant", "AI facilitator", "AI moderator", "AI adjudicator",
    "AI analyst", "AI advisor", "AI assistant", "AI consultant", "decision support", "analytical support", "strategic analysis",
    "scenario generation", "content generation", "text generation", "narrative generation", "story generation", "plot generation", "event generation", "outcome generation",
    "human-AI interaction", "human-machine interaction", "collaborative AI", "AI collaboration", "AI partnership",
    "performance evaluation", "strategy evaluation", "decision evaluation", "outcome assessment", "effectiveness assessment", "impact assessment",
)
PRODUCTION_CATEGORIES = ("cs.AI", "cs.CL", "cs.LG", "cs.GT", "cs.MA")
PRODUCTION_FIELDS = ("Computer Science", "Political Science", "Economics")


def vocabulary(*lists: Iterable[str]) -> list[str]:
    """All terms once, without regard to case, in order."""
    first: dict[str, str] = {}
    for t in chain(*lists):
        first.setdefault(t.lower(), t)
    return list(first.values())


def expanded(games: Iterable[str] = (), models: Iterable[str] = (), actions: Iterable[str] = ()) -> tuple[list[str], list[str], list[str]]:
    """The configured terms, widened, each once."""
    return vocabulary(games, MORE_GAMES), vocabulary(models, MORE_MODELS), vocabulary(actions, MORE_ACTIONS)


def group(terms: Iterable[str]) -> str:
    """Terms joined by OR; those of several words are quoted."""
    return " OR ".join(f'"{t}"' if re.search(r"[\s-]", t) else t for t in terms)


def base_query(games: Sequence[str], models: Sequence[str], actions: Sequence[str] = (), excluded: Sequence[str] = ()) -> str:
    """(games) AND (models) [AND (actions)] NOT each excluded term, in the search language; NEAR stays NEAR."""
    written = lambda t: search.printed(search.parse(t if re.search(r'["*?]|NEAR/', t) else f'"{t}"'))
    parts = [f"({' OR '.join(map(written, terms))})" for terms in (games, models, actions) if terms]
    return " AND ".join(parts) + "".join(f" NOT {written(t)}" for t in excluded)


def from_templates(templates: Iterable[Mapping[str, str]], excluded: Sequence[str], models: Sequence[str]) -> list[dict[str, str]]:
    """Secondary queries: description, and template with {exclusion_terms} and {llm_terms} filled in."""
    filled = {"{exclusion_terms}": group(excluded), "{llm_terms}": group(models)}
    out = []
    for t in templates:
        query = t.get("template", "")
        for name, terms in filled.items():
            query = query.replace(name, terms)
        out.append({"description": t.get("description", ""), "query": " ".join(query.split())})
    return out


def core_query(games: Sequence[str], models: Sequence[str], actions: Sequence[str] = ()) -> str:
    both = f"({group(games)}) AND ({group(models)})"
    return f"({both}) OR (({group(games)}) AND ({group(actions)}))" if actions else both


def source_queries(source: str, games: Sequence[str], models: Sequence[str], actions: Sequence[str] = (), places: Sequence[str] | None = None, combinations: Iterable[Sequence[str]] = COMBINATIONS, authors: Sequence[str] = AUTHORS, concepts: Sequence[str] = CONCEPTS) -> list[str]:
    """Variants for one source by category (arxiv), field (semantic_scholar), journal (crossref), combination and author (google_scholar)."""
    quoted = lambda terms: " OR ".join(f'"{t}"' for t in terms)
    if source == "arxiv":
        near = lambda c: (f"({group(games[:10])}) AND ({group(models[:15])}) AND cat:{c}", f"({group(models[:15])}) AND ({quoted(GAME_WORDS)}) AND cat:{c}")
        return [*chain.from_iterable(near(c) for c in places or CATEGORIES)]
    if source == "semantic_scholar":
        narrow = lambda f: [f'"{a}" AND "{b}" AND fieldsOfStudy:{f}' for a, b in product(AI_TERMS, THEORY_TERMS)] if f == FIELDS[0] else []
        return [*chain.from_iterable([f"({core_query(games, models, actions)}) AND fieldsOfStudy:{f}", *narrow(f)] for f in places or FIELDS)]
    if source == "crossref":
        return [f'"{t}" AND "{j}"' for j, t in product(places or JOURNALS, [*games[:8], *models[:12]])]
    if source == "google_scholar":
        return [" AND ".join(f'"{t}"' for t in c) for c in combinations] + [f'author:"{a}" "{c}"' for a, c in product(authors, concepts)]
    return []


def experimental_queries() -> list[str]:
    """New terms with each game variant, and recent models."""
    return [f'"{a}" AND "{b}"' for a, b in product(NEW_TERMS, GAME_VARIANTS)] + [f'"{m}" AND ("wargame" OR "simulation" OR "exercise")' for m in RECENT_MODELS]


def distinct_queries(queries: Iterable[str], folded: bool = True) -> list[str]:
    """Each query once, in order; folded: without regard to case and spacing."""
    key = lambda q: re.sub(r"\s+", " ", q.strip().lower()) if folded else q
    seen: set[str] = set()
    return [q for q in queries if not (key(q) in seen or seen.add(key(q)))]


def best(queries: Sequence[str], scores: Mapping[str, float], most: int) -> list[str]:
    """The first query, which is the core, then the others by falling score, ties in order."""
    if len(queries) <= most:
        return list(queries)
    rest = sorted(range(1, len(queries)), key=lambda i: (-scores.get(queries[i], 0.0), i))
    return [queries[0], *(queries[i] for i in rest[: most - 1])]


def history_of(runs: DataFrame, source: str, queries: Sequence[str]) -> dict[str, float]:
    """Scores of those of the given queries that a source has run before; one row per query comes to the driver."""
    asked = F.broadcast(runs.sparkSession.createDataFrame([(q,) for q in queries], "query_text string"))
    return {r["query_text"]: r["score"] for r in statistics.query_history(runs.where(F.col("source") == source).join(asked, "query_text", "left_semi")).collect()}


def generated(source: str, games: Sequence[str], models: Sequence[str], actions: Sequence[str] = (), most: int = 10, experimental: bool = True, scores: Mapping[str, float] | None = None, **variants: object) -> list[str]:
    """The core query, the source's variants and experimental ones, each once, the best of them."""
    queries = [core_query(games, models, actions), *source_queries(source, games, models, actions, **variants), *(experimental_queries() if experimental else ())]
    return best(distinct_queries(queries), scores or {}, most)


def production_queries(source: str, base: str, places: Sequence[str] | None = None) -> list[str]:
    """The base query, and for arXiv and Semantic Scholar one for each category or field."""
    more = {"arxiv": [f"({base}) AND cat:{c}" for c in places or PRODUCTION_CATEGORIES], "semantic_scholar": [f"{base} AND field:{f}" for f in places or PRODUCTION_FIELDS]}
    return distinct_queries([base, *more.get(source, ())], folded=False)
