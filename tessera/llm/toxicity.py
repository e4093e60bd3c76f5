"""Toxicity: misspelled terms of a lexicon, weighed by what stands around them.

The lexicon is a trie of whole words and of stems: common insults, and the words and beginnings that labelled toxic
documents hold and clean ones don't. Levenshtein automata run over all of it at once: a state is a set of trie nodes with the
edits spent to get there, determinised as texts ask for it, so that a word costs a few table lookups whatever
the size of the lexicon. Each hit weighs by its term, its edits and its context: inside quotation marks or after words that
report speech it counts little, beside an address it counts more. A logistic model turns the sums of a document into a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, read, written

#: Insults that the lexicon always has, in English; labels add terms of any language. Weight where labels say nothing.
SEEDS = (
    "arsehole asshole bastard bitch clown creep cretin degenerate despicable dimwit disgusting dumbass filth freak fuck garbage halfwit idiot imbecile jerk loser "
    "lowlife moron nitwit parasite pathetic pig prick retard scum scumbag shithead simpleton slut stupid trash twat vermin whore wimp worthless"
).split()
SEED_WEIGHT = 3.0
#: Words that report speech, up to REPORT words before a hit; words that address someone, up to ADDRESS words from it.
REPORTS = frozenset("said says saying wrote writes called calls quote quoted quotes word words term insult insults slur sagte sagt schrieb nannte wort zitat dit disait écrit mot dijo dice escribió palabra insulto".split())
ADDRESSES = frozenset("you your yours you're u ur du dich dir dein ihr euch tu toi ton vous votre tú ti usted ustedes eres".split())
REPORT, ADDRESS = 4, 3
#: Opening quotation marks with the closing ones, and how many characters they may stand from a hit.
QUOTES = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’", "‚": "‘’"}
QUOTE_SPAN = 200
QUOTED_FACTOR, ADDRESSED_FACTOR, EDIT_FACTOR = 0.25, 1.5, 0.5
#: At most so many labelled documents of a class train the model (a sample by hash); copies among them count once.
TRAIN_ROWS = 12_000
#: A term needs so many toxic documents, and this lower bound (LOWER standard errors below) of its log odds against clean ones.
TOXIC_DOCS, LIFT, LOWER = 3, 1.0, 1.64
#: So many terms of those tried may be expected to pass by chance.
CHANCE_TERMS = 0.2
#: Least hashes by which copies in the sample are known: a row that shares one with an earlier row of its class doesn't train.
SIGNATURES = 4
#: Of a word, stems of these lengths are tried; a stem has so many different words.
STEMS, STEM_WORDS = (4, 5, 6), 3
#: Least share of toxic documents among those with a term; and the share of clean documents with misspellings of a term from which on it is taken as spelled only.
PURITY, LOOSE_CLEAN = 0.9, 0.0005
#: Edits allowed in a term of so many characters or more. A word that so many clean training documents have is never a misspelling.
EDITS = ((5, 1), (9, 2))
KNOWN_DOCS = 2
#: States that an automaton keeps before it starts anew.
MAX_STATES = 50_000
#: Words of letters, digits and marks that stand for letters.
WORD = re.compile(r"\w+(?:[@$!*]+\w+)*")


def edits_allowed(term: str) -> int:
    return max((k for n, k in EDITS if len(term) >= n), default=0)


class Automaton:
    """The trie of a lexicon with the Levenshtein automata of its terms, determinised lazily.

    terms: weight by term; a term ending in * is a stem, which longer words continue. Stems and the terms in spelled allow no edits, other
    terms edits_allowed(): characters put in, left out, replaced, or two neighbours swapped.
    """

    def __init__(self, terms: dict[str, float], spelled: Iterable[str] = ()) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, float, int] | None] = [None]  # term, weight, edits allowed
        self.stems: list[tuple[str, float] | None] = [None]
        self.most = [0]  # edits that some term below a node allows
        exact = frozenset(spelled)
        for term, w in sorted(terms.items()):
            stem = term.endswith("*")
            k = 0 if stem or term in exact else edits_allowed(term)
            node = 0
            for c in term.removesuffix("*"):
                self.most[node] = max(self.most[node], k)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.stems.append(None)
                    self.most.append(0)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], k)
            if stem:
                self.stems[node] = (term, w)
            else:
                self.ends[node] = (term, w, k)
        self.reset()

    def reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.stemmed: list[str | None] = []
        self.start = self._state(self._closed({(0, 0, "")}))

    def _closed(self, items: set) -> frozenset:
        """With characters of the term left out of the word."""
        todo, out = list(items), set(items)
        while todo:
            node, e, swap = todo.pop()
            if not swap:
                for child in self.children[node].values():
                    if e < self.most[child] and (child, e + 1, "") not in out:
                        out.add((child, e + 1, ""))
                        todo.append((child, e + 1, ""))
        return frozenset(out)

    def _state(self, items: frozenset) -> int:
        if items in self.states:
            return self.states[items]
        n = self.states[items] = len(self.sets)
        self.sets.append(items)
        self.moves.append({})
        ends = [(-self.ends[x][1] * EDIT_FACTOR**e, e, self.ends[x][0]) for x, e, swap in items if not swap and self.ends[x] and e <= self.ends[x][2]]
        stems = [(-self.stems[x][1], self.stems[x][0]) for x, e, swap in items if not swap and e == 0 and self.stems[x]]
        self.accepts.append((min(ends)[2], min(ends)[1]) if ends else None)
        self.stemmed.append(min(stems)[1] if stems else None)
        return n

    def _move(self, state: int, c: str) -> int:
        """The state after c; -1 if no term is left."""
        out = set()
        for node, e, swap in self.sets[state]:
            if swap:  # the second of two swapped characters must follow
                if c == swap:
                    out.add((node, e, ""))
                continue
            children = self.children[node]
            if c in children:
                out.add((children[c], e, ""))
            if e < self.most[node]:
                out.add((node, e + 1, ""))
            for d, child in children.items():
                if d != c and e < self.most[child]:
                    out.add((child, e + 1, ""))
                    if c in self.children[child]:
                        out.add((self.children[child][c], e + 1, d))
        items = self._closed({(x, e, s) for x, e, s in out if e <= self.most[x]})
        to = self.moves[state][c] = self._state(items) if items else -1
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The term of greatest weight that the word is, begins with, or misspells, and the edits; None if there is none."""
        state, stem = self.start, None
        for c in word:
            stem = self.stemmed[state] or stem
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                return (stem, 0) if stem else None
        whole = self.accepts[state]
        return whole if whole and (whole[1] == 0 or not stem) else (stem, 0) if stem else None


@dataclass
class Model:
    """A lexicon, the words that are no misspellings, the terms that allow none, and the logistic model over features()."""

    terms: dict[str, float]
    known: frozenset[str] = frozenset()
    spelled: frozenset[str] = frozenset()
    bias: float = -3.0
    slopes: list[float] = field(default_factory=lambda: [1.5, 0.5])

    def automaton(self) -> Automaton:
        return Automaton(self.terms, self.spelled)


@dataclass(frozen=True)
class Hit:
    start: int
    end: int
    term: str
    edits: int
    quoted: bool
    addressed: bool
    weight: float


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the place stands between a quotation mark and its closing mark within QUOTE_SPAN characters and one line."""
    left = text[max(0, start - QUOTE_SPAN) : start].rpartition("\n")[2]
    right = text[end : end + QUOTE_SPAN].partition("\n")[0]
    for mark, closing in QUOTES.items():
        open_now = left.count(mark) % 2 == 1 if mark == closing else left.rfind(mark) > max(left.rfind(c) for c in closing)
        if open_now and any(c in right for c in closing):
            return True
    return False


def find_hits(text: str | None, automaton: Automaton, model: Model) -> tuple[list[Hit], int]:
    """Hits in order, and the number of words. Places are code points of the text in lower case where that keeps its length, else of the lowered text."""
    low = (text or "").lower()
    words = WORD.findall(low)
    if len(automaton.sets) > MAX_STATES:
        automaton.reset()
    met = {}
    for w in set(words):
        found = automaton.match(w)
        if found and not (found[1] and w in model.known):
            met[w] = found
    if not met:
        return [], len(words)
    out = []
    for i, m in enumerate(WORD.finditer(low)):
        if m.group() in met:
            term, edits = met[m.group()]
            said = quoted(low, m.start(), m.end()) or not REPORTS.isdisjoint(words[max(0, i - REPORT) : i])
            addressed = not ADDRESSES.isdisjoint(words[max(0, i - ADDRESS) : i + ADDRESS + 1])
            weight = model.terms[term] * EDIT_FACTOR**edits * (QUOTED_FACTOR if said else ADDRESSED_FACTOR if addressed else 1.0)
            out.append(Hit(m.start(), m.end(), term, edits, said, addressed, weight))
    return out, len(words)


def features(hits: list[Hit], n_words: int) -> list[float]:
    """Logarithms of the summed weights of all hits, and of the same a hundred words. A misspelled hit weighs less, and else counts as any other."""
    total = sum(h.weight for h in hits)
    return [math.log1p(total), math.log1p(100 * total / (n_words + 20))]


def signatures(words: list[str]) -> list[int]:
    """The least of SIGNATURES hashes each of the three-word shingles: near copies share most of them, other texts none. Without words -1."""
    if not words:
        return [-1] * SIGNATURES
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    if len(h) > 2:
        h = h[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ h[2:] * np.uint64(0x165667B19E3779F9)
    out = []
    for k in range(SIGNATURES):
        mixed = (h ^ np.uint64(k * 0x632BE59BD9B4E019 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        out.append(int((mixed * np.uint64(0x94D049BB133111EB)).min() >> np.uint64(1)))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """doc_id, text, label: about TRAIN_ROWS labelled documents of each class, chosen by a hash of the id, without copies of earlier ones.

    docs and labels have an id doc_id; rows without id, label or text don't train. A written table.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy("doc_id").agg(F.max(F.col(label_col)).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r["label"] in (0, 1)}
    share = F.when(F.col("label") == 1, F.lit(TRAIN_ROWS / max(sizes.get(1, 1), 1))).otherwise(TRAIN_ROWS / max(sizes.get(0, 1), 1))
    chosen = marked.where("label IN (0, 1)").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    # About 2 TRAIN_ROWS ids and labels at most, so that documents don't move.
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("sigs", pa.array([signatures(WORD.findall(t.as_py().lower())) for t in batch.column(1)], pa.list_(pa.int64())))

    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = written(arrow_map(rows, sign, f"doc_id {kind}, text string, label int, sigs array<long>"), "toxicity-sample")
    first = signed.select("doc_id", "label", F.posexplode("sigs").alias("k", "sig")).groupBy("label", "k", "sig").agg(F.min("doc_id").alias("doc_id"))
    new = first.groupBy("doc_id", "label").count().where(f"count = {SIGNATURES}").select("doc_id")
    return written(signed.drop("sigs").dropDuplicates(["doc_id"]).join(F.broadcast(new), "doc_id", "left_semi"), "toxicity-training")


def learned_terms(sample: DataFrame) -> tuple[dict[str, float], DataFrame]:
    """Weights of words and stems (with *) that toxic documents of the sample have and clean ones lack; and the documents of each word by class."""
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, own = [], []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = {w for w in WORD.findall(text.as_py().lower()) if 2 < len(w) <= 40}
                stems = {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
                terms += [*words, *stems]
                own += [label] * (len(words) + len(stems))
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(own, pa.int32())], names=["term", "label"])

    per = written(arrow_map(sample.select("text", "label"), count, "term string, label int").groupBy("term").agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("c")), "toxicity-terms")
    if not toxic or not clean:
        return {}, per
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (toxic + 1)) - F.log(c / (clean + 1))
    lower = odds - LOWER * F.sqrt(1 / t + 1 / c)
    # A bound (Chernoff's) of the chance that so many of the term's documents are toxic, if it had nothing to do with it.
    rate, share = toxic / (toxic + clean), F.col("t") / (F.col("t") + F.col("c"))
    ratio = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    chance = F.when(share > rate, F.exp(-(F.col("t") + F.col("c")) * (ratio(share, F.lit(rate)) + ratio(1 - share, F.lit(1 - rate))))).otherwise(1.0)
    tried = per.where(F.col("t") + F.col("c") >= TOXIC_DOCS).withColumn("purity", share)
    n_tried = max(tried.count(), 1)
    strong = tried.where(f"t >= {TOXIC_DOCS} AND purity >= {PURITY}").select("term", lower.alias("w"), chance.alias("chance")).where((F.col("w") >= LIFT) & (F.col("chance") * n_tried <= CHANCE_TERMS)).drop("chance")
    # A stem needs several words, else it says no more than its word.
    words = per.where("t > 0 AND term NOT LIKE '%*'").select(F.explode(F.array(*[F.concat(F.substring("term", 1, k), F.lit("*")) for k in STEMS])).alias("term"), F.col("term").alias("word"))
    several = words.groupBy("term").agg(F.countDistinct("word").alias("k")).where(f"k >= {STEM_WORDS}").select("term")
    chosen = strong.where("term NOT LIKE '%*'").unionByName(strong.where("term LIKE '%*'").join(several, "term", "left_semi"))
    return {r["term"]: float(r["w"]) for r in chosen.collect()}, per  # of the bounded sample's terms


def lexicon(sample: DataFrame) -> Model:
    """The terms of the sample and the seeds, without the logistic part."""
    learned, per = learned_terms(sample)
    seen = {r["term"]: (r["t"], r["c"]) for r in per.where(F.col("term").isin(list(SEEDS))).collect()}
    terms = {s: SEED_WEIGHT for s in SEEDS if sum(seen.get(s, (0, 0))) < 2 * TOXIC_DOCS}
    terms |= {t: w for t, w in learned.items() if not (t.endswith("*") and t[:-2] + "*" in learned and learned[t[:-2] + "*"] >= w)}
    automaton = Automaton(terms)
    known = per.where(f"c >= {KNOWN_DOCS} AND term NOT LIKE '%*'").select("term")

    def loose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [w for w in batch.column(0).to_pylist() if (found := automaton.match(w)) and found[1]]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["term"])

    model = Model(terms, frozenset(r["term"] for r in arrow_map(known, loose, "term string").collect()))
    clean = sample.where("label = 0")
    misspelled = score(clean, model).select(F.explode(F.array_distinct(F.transform(F.filter("hits", lambda h: h["edits"] > 0), lambda h: h["term"]))).alias("term"))
    often = misspelled.groupBy("term").count().where(F.col("count") > LOOSE_CLEAN * clean.count()).collect()
    model.spelled = frozenset(r["term"] for r in often)
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 200) -> tuple[float, list[float]]:
    """Weights by Newton's method; slopes are pulled to 0 by the ridge and never negative."""
    a = np.column_stack([np.ones(len(x)), x])
    pull = np.diag([1e-3] + [ridge] * x.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + pull @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), [max(0.0, float(v)) for v in w[1:]]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Model:
    """A model of the labelled documents; see training_sample(). Without both classes, seeds and default slopes.

    The logistic part is fitted on a quarter of the sample, with a lexicon of the other three; then the lexicon takes all.
    """
    sample = training_sample(docs, labels, label_col)
    quarter = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    model = lexicon(sample)
    apart = lexicon(sample.where(~quarter))
    scored = features_of(sample.where(quarter).select("doc_id", "text", "label"), apart).select("label", "x").collect()  # of the bounded sample
    y = np.array([r["label"] for r in scored])
    if len(set(y.tolist())) == 2:
        model.bias, model.slopes = logistic(np.array([r["x"] for r in scored]), y)
    return model


def features_of(rows: DataFrame, model: Model) -> DataFrame:
    """rows (doc_id, text, label) with x, their features."""
    automaton = model.automaton()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(*find_hits(t.as_py(), automaton, model)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    return arrow_map(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, label int, x array<double>")


HITS = "array<struct<start: int, end: int, term: string, edits: int, quoted: boolean, addressed: boolean, weight: double>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), hits: the terms found with their places, edits and contexts.

    Whole texts are read, of any length; null and empty texts have no hits and the score of such texts. Each row is scored by its text
    alone, so repeated rows and copies score alike; no rows give no rows. Other columns aren't read.
    """
    automaton = model.automaton()
    slopes = np.array(model.slopes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("addressed", pa.bool_()), ("weight", pa.float64())]))
        for batch in batches:
            scores, hits = [], []
            for text in batch.column(1):
                found, n = find_hits(text.as_py(), automaton, model)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.bias + float(slopes @ features(found, n)))))))
                hits.append([h.__dict__ for h in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(hits, kind)], names=["doc_id", "score", "hits"])

    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, hits {HITS}")


def held_out(name: str = "doc_id"):
    """Whether a document's label is kept from learning; a null id has no label, and isn't held out."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, learned from labels of those that aren't held out; score() says what nulls and repeated rows give."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
