"""Language identification by interpolated Kneser-Ney character models.

One model of order 3 per language gives the probability of a character after its two predecessors:
discounted counts interpolated with continuation counts of the shorter contexts, down to a uniform
distribution over the learned alphabet and one unknown character. All languages' models lie side by side
in sorted arrays of n-gram hashes, one column per language; a binary search finds an n-gram once for all
languages. The language of least cross-entropy per character wins. A text is rejected if it has no letter, or if
its cross-entropy is far above what the calibration texts of the winning language have shown, and its score says so.

Texts are read as lower-case letters with each run of other characters as one blank, so that markup,
digits and noise marks don't decide a language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, bounded_batches, read, written

UNKNOWN_LANGUAGE = "und"
#: The models are fitted on about so many labelled texts of each language, the least of a seeded hash
#: of id and language; this bounds the models' size. Everything else reads all rows.
TRAIN_TEXTS = 2000
#: Of these, each FOLD-th text calibrates scores and rejection instead.
FOLD = 5
#: Rejection: above the worst calibration text's cross-entropy by this many nats a character.
SLACK = 1.5
#: How steeply the score falls where a text's cross-entropy passes that limit, at which it is halved: per nat a character.
STEEP = 4.0
SEED = 6
BLANK = ord(" ")
PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)

_folded: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank for all that are no letters."""
    global _folded
    if _folded is None:
        table = np.full(0x110000, BLANK, dtype=np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (ch := chr(c)).isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _folded = table
    return _folded


def letters(text: str) -> np.ndarray:
    """The folded text with single blanks, one before and one after; empty if it has no letter."""
    codes = fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    blank = codes == BLANK
    if blank.all():
        return codes[:0]
    keep = ~(blank & np.concatenate(([True], blank[:-1])))
    codes = codes[keep]
    return np.concatenate(([BLANK], codes if codes[-1] == BLANK else np.append(codes, BLANK))).astype(np.uint32)


def gram_hash(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each n-gram; unlike orders never meet in one array."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(codes) - n + 1), dtype=np.uint64)
        for i in range(n):
            out = (out ^ codes[i : len(codes) - n + 1 + i].astype(np.uint64)) * PRIMES[0]
            out ^= out >> np.uint64(29)
        return out


@dataclass
class Level:
    """N-grams of one order: sorted hashes, and per language the log probability of the last character."""

    keys: np.ndarray
    logp: np.ndarray


@dataclass
class Models:
    langs: list[str] = field(default_factory=list)
    grams: dict[int, Level] = field(default_factory=dict)
    #: By context length: sorted context hashes, and per language the log weight of the shorter context.
    weights: dict[int, Level] = field(default_factory=dict)
    floor: np.ndarray | None = None
    worst: np.ndarray | None = None
    sharpness: float = 1.0


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def train(counts: dict[str, dict[tuple[int, int, int], int]]) -> Models:
    """Models from trigram counts by language; (first, second, third) code points -> count."""
    models = Models(langs=sorted(counts))
    n_langs = len(models.langs)
    alphabet = {g[2] for c in counts.values() for g in c} | {BLANK}
    models.floor = np.full(n_langs, -np.log(len(alphabet) + 1))
    per: list[dict[int, dict[tuple, tuple[float, float]]]] = []
    orders: dict[int, set[tuple]] = {1: set(), 2: set(), 3: set()}
    for lang in models.langs:
        level: dict[int, dict[tuple, int]] = {3: dict(counts[lang]), 2: {}, 1: {}}
        for n in (3, 2):  # continuation counts: how many different characters precede
            for gram in level[n]:
                level[n - 1][gram[1:]] = level[n - 1].get(gram[1:], 0) + 1
        out: dict[int, dict] = {}
        for n in (1, 2, 3):
            ones = sum(1 for v in level[n].values() if v == 1)
            twos = sum(1 for v in level[n].values() if v == 2)
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total: dict[tuple, int] = {}
            kinds: dict[tuple, int] = {}
            for gram, v in level[n].items():
                total[gram[:-1]] = total.get(gram[:-1], 0) + v
                kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
            weight = {c: discount * kinds[c] / total[c] for c in total}
            out[n] = {"count": level[n], "discount": discount, "total": total, "weight": weight}
            orders[n] |= level[n].keys()
        per.append(out)

    uniform = 1.0 / (len(alphabet) + 1)

    def prob(model: dict, gram: tuple) -> float:
        lower = prob(model, gram[1:]) if len(gram) > 1 else uniform
        own = model[len(gram)]
        total = own["total"].get(gram[:-1])
        if not total:
            return lower
        return max(own["count"].get(gram, 0) - own["discount"], 0.0) / total + own["weight"][gram[:-1]] * lower

    for n, grams in orders.items():
        ordered = sorted(grams)
        keys = gram_hash(np.array(ordered, dtype=np.uint32).reshape(-1), n)[::n] if ordered else np.zeros(0, np.uint64)
        logp = np.log(np.array([[prob(m, g) for m in per] for g in ordered], dtype=np.float64).reshape(len(ordered), n_langs))
        at = np.argsort(keys, kind="stable")
        models.grams[n] = Level(keys[at], logp[at].astype(np.float32))
        contexts = sorted({g[:-1] for g in ordered})
        if n > 1:
            ckeys = gram_hash(np.array(contexts, dtype=np.uint32).reshape(-1), n - 1)[:: n - 1]
            clog = np.log(np.array([[m[n]["weight"].get(c, 1.0) for m in per] for c in contexts], dtype=np.float64).reshape(len(contexts), n_langs))
            at = np.argsort(ckeys, kind="stable")
            models.weights[n - 1] = Level(ckeys[at], clog[at].astype(np.float32))
    models.weights[0] = Level(np.zeros(1, np.uint64), np.log(np.array([[m[1]["weight"].get((), 1.0) for m in per]], dtype=np.float64)).astype(np.float32))
    models.worst = np.full(n_langs, np.inf)
    return models


def cross_entropy(models: Models, codes: np.ndarray) -> np.ndarray:
    """Nats per character under each language; codes as of letters(), not empty."""
    total = np.zeros(len(models.langs))
    for start in range(0, len(codes) - 2, 1 << 16):
        part = codes[start : start + (1 << 16) + 2]
        at, hit = _find(models.grams[3].keys, gram_hash(part, 3))
        total += models.grams[3].logp[at[hit]].sum(axis=0, dtype=np.float64)
        missed = np.flatnonzero(~hit)
        if len(missed):
            total += _backed_off(models, part, missed).sum(axis=0)
    return -total / max(1, len(codes) - 2)


def _backed_off(models: Models, part: np.ndarray, missed: np.ndarray) -> np.ndarray:
    """Log probabilities of characters whose trigram no language has."""
    out = np.zeros((len(missed), len(models.langs)))
    pairs, singles = gram_hash(part, 2), gram_hash(part, 1)
    open_rows, at = np.arange(len(missed)), missed
    for n, contexts, grams in ((2, pairs[at], pairs[at + 1]), (1, singles[at + 1], singles[at + 2])):
        own = models.weights[n]
        where, known = _find(own.keys, contexts[open_rows])
        out[open_rows[known]] += own.logp[where[known]]
        level = models.grams[n]
        where, hit = _find(level.keys, grams[open_rows])
        out[open_rows[hit]] += level.logp[where[hit]]
        open_rows = open_rows[~hit]
    out[open_rows] += models.weights[0].logp[0] + models.floor
    return out


def decide(models: Models, text: str | None) -> tuple[str, float, float | None, bool]:
    """Language, score, cross-entropy and whether it is rejected.

    The score is the calibrated probability among the learned languages times that of being one of them at all; a rejected
    text's is under a half.
    """
    codes = letters(text or "")
    if not len(codes) or not models.langs:
        return UNKNOWN_LANGUAGE, 0.0, None, True
    entropy = cross_entropy(models, codes)
    best = int(np.argmin(entropy))
    odds = np.exp(-(entropy - entropy[best]) * models.sharpness * np.sqrt(len(codes)))
    beyond = float(entropy[best] - models.worst[best] - SLACK)  # over 0: no learned language explains the text
    known = 1.0 / (1.0 + np.exp(min(50.0, STEEP * beyond)))
    return models.langs[best], float(known / odds.sum()), float(entropy[best]), beyond > 0


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_texts: int = TRAIN_TEXTS) -> Models:
    """Models of the languages in labelled; rows without text or language are left out.

    About train_texts rows of each language, those of least hash, are read whole. Trigrams are counted
    on the executors; the driver gets one row per language and trigram.
    """
    rows = labelled.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.withColumn("h", F.xxhash64(F.lit(SEED), "i", F.xxhash64("text")))
    share = F.least(F.lit(1.0), F.lit(float(train_texts)) / F.col("n"))
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", share.alias("share"))
    u = F.shiftrightunsigned("h", 11).cast("double") / F.lit(float(2**53))
    chosen = written(rows.join(F.broadcast(shares), "lang").where(u <= F.col("share")).select("lang", "text", (F.pmod(F.xxhash64("h"), F.lit(FOLD)) == 0).alias("held")), "langid-train")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, text, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = letters(text).astype(np.uint64)
                if held or len(codes) < 3:
                    continue
                packed, n = np.unique(codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:], return_counts=True)
                own = found.setdefault(lang, {})
                for gram, k in zip(packed.tolist(), n.tolist(), strict=True):
                    own[gram] = own.get(gram, 0) + k
        for lang, own in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())], names=["lang", "gram", "n"])

    grams = arrow_map(chosen, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, dict] = {}
    mask = (1 << 21) - 1
    for r in grams.toLocalIterator():
        counts.setdefault(r["lang"], {})[(r["gram"] >> 42, r["gram"] >> 21 & mask, r["gram"] & mask)] = r["n"]
    if not counts:
        return Models()
    models = train(counts)
    held = labelled.sparkSession.sparkContext.broadcast(models)

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            out: list[tuple] = []
            for lang, text, is_held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = letters(text)
                if is_held and len(codes) and lang in own.langs:
                    entropy, at = cross_entropy(own, codes), own.langs.index(lang)
                    other = np.delete(entropy, at)
                    out.append((lang, float(entropy[at]), float((other.min() - entropy[at]) * np.sqrt(len(codes))) if len(other) else 1.0))
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "entropy", "margin"), x, strict=True)) for x in out], pa.schema([("lang", pa.string()), ("entropy", pa.float64()), ("margin", pa.float64())]))

    probed = written(arrow_map(chosen, probe, "lang string, entropy double, margin double"), "langid-held")
    for r in probed.groupBy("lang").agg(F.max("entropy").alias("worst")).collect():
        models.worst[models.langs.index(r["lang"])] = r["worst"]
    grid = [0.1, 0.3, 1.0, 3.0, 10.0]
    losses = probed.agg(*[F.avg(F.log1p(F.exp(F.least(F.lit(50.0), F.lit(-s) * F.col("margin"))))).alias(f"s{i}") for i, s in enumerate(grid)]).first()
    if losses["s0"] is not None:
        models.sharpness = min(zip(losses, grid, strict=True))[1]
    return models


def identify(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """docs, every row and column, with __li_lang, __li_score (0 to 1), __li_entropy and __li_rejected.

    Null texts and texts without a letter are of language ``und`` and rejected, with score 0; so is
    everything if no language was learned. Languages that tie go to the first in order. Texts of any
    length are read whole.
    """
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("lang string, score double, entropy double, rejected boolean")
    def judge(texts: pa.Array) -> pa.Array:
        found = [decide(held.value, t.as_py()) for t in texts]
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], names=["lang", "score", "entropy", "rejected"])

    out = docs.withColumn("__li", judge(F.col(text_col)))
    return out.withColumns({"__li_lang": F.col("__li.lang"), "__li_score": F.col("__li.score"), "__li_entropy": F.col("__li.entropy"), "__li_rejected": F.col("__li.rejected")}).drop("__li")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def predict(docs: DataFrame, train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, entropy, rejected.

    Learns from the rows that are not held out. Repeated rows get equal answers; an empty table gives no
    rows, and where nothing can be learned all are ``und``. Columns other than doc_id, text and lang are not read.
    """
    rows = docs.select("doc_id", "text", "lang")
    models = fit(rows.where(~held_out(F.col("doc_id"))), train_texts=train_texts)
    out = identify(rows.select("doc_id", "text"), models)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__li_lang").alias("lang_pred"), F.col("__li_score").alias("score"), F.col("__li_entropy").alias("entropy"), F.col("__li_rejected").alias("rejected"))


def keep_identified(docs: DataFrame, train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """The rows of docs that are not rejected, with docs' columns."""
    models = fit(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))), train_texts=train_texts)
    return identify(docs, models).where(~F.col("__li_rejected")).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(read(spark, sf_dir, "documents"))
