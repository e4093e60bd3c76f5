"""Operators without SQL, and the pipeline, against plain versions of their own."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import bpe, fingerprints, html_extract, langid, licenses, mixing, secrets, sharding

MASK = (1 << 64) - 1


def hashed(*values):
    """The engine's xxhash64 of ints (32 bits), longs (tuples of one) and texts."""
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<q", v[0]) if isinstance(v, tuple) else struct.pack("<i", v)
        h = xxhash.xxh64_intdigest(data, seed=h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def made(n, seed=1, langs=("aa", "bb")):
    rng = random.Random(seed)
    syllables = {"aa": ["ba", "lo", "mi", "ra"], "bb": ["ke", "tu", "sir", "ön"]}
    text = lambda lang, k: " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(k))
    rows = []
    for i in range(n):
        lang = rng.choice(langs)
        kind = rng.random()
        old = rng.choice(rows) if rows else None
        if old and old[2] and kind < 0.15:
            t, lang = old[1].upper() if rng.random() < 0.5 else old[1], old[2]
        elif old and old[2] and kind < 0.35:
            own = old[1].split(" ")
            own[rng.randrange(len(own))] = text(lang, 1)
            t, lang = " ".join(own), old[2]
        elif kind < 0.4:
            t, lang = "чужой текст на другом языке " * rng.randint(1, 4), None
        elif kind < 0.45:
            t = "12 %% 34"
        else:
            t = text(lang, rng.randint(6, 80))
        rows.append((i, t, lang, rng.choice(["s1", "s1", "s2", None])))
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], "doc_id long, text string, lang string, source string, n_chars long")


# ---- op3


def plain_fingerprint(text, samples=fingerprints.SAMPLES):
    counts = Counter(words(lower(text)))
    uniform = lambda h, place: (((h >> (21 * place)) & ((1 << 21) - 1)) + 0.5) / (1 << 21)
    gamma = lambda h: -math.log(uniform(h, 0) * uniform(h, 1))
    out = []
    for p in range(samples):
        best = None
        for w, n in counts.items():
            h = hashed((signed(hashed(w)),), fingerprints.SEED, p // fingerprints.GROUP, p % fingerprints.GROUP)
            r, b = gamma(hashed((signed(h),))), uniform(h, 2)
            t = math.floor(math.log(n) / r + b)
            log_a = math.log(gamma(h)) - r * (1 + t - b)
            name = ((h >> 7) ^ (t * 0x9E3779B1)) & 0xFFFFFFFF
            value = (int((log_a + 128) * (1 << 23)) << 32) | name
            best = value if best is None else min(best, value)
        out.append(f"{best & 0xFFFFFFFF:08x}" if best is not None else "")
    return "".join(out)


def test_fingerprints_are_consistent_weighted_samples(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 40))), None, None) for i in range(40)] + [(50, "", None, None), (51, "A a\tB", None, None)]
    got = {r["doc_id"]: r for r in fingerprints.against_edits(documents(spark, rows)).collect()}
    for k, (i, t, _, _) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        a, b, c = map(plain_fingerprint, (t, edited, following))
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (a, b)
        like = lambda x, y: float(x == y) if not x or not y else np.mean([x[j : j + 8] == y[j : j + 8] for j in range(0, len(x), 8)])
        assert (got[i]["near_edited"], got[i]["near_next"]) == pytest.approx((like(a, b), like(a, c)))


# ---- op6


def plain_letters(text):
    folded = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    return " " + " ".join(folded.split()) + " " if folded.split() else ""


class PlainModel:
    """Interpolated Kneser-Ney of order 3, by recursion."""

    def __init__(self, texts, alphabet):
        self.counts = {3: Counter(t[i : i + 3] for t in texts for i in range(len(t) - 2))}
        for n in (2, 1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.alphabet = alphabet
        self.discount = {}
        for n, c in self.counts.items():
            ones, twos = (sum(v == k for v in c.values()) for k in (1, 2))
            self.discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5
        self.total, self.kinds = ({n: Counter() for n in (1, 2, 3)} for _ in range(2))
        for n, c in self.counts.items():
            for g, v in c.items():
                self.total[n][g[:-1]] += v
                self.kinds[n][g[:-1]] += 1
        self.p = cache(self._p)

    def _p(self, gram):
        if not gram:
            return 1 / (self.alphabet + 1)
        n, total = len(gram), self.total[len(gram)][gram[:-1]]
        lower_order = self.p(gram[1:])
        if not total:
            return lower_order
        d = self.discount[n]
        return max(self.counts[n][gram] - d, 0) / total + d * self.kinds[n][gram[:-1]] / total * lower_order

    def entropy(self, text):
        return -sum(math.log(self.p(text[i : i + 3])) for i in range(len(text) - 2)) / (len(text) - 2)


def plain_languages(spark, rows):
    """doc_id -> (language, entropy, rejected), learned as op6 must."""
    df = documents(spark, rows).where(~langid.held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    dealt = df.select("doc_id", (F.pmod(F.xxhash64(F.xxhash64(F.lit(langid.SEED), "doc_id", F.xxhash64("text"))), F.lit(langid.FOLD)) == 0).alias("held")).collect()
    held = {r["doc_id"]: r["held"] for r in dealt}
    langs = sorted({lang for i, _, lang, _ in rows if i in held})
    fit = {x: [t for t in (plain_letters(t) for i, t, lang, _ in rows if lang == x and held.get(i) is False) if t] for x in langs}
    alphabet = len({t[i] for ts in fit.values() for t in ts for i in range(2, len(t))} | {" "})
    models = {x: PlainModel(fit[x], alphabet) for x in langs}
    worst = {x: max([models[x].entropy(plain_letters(t)) for i, t, lang, _ in rows if lang == x and held.get(i) and plain_letters(t)], default=math.inf) for x in langs}
    out = {}
    for i, t, _, _ in rows:
        folded = plain_letters(t)
        if not folded:
            out[i] = ("und", None, True)
            continue
        entropy = {x: models[x].entropy(folded) for x in langs}
        best = min(langs, key=lambda x: (entropy[x], x))
        out[i] = (best, entropy[best], entropy[best] > worst[best] + langid.SLACK)
    return out


def test_languages_equal_a_recursive_model(spark):
    rows = [*made(150), (900, None, "aa", "s"), (901, "", None, None)]
    want = plain_languages(spark, rows)
    got = langid.predict(documents(spark, rows)).collect()
    assert len(got) == len(rows) and any(w[2] and w[1] for w in want.values())
    for r in got:
        lang, entropy, rejected = want[r["doc_id"]]
        assert (r["lang_pred"], r["rejected"]) == (lang, rejected)
        assert r["entropy"] == (pytest.approx(entropy, abs=1e-4) if entropy is not None else None)


# ---- op8


def test_shards_equal_a_plain_descent(spark):
    tree = {"r0": {"k0": {0: 1.0, 1: 3.0}, "k1": {2: 4.0}}, "r1": {"k2": {3: 8.0, 4: 0.0}, "k3": {5: 0.5}}}

    def descend(doc_id, node, path):
        if not isinstance(node, dict):
            return int(path.rpartition("/")[2])
        best = None
        for name, child in node.items():
            weight = sharding.weight_of(child)
            if weight > 0:
                at = f"{path}/{name}"
                u = ((hashed((doc_id,), at) >> 11) + 0.5) / 2**53
                best = min(best or (math.inf, "", None), (-math.log(u) / weight, at, child), key=lambda x: x[:2])
        return descend(doc_id, best[2], best[1])

    got = sharding.shard(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), tree).collect()
    assert all(r["shard"] == descend(r["doc_id"], tree, "seed0") for r in got)


# ---- op2


def test_pages_keep_what_only_they_have(spark):
    """Hosts whose pages share a site's lines in neutral markup, inside main and outside, and have lines of their own."""
    rng = random.Random(3)
    rows, want = [], {}
    for host in range(6):
        site = [f"site {host} line {k}" for k in range(rng.randint(1, 6))]
        for page in range(rng.randint(3, 40)):
            own = [f"own {host} {page} {k}" for k in range(rng.randint(1, 12))]
            lines = list(site[: len(site) // 2]) + own + site[len(site) // 2 :]
            lines = [(x, x in own) for x in lines]
            tag = "main" if host % 2 else "div"
            i = len(rows)
            rows.append((i, f"http://h{host}.org/{page:03}", f"<{tag}>" + "".join(f"<p>{x}</p>" for x, _ in lines) + f"</{tag}>"))
            want[i] = "\n\n".join(own)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract(df).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_pages_long_and_repeated(spark):
    long = "<main>" + "".join(f"<p>line {i}</p>" for i in range(60_000)) + "</main>"
    df = spark.createDataFrame([(1, "http://a.org/x", long), (1, "http://a.org/x", long), (2, None, None)], "page_id long, url string, html string")
    got = html_extract.extract(df).collect()
    assert sorted(r["n_chars"] for r in got) == [0, *[sum(len(f"line {i}") + 2 for i in range(60_000)) - 2] * 2]


# ---- op4, op7, op9: edges


def test_scans_of_long_repeated_and_no_rows(spark):
    long = "word " * 300_000 + "password = hunter22 mit license"
    rows = [(1, long), (1, long), (None, "mit license"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("findings", "matches", "ids", "decoded", "n_tokens")})
    found = secrets.summary(secrets.scan(df)).collect()
    start = long.index("password")
    assert Counter((r["doc_id"], r["spans"]) for r in found) == Counter({(1, f"assign:{start}:{start + 19}"): 2, (None, ""): 1, (2, ""): 1})
    licensed = licenses.summary(licenses.scan(df)).collect()
    assert Counter((r["doc_id"], r["labels"], r["last_word"]) for r in licensed) == Counter({(1, "mit", 300_002): 2, (None, "mit", 0): 1, (2, "", None): 1})
    path, pattern = bpe.installed()
    tokens = bpe.digests(df, path, pattern).collect()
    assert Counter(r["doc_id"] for r in tokens) == Counter({1: 2, None: 1, 2: 1})
    assert {r["decoded_sha256"] for r in tokens if r["doc_id"] == 1} == {hashlib.sha256(long.encode()).hexdigest()}
    empty = df.limit(0)
    assert secrets.scan(empty).count() == licenses.scan(empty).count() == bpe.digests(empty, path, pattern).count() == bpe.encode_texts(empty, path, pattern).count() == 0


# ---- pipeline


def plain_pipeline(spark, rows):
    """The rows of corpus_pipeline.run, from the given documents."""
    judged = plain_languages(spark, rows)
    rows = [r for r in rows if not judged[r[0]][2]]
    last = {}
    for r in rows:
        last[lower(r[1])] = max(last.get(lower(r[1]), -1), r[0])
    rows = [r for r in rows if last[lower(r[1])] == r[0]]
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    least = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                n = len(sets[a] & sets[b])
                if least[a] != least[b] and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    low, high = sorted((least[a], least[b]))
                    least = [low if x == high else x for x in least]
                    changed = True
    rows = [r for k, r in enumerate(rows) if least[k] == k]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in rows])
    copies = {i: taken // size for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall() if size}
    import tiktoken

    path, pattern = bpe.installed()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(path))}, special_tokens={})
    out = Counter()
    for i, t, _, _ in rows:
        ids = own.encode_ordinary(t)
        out[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] = copies.get(i, 0)
    return +out


@pytest.mark.parametrize("seed", [1, 5])
def test_pipeline_equals_plain_stages(spark, tmp_path, seed):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = made(140, seed)
    documents(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    want = plain_pipeline(spark, rows)
    assert len(want) > 20 and max(want.values()) == 2
    assert got == want


def test_pipeline_stages_keep_columns_and_take_nulls_and_no_rows(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [*made(30), (None, "ba lo mi ra " * 9, "aa", None), (None, None, None, None), (7, None, None, "s9"), (8, "ba " * 5000, None, "s1")]
    docs = documents(spark, rows).withColumn("component_id", F.lit(1)).withColumn("__copy_of", F.lit(2))
    for part in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, part, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, part, str(tmp_path)).count() == part.count()
