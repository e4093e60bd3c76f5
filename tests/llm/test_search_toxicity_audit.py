"""Ranked search, toxicity and the filter audit against plain versions, on edge cases of their tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import filter_audit, lexical_search, licenses, ngram_join, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("item", "rank", "score", "n", "key", "id", "term", "label", "part", "good", "hits")
ALPHABET = "alpha beta gamma delta épsilon zeta eta theta iota kappa".split()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows], SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in CLASHING})


def made(seed, n=80):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.3:
            rows.append((i, rng.choice(rows)[1], rng.choice(["en", "", None])))
        else:
            rows.append((i, " ".join(rng.choice(ALPHABET[: rng.randint(1, 10)]) for _ in range(rng.choice([1, 5, 40, 300]))) + rng.choice(["", "! #", " ABC DEF GHI", "\x0b\n"]), rng.choice(["en", "fr", None])))
    return [*rows, (n, None, "en"), (n + 1, "", None), (n + 2, "ALPHA " * 5000, "fr"), (n + 3, "x_y-z ÀB", "en"), (None, "alpha beta", "en"), (None, None, None), rows[3], rows[3]]


# Ranked search.


def plain_search(docs, items, k=10):
    term = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    counts = [(i, Counter(term(t))) for i, t, *_ in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 25 + (75 * c.total() * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in term(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


ITEMS = [(0, "Alpha beta beta"), (1, "kappa"), (2, None), (3, ""), (4, "unknown words"), (5, "x y z àb épsilon"), (6, " ".join(ALPHABET * 3)), (7, "alpha")]


@pytest.mark.parametrize(("seed", "postings"), [(1, 10**6), (2, 40), (3, 1)])
def test_search_equals_scoring_all(spark, monkeypatch, seed, postings):
    """Also with blocks of a few documents, and lists that take several rounds."""
    monkeypatch.setattr(lexical_search, "FIRST_DEPTH", 1 + seed % 2)
    rows = made(seed)
    best = {}
    # The blocks are cut in the tasks; here their search is driven directly.
    docs = [(i, lexical_search.terms_of(t)) for i, t, _ in rows]
    vocabulary = {}
    counts = [Counter(vocabulary.setdefault(t, len(vocabulary)) for t in lexical_search.terms_of(text)) for _, text in ITEMS]
    n_docs, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    np = lexical_search.np
    weights = np.array([lexical_search.weight(n_docs, sum(t in set(w) for _, w in docs)) for t in vocabulary] + [0], np.int64)
    held, blocks = [], []
    for i, w in docs:
        met = Counter(t for t in w if t in vocabulary)
        if met:
            held.append((i, len(w), [vocabulary[t] for t in met], list(met.values())))
        if sum(len(h[2]) for h in held) >= postings:
            blocks, held = [*blocks, held], []
    for block in [*blocks, held]:
        if block:
            flat = lambda k, block=block: np.array([x for h in block for x in h[k]], np.int64)
            built = lexical_search.Block([h[0] for h in block], np.array([h[1] for h in block]), np.array([len(h[2]) for h in block]), flat(2), flat(3), n_docs, total)
            for k, c in enumerate(counts):
                best[k] = built.search(lexical_search.Item(k, c, weights), np.zeros(len(weights), np.int64), best.get(k, []), 10)
    got = [(ITEMS[k][0], r, i, s) for k in range(len(ITEMS)) for r, (s, i) in enumerate([x for x in best.get(k, []) if x[0] > 0], 1)]
    assert got == plain_search(rows, ITEMS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    spread = lexical_search.search(frame(spark, rows), items).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in spread if r["doc_id"] is not None) == sorted(x for x in plain_search(rows, ITEMS) if x[2] is not None)


def test_search_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "PASS_BYTES", 40)
    rows = made(4, 30)
    got = lexical_search.search(frame(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string"), 3).collect()
    assert sorted(map(str, ((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got))) == sorted(map(str, plain_search(rows, ITEMS, 3)))


def test_search_without_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(frame(spark, made(1)).limit(0), items).count() == 0
    assert lexical_search.search(frame(spark, made(1)), items.limit(0)).count() == 0


# Toxicity.


def edits(a, b):
    """Optimal string alignment: insertions, deletions, replacements and swaps of neighbours."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@pytest.mark.parametrize("seed", range(3))
def test_the_automaton_equals_edit_distances(seed):
    rng = random.Random(seed)
    terms = {"".join(rng.choice("abcd") for _ in range(rng.randint(2, 11))): rng.random() + 0.1 for _ in range(40)}
    automaton = toxicity.Automaton(terms)
    for _ in range(3000):
        w = list(rng.choice(list(terms)))
        for _ in range(rng.randint(0, 3)):
            kind, at = rng.random(), rng.randrange(len(w) + 1)
            w[at:at] = [rng.choice("abcde")] if kind < 0.4 else []
            if kind > 0.4 and w:
                w.pop(rng.randrange(len(w)))
            if kind > 0.7 and len(w) > 2:
                w[0], w[1] = w[1], w[0]
        w = "".join(w)
        want = [(terms[t] * toxicity.EDIT_FACTOR ** edits(t, w), edits(t, w)) for t in terms if edits(t, w) <= toxicity.edits_allowed(t)]
        got = automaton.match(w)
        assert (got is None) == (not want)
        if got:
            assert terms[got[0]] * toxicity.EDIT_FACTOR ** got[1] == pytest.approx(max(want)[0])


def test_stems_and_spelled_terms():
    automaton = toxicity.Automaton({"lowei*": 2.0, "moron": 3.0, "trash": 1.0}, spelled=["trash"])
    assert automaton.match("loweichen") == ("lowei*", 0)
    assert automaton.match("lowei") is None
    assert automaton.match("loweh") is None
    assert automaton.match("moorn") == ("moron", 1) == automaton.match("m0ron")
    assert automaton.match("trasj") is None
    assert automaton.match("trash") == ("trash", 0)


def test_contexts_weigh():
    model = toxicity.Model({"idiot": 3.0})
    weigh = lambda text: sum(h.weight for h in toxicity.find_hits(text, model.automaton(), model)[0])
    plain = weigh("what an idiot indeed")
    assert weigh('she read "what an idiot indeed" aloud') < plain
    assert weigh("the word idiot is old") < plain
    assert weigh("you are an idiot") > plain > weigh("what an idoit indeed") > 0
    assert weigh("») idiot (« and \n“idiot") > 0
    assert toxicity.find_hits(None, model.automaton(), model) == ([], 0)


def test_states_are_let_go(monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_STATES", 5)
    model = toxicity.Model({"idiot": 3.0, "moron": 3.0})
    automaton = model.automaton()
    for text in ("idoit xyz", "moron abc", "idiot"):
        assert toxicity.find_hits(text, automaton, model)[0]


def labelled(seed, n):
    rng = random.Random(seed)
    bad = ["grunzel" + s for s in ("ab", "ek", "to", "ir", "um")] + ["idiot", "scum"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(["ba", "lo", "mi", "ra", "ke"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "en"))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    return rows, labels, {r[0]: bool(set(r[1].split()) & set(bad)) for r in rows}


def test_toxic_words_are_learned_and_held_out_rows_scored(spark):
    rows, labels, toxic = labelled(5, 500)
    rows = rows + [(1000, None, "en"), (1001, "", "en"), (1002, "ba " * 20000, "en"), (None, "idiot scum idiot", "en"), rows[0], rows[0]]
    docs = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs.where(~toxicity.held_out()), marks.where(~toxicity.held_out()))
    assert any(t.startswith("grunz") for t in model.terms)
    got = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect()
    assert len(got) == len(rows)
    tested = [(r["score"] >= 0.5, toxic[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    assert len(tested) > 60 and sum(a == b for a, b in tested) / len(tested) > 0.97
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1000] == by[1001] < 0.5 and by[1002] < 0.5 and by[None] > 0.5
    assert len({r["score"] for r in got if r["doc_id"] == 0}) == 1


def test_misspelled_terms_raise_the_score(spark):
    """Of a held-out text, although no training text misspells anything; quoted they raise it less."""
    rows, labels, _ = labelled(7, 400)
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    plain = " ".join(["balo mira keba"] * 10)
    texts = [plain, plain + " idoit grunzeltto idi0t scum", plain + ' "idoit" "scum"', plain + " idiot scum scum idiot"]
    clean, misspelled, quoted, spelled = (r["score"] for r in toxicity.score(frame(spark, [(i, t, "en") for i, t in enumerate(texts)]), model).orderBy("doc_id").collect())
    assert clean < quoted < misspelled < spelled
    assert clean < 0.5 < misspelled


def test_toxicity_without_labels(spark):
    rows, labels, _ = labelled(6, 20)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame(spark, rows), none)
    assert set(model.terms) == set(toxicity.SEEDS)
    assert toxicity.score(frame(spark, rows).limit(0), model).count() == 0


# The filter audit.


def test_the_audit_equals_every_order_played(spark):
    rows = [r for r in made(7) if r[0] is not None]
    rng = random.Random(8)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 90, 2)] + [(0, 1, 1), (500, 1, 1)]
    docs, marks = frame(spark, rows), spark.createDataFrame([*labels, (None, 1, 1)], "doc_id long, quality int, toxic int")
    first, said = {}, {}
    for i, t, _ in rows:
        first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        said.setdefault(i, [False, False])
        said[i] = [said[i][0] or q == 1, said[i][1] or x == 1]

    def failing(i, t):
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        return {f for f, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), i > first[t]), strict=True) if bad}

    parts = {}
    for i, t, lang in rows:
        parts.setdefault(lang or "", []).append((failing(i, t), said.get(i, [False, False])))
    want, shapley = [], Counter()
    for part, own in parts.items():
        for order in permutations("ABCDE"):
            here = list(own)
            for step, f in enumerate(order, 1):
                lost, here = [x for x in here if f in x[0]], [x for x in here if f not in x[0]]
                shapley[part, f] += len(lost)
                want.append([part, "".join(order), step, len(here), len(lost), sum(f in x[0] for x in own) - len(lost), sum(x[0] == {f} for x in own), sum(x[1][0] for x in lost), sum(x[1][1] for x in lost), f])
    want = sorted([*w[:-1], shapley[w[0], w[-1]]] for w in want)
    got = filter_audit.audit(filter_audit.patterns(docs, marks), list("ABCDE"))
    assert sorted(map(list, got.collect())) == want


def test_the_audit_of_nameless_rows_and_none(spark):
    docs = frame(spark, [(None, "a", None), (None, "a", None), (2, "a", None), (1, "a", "x"), (1, "a", "x")])
    counted = filter_audit.patterns(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert sorted((r["part"], r["E"], r["n"]) for r in counted) == [("", False, 2), ("", True, 1), ("x", False, 2)]
    none = filter_audit.patterns(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert filter_audit.audit(none, list("ABCDE")).count() == 0


def test_the_sql_of_search_and_audit(spark):
    con = duckdb.connect()
    data = "/root/testdata/sf0.001"
    for t in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for op in (lexical_search, filter_audit):
        got = op.query(spark, data)
        want = con.sql(op.SQL)
        at = [want.columns.index(c) for c in got.columns]
        assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


# Words that a polynomial hash modulo a power of two can't tell apart.


@pytest.mark.parametrize("doublings", [8, 10, 12])
def test_complements_of_one_word_are_no_copies(spark, doublings):
    a, b = "a", "b"
    for _ in range(doublings):
        a, b = a + b, b + a
    docs = frame(spark, [(1, a, "en"), (2, b, "en"), (3, a.upper(), "en"), (4, a + b, "en"), (5, b + a, "en")])
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(docs).collect()) == [1, 2, 4, 5]


# Licences in their usual spellings.


@pytest.mark.parametrize(("text", "label"), [
    ("released under the BSD license", "bsd"), ("licensed under Apache-2.0", "apache"), ("SPDX-License-Identifier: MIT", "mit"), ("GNU Affero General Public License", "agpl"),
    ("Creative Commons Attribution 4.0 International License", "cc-by"), ("Eclipse Public License - v 2.0", "epl"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl"), ("an apache rode past two mit students", None),
])
def test_names_and_tags_are_found(text, label):
    index = licenses.Index(licenses.templates(), {}, 10)
    assert ({t.label for _, _, t in index.find(licenses.words_of("see " + text + " for all"))} or {None}) == {label}
