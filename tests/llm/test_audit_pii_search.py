"""Source divergence, personal data and lexical search against plain versions, and on odd input."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import divergence, lexical, pii
from eventide.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n long, term string, rank int, k int, value long, m long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def rows_of(*texts):
    """(doc_id, text, lang, source) and columns whose names the operators use too."""
    return [(i, t, la, s, 7, "x", 1, 2, 3, None) for i, t, la, s in texts]


ODD = rows_of((1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "en", "s"), (4, "one 1.2.3.4", "en", "s"),
              (5, "the cat sat on the mat", "en", "a"), (5, "the cat sat on the mat", "en", "a"), (6, "THE CAT sat on the mat", "en", None),
              (None, "the cat sat on the mat", "en", "a"), (7, LONG, "en", "b"), (8, "%%% !!!", "de", "b"),
              (9, "日本語 テキスト 😀 é", "fr", "é"), (10, "cat", "de", None))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- Divergence ------------------------------------------------------------

def plain_audit(rows, least):
    groups, docs_with, count = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        count[lang, source].update(words)
        docs_with[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs_with[lang].items() if n >= least]
        mine = sorted(s for la, s in groups if la == lang)

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // total for t in kept}
        p = {s: shares(count[lang, s]) for s in mine}
        q = shares(sum((count[lang, s] for s in mine), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in mine if o != s]
            term = [(-f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            by = lambda x: (x[0], x[1].encode())
            out += [(lang, s, "pair", o, -v, i) for i, (v, o) in enumerate(sorted(pair, key=by), 1)]
            out += [(lang, s, "term", o, -v, i) for i, (v, o) in enumerate(sorted(term, key=by)[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("cells", [3, 200_000])
def test_divergence_equals_plain(spark, odd, monkeypatch, cells):
    monkeypatch.setattr(divergence, "TREE_CELLS", cells)
    monkeypatch.setattr(divergence, "HELD", 50)
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdé" for b in "XYz"]
    rows = rows_of(*[(i, " ".join(rng.choices(words, range(1, 16), k=rng.randrange(12))), rng.choice(["en", "de", None]),
                      rng.choice(["s1", "s2", "s3", "S", None])) for i in range(300)])
    for least in (10, 1):
        got = divergence.audit(spark.createDataFrame(rows, DOCS), least_docs=least)
        assert sorted(map(tuple, got.collect())) == plain_audit(rows, least)
    assert sorted(map(tuple, divergence.audit(odd, least_docs=2).collect())) == plain_audit(ODD, 2)
    assert sorted(map(tuple, divergence.audit(odd).collect())) == plain_audit(ODD, 10)      # no kept term: every value is 0


def test_divergence_of_nothing(empty):
    assert divergence.audit(empty).collect() == []


def test_tree_counts_a_shared_path_once():
    """Three rows, two nodes below the shared first one: each correction once per node, times its rows."""
    zero = np.array([5] * 6)
    ptr, source, count = np.array([0, 2, 4, 6]), np.array([1, 2, 1, 2, 1, 3]), np.array([7, 1, 7, 1, 7, 2])
    p = np.array([900, 100, 900, 100, 900, 300])
    a, b, value = divergence.tree_sums(ptr, source, count, p, zero, np.array([1, 4, 10]))
    f = lambda x, y: (x - y) ** 2 // (x + y)
    c = lambda x, y: f(x, y) - f(x, 5) - f(5, y) + f(5, 5)
    assert list(zip(a.tolist(), b.tolist(), value.tolist())) == [(1, 2, 5 * c(900, 100)), (1, 3, 10 * c(900, 300))]


# ---- Personal data ---------------------------------------------------------

def plain_base(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for alphabet in ("1234 56.789-+()@ab._% \n25", "0123456789", "a@b.c", "+1 -.()2", "12.٣é@"):
        for _ in range(3000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert pii.base_spans(t) == plain_base(t), t


def test_base_spans_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000, "a@" * 150_000, "+1" * 150_000, "1.2.3." * 50_000, "+1" + " " * 300_000, "x" * 300_000 + "1"):
        pii.graph_of(t, pii.base_spans(t))


def small_graph(n, chain, skip, held=None):
    return pii.Graph([(3 * i, 3 * i + 2) for i in range(n)], [[i % 5, 5 + i] for i in range(n)], chain, skip, held or [-1] * n)


def random_field(seed):
    rng = np.random.default_rng(seed)
    u = np.zeros((pii.BUCKETS, pii.LABELS))
    u[:20] = rng.normal(size=(20, pii.LABELS))
    s = rng.normal(size=(2, pii.LABELS, pii.LABELS))
    return pii.Field(u, rng.normal(size=(pii.LABELS, pii.LABELS)), s + s.transpose(0, 2, 1))


def plain_marginals(graph, field):
    n, total = len(graph.spans), np.zeros((len(graph.spans), pii.LABELS))
    unary = np.array([field.unary[f].sum(axis=0) for f in graph.features])
    for labels in product(range(pii.LABELS), repeat=n):
        s = sum(unary[i, x] for i, x in enumerate(labels)) + sum(field.chain[labels[i], labels[i + 1]] for i in graph.chain)
        s += sum(field.skip[k, labels[i], labels[j]] for i, j, k in graph.skip)
        for i, x in enumerate(labels):
            total[i, x] += math.exp(s)
    return total / total.sum(axis=1, keepdims=True)


def test_propagation_is_exact_without_loops():
    """A chain with a distant link that closes no loop, against enumeration; and two texts side by side."""
    graphs = [small_graph(4, [0, 1], [(1, 3, 1)]), small_graph(3, [1], [(0, 2, 0)]), small_graph(1, [], [])]
    field = random_field(1)
    batch = pii.Batch(graphs)
    got, joint = pii.propagate(batch, field, batch.scores(field), steps=60)
    want = np.concatenate([plain_marginals(g, field) for g in graphs])
    assert np.allclose(got, want, atol=1e-6)
    assert np.allclose(joint.sum(axis=2), got[batch.left], atol=1e-6) and np.allclose(joint.sum(axis=1), got[batch.right], atol=1e-6)
    for g, a, b in zip(graphs, batch.start[:-1], batch.start[1:]):        # alone as in company, at any number of rounds
        alone = pii.Batch([g])
        assert np.array_equal(pii.propagate(alone, field, alone.scores(field))[0],
                              pii.propagate(batch, field, batch.scores(field))[0][a:b])


def test_propagation_with_a_loop_is_near():
    graph, field = small_graph(4, [0, 1, 2], [(0, 3, 1)]), random_field(2)
    field = pii.Field(field.unary, field.chain * 0.3, field.skip * 0.3)
    batch = pii.Batch([graph])
    assert np.abs(pii.propagate(batch, field, batch.scores(field), 60)[0] - plain_marginals(graph, field)).max() < 0.05


def test_gradient_by_differences():
    graph = small_graph(4, [0, 1], [(1, 3, 1)], [1, -1, 4, 2])
    batch, field, gold = pii.Batch([graph]), random_field(3), np.array([1, 0, 4, 2])

    def loss(f):
        unary = np.array([f.unary[x].sum(axis=0) for x in graph.features])
        score = lambda y: (sum(unary[i, x] for i, x in enumerate(y)) + sum(f.chain[y[i], y[i + 1]] for i in graph.chain)
                           + sum(f.skip[k, y[i], y[j]] for i, j, k in graph.skip))
        every = [score(y) for y in product(range(pii.LABELS), repeat=4)]
        return np.logaddexp.reduce(every) - score(gold.tolist())
    batch_steps = pii.STEPS
    try:
        pii.STEPS = 60
        pii.propagate.__defaults__ = (60,)
        unary, chain, skip = pii.gradient(batch, field, gold)
    finally:
        pii.STEPS = batch_steps
        pii.propagate.__defaults__ = (batch_steps,)
    e = 1e-4
    for table, grad, at in ((field.unary, unary, (2, 4)), (field.unary, unary, (6, 0)), (field.chain, chain, (1, 0))):
        table[at] += e
        up = loss(field)
        table[at] -= 2 * e
        down = loss(field)
        table[at] += e
        assert abs((up - down) / (2 * e) - grad[at]) < 1e-4
    field.skip[1, 0, 2] += e
    field.skip[1, 2, 0] += e
    up = loss(field)
    field.skip[1, 0, 2] -= 2 * e
    field.skip[1, 2, 0] -= 2 * e
    assert abs((up - loss(field)) / (2 * e) - 2 * skip[1, 0, 2]) < 1e-4


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


WORDS = " the cat sat on the mat, and then there was a dog. "


def added(field, text):
    base, every = pii.find([text], field)[0]
    assert base == plain_base(text) and set(base) <= set(every) and every == sorted(every)
    return [(pii.KINDS[k], text[a:b]) for k, a, b in every if (k, a, b) not in base]


def test_known_numbers_in_other_notations_are_added(field):
    assert ("phone", "743-555-3824") in added(field, "+1 (743) 555-3824" + WORDS + "743-555-3824" + WORDS)
    assert ("card", "4785.3805.9239.1139") in added(field, "4785380592391139" + WORDS * 50 + "4785.3805.9239.1139" + WORDS)


def test_strange_numbers_are_left_alone(field):
    for t in ("743-555-3824" + WORDS, "+1 (743) 555-3824" + WORDS + "year 2024, page 12, 99.5 %" + WORDS,
              "4785380592391139" + WORDS + "1234.5678.9012.3456" + WORDS, "4785380592391138" + WORDS + "4785.3805.9239.1138", WORDS * 9, ""):
        assert added(field, t) == []


def test_scan_of_odd_rows(spark, odd, empty, field):
    rows = odd.unionByName(spark.createDataFrame(rows_of((11, LONG + " mail a.b@c.example.com and +1 (743) 555-3824", "en", "s")), DOCS))
    for f in (field, None):
        got = pii.scan(rows, f).collect()
        assert len(got) == rows.count() and set(rows.columns) < set(got[0].asDict())
        for r in got:
            base = plain_base(r.text or "")
            said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
            assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
            assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
    assert pii.fit(empty) is None and pii.scan(empty, None).count() == 0


def test_query_equals_plain_patterns(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op12_pii"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_base(docs[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()


# ---- Lexical search --------------------------------------------------------

def plain_terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain_search(docs, items, k=20):
    vectors = [(i, Counter(plain_terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in vectors)
    words = sum(sum(c.values()) for _, c in vectors)
    df = Counter(t for _, c in vectors for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(plain_terms(text)), []
        for i, c in vectors:
            if c:
                m = 75 + 25 * sum(c.values()) * n // words
                s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, r in asked.items() if c[t])
                if s > 0:
                    found.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def test_search_equals_plain(spark, odd, monkeypatch):
    items = spark.createDataFrame([(1, "the cat", "x"), (2, None, "x"), (3, "", "x"), (4, "テキスト mat mat W5x5", "x"), (None, "cat", "x"),
                                   (5, "unheard", "x"), (1, "the cat", "x")], "item_id long, text string, doc_id string")
    docs = [(r[0], r[1]) for r in ODD]
    want = plain_search(docs, [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, lexical.search(odd, items).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 20)                       # several blocks of items
    assert sorted(map(tuple, lexical.search(odd, items).collect()), key=repr) == want


def test_search_of_nothing(spark, odd, empty):
    items = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert lexical.search(empty, items).count() == 0 and lexical.search(odd, items.limit(0)).count() == 0
    assert lexical.search(odd, items).columns == lexical.search(empty, items).columns


@pytest.mark.parametrize("seed", range(12))
def test_trie_equals_scoring_all(seed):
    """Copies, common beginnings and ties: the walk finds what scoring every document finds, with fewer looks."""
    rng = random.Random(seed)
    kinds = rng.choice([3, 12, 200])
    docs = []
    for i in range(rng.choice([1, 40, 700])):
        if docs and rng.random() < 0.3:
            terms, m = rng.choice(docs)[1:]
        else:
            terms, m = {t: rng.randrange(1, 4) for t in range(kinds) if rng.random() < 0.9 / (1 + t)}, rng.randrange(75, 140)
        docs.append((i // 2, terms or {0: 1}, m))
    weight = np.array([rng.randrange(0, 4) * 100 * (1 + t) for t in range(kinds)])
    texts = [[rng.randrange(kinds) for _ in range(rng.randrange(6))] for _ in range(15)]
    items, best = lexical.Items(texts, weight), lexical.Best(15, 5)
    ptr = np.concatenate([[0], np.cumsum([len(t) for _, t, _ in docs])])
    tree = lexical.Trie(np.array([d for d, _, _ in docs]), np.array([m for *_, m in docs]), ptr,
                        np.array([t for _, c, _ in docs for t in sorted(c)]), np.array([c[t] for _, c, _ in docs for t in sorted(c)]))
    looked = tree.search(items, best)
    for i, asked in enumerate(texts):
        every = sorted((-sum(int(weight[t]) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c), d) for d, c, m in docs)
        assert best.found[i] == [x for x in every if x[0] < 0][:5]
    if len(docs) == 700:
        assert looked < 2 * len(docs)


def test_norm_is_exact(spark):
    rows = spark.range(1).select(F.lit(10 ** 12 + 7).alias("n"))
    docs, words = 10 ** 11 + 3, 10 ** 15 + 1
    assert rows.select(lexical.norm_of("n", docs, words)).first()[0] == 75 + 25 * (10 ** 12 + 7) * docs // words
