"""Learned and hashed parts against plain code: ratios, hinge optimum, features, lexicon, subset hashes, likeness."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

from eventide.llm import ann, imatch, langid, quality

MASK = (1 << 64) - 1
SMALL = "/root/testdata/sf0.001"


# ---- Quality: ratios, optimum, features ---------------------------------------

def test_log_count_ratio():
    rows = [np.array([1, 5, 9]), np.array([5, 7]), np.array([1, 2]), np.array([9])]
    y = np.array([1.0, -1.0, 1.0, -1.0])
    got = quality.log_count_ratio(rows, y)
    count = {c: Counter(b for r, l in zip(rows, y) if l == c for b in r.tolist()) for c in (1, -1)}
    total = {c: sum(count[c].values()) + quality.BUCKETS for c in (1, -1)}
    for b in (0, 1, 2, 5, 7, 9):
        want = math.log((count[1][b] + 1) / total[1]) - math.log((count[-1][b] + 1) / total[-1])
        assert abs(got[b] - want) < 1e-12


def test_coordinate_descent_reaches_the_hinge_optimum():
    """Against slow projected gradient ascent on the same dual, and by the duality gap."""
    rng = np.random.default_rng(3)
    n, width, cost = 24, 12, 0.7
    rows = [np.sort(rng.choice(width, 5, replace=False)) for _ in range(n)]
    values = [rng.normal(size=5) for _ in range(n)]
    y = np.where(rng.random(n) < 0.5, 1.0, -1.0)
    x = np.zeros((n, width + 1))
    for i in range(n):
        x[i, rows[i]], x[i, width] = values[i], 1.0          # the bias is one more, regularised weight
    w, bias = quality.coordinate_descent(rows, values, y, cost, rounds=4000)
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha = np.zeros(n)
    for _ in range(60_000):
        alpha = np.clip(alpha + (1 - q @ alpha) / np.linalg.norm(q, 2), 0, cost)
    best = (alpha * y) @ x
    assert np.allclose(np.append(w[:width], bias), best, atol=5e-3)
    primal = 0.5 * (w @ w + bias * bias) + cost * sum(max(0.0, 1 - y[i] * (w[rows[i]] @ values[i] + bias)) for i in range(n))
    assert primal - (alpha.sum() - 0.5 * best @ best) < 1e-3 * primal


def plain_quality_features(text):
    tokens = quality.TOKEN.findall(text)
    one = lambda v: np.array([v], dtype=np.uint64)
    w = [one(quality.hash_word(t)) for t in tokens]
    s = [one(quality.hash_shape(quality.shape(t))) for t in tokens]
    found = set()
    for i in range(len(tokens)):
        found |= {int(quality._mix(w[i], 1)[0]), int(quality._mix(s[i], 2)[0])}
        if i >= 1:
            found |= {int(quality._mix(w[i - 1], w[i], 3)[0]), int(quality._mix(s[i - 1], s[i], 4)[0])}
            if tokens[i] == tokens[i - 1]:
                found.add(int(quality._mix(s[i], 6)[0]))
        if i >= 2:
            found.add(int(quality._mix(s[i - 2], s[i - 1], s[i], 5)[0]))
            if tokens[i] == tokens[i - 1] == tokens[i - 2]:
                found.add(int(quality._mix(s[i], 7)[0]))
    return sorted(found)


def test_quality_features_are_the_plain_n_grams():
    texts = ["the cat sat, sat sat on THE mat", None, "", "x", "a a a a", "12 %% é", "one two"]
    doc, bucket = quality.features(texts, quality.coder())
    for i, t in enumerate(texts):
        assert bucket[doc == i].tolist() == plain_quality_features(t or "")


def test_quality_score_is_the_weighted_sum():
    rng = np.random.default_rng(1)
    model = quality.Nbsvm(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3, (1.5, -0.2))
    texts = ["the cat sat on the mat", "", "buy now now now"]
    doc, bucket = quality.features(texts, quality.coder())
    got = model.scores(model.margins(doc, bucket, len(texts)))
    for t, s in zip(texts, got):
        margin = sum(float(model.weight[b]) for b in plain_quality_features(t)) + 0.3
        assert abs(s - 1 / (1 + math.exp(-(1.5 * margin - 0.2)))) < 1e-9


# ---- Language ID: features ------------------------------------------------------

def plain_buckets(word):
    """Buckets of the n-grams of a word with its borders, and of the whole word."""
    points = [2, *map(ord, word), 3]
    p, out = 0x9E3779B97F4A7C15, []

    def bucket(h):
        h = (h ^ (h >> 33)) * 0xFF51AFD7ED558CCD & MASK
        return (h ^ (h >> 33)) >> 48

    for n in range(1, langid.NGRAMS + 1):
        for i in range(len(points) - n + 1):
            h = 0
            for c in points[i:i + n]:
                h = (h * p + c & MASK) ^ (h >> 29)
            out.append(bucket(h + n & MASK))
    whole = sum((c + 7) * (i * p & MASK ^ 0xD6E8FEB86659FD93) for i, c in enumerate(points)) & MASK
    return Counter([*out, bucket(whole + 99 & MASK)])


def test_language_features_are_the_plain_n_grams():
    words = ["a", "cat", "straße", "日本", "aaaa", "x" * 40]
    buckets, rows = langid.word_features(words)
    for i, w in enumerate(words):
        assert Counter(buckets[rows == i].tolist()) == plain_buckets(w)


def test_language_posterior_is_the_sum_over_all_paths():
    """A text's label and score against enumeration of every label sequence."""
    model = langid.train([("de", "der hund und die katze".split()), ("en", "the dog and the cat".split()),
                          ("fr", "le chien et le chat".split())] * 4, rounds=15)
    text = "the katze et dog"
    emit = model.emissions(langid.words_of(text))
    k, n = len(model.labels), len(emit)
    weight = np.zeros((n, k))
    for path in np.ndindex(*[k] * n):
        s = model.start[path[0]] + sum(emit[i, x] for i, x in enumerate(path)) + sum(model.trans[a, b] for a, b in zip(path, path[1:]))
        for i, x in enumerate(path):
            weight[i, x] += math.exp(s)
    mean = (weight / weight.sum(axis=1, keepdims=True)).mean(axis=0)
    labels, scores, _ = langid.label_texts(model, [text])
    assert labels == [model.labels[int(mean.argmax())]] and abs(scores[0] - mean.max()) < 1e-4


# ---- I-Match: lexicon, subset hashes, likeness -------------------------------------

def test_lexicon_is_the_band_of_document_frequencies(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [r.text or "" for r in docs.collect()]
    df = Counter(t for text in texts for t in set(re.findall(r"\w+", text.lower())))
    for low, high in ((2e-4, 0.1), (0.05, 0.5), (0.9, 0.95)):
        lo, hi = max(2, math.ceil(low * len(texts))), max(2, math.floor(high * len(texts)))
        assert imatch.lexicon(docs, "text", low, high) == sorted(t for t, n in df.items() if lo <= n <= hi)


def plain_fingerprint(text, known):
    terms = set(re.findall(r"\w+", text.lower())) or ({text} if text else set())
    used = {t for t in terms if t in known} or terms
    hashed = sorted({xxhash.xxh64_intdigest(t.encode(), 1): t for t in used}.items())
    out = [0] * imatch.CODES
    for level in range(imatch.LEVELS):
        subsets = defaultdict(list)
        for h, t in hashed:
            pick = xxhash.xxh64_intdigest(t.encode(), 10 + level)
            if (pick >> 32) % 4 ** level == 0:
                subsets[level * imatch.SUBSETS + pick % imatch.SUBSETS].append(h)
        for s, hs in subsets.items():
            total = 0
            for place, h in enumerate(hs, 1):
                x = (h ^ place * int(imatch._M) & MASK) * 0xFF51AFD7ED558CCD & MASK
                total += x ^ (x >> 31)
            out[s] = max((total * int(imatch._M) & MASK) >> 48, 1)
    return out


def test_fingerprints_are_the_plain_subset_hashes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = set(imatch.lexicon(docs))
    texts = [r.text or "" for r in docs.limit(40).collect()] + ["", "%%%", "no such words zzqq", "Ünï ünï"]
    got = imatch.fingerprints(texts, imatch.term_codes(known))
    for t, row in zip(texts, got):
        assert row.tolist() == plain_fingerprint(t, known)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    per = imatch.SUBSETS
    levels = [(sum(x > 0 or y > 0 for x, y in zip(a[i:i + per], b[i:i + per])), sum(x == y > 0 for x, y in zip(a[i:i + per], b[i:i + per])))
              for i in range(0, len(a), per)]
    at = next((i for i, (full, _) in enumerate(levels) if full <= 0.7 * per), len(levels) - 1)
    while at > 0 and sum(f for f, _ in levels[at:]) == 0:
        at -= 1
    return sum(s for _, s in levels[at:]) / max(1, sum(f for f, _ in levels[at:]))


def test_likeness_is_the_share_of_equal_hashes():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    codes = imatch.term_codes(set(words))
    for n in (1, 5, 60, 400):
        a = [" ".join(rng.sample(words, n)) for _ in range(8)]
        b = [" ".join(w if rng.random() < 0.8 else rng.choice(words) for w in t.split()) for t in a]
        x, y = imatch.fingerprints(a, codes), imatch.fingerprints(b, codes)
        assert np.allclose(imatch.likeness(x, y), [plain_likeness(p, q) for p, q in zip(x.tolist(), y.tolist())])


# ---- Nearest neighbours: results do not depend on the blocks --------------------------

def test_block_sizes_do_not_change_the_result(spark, monkeypatch):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding")
    want = sorted(map(tuple, ann.search(rows).collect()))
    monkeypatch.setattr(ann, "INDEX_ROWS", 97)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    assert sorted(map(tuple, ann.search(rows).collect())) == want
