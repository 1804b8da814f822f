"""The llm operators against plain versions, and on odd input (nulls, empty, repeated, very long, extra columns)."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from eventide.llm import ann, bpe, chat, imatch, langid, licenses, mixing, quality, simhash, urls
from eventide.llm.components import components
from eventide.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ODD = [(1, None, None, None, None, 0.5, "x"), (2, "", "en", "s", 0, None, None), (3, " \n\t ", "en", "s", 3, None, None),
       (4, "one", "en", "s", 3, None, None), (5, "the cat sat on the mat", "en", "a", 1, None, None),
       (5, "the cat sat on the mat", "en", "a", 1, None, None), (6, "THE CAT sat on the mat", "en", None, 1, None, None),
       (None, "the cat sat on the mat", "en", "a", 1, None, None), (7, LONG, "en", "b", 1, None, None),
       (8, "%%% !!!", "de", "b", 1, None, None), (9, "日本語 テキスト 😀 \u0000 é", "fr", "é", 1, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# ---- SimHash ---------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def plain_components(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    fps = list(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_simhash_against_plain(spark, odd):
    for docs in (odd, docs_of(spark)):
        rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        comp = plain_components({f for _, f in rows})
        least = {}
        for i, f in rows:
            if i is not None:
                least[comp[f]] = min(i, least.get(comp[f], i))
        want = sorted((repr(i), f"{f:016x}", least.get(comp[f])) for i, f in rows)
        got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("f"), "component_id")
        assert sorted((repr(r.doc_id), r.f, r.component_id) for r in got.collect()) == want


def test_simhash_crowded_blocks(spark):
    """A dense ball, chains and strangers: every way of linking gives the components of all links."""
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 4))) for _ in range(150)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    chain = rng.getrandbits(64)
    for i in range(0, 60, 3):
        chain ^= 7 << i
        fps.add(chain)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = plain_components(set(fps))
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for edges in (simhash.link_edges(df, hot=4), simhash._ball_edges(df), simhash.link_edges(df)):
        got = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in components(edges).collect()}
        same = {}
        for f in fps:
            same.setdefault(want[f], set()).add(got.get(f, f))
        assert all(len(v) == 1 for v in same.values()) and len({min(v) for v in same.values()}) == len(same)


def test_keep_one(spark, odd, empty):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # 1, 2, 3 share fingerprint zero; 5 (twice), 6 and the row without id are one text up to case.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 7, 8, 9]
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0
    loose = odd.filter("doc_id IS NULL")
    assert simhash.keep_one(loose.unionAll(loose)).count() == 1


# ---- language, quality -----------------------------------------------------

def test_langid_held_out_and_odd(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = langid.predict(docs, model, keep=["doc_id", "lang"]).withColumn(
        "h", langid.held_out(F.col("doc_id"), 4, 2)).filter("h").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.h for r in rows)
    got = langid.predict(odd, model).collect()
    assert [r.lang_pred for r in got if r.text is None or not re.search(r"[^\W\d_]", r.text)] == ["und"] * 4
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(ODD)
    assert langid.fit(empty) is None and langid.predict(empty, None).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


def test_forward_backward_is_the_plain_recursion():
    rng = np.random.default_rng(0)
    lengths, k = np.array([1, 64, 65, 200, 3]), 3
    emit, move, start = rng.random((lengths.sum(), k)) + .01, rng.random((k, k)) + .05, rng.random(k)
    alpha, beta = langid.forward_backward(emit, lengths, move, start)
    post = alpha * beta / (alpha * beta).sum(axis=1, keepdims=True)
    at = 0
    for n in lengths:
        e = emit[at:at + n]
        a, b = np.zeros((n, k)), np.ones((n, k))
        for t in range(n):
            a[t] = (start if t == 0 else a[t - 1] @ move) * e[t]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = move @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        want = a * b / (a * b).sum(axis=1, keepdims=True)
        assert np.allclose(post[at:at + n], want)
        at += n


def test_code_switched_words_get_their_own_labels():
    spans = [("a", "aba baab abba aab bab".split())] * 30 + [("z", "zyz yzzy zyy yyz zzy".split())] * 30
    model = langid.train(spans)
    words = "aba abba bab zyz yyz zzy".split()
    emit = langid._exp(model.emissions(words))
    alpha, beta = langid.forward_backward(emit, np.array([6]), np.exp(model.trans), np.exp(model.start))
    assert (alpha * beta).argmax(axis=1).tolist() == [0, 0, 0, 1, 1, 1]


def test_quality_held_out_and_odd(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = (quality.score(docs, model, keep=["doc_id"]).join(labels, "doc_id")
            .filter(langid.held_out(F.col("doc_id"), 5, 0)).collect())
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([(r.score >= quality.THRESHOLD) == r.quality for r in rows]) > 0.9
    got = quality.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    none = quality.fit(empty, labels)
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


def test_quality_sample_skips_a_text_that_does_not_fit(spark):
    """One long text early in the order does not end the sample."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    order = [r.doc_id for r in labels.filter(~langid.held_out(F.col("doc_id"), 5, 0))
             .orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").collect()]
    for place in (0, 1):
        docs = spark.createDataFrame([(i, "ab cd " * (500 if i == order[place] else 5)) for i in range(60)], "doc_id long, text string")
        rows, got = quality.sample(docs, labels, max_chars=2000)
        assert len(rows) == len(got) == len(order) - 1 and set(got) == {0, 1}


# ---- mixing ----------------------------------------------------------------

def test_mixing_targets_limits_and_reruns(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    rows = mixing.mix(docs).collect()
    taken, sizes, target = {}, {}, {}
    for r in rows:
        assert 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
        sizes[r.source], target[r.source] = r.source_size, r.target
    assert abs(sum(target.values()) / (1.5 * sum(sizes.values())) - 1) < 1e-9
    assert all(target[s] <= 2 * sizes[s] + 1e-6 and abs(taken[s] / target[s] - 1) < 0.05 for s in target)
    again = {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}
    sized = odd.withColumn("size", mixing.word_count(F.col("text")))
    got = mixing.mix(sized).collect()
    assert len(got) == len(ODD) and {r["size"] for r in got if not (r.text or "").strip()} == {0}
    assert mixing.mix(empty.withColumn("size", F.lit(1).cast("long"))).count() == 0


def test_mixing_copies_are_systematic(spark):
    """Copies along the order are the integer crossings of one running sum."""
    docs = spark.createDataFrame([(i, "a" if i % 3 else "b", 5) for i in range(900)], "doc_id long, source string, size long")
    rows = mixing.mix(docs).collect()
    for s in "ab":
        part = [r for r in rows if r.source == s]
        assert abs(sum(r.copies for r in part) - part[0].target / 5) <= 1


# ---- byte-level BPE --------------------------------------------------------

def test_bpe_is_tiktoken(spark, odd, empty):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    encoder = bpe.load(path, P.PATTERN)
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    rng = random.Random(1)
    letters = [chr(i) for i in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600, 0x4E2D, 0x660, 0x16EE, 0x180E]]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 5000 + "ab" * 700, "x" * 64, "x" * 65, " " * 300 + "q", "it's <|endoftext|> we'll\r\n\r\n  go"]
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert ids.tolist() == other.encode_ordinary(text)
        assert encoder.decode(ids.tolist()) == text.encode()
    for piece in ("tokenization", "ééé", "x" * 70):
        assert encoder.merge(piece.encode()) == other.encode_ordinary(piece)
    for r in bpe.tokenize(odd, path, P.PATTERN, with_ids=True).collect():
        ids = other.encode_ordinary(r.text or "")
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.tokenize(empty, path, P.PATTERN).count() == 0


# ---- I-Match ---------------------------------------------------------------

def test_imatch_edits_and_order(spark, odd, empty):
    docs = docs_of(spark)
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in imatch.compare(docs).collect()}
    assert len(got) == len(texts)
    for n, (i, t) in enumerate(texts):
        after, half = texts[(n + 1) % len(texts)][1], len(t) // 2
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
    by_text = {}
    for i, t in texts:
        by_text.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.9
    rows = imatch.compare(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert imatch.compare(empty).count() == 0
    one = imatch.compare(odd.filter("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_document_frequency_counts_all(spark):
    docs = spark.createDataFrame([("a b a",), ("B c",), (None,), ("",)], "text string")
    assert {r.term: r.df for r in imatch.document_frequency(docs).collect()} == {"a": 1, "b": 2, "c": 1}


# ---- nearest neighbours ----------------------------------------------------

def test_ann_recall_scores_and_ties(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rows += [(10_000_000 + i, rows[50][1]) for i in range(8)]           # copies of a query: ties to smaller ids
    odd = [(10_000_050, None), (10_000_100, [0.0] * 64), (10_000_150, [float("nan")] + [1.0] * 63),
           (10_000_200, [None] + [1.0] * 63), (10_000_250, [1.0] * 3), (None, [1.0] * 64)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    norms, hit, total = np.sqrt((x * x).sum(axis=1)), 0, 0
    found = {}
    for r in ann.search(df).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    for n in np.flatnonzero(ids % 50 == 0):
        s = (x * x[n]).sum(axis=1) / (norms * norms[n])
        s[n] = -9
        order = np.lexsort((ids, -s))[:5]
        got = sorted(found[ids[n]])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        exact = dict(zip(ids.tolist(), s))
        assert all(abs(exact[v] - sc) < 1e-12 for _, v, sc in got)
        hit += len({v for _, v, _ in got} & set(ids[order].tolist()))
        total += 5
    assert hit / total >= 0.9
    assert [v for _, v, _ in sorted(found[50])] == [10_000_000 + i for i in range(5)]
    few = spark.createDataFrame([(50, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r.vec_id, r.score) for r in ann.search(few).collect()] == [(1, 3, 0.0)]
    assert ann.search(few.limit(0)).count() == 0


def test_multi_index_finds_every_code_in_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, size=(500, 4), dtype=np.uint16)
    codes[1] = codes[0] ^ np.array([1, 0, 3, 0], dtype=np.uint16)
    index = ann.MultiIndex(codes)
    for q in codes[:20]:
        for radius in (0, 3, 17, 24, 30):
            rows, _ = index.within(q, radius)
            assert set(rows) == set(np.flatnonzero(ann.distances(q, codes) <= radius))


# ---- native operators ------------------------------------------------------

def test_licenses(spark, odd, empty):
    mit = dict(licenses.LICENSES)["MIT"]
    changed = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("LICENSE", "LICENCE").replace(".", " . ") + "\n\n"
    docs = spark.createDataFrame([(1, mit), (2, changed), (3, mit + " and more"), (4, "text\n  *Released under the MIT Licence*\nx"),
                                  (5, None), (6, "")], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(docs).collect()}
    assert got == {1: ("MIT", None), 2: ("MIT", None), 3: (None, None), 4: (None, "MIT"), 5: (None, None), 6: (None, None)}
    assert len(licenses.scan(odd).collect()) == len(ODD) and licenses.scan(empty).count() == 0
    names = [r.license for r in licenses.scan(spark.createDataFrame(licenses.LICENSES, "doc_id string, text string")).collect()]
    assert sorted(names) == sorted(n for n, _ in licenses.LICENSES)


def test_licenses_usual_wordings(spark):
    texts = dict(licenses._BASE)
    mit, bsd = texts["MIT"].split("\n", 1)[1], texts["BSD-3-Clause"].split("\n", 1)[1]
    apache, gpl = (open(f"{licenses.__file__[:-11]}license_texts/{n}.txt").read() for n in ("Apache-2.0", "GPL-2.0"))
    rows = [("MIT", None, "The MIT License (MIT)\n\nCopyright (c) Microsoft Corporation.\n" + mit), ("MIT", None, mit),
            ("MIT", None, "MIT License\n\nCopyright © The Authors\n\n" + mit), ("Apache-2.0", None, apache), ("GPL-2.0", None, gpl),
            ("Apache-2.0", None, apache[:apache.index("END OF TERMS")]),
            ("BSD-3-Clause", None, "Copyright (c) 2009 A\nAll rights reserved.\n" + bsd.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR")),
            ("BSD-3-Clause", None, re.sub(r"\n[123]\. ", "\n * ", bsd)),
            (None, "GPL-2.0", "x\nLicensed under the GNU General Public License, version 2.\ny"), (None, "CC-BY-4.0", "Licensed under CC BY 4.0."),
            (None, "LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only"), (None, None, "This work is licensed under other terms.\ncopyright notice")]
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [(a, b) for a, b, _ in rows]


def test_url_rules_and_templates(spark):
    rows = [(1, "http://A.Example.COM/en/1"), (2, "http://www.example.com/en/x?q"), (3, "http://x.www.example.com/en/"),
            (4, "https://a.net/es/1"), (5, "https://a.net/de/1"), (6, None), (7, "no scheme"), (8, "http://a.com"),
            (9, "http://a.com#x://b.net/es/"), (10, "x://y://z/p"), (11, "http://a.net/" + "s/" * 5000), (1, "http://A.Example.COM/en/1")]
    got = [(r.page_id, r.host, r.path[:9], r.rule, r.verdict) for r in
           urls.judge(spark.createDataFrame(rows, "page_id long, url string")).orderBy("page_id").collect()]
    assert got[:4] == [(1, "a.example.com", "/en/1", "example.com/en/", "block")] * 2 + [
        (2, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (3, "x.www.example.com", "/en/", "www.example.com/en/", "allow")]
    assert got[4][3:] == ("net/es/", "block") and got[5][3] is None
    assert got[6][1:4] == got[7][1:4] == ("", "", None) and got[8][1:4] == ("a.com", "", None)
    assert got[9][1:3] == ("a.com", "") and got[10][1:3] == ("y:", "//z/p") and len(got) == 12
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_templates_learn_from_labels(spark):
    rows = [(i, f"http://h.net/{'es' if i % 2 else 'fr'}/{i}") for i in range(40)]
    rows += [(100 + i, f"http://h.com/shop/{i}") for i in range(20)]
    rows += [(200, "http://other.org/es/7"), (201, "http://other.org/shop/9"), (202, "http://other.org/zzz")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[200].verdict == "block" and got[201].verdict == "allow"
    assert got[1].template == got[2].template == "*/{n}"       # es and fr do not differ: one branch


def test_chat_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo <|im_end|>"), (1, 2, "bob", "yo <|im_end|>"),
            (1, 300, "ann", "late"), (2, 0, None, None), (3, 0, "system", "alone"), (None, None, "x", "y")]
    got = chat.dialogues(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    by = {(r.conv_id, r.part, r.participant): r for r in got}
    assert set(by) == {(1, 0, "ann"), (1, 0, "bob"), (2, 0, "unknown"), (None, 0, "x")}
    r = by[(1, 0, "ann")]
    assert r.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\n")
    for r in got:
        spans = [tuple(map(int, s.split("-"))) for s in r.loss_spans.split(",")]
        assert sum(b - a for a, b in spans) == r.loss_chars
        own = [t for c, n, role, t in rows if c == r.conv_id and (role or "unknown") == r.participant]
        assert [r.text[a:b] for a, b in spans] == [(t or "").replace("<|", "< |") + "<|im_end|>" for t in own]


def test_chat_parts_are_bounded_by_rows(spark):
    """Repeated and null turn numbers, equal rows and a null conv_id: no part above TURNS rows, none lost."""
    rows = [(1, 0, "ann", f"a{i}") for i in range(700)] + [(1, 1, "bob", "same")] * 600 + [(1, None, "ann", "x")] * 300
    rows += [(None, None, "ann", f"n{i % 400}") for i in range(800)] + [(2, i, "ann", f"t{i}") for i in range(300)]
    rows += [(3, 5, "bob", "b"), (3, 5, "ann", "a"), (3, None, "ann", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said, parts = {}, {}
    for r in chat.dialogues(df.repartition(5)).collect():
        assert 0 < r.n_turns <= chat.TURNS
        spans = [tuple(map(int, s.split("-"))) for s in r.loss_spans.split(",") if s]
        said.setdefault(r.conv_id, []).extend((r.participant, r.text[a:b - 10]) for a, b in spans)
        parts.setdefault(r.conv_id, {})[r.part] = r
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role, text))
    assert {c: sorted(v) for c, v in said.items()} == {c: sorted(v) for c, v in want.items()}
    assert {c: sorted(p) for c, p in parts.items()} == {1: list(range(7)), None: list(range(4)), 2: [0, 1], 3: [0]}
    assert [re.findall("t\\d+(?=<)", parts[2][n].text) for n in (0, 1)] == [
        [f"t{i}" for i in range(256)], [f"t{i}" for i in range(256, 300)]]
    assert re.findall(r"\n(\w)<\|im_end", parts[3][0].text) == ["c", "a", "b"]


def test_chat_parts_make_the_whole_rendering(spark):
    """Every participant gets every part, also silent ones and parts of system turns only."""
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo")]
    rows += [(1, 3 + i, "ann", f"a{i}") for i in range(300)] + [(1, 400 + i, "system", f"s{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.participant, r.part): r for r in chat.dialogues(df).collect()}
    assert set(got) == {(who, part) for who in ("ann", "bob") for part in range(3)}
    for who in ("ann", "bob"):
        whole = "".join(got[who, part].text for part in range(3))
        assert whole == "".join(
            "<|im_start|>" + ("system" if role == "system" else "assistant" if role == who else f"user name={role}")
            + f"\n{text}<|im_end|>\n" for _, _, role, text in rows)
        assert sum(got[who, part].n_turns for part in range(3)) == len(rows)
        assert sum(got[who, part].loss_chars for part in range(3)) == sum(len(t) + 10 for _, _, role, t in rows if role == who)
    assert got["bob", 2].loss_spans == "" and got["bob", 2].loss_chars == 0


def test_queries_registered_once_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) == {"op1_licenses", "op3_urls", "op6_mixing", "op9_chat", "op11_divergence", "op13_lexical"}
