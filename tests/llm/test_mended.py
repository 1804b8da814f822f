"""Cases that earlier versions lost: one-line licences, deep and rare paths, many languages, crowded turns, clashing columns."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from eventide.llm import chat, langid, licenses, mixing, urls
from eventide.llm.queries import ORACLE


# ---- Licences --------------------------------------------------------------

def test_a_notice_never_takes_the_text_with_it(spark):
    texts = dict(licenses._BASE)
    mit, bsd = texts["MIT"].split("\n", 1)[1], texts["BSD-3-Clause"].split("\n", 1)[1]
    one_line = lambda t: " ".join(t.split())
    news = "Copyright 2021 was a busy year for courts and " + "the parties went on and on about it " * 20
    rows = [("MIT", one_line("Copyright (c) 2021 Jane Q. Doe " + mit)), ("MIT", one_line("MIT License Copyright (c) 2021 Jane Doe " + mit)),
            ("BSD-3-Clause", one_line("Copyright (c) 2021, Jane Doe. All rights reserved. " + bsd).replace("All rights reserved. ", "")),
            ("MIT", "Copyright 2021 A B\n" + mit), (None, news), (None, "Copyright 2021 Example Ltd."), (None, "(c) 2020"),
            (None, "Copyright 2021 Example Ltd. " + "Words go on here, " * 30), (None, "all rights reserved")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [got[i].license for i in range(len(rows))] == [x for x, _ in rows]
    assert got[4].n_words > 150 and got[7].n_words >= 120 and all(got[i].n_words > 0 for i in range(len(rows)))
    assert len({r.digest for r in got.values() if r.license is None}) == 5
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, t) in enumerate(rows)])
    want = con.execute(f"SELECT doc_id, digest, license, notices, n_words FROM ({ORACLE['op1_licenses']}) ORDER BY doc_id").fetchall()
    assert [tuple(got[i][c] for c in ("doc_id", "digest", "license", "notices", "n_words")) for i in range(len(rows))] == want


def test_a_licence_after_a_notice_in_its_line_is_found(spark):
    docs = spark.createDataFrame([(1, "x\nCopyright 2021 Jane. Licensed under the MIT License.\ny")], "doc_id long, text string")
    assert licenses.scan(docs).first().notices == "MIT"


# ---- URLs ------------------------------------------------------------------

def general(path):
    return tuple(re.sub("[0-9]+", "{n}", s) for s in path.split("/") if s)


def plain_templates(pages, rare=5):
    """(host, general path) -> template, by a tree of nested groups; pages: (host, path, verdict or None)."""
    seen, anywhere = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [0, 0])
    for host, path, verdict in pages:
        segs = general(path)
        for scope in (host, None):
            c = seen[scope, segs]
            c[0], c[1], c[2] = c[0] + 1, c[1] + (verdict is not None), c[2] + (verdict == "block")
        for d, s in enumerate(segs):
            anywhere[d, s][0] += verdict is not None
            anywhere[d, s][1] += verdict == "block"

    def unlike(l, b, rl, rb):
        if not l or not rl:
            return False
        p, gap = (b + rb) / (l + rl), b / l - rb / rl
        return gap * gap > 3.8416 * p * (1 - p) * (1 / l + 1 / rl)

    out = {}

    def grow(scope, members, prefix, d):
        branches = defaultdict(list)
        for segs, c in members:
            if len(segs) == d:
                out[scope, segs] = "/".join(prefix)
            else:
                branches[segs[d]].append((segs, c))
        total = [sum(c[i] for b in branches.values() for _, c in b) for i in range(3)]
        merged = defaultdict(list)
        for s, b in branches.items():
            n, l, k = (sum(c[i] for _, c in b) for i in range(3))
            rl, rk = total[1] - l, total[2] - k
            if len(branches) == 1:
                wild = False
            elif n < rare:
                wild = not unlike(*anywhere[d, s], rl, rk)
            else:
                wild = l >= rare and rl >= rare and not unlike(l, k, rl, rk)
            merged["*" if wild else s] += b
        for g, b in merged.items():
            grow(scope, b, prefix + [g], d + 1)
    for scope in {s for s, _ in seen}:
        grow(scope, [(segs, c) for (s, segs), c in seen.items() if s == scope], [], 0)
    return {k: v for k, v in out.items() if k[0] is not None}


def judged(spark, pages, rules):
    df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p, _) in enumerate(pages)], "page_id long, url string")
    return [r for r in urls.judge(df, rules).orderBy("page_id").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_url_tree_equals_a_plain_one(spark, seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "spam", "x1", "7", "31"]
    raw = [(rng.choice(["h.net", "g.net", "k.org"]), "/" + "/".join(rng.choice(words) for _ in range(rng.randrange(0, 5)))) for _ in range(400)]
    rules = [("block", "net", "/spam"), ("allow", "net", "/a"), ("block", "org", "/b/"), ("allow", "org", "/c/7")]
    rule = lambda h, p: max([(len(x + y), v) for v, x, y in rules if (h == x or h.endswith("." + x)) and p.startswith(y)],
                            default=(0, None))[1]
    pages = [(h, p, rule(h, p)) for h, p in raw]
    want = plain_templates(pages)
    for (h, p, _), r in zip(pages, judged(spark, pages, rules)):
        assert r.template == want[h, general(p)]


def test_merged_branches_meet_below(spark):
    pages = [("h.net", f"/u/user{chr(97 + i % 26)}{chr(97 + i // 26)}/{'spam' if i % 2 else 'profile'}", None) for i in range(60)]
    pages += [("h.net", "/u/late/spam", None), ("h.net", "/u/later/profile", None)]
    rules = [("block" if p.endswith("spam") else "allow", h, p) for h, p, _ in pages[:60]]
    got = judged(spark, pages, rules)
    assert [r.template for r in got[60:]] == ["u/*/spam", "u/*/profile"]
    assert [r.verdict for r in got[60:]] == ["block", "allow"]


def test_paths_are_judged_by_all_their_segments(spark):
    deep = "/a/b/c/d/e/f/g/h"
    pages = [("h.net", f"{deep}/{kind}/{i}", None) for kind in ("good", "bad") for i in range(8)]
    pages += [("h.net", f"{deep}/good/99", None), ("h.net", f"{deep}/bad/99", None)]
    rules = [("allow", "h.net", f"{deep}/good/{i}") for i in range(8)] + [("block", "h.net", f"{deep}/bad/{i}") for i in range(8)]
    assert [r.verdict for r in judged(spark, pages, rules)[16:]] == ["allow", "block"]


def test_an_unlike_rare_branch_is_not_condemned(spark):
    pages = [("small.net", "/es/1", None), ("small.net", "/fr/1", None), ("small.net", "/fr/2", None), ("small.net", "/de/1", None)]
    pages += [(f"h{i}.com", "/de/1", None) for i in range(30)] + [(f"h{i}.com", "/es/1", None) for i in range(10)]
    got = judged(spark, pages, None)
    assert [r.verdict for r in got[:4]] == ["block", "block", "block", "allow"]


# ---- Language ID -----------------------------------------------------------

def test_more_than_64_languages_are_learned(spark):
    rng = random.Random(4)
    words = {f"l{i:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for i in range(70)}
    text = lambda la: " ".join(rng.choice(words[la]) for _ in range(20))
    rows = [(i, text(la), la) for i, la in enumerate(sorted(words) * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spans = langid.sample(docs, per_label=4, max_spans=300)
    assert Counter(la for la, _ in spans) == dict.fromkeys(words, 4)
    assert Counter(la for la, _ in langid.sample(docs, per_label=4, max_spans=71)) == dict.fromkeys(words, 1)
    model = langid.train(spans, rounds=25)
    got = langid.label_texts(model, [text(la) for la in sorted(words)])[0]
    assert sum(a == b for a, b in zip(got, sorted(words))) >= 67


def test_only_letters_make_words():
    assert langid.words_of("½ ② ² Ⅷ abc②def é") == ["abc", "def", "é"]
    model = langid.train([("en", ["the", "cat"])])
    assert langid.label_texts(model, ["½ ② ²", "the"])[0] == ["und", "en"]


# ---- Chat ------------------------------------------------------------------

def test_chat_query_sql_on_long_dialogues(spark):
    """Dialogues beyond one part, with crowded, repeated, null and negative turn numbers and silent participants."""
    rng = random.Random(6)
    rows = [(1, 0, "ann", f"a{i}") for i in range(257)] + [(2, 0, rng.choice(["ann", "bob"]), f"t{i % 300}") for i in range(700)]
    rows += [(3, rng.choice([None, -5, 1, 2, 900]), rng.choice(["ann", "bob", "system", None]), rng.choice(["x", None, "<|im", "é" * 40]))
             for _ in range(900)]
    rows += [(None, i, "cid", f"n{i}") for i in range(300)] + [(4, i, "system" if i > 3 else "dan", "s") for i in range(600)] + [(5, 1, "eve", "short")]
    got = chat.dialogues(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE['op9_chat']})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want))


def test_chat_of_nothing_and_of_a_very_long_text(spark):
    schema = "conv_id long, turn long, role string, text string, place int, n long, chunk long"
    assert chat.dialogues(spark.createDataFrame([], schema)).count() == 0
    long = "word " * 400_000
    r, = chat.dialogues(spark.createDataFrame([(1, 1, "ann", long, 1, 2, 3)], schema)).collect()
    assert r.loss_chars == len(long) + 10 and long in r.text


# ---- Mixing ----------------------------------------------------------------

def test_mixing_refuses_to_replace_columns(spark):
    rows = spark.createDataFrame([(i, "s", 10 + i, i) for i in range(20)], "doc_id long, source string, size long, target long")
    with pytest.raises(ValueError, match="target"):
        mixing.mix(rows)
    got = mixing.mix(rows, out=("of_source", "goal", "times")).withColumn("same", F.col("target") == F.col("doc_id")).collect()
    assert all(r.same for r in got) and len(got) == 20 and {r.of_source for r in got} == {sum(10 + i for i in range(20))}
