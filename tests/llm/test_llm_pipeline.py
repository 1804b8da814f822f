"""The pipeline: stages against plain filters, and its registered queries against SQL."""

import base64
import os
import random
import re
from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import langid, mixing, quality, simhash
from eventide.llm.queries import ORACLE, QUERIES
from eventide.plans.lineage import materialize

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, left = [n for n, _ in corpus_pipeline.STAGES], docs
    assert names == ["language_id", "quality", "near_dedup", "mix_sources", "encode"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, materialize(stage(spark, left, SMALL), "test")
        assert left.columns == docs.columns
        ids = {r.doc_id for r in left.collect()}
        if name == "language_id":
            scored = langid.predict(before, langid.fit(before), out=("lang_pred", "score", "familiar")).collect()
            want = {r.doc_id for r in scored if r.lang_pred != "und" and r.familiar >= 0.65}
        elif name == "quality":
            model = quality.fit(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
            want = {r.doc_id for r in quality.score(before, model).collect() if r.score >= 0.3}
        elif name == "near_dedup":
            want = {r.component_id for r in simhash.near_duplicates(before).collect()}
            assert left.count() == len(want)
        else:
            sized = before.withColumn("size", mixing.word_count(F.col("text")))
            copies = {r.doc_id: r.copies for r in mixing.mix(sized).collect()}
            want = {i for i, n in copies.items() if n}
            assert left.count() == sum(copies.values())
        assert ids == want, name
    tokens = corpus_pipeline.STAGES[-1][1](spark, left, SMALL)
    assert tokens.count() == left.count()
    whole = corpus_pipeline.run(spark, SMALL)
    key = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, tokens.select(*key).collect()))


GREEK = "Η γρήγορη καφέ αλεπού πηδά πάνω από το τεμπέλικο σκυλί και φεύγει μακριά από το σπίτι"


def test_language_stage_rejects_foreign_texts_only(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rng = random.Random(1)
    salad = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 10))) for _ in range(100))
    foreign = [(-1, GREEK), (-2, salad), (-3, "Быстрая коричневая лиса прыгает через ленивую собаку"), (-4, "½ ② ²"), (-5, "日本語のテキスト")]
    more = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in foreign], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(more), SMALL).collect()}
    lettered = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert kept == lettered


def test_stages_keep_columns_of_any_name(spark):
    """Columns named as the stages name their own come through with their values, also beside very long texts."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    long = docs.filter("lang = 'en'").limit(1).select((F.lit(10 ** 6)).alias("doc_id"), F.repeat(F.concat("text", F.lit(" ")), 300).alias("text"),
                                                      "lang", "source", "n_chars")
    extra = ["key", "band", "sub", "target", "copies", "source_size", "__quality", "__lang", "__size", "__copy", "size", "copy", "score",
             "lang_pred", "lang_score", "familiar", "quality_score", "row", "fp", "root", "md5", "id", "a.b", "n", "rate"]
    docs = docs.unionByName(long)
    for i, c in enumerate(extra):
        docs = docs.withColumn(c, F.col("doc_id") * 100 + i)
    docs = materialize(docs, "test-extra")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = materialize(stage(spark, left, SMALL), "test-extra")
        assert left.columns == docs.columns
    assert left.count() > 100
    for r in left.collect():
        assert [r[c] for c in extra] == [r.doc_id * 100 + i for i in range(len(extra))]
    assert corpus_pipeline.STAGES[-1][1](spark, left, SMALL).count() == left.count()


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def plain_dedup(rows):
    """Ids that stay: the smallest of every group of texts whose fingerprints link, by comparing all of them."""
    fps = {}
    for r in rows:
        words = [w.lower() for w in plain_words(r.text)]
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        fps[r.doc_id] = sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))
    left, kept = set(fps), set()
    while left:
        group, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            near = {j for j in left - group if (fps[i] ^ fps[j]).bit_count() <= 3}
            group |= near
            todo += near
        kept.add(min(group))
        left -= group
    return kept


def test_later_stages_against_plain_code(spark):
    """Near-dedup by comparing all, the mix by its SQL on the stage's own input, encoding by tiktoken."""
    docs = materialize(corpus_pipeline.quality_filter(spark, corpus_pipeline.language_id(
        spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL), SMALL), "plain")
    unique = materialize(corpus_pipeline.near_dedup(spark, docs, SMALL), "plain")
    assert {r.doc_id for r in unique.collect()} == plain_dedup(docs.collect()) and unique.count() > 50
    mixed = materialize(corpus_pipeline.mix_sources(spark, unique, SMALL), "plain")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r.doc_id, r.text, r.source) for r in unique.collect()])
    want = {i: n // size for i, size, n in con.execute(f"SELECT doc_id, size, taken FROM ({ORACLE['op6_mixing']})").fetchall() if n}
    assert Counter(r.doc_id for r in mixed.collect()) == want
    ranks = {base64.b64decode(t): int(n) for t, n in (line.split() for line in open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") if line.strip())}
    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in corpus_pipeline.encode(spark, mixed, SMALL).collect():
        assert list(r.token_ids) == plain.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.token_ids)


def test_stages_on_empty_and_null_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    nulls = spark.createDataFrame([(None,) * 5] * 3, docs.schema)
    for rows in (docs.limit(0), nulls, nulls.unionByName(docs)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SMALL).count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations", "embeddings", "benchmark"):
        if os.path.exists(f"{SMALL}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = QUERIES[name](spark, SMALL)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want))
