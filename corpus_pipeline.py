"""Training-corpus pipeline: five stages over ``documents``, each writing Parquet for the next.

Language ID and quality filter, SimHash near-dedup keeps one of each
group, mixing repeats or drops documents to meet the source targets, and
byte-level BPE gives the tokens.  All but the last return the columns of their input, whatever their names.

Null, empty and letterless texts go at the first stage.  Repeated rows are near duplicates of each other, so one stays.  Very long
texts are taken whole by every stage.  Ties: equal languages go to the smaller name, of equal documents the smallest id
stays.  An empty table gives no rows at any stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import bpe, langid, mixing, quality, simhash
from eventide.llm.batches import quoted, unused
from eventide.plans.lineage import materialize

#: A text is in no learned language if its n-grams are less known than this share of what is usual for them.
LEAST_FAMILIAR = 0.65


def _columns(docs: DataFrame) -> list:
    return [quoted(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those in none of the learned languages."""
    lang, score, familiar = unused(docs.columns, "lang_pred", "lang_score", "familiar")
    scored = langid.predict(docs, langid.fit(docs), out=(lang, score, familiar))
    return scored.filter((F.col(lang) != langid.UNKNOWN) & (F.col(familiar) >= LEAST_FAMILIAR)).select(*_columns(docs))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts scored under the quality threshold."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, = unused(docs.columns, "quality_score")
    return quality.score(docs, model, out=score).filter(F.col(score) >= quality.THRESHOLD).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component (three-word shingles, three bits)."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits every document as often as the mix takes it."""
    size, total, target, copies, copy = unused(docs.columns, "size", "source_size", "target", "copies", "copy")
    sized = docs.withColumn(size, mixing.word_count(F.col("text")))
    mixed = mixing.mix(sized, size=size, out=(total, target, copies)).filter(F.col(copies) > 0)
    return (mixed.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*_columns(docs)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with the digests of op7."""
    return bpe.tokenize(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                        with_ids=True, keep=["doc_id"])


STAGES = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: The learned stages and the fingerprints have no SQL form; tests hold the run against a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
