"""I-Match fingerprints over randomised lexicon subsets.

Terms (runs of word characters, lower case) whose inverse document frequency lies in a
band form the lexicon.  A text's distinct lexicon terms, sorted, are hashed once for each of several
random lexicon subsets; the fingerprint is the row of these hashes.  Subsets come in
levels: those of level l hold a 4^-l share of the lexicon, dealt over ``SUBSETS``
subsets, so short texts are told apart by the dense levels and for long ones
the sparse levels still hold about one term per subset, which an edit may leave alone.

The band is given as shares of all documents, so the lexicon has at most (mean distinct terms) /
``low`` entries whatever the corpus size, and can be sent to all tasks.
Document frequencies count all documents.

A text without lexicon terms is fingerprinted by all its terms, one
without terms by itself as one term; null is the empty text, all zeros.
Equal texts have equal fingerprints.  The next document goes by ascending id, null ids
last, equal ids by their packed text; the last one's next is the first (a single row is its own next).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from eventide.llm import batches
from eventide.llm.batches import Remembered, SLICE_CHARS

TERM = re.compile(r"\w+")
SUBSETS, LEVELS = 48, 4
CODES = SUBSETS * LEVELS
#: Terms whose codes a worker remembers, and terms a task counts before it hands them on.
REMEMBER, FLUSH = 150_000, 200_000
#: Rows per part of the id order.
PART_ROWS = 500
_M = np.uint64(0x9E3779B97F4A7C15)


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.lower()) or ([text] if text else [])


def document_frequency(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df) over all documents; tasks pre-aggregate before the shuffle."""
    def run(chunks):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              names=["term", "df"])
        for batch in chunks:
            for part in batches.slices(batch, 0):
                for t in part.column(0).to_pylist():
                    seen.update(set(TERM.findall(batches.text(t).lower())))
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return (batches.small_batches(docs).select(F.col(text).cast("binary").alias("t")).mapInArrow(run, "term string, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def lexicon(docs: DataFrame, text: str = "text", low: float = 2e-4, high: float = 0.1) -> list[str]:
    """Terms with document frequency from ``low`` to ``high`` of all documents, at least two documents."""
    n = docs.count()
    band = F.col("df").between(max(2, math.ceil(low * n)), max(2, math.floor(high * n)))
    return sorted(r["term"] for r in document_frequency(docs, text).filter(band).select("term").collect())


def term_codes(known: set[str]) -> Remembered:
    """Per term: hash, whether in the lexicon, and per level its subset (or CODES if not in the level)."""
    def make(terms):
        out = np.full((len(terms), 2 + LEVELS), CODES, dtype=np.uint64)
        for n, t in enumerate(terms):
            b = t.encode("utf-8", "replace")
            out[n, 0], out[n, 1] = xxhash.xxh64_intdigest(b, 1), t in known
            for level in range(LEVELS):
                h = xxhash.xxh64_intdigest(b, 10 + level)
                if (h >> 32) % 4 ** level == 0:
                    out[n, 2 + level] = level * SUBSETS + h % SUBSETS
        return out
    return Remembered(make, 2 + LEVELS, np.uint64, REMEMBER)


def fingerprints(texts: list[str], codes: Remembered) -> np.ndarray:
    """One row of CODES 16-bit hashes per text; 0 marks a subset without terms."""
    out = np.zeros((len(texts), CODES), dtype=np.uint16)
    terms = [terms_of(t) for t in texts]
    sizes = np.array([len(t) for t in terms], dtype=np.int64)
    if not sizes.sum():
        return out
    rows = codes.of([t for ts in terms for t in ts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    has = np.bincount(doc, rows[:, 1].astype(np.float64), len(texts)) > 0
    use = (rows[:, 1] == 1) | ~has[doc]
    doc, rows = doc[use], rows[use]
    order = np.lexsort((rows[:, 0], doc))                  # each text's terms in one order
    doc, rows = doc[order], rows[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (rows[1:, 0] != rows[:-1, 0])   # distinct terms
    doc, rows = doc[new], rows[new]
    for level in range(LEVELS):
        subset = rows[:, 2 + level].astype(np.int64)
        inside = subset < CODES
        key = (doc * CODES + subset)[inside]
        order = np.argsort(key, kind="stable")
        key, h = key[order], rows[inside, 0][order]
        if not len(key):
            continue
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        place = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        x = (h ^ (place.astype(np.uint64) + np.uint64(1)) * _M) * np.uint64(0xFF51AFD7ED558CCD)
        total = np.add.reduceat(x ^ (x >> np.uint64(31)), first) * _M
        out.reshape(-1)[key[first]] = np.maximum(total >> np.uint64(48), 1).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of subset hashes that agree, among subsets with terms in either text.

    Taken from the first level at which at most 70 % of the subsets have
    terms, down to the sparser ones: there a subset holds about one term. Equal fingerprints: 1.
    """
    a3, b3 = a.reshape(-1, LEVELS, SUBSETS), b.reshape(-1, LEVELS, SUBSETS)
    full = ((a3 > 0) | (b3 > 0)).sum(axis=2)
    same = ((a3 == b3) & (a3 > 0)).sum(axis=2)
    sparse = np.argmax(np.concatenate([full <= 0.7 * SUBSETS, np.ones((len(a3), 1), bool)], axis=1), axis=1)
    sparse = np.minimum(sparse, LEVELS - 1)
    full_from = np.cumsum(full[:, ::-1], axis=1)[:, ::-1]
    same_from = np.cumsum(same[:, ::-1], axis=1)[:, ::-1]
    rows = np.arange(len(a3))
    while ((full_from[rows, sparse] == 0) & (sparse > 0)).any():
        sparse = np.where((full_from[rows, sparse] == 0) & (sparse > 0), sparse - 1, sparse)
    share = same_from[rows, sparse] / np.maximum(full_from[rows, sparse], 1)
    return np.where((a == b).all(axis=1), 1.0, share)


def text_of(row: np.ndarray) -> str:
    return row.astype(">u2").tobytes().hex()


def edited(text: str, after: str) -> str:
    """The last half of the code points replaced by the next text's first ones."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts (packed) dealt into parts of the id order, each part ended by the first row of the next.

    Bounds come from quantiles of all ids; only they and each part's first id
    pass through the driver (at most 10,000).
    """
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    n = ids.count()
    cuts = min(10_000, n // PART_ROWS)
    shares = [i / cuts for i in range(1, cuts)] if cuts > 1 else []
    bounds = np.array(sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10_000).alias("q")).first()["q"] or []))
                      if shares else [], dtype=np.int64)

    def part_of(values: list) -> np.ndarray:
        known = np.array([v is not None for v in values], dtype=bool)
        at = np.searchsorted(bounds, np.array([v if v is not None else 0 for v in values], dtype=np.int64), side="left")
        return np.where(known, at, len(bounds) + 1)

    dealt = batches.append(ids.withColumn("none", F.lit("")), [("part", "int")],
                           lambda _, v: [part_of(v).astype(np.int32)], ["none", "doc_id"])
    firsts = {r["part"]: r["first"] for r in dealt.groupBy("part").agg(F.min("doc_id").alias("first")).collect()}
    parts = sorted(firsts)
    before = {firsts[p]: parts[i - 1] for i, p in enumerate(parts)}

    def make(texts, values):
        pack = zstandard.ZstdCompressor(level=3)
        return [part_of(values).astype(np.int32), [before.get(v) for v in values], [pack.compress(t or b"") for t in texts]]

    rows = batches.append(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")),
                          [("part", "int"), ("mark", "int"), ("packed", "binary")], make, ["text", "doc_id"], ["doc_id"])
    return rows.select("doc_id", "packed", F.explode(F.array_compact(F.array(
        F.struct(F.col("part"), F.lit(0).alias("tail")),
        F.when(F.col("mark").isNotNull(), F.struct(F.col("mark").alias("part"), F.lit(1).alias("tail")))))).alias("p")).select(
        "p.part", "p.tail", "doc_id", "packed")


def compare(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **band) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likenesses."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(lexicon(docs.select(text), text, **band))
    rows = (in_order(docs, doc_id, text).repartition("part")
            .sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_last(), "packed"))

    def run(chunks):
        codes = term_codes(set(known.value))
        pending, todo, held = None, [], 0
        for batch in chunks:
            for part, tail, i, raw in zip(*[batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "packed")]):
                own = zstandard.ZstdDecompressor().decompress(raw).decode("utf-8", "replace")
                if pending is not None and pending[0] == part:
                    todo.append((pending[1], pending[2], own))
                    held += len(own)
                    if held >= SLICE_CHARS:
                        yield rows_of(todo, codes)
                        todo, held = [], 0
                pending = None if tail else (part, i, own)
        if todo:
            yield rows_of(todo, codes)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def rows_of(todo: list[tuple], codes: Remembered) -> pa.RecordBatch:
    """Output rows of (id, text, next text) triples; most next texts are the next triple's own."""
    follows = [n + 1 < len(todo) and todo[n + 1][1] == t[2] for n, t in enumerate(todo)]
    loose = [n for n, f in enumerate(follows) if not f]
    changed = [edited(t[1], t[2]) for t in todo]
    own = fingerprints([t[1] for t in todo] + [todo[n][2] for n in loose], codes)
    nxt = np.roll(own[:len(todo)], -1, axis=0)
    nxt[loose] = own[len(todo):]
    own = own[:len(todo)]
    new = fingerprints(changed, codes)
    cols = [pa.array([t[0] for t in todo], pa.int64()), pa.array([len(t[1]) for t in todo], pa.int64()),
            pa.array([hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in changed]),
            pa.array([text_of(r) for r in own]), pa.array([text_of(r) for r in new]),
            pa.array(likeness(own, new)), pa.array(likeness(own, nxt))]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                                   "edited_fingerprint", "near_edited", "near_next"])
