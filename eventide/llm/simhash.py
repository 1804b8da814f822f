"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

Words are the runs of characters outside ``\\x20 \\x09-\\x0D`` after A-Z is
lower-cased.  A text of n >= 3 words has n - 2 shingles of three words
joined by one space, repeats included; one or two words make one shingle; a text
without words (null, empty, blank) has fingerprint zero and is linked
like any other.  Bit i is set if it is set in over half of the
shingles' XXH64 values (seed 42, UTF-8 bytes).

Two fingerprints link when at most ``distance`` (3) bits differ.  The
pigeonhole principle finds every such pair: of ``parts`` bit blocks at most
three differ, so the pair agrees on some choice of ``parts - 3`` blocks.
Distinct fingerprints are joined on those blocks and the pairs verified.
A block shared by more than ``hot`` fingerprints is not paired; its
members go to a finer division, and what is still crowded there to Hamming balls, which link through
common neighbours and emit a constant number of rows per fingerprint.
All three ways are exact, so no link is lost at any group size.

Null ids keep their rows but never become a ``component_id`` unless the
whole component has none (then it is null).  Repeated rows give repeated results.
"""

from __future__ import annotations

import itertools
import re
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.batches import append, unused
from eventide.llm.components import components
from eventide.plans.lineage import materialize

BITS = 64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes, size: int = 1 << 20):
    """Lists of lower-cased words, cut at white space about every ``size`` bytes."""
    pos = 0
    while pos < len(text):
        end = pos + size
        if end < len(text):
            gap = _SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[pos:end].lower().split()  # bytes.lower/split: A-Z and these six blanks only
        pos = end


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of one text as an unsigned integer."""
    ones, total, tail = np.zeros(BITS, dtype=np.int64), 0, []
    for words in word_blocks(text or b""):
        words = tail + words
        runs = [words[i:] for i in range(shingle)]
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed) for s in zip(*runs)]
        tail = words[-(shingle - 1):] if shingle > 1 else []
        if hashes:
            total += len(hashes)
            ones += _bit_counts(hashes)
    if not total and tail:
        total, ones = 1, _bit_counts([xxhash.xxh64_intdigest(b" ".join(tail), seed)])
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3,
                     keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the fingerprint as a signed long (same 64 bits)."""
    def make(texts):
        return [np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)]
    return append(docs, [(out, "long")], make, [text], keep)


def _masks(parts: int, differ: int) -> list[int]:
    """Signed 64-bit masks: every choice of ``parts - differ`` of ``parts`` near-equal bit blocks."""
    cuts = [round(i * BITS / parts) for i in range(parts + 1)]
    blocks = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(parts)]
    masks = [sum(c) for c in itertools.combinations(blocks, parts - differ)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _parts_for(n: int, differ: int) -> int:
    """The fewest blocks whose chance collisions stay below one per fingerprint."""
    for parts in range(differ + 1, 16):
        bits = BITS * (parts - differ) / parts
        if n * len(_masks(parts, differ)) <= 2.0 ** bits:
            return parts
    return 16


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _tier(fps: DataFrame, parts: int, distance: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """(edges found in blocks of at most ``hot`` members, fingerprints of larger blocks)."""
    masks = _masks(parts, distance)
    keys = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
        for i, m in enumerate(masks)])).alias("b")).select("fp", "b.k", "b.v")
    counts = keys.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(keys.join(counts, ["k", "v"]), "simhash-blocks")
    cold = shared.filter(F.col("n") <= hot).select("k", "v", "fp")
    a, b = cold.alias("a"), cold.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = reduce(lambda c, im: c.when(x.bitwiseAND(F.lit(im[1])) == 0, F.lit(im[0])),
                   list(enumerate(masks))[1:], F.when(x.bitwiseAND(F.lit(masks[0])) == 0, F.lit(0)))
    once = first == F.col("a.k") if parts <= 8 else F.lit(True)
    edges = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.v") == F.col("b.v"))
                   & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(x) <= distance) & once)
    return (edges.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")),
            shared.filter(F.col("n") > hot).select("fp").distinct())


def _ball_edges(fps: DataFrame) -> DataFrame:
    """Edges with the same components as all links of at most three bits.

    Fingerprints that share a point of their radius-1 balls are at most two
    apart: each links to the smallest of them.  Links of three bits join an even
    and an odd popcount; the even one's radius-1 ball meets the odd one's
    points at distance two, and the odd one links to the smallest even one there.
    """
    one = [1 << i if i < 63 else -(1 << 63) for i in range(BITS)]
    two = [(x := (1 << i) | (1 << j)) - (1 << 64 if x >> 63 else 0) for i in range(BITS) for j in range(i)]
    flip = lambda flips: F.explode(F.transform(
        F.array(*[F.lit(m) for m in flips]), lambda m: F.col("fp").bitwiseXOR(m))).alias("z")
    near = fps.select("fp", flip([0, *one]))
    low = near.groupBy("z").agg(F.min("fp").alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    close = near.join(low, "z").filter("fp > m").select(F.col("m").alias("u"), F.col("fp").alias("v"))
    even = F.bit_count(F.col("fp")) % 2 == 0
    centre = fps.filter(even).select("fp", flip(one)).groupBy("z").agg(F.min("fp").alias("m"))
    odd = fps.filter(~even).select("fp", flip(two))
    three = odd.join(centre, "z").select(F.least("m", "fp").alias("u"), F.greatest("m", "fp").alias("v"))
    return close.unionByName(three).distinct()


def link_edges(fps: DataFrame, distance: int = 3, hot: int = 64) -> DataFrame:
    """Edges (u < v) over distinct fingerprints ``fp`` whose components are those of all links."""
    n = fps.count()
    edges, crowded = _tier(fps, _parts_for(n, distance), distance, hot)
    for parts in (10,):
        crowded = materialize(crowded, "simhash-hot")
        if crowded.isEmpty():
            return edges
        more, crowded = _tier(crowded, parts, distance, hot)
        edges = edges.unionByName(more)
    crowded = materialize(crowded, "simhash-hot")
    if crowded.isEmpty():
        return edges
    if distance != 3:
        raise ValueError("the ball method covers a distance of 3 bits")
    return edges.unionByName(_ball_edges(crowded))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                    shingle: int = 3, distance: int = 3, hot: int = 64) -> DataFrame:
    """One row per input row: doc_id, fp (long), root (smallest linked fp), component_id."""
    ids = materialize(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                       shingle=shingle, keep=["doc_id"]), "simhash-fp")
    fps = materialize(ids.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(link_edges(fps.select("fp"), distance, hot)).withColumnRenamed("node", "fp")
    fps = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = fps.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = fps.join(least, "root").select("fp", "root", "component_id")
    return ids.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` with one of each component: the smallest id (null last),
    among rows of equal id the smallest in their other columns."""
    found = materialize(near_duplicates(docs, doc_id, text, **kw), "simhash-classes")
    often = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    # An id is plain if one row has it; others are told apart by their fingerprint.
    plain = found.join(often.filter("n = 1 AND doc_id IS NOT NULL"), "doc_id", "left_semi")
    keep = plain.filter("doc_id = component_id").select("doc_id")
    kept = docs.join(keep, docs[doc_id] == keep["doc_id"], "left_semi")
    odd = found.join(often.filter("n > 1"), found["doc_id"].eqNullSafe(often["doc_id"]), "left_semi").unionByName(
        found.filter("doc_id IS NULL")).distinct()
    odd = materialize(odd.filter("doc_id <=> component_id").select("doc_id", "fp", "root"), "simhash-odd")
    if odd.isEmpty():
        return kept
    cols = docs.columns
    mine, other, its, root = unused(cols, "fp", "other_id", "other_fp", "root")
    rows = with_fingerprint(docs.join(odd, docs[doc_id].eqNullSafe(odd["doc_id"]), "left_semi"), text, mine)
    one = rows.join(odd.select(F.col("doc_id").alias(other), F.col("fp").alias(its), F.col("root").alias(root)),
                    F.col(doc_id).eqNullSafe(F.col(other)) & (F.col(mine) == F.col(its)))
    one = one.groupBy(root).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in cols])).alias("r")).select("r.*")
    return kept.unionByName(one)
