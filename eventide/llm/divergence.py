"""Source divergence audit over a frequent-pattern tree of term rows.

For every language, its frequent terms (in at least ``least_docs`` of its documents) and the smoothed share
p of each term in each source and in the language, in parts of 10^9:
``p = 1 + floor(10^9 (count + 2) / (N + 2V))``.  Two shares differ by ``f = floor((p - q)^2 / (p + q))``.

The sum of f over all terms for a pair of sources is taken as
    V * f(zero, zero)
  + sum over the terms of either source of f(its share, the other's zero share) - f(zero, zero)
  + sum over the terms of both of a correction,
so that terms which a source lacks cost nothing.  The first two parts need the number of terms per
(source, count) only.  For the corrections a term is a row: its (source, count) cells with counts above 0, in source
order.  Equal rows are counted once with their multiplicity; sorted rows make a frequent-pattern tree, in which
rows with the same beginning share a path; each node, with the multiplicity of all rows through it, adds one
correction per ancestor.  A tree holds about ``TREE_CELLS`` cells of neighbouring rows, so memory is bounded,
and the trees' sums add up exactly: all arithmetic is on integers.

Texts are counted inside tasks, by (language, source), before any shuffle; a hot source or term comes as one number per
task.  A term row has one cell per source of its language, as the report has one row per pair of sources.

Null text, lang and source are ''.  Texts without terms, empty languages (V = 0: every value is 0) and sources
without any term still give their groups.  Repeated rows count each; very long texts are counted whole; ties rank by
item (UTF-8).  An empty table gives no rows; extra columns of any name are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm import batches
from eventide.plans.broadcast import bounded_broadcast
from eventide.plans.lineage import materialize

LEAST_DOCS = 10
#: Counts that a task holds before it hands them on.
HELD = 300_000
TREE_CELLS = 200_000

# Letters A-Z become small; every other ASCII character but a-z separates terms.
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b | 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def differ(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def differ_np(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def share_of(n: str, words: str, v: str) -> Column:
    """p for a count, the group's sum of counts and the number of kept terms (null if there are none)."""
    return F.expr(f"1L + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(19,0))) "
                  f"div nullif(CAST({words} + 2 * {v} AS DECIMAL(20,0)), 0)")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) partial counts of ``docs`` (lang, source, text)."""
    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_with) in held.items():
                terms = list(n)
                for at in range(0, len(terms), 50_000):
                    part = terms[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                         pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()),
                         pa.array([docs_with[t] for t in part], pa.int64())], names=["lang", "source", "term", "n", "docs"])

        size = 0
        for chunk in chunks:
            for part in batches.slices(chunk, 2):
                langs, sources = part.column(0).to_pylist(), part.column(1).to_pylist()
                for lang, source, text in zip(langs, sources, part.column(2).cast(pa.binary()).to_pylist()):
                    words = terms_of(text)
                    n, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    n.update(words)
                    docs_with.update(list(set(words)))
                    size += len(n)
                    if size > HELD:
                        yield from out()
                        held.clear()
                        size = 0
        yield from out()

    return batches.small_batches(docs).select("lang", "source", "text").mapInArrow(
        run, "lang string, source string, term string, n long, docs long")


def pair_sums(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value): corrections of the source pairs (a before b) summed over term rows.

    ``rows`` has lang, path (array of (source number, count, p, p of count 0)) and times, sorted by lang and path.
    """
    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            langs, times = chunk.column(0).to_pylist(), chunk.column(2).to_numpy()
            lists = chunk.column(1)
            offsets = lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            cells = [c.to_numpy() for c in lists.flatten().flatten()]
            start = 0
            for i in range(1, len(langs) + 1):
                if i == len(langs) or langs[i] != langs[start] or offsets[i] - offsets[start] > TREE_CELLS:
                    span = slice(offsets[start], offsets[i])
                    a, b, value = tree_sums(offsets[start:i + 1] - offsets[start], *[c[span] for c in cells], times[start:i])
                    if len(a):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([langs[start]] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                             pa.array(value, pa.int64())], names=["lang", "a", "b", "value"])
                    start = i

    return batches.small_batches(rows).select("lang", "path", "times").mapInArrow(
        run, "lang string, a int, b int, value long")


def tree_sums(ptr: np.ndarray, source: np.ndarray, count: np.ndarray, p: np.ndarray, zero: np.ndarray,
              times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, value) of a tree of sorted rows, which ``ptr`` cuts out of the cells.

    A row opens a node for every cell after those that it shares with the row before it; the node's
    multiplicity is that of its row and of the following ones that share it too.
    """
    n, sizes = len(times), ptr[1:] - ptr[:-1]
    row = np.repeat(np.arange(n), sizes)
    depth = np.arange(len(source)) - ptr[row]
    same = np.zeros(len(source), bool)                        # as in the row before, at the same depth
    at = np.flatnonzero((row > 0) & (depth < np.append(0, sizes)[row]))
    up = ptr[row[at] - 1] + depth[at]
    same[at] = (source[at] == source[up]) & (count[at] == count[up])
    unlike = np.where(same, len(source), depth)
    shared = sizes.copy()
    full = np.flatnonzero(sizes)
    if len(full):
        shared[full] = np.minimum(sizes[full], np.minimum.reduceat(unlike, ptr[:-1][full]))
    before = np.concatenate([[0], np.cumsum(times)])
    out: list[tuple] = []
    for d in range(1, int(sizes.max()) if n else 0):
        border = np.flatnonzero(shared <= d)                  # rows at which a node of this depth ends
        opened = border[sizes[border] > d]
        if not len(opened):
            continue
        ends = np.append(border, n)[np.searchsorted(border, opened, side="right")]
        many = (before[ends] - before[opened])[:, None]
        node = ptr[opened] + d
        above = ptr[opened][:, None] + np.arange(d)           # its ancestors
        pn, zn, pa_, za = p[node][:, None], zero[node][:, None], p[above], zero[above]
        value = differ_np(pa_, pn) - differ_np(pa_, zn) - differ_np(za, pn) + differ_np(za, zn)
        out.append((source[above].ravel(), np.repeat(source[node], d), (value * many).ravel()))
    if not out:
        return (np.zeros(0, np.int32),) * 2 + (np.zeros(0, np.int64),)
    a, b, value = (np.concatenate(c) for c in zip(*out))
    by = np.lexsort((b, a))
    a, b, value = a[by], b[by], value[by]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[first], b[first], np.add.reduceat(value, first)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", *,
          least_docs: int = LEAST_DOCS, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources, and each source's ``top`` terms over its language."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for n, c in (("lang", lang), ("source", source), ("text", text))])
    per_source = term_counts(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = per_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(F.struct("source", "n")).alias("cells"))
    kept = materialize(by_term.filter(F.col("docs") >= least_docs), "divergence-terms")

    cells = kept.select("lang", "term", F.explode("cells").alias("c")).select("lang", "term", "c.source", "c.n")
    words = cells.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("lang_words"))
    groups = (rows.select("lang", "source").distinct().join(words, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["words", "v", "lang_words"])
              .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
              .withColumn("zero", share_of("0", "words", "v")))
    groups = materialize(groups, "divergence-groups")         # one row per (lang, source)

    cells = materialize(cells.join(bounded_broadcast(groups), ["lang", "source"])
                        .withColumn("p", share_of("n", "words", "v")), "divergence-cells")

    # Terms above their language's share.
    of_lang = kept.select("lang", "term", "all")
    term = (cells.join(of_lang, ["lang", "term"]).withColumn("q", share_of("all", "lang_words", "v")).filter("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), differ("p", "q").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    term = term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    # Pairs of sources: zero counts, counts of one, counts of both.
    other = groups.select("lang", F.col("k").alias("b"), F.col("zero").alias("other_zero"))
    side = bounded_broadcast(other)
    base = (groups.join(side, "lang").filter("k <> b")
            .select("lang", F.col("k").alias("a"), "b", (F.coalesce(differ("zero", "other_zero"), F.lit(0)) * F.col("v")).alias("value")))
    counted = cells.groupBy("lang", "k", "zero", "p").agg(F.count(F.lit(1)).alias("times"))
    one = (counted.join(side, "lang").filter("k <> b").groupBy("lang", F.col("k").alias("a"), "b")
           .agg(F.sum((differ("p", "other_zero") - differ("zero", "other_zero")) * F.col("times")).alias("value")))
    paths = (cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("k", "n", "p", "zero"))).alias("path"))
             .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")))
    # Neighbouring rows come together by the range of their first cells; a hash splits rows that share these.
    head = F.transform(F.slice("path", 1, 4), lambda c: F.struct(c["k"], c["n"]))
    paths = paths.repartitionByRange("lang", head, F.xxhash64("path")).sortWithinPartitions("lang", "path")
    both = pair_sums(paths).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    turned = lambda df: df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    both, one = materialize(both, "divergence-pairs"), materialize(one, "divergence-one")
    sums = (base.unionByName(one).unionByName(turned(one)).unionByName(both).unionByName(turned(both))
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    name = lambda k, n: groups.select("lang", F.col("k").alias(k), F.col("source").alias(n))
    pair = (sums.join(bounded_broadcast(name("a", "source")), ["lang", "a"]).join(bounded_broadcast(name("b", "item")), ["lang", "b"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    pair = pair.withColumn("rank", F.row_number().over(order))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")
