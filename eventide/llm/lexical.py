"""Ranked lexical search over a trie of document term vectors.

The terms of all items are the only ones that matter, so every document becomes a restricted term
vector: its counts of item terms, in order of falling document frequency.  Vectors are
inserted in path-compressed tries (one per ``TREE_DOCS`` documents of a task, so memory is bounded), where
documents that share their frequent terms share a path.  Each node holds the largest count of
every term in its subtree and the smallest length norm ``m``; as a score grows with counts and falls with
``m``, these bound every score below the node.  An item walks a trie depth first, best
child first, and leaves out a subtree whose bound cannot enter its best ``k``; the best found so far are
kept from trie to trie.  The walk carries all items still interested in a node at once.
Each task returns its best ``k`` per item, and these are ranked once more.

Scores are integers: ``w = floor(1000 ln((2N+2) / (2df+1)))`` per term,
``m = 75 + 25 n N div L`` per document, a term adds ``w * (10^9 tf div (1000 tf + 12 m))``.

Items are taken in blocks of about ``BLOCK_CHARS`` characters, so what a task is sent is bounded; every
block is searched over all documents.  Null or empty texts have no terms, and are in no
result; items without terms, or whose terms occur nowhere, have no rows.  Equal scores order by document
id, null ids last.  Repeated documents are ranked each, repeated items answered each.  Very long texts are
taken whole.  Empty tables give no rows.  Extra columns of any name are ignored.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm import batches
from eventide.plans.lineage import materialize

BLOCK_CHARS = 4_000_000
#: Documents of a trie, and term entries that end one early.
TREE_DOCS, TREE_ENTRIES = 8192, 1_000_000
#: Documents that are scored together at the end of a path.
LEAF = 16
NO_ID = np.iinfo(np.int64).max

# Letters A-Z become small; what is no ASCII letter or digit, nor beyond ASCII, separates terms.
_FOLD = bytes(b if b >= 0x80 else b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
              for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def norm_of(n: str, docs: int, words: int) -> Column:
    """The length norm m of a document with ``n`` (a column) terms."""
    return F.expr(f"75L + (CAST(25 AS DECIMAL(2,0)) * CAST({docs} AS DECIMAL(16,0)) * CAST({n} AS DECIMAL(18,0))) "
                  f"div CAST({words} AS DECIMAL(19,0))")


def gain(tf: np.ndarray, m) -> np.ndarray:
    return (10 ** 9 * tf) // (1000 * tf + 12 * m)


class Items:
    """Weighted terms of the items of a block, as rows of (term rank, weight times repeats)."""

    def __init__(self, texts: list[list[int]], weight: np.ndarray):
        counts = [sorted(Counter(t).items()) for t in texts]
        sizes = np.array([len(c) for c in counts], dtype=np.int64)
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        self.term = np.array([t for c in counts for t, _ in c], dtype=np.int64)
        self.weight = weight[self.term] * np.array([n for c in counts for _, n in c], dtype=np.int64)
        self.vocabulary = len(weight)

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def scores(self, gains: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Scores of the items ``which`` (each with a term) for gains per term."""
        if len(which) * 4 > len(self):
            return np.add.reduceat(self.weight * gains[self.term], self.ptr[which]) if len(which) == len(self) \
                else np.add.reduceat(np.append(self.weight * gains[self.term], 0), self._cuts(which))[::2]
        sizes = self.ptr[which + 1] - self.ptr[which]
        first = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.ptr[which] - first, sizes)
        return np.add.reduceat(self.weight[at] * gains[self.term[at]], first)

    def _cuts(self, which: np.ndarray) -> np.ndarray:
        return np.stack([self.ptr[which], self.ptr[which + 1]], axis=1).ravel()


class Best:
    """The best ``k`` documents per item: (falling score, rising id)."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.score, self.id = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)

    def open(self, which: np.ndarray, score: np.ndarray, doc_id) -> np.ndarray:
        """Whether a document of this score and id (or any with smaller ones) would enter."""
        return (score > self.score[which]) | ((score == self.score[which]) & (score > 0) & (doc_id < self.id[which]))

    def add(self, item: int, score: int, doc_id: int) -> None:
        found = self.found[item]
        bisect.insort(found, (-score, doc_id))
        if len(found) > self.k:
            found.pop()
        if len(found) == self.k:
            self.score[item], self.id[item] = -found[-1][0], found[-1][1]


class Node:
    """Documents lo to hi of a trie; without children they are scored one by one."""

    __slots__ = ("depth", "lo", "hi", "children", "terms", "most", "least_m", "least_id")

    def __init__(self, depth: int, lo: int, hi: int = 0):
        self.depth, self.lo, self.hi, self.children = depth, lo, hi, []


class Trie:
    """Restricted vectors of documents, sorted by path; ``ptr`` cuts ``term`` and ``tf`` into rows."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ptr: np.ndarray, term: np.ndarray, tf: np.ndarray):
        paths = term.astype(">u4")
        keys = [paths[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:])]
        order = np.array(sorted(range(len(keys)), key=lambda i: (keys[i], m[i], ids[i])), dtype=np.int64)
        sizes = (ptr[1:] - ptr[:-1])[order]
        at = np.arange(len(term)) + np.repeat(ptr[:-1][order] - (np.cumsum(sizes) - sizes), sizes)
        self.ids, self.m, self.term, self.tf = ids[order], m[order], term[at], tf[at]
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        self.root = self._grow()
        self._summarise()

    def _shared(self, i: int) -> int:
        """Terms that the paths of documents i - 1 and i share."""
        a, b = self.term[self.ptr[i - 1]:self.ptr[i]], self.term[self.ptr[i]:self.ptr[i + 1]]
        n = min(len(a), len(b))
        unlike = np.flatnonzero(a[:n] != b[:n])
        return int(unlike[0]) if len(unlike) else n

    def _grow(self) -> Node:
        n = len(self.ids)
        stack = [Node(0, 0)]
        for i in range(1, n + 1):
            shared = self._shared(i) if i < n else 0
            child = Node(int(self.ptr[i] - self.ptr[i - 1]) + 1, i - 1, i)
            while stack[-1].depth > shared:
                top = stack.pop()
                top.children.append(child)
                child = self._close(top, i)
            if stack[-1].depth < shared:
                stack.append(Node(shared, child.lo))
            stack[-1].children.append(child)
        return self._close(stack[0], n)

    @staticmethod
    def _close(node: Node, hi: int) -> Node:
        """Small subtrees become leaves, and neighbouring small children one leaf."""
        node.hi = hi
        if hi - node.lo <= LEAF:
            node.children = []
            return node
        merged: list[Node] = []
        for child in node.children:
            last = merged[-1] if merged else None
            if last and not last.children and not child.children and child.hi - last.lo <= LEAF:
                last.hi = child.hi
            else:
                merged.append(child)
        node.children = merged
        return node

    def _summarise(self) -> None:
        todo, order = [self.root], []
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.children
        for node in reversed(order):                     # children before their parent
            if node.children:
                terms = np.concatenate([c.terms for c in node.children])
                most = np.concatenate([c.most for c in node.children])
            else:
                span = slice(self.ptr[node.lo], self.ptr[node.hi])
                terms, most = self.term[span], self.tf[span]
            by = np.argsort(terms, kind="stable")
            terms = terms[by]
            first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
            node.terms = terms[first]
            node.most = np.maximum.reduceat(most[by], first) if len(terms) else most
            node.least_m, node.least_id = self.m[node.lo:node.hi].min(), self.ids[node.lo:node.hi].min()

    def search(self, items: Items, best: Best) -> int:
        """Puts what enters into ``best``; returns the number of nodes and documents scored."""
        gains = np.zeros(items.vocabulary, dtype=np.int64)

        def scored(terms, tf, m, which):
            gains[terms] = gain(tf, m)
            out = items.scores(gains, which)
            gains[terms] = 0
            return out

        every = np.flatnonzero(items.ptr[1:] > items.ptr[:-1])
        if not len(every):
            return 0
        looked = 1
        stack = [(self.root, every, scored(self.root.terms, self.root.most, self.root.least_m, every))]
        while stack:
            node, which, bound = stack.pop()
            on = best.open(which, bound, node.least_id)   # the best may have risen since the bound was taken
            which = which[on]
            if not len(which):
                continue
            if not node.children:
                for i in range(node.lo, node.hi):
                    looked += 1
                    span = slice(self.ptr[i], self.ptr[i + 1])
                    score = scored(self.term[span], self.tf[span], self.m[i], which)
                    for j in np.flatnonzero(best.open(which, score, self.ids[i])).tolist():
                        best.add(int(which[j]), int(score[j]), int(self.ids[i]))
                continue
            below = [(c, which, scored(c.terms, c.most, c.least_m, which)) for c in node.children]
            looked += len(below)
            stack += sorted(below, key=lambda x: int(x[2].sum()))    # the most promising child is taken next
        return looked


def vectors(docs: DataFrame, known: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): all terms counted, those in ``known`` listed by number."""
    def make(texts):
        n, terms, tfs = [], [], []
        for t in texts:
            words = terms_of(t)
            counts = Counter(words)
            kept = [(known[w], c) for w, c in counts.items() if w in known]
            n.append(len(words))
            terms.append([k for k, _ in kept])
            tfs.append([c for _, c in kept])
        return [n, terms, tfs]

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return batches.append(rows, [("n", "long"), ("terms", "array<int>"), ("tfs", "array<int>")], make, ["text"], ["doc_id"])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy()


def top_of_tasks(rows: DataFrame, items: Items, place: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best ``k`` per item.  ``place``: rank of a term number by frequency."""
    def trees(chunks: Iterator[pa.RecordBatch]) -> Iterator[Trie]:
        held: list[tuple] = []
        size = entries = 0

        def grow() -> Trie:
            ids, m, sizes, term, tf = (np.concatenate(c) for c in zip(*held))
            row = np.repeat(np.arange(len(ids)), sizes)
            by = np.lexsort((term, row))
            return Trie(ids, m, np.concatenate([[0], np.cumsum(sizes)]), term[by], tf[by])

        for chunk in chunks:
            ids = chunk.column(0)
            missing = np.asarray(ids.is_null())
            offsets, term = _lists(chunk.column(2))
            tf = _lists(chunk.column(3))[1]
            held.append((np.where(missing, NO_ID, ids.fill_null(0).to_numpy()), chunk.column(1).to_numpy(),
                         np.diff(offsets).astype(np.int64), place[term], tf.astype(np.int64)))
            size, entries = size + chunk.num_rows, entries + len(term)
            if size >= TREE_DOCS or entries >= TREE_ENTRIES:
                yield grow()
                held, size, entries = [], 0, 0
        if size:
            yield grow()

    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items), k)
        for tree in trees(chunks):
            tree.search(items, best)
        flat = [(i, None if d == NO_ID else d, -s) for i, found in enumerate(best.found) for s, d in found]
        for at in range(0, len(flat), 50_000):
            part = list(zip(*flat[at:at + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int64()),
                                              pa.array(part[2], pa.int64())], names=["item", "doc_id", "score"])

    return batches.small_batches(rows).select("doc_id", "m", "terms", "tfs").mapInArrow(run, "item int, doc_id long, score long")


def search_block(docs: DataFrame, block: list[tuple[int | None, bytes | None]], k: int = 20) -> DataFrame | None:
    """Ranked documents of a block of items (id, text); None if no item has terms that occur."""
    spark = docs.sparkSession
    texts = [terms_of(t) for _, t in block]
    known = {t: i for i, t in enumerate(sorted({t for ts in texts for t in ts}))}
    if not known:
        return None
    rows = materialize(vectors(docs, known), "lexical-vectors")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("words")).first()
    if not total["words"]:
        return None
    df = np.zeros(len(known), dtype=np.int64)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        df[r["t"]] = r["n"]
    place = np.empty(len(known), dtype=np.int64)
    by_frequency = np.argsort(-df, kind="stable")
    place[by_frequency] = np.arange(len(known))
    weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(n) + 1))) for n in df[by_frequency]],
                      dtype=np.int64)
    items = Items([[int(place[known[t]]) for t in ts] for ts in texts], weight)
    rows = rows.filter(F.size("terms") > 0).withColumn("m", norm_of("n", total["docs"], total["words"]))
    best = top_of_tasks(rows, items, place, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], "item int, item_id long")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, *, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, over all documents."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    chars = asked.agg(F.sum(F.length("text") + 16).alias("n")).first()["n"] or 0
    n = -(-chars // BLOCK_CHARS)
    out = None
    for b in range(n):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        found = search_block(docs, [(r["item_id"], r["text"].encode("utf-8", "replace") if r["text"] else None) for r in block], k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
