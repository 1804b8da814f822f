"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are normalised, centred, rotated to their principal axes and then by learned
rotations that bring them near the corners of the cube (iterative
quantisation); the signs are the code.  Codes split into 16-bit substrings, each indexed.  Two
codes within Hamming radius r agree in some substring up to its share of
r (the pigeonhole principle), so probing every substring index to its share retrieves every code within
the radius; these are reranked by cosine on the original vectors in double
precision.  If fewer than k codes lie within r, the radius grows
to the k-th nearest code.

The rotations are fitted on a bounded sample (``sample`` vectors in hash order).  The
radius is the ``quantile`` of the code distances of true neighbours, found by brute force for
``probes`` queries over all rows.  Index and queries are dealt into
blocks of bounded size and every pair of an index and a query block is one task group.  The queries being a fixed
share of the rows, the pairs grow with the square of the table; blocks grow with it up to a bounded size.

Vectors that are null, zero, hold null or non-finite components or do not
have the commonest dimension (the larger on ties) take no part; neither do null ids.  An id counts once (of
different vectors, the smallest); a query never finds its own id.  An empty table gives no rows; extra columns of any
name are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Least rows of an index block and of a query block, and bytes that a block of vectors grows to with the table.
INDEX_ROWS, QUERY_ROWS = 8192, 1024
INDEX_BYTES, QUERY_BYTES = 64 << 20, 8 << 20
_SCHEMA = "query_id long, vec_id long, score double"


@dataclass
class Codes:
    """Mean, and a matrix whose columns are the learned directions."""

    mean: np.ndarray
    turn: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = (unit(x) - self.mean) @ self.turn > 0
        short = -bits.shape[1] % 16
        return np.packbits(np.pad(bits, ((0, 0), (0, short))), axis=1).view(np.uint16)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn(x: np.ndarray, rotations: int = 2, rounds: int = 40) -> Codes:
    """Iterative quantisation, from several random starts side by side."""
    x = unit(x)
    mean = x.mean(axis=0)
    x = x - mean
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    v = x @ axes
    rng, turns = np.random.default_rng(11), []
    for _ in range(rotations):
        turn = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
            turn = (a @ b).T
        turns.append(axes @ turn)
    return Codes(mean, np.concatenate(turns, axis=1))


def distances(a: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ a).sum(axis=-1, dtype=np.int32)


class MultiIndex:
    """Codes of a block, indexed by each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, first = np.unique(codes[order, j], return_index=True)
            self.tables.append((order, values, np.append(first, len(order))))

    def within(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of every code within the radius."""
        parts = len(self.tables)
        share, more = divmod(radius, parts)      # `more + 1` substrings at the share, the rest one less
        found = np.zeros(len(self.codes), bool)
        for j, (order, values, first) in enumerate(self.tables):
            reach = share if j <= more else share - 1
            if reach < 0:
                continue
            near = np.bitwise_count(values ^ query[j]) <= reach          # buckets to probe
            found[order[np.repeat(near, np.diff(first))]] = True
        rows = np.flatnonzero(found)
        d = distances(query, self.codes[rows])
        return rows[d <= radius], d[d <= radius]

    def search(self, query: np.ndarray, radius: int, k: int) -> np.ndarray:
        """Rows of every code within the radius, or within the k-th nearest code's distance if that is larger."""
        rows, _ = self.within(query, radius)
        while len(rows) < min(k, len(self.codes)):
            radius = 2 * radius + len(self.tables)
            rows, d = self.within(query, radius)
            if len(rows) >= min(k, len(self.codes)):
                kth = np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1]
                rows = rows[d <= kth]
        return rows


def cosines(x: np.ndarray, norms: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores wherever they stand."""
    return (x * q).sum(axis=1) / (norms * math.sqrt((q * q).sum()))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v): the rows that take part, vectors in double precision."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    return np.asarray(flat, dtype=np.float64).reshape(rows, -1)


def _once(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per id, the smallest vector."""
    if len(np.unique(ids)) == len(ids):
        order = np.argsort(ids, kind="stable")
        return ids[order], x[order]
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    keep = np.concatenate([[True], ids[1:] != ids[:-1]])
    return ids[keep], x[keep]


def _best(qid: int, ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    other = ids != qid
    ids, scores = ids[other], scores[other]
    order = np.lexsort((ids, -scores))[:k]
    return [(qid, int(ids[i]), float(scores[i])) for i in order]


def _batch(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.float64())]


def exact(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """The k nearest of a bounded list of queries among all rows, by brute force."""
    def run(batches):
        for batch in batches:
            ids, x = _once(np.asarray(batch.column(0)), _matrix(batch.column(1), batch.num_rows))
            norms = np.sqrt((x * x).sum(axis=1))
            out = [r for qid, q in queries for r in _best(qid, ids, cosines(x, norms, np.array(q)), k)]
            yield pa.RecordBatch.from_arrays(_batch(out), names=["query_id", "vec_id", "score"])
    return top(rows.select("id", "v").mapInArrow(run, _SCHEMA), k)


def top(found: DataFrame, k: int) -> DataFrame:
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def radius_for(rows: DataFrame, codes: Codes, is_query, probes: int, k: int, quantile: float) -> int:
    """The quantile of code distances from probe queries to their true neighbours."""
    drawn = (rows.filter(is_query).orderBy(F.xxhash64(F.lit("probe"), "id"), "id", "v").limit(probes).collect())
    queries = list({r["id"]: (r["id"], list(r["v"])) for r in drawn}.values())
    if not queries:
        return 0
    near = exact(rows, queries, k)
    pairs = near.join(rows, near["vec_id"] == rows["id"]).select("query_id", "v").collect()
    if not pairs:
        return 0
    of = {qid: codes.of(np.array([q]))[0] for qid, q in queries}
    found = codes.of(np.array([p["v"] for p in pairs]))
    d = [int(distances(of[p["query_id"]], found[n])) for n, p in enumerate(pairs)]
    return int(np.quantile(d, quantile, method="higher"))


def search(vectors: DataFrame, every: int = 50, k: int = 5, *, vec_id: str = "vec_id", embedding: str = "embedding",
           rotations: int = 2, sample: int = 8192, probes: int = 64, quantile: float = 0.99) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row whose id is divisible by ``every``."""
    rows = usable(vectors, vec_id, embedding)
    is_query = F.col("id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    drawn = rows.orderBy(F.xxhash64(F.lit("codes"), "id"), "id", "v").limit(sample).select("v").collect()
    if not drawn or not n_queries:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = learn(np.array([r["v"] for r in drawn]), rotations)
    radius = radius_for(rows, codes, is_query, probes, k, quantile)
    # Large tables get larger blocks, up to a size in bytes, so that fewer copies of the index are sent.
    width = 8 * len(drawn[0]["v"])
    index_rows = max(INDEX_ROWS, min(n // 256, INDEX_BYTES // width))
    query_rows = max(QUERY_ROWS, min(n_queries // 32, QUERY_BYTES // width))
    index_blocks, query_blocks = -(-n // index_rows), -(-n_queries // query_rows)
    deal = lambda blocks, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(blocks)).cast("int")
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    index = rows.select(deal(index_blocks, "i").alias("ib"), all_of(query_blocks).alias("qb"), "id", "v")
    queries = rows.filter(is_query).select(all_of(index_blocks).alias("ib"), deal(query_blocks, "q").alias("qb"), "id", "v")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, x = _once(np.asarray(left["id"]), _matrix(left["v"], left.num_rows))
            qids, qs = _once(np.asarray(right["id"]), _matrix(right["v"], right.num_rows))
            norms = np.sqrt((x * x).sum(axis=1))
            table = MultiIndex(codes.of(x))
            for qid, q, code in zip(qids.tolist(), qs, codes.of(qs)):
                at = table.search(code, radius, k + 1)      # one may be the query itself
                out += _best(qid, ids[at], cosines(x[at], norms[at], q), k)
        return pa.Table.from_arrays(_batch(out), names=["query_id", "vec_id", "score"])

    found = index.groupBy("ib", "qb").cogroup(queries.groupBy("ib", "qb")).applyInArrow(run, _SCHEMA)
    return top(found, k)
