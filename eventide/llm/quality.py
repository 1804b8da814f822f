"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of hashed n-grams: words and pairs of words (as written
and by shape: case, digits, the marks themselves), triples of shapes, and immediate
repetitions.  Each indicator is scaled by the log-count ratio of its n-gram
between the classes, and a linear hinge-loss model is fitted on top by dual
coordinate descent.  Margins of rows left out of a first fit give the logistic scale that
turns a margin into the score.

Labels come from a bounded sample (``max_docs`` labelled texts and ``max_chars``
characters, taken in hash order of the ids over all labelled rows); every text is scored whole.

Null and empty texts have no features: their score is the model's at the
origin.  Contradicting labels of an id are left out, repeated ones count
once.  Without both classes among the labelled rows every score is 1.0 if
only class 1 occurs, 0.0 if only class 0, else 0.5.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventide.llm import batches
from eventide.llm.batches import Remembered
from eventide.llm.langid import held_out

BUCKETS = 1 << 18
THRESHOLD = 0.3
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Tokens whose codes a worker remembers; the memory is emptied when full.
REMEMBER = 150_000
_M = np.uint64(0x9E3779B97F4A7C15)


def shape(token: str) -> str:
    if not token[0].isalnum() and token[0] != "_":
        return token[:4]
    if token.isdigit():
        return "9"
    if token.islower():
        return "x"
    if token.isupper():
        return "X" if len(token) > 1 else "I"
    return "Xx" if token[0].isupper() and token[1:].islower() else "xX" if token.isalpha() else "x9"


def _code(text: str) -> int:
    h = 0xCBF29CE484222325
    for b in text.encode("utf-8", "replace"):
        h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return h


def coder() -> Remembered:
    """Token codes (word, shape), remembered by a worker."""
    return Remembered(lambda tokens: np.array([(hash_word(t), hash_shape(shape(t))) for t in tokens], dtype=np.uint64),
                      2, np.uint64, REMEMBER)


_SHAPES: dict[str, int] = {}


def hash_shape(s: str) -> int:
    if s not in _SHAPES:
        if len(_SHAPES) > 100_000:
            _SHAPES.clear()
        _SHAPES[s] = _code("\x01" + s)
    return _SHAPES[s]


def hash_word(w: str) -> int:
    b = w.encode("utf-8", "replace")
    return zlib.crc32(b) << 32 | zlib.crc32(b, 0x5BD1E995)


def _mix(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint64(0)
    for p in parts:
        h = (h ^ (p if isinstance(p, np.ndarray) else np.uint64(p))) * _M
        h = h ^ (h >> np.uint64(29))
    return (h >> np.uint64(46)).astype(np.int64)


def features(texts: list[str | None], codes_of: Remembered) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every distinct feature, ordered by text."""
    tokens = [TOKEN.findall(t) if t else [] for t in texts]
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = codes_of.of([t for ts in tokens for t in ts])
    w, s = codes[:, 0], codes[:, 1]
    doc = np.repeat(np.arange(len(texts)), sizes)
    pair = doc[1:] == doc[:-1]
    triple = pair[1:] & pair[:-1]
    same = (w[1:] == w[:-1]) & pair
    keys = [(doc, _mix(w, 1)), (doc, _mix(s, 2)),
            (doc[1:][pair], _mix(w[:-1][pair], w[1:][pair], 3)), (doc[1:][pair], _mix(s[:-1][pair], s[1:][pair], 4)),
            (doc[2:][triple], _mix(s[:-2][triple], s[1:-1][triple], s[2:][triple], 5)),
            (doc[1:][same], _mix(s[1:][same], 6)),
            (doc[2:][triple & same[1:] & same[:-1]], _mix(s[2:][triple & same[1:] & same[:-1]], 7))]
    both = np.concatenate([d * BUCKETS + b for d, b in keys])
    both.sort()
    both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both // BUCKETS, both % BUCKETS


@dataclass
class Nbsvm:
    """Weight per bucket (ratio times coefficient), bias, logistic scale."""

    weight: np.ndarray
    bias: float
    scale: tuple[float, float]

    def margins(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(doc, self.weight[bucket], n) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1.0 / (1.0 + np.exp(-np.clip(a * margins + b, -30, 30)))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = [np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(y == c)]), minlength=BUCKETS) + alpha
              for c in (1, -1)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0,
                       rounds: int = 15) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias by coordinate descent in the dual."""
    w, bias = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([v @ v for v in values]) + 1.0
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * (w[r] @ v + bias) - 1.0
            a = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            if a != alpha[i]:
                step = (a - alpha[i]) * y[i]
                w[r] += step * v
                bias += step
                largest = max(largest, abs(a - alpha[i]))
                alpha[i] = a
        if largest < 1e-3:
            break
    return w, bias


def train(rows: list[np.ndarray], labels: list[int], cost: float = 0.1) -> Nbsvm:
    """Fit to the feature buckets of labelled texts; see the module for one-class data."""
    y = np.where(np.array(labels, dtype=np.int64) == 1, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        p = 30.0 if len(y) and y[0] > 0 else -30.0 if len(y) else 0.0
        return Nbsvm(np.zeros(BUCKETS, np.float32), 0.0, (0.0, p))

    def fit(keep: np.ndarray) -> tuple[np.ndarray, float]:
        some = [rows[i] for i in keep]
        ratio = log_count_ratio(some, y[keep])
        w, bias = coordinate_descent(some, [ratio[r] for r in some], y[keep], cost)
        return w * ratio, bias

    left = np.arange(len(y)) % 4 == 3
    scale = (1.0, 0.0)
    if len(set(y[left])) == 2 and len(set(y[~left])) == 2:
        w, bias = fit(np.flatnonzero(~left))
        scale = logistic(np.array([w[rows[i]].sum() + bias for i in np.flatnonzero(left)]), y[left])
    w, bias = fit(np.arange(len(y)))
    return Nbsvm(w.astype(np.float32), bias, scale)


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the label's log odds in the margin, by Newton steps with a small ridge."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    t = (np.where(y > 0, (y > 0).sum() + 1, 1)) / (np.where(y > 0, (y > 0).sum(), (y < 0).sum()) + 2)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p) - 1e-3 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return (float(max(beta[0], 1e-3)), float(beta[1]))


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", *,
           max_docs: int = 6000, max_chars: int = 24_000_000) -> tuple[list[np.ndarray], list[int]]:
    """Feature buckets and labels of a bounded sample outside fold 0 of 5."""
    lab = (labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id), 5, 0))
           .groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("y"), F.max(label).alias("hi"))
           .filter("y = hi").select("id", "y"))
    there = docs.select(F.col(doc_id).alias("id")).filter("id IS NOT NULL").distinct()
    ids = lab.join(there, "id").orderBy(F.xxhash64(F.lit("quality"), "id"), "id").limit(max_docs).collect()
    if not ids:
        return [], []
    drawn = docs.sparkSession.createDataFrame([(r["id"], int(r["y"]), n) for n, r in enumerate(ids)],
                                              "id long, y int, n int")
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(drawn), "id")
    sizes = {r["n"]: r["c"] for r in texts.groupBy("n").agg(F.max(F.length("t")).alias("c")).collect()}
    chars, kept = 0, []
    for n, r in enumerate(ids):
        if chars + (sizes.get(n) or 0) > max_chars:
            continue
        chars += sizes.get(n) or 0
        kept.append((r["id"], int(r["y"]), n))
    if len(kept) < len(ids):
        drawn = docs.sparkSession.createDataFrame(kept, "id long, y int, n int")
        texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(drawn), "id")

    def make(values):
        doc, bucket = features([batches.text(v) for v in values], coder())
        cuts = np.searchsorted(doc, np.arange(1, len(values)))
        return [[x.tolist() for x in np.split(bucket.astype(np.int32), cuts)]]

    got = batches.append(texts, [("f", "array<int>")], make, ["t"], ["n", "y"])
    one = {}
    for r in got.toLocalIterator():
        if r["n"] not in one or r["f"] < one[r["n"]][1].tolist():
            one[r["n"]] = r["y"], np.array(r["f"], dtype=np.int32)
    return [one[n][1] for n in sorted(one)], [one[n][0] for n in sorted(one)]


def fit(docs: DataFrame, labels: DataFrame, **kw) -> Nbsvm:
    return train(*sample(docs, labels, **kw))


def score(docs: DataFrame, model: Nbsvm, text: str = "text", out: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score of every whole text."""
    memory: list[Remembered] = []

    def make(texts):
        if not memory:
            memory.append(coder())
        doc, bucket = features([batches.text(t) for t in texts], memory[0])
        return [model.scores(model.margins(doc, bucket, len(texts)))]

    return batches.append(docs, [(out, "double")], make, [text], keep)
