"""Language identification by a linear-chain conditional random field over words.

Words are the runs of letters of the lower-cased text.  A word's emission
scores are summed weights of hashed features: character n-grams of one to four
with its borders marked (those at a border are its affixes), the word itself, and membership of a
lexicon of words typical of one language.  Learned transitions tie
neighbouring words, so switched passages get their own labels;
forward-backward gives each word's posterior, and a text's
language is the one with the largest mean posterior, which is the score.  A posterior only weighs the learned
languages against each other; whether a text is in any of them is told by its familiarity, the share of its
character n-grams of three and four that the sample held, relative to that of labelled spans left out (about 1 for a
text in a learned language).

Training uses a bounded sample: ``per_label`` spans of ``span`` words (500 of 48) of every language, fewer where
the languages are so many that they would exceed ``max_spans`` in all (at least one each), drawn by hash over all labelled
rows, spans at a hashed place of the text.  Spans of different languages are joined into switched sequences, so
the transitions between languages are learned too.  Everything else covers whole texts.

Text null or without letters: ``und``, score 0.  No labelled row: every text
is ``und``.  Equal means go to the smaller label.  Null labels are not learned from.  Repeated rows get equal results,
very long texts are taken whole, an empty table gives no rows, and extra columns of any name are passed on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm import batches
from eventide.llm.batches import Remembered

UNKNOWN = "und"
_WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
NGRAMS = 4
#: n-grams from this length tell whether a text is in a learned language at all.
FOREIGN = 3
#: Words whose scores a worker remembers; the memory is emptied when full.
REMEMBER = 120_000
_P = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L) of the lower-cased text."""
    words = _WORDS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    # Numbers like ½ or ② count as word characters for the pattern, but are no letters.
    return "".join(c if c.isalpha() else " " for w in words for c in (*w, " ")).split()


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature, row of ``words`` it belongs to), ordered by row within each kind."""
    sizes = np.array([len(w) + 2 for w in words])
    points = np.frombuffer(("".join("\x02" + w + "\x03" for w in words)).encode("utf-32-le", "surrogatepass"),
                           dtype="<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    start = ends - sizes
    buckets, rows = [], []
    h = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, NGRAMS + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = (h[:m] * _P + points[n - 1:]) ^ (h[:m] >> np.uint64(29))
        inside = np.arange(m) + n <= ends[row[:m]]
        buckets.append(_bucket(h[inside] + np.uint64(n)))
        rows.append(row[:m][inside])
    place = (np.arange(len(points)) - start[row]).astype(np.uint64)
    whole = np.add.reduceat((points + np.uint64(7)) * (place * _P ^ np.uint64(0xD6E8FEB86659FD93)), start)
    buckets.append(_bucket(whole + np.uint64(99)))
    rows.append(np.arange(len(words)))
    return np.concatenate(buckets), np.concatenate(rows)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((h ^ (h >> np.uint64(33))) >> np.uint64(48)).astype(np.int64)


@dataclass
class Crf:
    """Weights of the field; ``labels`` sorted."""

    labels: list[str]
    weight: np.ndarray                   # BUCKETS x labels
    lexicon_weight: np.ndarray           # lexicon language x label
    trans: np.ndarray                    # from x to
    start: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)
    seen: np.ndarray = field(default_factory=lambda: np.ones(BUCKETS, bool))    # of the sample's n-grams from FOREIGN on
    usual: float = 1.0                                                          # familiarity of words left out

    def see(self, words: list[str]) -> None:
        buckets = word_features(words)[0]
        self.seen = np.zeros(BUCKETS, bool)
        self.seen[buckets[longer_ngrams(words, len(buckets))]] = True

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log scores, one row per word."""
        return self.scored(words)[0]

    def familiar(self, words: list[str]) -> np.ndarray:
        """Share of every word's longer n-grams that the sample held, whatever the language, over the usual share."""
        return self.scored(words)[1]

    def scored(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log scores and familiarity of words, from the same features."""
        buckets, rows = word_features(words)
        out = np.stack([np.bincount(rows, self.weight[buckets, j], len(words)) for j in range(len(self.labels))], axis=1)
        got = [(n, self.lexicon[w]) for n, w in enumerate(words) if w in self.lexicon]
        if got:
            n, k = np.array(got).T
            out[n] += self.lexicon_weight[k]
        long = longer_ngrams(words, len(buckets))
        known = np.bincount(rows[long], self.seen[buckets[long]], len(words))
        return out, known / np.bincount(rows[long], minlength=len(words)) / self.usual


def longer_ngrams(words: list[str], features: int) -> slice:
    """Place of the n-grams from FOREIGN on among the features of words: after the shorter ones, before the whole words."""
    sizes = np.array([len(w) + 2 for w in words])
    return slice(int(sum((sizes - n + 1).sum() for n in range(1, FOREIGN))), features - len(words))


#: Words per block of the forward-backward scan.
BLOCK = 64


def _norm(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def forward_backward(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """(alpha, beta) of many non-empty sequences laid end to end in ``emit`` (exp scores).

    Sequences are cut into blocks.  All blocks first get their transfer matrix
    side by side; the messages at block borders follow from these, one step
    per block; then all blocks fill in their words side by side.  A very long
    text thus costs few steps, and the result is that of the plain recursion.
    """
    k = emit.shape[1]
    per = -(-lengths // BLOCK)                                   # blocks of each sequence
    seq = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(seq)) - np.repeat(np.cumsum(per) - per, per)
    begin = np.repeat(np.cumsum(lengths) - lengths, per) + nth * BLOCK
    size = np.minimum(BLOCK, lengths[seq] - nth * BLOCK)
    order = np.argsort(-size, kind="stable")                      # full blocks first
    begin, size, first = begin[order], size[order], (nth == 0)[order]
    where = np.empty_like(order)
    where[order] = np.arange(len(order))
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    enter = np.where(first[:, None, None], np.tile(start, (k, 1)), trans)   # into a block's first word
    move = enter * emit[begin][:, None, :]
    for t in range(1, longest):
        n = active[t]
        step = (move[:n] @ trans) * emit[begin[:n] + t][:, None, :]
        move[:n] = step / step.sum(axis=(1, 2), keepdims=True)
    before, after = np.full((len(seq), k), 1.0 / k), np.ones((len(seq), k))
    at = np.cumsum(per) - per                                     # place of each sequence's block 0
    many = np.argsort(-per, kind="stable")
    left = np.searchsorted(-per[many], -np.arange(1, int(per.max()) + 1), side="right")
    for j in range(1, len(left)):
        s = many[:left[j]]
        a, b = where[at[s] + j - 1], where[at[s] + j]
        before[b] = _norm((before[a][:, None, :] @ move[a])[:, 0])
    for j in range(len(left) - 1, 0, -1):
        s = many[:left[j]]
        a, b = where[at[s] + j - 1], where[at[s] + j]
        after[a] = _norm((move[b] @ after[b][:, :, None])[:, :, 0])
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    x = (before[:, None, :] @ enter)[:, 0]
    for t in range(longest):
        n = active[t]
        x = _norm((x[:n] if t == 0 else x[:n] @ trans) * emit[begin[:n] + t])
        alpha[begin[:n] + t] = x
    y = after[:active[-1]]
    for t in range(longest - 1, -1, -1):
        n = active[t]
        if t < longest - 1:
            y = _norm((emit[begin[:len(y)] + t + 1] * y) @ trans.T)
            y = np.concatenate([y, after[len(y):n]])
        beta[begin[:n] + t] = y
    return alpha, beta


def train(spans: list[tuple[str, list[str]]], rounds: int = 40, rate: float = 0.2, l2: float = 1e-4) -> Crf | None:
    """A field fitted to (label, words) spans by Adam on the full conditional likelihood."""
    spans = [(lab, w) for lab, w in spans if w]
    labels = sorted({lab for lab, _ in spans})
    if not labels:
        return None
    code = {lab: i for i, lab in enumerate(labels)}
    k = len(labels)
    vocab = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in spans for w in ws))}
    words = list(vocab)
    seen = np.zeros((len(words), k))
    for lab, ws in spans:
        for w in ws:
            seen[vocab[w], code[lab]] += 1
    total = seen.sum(axis=1)
    typical = (total >= 3) & (seen.max(axis=1) >= 0.8 * total)
    lexicon = {words[i]: int(seen[i].argmax()) for i in np.flatnonzero(typical)}
    # One to three spans make a sequence, in an order that mixes languages.
    rng = np.random.default_rng(7)
    shuffled = [spans[i] for i in rng.permutation(len(spans))]
    lengths, ids, gold, i = [], [], [], 0
    while i < len(shuffled):
        part = shuffled[i:i + 1 + int(rng.integers(3))]
        i += len(part)
        lengths.append(sum(len(w) for _, w in part))
        for lab, ws in part:
            ids += [vocab[w] for w in ws]
            gold += [code[lab]] * len(ws)
    lengths, ids, gold = np.array(lengths), np.array(ids), np.array(gold)
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(ids), bool)
    inner[first] = False
    observed = np.zeros((k, k))
    np.add.at(observed, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    observed_start = np.bincount(gold[first], minlength=k).astype(float)
    buckets, rows = word_features(words)
    lex = np.array([lexicon.get(w, -1) for w in words])
    at_lex = np.flatnonzero(lex >= 0)
    params = [np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros(k)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n = len(ids)
    for step in range(1, rounds + 1):
        weight, lex_weight, trans, start = params
        e = np.stack([np.bincount(rows, weight[buckets, j], len(words)) for j in range(k)], axis=1)
        e[at_lex] += lex_weight[lex[at_lex]]
        emit, moves = _exp(e)[ids], np.exp(trans)
        alpha, beta = forward_backward(emit, lengths, moves, np.exp(start))
        post = _norm(alpha * beta)
        ahead, into = alpha[:-1][inner[1:]], (emit * beta)[1:][inner[1:]]
        pairs = moves * ((ahead / ((ahead @ moves) * into).sum(axis=1, keepdims=True)).T @ into)
        starts = post[first].sum(axis=0)
        post[np.arange(n), gold] -= 1
        by_word = np.stack([np.bincount(ids, post[:, j], len(words)) for j in range(k)], axis=1)
        grads = [np.stack([np.bincount(buckets, by_word[rows, j], BUCKETS) for j in range(k)], axis=1),
                 np.stack([np.bincount(lex[at_lex], by_word[at_lex, j], k) for j in range(k)], axis=1),
                 pairs - observed, starts - observed_start]
        for p, g, mm, vv in zip(params, grads, m, v):
            g = g / n + l2 * p
            mm += 0.1 * (g - mm)
            vv += 0.01 * (g * g - vv)
            p -= rate * (mm / (1 - 0.9 ** step)) / (np.sqrt(vv / (1 - 0.99 ** step)) + 1e-6)
    weight, lex_weight, trans, start = params
    model = Crf(labels, weight.astype(np.float32), lex_weight, trans, start, lexicon)
    # What is usual shows in spans left out: every tenth against the others.
    kept, left = [w for i, (_, ws) in enumerate(spans) if i % 10 for w in ws], [w for _, ws in spans[::10] for w in ws]
    if kept:
        model.see(kept)
        model.usual = max(float(model.familiar(left).mean()), 0.01)
    model.see(words)
    return model


def _exp(scores: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30.0))


def sample(rows: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id", *,
           per_label: int = 500, span: int = 48, max_spans: int = 32_000) -> list[tuple[str, list[str]]]:
    """At most ``max_spans`` spans of labelled rows (or one per language), spread over all of them by hash."""
    rows = rows.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    n = rows.groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    top = [(r["l"], r["n"]) for r in n.orderBy("l").collect()]
    if not top:
        return []
    per_label = max(1, min(per_label, max_spans // len(top)))
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col(doc_id), F.length(text)), F.lit(1 << 30)) / float(1 << 30)
    # Somewhat more than needed, so that no language falls short by chance.
    drawn = rows.filter(draw < F.try_element_at(F.create_map(
        *[F.lit(x) for lab, c in top for x in (lab, min(1.0, (1.3 * per_label + 20) / c))]), F.col(label)))

    def cut(texts, hashes):
        out = []
        for t, h in zip(texts, hashes):
            w = words_of(batches.text(t))
            at = h % max(1, len(w) - span + 1)
            out.append(" ".join(w[at:at + span]))
        return [out]

    drawn = drawn.select(F.col(label).alias("l"), F.col(text).alias("t"), draw.alias("u"),
                         F.abs(F.hash(F.col(doc_id), F.length(text))).cast("long").alias("h"))
    got = batches.append(drawn, [("words", "string")], cut, ["t", "h"], ["l", "u"])
    got = got.withColumn("nth", F.row_number().over(Window.partitionBy("l").orderBy("u", "words"))).filter(
        F.col("nth") <= per_label).orderBy("u", "l", "words").collect()
    return [(r["l"], r["words"].split(" ") if r["words"] else []) for r in got]


def memory_of(model: Crf) -> Remembered:
    """Exp scores and familiarity of words, remembered by a worker."""
    def make(words):
        scores, familiar = model.scored(words)
        return np.column_stack([_exp(scores), familiar])

    return Remembered(make, len(model.labels) + 1, np.float64, REMEMBER)


def label_texts(model: Crf, texts: list[str | None],
                memory: Remembered | None = None) -> tuple[list[str], list[float], list[float]]:
    """(label, score, mean familiarity of the words) of every text."""
    memory = memory or memory_of(model)
    words = [words_of(t) if t else [] for t in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    labels, scores, familiar = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    full = np.flatnonzero(lengths)
    if len(full):
        rows = memory.of([w for ws in words for w in ws])
        alpha, beta = forward_backward(rows[:, :-1], lengths[full], np.exp(model.trans), np.exp(model.start))
        first = np.cumsum(lengths[full]) - lengths[full]
        post = np.column_stack([_norm(alpha * beta), rows[:, -1]])
        means = np.add.reduceat(post, first, axis=0) / lengths[full][:, None]
        known, means = means[:, -1], means[:, :-1]
        for n, best, p, f in zip(full.tolist(), means.argmax(axis=1).tolist(), means.max(axis=1).tolist(), known.tolist()):
            labels[n], scores[n], familiar[n] = model.labels[best], min(p, 1.0), f
    return labels, scores, familiar


def predict(docs: DataFrame, model: Crf | None, text: str = "text",
            out: tuple[str, ...] = ("lang_pred", "score"), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the predicted label, its score and, if a third name is given, the text's familiarity."""
    if model is None:
        return docs.select(*[batches.quoted(c) for c in keep or docs.columns]).withColumns(
            {out[0]: F.lit(UNKNOWN), **{c: F.lit(0.0) for c in out[1:]}})
    memory: list[Remembered] = []

    def make(texts):
        if not memory:
            memory.append(memory_of(model))
        return list(label_texts(model, [batches.text(t) for t in texts], memory[0]))[:len(out)]

    return batches.append(docs, [(out[0], "string"), *[(c, "double") for c in out[1:]]], make, [text], keep)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the row's id falls in the fold (null ids: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id", **kw) -> Crf | None:
    """The field learned from the labelled rows outside fold 2 of 4."""
    return train(sample(docs.filter(F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id), 4, 2)), text, label, doc_id, **kw))
