"""Personal data by fixed patterns and a skip-chain conditional random field.

The base spans (email, ip, card, phone) are the leftmost non-overlapping matches of fixed patterns that pass their
check.  The field adds mentions that the patterns miss, such as a known number in another notation.

Tokens are the runs of ``A-Za-z0-9@._%+()/:-`` that hold a digit or ``@``; all other words are outside every entity
by definition.  A token is outside (O) or begins or continues one of the kinds (nine labels), scored by hashed
features of its shape, digits and neighbours.  Tokens with only white space between them share chain potentials.  Distant tokens
that repeat each other, or carry the same seven digits up to their end whatever the notation, share skip potentials:
each is linked to the next with the same key, so a document has at most ``KEYS`` skip links per token, however often one
repeats.  Loopy belief propagation (``STEPS`` rounds, the same for every document) spreads the labels; tokens
of base spans are held at their label, so what is certain in one place decides the doubtful in another.

A span is added for a run of tokens whose marginals say the same kind at ``SURE`` or more, if it touches no base
span and is linked to one; base spans always stay.  Trained here on the base spans of a bounded sample of texts
(``max_docs`` texts with digits and ``max_chars`` characters, none above a 200th of that, drawn by hash), each followed by its
own numbers in other notations and by strange ones, by gradient steps on the
likelihood with the marginals of the same propagation.

Null and empty texts have no spans.  Rows are independent, so repeated rows repeat their result; very long texts are taken
whole, in linear time.  Ties between labels go to O, then in order of kinds.  An empty table gives no rows (and no model:
base spans only).  Columns of ``keep`` are passed on; extra columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventide.llm import batches

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)                     # O, then begin and continue of every kind
BUCKETS = 1 << 12
STEPS = 12
DAMPING = 0.5
KEYS = 2
SURE = 0.8
#: Added to the score of a label that a base span fixes.
HELD = 30.0

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot begin inside a run of digits, so the look-behind changes no match; it keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9@._%+()/:-])[A-Za-z._%+()/:-]*+[0-9@][A-Za-z0-9@._%+()/:-]*+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]                     # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` with what may stand before it, back to the last match at most."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(x) <= 3 and int(x or "0") <= 255 for x in (p.lstrip("0") for p in m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


def shape_of(token: str) -> str:
    """Runs of digits with their length, runs of letters as ``a``, other characters as they are."""
    out, i = [], 0
    while i < len(token):
        j = i
        if token[i].isdigit():
            while j < len(token) and token[j].isdigit():
                j += 1
            out.append(f"9{min(j - i, 20)}")
        elif token[i].isalpha():
            while j < len(token) and token[j].isalpha():
                j += 1
            out.append("a")
        else:
            j += 1
            out.append(token[i])
        i = j
        if len(out) >= 24:                       # a long mixed token: its beginning says what it is not
            out.append("~")
            break
    return "".join(out)


@dataclass
class Graph:
    """Tokens of one text: places, features, links and the labels of its base spans."""

    spans: list[tuple[int, int]]                 # of the tokens, without outer punctuation
    features: list[list[int]]
    chain: list[int]                             # i if tokens i and i + 1 are neighbours
    skip: list[tuple[int, int, int]]             # tokens i < j and the kind of their key
    held: list[int]                              # label of the base span, or -1


def _features(token: str, digits: str, before: str, after: str, run: int) -> list[int]:
    shape = shape_of(token)
    total = len(digits)
    parts = token.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    return [_bucket(f) for f in (
        "bias", "shape " + shape, f"digits {min(total, 21)}", f"run {min(run, 21)}", f"at {token.count('@')}", f"dots {min(token.count('.'), 5)}",
        "letters" if any(c.isalpha() for c in token) else "no letters", f"quad {quad}",
        f"plus {token[:1] == '+'} {before[:1] == '+'}", f"paren {token[:1] == '('} {token[-1:] == ')'}", f"dash {min(token.count('-'), 4)}",
        "before " + before, "after " + after, f"{before} {shape} {after}")]


def graph_of(text: str, base: list[Span]) -> Graph:
    spans, tokens = [], []
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in "._%-)/:":
            a += 1
        while b > a and text[b - 1] in "._%-(+/:":
            b -= 1
        if a < b:
            spans.append((a, b))
            tokens.append(text[a:b])
    n = len(tokens)
    near = [spans[i + 1][0] - spans[i][1] <= 3 and text[spans[i][1]:spans[i + 1][0]].strip(" \t") == "" for i in range(n - 1)]
    digits = [_NOT_DIGIT.sub("", t) for t in tokens]
    shapes = [shape_of(t) for t in tokens]
    run, features, skip = [0] * n, [], []
    tails = [""] * n                              # the last digits of the neighbouring tokens up to here
    for i in range(n):
        joined = i > 0 and near[i - 1]
        run[i] = len(digits[i]) + (run[i - 1] if joined else 0)
        tails[i] = ((tails[i - 1] if joined else "") + digits[i])[-7:]
    last: dict[tuple[int, str], int] = {}
    for i, t in enumerate(tokens):
        features.append(_features(t, digits[i], shapes[i - 1] if i and near[i - 1] else "-",
                                  shapes[i + 1] if i + 1 < n and near[i] else "-", run[i]))
        keys = [(0, t.lower())] if len(t) >= 4 else []
        if len(tails[i]) == 7 and digits[i]:
            keys.append((1, tails[i]))
        for key in keys:
            j = last.get(key)
            if j is not None:
                skip.append((j, i, key[0]))
            last[key] = i
    held = [-1] * n
    for kind, a, b in base:
        i, first = _first_ending_after(spans, a), True
        while i < n and spans[i][0] < b:
            if held[i] < 0:
                held[i] = 1 + 2 * kind + (not first)
            first = False
            i += 1
    return Graph(spans, features, [i for i in range(n - 1) if near[i]], skip, held)


def _first_ending_after(spans: list[tuple[int, int]], place: int) -> int:
    lo, hi = 0, len(spans)
    while lo < hi:
        mid = (lo + hi) // 2
        if spans[mid][1] <= place:
            lo = mid + 1
        else:
            hi = mid
    return lo


@dataclass
class Field:
    """Weights: features by label, chain (left label by right label), skip (kind of key by labels, symmetric)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


class Batch:
    """Several graphs laid side by side."""

    def __init__(self, graphs: list[Graph]):
        sizes = [len(g.spans) for g in graphs]
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.n = int(self.start[-1])
        self.held = np.array([h for g in graphs for h in g.held], dtype=np.int64)
        self.row = np.array([i + s for g, s in zip(graphs, self.start.tolist()) for i, f in enumerate(g.features) for _ in f], dtype=np.int64)
        self.bucket = np.array([b for g in graphs for f in g.features for b in f], dtype=np.int64)
        links = [(i + s, i + 1 + s, 0) for g, s in zip(graphs, self.start.tolist()) for i in g.chain]
        links += [(i + s, j + s, 1 + k) for g, s in zip(graphs, self.start.tolist()) for i, j, k in g.skip]
        self.left, self.right, self.kind = np.array(links, dtype=np.int64).reshape(-1, 3).T

    def scores(self, field: Field) -> np.ndarray:
        return np.stack([np.bincount(self.row, field.unary[self.bucket, j], self.n) for j in range(LABELS)], axis=1)


def _normal(x: np.ndarray, axis) -> np.ndarray:
    x = x - x.max(axis=axis, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=axis, keepdims=True))


def propagate(batch: Batch, field: Field, scores: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(marginals of the tokens, joint marginals of the links) after ``steps`` rounds of messages.

    Messages are log vectors of link ends: ``to_right`` from the left token to the right one, and back.
    """
    tables = np.concatenate([field.chain[None], field.skip])[batch.kind]       # link x left label x right label
    moves = np.exp(tables)
    back = moves.transpose(0, 2, 1)
    to_right, to_left = np.zeros((2, len(batch.kind), LABELS))

    def beliefs():
        total = scores.copy()
        np.add.at(total, batch.right, to_right)
        np.add.at(total, batch.left, to_left)
        return total

    def message(x, table):                          # log of exp(x) times the table, without overflow
        top = x.max(axis=1, keepdims=True)
        return _normal(np.log(np.einsum("ea,eab->eb", np.exp(x - top), table)) + top, 1)

    for step in range(steps if len(batch.kind) else 0):
        total = beliefs()
        new_right = message(total[batch.left] - to_left, moves)
        new_left = message(total[batch.right] - to_right, back)
        keep = DAMPING if step else 0.0
        to_right, to_left = keep * to_right + (1 - keep) * new_right, keep * to_left + (1 - keep) * new_left
    total = beliefs()
    joint = (total[batch.left] - to_left)[:, :, None] + tables + (total[batch.right] - to_right)[:, None, :]
    return np.exp(_normal(total, 1)), np.exp(_normal(joint, (1, 2))) if len(joint) else joint


def train(graphs: list[Graph], rounds: int = 40, rate: float = 0.2, l2: float = 2e-3) -> Field | None:
    """A field fitted to the held labels (O where none) by Adam."""
    graphs = [g for g in graphs if g.spans]
    if not graphs:
        return None
    batch = Batch(graphs)
    gold = np.maximum(batch.held, 0)
    params = [np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((2, LABELS, LABELS))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        field = Field(*params)
        for p, g, a, b in zip(params, gradient(batch, field, gold), first, second):
            g = g / batch.n + l2 * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
    return Field(*params)


def rewritten(text: str, base: list[Span], seed: int) -> tuple[str, list[Span]]:
    """``text`` and its spans, followed by its numbers in notations that no pattern fits, which are spans too,
    and by strange numbers in the same notations, which are none: only the link to a span tells them apart."""
    rng, spans = np.random.default_rng(seed), list(base)
    for kind, a, b in base:
        digits = _NOT_DIGIT.sub("", text[a:b])
        if kind == 0 or len(digits) < 8:
            continue
        strange = "".join(str(x) for x in rng.integers(0, 10, len(digits)))
        for own, d in ((True, digits), (False, strange)):
            if kind == 1:
                said = text[a:b].replace(".", "-") if own else "-".join(str(x) for x in rng.integers(1, 256, 4))
            elif kind == 2:
                said = "./:"[int(rng.integers(3))].join(d[i:i + 4] for i in range(0, len(d), 4))
            else:
                d = d[-10:]
                said = ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "{}{}{}")[int(rng.integers(5))].format(d[:-7], d[-7:-4], d[-4:])
            text += " so on "
            if own:
                spans.append((kind, len(text) + (said[:1] == "("), len(text) + len(said)))
            text += said + " and"
    return text, spans


def gradient(batch: Batch, field: Field, gold: np.ndarray) -> list[np.ndarray]:
    """Expected minus observed counts of unary, chain and skip features."""
    single, joint = propagate(batch, field, batch.scores(field))
    single[np.arange(batch.n), gold] -= 1
    unary = np.stack([np.bincount(batch.bucket, single[batch.row, j], BUCKETS) for j in range(LABELS)], axis=1)
    pairs = np.zeros((3, LABELS, LABELS))
    np.add.at(pairs, batch.kind, joint)
    np.add.at(pairs, (batch.kind, gold[batch.left], gold[batch.right]), -1)
    skip = (pairs[1:] + pairs[1:].transpose(0, 2, 1)) / 2
    return [unary, pairs[0], skip]


def added_spans(graph: Graph, marginal: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of one kind that the field is sure of, touching no base span, tied to one by skip links of that kind."""
    best = marginal.argmax(axis=1)
    kind = np.where(best > 0, (best - 1) // 2, -1)
    by_kind = np.stack([marginal[:, 1 + 2 * k] + marginal[:, 2 + 2 * k] for k in range(len(KINDS))], axis=1)
    linked, grew = {i for i, h in enumerate(graph.held) if h >= 0}, True
    links = [(i, j) for i, j, _ in graph.skip if kind[i] == kind[j] >= 0]
    while grew:                                   # forward and back along the links, from the base spans
        size = len(linked)
        for i, j in links:
            if i in linked:
                linked.add(j)
        for i, j in reversed(links):
            if j in linked:
                linked.add(i)
        grew = len(linked) > size
    near, out, i, n = set(graph.chain), [], 0, len(best)
    free = [h < 0 for h in graph.held]
    while i < n:
        if kind[i] < 0 or not free[i]:
            i += 1
            continue
        j = i
        while j + 1 < n and j in near and free[j + 1] and best[j + 1] == 2 + 2 * kind[i]:
            j += 1
        sure = by_kind[i:j + 1, kind[i]].min() >= SURE
        clear = not (i > 0 and i - 1 in near and graph.held[i - 1] == best[i] and best[i] % 2 == 0)
        if sure and clear and any(x in linked for x in range(i, j + 1)):
            a, b = graph.spans[i][0], graph.spans[j][1]
            if not any(x < b and y > a for _, x, y in base):
                out.append((int(kind[i]), a, b))
        i = j + 1
    return out


def find(texts: list[str], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans by kind and start) of every text."""
    base = [base_spans(t) for t in texts]
    if field is None:
        return [(b, b) for b in base]
    # A span is added only if links tie it to a base span, so texts without any need no field.
    graphs = [graph_of(t, b) if b else None for t, b in zip(texts, base)]
    used = [g for g in graphs if g and g.spans and g.skip]
    marginals: dict[int, np.ndarray] = {}
    if used:
        batch = Batch(used)
        scores = batch.scores(field)
        at = np.flatnonzero(batch.held >= 0)
        scores[at, batch.held[at]] += HELD
        single = propagate(batch, field, scores)[0]
        marginals = {id(g): single[a:b] for g, a, b in zip(used, batch.start[:-1], batch.start[1:])}
    out = []
    for b, g in zip(base, graphs):
        more = added_spans(g, marginals[id(g)], b) if g is not None and id(g) in marginals else []
        out.append((b, sorted(b + more)))
    return out


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, max_docs: int = 1500, max_chars: int = 10_000_000) -> Field | None:
    """The field learned from the base spans of a sample of texts with digits or ``@``."""
    draw = F.pmod(F.xxhash64(F.lit("pii"), F.col(doc_id), F.length(text)), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.filter(F.col(text).rlike("[0-9@]") & (F.length(text) <= max_chars // 200))
    n = rows.count()                              # so that tasks hand on no more than the sample
    rows = (rows.select(F.col(text).alias("t"), draw.alias("u")).filter(F.col("u") < min(1.0, 1.3 * max_docs / max(n, 1)))
            .orderBy("u", "t").limit(max_docs).collect())
    graphs, left = [], max_chars
    for r in rows:
        if len(r["t"]) <= left:
            left -= len(r["t"])
            text = r["t"] + "\n"
            graphs.append(graph_of(*rewritten(text, base_spans(text), zlib.crc32(text.encode("utf-8", "replace")))))
    return train(graphs)


def scan(docs: DataFrame, field: Field | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans) and spans."""
    def make(texts):
        found = find([batches.text(t) for t in texts], field)
        counts = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in range(len(KINDS))]
        return [*counts, [hashlib.sha256(spelled(base).encode()).hexdigest() for base, _ in found], [spelled(s) for _, s in found]]

    fields = [(f"n_{k}", "long") for k in KINDS] + [("base_sha256", "string"), ("spans", "string")]
    return batches.append(docs, fields, make, [text], keep)
