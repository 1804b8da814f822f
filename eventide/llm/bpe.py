"""Byte-level BPE encoding and decoding with given ranks.

A pre-token's live byte positions hold, as keys of a segment tree, the rank of the
pair that starts there (with the position, so the minimum is the leftmost of
lowest rank).  The root names the next merge; the merge updates the
leaves of the two neighbouring pairs and of the consumed position, each along
one path to the root.  A pre-token of n bytes takes O(n log n).  ``merge``
does this for one pre-token; ``merge_many`` keeps the trees of many short ones as
rows of arrays and makes one merge in each per step.

Null text is the empty text: no tokens, decoded to no bytes.  Ill-formed
UTF-8 is read with replacement characters.  Repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from eventide.llm import batches

_NONE = 1 << 62
_POS = (1 << 32) - 1
#: Runs that a worker remembers as recently used, and as many older ones.
REMEMBER = 150_000
#: Bytes up to which pre-tokens are merged many at a time.
SHORT = 64
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Text cut where no pre-token of the public patterns can cross: an optional space with what
#: follows up to white space, or white space.  Each run is split by the pattern once and remembered.
RUNS = f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


class Encoder:
    """Ranks (token bytes -> id) and a pre-token pattern.

    ``runs`` must not cut through a match of the pattern; None splits by the pattern alone.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, runs: str | None = RUNS):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.runs = re.compile(runs) if runs else self.split
        self.token = {i: b for b, i in ranks.items()}
        self.bytes_of = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self.known: dict[str, str] = {}          # run -> its ids, as one character each
        self.older: dict[str, str] = {}
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.base = max(ranks.values()) + 1
        pairs = [(ranks[b[:k]] * self.base + ranks[b[k:]], r) for b, r in ranks.items()
                 for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks]
        pairs.sort()
        self.pair = np.array([p for p, _ in pairs], dtype=np.int64)
        self.pair_rank = np.array([r for _, r in pairs], dtype=np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks, n = self.ranks, len(piece)
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        after = list(range(1, n + 2))       # start of the next live token; n: the end
        before = list(range(-1, n))
        width = 1 << (n - 1).bit_length()
        tree = [_NONE] * (2 * width)
        get = ranks.get
        for i in range(n - 1):
            r = get(piece[i:i + 2])
            if r is not None:
                tree[width + i] = r << 32 | i
        for i in range(width - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(i: int, end: int) -> None:
            r = get(piece[i:end]) if end else None
            i += width
            tree[i] = _NONE if r is None else r << 32 | (i - width)
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                m = a if a < b else b
                if tree[i] == m:
                    return
                tree[i] = m
                i >>= 1

        while tree[1] != _NONE:
            i = tree[1] & _POS
            gone = after[i]
            end = after[i] = after[gone]
            before[end] = i
            put(gone, 0)
            put(i, after[end] if end < n else 0)
            left = before[i]
            if left >= 0:
                put(left, end)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:after[i]]])
            i = after[i]
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], _NONE)

    def merge_many(self, pieces: list[bytes]) -> list[str]:
        """Ids (as characters) of pre-tokens of at most SHORT bytes."""
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for n, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[n] = chr(whole)
            else:
                groups.setdefault(1 << (len(p) - 1).bit_length(), []).append(n)
        for width, members in groups.items():
            for n, ids in zip(members, self._merge_rows([pieces[n] for n in members], width)):
                out[n] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[str]:
        rows = len(pieces)
        size = np.array([len(p) for p in pieces])
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        token = np.concatenate([self.byte[flat].reshape(rows, width), np.zeros((rows, 1), np.int64)], axis=1)
        after = np.tile(np.arange(1, width + 2), (rows, 1))
        before = np.tile(np.arange(-1, width), (rows, 1))
        place = np.arange(width - 1)
        rank = self._ranks(token[:, :width - 1], token[:, 1:width])
        leaf = np.full((rows, width), _NONE, dtype=np.int64)
        leaf[:, :-1] = np.where((rank < _NONE) & (place + 1 < size[:, None]), rank << 32 | place, _NONE)
        tree = [leaf]
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, 0::2], tree[-1][:, 1::2]))
        stands = np.arange(width) < size[:, None]
        live = np.flatnonzero(tree[-1][:, 0] < _NONE)
        while len(live):
            root = tree[-1][live, 0]
            i, merged = root & _POS, root >> 32
            gone = after[live, i]
            end = after[live, gone]
            token[live, i] = merged
            after[live, i] = end
            before[live, end] = i
            r = self._ranks(merged, token[live, end])
            leaf[live, gone] = _NONE
            stands[live, gone] = False
            leaf[live, i] = np.where((end < size[live]) & (r < _NONE), r << 32 | i, _NONE)
            left = before[live, i]
            at = np.maximum(left, 0)
            r = self._ranks(token[live, at], merged)
            leaf[live, at] = np.where(left < 0, leaf[live, at], np.where(r < _NONE, r << 32 | at, _NONE))
            paths = [gone, i, at]
            for below, level in zip(tree, tree[1:]):
                paths = [p >> 1 for p in paths]
                for p in paths:
                    level[live, p] = np.minimum(below[live, 2 * p], below[live, 2 * p + 1])
            live = live[tree[-1][live, 0] < _NONE]
        chars = _chars(token[:, :width][stands])
        cuts = np.concatenate([[0], np.cumsum(stands.sum(axis=1))]).tolist()
        return [chars[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.known) > REMEMBER:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        cut = [self.runs.findall(t) for t in texts]
        new = {}
        for r in set(chain.from_iterable(cut)):
            if r not in known:
                old = older.get(r)
                if old is None:
                    new[r] = self.split.findall(r)
                else:
                    known[r] = old
        pieces = list(set(chain.from_iterable(new.values())))
        data = [p.encode() for p in pieces]
        short = [n for n, b in enumerate(data) if len(b) <= SHORT]
        ids = dict(zip([pieces[n] for n in short], self.merge_many([data[n] for n in short])))
        ids.update((p, "".join(map(chr, self.merge(b)))) for p, b in zip(pieces, data) if len(b) > SHORT)
        for r, found in new.items():
            known[r] = "".join([ids[p] for p in found])
        out = [_numbers("".join([known[r] for r in found])) for found in cut]
        for r in new:
            if len(r) > SHORT:
                del known[r]
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _chars(ids: np.ndarray) -> str:
    return ids.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _numbers(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file (base64 token, space, id per line)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    return Encoder(ranks, pattern)


def tokenize(docs: DataFrame, path: str, pattern: str, text: str = "text", with_ids: bool = False,
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_tokens, ids_sha256, decoded_sha256 and, if asked, token_ids.

    ``path`` must be readable on every executor (the vocabulary is installed
    there like the library itself).
    """
    fields = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    fields += [("token_ids", "array<int>")] if with_ids else []

    def make(texts):
        encoder = load(path, pattern)
        counts, digests, decoded, kept = [], [], [], []
        for found in encoder.encode_all([batches.text(raw) for raw in texts]):
            ids = found.tolist()
            counts.append(len(ids))
            digests.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            if with_ids:
                kept.append(found.astype(np.int32))
        return [counts, digests, decoded, *([kept] if with_ids else [])]

    return batches.append(docs, fields, make, [text], keep)
