"""Reading a SentencePiece model file and the tables that encoding needs.

Only public fields of the file format are read: the pieces (text, score, type), the model
type, and the normaliser's flags.  Models with a character map or whitespace removal are
refused, as their normalisation is not built here.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_NONE = np.int64(1 << 40)               # rank of "no piece"
_TOP = np.uint64(64 - 20)
_BASES = (0x100000001B3, 0x9E3779B97F4A7C15)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(number, value) of a protocol buffer message; submessages and texts as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at:at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at:at + n], at + n
        else:
            raise ValueError("not a SentencePiece model")
        yield tag >> 3, value


def bpe(text: str, rank: dict[str, int]) -> list[str]:
    """Merge the adjacent pair whose union is the best piece, leftmost first, until none is."""
    parts = list(text)
    while len(parts) > 1:
        best = min(((rank.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best[0] >= 1 << 40:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Prefix hashes of equally long rows of code points, one table per base."""
    out = []
    for base in _BASES:
        h = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
        for j in range(codes.shape[1]):
            h[:, j + 1] = h[:, j] * np.uint64(base) + codes[:, j] + np.uint64(1)
        out.append(h)
    return out


@dataclass
class PieceModel:
    """Pieces and lookup tables.  ``keys`` are the sorted hashes of the piece texts."""

    texts: list[str]
    scores: np.ndarray
    types: list[int]
    kind: int
    dummy_prefix: bool
    byte_fallback: bool
    keys: np.ndarray = field(default=None)
    check: np.ndarray = field(default=None)
    ids: np.ndarray = field(default=None)
    maybe: np.ndarray = field(default=None)      # by the top bits of a hash: may it be a key
    longest: int = 0
    left: np.ndarray = field(default=None)       # last merge of each piece (BPE)
    right: np.ndarray = field(default=None)
    rank: np.ndarray = field(default=None)       # when a piece is formed; -1: a character
    whole: np.ndarray = field(default=None)      # the piece encodes to itself
    pair_keys: np.ndarray = field(default=None)  # left * V + right of every union of pieces
    pair_rank: np.ndarray = field(default=None)

    @classmethod
    def parse(cls, data: bytes) -> "PieceModel":
        texts, scores, types, kind, flags = [], [], [], UNIGRAM, {}
        fallback = False
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                texts.append(own[1].decode("utf-8"))
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                types.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(_fields(value))
                kind, fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif number == 3:
                flags = dict(_fields(value))
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if flags.get(2) or flags.get(4, 1) or not flags.get(5, 1) or USER in types:
            raise ValueError("models with a character map, whitespace removal or user pieces are not supported")
        model = cls(texts, np.array(scores), types, kind, bool(flags.get(3, 1)), fallback)
        model._build()
        return model

    def _build(self) -> None:
        normal = [i for i, t in enumerate(self.types) if t == NORMAL]
        by_length: dict[int, list[int]] = {}
        for i in normal:
            by_length.setdefault(len(self.texts[i]), []).append(i)
        self.longest = max(by_length)
        keys, check, ids = [], [], []
        for n, own in by_length.items():
            codes = np.array([[ord(c) for c in self.texts[i]] for i in own], dtype=np.uint64).reshape(-1, n)
            a, b = hashes(codes)
            keys.append(a[:, n])
            check.append(b[:, n])
            ids += own
        keys, check, ids = np.concatenate(keys), np.concatenate(check), np.array(ids)
        order = np.argsort(keys, kind="stable")
        self.keys, self.check, self.ids = keys[order], check[order], ids[order].astype(np.int32)
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.keys >> _TOP] = True
        if self.kind == BPE:
            self._build_merges(normal)

    def _build_merges(self, normal: list[int]) -> None:
        """Formation of every piece.  Pieces of spaces only share one score in some models;
        they are not merged here but read greedily (see the encoder)."""
        v = len(self.texts)
        order = sorted((i for i in normal if len(self.texts[i]) > 1 and set(self.texts[i]) != {SPACE}),
                       key=lambda i: -self.scores[i])
        if any(self.scores[a] == self.scores[b] for a, b in zip(order, order[1:])):
            raise ValueError("pieces of equal score")
        rank = {self.texts[i]: r for r, i in enumerate(order)}
        of = {self.texts[i]: i for i in normal}
        self.rank = np.full(v, -1, dtype=np.int64)
        self.left = np.full(v, -1, dtype=np.int32)
        self.right = np.full(v, -1, dtype=np.int32)
        self.whole = np.zeros(v, dtype=bool)
        pairs = []
        for i in normal:
            if len(self.texts[i]) == 1:
                self.whole[i] = True
        for r, i in enumerate(order):
            text = self.texts[i]
            self.rank[i] = r
            for cut in range(1, len(text)):
                a, b = of.get(text[:cut]), of.get(text[cut:])
                if a is not None and b is not None:
                    pairs.append((a * v + b, r))
            # its parts are formed earlier: without it the text ends in the two of them
            below = _Below(rank, r)
            parts = bpe(text, below)
            if len(parts) == 2 and parts[0] in of and parts[1] in of:
                self.left[i], self.right[i], self.whole[i] = of[parts[0]], of[parts[1]], True
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.pair_rank = np.array([r for _, r in pairs], dtype=np.int64)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Piece ids of span hashes, -1 where there is none."""
        out = np.full(len(key), -1, dtype=np.int32)
        asked = np.flatnonzero(self.maybe[key >> _TOP])       # spares most spans the search
        k = key[asked]
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        out[asked] = np.where((self.keys[at] == k) & (self.check[at] == check[asked]), self.ids[at], -1)
        return out

    def union_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(len(a), _NONE)
        key = a.astype(np.int64) * len(self.texts) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], _NONE)

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the texts of a and b together would end in just a and b.

        The neighbours at the border, from last to first formed: whenever two of them stood
        side by side, their union must not have come before the next step of either."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_next = np.full(len(x), _NONE)
        y_next = np.full(len(x), _NONE)
        good = np.ones(len(x), dtype=bool)
        live = np.arange(len(x))
        while len(live):
            u = self.union_rank(x[live], y[live])
            bad = (u < x_next[live]) & (u <= y_next[live]) & (u < _NONE)
            good[live[bad]] = False
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            undo_x = go & (rx > ry)
            undo_y = go & ~undo_x
            i, j = live[undo_x], live[undo_y]
            x_next[i], x[i] = self.rank[x[i]], self.right[x[i]]
            y_next[j], y[j] = self.rank[y[j]], self.left[y[j]]
            live = live[go]
        return good


class _Below(dict):
    """Ranks below a limit (a view for :func:`bpe`)."""

    def __init__(self, rank, limit):
        self.of, self.limit = rank, limit

    def get(self, text, default=None):
        r = self.of.get(text, default)
        return r if r < self.limit else default
