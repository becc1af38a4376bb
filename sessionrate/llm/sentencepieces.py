"""Operator 10: SentencePiece encoding and decoding by a batched Viterbi pass.

A text is escaped (spaces become U+2581, one in front) and cut into words where no piece
can reach across: before a run of spaces, and around characters that occur in no longer
piece.  Equally long words advance together, position by position: the hashes of all spans
that end there probe the sorted piece keys, the best admissible piece of each word is kept
as a backpointer, and the pieces are read back from the end.

* Unigram models: admissible is every piece, best is the largest sum of scores.
* BPE models (as the public 32k vocabulary): the largest sum of scores is not what the
  model's merges give, so the same pass keeps, of the pieces that end at a position, the
  one that may follow its predecessor: two neighbouring pieces must stay apart when their
  texts are merged by rank.  Exactly one piece per position does (an encoding is right
  exactly if each two neighbours are), so the result equals the library's.

Runs of spaces beside a word's own are read greedily (their pieces share one score, and
the library merges them from the left).  Characters without a piece become bytes.

Decoding joins the pieces, turns U+2581 into spaces and drops the one in front.

Defined cases: NULL text has NULL ids, empty text none; a text of any length is encoded
whole (a word without a break of any length too, span by span); repeated rows get equal
ids; extra columns are carried, those named like an output column are replaced; no
documents give no rows.  One map step; the model's tables go to the tasks with the plan.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame

from sessionrate.llm.common import map_text
from sessionrate.llm.piece_model import (BPE, BYTE, CONTROL, SPACE, UNKNOWN, PieceModel, _BASES,
                                         hashes)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CACHE_WORDS = 500_000      # distinct words a Python worker keeps (about 200 bytes each)
ROWS = 4096                # words that advance together
CELLS = 1 << 20            # spans looked up at once, at most
LONG = 512                 # longer words advance alone, in plain Python
_PAIR_BITS = 22            # slots of the table of pairs already compared
_NO_PIECE = -2             # backpointer: a character without a piece


class Encoder:
    def __init__(self, model: PieceModel):
        self.model = model
        texts = model.texts
        joined = {c for t, kind in zip(texts, model.types) if kind == 1 and len(t) > 1 for c in t} - {SPACE}
        inner = "".join(map(re.escape, sorted(joined)))
        self.cut = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|." if inner else f"{SPACE}+|.", re.S)
        crossing = any(SPACE in t.lstrip(SPACE) for t, kind in zip(texts, model.types) if kind == 1)
        if crossing:
            raise ValueError("pieces across words are not supported")
        self.of = {t: i for i, t in enumerate(texts) if model.types[i] == 1}
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(texts) if model.types[i] == BYTE}
        self.unknown = next((i for i, k in enumerate(model.types) if k == UNKNOWN), 0)
        self.spaces = sorted((len(t) for t in self.of if set(t) == {SPACE}), reverse=True)
        self.raw = [self._raw(i) for i in range(len(texts))]
        self._clear()
        self.pair_key = np.full(1 << _PAIR_BITS, -1, dtype=np.int64)
        self.pair_good = np.zeros(1 << _PAIR_BITS, dtype=bool)

    def _clear(self) -> None:
        """No words: row of each word, and per row its ids' place in one array."""
        self.rows: dict[str, int] = {}
        self.start, self.size = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
        self.flat, self.used = np.zeros(4096, dtype=np.int32), 0

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add words with their ids (one after another) and numbers of ids."""
        first, last, end = len(self.rows), len(self.rows) + len(words), self.used + len(ids)
        if last > len(self.start):
            self.start, self.size = (np.resize(x, max(last, 2 * len(x))) for x in (self.start, self.size))
        if end > len(self.flat):
            self.flat = np.resize(self.flat, max(end, 2 * len(self.flat)))
        self.start[first:last] = self.used + np.cumsum(sizes) - sizes
        self.size[first:last] = sizes
        self.flat[self.used:end] = ids
        self.used = end
        self.rows.update(zip(words, range(first, last)))

    def _ids_of(self, word: str) -> list[int]:
        r = self.rows[word]
        return self.flat[self.start[r]:self.start[r] + self.size[r]].tolist()

    def _raw(self, i: int) -> bytes:
        kind, text = self.model.types[i], self.model.texts[i]
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else text.replace(SPACE, " ").encode()

    # ---------------------------------------------------------------- words
    def _no_piece(self, char: str) -> list[int]:
        if self.model.byte_fallback and self.byte:
            return [self.byte[b] for b in char.encode("utf-8", "replace")]
        return [self.unknown]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``model.stay_apart`` through a table of pairs seen before."""
        key = a.astype(np.int64) * len(self.model.texts) + b
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        out = self.pair_good[slot]
        new = np.flatnonzero(self.pair_key[slot] != key)
        if len(new):
            keys, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            good = self.model.stay_apart(a[new][first], b[new][first])
            out[new] = good[back]
            self.pair_key[slot[new][first]] = keys
            self.pair_good[slot[new][first]] = good
        return out

    def _advance(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of equally long words: one pass over the positions, then read back."""
        m, n, rows = self.model, len(words[0]), len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = codes.reshape(rows, n).astype(np.uint64)
        first, second = hashes(codes)
        # spans[length][:, i]: the piece that the span [i, i + length) of each word is, or -1
        spans, some = {}, {}
        for length in range(1, min(m.longest, n) + 1):
            f, s = (h[:, length:] - h[:, :-length] * np.uint64(pow(base, length, 1 << 64))
                    for h, base in zip((first, second), _BASES))
            p = m.find(f.ravel(), s.ravel())
            if m.kind == BPE:
                p[~m.whole[p]] = -1
            spans[length] = p.reshape(f.shape)
            some[length] = (spans[length] >= 0).any(axis=0)
        piece = np.full((rows, n + 1), -1, dtype=np.int32)      # backpointers: piece that ends here
        size = np.zeros((rows, n + 1), dtype=np.int32)          # ... and its length
        if m.kind == BPE:
            self._followers(n, spans, some, piece, size)
        else:
            self._best_sums(n, spans, some, piece, size)
        return self._read_back(words, piece, size)

    def _followers(self, n, spans, some, piece, size) -> None:
        """At every position the one piece that may follow its predecessor."""
        for j in range(1, n + 1):
            left = np.arange(len(piece))                        # words still without a piece here
            for length in range(min(self.model.longest, j), 0, -1):
                i = j - length
                if not some[length][i]:
                    continue
                p = spans[length][left, i]
                hit = np.flatnonzero(p >= 0)
                if i and len(hit):
                    before, after = piece[left[hit], i], p[hit]
                    ok = before == _NO_PIECE
                    asked = np.flatnonzero(~ok)
                    ok[asked] = self._apart(before[asked], after[asked])
                    hit = hit[ok]
                if len(hit):
                    got = left[hit]
                    piece[got, j], size[got, j] = p[hit], length
                    left = np.delete(left, hit)
                    if not len(left):
                        break
            piece[left, j], size[left, j] = _NO_PIECE, 1

    def _best_sums(self, n, spans, some, piece, size) -> None:
        """At every position the piece of the largest sum of scores."""
        m = self.model
        best = np.full(piece.shape, -np.inf)
        best[:, 0] = 0.0
        lone = float(m.scores.min()) - 10.0                     # a character without a piece
        for j in range(1, n + 1):
            alone = np.where(spans[1][:, j - 1] < 0, best[:, j - 1] + lone, -np.inf)
            best[:, j], size[:, j], piece[:, j] = alone, 1, _NO_PIECE
            for length in range(1, min(m.longest, j) + 1):
                if some[length][j - length]:
                    p = spans[length][:, j - length]
                    score = np.where(p >= 0, best[:, j - length] + m.scores[p], -np.inf)
                    better = score > best[:, j]
                    best[better, j], size[better, j], piece[better, j] = score[better], length, p[better]

    def _read_back(self, words, piece, size) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and how many each has."""
        n = len(words[0])
        at = np.full(len(words), n)
        live = np.arange(len(words))
        of, begin, ids = [], [], []
        while len(live):
            end = at[live]
            ids.append(piece[live, end])
            at[live] = end - size[live, end]
            of.append(live)
            begin.append(at[live])
            live = live[at[live] > 0]
        of, begin, ids = map(np.concatenate, (of, begin, ids))
        order = np.argsort(of * (n + 1) + begin)
        of, begin, ids = of[order], begin[order], ids[order]
        lone = np.flatnonzero(ids == _NO_PIECE)
        if len(lone):
            instead = [self._no_piece(words[w][i]) for w, i in zip(of[lone].tolist(), begin[lone].tolist())]
            times = np.ones(len(ids), dtype=np.int64)
            times[lone] = [len(x) for x in instead]
            of, ids = np.repeat(of, times), np.repeat(ids, times)
            ids[ids == _NO_PIECE] = [i for x in instead for i in x]
        return ids, np.bincount(of, minlength=len(words))

    def _alone(self, word: str) -> list[int]:
        """The same pass over one long word, a position at a time."""
        m, n = self.model, len(word)
        piece, size, best = [-1] * (n + 1), [0] * (n + 1), [0.0] + [float("-inf")] * n
        floor = float(m.scores.min()) - 10.0
        apart: dict[tuple, bool] = {}
        for j in range(1, n + 1):
            for length in range(min(m.longest, j), 0, -1):
                i = j - length
                p = self.of.get(word[i:j], -1)
                if p < 0:
                    continue
                if m.kind != BPE:
                    if best[i] + m.scores[p] > best[j]:
                        best[j], piece[j], size[j] = best[i] + m.scores[p], p, length
                    continue
                if not m.whole[p]:
                    continue
                if i and piece[i] >= 0:
                    pair = (piece[i], p)
                    if pair not in apart:
                        apart[pair] = bool(m.stay_apart(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if not apart[pair]:
                        continue
                piece[j], size[j] = p, length
                break
            if piece[j] == -1 or (m.kind != BPE and word[j - 1] not in self.of and best[j - 1] + floor >= best[j]):
                best[j], piece[j], size[j] = best[j - 1] + floor, _NO_PIECE, 1
        ids, at = [], n
        while at:
            ids += [piece[at]] if piece[at] >= 0 else self._no_piece(word[at - 1])[::-1]
            at -= size[at]
        return ids[::-1]

    def _run_of_spaces(self, n: int) -> list[int]:
        out = []
        while n:
            k = next((k for k in self.spaces if k <= n), 0)
            if not k:
                return out + self._no_piece(SPACE) * n
            out.append(self.of[SPACE * k])
            n -= k
        return out

    def _learn(self, fresh: list[str]) -> None:
        """Encode words (at most one space in front) and keep them."""
        by_length: dict[int, list[str]] = {}
        for w in fresh:
            by_length.setdefault(len(w), []).append(w)
        for n, words in by_length.items():
            if n > LONG:
                for w in words:
                    ids = self._alone(w)
                    self._keep([w], np.array(ids, dtype=np.int32), np.array([len(ids)]))
                continue
            step = max(1, min(ROWS, CELLS // (n * self.model.longest)))
            for i in range(0, len(words), step):
                self._keep(words[i:i + step], *self._advance(words[i:i + step]))

    def _spaced(self, word: str) -> list[int]:
        """A word with more than one space in front, or spaces alone."""
        text = word.lstrip(SPACE)
        n = len(word) - len(text)
        if not text:
            return self._run_of_spaces(n)
        own = self._ids_of(SPACE + text)
        if own[0] == self.of.get(SPACE):       # the word does not take its space
            return self._run_of_spaces(n) + own[1:]
        return self._run_of_spaces(n - 1) + own

    # ---------------------------------------------------------------- texts
    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the offsets between them (a missing
        text has none)."""
        front = SPACE if self.model.dummy_prefix else ""
        cut = [self.cut.findall(front + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = list(chain.from_iterable(cut))
        if len(self.rows) > CACHE_WORDS:
            self._clear()
        row = np.fromiter(map(self.rows.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(row < 0)
        if len(new):
            fresh = {words[i] for i in new.tolist()}
            double = {w for w in fresh if w.startswith(SPACE * 2) or w == SPACE}
            need = {SPACE + w.lstrip(SPACE) for w in double} - {SPACE}
            self._learn(sorted(((fresh - double) | need) - self.rows.keys()))
            for w in sorted(double):
                ids = self._spaced(w)
                self._keep([w], np.array(ids, dtype=np.int32), np.array([len(ids)]))
            row[new] = [self.rows[words[i]] for i in new.tolist()]
        sizes = self.size[row]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.start[row] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)])]

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        ids, ends = self.encode_flat(texts)
        return [None if t is None else ids[a:b] for t, a, b in zip(texts, ends[:-1], ends[1:])]

    def decode(self, ids) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        if self.model.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_ENCODERS: dict[bytes, Encoder] = {}       # of this Python process, by model


def encoder(data: bytes) -> Encoder:
    """The process's encoder for a model file's bytes."""
    if data not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[data] = Encoder(PieceModel.parse(data))
    return _ENCODERS[data]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def with_ids(docs: DataFrame, data: bytes, text: str = "text", check: bool = False,
             drop: tuple = ()) -> DataFrame:
    """Add ``ids`` and ``n_ids``; with ``check`` also ``round_trip``: whether decoding the
    ids gives the text back (U+2581 of the text itself reads back as a space)."""
    def run(texts):
        import pyarrow as pa

        enc = encoder(data)
        ids, ends = enc.encode_flat(texts)
        missing = np.array([t is None for t in texts])
        out = {"ids": pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(ids, type=pa.int32()),
                                               mask=pa.array(missing)),
               "n_ids": pa.array(np.diff(ends), mask=missing)}
        if check:
            out["round_trip"] = [None if t is None else enc.decode(ids[a:b].tolist()) == t.replace(SPACE, " ")
                                 for t, a, b in zip(texts, ends[:-1], ends[1:])]
        return out

    fields = "ids array<int>, n_ids long" + (", round_trip boolean" if check else "")
    return map_text(docs, run, fields, text, drop=drop)


def decoded(df: DataFrame, data: bytes, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the column ``ids``."""
    return map_text(df, lambda rows: {"decoded": [None if x is None else encoder(data).decode(x) for x in rows]},
                    "decoded string", ids)
