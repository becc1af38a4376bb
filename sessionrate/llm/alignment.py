"""Operator 11: cross-tokenizer alignment by pointer jumping.

A text is encoded twice: with a space in front by a byte-level BPE (A), and by a
SentencePiece model, which adds that space itself (B).  Both token sequences cover the same
bytes, so they fall apart into the smallest groups of tokens that end together:

1. Every token points to the token of the other sequence that holds its last byte, which of
   all tokens that overlap it reaches farthest right; a B token that ends together with that
   one points to itself.
2. Successors are doubled (``succ = succ[succ]``) for all tokens of all texts of a batch at once
   until nothing changes: a token then points to the last token of its group, whose rank labels
   the group.

A link is a pair of an A and a B occurrence in one group.  Spark counts in how many documents
each pair of ids is linked, and gives every document back the counts of its links:

* A document's row holds its distinct id pairs and how often each occurs; those rows are
  written once, and the pairs counted with map-side sums.
* Pairs in more than 1/``FREQUENT`` of all rows of pairs are fewer than FREQUENT, whatever the
  input; this table is sent to the tasks, which sum over such pairs row by row.  Only
  the rows of other pairs are shuffled, to the counts.  The highest count of an A id is one
  row per id of the vocabulary.

The ids of A are those of its own file.  Texts of characters whose classes are the same in
all Unicode versions are encoded by a second library built from that file's vocabulary (same
ids, less time, tested); others, and texts with very long words, by the file's own one.

Defined cases: NULL and empty texts, and texts whose tokens do not give back their bytes (a
model that normalises, U+2581 in the text), have no tokens: zeros, and '' for the column of
groups.  Repeated rows are documents of their own; extra columns are ignored (or carried by
:func:`with_groups`); an empty table gives no rows.  A text is encoded whole, so its task
holds memory in proportion to its length and to its distinct links.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionrate.llm.common import map_text, materialize

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 100_000
CHARS = 1_000_000          # characters aligned at once (or one longer text)
_SMALL = 4096              # links of a group that are listed one by one
# the classes of the split pattern differ between Unicode versions outside these
_OTHER = re.compile("[^\x00-\x1b\x20-ɏ‐-‧‰-⁞₠-₵]|\\S{2000}|\\s{2000}")
# fixed value: the split pattern of byte-level BPE files that name none of their own
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable bytes stand for themselves, the
    others for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both encoders and the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        import tiktoken

        self.a_json = a.decode("utf-8")
        spec = json.loads(self.a_json)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        of = _byte_of()
        plain = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        ranks = {bytes(of[c] for c in t): i for t, i in plain.items()}
        self.a_bytes = [b""] * (1 + max([*plain.values(), *special.values()]))
        for t, i in ranks.items():
            self.a_bytes[i] = t
        for t, i in special.items():
            self.a_bytes[i] = t.encode("utf-8")
        self.fast = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = p = sentencepiece.SentencePieceProcessor(model_proto=b)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.b_bytes = [bytes([int(t[3:5], 16)]) if p.is_byte(i) else t.replace("▁", " ").encode("utf-8")
                        for i, t in enumerate(names)]
        self.a_size, self.b_size = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        top = max(len(self.a_bytes), len(self.b_bytes))
        # decimal ids, each followed by one of three separators
        self.decimal = [b"%d%c" % (i, s) for s in b",|;" for i in range(top)]
        self.top = top

    @functools.cached_property
    def full(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_str(self.a_json)
        out.encode_special_tokens = True
        return out

    def encode_a(self, text: str) -> np.ndarray:
        if _OTHER.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return np.array(self.fast.encode_ordinary(text), dtype=np.int64)

    def encode(self, texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text; none where they do not give back the text's bytes."""
        none = np.empty(0, dtype=np.int64)
        out = []
        for text, b in zip(texts, self.pieces.encode([t or "" for t in texts], num_threads=1)):
            a, b, data = none, np.array(b, dtype=np.int64), b""
            if text:
                a, data = self.encode_a(" " + text), (" " + text).encode("utf-8")
            same = data and all(b"".join(map(of.__getitem__, ids.tolist())) == data
                                for of, ids in ((self.a_bytes, a), (self.b_bytes, b)))
            out.append((a, b) if same else (none, none))
        return out


@functools.lru_cache(maxsize=2)
def tokenizers(a: bytes, b: bytes) -> Tokenizers:
    """Built once per Python worker."""
    return Tokenizers(a, b)


def read_files(a: str = A_FILE, b: str = B_FILE) -> tuple[bytes, bytes]:
    """The two vocabulary files, read by the driver; they travel with the plan."""
    with open(a, "rb") as fa, open(b, "rb") as fb:
        return fa.read(), fb.read()


# ------------------------------------------------------------------- alignment
def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The B token that ends the group of each A and of each B token.

    Ends are byte offsets, rising; both end at the same byte."""
    n = len(end_a)
    to_b = n + np.searchsorted(end_b, end_a)           # holds the last byte of the A token
    to_a = np.searchsorted(end_a, end_b)
    own = n + np.arange(len(end_b))
    succ = np.concatenate([to_b, np.where(end_a[to_a] > end_b, to_a, own) if n else own])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ[:n] - n, succ[n:] - n
        succ = further


@dataclass
class Aligned:
    """Tokens of several texts, one after another, with their groups."""
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray            # rising
    group_b: np.ndarray
    n_a: np.ndarray                # per group
    n_b: np.ndarray
    text: np.ndarray               # of each group
    texts: int


def align(tk: Tokenizers, texts: list) -> Aligned:
    pairs = tk.encode(texts)
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, dtype=np.int64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, dtype=np.int64)
    of_b = np.repeat(np.arange(len(pairs)), [len(p[1]) for p in pairs])
    # texts lie one after another on one axis of bytes: each ends a group
    last_a, last_b = terminals(np.cumsum(tk.a_size[a]), np.cumsum(tk.b_size[b]))
    ends = last_b == np.arange(len(b))
    rank = np.cumsum(ends) - 1
    group_a, group_b, groups = rank[last_a], rank[last_b], int(ends.sum())
    return Aligned(a, b, group_a, group_b, np.bincount(group_a, minlength=groups),
                   np.bincount(group_b, minlength=groups), of_b[ends], len(texts))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Exact sums between bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _per_text(x: Aligned, of_group: np.ndarray) -> np.ndarray:
    return _sums(of_group, np.searchsorted(x.text, np.arange(x.texts + 1)))


def written(x: Aligned, tk: Tokenizers) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` per text."""
    before_a = np.concatenate([[0], np.cumsum(x.n_a)])
    before_b = np.concatenate([[0], np.cumsum(x.n_b)])
    codes = np.empty(len(x.a) + len(x.b), dtype=np.int64)
    at, last = np.arange(len(x.a)), before_a[1:] - 1
    sep = np.zeros(len(x.a), dtype=np.int64)
    sep[last] = 1
    codes[at + before_b[x.group_a]] = x.a + sep * tk.top
    at, last = np.arange(len(x.b)), before_b[1:] - 1
    sep = np.zeros(len(x.b), dtype=np.int64)
    sep[last] = 2
    codes[at + before_a[1:][x.group_b]] = x.b + sep * tk.top
    bounds = np.concatenate([[0], np.cumsum(_per_text(x, x.n_a + x.n_b))]).tolist()
    show = tk.decimal.__getitem__
    return [b"".join(map(show, codes[i:j].tolist()))[:-1] for i, j in zip(bounds, bounds[1:])]


def links(x: Aligned, tk: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs per text: (text, a, b, how often), in order."""
    first_a = np.cumsum(x.n_a) - x.n_a
    first_b = np.cumsum(x.n_b) - x.n_b
    n = x.n_a * x.n_b
    width = len(tk.b_bytes)
    per_text = len(tk.a_bytes) * width
    small = np.flatnonzero(n <= _SMALL)
    group = np.repeat(small, n[small])
    at = np.arange(len(group)) - np.repeat(np.cumsum(n[small]) - n[small], n[small])
    a = x.a[first_a[group] + at // x.n_b[group]]
    b = x.b[first_b[group] + at % x.n_b[group]]
    keys, times = [x.text[group] * per_text + a * width + b], [np.ones(len(group), dtype=np.int64)]
    for g in np.flatnonzero(n > _SMALL):               # distinct ids first
        a, na = np.unique(x.a[first_a[g]:first_a[g] + x.n_a[g]], return_counts=True)
        b, nb = np.unique(x.b[first_b[g]:first_b[g] + x.n_b[g]], return_counts=True)
        keys.append((x.text[g] * per_text + a[:, None] * width + b).ravel())
        times.append((na[:, None] * nb).ravel())
    key, often = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, often = key[order], often[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    often = _sums(often, np.append(starts, len(key)))
    key = key[starts]
    return key // per_text, key % per_text // width, key % width, often


def _slices(texts: list):
    start = total = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if total and total + n > CHARS:
            yield texts[start:i]
            start, total = i, 0
        total += n
    if texts:
        yield texts[start:]


def _lists(values: np.ndarray, sizes: np.ndarray, kind):
    import pyarrow as pa

    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(values, type=kind))


# ---------------------------------------------------------------- Spark jobs
def with_groups(docs: DataFrame, text: str = "text", files: tuple[bytes, bytes] | None = None) -> DataFrame:
    """Add a_ids, b_ids and a_groups, b_groups (each token's group, from 0): the alignment itself."""
    files = files or read_files()

    def run(texts):
        import pyarrow as pa

        tk, out = tokenizers(*files), {k: [] for k in ("a_ids", "b_ids", "a_groups", "b_groups")}
        for part in _slices(texts):
            x = align(tk, part)
            first = np.searchsorted(x.text, np.arange(x.texts + 1))[:-1]
            na, nb = _per_text(x, x.n_a), _per_text(x, x.n_b)
            out["a_ids"].append(_lists(x.a, na, pa.int32()))
            out["b_ids"].append(_lists(x.b, nb, pa.int32()))
            out["a_groups"].append(_lists(x.group_a - np.repeat(first, na), na, pa.int32()))
            out["b_groups"].append(_lists(x.group_b - np.repeat(first, nb), nb, pa.int32()))
        return {k: pa.concat_arrays(v) if v else [] for k, v in out.items()}

    return map_text(docs, run, "a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>", text)


_FIELDS = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "a array<int>, b array<int>, times array<long>")


def digests(docs: DataFrame, text: str = "text", files: tuple[bytes, bytes] | None = None, drop: tuple = ()) -> DataFrame:
    """Counts, the digest of the groups, and the distinct linked id pairs (a, b, times) per text."""
    files = files or read_files()

    def run(texts):
        import pyarrow as pa

        tk, out = tokenizers(*files), {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times")}
        for part in _slices(texts):
            x = align(tk, part)
            for name, of_group in (("n_a", x.n_a), ("n_b", x.n_b), ("n_groups", np.ones(len(x.n_a), dtype=np.int64)),
                                   ("n_links", x.n_a * x.n_b)):
                out[name].append(pa.array(_per_text(x, of_group), type=pa.int64()))
            shown = [hashlib.sha256(s).hexdigest() if s else "" for s in written(x, tk)]
            out["groups_sha256"].append(pa.array(shown, type=pa.string()))
            of, a, b, times = links(x, tk)
            sizes = np.bincount(of, minlength=x.texts)
            for name, values, kind in (("a", a, pa.int32()), ("b", b, pa.int32()), ("times", times, pa.int64())):
                out[name].append(_lists(values, sizes, kind))
        return {k: pa.concat_arrays(v) if v else [] for k, v in out.items()}

    return map_text(docs, run, _FIELDS, text, drop=drop)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n): in how many rows each id pair is linked."""
    pairs = rows.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _with_frequent(rows: DataFrame, frequent) -> DataFrame:
    """Sums over the pairs of the frequent table; other pairs stay in a, b, times."""
    keys = frequent["a"].to_numpy(dtype=np.int64) << 32 | frequent["b"].to_numpy(dtype=np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    counts, best = frequent["n"].to_numpy(dtype=np.int64)[order], frequent["best"].to_numpy(dtype=bool)[order]
    kept = [c for c in rows.columns if c not in ("a", "b", "times")]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b, times = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "times"))
            bounds = np.concatenate([[0], np.cumsum(a.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            a, b, times = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b, times))
            key = a << 32 | b
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)
            n = counts[at] * hit if len(keys) else np.zeros(len(key), dtype=np.int64)
            top = best[at] & hit if len(keys) else hit
            rest = _sums(~hit, bounds)
            cols = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            cols += [pa.array(_sums(times * top, bounds)), pa.array(_sums(times * n, bounds)),
                     *(_lists(x[~hit], rest, k) for x, k in ((a, pa.int32()), (b, pa.int32()), (times, pa.int64())))]
            yield pa.RecordBatch.from_arrays(cols, [*kept, "best_part", "sum_part", "a", "b", "times"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, f"{kinds}, best_part long, sum_part long, a array<int>, b array<int>, times array<long>")


def score_links(docs: DataFrame, key: str = "doc_id", text: str = "text", files: tuple[bytes, bytes] | None = None) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = digests(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", files, drop=("_text",))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    counts = materialize(pair_counts(rows), "alignment-counts")
    # one row per id of A's vocabulary
    most = F.broadcast(counts.groupBy(F.col("a").alias("_a")).agg(F.max("n").alias("most")))
    counts = counts.join(most, F.col("a") == F.col("_a")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    often = F.col("n") * FREQUENT > F.lit(total)       # fewer than FREQUENT rows
    rows = materialize(_with_frequent(rows, counts.filter(often).toPandas()), "alignment-sums")
    rare = rows.filter(F.size("a") > 0).select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p"))
    more = (rare.select("row", "p.*").join(counts.filter(~often), ["a", "b"])
                .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rest"),
                                    F.sum(F.col("times") * F.col("n")).alias("sum_rest")))
    whole = rows.drop("a", "b", "times").join(more, "row", "left")
    add = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0)))
    return whole.select(F.col("_key").alias(key), "n_a", "n_b", "n_groups", "n_links",
                        add("best_part", "best_rest").alias("n_best"), add("sum_part", "sum_rest").alias("count_sum"),
                        "groups_sha256")
