"""Operator 4: Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (each the shortest piece not yet in the
dictionary), the phrases are hashed, and the ``K`` smallest hashes of the phrase set are
its signature.  The likeness of two signatures is the share of common phrases among the
``K`` smallest of both sets, an estimate of the Jaccard likeness of the dictionaries: texts
that compress well together have like dictionaries.

:func:`with_fingerprint` is one map step.  :func:`edited_likeness` compares every document
with its edited text (the second half replaced by the beginning of the next document) and
with the next document.  It sorts by one range shuffle of the texts; each task walks its
range and parses the half that a text and its edited text share once.  The one row per
range whose next document lies in another range is completed afterwards, from the first
row of the next range that has any: two rows per task.

Defined cases: NULL text is the empty text; an empty text has the empty signature, like
only to another empty one; equal texts have equal fingerprints; of equal ids the order is
that of a text hash; a NULL id comes last; a single document is its own next; a text of
any length is parsed whole, in one pass; extra columns are ignored or (map step) carried;
no documents give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_schema

from sessionrate.llm.common import map_text, materialize

K = 64
CHUNK = 100_000          # phrases hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = []        # powers of the base and of its inverse, grown on demand


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, b, dtype=np.uint64))])
                      for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def parse(text: str, seen: set, start: int = 0, at: int = 0) -> tuple[list[int], int]:
    """Continue the parse of ``text`` from position ``at`` with the dictionary ``seen``
    and an open phrase that began at ``start``.  Returns the ends of the phrases found
    and where the open phrase begins."""
    ends = []
    add, ends_append = seen.add, ends.append
    for i in range(at + 1, len(text) + 1):
        phrase = text[start:i]
        if phrase not in seen:
            add(phrase)
            ends_append(i)
            start = i
    return ends, start


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def signature(points: np.ndarray, ends: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest 32-bit hashes of the phrases of a text that end at ``ends``."""
    if len(ends) > CHUNK:                       # a long text: piece by piece, in bounded memory
        out, begin = np.zeros(0, dtype=np.uint32), 0
        for i in range(0, len(ends), CHUNK):
            part = ends[i:i + CHUNK]
            out = np.unique(np.concatenate([out, signature(points[begin:part[-1]], part - begin, k)]))[:k]
            begin = part[-1]
        return out
    if not len(ends):
        return np.zeros(0, dtype=np.uint32)
    up, down = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:len(points)], out=sums[1:])
    starts = np.concatenate([[0], ends[:-1]])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (_mix(h + (ends - starts).astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    if len(h) > 4 * k:
        h = np.partition(h, 2 * k)[:2 * k]          # room for equal hashes
        small = np.unique(h)
        if len(small) >= k:
            return small[:k]
    return np.unique(h)[:k]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness of two phrase sets from their signatures."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.sort(np.concatenate([a, b]))
    again = both[1:] == both[:-1]
    first = np.concatenate([[True], ~again])
    union = both[first][:k]
    common = both[1:][again]
    return float(np.searchsorted(common, union[-1], side="right") / len(union))


def fingerprint(text: str | None) -> np.ndarray:
    text = text or ""
    ends, _ = parse(text, set())
    return signature(_points(text), np.array(ends, dtype=np.int64))


def _hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint``: the signature as hex, 8 digits a hash, ascending."""
    return map_text(docs, lambda ts: {"fingerprint": [_hex(fingerprint(t)) for t in ts]},
                    "fingerprint string", text)


def likeness_of(a: str | None, b: str | None) -> float:
    """Likeness of two fingerprints in hex."""
    x, y = (np.frombuffer(bytes.fromhex(s or ""), dtype=">u4").astype(np.uint32) for s in (a, b))
    return likeness(x, y)


# ------------------------------------------------ a text, its edited text, the next
class _Doc:
    """A document in the walk: its parse, split where its edited text leaves it."""

    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text or ""
        self.points = _points(self.text)
        self.n = len(self.points)
        self.keep = self.n - self.n // 2
        self.seen = set()
        self.head, self.open = parse(self.text[:self.keep], self.seen)
        grown = self.seen.copy() if self.n else self.seen
        tail, _ = parse(self.text, grown, self.open, self.keep)
        self.sig = signature(self.points, np.array(self.head + tail, dtype=np.int64))

    def row(self, follower: "_Doc") -> dict:
        take = self.n // 2
        edited = self.text[:self.keep] + follower.text[:take]
        tail, _ = parse(edited, self.seen, self.open, self.keep)
        self.seen = None
        points = np.concatenate([self.points[:self.keep], follower.points[:take]])
        sig = signature(points, np.array(self.head + tail, dtype=np.int64))
        return {"edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                "edited_fp": sig.astype(">u4").tobytes(),
                "near_edited": likeness(self.sig, sig), "near_next": likeness(self.sig, follower.sig)}

    def base(self) -> dict:
        return {"doc_id": self.doc_id, "n_chars": self.n, "fp": self.sig.astype(">u4").tobytes()}


_ROW = ("doc_id long, n_chars long, fp binary, edited_sha256 string, edited_fp binary, "
        "near_edited double, near_next double")
_WALK = _ROW + ", part int, first boolean, last boolean, text string"


def _walk(batches, schema):
    """Rows of one sorted range.  The first carries its text, so does the last, which has
    no next row here and stays incomplete."""
    import pyarrow as pa

    part = TaskContext.get().partitionId()
    out, before, is_first = [], None, True

    def give(doc, more, last):
        nonlocal is_first
        keep = is_first or last
        out.append({**doc.base(), **more, "part": part, "first": is_first, "last": last,
                    "text": doc.text if keep else None})
        is_first = False

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            doc = _Doc(doc_id, text)
            if before is not None:
                give(before, before.row(doc), False)
            before = doc
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if before is not None:
        give(before, {}, True)
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _complete(batches, schema):
    import pyarrow as pa

    for batch in batches:
        rows = []
        for doc_id, text, follows in zip(*(c.to_pylist() for c in batch.columns)):
            doc = _Doc(doc_id, text)
            rows.append({**doc.base(), **doc.row(_Doc(None, follows))})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _map(df: DataFrame, step, ddl: str) -> DataFrame:
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    return df.mapInArrow(lambda batches: step(batches, schema), ddl)


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h").asc()]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    walked = materialize(_map(rows.select("doc_id", "text"), _walk, _WALK), "lz-walk")
    ranges = walked.filter("first").select("part", F.col("text").alias("follows"))
    # the next range that has rows; after the last one, the first.  One number per task
    parts = walked.filter("first").select("part")
    after = F.lead("part").over(Window.orderBy("part"))
    start = F.min("part").over(Window.orderBy("part"))
    follow = parts.select(F.col("part").alias("_part"), F.coalesce(after, start).alias("_next"))
    tails = (walked.filter("last").select("doc_id", "text", "part")
             .join(follow, F.col("part") == F.col("_part")).drop("part", "_part")
             .join(ranges, F.col("_next") == F.col("part")).select("doc_id", "text", "follows"))
    names = [f.name for f in T.StructType.fromDDL(_ROW)]
    done = walked.filter("not last").select(*names).unionByName(_map(tails, _complete, _ROW))
    return done.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fp")).alias("fingerprint"),
                       F.lower(F.hex("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")
