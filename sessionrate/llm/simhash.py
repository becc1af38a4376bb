"""Operator 2: near-duplicates by 64-bit SimHash and the generalised pigeonhole principle.

A fingerprint bit is 1 if it is set in over half of the XXH64 (seed 42) hashes of the
text's word shingles.  Fingerprints within ``distance`` differing bits are linked:

1. Equal fingerprints are one entry (map-side grouping, so copies cost nothing later).
2. The 64 bits are grouped into ``m`` parts by their correlation over all entries, so that
   bits that move together share a part.
3. For every entry, thresholds t_1..t_m (-1: part unused) with sum distance - m + 1 are
   allocated by dynamic programming over the estimated number of candidates, taken from a
   histogram of each part's values (``CELLS`` counters a part, whatever the input).  By
   the generalised pigeonhole principle every neighbour is within t_i of the entry in some
   part i, whatever the allocation; the histogram only decides the cost.
4. Every entry is indexed under its value in each part and probes all values within t_i;
   index and probes meet in one join whose condition verifies the full distance.
5. Values that more than ``HOT`` entries share (counted exactly) are left out of that join, on
   both sides: their entries are linked through hubs instead.  Two fingerprints differ in at
   most 2 bits exactly if some 64-bit value is within 1 bit of both, so each such entry
   meets its neighbours under its 65 hub values; a hub has 65 members at most.  Thus the
   work stays in proportion to the entries however large a group of near copies is, and no
   link is lost.
6. Links become components by alternating stars.

Defined cases: a text without words (NULL, empty, blanks) has fingerprint zero and is
linked like any other; a text with fewer words than a shingle is one shingle; repeated
rows are linked by their equal fingerprints; a NULL doc_id takes part but is never the
smallest; extra columns are ignored or, in :func:`one_per_group`, carried; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionrate.llm.common import map_text, materialize
from sessionrate.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
BITS = 64
CELLS = 1 << 14
HOT = 64
_BLOCK = 100_000       # hashes whose bits are counted at once


# ----------------------------------------------------------------- fingerprints
def _shingles(text: str | None, width: int) -> list[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(width)])))


def _hashes(text: str | None, width: int) -> np.ndarray:
    shingles, digest = _shingles(text, width), xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))


def _majority(hashes: np.ndarray) -> int:
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, _BLOCK):
        bits = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    return _majority(_hashes(text, width))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_fingerprint(docs: DataFrame, text: str = "text", drop: tuple = (), width: int = SHINGLE) -> DataFrame:
    """Add ``fp``, the fingerprint as a (signed) long."""
    return map_text(docs, lambda ts: {"fp": [_signed(fingerprint(t, width)) for t in ts]},
                    "fp long", text, drop=drop)


def hex_fp(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


# ------------------------------------------------------- bit groups and thresholds
def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Bits in ``m`` groups of (nearly) equal size, correlated bits together.

    ``together[i, j]``: entries in which bits i and j are both 1.
    """
    n = max(n, 1)
    p = np.diag(together) / n
    cov = together / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0.0)
    free, groups = set(range(BITS)), []
    for g in range(m):
        size = len(free) // (m - g)
        own = [max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())]
        free.remove(own[0])
        while len(own) < size:
            best = max(sorted(free), key=lambda b: corr[b, own].sum())
            own.append(best)
            free.remove(best)
        groups.append(sorted(own))
    return groups


def project(fps: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), dtype=np.uint64)
    for k, b in enumerate(group):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def cell(values: np.ndarray) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14)).astype(np.int64)


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Thresholds per entry and part, of least summed cost, that add up to ``total``.

    ``cost[part, t + 1, entry]`` for t = -1, 0, 1; dynamic programming over the parts.
    """
    m, options, n = cost.shape
    sums = np.arange(-m, m + 1)
    best = np.full((len(sums), n), np.inf)
    best[m] = 0.0
    picked = np.zeros((m, len(sums), n), dtype=np.int8)
    for i in range(m):
        new = np.full_like(best, np.inf)
        for t in range(-1, options - 1):
            for s in range(len(sums)):
                if 0 <= s - t < len(sums):
                    c = best[s - t] + cost[i, t + 1]
                    better = c < new[s]
                    new[s][better] = c[better]
                    picked[i, s][better] = t
        best = new
    out = np.empty((m, n), dtype=np.int8)
    at = np.full(n, total + m)
    for i in range(m - 1, -1, -1):
        out[i] = picked[i, at, np.arange(n)]
        at = at - out[i]
    return out


class Probing:
    """Bit groups and histograms; turns fingerprints into index and probe rows."""

    def __init__(self, groups: list[list[int]], counts: np.ndarray, distance: int = DISTANCE):
        self.groups, self.counts, self.distance = groups, counts, distance

    def _near(self, i: int, values: np.ndarray) -> np.ndarray:
        """Values within 1 bit in part i: (entries, 1 + bits of the part)."""
        flips = np.uint64(1) << np.arange(len(self.groups[i]), dtype=np.uint64)
        return np.concatenate([values[:, None], values[:, None] ^ flips], axis=1)

    def index(self, fps: np.ndarray):
        for i, g in enumerate(self.groups):
            yield i, project(fps, g), np.arange(len(fps))

    def probes(self, fps: np.ndarray):
        m = len(self.groups)
        near = [self._near(i, project(fps, g)) for i, g in enumerate(self.groups)]
        load = [self.counts[i][cell(v.ravel())].reshape(v.shape) for i, v in enumerate(near)]
        cost = np.zeros((m, 3, len(fps)))
        for i in range(m):
            cost[i, 1] = load[i][:, 0] + 1
            cost[i, 2] = load[i].sum(axis=1) + load[i].shape[1]
        t = allocate(cost, self.distance - m + 1)
        for i in range(m):
            rows = np.flatnonzero(t[i] == 0)
            yield i, near[i][rows, 0], rows
            rows = np.flatnonzero(t[i] == 1)
            yield i, near[i][rows].ravel(), np.repeat(rows, near[i].shape[1])


def parts_for(n: int) -> int:
    """Number of parts: values about as wide as the entries are many, 2 to 4 parts."""
    return max(2, min(4, BITS // max(1, int(n).bit_length())))


# ---------------------------------------------------------------- Spark jobs
def _fps(batch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _bit_groups(entries: DataFrame, n: int, m: int) -> list[list[int]]:
    def run(batches):
        import pyarrow as pa

        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            x = _bits(_fps(batch)).astype(np.float32)   # exact: a batch is far below 2**24 rows
            total += (x.T @ x).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], ["cell", "n"])

    got = entries.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    together = np.zeros(BITS * BITS)
    for r in got:                                       # 4096 cells at most
        together[r["cell"]] = r["n"]
    return group_bits(together.reshape(BITS, BITS), n, m)


def _histogram(entries: DataFrame, groups: list[list[int]]) -> np.ndarray:
    def run(batches):
        import pyarrow as pa

        total = np.zeros((len(groups), CELLS), dtype=np.int64)
        for batch in batches:
            fps = _fps(batch)
            for i, g in enumerate(groups):
                total[i] += np.bincount(cell(project(fps, g)), minlength=CELLS)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], ["cell", "n"])

    got = entries.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(groups) * CELLS, dtype=np.int64)    # parts x CELLS at most
    counts[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return counts.reshape(len(groups), CELLS)


def _rows(entries: DataFrame, probing: Probing, probe: bool) -> DataFrame:
    """(part, value, fp) rows: what the entries are indexed under, or what they probe."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = _fps(batch)
            if not len(fps):
                continue
            for i, values, rows in (probing.probes(fps) if probe else probing.index(fps)):
                v, f = values.view(np.int64), fps[rows].view(np.int64)
                part = np.full(len(v), i, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(v), pa.array(f)], ["part", "value", "fp"])

    return entries.mapInArrow(run, "part int, value long, fp long")


def _near_values(col: str):
    flips = [F.col(col).bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)]
    return F.array(F.col(col), *flips)


def links(entries: DataFrame, n: int) -> DataFrame:
    """(a, b): fingerprints within DISTANCE bits, enough of them to connect every pair
    that is (all pairs outside hot values, stars around hubs within them)."""
    m = parts_for(n)
    groups = _bit_groups(entries, n, m)
    probing = Probing(groups, _histogram(entries, groups))
    index = materialize(_rows(entries, probing, False), "simhash-index")
    probes = materialize(_rows(entries, probing, True), "simhash-probes")
    value = ["part", "value"]
    hot = materialize(index.groupBy(value).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT)
                      .select(value), "simhash-hot")
    i = index.join(hot, value, "left_anti").select(*value, F.col("fp").alias("b"))
    p = probes.join(hot, value, "left_anti").select(*value, F.col("fp").alias("a"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    pairs = p.join(i, (p["part"] == i["part"]) & (p["value"] == i["value"])
                   & (F.col("a") < F.col("b")) & close).select("a", "b")
    met = index.join(hot, value, "left_semi").select("fp").unionByName(
        probes.join(hot, value, "left_semi").select("fp")).distinct()
    hubs = (met.select("fp", F.explode(_near_values("fp")).alias("hub"))
               .groupBy("hub").agg(F.sort_array(F.collect_list("fp")).alias("of"))   # 65 at most
               .filter(F.size("of") > 1))
    stars = hubs.select(F.col("of")[0].alias("a"), F.explode(F.slice("of", 2, BITS)).alias("b"))
    return pairs.unionByName(stars)


def groups(fps: DataFrame, key: str = "doc_id") -> DataFrame:
    """``fps`` (key, fp) -> (fp, root, component), one row per distinct fingerprint: the
    smallest fingerprint and the smallest key reachable from it.  (Where rows of one key have
    several texts, two groups may have the same smallest key, but never the same root.)"""
    entries = materialize(fps.groupBy("fp").agg(F.min(key).alias("first")), "simhash-entries")
    n = entries.count()
    star = components(links(entries.select("fp"), n), "simhash-links")
    rooted = entries.join(star, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    least = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component"))
    return rooted.join(least, F.col("root") == F.col("_root")).select("fp", "root", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fp (long), component (smallest key of its group)."""
    fps = materialize(with_fingerprint(docs.select(key, text), text, drop=(text,)), "simhash-fps")
    of = groups(fps, key).withColumnRenamed("fp", "_fp")
    return fps.join(of, F.col("fp") == F.col("_fp")).select(key, "fp", "component")


def _name(key):
    return F.coalesce(key.cast("string"), F.lit("no key"))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group, one row that has the
    smallest key (of several rows with that key, the one of the smallest row hash)."""
    cols = [F.col(c) for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_text"),
                       _name(F.col(key)).alias("_id"), F.xxhash64(*cols).alias("_mark"))
    fps = materialize(with_fingerprint(rows.select("_key", "_mark", "_text"), "_text", drop=("_text",)), "simhash-fps")
    of = groups(fps, "_key").select(F.col("fp").alias("_of"), "root")
    first = F.min(F.struct(F.col("_key").isNull().alias("late"), "_key", "_mark"))
    best = (fps.join(of, F.col("fp") == F.col("_of")).groupBy("root").agg(first.alias("b"))
               .select(_name(F.col("b._key")).alias("_id"), F.col("b._mark").alias("_mark")).distinct())
    # plain equality on both columns: the join's partitioning then serves the grouping too
    kept = rows.select("_row", "_id", "_mark").join(best, ["_id", "_mark"], "left_semi")
    return kept.dropDuplicates(["_id", "_mark"]).select("_row.*")
