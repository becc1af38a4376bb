"""Operator 12: embedding near-duplicates by randomised-rotation binary codes.

Vectors of cosine 0.9 or more are linked.

1. Equal vectors are one entry with a weight (map-side grouping; told apart by 128 bits of hash).
2. A unit vector o is rotated at random and replaced by the signs of its coordinates, a unit
   vector c(o) of equal entries.  <c(o), o> is stored as the correction factor: <c(o), q> /
   <c(o), o> is an unbiased estimate of <o, q>, with an error of about
   sqrt((1 - f^2) / f^2 / (D - 1)) (f: the factor, D: the dimension rotated in).  Every entry
   has two such codes, of independent rotations, so that <c1(o), c2(q)> / (f1 f2) is unbiased
   too and codes alone give an estimate and its confidence bound.
3. The bits are cut into words; entries that share a word meet in a tile.  The number of words
   is such that a pair at the threshold shares one with probability RECALL or more.  Only codes
   and factors travel there (their size does not depend on the vectors' dimension).  Members
   of a pair whose estimate plus its bound reaches the threshold are named.
4. The vectors of named members alone are sent to their tiles, and the cosine recomputed
   in double precision decides.  A pair counts in the first word that it shares.
5. A word that more than HOT entries share is cut into blocks, and each two blocks are a
   tile of their own.  Before that, entries of hot words gather around pivots: two vectors
   within half the threshold's angle of a third are linked for certain, so the members of such a
   core are counted by its weight and linked to its pivot; their pairs are never made, and
   the blocks of a word's largest core do not meet each other.
6. A tile gives one row per linked member: its number of links and one edge.  Edges become
   components by alternating stars.

No pair below the threshold is linked.  A pair above it is missed if it shares no word, or
if its estimate is wrong by over SIGMAS deviations; README has the measured recall.

Defined cases: vectors that are NULL, empty, zero, or hold a NULL or non-finite entry link
with nothing and are their own component; vectors of different length are never linked;
repeated rows are linked like any equal vectors, and each appears in the result; a row whose
key is NULL is linked but never names a component (alone it has component NULL); extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionrate.llm.common import materialize
from sessionrate.llm.components import components

COSINE = 0.9
RECALL = 0.95              # of pairs at the threshold; nearer ones share more words
SIGMAS = 4.0
HOT = 256                  # entries of a word that meet in one tile
PER_WORD = 8               # entries expected to share a word by chance
CORE_WORDS = 4             # words by which cores are gathered
SEED = 12
FEW_ROWS = 100_000         # a table of at most so many narrow rows may be broadcast
_ROWS = 16_384             # rows of complete tiles handled at once
_CELLS = 1 << 22           # pairs compared at once


@dataclass(frozen=True)
class Words:
    """``count`` words of ``width`` bits; the first half of them from the first rotation."""
    width: int
    count: int
    cosine: float = COSINE

    @classmethod
    def for_entries(cls, n: int, cosine: float = COSINE) -> "Words":
        """Words that about PER_WORD entries share by chance (8 to 20 bits)."""
        width = min(20, max(8, int(n).bit_length() - 1 - int(math.log2(PER_WORD))))
        alike = (1 - math.acos(cosine) / math.pi) ** width
        return cls(width, min(254, max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - alike)))), cosine)

    @property
    def halves(self) -> tuple[int, int]:
        """Bits of the two codes."""
        first = (self.count + 1) // 2
        return first * self.width, (self.count - first) * self.width


@functools.lru_cache(maxsize=8)
def rotation(bits: int, dim: int, seed: int) -> np.ndarray:
    """``bits`` rows of a random rotation, as far as they meet vectors of ``dim`` entries."""
    size = max(bits, dim)
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:bits, :dim]


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, also where squares over- or underflow."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(x: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words (rows, count) and both correction factors (rows, 2) of unit vectors."""
    signs, factors = [], []
    for i, bits in enumerate(words.halves):
        y = x @ rotation(bits, x.shape[1], SEED + i).T
        signs.append(y > 0)
        factors.append(np.abs(y).sum(axis=1) / math.sqrt(bits))
    bits = np.concatenate(signs, axis=1).reshape(len(x), words.count, words.width)
    return bits @ (1 << np.arange(words.width)), np.stack(factors, axis=1)


def decode(of: np.ndarray, words: Words, dim: int) -> list[np.ndarray]:
    """Both code vectors, rotated back, for words (rows, count)."""
    signs = ((of[..., None] >> np.arange(words.width)) & 1).reshape(*of.shape[:-1], -1) * 2.0 - 1.0
    cut = words.halves[0]
    return [(part @ rotation(bits, dim, SEED + i)) / math.sqrt(bits)
            for i, (part, bits) in enumerate(zip((signs[..., :cut], signs[..., cut:]), words.halves))]


def estimates(of: np.ndarray, factors: np.ndarray, words: Words, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all pairs of (tiles, rows), and their bounds."""
    one, two = decode(of, words, dim)
    f1, f2 = factors[..., 0], factors[..., 1]
    cross = (one / f1[..., None]) @ np.swapaxes(two / f2[..., None], -1, -2)
    s1, s2 = ((1 - f * f) / (f * f) / max(max(bits, dim) - 1, 1) for f, bits in zip((f1, f2), words.halves))
    variance = s1[..., :, None] + s2[..., None, :] + dim * s1[..., :, None] * s2[..., None, :]
    bound = SIGMAS * np.sqrt(np.maximum(variance, np.swapaxes(variance, -1, -2)))
    return (cross + np.swapaxes(cross, -1, -2)) / 2, bound


# ----------------------------------------------------------------------- tiles
def _array(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _rows_of(column, width: int) -> np.ndarray:
    return _array(column.combine_chunks().flatten()).reshape(-1, width)


def _complete(batches):
    """Arrow tables of complete tiles (rows come sorted by key, i, j)."""
    import pyarrow as pa

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < _ROWS:
            continue
        table = pa.Table.from_batches(held)
        starts = _starts(table)
        if len(starts) > 1:                             # the last tile may go on
            yield table.slice(0, starts[-1])
            table = table.slice(starts[-1])
        held, rows = table.to_batches(), table.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def _starts(table) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for c in ("key", "i", "j"):
        x = _array(table.column(c))
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _stacks(table):
    """(dimension, rows): indices of tiles of one size and dimension, as (tiles, size)."""
    starts = _starts(table)
    sizes = np.diff(np.append(starts, table.num_rows))
    dims = _array(table.column("key"))[starts] >> 32
    for size, dim in sorted(set(zip(sizes.tolist(), dims.tolist()))):
        if size < 2:
            continue
        own = starts[(sizes == size) & (dims == dim)]
        step = max(1, _CELLS // size ** 2)
        for i in range(0, len(own), step):
            yield dim, own[i:i + step, None] + np.arange(size)


def _allowed(table, at: np.ndarray) -> np.ndarray:
    """Pairs (tile, a, b), a < b, of different cores and, in a tile of two blocks, of both."""
    block, core = _array(table.column("block"))[at], _array(table.column("core"))[at]
    two = _array(table.column("i"))[at[:, 0]] != _array(table.column("j"))[at[:, 0]]
    apart = (block[:, :, None] != block[:, None, :]) | ~two[:, None, None]
    return np.triu(apart & (core[:, :, None] != core[:, None, :]), 1)


def _first_shared(of: np.ndarray, key: np.ndarray, t, a, b) -> np.ndarray:
    """Whether the tile's word is the first that the pairs share."""
    word = (key[t] >> 24) & 255
    same = of[t, a] == of[t, b]
    return same.argmax(axis=1) == word


def _named(table, words: Words):
    """Rows of members of a pair that needs its exact cosine."""
    of, factors = _rows_of(table.column("words"), words.count), _rows_of(table.column("factors"), 2)
    key, out = _array(table.column("key")), np.zeros(table.num_rows, dtype=bool)
    for dim, at in _stacks(table):
        near, bound = estimates(of[at], factors[at], words, dim)
        t, a, b = np.nonzero(_allowed(table, at) & (near + bound >= words.cosine))
        first = _first_shared(of[at], key[at[:, 0]], t, a, b)
        out[at[t[first], a[first]]] = True
        out[at[t[first], b[first]]] = True
    return out


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member reachable over the pairs."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _linked(table, words: Words):
    """(rows, links, rows they have an edge to) of linked members, by exact cosines."""
    of, key = _rows_of(table.column("words"), words.count), _array(table.column("key"))
    weight, vectors = _array(table.column("w")), table.column("vec").combine_chunks()
    links = np.zeros(table.num_rows, dtype=np.int64)
    left, right = [], []
    for dim, at in _stacks(table):
        import pyarrow as pa

        x = units(_array(vectors.take(pa.array(at.ravel())).flatten()).astype(float).reshape(-1, dim)).reshape(*at.shape, dim)
        t, a, b = np.nonzero(_allowed(table, at) & (x @ np.swapaxes(x, 1, 2) >= words.cosine))
        first = _first_shared(of[at], key[at[:, 0]], t, a, b)
        a, b = at[t[first], a[first]], at[t[first], b[first]]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        left.append(a)
        right.append(b)
    none = np.empty(0, dtype=np.int64)
    label = _labels(table.num_rows, np.concatenate([none, *left]), np.concatenate([none, *right]))
    rows = np.flatnonzero(links)
    return rows, links[rows], label[rows]


# ---------------------------------------------------------------- Spark jobs
def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    some = F.exists(vec, lambda c: c != 0)
    return vec.isNotNull() & F.coalesce(~bad & some, F.lit(False))


def _identity(vec: str = "vec") -> list[Column]:
    return [F.xxhash64(vec).alias("h1"), F.xxhash64(F.lit(SEED), vec).alias("h2")]


def _small(df: DataFrame) -> DataFrame:
    """For a join: broadcast if it has at most FEW_ROWS rows."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def _encoded(entries: DataFrame, words: Words) -> DataFrame:
    """Add words and factors."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(batch.schema.get_field_index("vec"))
            sizes = _array(vectors.value_lengths())
            of, factors = np.empty((len(sizes), words.count), dtype=np.int64), np.empty((len(sizes), 2))
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = _array(vectors.take(pa.array(rows)).flatten()).astype(float).reshape(-1, dim)
                of[rows], factors[rows] = encode(units(x), words)
            cut = lambda x, kind: pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, x.shape[1]), type=pa.int32()), pa.array(x.ravel(), type=kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, cut(of, pa.int32()), cut(factors, pa.float32())],
                                             [*batch.schema.names, "words", "factors"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries.schema)
    return entries.mapInArrow(run, f"{kinds}, words array<int>, factors array<float>")


def _key(band, value) -> Column:
    """Dimension, number and value of a word in one long."""
    return F.shiftleft(F.size("vec").cast("long"), 32) + F.shiftleft(band.cast("long"), 24) + value.cast("long")


def _gather(members: DataFrame, cosine: float) -> DataFrame:
    """``members`` (id, vec, pivot, pivot_vec, to, to_vec): those that move to the pivot ``to``, as
    (id, pivot, pivot_vec)."""
    # two vectors this near to one pivot are linked, with room for rounding
    least = math.cos(math.acos(cosine) / 2 - 1e-6)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, vec, to, to_vec = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "vec", "to", "to_vec"))
            if not batch.num_rows:
                continue
            sizes, keep = _array(vec.value_lengths()), np.zeros(batch.num_rows, dtype=bool)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x, y = (units(_array(c.take(pa.array(rows)).flatten()).astype(float).reshape(-1, dim)) for c in (vec, to_vec))
                keep[rows] = (x * y).sum(axis=1) >= least
            keep = pa.array(keep)
            yield pa.RecordBatch.from_arrays([ids.filter(keep), to.filter(keep), to_vec.filter(keep)], ["id", "pivot", "pivot_vec"])

    kind = members.schema["vec"].dataType.simpleString()
    return members.filter("to < pivot").mapInArrow(run, f"id long, pivot long, pivot_vec {kind}")


def cores(entries: DataFrame, words: Words) -> DataFrame | None:
    """(id, core) of entries of hot words that lie near a pivot; None if no word is hot."""
    moved = None
    for band in range(min(CORE_WORDS, words.count)):
        keyed = entries.select("id", "vec", _key(F.lit(band), F.col("words")[band]).alias("key"))
        hot = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("key"),
                          "codes-hot")
        if not hot.limit(1).count():
            continue
        members = keyed.join(_small(hot), "key", "left_semi")
        if moved is None:
            members = members.select("*", F.col("id").alias("pivot"), F.col("vec").alias("pivot_vec"))
        else:
            members = members.join(moved, "id", "left").select(
                "id", "vec", "key", F.coalesce("pivot", "id").alias("pivot"), F.coalesce("pivot_vec", "vec").alias("pivot_vec"))
        members = materialize(members, "codes-members")
        best = members.groupBy("key").agg(F.min(F.struct("pivot", "pivot_vec")).alias("b")).select(
            "key", F.col("b.pivot").alias("to"), F.col("b.pivot_vec").alias("to_vec"))
        now = _gather(members.join(best, "key"), words.cosine)
        if moved is not None:
            kept = moved.withColumnsRenamed({"pivot": "p", "pivot_vec": "v"})
            now = kept.join(now, "id", "full").select("id", F.coalesce("pivot", "p").alias("pivot"),
                                                      F.coalesce("pivot_vec", "v").alias("pivot_vec"))
        moved = materialize(now, "codes-cores")
    return None if moved is None else moved.select("id", F.col("pivot").alias("core"))


def _tiled(slim: DataFrame) -> DataFrame:
    """``slim`` (id, core, ..., key) with the tiles (i, j) of every row and its block."""
    sizes = slim.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("core").alias("low"), F.max("core").alias("high"))
    hot = materialize(sizes.filter(F.col("n") > HOT).select("key", "n"), "codes-hot")
    if not hot.limit(1).count():
        zero = F.lit(0)
        return slim.select("*", zero.alias("block"), zero.alias("i"), zero.alias("j"))
    share = slim.select("key", "core").join(_small(hot), "key", "left_semi").groupBy("key", "core").agg(
        F.count(F.lit(1)).alias("m"))
    main = share.filter(F.col("m") > HOT).groupBy("key").agg(F.max(F.struct("m", "core")).alias("t")).select(
        "key", F.col("t.core").alias("main"), F.col("t.m").alias("m"))
    hot = materialize(hot.join(main, "key", "left").select(
        "key", "main", F.ceil((F.col("n") - F.coalesce("m", F.lit(0))) / HOT).cast("int").alias("r"),
        F.ceil(F.coalesce("m", F.lit(0)) / HOT).cast("int").alias("g")), "codes-hot")
    rows = slim.join(_small(hot), "key", "left")
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    inner = F.coalesce(F.col("core") == F.col("main"), F.lit(False))
    rows = rows.select("*", inner.alias("inner"), F.when(F.col("r").isNull(), 0).when(inner, F.col("r") + deal(F.col("g")))
                       .otherwise(deal(F.col("r"))).alias("block"))
    # members of the main core meet the other blocks only
    met = F.when(F.col("r").isNull(), F.array(F.lit(0))).when(~F.col("inner"), F.sequence(F.lit(0), F.col("r") + F.col("g") - 1)) \
           .when(F.col("r") > 0, F.sequence(F.lit(0), F.col("r") - 1))
    rows = rows.select(*slim.columns, "block", F.explode(met).alias("with"))
    return rows.select(*slim.columns, "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def links(entries: DataFrame, words: Words) -> DataFrame:
    """(id, links, to): per entry and tile, or core, the weight linked and an edge.

    ``entries``: id, vec, w, words, factors."""
    core = cores(entries, words)
    if core is None:
        entries = entries.withColumn("core", F.col("id"))
    else:
        entries = materialize(entries.join(core, "id", "left").withColumn("core", F.coalesce("core", "id")), "codes-cored")
    slim = entries.select("id", "core", "words", "factors", F.size("vec").alias("d"), F.posexplode("words").alias("band", "value"))
    slim = slim.select("id", "core", "words", "factors", (F.shiftleft(F.col("d").cast("long"), 32)
                       + F.shiftleft(F.col("band").cast("long"), 24) + F.col("value").cast("long")).alias("key"))

    def name(batches):
        import pyarrow as pa

        for table in _complete(batches):
            keep = pa.array(_named(table, words))
            yield from table.select(["key", "i", "j", "block", "id"]).filter(keep).combine_chunks().to_batches()

    named = materialize(_by_tile(_tiled(slim)).mapInArrow(name, "key long, i int, j int, block int, id long"), "codes-named")
    exact = named.join(entries.select("id", "core", "words", "vec", "w"), "id")

    def link(batches):
        import pyarrow as pa

        for table in _complete(batches):
            ids = _array(table.column("id"))
            rows, n, to = _linked(table, words)
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(n), pa.array(ids[to])], ["id", "links", "to"])

    out = _by_tile(exact).mapInArrow(link, "id long, links long, to long")
    if core is not None:
        whole = entries.groupBy("core").agg(F.sum("w").alias("all"), F.count(F.lit(1)).alias("m")).filter("m > 1")
        out = out.unionByName(entries.select("id", "core", "w").join(whole, "core").select(
            "id", (F.col("all") - F.col("w")).alias("links"), F.col("core").alias("to")))
    return materialize(out, "codes-links")


def near_duplicates(df: DataFrame, key: str = "vec_id", vec: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: key, n_links, component (smallest key reachable) and kept."""
    rows = df.select(F.col(key).alias("_key"), F.col(vec).alias("vec"))
    good = rows.filter(usable(F.col("vec")))
    entries = good.select("_key", "vec", *_identity()).groupBy("h1", "h2").agg(
        F.min("_key").alias("first"), F.count(F.lit(1)).alias("w"), F.any_value("vec").alias("vec"))
    entries = materialize(entries.withColumn("id", F.monotonically_increasing_id()), "codes-entries")
    words = Words.for_entries(entries.count(), cosine)
    coded = materialize(_encoded(entries.select("id", "vec", "w"), words), "codes-coded")
    found = links(coded, words)
    star = components(found.select("id", "to"), "codes-edges")
    total = found.groupBy("id").agg(F.sum("links").alias("links"))
    rooted = entries.select("id", "h1", "h2", "first", "w").join(star, F.col("id") == F.col("node"), "left").select(
        "id", "h1", "h2", "first", "w", F.coalesce("root", "id").alias("root"))
    rooted = materialize(rooted.join(total, "id", "left").select(
        "h1", "h2", "first", "root", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "codes-roots")
    least = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component"))
    of = rooted.join(least, F.col("root") == F.col("_root")).select("h1", "h2", "n_links", "component")
    met = good.select("_key", *_identity()).join(of, ["h1", "h2"]).select("_key", "n_links", "component")
    alone = rows.filter(~usable(F.col("vec"))).select("_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component"))
    out = met.unionByName(alone)
    return out.select(F.col("_key").alias(key), "n_links", "component",
                      F.coalesce(F.col("_key") == F.col("component"), F.lit(False)).alias("kept"))
