"""Operator 9: class-based n-gram scoring (Brown classes found by exchange clustering).

A token's probability is that of its class after the previous token's class, times that of
the word within its class.  Tokens are the words of the text (A-Z lower-cased, runs of
bytes other than space and \\t..\\r) and one end.

Training, over all training documents:

1. All words are counted.  The most frequent ones are the seeds, ``SEED_ROOT`` times the square
   root of the number of different words (``MIN_SEEDS`` at least), and there are ``CLASS_ROOT``
   times its fourth root of classes (``MIN_CLASSES`` at least), so both grow with the corpus.
2. The seeds' bigram counts (other words as one) become one row per seed, its neighbours.
   Exchange clustering starts with the ``START`` most frequent, on the driver; the other seeds
   are placed, and sweeps over all seeds follow as Spark jobs: every seed goes to the class
   that raises the class-bigram likelihood most, given the classes of the others, half of them
   at a time; class bigrams are counted anew after each half, and a half that lowers the
   likelihood is undone and ends the sweeps.
3. Every document is turned into numbers block by block (a block is about
   ``BLOCK_TOKENS`` tokens of one input split): seeds keep their numbers, every other word of its
   vocabulary becomes a row (block, word, counts by class of the neighbours), its documents
   become packed word numbers.
4. The vocabulary rows meet by word: total count, and one exchange step, the class of the
   largest gain in likelihood given its neighbours' classes.  So every word has a class,
   however rare.
5. Count and class go back to each block, whose documents become class sequences; class
   transitions are counted over the training documents and every document is scored.

Smoothing: a class transition is interpolated with the class's own share (``BETA`` pseudo
counts); a class keeps the share of its words that occur once for words never seen
(n1 + 1 of N + n1 + 1), which are one further type, as in the base score.

Scale: what is shuffled are each block's distinct words, twice, the seeds' distinct bigrams,
twice, and the packed documents once.  A seed is in no vocabulary row; another word is one row
per block however often it occurs, and the task that sums it up holds 16 bytes of each and its
counts by class.  A seed's row of neighbours has two entries per seed at most.  The driver holds
the seeds, their classes (the square root of the vocabulary), the bigrams of ``START`` of them
and class tables.

Defined cases: NULL and empty texts are the end alone; repeated rows get equal scores; a
NULL id is the empty id for the held-out choice; without any training document all words
are unknown and scores are those of an empty table; a single long document is a block of
its own; extra columns are ignored; no documents give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionrate.llm.common import materialize, portions, scratch_path, shuffle_partitions

SEED_ROOT, MIN_SEEDS = 2.0, 500
CLASS_ROOT, MIN_CLASSES = 1.5, 24
START = 500                    # seeds clustered on the driver before the others
START_SWEEPS = 15
SWEEPS = 3                     # over all seeds, as Spark jobs
BETA = 20.0
BLOCK_TOKENS = 1_500_000
ROWS_PER_TASK = 250_000        # vocabulary rows that meet in one task
CHUNK = 8192                   # of its words whose classes are chosen at once
HELD = 4_000_000               # packed entries held before those of equal words are summed up
END = ""                       # the end token; never a word
NONE = 65535                   # class code of an unknown word
MOST = 65535                   # largest count in one packed entry


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _map(df: DataFrame, step, ddl: str) -> DataFrame:
    """mapInArrow of ``step(batches, schema)``."""
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    return df.mapInArrow(lambda batches: step(batches, schema), ddl)


# ------------------------------------------------------------------- seeds
def _counts(batches, schema):
    import pyarrow as pa

    counts, tokens = Counter(), 0

    def flush():
        items = [(w.decode("utf-8", "surrogatepass"), n) for w, n in counts.items()]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in items], type=pa.string()),
                                           pa.array([n for _, n in items], type=pa.int64())], schema=schema)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            words = words_of(text)
            counts.update(words)
            tokens += len(words)
        if tokens >= BLOCK_TOKENS:
            yield flush()
            counts, tokens = Counter(), 0
    if tokens:
        yield flush()


def word_counts(train: DataFrame) -> DataFrame:
    """All words with their counts."""
    return _map(train.select("text"), _counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, limit: int) -> list:
    return counts.orderBy(F.desc("n"), "word").limit(limit).collect()


def seed_words(train: DataFrame, limit: int) -> list[str]:
    return [r["word"] for r in _most_frequent(word_counts(train), limit)]


def sizes(types: int) -> tuple[int, int]:
    """Number of seeds and of classes for a vocabulary of ``types`` words."""
    return max(MIN_SEEDS, int(SEED_ROOT * types ** 0.5)), max(MIN_CLASSES, int(CLASS_ROOT * types ** 0.25))


def _seed_numbers(seeds: list[str]) -> dict[bytes, int]:
    return {w.encode("utf-8", "surrogatepass"): i for i, w in enumerate(seeds)}


def seed_neighbours(train: DataFrame, seeds: list[str]) -> DataFrame:
    """Neighbours of each seed: (word, code, n), arrays of codes and counts, every code once.

    Words are numbered as in ``seeds``; S stands for other words, S + 1 for the border.  A code
    below S + 2 is a word to the right, code - (S + 2) one to the left.  Numbers S and S + 1
    have rows with right neighbours only."""
    size = len(seeds) + 2

    def step(batches, schema):
        import pyarrow as pa

        number, other, border = _seed_numbers(seeds), size - 2, size - 1
        held, tokens = [], 0

        def flush():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n.astype(np.int64))], schema=schema)

        for batch in batches:
            for part in portions(batch, "text"):
                flat = [border]
                for text in part.column(0).to_pylist():
                    flat += [number.get(w, other) for w in words_of(text)]
                    flat.append(border)
                ids = np.array(flat, dtype=np.int64)
                held.append(ids[:-1] * size + ids[1:])
                tokens += len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield flush()
                    held, tokens = [], 0
        if held:
            yield flush()

    cells = (_map(train.select("text"), step, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
             .select(F.expr(f"cell div {size}").cast("int").alias("a"), (F.col("cell") % size).cast("int").alias("b"), "n"))
    right = F.struct(F.col("a").alias("word"), F.col("b").alias("code"))
    left = F.struct(F.col("b").alias("word"), (F.col("a") + size).alias("code"))
    both = F.when(F.col("b") < len(seeds), F.array(right, left)).otherwise(F.array(right))
    return (cells.select(F.explode(both).alias("x"), "n").groupBy("x.word")
            .agg(F.collect_list(F.struct("x.code", "n")).alias("near"))
            .select("word", "near.code", "near.n"))


def _near_rows(batches):
    for batch in batches:
        code, n = batch.column(1), batch.column(2)
        at = code.offsets.to_numpy()
        codes, counts = code.values.to_numpy(), n.values.to_numpy()
        for i, w in enumerate(batch.column(0).to_pylist()):
            yield w, codes[at[i]:at[i + 1]], counts[at[i]:at[i + 1]]


def class_bigrams(near: DataFrame, of: np.ndarray, width: int) -> np.ndarray:
    """Bigram counts of the classes ``of`` the numbers (words, other words, border)."""
    of = of.astype(np.int32)

    def step(batches, schema):
        import pyarrow as pa

        total = np.zeros(width * width)
        for w, codes, n in _near_rows(batches):
            right = codes < len(of)
            own = of[w] * width
            total[own:own + width] += np.bincount(of[codes[right]], weights=n[right], minlength=width)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells].astype(np.int64))], schema=schema)

    got = (_map(near, step, "cell long, n long").groupBy("cell")
           .agg(F.sum("n").alias("n")).toPandas())                  # width ** 2 cells at most
    out = np.zeros(width * width)
    out[got["cell"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.float64)
    return out.reshape(width, width)


# --------------------------------------------------------- exchange clustering
def _g(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(n: np.ndarray) -> float:
    """Of the class bigram model with counts ``n``, up to a constant: sum g(N(c, d)) -
    sum g(N(c, .)) - sum g(N(., c)) with g(x) = x log x."""
    return float(_g(n).sum() - _g(n.sum(axis=1)).sum() - _g(n.sum(axis=0)).sum())


def class_gains(n: np.ndarray, row: np.ndarray, col: np.ndarray, self_: float) -> np.ndarray:
    """Likelihood gained by putting a word into each class but the last two.  ``n`` does not
    count the word; ``row`` and ``col`` are its neighbours by class, without itself."""
    classes = len(n) - 2
    c, g = np.arange(classes), _g(n)
    right, left = (n.sum(axis=1) + col)[:classes], (n.sum(axis=0) + row)[:classes]   # its neighbours stay
    r = _g(n[:classes] + row) - g[:classes]
    k = _g(n[:, :classes] + col[:, None]) - g[:, :classes]
    gain = r.sum(axis=1) - r[c, c] + k.sum(axis=0) - k[c, c]
    gain += _g(n[c, c] + row[c] + col[c] + self_) - g[c, c]
    gain -= _g(right + row.sum() + self_) - _g(right) + _g(left + col.sum() + self_) - _g(left)
    return gain


def _shift(n, c, row, col, self_, sign):
    n[c] += sign * row
    n[:, c] += sign * col
    n[c, c] += sign * self_


def exchange(bigrams: np.ndarray, classes: int = MIN_CLASSES, sweeps: int = START_SWEEPS) -> np.ndarray:
    """Class of every word (rows of ``bigrams`` but the last two, which stay classes of
    their own: other words and the border): a sweep takes each word out of its class and puts
    it where the likelihood is largest."""
    words = len(bigrams) - 2
    of = np.concatenate([np.arange(words) % classes, [classes, classes + 1]])
    size = classes + 2
    one = np.eye(size)
    n = one[of].T @ bigrams @ one[of]
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            here = of[w]
            row = np.bincount(of, weights=bigrams[w], minlength=size)
            col = np.bincount(of, weights=bigrams[:, w], minlength=size)
            self_ = bigrams[w, w]
            row[here] -= self_
            col[here] -= self_
            _shift(n, here, row, col, self_, -1)
            gain = class_gains(n, row, col, self_)
            best = int(gain.argmax())
            if gain[best] <= gain[here] + 1e-9:
                best = here
            moved += best != here
            of[w] = best
            _shift(n, best, row, col, self_, 1)
        if not moved:
            break
    return of[:words]


def best_classes(near: DataFrame, of: np.ndarray, n: np.ndarray, who: np.ndarray) -> np.ndarray:
    """``of`` with the best class of every word in the mask ``who``, given the classes of all
    others; a word in no class yet (class C, other words) gets one."""
    width, of32 = len(n), of.astype(np.int32)

    def step(batches, schema):
        import pyarrow as pa

        both = np.concatenate([of32, of32 + width])
        words, best = [], []
        for w, codes, count in _near_rows(batches):
            if w >= len(who) or not who[w]:
                continue
            here, self_ = of32[w], float(count[codes == w].sum())
            near_ = np.bincount(both[codes], weights=count, minlength=2 * width)
            row, col = near_[:width], near_[width:]
            row[here] -= self_
            col[here] -= self_
            rest = n.copy()
            _shift(rest, here, row, col, self_, -1)
            gain = class_gains(rest, row, col, self_)
            to = int(gain.argmax())
            if here < width - 2 and gain[to] <= gain[here] + 1e-9:
                to = int(here)
            words.append(w)
            best.append(to)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int32()), pa.array(best, pa.int32())], schema=schema)

    got = _map(near, step, "word int, class int").toPandas()         # one row per seed at most
    out = of.copy()
    out[got["word"].to_numpy(dtype=np.int64)] = got["class"].to_numpy(dtype=np.int64)
    return out


def sweep(near: DataFrame, of: np.ndarray, classes: int, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all numbers after the sweeps over all seeds, and their class bigrams."""
    words, width = len(of) - 2, classes + 2
    n = class_bigrams(near, of, width)
    new = of[:words] == classes
    if new.any():
        of = best_classes(near, of, n, new)
        n = class_bigrams(near, of, width)
    for _ in range(sweeps):
        moved = 0
        for turn in (0, 1):
            to = best_classes(near, of, n, np.arange(words) % 2 == turn)
            if (to == of).all():
                continue
            after = class_bigrams(near, to, width)
            if likelihood(after) <= likelihood(n):
                return of, n
            moved += int((to != of).sum())
            of, n = to, after
        if not moved:
            break
    return of, n


@dataclass
class Seeds:
    """Seed words, their counts and classes, and the class bigram counts seen among them.

    Classes 0..C-1; C stands for other words, C + 1 for the border (end of a text)."""

    words: list[str]
    counts: np.ndarray
    classes: np.ndarray
    n: np.ndarray

    @property
    def size(self) -> int:
        return len(self.n)

    def gains(self) -> np.ndarray:
        """Gain in likelihood, to first order in the word's counts, of putting a word into a
        class: per neighbour class on the left, then on the right, and per occurrence."""
        c = self.size - 2
        log = np.log(self.n + 0.5)
        total = np.log(self.n.sum(axis=1)[:c] + 1.0) + np.log(self.n.sum(axis=0)[:c] + 1.0)
        return np.concatenate([log[:, :c], log[:c].T, -total[None, :]])


def cluster_seeds(train: DataFrame, limit: int | None = None, classes: int | None = None,
                  sweeps: int = SWEEPS) -> Seeds:
    """Seeds and their classes; ``limit`` and ``classes`` follow the vocabulary unless given."""
    counts = materialize(word_counts(train), "lm-counts")
    grown = sizes(counts.count())
    top = _most_frequent(counts, grown[0] if limit is None else limit)
    words = [r["word"] for r in top]
    classes = max(1, min(grown[1] if classes is None else classes, len(words)))
    near = materialize(seed_neighbours(train, words), "lm-neighbours")
    first = min(START, len(words))
    of = np.concatenate([np.full(len(words), classes), [classes, classes + 1]]).astype(np.int64)
    if first:
        start = np.minimum(np.arange(len(words) + 2), first)
        start[-1] = first + 1
        of[:first] = exchange(class_bigrams(near, start, first + 2), min(classes, first))
    of, n = sweep(near, of, classes, sweeps)
    return Seeds(words, np.array([r["n"] for r in top], dtype=np.int64), of[:len(words)], n)


# ----------------------------------------------------------- documents to numbers
_BLOCK = ("kind int, block long, word string, local int, near binary, "
          "doc_id long, held_out boolean, ids binary")


def _pack(features: np.ndarray, counts: np.ndarray, starts: np.ndarray):
    """Lists of (feature, count) pairs of 16 bits; a larger count takes several pairs."""
    import pyarrow as pa

    pairs = -(-counts // MOST)
    ends = np.concatenate([[0], np.cumsum(pairs)])
    out = np.empty((ends[-1], 2), dtype="<u2")
    out[:, 0] = np.repeat(features, pairs)
    out[:, 1] = MOST
    out[ends[1:] - 1, 1] = counts - (pairs - 1) * MOST
    at = (ends[starts] * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(out.tobytes())])


def _unpack(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of each pair of a packed column."""
    import pyarrow as pa

    if not len(column):
        return (np.zeros(0, dtype=np.int64),) * 3
    _, offsets, data = column.buffers()
    kind = "<i8" if pa.types.is_large_binary(column.type) else "<i4"
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1] // 4
    rows = np.repeat(np.arange(len(column)), np.diff(at))
    pairs = np.frombuffer(data or b"", dtype="<u2")[2 * at[0]:2 * at[-1]].reshape(-1, 2).astype(np.int64)
    return rows, pairs[:, 0], pairs[:, 1]


def _blocks(seeds: Seeds):
    width = seeds.size

    def step(batches, schema):
        import pyarrow as pa

        seed, seeds_n = _seed_numbers(seeds.words), len(seeds.words)
        first = TaskContext.get().partitionId() << 24
        docs, words, tokens, made = [], [], 0, 0

        def flush():
            own = [w for w in dict.fromkeys(w for d in words for w in d) if w not in seed]
            look = {**seed, **{w: seeds_n + i for i, w in enumerate(own)}}.__getitem__
            size = seeds_n + len(own)
            near = np.concatenate([seeds.classes, np.full(len(own), width - 2), [width - 1]])   # last: the border
            ids = [np.fromiter(map(look, d), dtype=np.int64, count=len(d)) for d in words]
            ends = np.array([size])
            flat = np.concatenate([ends] + [y for x, (_, out) in zip(ids, docs) if not out for y in (x, ends)])
            at = np.flatnonzero((flat < size) & (flat >= seeds_n))
            rows = (flat[at] - seeds_n) * (2 * width)
            keys, counts = np.unique(np.concatenate([rows + near[flat[at - 1]], rows + width + near[flat[at + 1]]]),
                                     return_counts=True)
            starts = np.searchsorted(keys, np.arange(len(own) + 1) * (2 * width))
            block = first + made

            def table(rows, **cols):
                return pa.RecordBatch.from_arrays(
                    [cols.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

            yield table(len(own), kind=pa.array(np.zeros(len(own), np.int32)), block=pa.array(np.full(len(own), block)),
                        word=pa.array(own, type=pa.binary()).cast(pa.string()),
                        local=pa.array(np.arange(seeds_n, size, dtype=np.int32)),
                        near=_pack(keys % (2 * width), counts, starts))
            yield table(len(docs), kind=pa.array(np.ones(len(docs), np.int32)),
                        block=pa.array(np.full(len(docs), block)),
                        doc_id=pa.array([d for d, _ in docs], type=pa.int64()),
                        held_out=pa.array([h for _, h in docs]),
                        ids=pa.array([zlib.compress(x.astype("<u4").tobytes(), 1) for x in ids]))

        for batch in batches:
            for doc_id, text, out in zip(*(c.to_pylist() for c in batch.columns)):
                own = words_of(text)
                docs.append((doc_id, out))
                words.append(own)
                tokens += len(own) + 1
                if tokens >= BLOCK_TOKENS:
                    yield from flush()
                    docs, words, tokens, made = [], [], 0, made + 1
        if docs:
            yield from flush()

    return step


# ------------------------------------------------------------ words to classes
_WORDS = "block long, local int, n long, class int, n1 long"


def _classify(seeds: Seeds):
    width, gains = seeds.size, seeds.gains()

    def step(batches, schema):
        """All rows of a word are in this task; none is a seed.  Gives each row its word's count and
        class; rows of block -1 sum up the words of a class (local: words, n: tokens, n1: once).

        Neighbours are summed up as the rows come; of a row only its block, number and word are
        held (16 bytes), as a frequent word has a row in every block."""
        import pyarrow as pa

        number: dict[str, int] = {}
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        rows, held, waiting = [], [], 0

        def merged():
            every = np.concatenate([keys, *(k for k, _ in held)])
            cells, at = np.unique(every, return_inverse=True)
            n = np.concatenate([counts, *(c for _, c in held)])
            return cells, np.bincount(at, weights=n, minlength=len(cells)).astype(np.int64)

        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            code = col["word"].dictionary_encode()
            of_code = np.array([number.setdefault(w, len(number)) for w in code.dictionary.to_pylist()], dtype=np.int64)
            row = of_code[code.indices.to_numpy(zero_copy_only=False)]
            at, feature, n = _unpack(col["near"])
            held.append((row[at] * (2 * width) + feature, n))
            waiting += len(at)
            if waiting > HELD + len(keys):
                keys, counts = merged()
                held, waiting = [], 0
            rows.append((col["block"].to_numpy(), col["local"].to_numpy(), row.astype(np.int32)))
        if not rows:
            return
        words, cell = len(number), CHUNK * 2 * width
        keys, counts = (np.concatenate([x, *more]) for x, more in zip((keys, counts), zip(*held) if held else ([], [])))
        chunk = keys // cell
        order = np.argsort(chunk.astype(np.uint16) if words < CHUNK << 16 else chunk, kind="stable")
        keys, counts, chunk = keys[order], counts[order], chunk[order]
        n, of = np.zeros(words, dtype=np.int64), np.full(words, NONE, dtype=np.int64)
        for lo in range(0, words, CHUNK):
            hi = min(words, lo + CHUNK)
            a, b = np.searchsorted(chunk, [lo // CHUNK, lo // CHUNK + 1])
            near = np.bincount(keys[a:b] - lo // CHUNK * cell, weights=counts[a:b],
                               minlength=(hi - lo) * 2 * width).reshape(hi - lo, 2 * width)
            n[lo:hi] = near[:, :width].sum(axis=1)             # every occurrence has one left neighbour
            of[lo:hi] = (near @ gains[:-1] + np.outer(n[lo:hi], gains[-1])).argmax(axis=1)
        of[n == 0] = NONE
        for block, local, row in rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(local), pa.array(n[row]), pa.array(of[row].astype(np.int32)),
                 pa.nulls(len(row), pa.int64())], schema=schema)
        types, tokens, once = class_sums(n[n > 0], of[n > 0], width - 2)
        c = np.flatnonzero(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(c), -1, np.int64)), pa.array(types[c].astype(np.int32)), pa.array(tokens[c]),
             pa.array(c.astype(np.int32)), pa.array(once[c])], schema=schema)

    return step


def class_sums(n: np.ndarray, of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, tokens and words that occur once, by class."""
    return tuple(np.bincount(of, weights=w, minlength=classes).astype(np.int64)
                 for w in (np.ones(len(n)), n.astype(float), (n == 1).astype(float)))


@dataclass
class Tables:
    """Class totals; class ``c`` (the last) is the end."""

    tokens: int                # N, ends included
    types: int                 # V, the end included
    n: np.ndarray              # tokens per class, the end last
    n1: np.ndarray             # words that occur once per class, the end's 0

    def unseen(self) -> np.ndarray:
        """Probability within each class of a word never seen; none is an end."""
        p = (self.n1 + 1.0) / (self.n + self.n1 + 1.0)
        p[-1] = 0.0
        return p

    def transitions(self, counts: np.ndarray) -> np.ndarray:
        """log10 P(class | previous class); last row: after an unknown word; last column:
        an unknown word."""
        c = len(self.n)
        share = (self.n + 1.0) / (self.n.sum() + c)
        rows = (counts + BETA * share) / (counts.sum(axis=1, keepdims=True) + BETA)
        rows = np.concatenate([rows, share[None, :]])
        return np.log10(np.concatenate([rows, (rows @ self.unseen())[:, None]], axis=1))


# ------------------------------------------------------------------- scoring
_DOCS = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, "
         "word_sum double, classes binary")


def _encode(tables: Tables, seeds: Seeds):
    """Per block: the documents as class codes, with the sums over their words."""
    end = len(tables.n) - 1
    within = tables.n + tables.n1 + 1.0
    within[-1] = max(1.0, tables.n[-1])
    schema = to_arrow_schema(T.StructType.fromDDL(_DOCS))

    def step(words, docs):
        import pyarrow as pa

        local = words["local"].to_numpy()
        size = len(seeds.words) + len(local)
        n = np.zeros(size + 1, dtype=np.int64)
        of = np.full(size + 1, NONE, dtype=np.int64)
        n[:len(seeds.words)], of[:len(seeds.words)] = seeds.counts, seeds.classes
        n[local], of[local] = words["n"].to_numpy(), words["class"].to_numpy()
        n[-1], of[-1] = tables.n[-1], end if tables.n[-1] else NONE
        base = np.log10(n + 1.0)
        known = n > 0
        inner = np.zeros(len(n))
        inner[known] = np.log10(n[known] / within[of[known]])
        out = {k: [] for k in ("n_tokens", "n_known", "base_sum", "word_sum", "classes")}
        last = np.array([size])
        for raw in docs["ids"].to_pylist():
            ids = np.concatenate([np.frombuffer(zlib.decompress(raw), dtype="<u4").astype(np.int64), last])
            out["n_tokens"].append(len(ids))
            out["n_known"].append(int(known[ids].sum()))
            out["base_sum"].append(float(base[ids].sum()))
            out["word_sum"].append(float(inner[ids].sum()))
            out["classes"].append(zlib.compress(of[ids].astype("<u2").tobytes(), 1))
        return pa.table([docs["doc_id"], docs["held_out"], *(out[f.name] for f in list(schema)[2:])],
                        schema=schema)

    return step


def _steps(raw: bytes, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Previous and own class of each token; unknown words as code end + 1."""
    own = np.frombuffer(zlib.decompress(raw), dtype="<u2").astype(np.int64)
    own = np.where(own == NONE, end + 1, own)
    return np.concatenate([[end], own[:-1]]), own


def _count_transitions(docs: DataFrame, end: int) -> np.ndarray:
    size = end + 2

    def step(batches, schema):
        import pyarrow as pa

        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                before, own = _steps(raw, end)
                total += np.bincount(before * size + own, minlength=size * size)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], schema=schema)

    got = (_map(docs.filter("not held_out").select("classes"), step, "cell long, n long")
           .groupBy("cell").agg(F.sum("n").alias("n")).collect())    # one per pair of classes at most
    out = np.zeros(size * size)
    for r in got:
        out[r["cell"]] = r["n"]
    return out.reshape(size, size)[:end + 1, :end + 1]


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def _score(tables: Tables, log_p: np.ndarray):
    end = len(tables.n) - 1
    unit = np.log10(tables.tokens + tables.types + 1.0)

    def step(batches, schema):
        import pyarrow as pa

        for batch in batches:
            d = dict(zip(batch.schema.names, batch.columns))
            n = d["n_tokens"].to_numpy()
            moves = [float(log_p[_steps(raw, end)].sum()) for raw in d["classes"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [d["doc_id"], d["held_out"], d["n_tokens"], d["n_known"],
                 pa.array(np.full(len(n), tables.tokens, dtype=np.int64)),
                 pa.array(d["base_sum"].to_numpy() - n * unit),
                 pa.array(d["word_sum"].to_numpy() + np.array(moves, dtype=np.float64))], schema=schema)

    return step


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", seeds: int | None = None,
          classes: int | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (both log10 probabilities).  ``seeds`` and ``classes``: see :func:`cluster_seeds`."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       held_out(key).alias("held_out"))
    found = cluster_seeds(rows.filter(~F.col("held_out")), seeds, classes, sweeps)
    path = scratch_path(spark, "lm-blocks")
    _map(rows, _blocks(found), _BLOCK).write.partitionBy("kind").parquet(path)
    block_schema = T.StructType([f for f in T.StructType.fromDDL(_BLOCK) if f.name != "kind"])
    blocks = spark.read.schema(block_schema.add("kind", T.IntegerType())).parquet(path)
    vocab = blocks.filter("kind = 0").select("block", "word", "local", "near")
    packed = blocks.filter("kind = 1").select("block", "doc_id", "held_out", "ids")
    parts = max(shuffle_partitions(spark), -(-vocab.count() // ROWS_PER_TASK))
    words = materialize(_map(vocab.repartition(parts, "word"), _classify(found), _WORDS), "lm-words")
    sums = {r["class"]: r for r in words.filter("block = -1").groupBy("class").agg(
        F.sum("local").alias("types"), F.sum("n").alias("n"), F.sum("n1").alias("n1")).collect()}
    ends = packed.filter("not held_out").count()
    c = found.size - 2
    of_seeds = class_sums(found.counts, found.classes, c)
    n = np.array([*of_seeds[1], ends], dtype=np.float64)
    n1 = np.array([*of_seeds[2], 0], dtype=np.float64)
    for i, r in sums.items():
        n[i] += r["n"]
        n1[i] += r["n1"]
    types = len(found.words) + sum(int(r["types"]) for r in sums.values()) + (ends > 0)
    tables = Tables(int(n.sum()), types, n, n1)
    own = words.filter("block >= 0").select("block", "local", "n", "class")
    encoded = materialize(own.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(
        _encode(tables, found), _DOCS), "lm-docs")
    log_p = tables.transitions(_count_transitions(encoded, c))
    return _map(encoded, _score(tables, log_p), _SCORES)
