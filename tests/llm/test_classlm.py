import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sessionrate.llm import classlm as C

from .conftest import edge_rows


def words(text):
    return [w.decode() for w in C.words_of(text)]


def likelihood(bigrams, of, classes):
    n = np.zeros((classes + 2, classes + 2))
    full = np.concatenate([of, [classes, classes + 1]])
    for i, j in np.ndindex(*bigrams.shape):
        n[full[i], full[j]] += bigrams[i, j]
    g = lambda x: sum(v * math.log(v) for v in np.ravel(x) if v > 0)
    return g(n) - g(n.sum(axis=1)) - g(n.sum(axis=0))


def test_seed_words_are_counted_over_all_blocks(spark):
    many = "a " * 400_000
    texts = [many + "b", many + "b c c", many + "b"]           # a block each
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert C.seed_words(df, 2) == ["a", "b"] and C.seed_words(df, 9) == ["a", "b", "c"]


def test_exchange_finds_planted_classes_and_a_local_optimum():
    rng = random.Random(0)
    n = np.zeros((14, 14))
    state = 0
    for _ in range(6000):                              # class 0 (words 0-5) and 1 (6-11) take turns
        new = rng.randrange(6) + (6 if state < 6 else 0)
        n[state, new] += 1
        state = new
    of = C.exchange(n, 2)
    assert len(set(of[:6])) == 1 and len(set(of[6:])) == 1 and of[0] != of[6]
    of = C.exchange(n, 4, sweeps=50)
    best = likelihood(n, of, 4)
    for w in range(12):
        for c in range(4):
            other = of.copy()
            other[w] = c
            assert likelihood(n, other, 4) <= best + 1e-6


def plain_bigrams(texts, seeds):
    number = {w: i for i, w in enumerate(seeds)}
    n = np.zeros((len(seeds) + 2, len(seeds) + 2))
    for t in texts:
        line = [len(seeds) + 1, *(number.get(w, len(seeds)) for w in words(t)), len(seeds) + 1]
        for x, y in zip(line, line[1:]):
            n[x, y] += 1
    return n


def plain_sweeps(bigrams, of, classes, sweeps):
    """The sweeps by trying every class of every word on the whole table."""
    size = len(of) - 2

    def moved(of, who):
        to = of.copy()
        for w in who:
            value = []
            for c in range(classes):
                other = of.copy()
                other[w] = c
                value.append(likelihood(bigrams, other[:size], classes))
            best = int(np.argmax(value))
            if of[w] == classes or value[best] > value[of[w]] + 1e-6:
                to[w] = best
        return to

    of = moved(of, [w for w in range(size) if of[w] == classes])
    for _ in range(sweeps):
        before = of
        for turn in (0, 1):
            to = moved(of, range(turn, size, 2))
            if (to == of).all():
                continue
            if likelihood(bigrams, to[:size], classes) <= likelihood(bigrams, of[:size], classes):
                return of
            of = to
        if (of == before).all():
            break
    return of


def test_sweeps_over_all_seeds_against_plain_code(spark, many_parts):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seeds = C.seed_words(df, 30)
    near = C.seed_neighbours(df, seeds).cache()
    bigrams = plain_bigrams([t for _, t in rows], seeds)
    assert (C.class_bigrams(near, np.arange(32), 32) == bigrams).all()
    of = np.array([i % 4 for i in range(10)] + [4] * 20 + [4, 5])           # ten in classes, the others in none
    got, n = C.sweep(near, of, 4, sweeps=2)
    assert got.tolist() == plain_sweeps(bigrams, of, 4, 2).tolist() and set(got[:30]) <= set(range(4))
    one = np.eye(6)[got]
    assert (n == one.T @ bigrams @ one).all()
    placed, _ = C.sweep(near, of, 4, sweeps=0)
    assert C.likelihood(n) > likelihood(bigrams, placed[:30], 4)


def test_seeds_and_classes_grow_with_the_vocabulary(spark):
    got = [C.sizes(10 ** k) for k in range(2, 11)]
    assert got[0] == (C.MIN_SEEDS, C.MIN_CLASSES) and got == sorted(got) and got[-1][0] == 200_000
    assert all(c < C.NONE for _, c in got)
    found = C.cluster_seeds(spark.createDataFrame([(" ".join(f"w{i % 700}" for i in range(3000)),)], "text string"))
    assert len(found.words) == 500 and found.counts.tolist() == [5] * 200 + [4] * 300


def test_packed_counts_of_any_size():
    features, counts = np.array([3, 9, 0, 1]), np.array([1, 65_535, 65_536, 200_000])
    rows, f, n = C._unpack(C._pack(features, counts, np.array([0, 2, 2, 4])).slice(0))
    total = Counter()
    for r, x, k in zip(rows, f, n):
        total[int(r), int(x)] += int(k)
    assert total == {(0, 3): 1, (0, 9): 65_535, (2, 0): 65_536, (2, 1): 200_000}


def corpus(n=160):
    rng = random.Random(1)
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = []
    for i in range(n):
        own = a if i % 2 else b
        rows.append((i, " ".join(rng.choice(own) if rng.random() < 0.97 else f"rare{rng.randrange(400)}"
                                 for _ in range(rng.randint(0, 50)))))
    return rows


def brute(rows, found):
    """Scores from the clustered seeds on, in plain code."""
    train = [words(t) for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2]
    count = Counter(w for d in train for w in d)
    ends, size = len(train), found.size
    c = size - 2
    seed = dict(zip(found.words, found.classes.tolist()))
    near = lambda w: size - 1 if w is None else seed.get(w, size - 2)
    left, right = defaultdict(Counter), defaultdict(Counter)
    for d in train:
        d = [None, *d, None]
        for x, y, z in zip(d, d[1:], d[2:]):
            left[y][near(x)] += 1
            right[y][near(z)] += 1
    gains, of = found.gains(), dict(seed)
    for w, n in count.items():
        if w not in seed:
            value = (sum(k * gains[f] for f, k in left[w].items()) + sum(k * gains[size + f] for f, k in right[w].items())
                     + n * gains[-1])
            of[w] = int(np.argmax(value))
    of = {w: k for w, k in of.items() if count[w]}
    n, n1 = np.zeros(c + 1), np.zeros(c + 1)
    for w, k in count.items():
        n[of[w]] += k
        n1[of[w]] += k == 1
    n[c] = ends
    total, types = int(n.sum()), len(count) + (ends > 0)
    unseen = [(n1[k] + 1) / (n[k] + n1[k] + 1) for k in range(c)] + [0.0]
    moves = np.zeros((c + 1, c + 1))
    code = lambda d: [of.get(w, c + 1) for w in d] + [c if ends else c + 1]
    for d in train:
        for x, y in zip([c, *code(d)], code(d)):
            moves[x, y] += 1
    share = (n + 1) / (n.sum() + c + 1)

    def step(x, y):
        p = share if x > c else (moves[x] + C.BETA * share) / (moves[x].sum() + C.BETA)
        return p[y] if y <= c else sum(p * unseen)

    out = {}
    for i, t in rows:
        d = words(t)
        base = sum(math.log10((k + 1) / (total + types + 1)) for k in [*(count[w] for w in d), ends])
        s = sum(math.log10(step(x, y)) for x, y in zip([c, *code(d)], code(d)))
        s += sum(math.log10(count[w] / (n[of[w]] + n1[of[w]] + 1)) for w in d if w in of)
        out[i, t] = (len(d) + 1, sum(w in of for w in d) + (ends > 0), total, base, s)
    return out


def check(rows, df, **how):
    train = df.selectExpr("cast(doc_id as long) doc_id", "text").filter(~C.held_out())
    found = C.cluster_seeds(train, how.get("seeds"), how.get("classes"))
    want = brute(rows, found)
    got = C.score(df, **how).collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for (i, t), v in want.items():
        texts[i].append(v)
    for r in got:
        own = (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        assert any(own[:3] == v[:3] and own[3:] == pytest.approx(v[3:], rel=1e-9) for v in texts[r.doc_id])
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7 == 2)
    return got


def test_scores_against_plain_code(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = check(rows, df, seeds=40, classes=6)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)      # lower perplexity


def test_probabilities_sum_to_one():
    t = C.Tables(100, 20, np.array([50.0, 30.0, 20.0]), np.array([5.0, 2.0, 0.0]))
    p = 10 ** t.transitions(np.array([[3, 4, 5], [0, 0, 0], [1, 2, 0]], dtype=float))
    assert np.allclose(p[:, :3].sum(axis=1), 1)
    assert np.allclose(p[:, 3], p[:, :3] @ t.unseen())


def test_awkward_rows(spark, edge, nothing):
    check([(r[0], r[1]) for r in edge_rows()], edge)
    assert C.score(nothing).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(held, "nothing to learn from"), (held, None)]
    got = C.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * 2
    assert all(math.isfinite(r.score) and r.base_score == 0.0 for r in got)
