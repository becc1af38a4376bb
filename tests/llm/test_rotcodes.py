"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest

from sessionrate.llm import rotcodes as R
from sessionrate.llm.common import read_table
from sessionrate.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, least=0.9):
    """[(key, links, component, kept)] by all pairs of (key, vector) rows."""
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [R.units(np.array([v], dtype=float))[0] if good else None for (_, v), good in zip(rows, ok)]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for d in {len(u) for u in unit if u is not None}:
        own = [i for i in range(n) if unit[i] is not None and len(unit[i]) == d]
        x = np.array([unit[i] for i in own])
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= least, 1))):
            i, j = own[a], own[b]
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return sorted(((key, links[i], low.get(find(i)), key is not None and key == low.get(find(i)))
                   for i, (key, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near(rng, centre, cosine):
    """A unit vector at that cosine of ``centre``."""
    e = rng.standard_normal(len(centre))
    e -= (e @ centre) * centre
    return cosine * centre + np.sqrt(1 - cosine ** 2) * e / np.linalg.norm(e)


def planted(seed, dim, groups, alone, cosine=0.99):
    rng = np.random.default_rng(seed)
    out = [x for x in R.units(rng.standard_normal((alone, dim)))]
    for size in groups:
        centre = R.units(rng.standard_normal((1, dim)))[0]
        out += [near(rng, centre, cosine) * rng.uniform(0.1, 9) for _ in range(size)]
    out += [out[0]] * 5 + [2 * out[1]]
    rng.shuffle(out)
    return [(i * 7 % 10007, x.tolist()) for i, x in enumerate(out)]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in rows],
                                 f"vec_id long, embedding array<{kind}>, kept string, core long").repartition(5)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    words = R.Words(13, 21)
    for dim in (16, 64, 700):                            # fewer and more entries than bits
        for cosine in (0.0, 0.5, 0.9, 0.99):
            a = R.units(rng.standard_normal((300, dim)))
            b = np.array([near(rng, x, cosine) for x in a])
            of, f = R.encode(np.stack([a, b], axis=1).reshape(-1, dim), words)
            est, bound = R.estimates(of.reshape(300, 2, -1), f.reshape(300, 2, 2), words, dim)
            off = est[:, 0, 1] - cosine
            assert abs(off.mean()) < 5 * off.std() / np.sqrt(300) + 1e-3
            assert (np.abs(off) < bound[:, 0, 1]).mean() > 0.995
            assert off.std() < bound[:, 0, 1].mean() / 2


def test_words_and_code_vectors():
    words = R.Words(9, 7)
    x = R.units(np.random.default_rng(1).standard_normal((50, 24)))
    of, f = R.encode(x, words)
    assert of.shape == (50, 7) and of.min() >= 0 and of.max() < 512
    for i, code in enumerate(R.decode(of, words, 24)):
        assert np.allclose((code * x).sum(axis=1), f[:, i])


def test_a_pair_at_the_threshold_shares_a_word():
    rng = np.random.default_rng(2)
    words = R.Words.for_entries(50_000)
    a = R.units(rng.standard_normal((2000, 64)))
    b = np.array([near(rng, x, 0.9) for x in a])
    hit = (R.encode(a, words)[0] == R.encode(b, words)[0]).any(axis=1).mean()
    assert hit > R.RECALL - 0.02


@pytest.mark.parametrize("hot", [16, 256])
@pytest.mark.parametrize("cosine", [0.96, 0.99])       # looser than a core, and within one
def test_against_all_pairs(spark, many_parts, monkeypatch, hot, cosine):
    monkeypatch.setattr(R, "HOT", hot)
    rows = planted(3, 64, [300, 60, 12, 2, 2], 250, cosine)
    got, want = result(R.near_duplicates(frame(spark, rows))), brute(rows)
    share = sum(r[1] for r in got) / sum(r[1] for r in want)
    assert len(got) == len(want) and 0.97 < share <= 1 and all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(got, want))
    assert [r[2:] for r in got] == [r[2:] for r in want]
    if cosine == 0.99:
        assert got == want


def test_pairs_of_a_core_are_not_made(spark, monkeypatch):
    monkeypatch.setattr(R, "HOT", 32)
    rows = planted(4, 32, [600], 50)
    df = frame(spark, rows)
    entries = df.selectExpr("vec_id as id", "embedding as vec", "1L as w").dropDuplicates(["vec"])
    words = R.Words.for_entries(700)
    coded = R.materialize(R._encoded(entries, words), "test-coded")
    core = {r.id: r.core for r in R.cores(coded, words).collect()}
    group = [r[0] for r in brute(rows) if r[1] > 100]
    assert sum(core.get(k, k) == min(core.values()) for k in group) > 0.9 * len(group)
    assert R.links(coded, words).count() < 40 * len(group)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, SF, "embeddings").collect()]
    got = QUERIES["op12_rotation_code_dedup"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert result(got) == brute(rows)


def test_awkward_rows(spark, many_parts):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [-1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [3.0, 0.0, 0.0]), (None, [1.0, 0.0]),
            (None, None), (None, [0.0, 5.0, 5.0, 5.0]), (12, [1e300, 1e300]), (13, [1e-300, 1e-300]), (14, [-0.0, 1.0]), (15, [0.0, 1.0]),
            (16, [7.0]), (17, [0.5])]
    assert result(R.near_duplicates(frame(spark, rows))) == brute(rows)


def test_no_rows(spark):
    got = R.near_duplicates(frame(spark, []))
    assert got.columns == ["vec_id", "n_links", "component", "kept"] and not got.collect()
