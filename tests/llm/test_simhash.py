import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sessionrate.llm import simhash as S
from sessionrate.llm.components import components

from .conftest import edge_rows, prose


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join("\0" if c in " \t\n\x0b\x0c\r" else c for c in low).split("\0") if w]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > n)


def brute_groups(rows):
    """(key, fp) rows -> smallest key reachable, by comparing all pairs."""
    root = {f: f for _, f in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 2:
            root[find(b)] = find(a)
    least = {}
    for k, f in rows:
        if k is not None:
            least[find(f)] = min(least.get(find(f), k), k)
    return [(k, f, least.get(find(f))) for k, f in rows]


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a b", "A b\tC", prose(1), "é É ß x\x0by\xa0z", prose(2, 4000)])
def test_fingerprint_against_plain_code(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_shingle_hash_is_sparks(spark):
    got = spark.sql("select xxhash64('a b c') as h").first().h
    assert xxhash.xxh64_intdigest(b"a b c", 42) == got % (1 << 64)


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(0)
    for m in (2, 3, 4):
        cost = rng.integers(0, 100, (m, 3, 20)).astype(float)
        cost[:, 0] = 0
        got = S.allocate(cost, 2 - m + 1)
        options = [t for t in itertools.product((-1, 0, 1), repeat=m) if sum(t) == 2 - m + 1]
        for e in range(20):
            price = lambda t: sum(cost[i, x + 1, e] for i, x in enumerate(t))  # noqa: B023, E731
            assert got[:, e].sum() == 2 - m + 1
            assert price(got[:, e]) == min(map(price, options))


@pytest.mark.parametrize("m", [2, 3, 4])
def test_every_near_pair_meets_under_a_value(m):
    rng = random.Random(m)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 2))) for b in base]
    fps = np.array(base + near, dtype=np.uint64)
    bits = list(range(64))
    rng.shuffle(bits)
    groups = [sorted(bits[i::m]) for i in range(m)]
    probing = S.Probing(groups, np.random.default_rng(m).integers(0, 60, (m, S.CELLS)))
    index, probes = {}, {}
    for i, v, rows in probing.index(fps):
        for x, r in zip(v.tolist(), rows.tolist()):
            index.setdefault((i, x), set()).add(r)
    for i, v, rows in probing.probes(fps):
        for x, r in zip(v.tolist(), rows.tolist()):
            probes.setdefault(r, set()).update(index.get((i, x), ()))
    for k in range(60):
        assert k + 60 in probes[k] and k in probes[k + 60]


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40], bits[:, 7] = bits[:, 3], 1 - bits[:, 3]
    groups = S.group_bits((bits.T @ bits).astype(float), 4000, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({3, 7, 40} <= set(g) for g in groups)


def _planted(seed, hot):
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for b in fps[:40]:                                     # near ones, exact ones, chains
        c = b
        for _ in range(rng.randint(1, 4)):
            c ^= sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3)))
            fps.append(c)
    if hot:                                                # hundreds that share most of their bits
        centre = rng.getrandbits(64)
        fps += [centre ^ sum(1 << i for i in rng.sample(range(12), rng.randint(0, 5))) for _ in range(600)]
        fps += [fps[0]] * 300
    rows = [(i * 7 % 1009, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    return rows + [(None, rows[0][1]), (None, 12345)]


@pytest.mark.parametrize("hot", [False, True])
def test_groups_against_all_pairs(spark, hot):
    rows = _planted(3, hot)
    df = spark.createDataFrame(rows, "doc_id long, fp long").repartition(5)
    got = {r.fp: r.component for r in S.groups(df).collect()}
    unsigned = [(k, f % (1 << 64)) for k, f in rows]
    for k, f, least in brute_groups(unsigned):
        assert got[f - (1 << 64) if f >> 63 else f] == least


def test_hot_values_are_linked_through_hubs(spark):
    """Entries of a hot value leave the join, and a hub has 65 members at most."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = np.array(sorted({centre ^ sum(1 << i for i in rng.sample(range(12), rng.randint(0, 6)))
                           for _ in range(900)}), dtype=np.uint64)
    groups = [list(range(i, 64, 4)) for i in range(4)]
    shared = [np.unique(S.project(fps, g), return_counts=True)[1].max() for g in groups]
    assert max(shared) > S.HOT
    df = spark.createDataFrame([(int(f) - (1 << 64) if int(f) >> 63 else int(f),) for f in fps], "fp long")
    links = S.links(df.repartition(4), len(fps)).collect()
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in links)      # a hub's members
    assert len(links) <= 65 * len(fps)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (60, 61), (61, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(8, 40)}, 61: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(edge, nothing):
    got = S.near_duplicates(edge).collect()
    rows = [(r[0], brute_fingerprint(r[1])) for r in edge_rows()]
    want = [(k, f - (1 << 64) if f >> 63 else f, c) for k, f, c in brute_groups(rows)]
    assert Counter((r.doc_id, r.fp, r.component) for r in got) == Counter(want)
    assert S.near_duplicates(nothing).count() == 0


def test_one_row_of_each_group_stays(edge, nothing):
    out = S.one_per_group(edge)
    assert out.columns == edge.columns
    kept = out.collect()
    groups = {(c, f) for _, f, c in brute_groups([(r[0], brute_fingerprint(r[1])) for r in edge_rows()])}
    want = Counter(c for c in {f: c for c, f in groups}.values())
    assert Counter(r.doc_id for r in kept) == want
    assert all(r.fp == "fp" and r._mark == "_mark" for r in kept)
    assert S.one_per_group(nothing).count() == 0


def test_hex_form(spark):
    df = spark.createDataFrame([(0,), (255,), (-1,)], "fp long")
    assert [r.h for r in df.select(S.hex_fp().alias("h")).collect()] == ["0" * 16, "00000000000000ff", "f" * 16]
    assert df.filter(F.length(S.hex_fp()) != 16).count() == 0
