import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sessionrate.llm import mixing as M

from .conftest import edge_rows, prose


def corpus(sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, prose(i, 8 + 8 * (i % 4)), source))
            i += 1
    return rows


def brute(rows, exponent, budget, seed=0):
    """Copies of each row: whole reads, then rows in permuted order up to the rest."""
    docs = defaultdict(list)
    for doc_id, text, source in rows:
        docs[source or ""].append(("" if doc_id is None else str(doc_id), len((text or "").split()), doc_id))
    tokens = {s: sum(n for _, n, _ in d) for s, d in docs.items()}
    total = sum(tokens.values())
    power = {s: (t / total) ** exponent if t else 0.0 for s, t in tokens.items()}
    out = Counter()
    for s, d in docs.items():
        if not tokens[s]:
            out.update({i: 1 for _, _, i in d})
            continue
        quota = round(power[s] / sum(power.values()) * budget)
        full, rest = divmod(quota, tokens[s])
        place = lambda k: int(hashlib.md5(f"{seed}:{k}\x1f{s}\x1f{full}".encode()).hexdigest()[:13], 16)  # noqa: B023, E731
        upto = 0
        for k, n, i in sorted(d, key=lambda x: (place(x[0]), x[0])):
            upto += n
            out[i] += full + (rest > 0 and upto <= rest)
    return out


def mix_of(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    return {r.doc_id: r.copies for r in M.mix_copies(df, **how).collect()}


def shares(rows, copies=None):
    t = Counter()
    for i, text, s in rows:
        t[s] += len(text.split()) * (1 if copies is None else copies[i])
    return {s: n / sum(t.values()) for s, n in t.items()}


def entropy(p):
    return -sum(x * math.log(x) for x in p.values() if x)


SIZES = {"big": 300, "mid": 60, "small": 20, "tiny": 6}


@pytest.mark.parametrize("target", [0.5, 0.8, 0.95])
def test_target_entropy_and_copies_against_plain_code(spark, target):
    rows = corpus(SIZES)
    got = mix_of(spark, rows, target_entropy=target, max_repeat=None, budget="corpus", block_rows=25)
    natural = shares(rows)
    lo, hi = 0.0, 1.0
    h = lambda a: entropy({s: p ** a / sum(x ** a for x in natural.values()) for s, p in natural.items()})
    want = target * math.log(len(SIZES))
    for _ in range(60):
        lo, hi = ((lo + hi) / 2, hi) if h((lo + hi) / 2) >= want else (lo, (lo + hi) / 2)
    exponent = 1.0 if h(1.0) >= want else round(lo, 6)
    total = sum(len(t.split()) for _, t, _ in rows)
    assert got == brute(rows, exponent, total)
    if exponent < 1:
        assert entropy(shares(rows, got)) == pytest.approx(want, abs=0.03)


def test_repetition_limit_holds(spark):
    rows = corpus(SIZES)
    got = mix_of(spark, rows, target_entropy=1.0, max_repeat=3.0, budget="corpus")
    assert max(got.values()) <= 3 and 0.9 < sum(shares(rows, got).values()) < 1.1
    cover = mix_of(spark, rows, target_entropy=1.0, max_repeat=2.0, budget="cover")
    assert min(cover.values()) == 1 and max(cover.values()) == 2


def test_blocks_do_not_change_the_result_size(spark):
    """Any block size takes the same tokens, to within a document a source."""
    rows = corpus({"a": 200, "b": 40})
    for size in (1, 7, 1000):
        got = mix_of(spark, rows, target_entropy=0.99, max_repeat=None, block_rows=size)
        assert abs(sum(got[i] * len(t.split()) for i, t, _ in rows) - sum(len(t.split()) for _, t, _ in rows)) < 80


def test_mixture_rows(spark):
    rows = corpus(SIZES)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    how = dict(target_entropy=0.9, max_repeat=None)
    copies = mix_of(spark, rows, **how)
    got = Counter((r.doc_id, r.epoch) for r in M.mixture(df, **how).collect())
    assert got == Counter((i, e) for i, n in copies.items() for e in range(n))


def test_reading_order_of_the_mixture(spark):
    """Read by (epoch, block, place), the last, partial epoch of a source ends where its budget does."""
    rows = corpus(SIZES)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("Place", F.lit("own"))
    out = M.mixture(df, target_entropy=0.9, max_repeat=None, block_rows=25, seed=4)
    assert out.columns == ["doc_id", "text", "source", "epoch", "block", "place"]
    for source, n in SIZES.items():
        got = sorted((r.epoch, r.block, r.place, r.doc_id) for r in out.filter(F.col("source") == source).collect())
        assert got == sorted(got, key=lambda r: (r[0], r[2]))                 # blocks are ranges of places
        assert max(b for _, b, _, _ in got) < -(-n // 25)
        last = got[-1][0]
        order = [i for e, _, _, i in got if e == 0]
        assert sorted(order) == [i for i, _, s in rows if s == source] or last == 0
        assert order != sorted(order)
        for e in range(1, last + 1):
            own = [i for f, _, _, i in got if f == e]
            assert own == order[:len(own)] and (e == last or len(own) == n)


def test_awkward_rows(edge, nothing):
    out = M.mix_copies(edge, target_entropy=0.9, max_repeat=4.0)
    assert out.columns == [c for c in edge.columns if c != "copies"] + ["copies"]
    got = out.collect()
    assert len(got) == len(edge_rows())
    cover = M.mix_copies(edge, target_entropy=1.0, max_repeat=3.0, budget="cover").collect()
    assert len(cover) == len(edge_rows()) and {1} <= {r.copies for r in cover} <= {1, 2, 3}
    assert M.mix_copies(nothing).count() == 0 and M.mixture(nothing).count() == 0
    blank = edge.filter("doc_id in (5, 6, 7)")
    assert [r.copies for r in M.mix_copies(blank).collect()] == [1, 1, 1]


@pytest.mark.parametrize("rest", [0, 1, 700, 4_000, 10 ** 6])
def test_cut_among_rows_of_one_id(spark, rest):
    rows = [("s", 5, "7", (i * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63), i % 7, 3, rest)
            for i in range(1500)]
    rows += rows[:40] + [("s", 4, "6", -9, 2, 3, rest), ("s", 6, "", 9, 2, 3, rest), ("t", 1, "1", 1, 9, 0, 5)]
    df = spark.createDataFrame(rows, "_source string, _u long, _key string, _text long, _tokens long, before long, rest long")
    got = {r._source: tuple(r.cut_row) for r in M.cut_rows(df).collect()}
    want, upto = {}, 3
    for _, u, key, text, n, _, _ in sorted(r for r in rows if r[0] == "s"):
        upto += n
        if upto <= rest:
            want["s"] = (u, key, text)
    assert got == want
    # no task ranks all rows of the id: rows are ranked within ranges of their texts' hashes
    assert "windowspecdefinition(_source" in (plan := M.cut_rows(df)._jdf.queryExecution().optimizedPlan().toString())
    assert any("windowspecdefinition(_source" in x and "_range" in x.split("_text")[0] for x in plan.split("\n"))
