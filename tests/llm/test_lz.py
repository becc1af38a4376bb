import hashlib
import random

import numpy as np
import pytest

from sessionrate.llm import lz

from .conftest import edge_rows, prose


def brute_phrases(text):
    seen, phrase = [], ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.append(phrase)
            phrase = ""
    return seen


@pytest.mark.parametrize("text", ["", "a", "aaaaaaa", "abababab", prose(1, 80), "é日本😀é日本"])
def test_phrases_against_plain_code(text):
    ends, start = lz.parse(text, set())
    cuts = [0, *ends]
    assert [text[a:b] for a, b in zip(cuts, cuts[1:])] == brute_phrases(text)
    assert start == (ends[-1] if ends else 0)


def test_signature_is_of_the_phrase_set():
    """Equal phrase sets hash alike wherever the phrases stand."""
    a, b = "abcab" + "x", "cabab"                 # a b c ab x | c a b ab
    sig = {t: set(lz.fingerprint(t).tolist()) for t in (a, b)}
    assert set(brute_phrases(b)) < set(brute_phrases(a))
    assert sig[b] < sig[a] and len(sig[a]) == 5
    assert lz.likeness(lz.fingerprint(a), lz.fingerprint(b)) == pytest.approx(4 / 5)


def test_small_sets_give_the_exact_jaccard_likeness():
    rng = random.Random(0)
    for _ in range(50):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(2))
        x, y = set(brute_phrases(a)), set(brute_phrases(b))
        want = len(x & y) / len(x | y) if x | y else 1.0
        assert lz.likeness(lz.fingerprint(a), lz.fingerprint(b)) == pytest.approx(want)


def test_estimate_is_near_the_true_likeness():
    for seed in range(10):
        a = prose(seed, 800)
        b = a[:len(a) // 2] + prose(seed + 100, 400)
        x, y = set(brute_phrases(a)), set(brute_phrases(b))
        assert abs(lz.likeness(lz.fingerprint(a), lz.fingerprint(b)) - len(x & y) / len(x | y)) < 0.25


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    texts = [prose(i, 400) for i in range(5)]
    want = [lz.fingerprint(t).tolist() for t in texts]
    monkeypatch.setattr(lz, "CHUNK", 7)
    assert [lz.fingerprint(t).tolist() for t in texts] == want


def test_bounds():
    f = lz.fingerprint(prose(1, 4000))
    assert len(f) == lz.K and (np.diff(f.astype(np.int64)) > 0).all()
    assert lz.likeness(f, f) == 1.0 and lz.likeness(f, lz.fingerprint("")) == 0.0
    assert lz.likeness_of(lz._hex(f), lz._hex(f)) == 1.0


def check_against_plain_code(rows, got):
    """``rows`` in their order (id descending, null last, then text hash)."""
    text = [t or "" for _, t in rows]
    assert len(got) == len(rows)
    for k, (doc_id, _) in enumerate(rows):
        own, after = text[k], text[(k + 1) % len(rows)]
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        f, e, n = lz.fingerprint(own), lz.fingerprint(edited), lz.fingerprint(after)
        want = (doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), lz._hex(f), lz._hex(e),
                lz.likeness(f, e), lz.likeness(f, n))
        assert want in got


def test_awkward_rows_over_many_ranges(spark, edge, nothing, many_parts):
    order = {r.t: r.h for r in spark.createDataFrame([(r[1] or "",) for r in edge_rows()], "t string")
             .selectExpr("t", "xxhash64(t) h").collect()}
    rows = sorted(((r[0], r[1]) for r in edge_rows()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), order[r[1] or ""]))
    got = [tuple(r) for r in lz.edited_likeness(edge).collect()]
    check_against_plain_code(rows, got)
    assert lz.edited_likeness(nothing).count() == 0
    one = edge.filter("doc_id = 9")
    r = lz.edited_likeness(one).first()
    assert r.near_next == 1.0 and r.n_chars == len(one.first().text)
    out = lz.with_fingerprint(edge)
    assert out.columns == edge.columns + ["fingerprint"] and lz.with_fingerprint(nothing).count() == 0
    assert {r.fingerprint for r in out.filter("text is null or text = ''").collect()} == {""}


def test_many_small_ranges(spark, many_parts):
    rows = [(i * 3, prose(i, 8)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in lz.edited_likeness(df).collect()]
    check_against_plain_code(sorted(rows, reverse=True), got)
