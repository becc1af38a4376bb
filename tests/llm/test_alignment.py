"""Alignment of two tokenizers against plain code on the libraries' own tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sessionrate.llm import alignment as L
from sessionrate.llm.common import read_table
from sessionrate.llm.queries import QUERIES

from .conftest import EXTRA, edge_rows

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libs():
    a = Tokenizer.from_file(L.A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=L.B_FILE)


@pytest.fixture(scope="module")
def tk():
    return L.tokenizers(*L.read_files())


def groups_of(text, libs):
    """[(A ids, B ids)] of one text, byte by byte."""
    if not text:
        return []
    a_lib, b_lib = libs
    a = a_lib.encode(" " + text, add_special_tokens=False).ids
    b = b_lib.encode(text)
    letters = {}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for i in printable:
        letters[chr(i)] = i
    for k, i in enumerate(j for j in range(256) if j not in printable):
        letters[chr(256 + k)] = i
    bytes_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
               else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
    data = (" " + text).encode()
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return []
    out, own, i, j, at_a, at_b = [], ([], []), 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            own[0].append(a[i])
            at_a += len(bytes_a[i])
            i += 1
        else:
            own[1].append(b[j])
            at_b += len(bytes_b[j])
            j += 1
        if at_a == at_b:
            out.append(own)
            own = ([], [])
    return out


def brute(rows, libs):
    groups = [groups_of(t, libs) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for ls in links for p in ls)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (key, _), g, ls in zip(rows, groups, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((key, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(ls.values()),
                    sum(n for p, n in ls.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in ls.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return Counter(out)


AWKWARD = ["a", " ", "  two  spaces ", "\n\n\tx\r\n", "<|endoftext|> <s> </s> <unk> <0x0A>", "▁ piece", "日本語 テキスト", "😀👍🏽 é ß",
           "1234567890 3.14", "x" * 5000, "=" * 3000 + "-" * 777, " " * 2500, "á ﬁ Å     ﻿", "\x00\x01\x7f",
           "don't we'll it's I'M", "ὕδωρ привет עברית العربية", "\U0001f9ff͸"]


def test_groups_of_awkward_texts(libs, tk):
    for t in AWKWARD:
        x = L.align(tk, [t])
        want = groups_of(t, libs)
        got = [(x.a[x.group_a == g].tolist(), x.b[x.group_b == g].tolist()) for g in range(len(x.n_a))]
        assert got == [tuple(w) for w in want], t


def test_texts_of_one_batch_do_not_mix(libs, tk):
    texts = [None, "", *AWKWARD, None, "end"]
    x = L.align(tk, texts)
    assert np.bincount(x.text, minlength=len(texts)).tolist() == [len(groups_of(t, libs)) for t in texts]


def test_both_encoders_of_a_agree(libs, tk):
    rng = random.Random(1)
    plain = [chr(c) for c in [*range(0x1c), *range(0x20, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205f), *range(0x20a0, 0x20b6)]]
    for _ in range(3000):
        t = "".join(rng.choice(plain) if rng.random() < 0.5 else rng.choice("aeinrst  .,'0\n") for _ in range(rng.randint(1, 80)))
        assert not L._OTHER.search(t)
        assert tk.fast.encode_ordinary(t) == libs[0].encode(t, add_special_tokens=False).ids, t


def test_pointer_jumping_on_random_cuts():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40, 400):
        for _ in range(20):
            a, b = (np.append(np.sort(rng.choice(n, rng.integers(0, n), replace=False)) + 0, n) for _ in range(2))
            a, b = a[a > 0], b[b > 0]
            common = np.intersect1d(a, b)
            last_a, last_b = L.terminals(a, b)
            assert (b[last_a] == common[np.searchsorted(common, a)]).all()
            assert (b[last_b] == common[np.searchsorted(common, b)]).all()


def test_links_of_a_large_group(tk):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 50, 300), rng.integers(0, 40, 200)
    one = L.Aligned(np.append(a, 7), np.append(b, 9), np.append(np.zeros(300, int), 1), np.append(np.zeros(200, int), 1),
                    np.array([300, 1]), np.array([200, 1]), np.array([1, 1]), 3)
    of, x, y, n = L.links(one, tk)
    want = Counter((i, j) for i in a.tolist() for j in b.tolist())
    want[7, 9] += 1
    assert set(of.tolist()) == {1} and dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == want


def test_query(spark, libs):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    got = QUERIES["op11_pointer_jumping_alignment"](spark, SF)
    assert got.columns == COLS
    assert Counter(map(tuple, got.collect())) == brute(rows, libs)


def test_rare_pairs_through_the_join(spark, libs, monkeypatch, many_parts):
    monkeypatch.setattr(L, "FREQUENT", 5)
    rows = [(i, t) for i, t in enumerate(AWKWARD + ["the river and the stone", "the stone", "The window."] * 4)]
    got = L.score_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(map(tuple, got.collect())) == brute(rows, libs)


def test_awkward_rows(spark, edge, libs, many_parts):
    got = L.score_links(edge)
    assert Counter(map(tuple, got.collect())) == brute([(r[0], r[1]) for r in edge_rows()], libs)


def test_no_rows(spark, nothing):
    assert L.score_links(nothing).columns == COLS and not L.score_links(nothing).collect()


def test_groups_as_columns(spark, edge, libs):
    got = L.with_groups(edge).collect()
    want = Counter(repr([tuple(g) for g in groups_of(r[1], libs)]) for r in edge_rows())
    assert len(got) == len(edge_rows()) and all(c in got[0].asDict() for c in EXTRA)
    mine = Counter()
    for r in got:
        own = [([], []) for _ in range(1 + max(r.a_groups, default=-1))]
        for side, ids, groups in ((0, r.a_ids, r.a_groups), (1, r.b_ids, r.b_groups)):
            for i, g in zip(ids, groups):
                own[g][side].append(i)
        mine[repr(own)] += 1
    assert mine == want
