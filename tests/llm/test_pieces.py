import math
import random
import struct

import numpy as np
import pytest
import sentencepiece

from sessionrate.llm import piece_model as P
from sessionrate.llm import sentencepieces as S

from .conftest import edge_rows, prose


@pytest.fixture(scope="module")
def data():
    return S.read_model()


@pytest.fixture(scope="module")
def enc(data):
    return S.encoder(data)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


TEXTS = ["", " ", "  ", "a", "  hello   world ", "\n\n x\ty", "▁▁ a▁b", "日本語テキスト 한국어 😀é", " " * 40 + "x" + " " * 17,
         "a" * 900, "ab" * 700 + " " + "the" * 400, "!!!??...   ----====", "12345 6789 3.14", "\0\x01 \x7f", "don't \"stop\""]


def test_ids_equal_the_librarys(enc, library):
    rng = random.Random(0)
    letters = list("abcdefghijklmnopqrstuvwxyz  ABC.,éßñ'\n0123456789-=/")
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice(enc.model.texts[259:]) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    texts += [prose(i, 80) for i in range(20)]
    got, want = enc.encode(texts), library.encode(texts)
    for text, a, b in zip(texts, got, want):
        assert a.tolist() == b, text
        assert enc.decode(b) == library.decode(b)
        assert enc.decode(b) == text.replace("▁", " ")


def test_neighbours_stay_apart_as_merging_says(enc):
    rng, m = random.Random(1), enc.model
    rank = {m.texts[i]: int(m.rank[i]) for i in range(len(m.texts)) if m.rank[i] >= 0}
    good = [i for i in range(len(m.texts)) if m.whole[i]]
    pairs = [(rng.choice(good), rng.choice(good)) for _ in range(3000)]
    got = m.stay_apart(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    for (a, b), apart in zip(pairs, got):
        assert apart == (P.bpe(m.texts[a] + m.texts[b], rank) == [m.texts[a], m.texts[b]])


def model_bytes(pieces, kind):
    """A small model file: pieces (text, score, type)."""
    def number(field, value):
        out, tag = b"", field << 3
        for v in (tag, value):
            while v > 127:
                out, v = out + bytes([v & 127 | 128]), v >> 7
            out += bytes([v])
        return out

    def block(field, raw):
        size = b""
        n = len(raw)
        while n > 127:
            size, n = size + bytes([n & 127 | 128]), n >> 7
        return bytes([field << 3 | 2]) + size + bytes([n]) + raw

    out = b""
    for text, score, type_ in pieces:
        out += block(1, block(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + number(3, type_))
    out += block(2, number(3, kind) + number(4, len(pieces)))
    return out + block(3, block(1, b"identity") + number(3, 1) + number(4, 0) + number(5, 1))


def unigram(seed):
    rng = random.Random(seed)
    texts = {c for c in "abc▁"} | {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(30)}
    texts |= {"▁" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(12)}
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    return pieces + [(t, -rng.uniform(1, 9), 1) for t in sorted(texts)]


def brute_unigram(word, score):
    """Best sum of scores over all cuts."""
    best = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        best[j] = max((best[i] + score.get(word[i:j], -math.inf) for i in range(max(0, j - 6), j)), default=-math.inf)
    return best[-1]


@pytest.mark.parametrize("seed", range(4))
def test_unigram_models(seed):
    pieces = unigram(seed)
    data = model_bytes(pieces, P.UNIGRAM)
    enc = S.Encoder(P.PieceModel.parse(data))
    score = {t: struct.unpack("<f", struct.pack("<f", s))[0] for t, s, k in pieces if k == 1}
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 30))) for _ in range(200)] + ["abc" * 300]
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text, ids in zip(texts, enc.encode(texts)):
        assert enc.decode(ids) == text
        words = enc.cut.findall("▁" + text.replace(" ", "▁"))
        if "▁▁" not in "▁" + text.replace(" ", "▁") and not text.endswith(" "):
            want = sum(brute_unigram(w, score) for w in words)
            assert sum(score[enc.model.texts[i]] for i in ids) == pytest.approx(want)
            library = own.encode(text)
            assert sum(score[enc.model.texts[i]] for i in library) == pytest.approx(want, rel=1e-5)
    assert enc.encode(["xa"])[0].tolist()[1:2] == [0] or 0 in enc.encode(["xa"])[0].tolist()


def test_unsupported_models_are_refused(data):
    with pytest.raises(ValueError):
        P.PieceModel.parse(model_bytes(unigram(0), 3))
    with pytest.raises(ValueError):
        P.PieceModel.parse(model_bytes(unigram(0) + [("user", 0.0, 4)], P.UNIGRAM))


def test_full_caches_change_nothing(data, library, monkeypatch):
    monkeypatch.setattr(S, "CACHE_WORDS", 3)
    enc = S.Encoder(P.PieceModel.parse(data))
    for text in TEXTS:
        assert enc.encode([text])[0].tolist() == library.encode(text)


def test_awkward_rows(edge, nothing, data, library):
    out = S.with_ids(edge, data, check=True)
    assert out.columns == [c for c in edge.columns if c != "ids"] + ["ids", "n_ids", "round_trip"]
    got = out.collect()
    assert len(got) == len(edge_rows())
    for r in got:
        if r.text is None:
            assert r.ids is None and r.n_ids is None and r.round_trip is None
        else:
            assert r.ids == library.encode(r.text) and r.n_ids == len(r.ids) and r.round_trip
    back = S.decoded(out, data)
    assert all(r.decoded == (None if r.text is None else r.text.replace("▁", " ")) for r in back.collect())
    assert S.with_ids(nothing, data).count() == 0 and S.decoded(S.with_ids(nothing, data), data).count() == 0
