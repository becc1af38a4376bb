from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline as P
from sessionrate.llm import pii, quality, sentencepieces
from sessionrate.llm.common import materialize, read_table

from .conftest import edge_rows
from .test_mixing import brute as brute_copies
from .test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = read_table(spark, SF, "documents")
    out = [docs.collect()]
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        out.append(docs.collect())
        assert name == P.STAGES[-1][0] or docs.columns == COLS
    return out


def test_quality_keeps_what_the_rules_keep(steps):
    want = {}
    for r in steps[0]:
        verdict, text = quality.judge(r.text)
        if verdict["kept"]:
            want[r.doc_id] = (r.doc_id, text, r.lang, r.source, len(text))
    assert Counter(map(tuple, steps[1])) == Counter(want.values())
    assert 0 < len(steps[1]) < len(steps[0])


def test_one_document_of_each_group_stays(steps):
    groups = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in steps[1]])
    reps = {least for _, _, least in groups}
    assert Counter(map(tuple, steps[2])) == Counter(tuple(r) for r in steps[1] if r.doc_id in reps)
    assert len(steps[2]) < len(steps[1])


def test_pseudonyms_replace_values_only(spark, steps):
    df = spark.createDataFrame(steps[2])
    want = {r.doc_id: r.text for r in pii.pseudonymise(df, key=pii.PUBLIC_TEST_KEY).collect()}
    assert {r.doc_id: r.text for r in steps[3]} == want
    assert all(r.n_chars == len(r.text) for r in steps[3])
    changed = [a.doc_id for a in steps[2] if want[a.doc_id] != a.text]
    assert changed and len(steps[3]) == len(steps[2])


def test_mixture_covers_every_document(steps):
    copies = Counter(r.doc_id for r in steps[4])
    assert set(copies) == {r.doc_id for r in steps[3]} and max(copies.values()) <= P.MAX_REPEAT
    tokens = Counter()
    for r in steps[3]:
        tokens[r.source] += len(r.text.split())
    total = sum(tokens.values())
    rows = [(r.doc_id, r.text, r.source) for r in steps[3]]
    fits = []
    for step in range(1001):
        a = step / 1000
        w = {s: (t / total) ** a for s, t in tokens.items()}
        budget = max(t / (w[s] / sum(w.values())) for s, t in tokens.items())
        fits.append(sum(abs(copies[k] - v) for k, v in brute_copies(rows, a, budget).items()))
    assert min(fits) <= 2 * len(tokens)                    # the exponent is known to 1/1000 here


def test_ids_equal_the_librarys(steps):
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    want = Counter((r.doc_id, tuple(lib.encode(r.text))) for r in steps[4])
    assert Counter((r.doc_id, tuple(r.ids)) for r in steps[5]) == want


def test_run_is_the_stages(spark, steps):
    got = P.run(spark, SF)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == Counter((r.doc_id, tuple(r.ids)) for r in steps[5])


def test_stages_on_awkward_rows_and_none(spark, edge, nothing):
    for docs in (edge, nothing):
        for name, stage in P.STAGES:
            out = stage(spark, docs, None)
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns
            docs = materialize(out, "test-stage")
            if name == P.STAGES[0][0]:
                good = [r for r in edge_rows() if quality.judge(r[1])[0]["kept"]]
                assert docs.count() in (0, len(good))
        assert docs.count() >= 0
    # stages alone take any rows
    for name, stage in P.STAGES:
        assert stage(spark, edge, None).count() >= 1
