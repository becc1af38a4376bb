"""The registered queries on the smallest tables: against SQL where there is any, else plain code."""

import os
import zlib
from collections import Counter

import duckdb
import pytest
import sentencepiece

import __spark_entry__ as E
from sessionrate.llm import mixing, sentencepieces
from sessionrate.llm.oracle import ORACLE
from sessionrate.llm.queries import QUERIES

from .test_lz import check_against_plain_code
from .test_mixing import brute as brute_copies
from .test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def run(spark, number, sf=SF):
    name = next(k for k in QUERIES if k.startswith(f"op{number}_"))
    return E.queries()[name](spark, sf)


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    want = Counter(tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall())
    assert sorted(names) == cols and Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_op2(spark, docs):
    want = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in docs])
    got = run(spark, 2)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == Counter((k, f"{f:016x}", c) for k, f, c in want)


def test_op4(spark, docs):
    rows = sorted(((r.doc_id, r.text) for r in docs), reverse=True)
    got = run(spark, 4)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                           "near_next"]
    got = [tuple(r) for r in got.collect()]
    check_against_plain_code(rows, got)
    assert sum(r[5] > r[6] for r in got) > 0.9 * len(got)


def test_op5(spark):
    got = run(spark, 5, MID).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.95 * len(held)
    assert {r.lang_pred for r in got} <= set(truth.values()) | {"und"}


def test_op6(spark, docs):
    got = {r.doc_id: r for r in run(spark, 6).collect()}
    assert len(got) == len(docs)
    for r in docs:
        assert (got[r.doc_id].text == r.text) == (got[r.doc_id].n_pseudonyms == 0)


def test_op8(spark, docs):
    got = {r.doc_id: r.copies for r in run(spark, 8).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs]
    total = sum(len(r.text.split()) for r in docs)
    light = spark.createDataFrame([(r.source, len(r.text.split())) for r in docs], "source string, tokens long")
    sources = light.groupBy("source").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")
    mix = mixing.solve(sources, 0.99, 4.0, "corpus")
    assert got == brute_copies(rows, mix.exponent, total)


def test_op9(spark, docs):
    got = run(spark, 9)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    held = [r for r in got.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op10(spark, docs):
    got = run(spark, 10).collect()
    assert len(got) == len(docs) and all(r.round_trip for r in got)
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    assert {r.doc_id: list(r.ids) for r in got} == {r.doc_id: lib.encode(r.text) for r in docs}
