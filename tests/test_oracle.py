"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from sessionrate.plans.oracle import ORACLE
from sessionrate.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _norm(v, digits):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.{digits}g}")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    digits = {f.name: (6 if f.dataType.simpleString() == "float" else 12) for f in df.schema.fields}
    got = Counter(tuple(_norm(r[c], digits[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = Counter(tuple(_norm(dict(zip(rel.columns, r))[c], digits[c]) for c in cols)
                   for r in rel.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["session", "window_start_ms", "window_end_ms", "metric", "value"]
    assert df.count() > 0
