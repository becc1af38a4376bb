import hashlib
from collections import Counter

import pytest

from sessionrate.llm import sharding as S

from .conftest import EXTRA


def test_permutations_and_fair_shares():
    names = [f"s{i}" for i in range(7)]
    table = S.lookup_table(names, 211)
    counts = Counter(table)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    start, stride = S.preference("s0", 211)
    assert sorted((start + i * stride) % 211 for i in range(211)) == list(range(211))


def test_weights_scale_shares():
    counts = Counter(S.lookup_table(["big", "small"], 1009, weights=[3, 1]))
    assert abs(counts[0] / 1009 - 0.75) < 0.01


def test_removing_a_shard_moves_little_else():
    names = list(S.SHARDS)
    a, b = S.lookup_table(names), S.lookup_table(names[:-1])
    moved = sum(x != y for x, y in zip(a, b) if x != len(names) - 1)
    assert moved / S.TABLE_SIZE < 0.05


@pytest.mark.parametrize("shards,size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_tables_are_refused(shards, size):
    with pytest.raises(ValueError):
        S.lookup_table(shards, size)


def test_awkward_rows(edge, nothing):
    out = S.place(edge).collect()
    assert len(out) == edge.count()
    table = S.lookup_table()
    for r in out:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:12], 16) % S.TABLE_SIZE
        assert (r.slot, r.shard) == (slot, S.SHARDS[table[slot]])
    assert S.place(edge).columns == [c for c in edge.columns if c != "shard"] + ["slot", "shard"]
    assert S.place(nothing).count() == 0


def test_files_hold_each_row_once_in_its_shard(spark, edge, tmp_path):
    placed = S.place(edge.drop(*EXTRA))
    S.write_shards(placed, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    key = ["doc_id", "text", "shard"]
    assert Counter(map(tuple, back.select(key).collect())) == Counter(map(tuple, placed.select(key).collect()))
