from sessionrate.llm import common as C


def test_text_functions_get_bounded_portions(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "TEXT_CHARS", 10)
    texts = ["a" * 4, None, "b" * 5, "c" * 30, "", "d" * 10, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["i", "t"])
    got = [p.column(1).to_pylist() for p in C.portions(batch, "t")]
    assert [t for p in got for t in p] == texts
    assert [sum(len(t or "") for t in p) for p in got] == [9, 30, 10, 1]
    assert list(C.portions(batch.slice(0, 0), "t")) == []


def test_text_functions_replace_clashing_columns(spark):
    df = spark.createDataFrame([(1, "ab", "old"), (2, None, "old")], "id long, text string, N string")
    out = C.map_text(df, lambda ts: {"n": [len(t or "") for t in ts]}, "n long")
    assert out.columns == ["id", "text", "n"] and [tuple(r) for r in out.orderBy("id").collect()] == [(1, "ab", 2), (2, None, 0)]


def test_hash_is_stable_and_takes_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, "")], "a long, b string")
    got = [r.h for r in df.select(C.hash01("a", "b", seed=3).alias("h")).collect()]
    assert got[0] == got[1] and 0 <= got[0] < 2 ** 52
