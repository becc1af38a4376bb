"""Shared helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionrate.session import ensure_utc, scratch_path

DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
#: rows per Arrow batch: bounds a Python worker's batch to about 1000 texts
ARROW_ROWS = 1000
#: characters that a text function is given at once (or one longer text)
TEXT_CHARS = 4_000_000


def prepare(spark: SparkSession) -> None:
    """Session settings every operator relies on (UTC, bounded Arrow batches)."""
    ensure_utc(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can reach, so a lost executor costs a
    re-read and not a re-computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash01(*cols: Column | str, seed: int = 0) -> Column:
    """Uniform hash of ``cols`` as a non-negative long (52 bits), stable across engines.

    Null members count as the empty text.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c) if isinstance(c, str) else c,
                                            F.lit("")).cast("string") for c in cols])
    digest = F.md5(F.concat(F.lit(f"{seed}:"), text))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def portions(batch, column: str):
    """A batch in slices of about TEXT_CHARS bytes (or list members) of ``column``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    start = total = 0
    for i, n in enumerate(pc.fill_null(length(values), 0).to_pylist()):
        if total and total + n > TEXT_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def map_text(df: DataFrame, fn, fields: str, text: str = "text", drop: tuple = ()) -> DataFrame:
    """Add columns computed from the text column, one Arrow batch at a time.

    ``fn(texts)`` takes a list of ``str | None``, of about TEXT_CHARS characters at most,
    and returns a dict of equally long lists (or Arrow arrays), one per member of ``fields``
    (a DDL string).  Input columns named
    like a new one (in any case) are replaced; ``drop`` names columns that are not carried.
    """
    new = T.StructType.fromDDL(fields)
    gone = {f.name.lower() for f in new} | {c.lower() for c in drop}
    kept = [c for c in df.columns if c.lower() not in gone]
    source = "_text_in"
    rows = df.select(*kept, F.col(text).alias(source))
    out = T.StructType([f for f in rows.schema if f.name != source] + list(new))
    kinds = to_arrow_schema(new)

    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in portions(whole, source)):
            at = batch.schema.get_field_index(source)
            got = fn(batch.column(at).to_pylist())
            cols = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            for f in kinds:
                x = got[f.name]
                cols.append(x if isinstance(x, pa.Array) else pa.array(x, type=f.type))
                names.append(f.name)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(run, out)
