"""Operator 1: placement of rows on shards through a permutation-filled lookup table.

Every shard has a permutation of the slots of a prime-sized table (start and stride from
two digests of its name).  The shards take turns; on its turn a shard claims the next
still free slot of its permutation.  The finished table has ``size`` entries whatever the
data is, so it is broadcast, and placing a row is one probe: ``table[hash(key) % size]``.
Shares differ by at most one slot per shard (equal weights), and removing a shard moves
hardly any slot besides its own.

Defined cases: a NULL key is the empty key; equal keys always share a shard; an empty
table gives an empty result; columns of the input named like an output column are
replaced.  Placement is a map step without a shuffle, so a hot key costs nothing here;
:func:`write_shards` deals the rows of one shard to several files by a row hash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: prime, over 100 slots per shard (shares then differ by under one per cent)
TABLE_SIZE = 3203
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def preference(name: str, size: int) -> tuple[int, int]:
    """Start and stride of a shard's permutation of ``range(size)`` (``size`` prime)."""
    return _digest(name + "/start") % size, _digest(name + "/stride") % (size - 1) + 1


def lookup_table(shards=SHARDS, size: int = TABLE_SIZE, weights=None) -> list[int]:
    """Slot -> index into ``shards``.  ``weights`` (0 < w) scale how often a shard claims."""
    shards = list(shards)
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be a non-empty list of distinct names")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime of at least the number of shards")
    weights = [1.0] * len(shards) if weights is None else [float(w) for w in weights]
    if len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("one positive weight per shard")
    top = max(weights)
    prefs = [preference(s, size) for s in shards]
    tried, credit, table, free = [0] * len(shards), [0.0] * len(shards), [-1] * size, size
    while free:
        for i, (start, stride) in enumerate(prefs):
            credit[i] += weights[i] / top
            if credit[i] < 1.0 - 1e-9 or not free:
                continue
            credit[i] -= 1.0
            while True:
                slot = (start + tried[i] * stride) % size
                tried[i] += 1
                if table[slot] < 0:
                    table[slot] = i
                    free -= 1
                    break
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % F.lit(size)


def table_frame(spark: SparkSession, tables: dict[str, list[str]], size: int) -> DataFrame:
    """(slot, one column of shard names per entry of ``tables``), ``size`` rows."""
    named = {c: [s[i] for i in lookup_table(s, size)] for c, s in tables.items()}
    rows = [(slot, *[named[c][slot] for c in named]) for slot in range(size)]
    schema = "_slot long, " + ", ".join(f"`{c}` string" for c in named)
    return spark.createDataFrame(rows, schema)


def place(df: DataFrame, key: str = "doc_id", shards=SHARDS, size: int = TABLE_SIZE,
          also: dict[str, list[str]] | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` (and one column per alternative shard list in ``also``)."""
    tables = {"shard": list(shards), **(also or {})}
    clash = {"slot", *map(str.lower, tables)} - {key.lower()}
    kept = [c for c in df.columns if c.lower() not in clash]
    rows = df.select(F.struct(*kept).alias("_row"), slot_of(df[key], size).alias("_at"))
    table = table_frame(df.sparkSession, tables, size)   # fixed size: `size` rows
    out = rows.join(F.broadcast(table), rows["_at"] == table["_slot"])
    return out.select("_row.*", F.col("_at").alias("slot"), *tables)


def write_shards(placed: DataFrame, path: str, key: str = "doc_id", files: int = 8) -> None:
    """One folder per shard; a shard's rows are dealt to ``files`` tasks by a row hash."""
    part = F.pmod(F.xxhash64(F.col(key), *[c for c in placed.columns if c != key]), F.lit(files))
    n = files * max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed.repartition(n, F.col("shard"), part).write.partitionBy("shard").parquet(path)
