"""Connected components of an edge table by alternating stars.

Each round joins every node's neighbours to the smallest of them (large star), then each
node's smaller neighbours (small star); the edge set shrinks to one star per component in
a logarithmic number of rounds.  Rounds are written to the shared checkpoint folder; only
a row count and a checksum of the edges come to the driver.  A node of high degree meets
its minimum in a plain join, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionrate.llm.common import materialize

MAX_ROUNDS = 60


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _both(edges: DataFrame) -> DataFrame:
    turned = F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.select(F.inline(turned))


def _least(edges: DataFrame) -> DataFrame:
    return (edges.groupBy(F.col("u").alias("_n")).agg(F.min("v").alias("_m"))
                 .select("_n", F.least("_n", "_m").alias("_m")))


def _star(edges: DataFrame) -> DataFrame:
    """Large star, then small star; edges have u > v afterwards."""
    both = _both(edges)
    large = (both.join(_least(both), F.col("u") == F.col("_n")).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("_m").alias("v")).filter("u <> v").distinct())
    least = _least(large)                       # u > v already: neighbours are smaller
    joined = large.join(least, F.col("u") == F.col("_n"))
    own = least.select(F.col("_n").alias("u"), F.col("_m").alias("v"))
    small = joined.select(F.greatest("v", "_m").alias("u"), F.least("v", "_m").alias("v"))
    return small.unionByName(own).filter("u <> v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node that has an edge and is not its component's smallest.

    ``edges`` has two comparable columns; direction, repeats and loops do not matter.
    """
    a, b = edges.columns[:2]
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                           .filter("u <> v").distinct(), name)
    mark = _checksum(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        now = materialize(_star(now), name)
        last, mark = mark, _checksum(now)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
