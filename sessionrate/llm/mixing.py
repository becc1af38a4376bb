"""Operator 8: mixing sources to target weights by temperature.

A source with token share ``p`` gets the weight ``p**a / sum(p**a)``.  The exponent ``a``
in [0, 1] (1: as found, 0: uniform) is bisected: the largest one whose weights reach the
target entropy (a fraction of the uniform entropy), raised further where it would repeat
a source more often than ``max_repeat`` times.  The weights are then realised exactly in
tokens: a source whose budget is ``q`` times its tokens is read ``floor(q)`` times whole,
and once more up to the rest of the budget in the order of a keyed permutation.

The permutation is dealt in blocks (ranges of the permuted order, about ``block_rows``
documents each): whole blocks are taken by a running sum over block totals, only the one
block in which a source's budget ends is ranked by place, and of rows with equal ids only one
range of text hashes (a 1,024th).  So no source, however hot,
is sorted or held in one task.  What reaches the driver are sums over all sources, a fixed
number per pass.

Defined cases: NULL source is the source ""; NULL text has no tokens; a source without
tokens is read once; repeated rows are rows of their own; no documents give no rows; extra
columns are carried, except those named like an output column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionrate.llm.common import hash01, materialize

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 1000
#: source tables up to this many rows are broadcast (about 100 bytes a row)
BROADCAST_ROWS = 50_000
_POINTS = 16           # exponents tried at once: a 16-fold bisection per pass
_PASSES = 8
_SPAN = float(2 ** 52)


@dataclass(frozen=True)
class Mix:
    exponent: float
    budget: int        # tokens of the mixture
    n_sources: int
    entropy: float     # of the weights, natural log


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _light(docs: DataFrame, source: str, text: str, key: str, tokens: Column | None) -> DataFrame:
    """Source, row identity and tokens of every document, without its text."""
    tokens = count_tokens(F.col(text)) if tokens is None else tokens
    return docs.select(*_identity(source, text, key), tokens.alias("_tokens"))


def _identity(source: str, text: str, key: str) -> list[Column]:
    return [F.coalesce(F.col(source), F.lit("")).alias("_source"),
            F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
            F.xxhash64(F.col(text)).alias("_text")]


def _at(sources: DataFrame, points: list[float], total: int) -> list[dict]:
    """For each exponent: sum of p**a, sum of p**a ln p, largest p**(a-1)."""
    p = F.col("tokens") / F.lit(float(total))
    aggs = []
    for i, a in enumerate(points):
        w = F.pow(p, F.lit(a))
        aggs += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(p)).alias(f"l{i}"),
                 F.max(F.pow(p, F.lit(a - 1.0))).alias(f"r{i}"),
                 F.min(F.pow(p, F.lit(a - 1.0))).alias(f"s{i}")]
    row = sources.filter("tokens > 0").agg(*aggs).first()
    out = []
    for i, a in enumerate(points):
        z = row[f"z{i}"]
        out.append({"a": a, "entropy": math.log(z) - a * row[f"l{i}"] / z,
                    "most": row[f"r{i}"] / z,        # repeats = most * budget / total
                    "least": row[f"s{i}"] / z})
    return out


def _bisect(sources: DataFrame, total: int, holds) -> float:
    """Largest exponent in [0, 1] for which ``holds``, which is monotone in the exponent
    (true at 0), to 16**-8; 1 where it holds there."""
    lo, hi = 0.0, 1.0
    for _ in range(_PASSES):
        points = [lo + (hi - lo) * i / _POINTS for i in range(_POINTS + 1)]
        ok = [holds(x) for x in _at(sources, points, total)]
        if ok[-1]:
            return hi
        k = max((i for i, good in enumerate(ok) if good), default=0)
        lo, hi = points[k], points[k + 1]
    return lo


def solve(sources: DataFrame, target_entropy: float | None, max_repeat: float | None,
          budget: int | str) -> Mix:
    """Exponent and token budget from the source table (source, tokens, rows).

    ``budget``: a number of tokens, ``"corpus"`` (as many as there are) or ``"cover"``
    (as few as read every source at least once; then ``max_repeat`` bounds the ratio of
    the most to the least repeated source).
    """
    head = sources.agg(F.sum("tokens").alias("t"), F.sum((F.col("tokens") > 0).cast("long")).alias("n")).first()
    total, n = int(head["t"] or 0), int(head["n"] or 0)
    if not total:
        return Mix(1.0, 0, 0, 0.0)

    def size(x):
        if budget == "cover":
            return total / x["least"]
        return total if budget == "corpus" else budget

    a = 1.0
    if target_entropy is not None and n > 1:
        want = target_entropy * math.log(n) - 1e-12
        a = _bisect(sources, total, lambda x: x["entropy"] >= want)
    if max_repeat is not None:
        over = lambda x: x["most"] * size(x) / total > max_repeat * (1 + 1e-12)
        if over(_at(sources, [a], total)[0]):
            # repeats fall as the exponent rises: smallest exponent within the limit
            a = max(a, min(1.0, _bisect(sources, total, over) + 16.0 ** -_PASSES))
    a = round(a, 6)
    x = _at(sources, [a], total)[0]
    return Mix(a, int(round(size(x))), n, x["entropy"])


def plan(docs: DataFrame, source="source", text="text", key="doc_id",
         target_entropy: float | None = 0.95, max_repeat: float | None = 4.0,
         budget: int | str = "corpus", tokens: Column | None = None, seed: int = 0,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per source: _source, tokens, quota (tokens of its budget), full (whole
    reads) and the place in the permuted order where its last, partial read ends."""
    light = materialize(_light(docs, source, text, key, tokens), "mix-rows")
    sources = materialize(light.groupBy("_source").agg(
        F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "mix-sources")
    mix = solve(sources, target_entropy, max_repeat, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    z = (sources.filter("tokens > 0")
         .agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(mix.exponent))))
         .first()[0] or 1.0)
    share = F.col("tokens") / F.lit(float(total or 1))
    weight = F.pow(share, F.lit(mix.exponent)) / F.lit(z)
    empty = F.col("tokens") == 0
    quota = F.round(F.col("weight") * F.lit(float(mix.budget))).cast("long")
    if budget == "cover":
        quota = F.greatest(quota, F.col("tokens"))      # rounding must not cost a document
    full = F.when(empty, 1).otherwise(F.floor(F.col("quota") / F.col("tokens"))).cast("long")
    sources = (sources
               .withColumn("weight", F.when(empty, 0.0).otherwise(weight))
               .withColumn("quota", quota)
               .withColumn("full", full)
               .withColumn("rest", F.col("quota") - F.when(empty, 0).otherwise(F.col("full") * F.col("tokens")))
               .withColumn("blocks", F.ceil(F.col("rows") / F.lit(block_rows)).cast("long")))
    rows = with_place(_joined(light, sources, "blocks", "full", "rest"), seed)
    ends = Window.partitionBy("_source").orderBy("_block")
    blocks = (rows.groupBy("_source", "_block", "rest").agg(F.sum("_tokens").alias("n"))
              .withColumn("upto", F.sum("n").over(ends)))
    cut = blocks.groupBy("_source").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("_block", (F.col("upto") - F.col("n")).alias("before")))).alias("c"))
    cut = cut.select("_source", F.col("c._block").alias("cut_block"), F.col("c.before").alias("before"))
    sources = materialize(sources.join(cut, "_source", "left"), "mix-plan")
    # the one block per source in which its budget ends, row by row
    last = with_place(_joined(light, sources, "blocks", "full", "rest", "cut_block", "before"), seed)
    taken = cut_rows(last.filter(F.col("_block") == F.col("cut_block")))
    return materialize(sources.join(taken, "_source", "left"), "mix-plan")


def cut_rows(last: DataFrame) -> DataFrame:
    """Per source, the last place (cut_row) whose first row is still within the budget.

    Rows of equal ids share ``_u``; they are summed up by ranges of the text's hash, so that only
    the range in which the budget ends is ranked by place.  Equal rows are one place."""
    of = ["_source", "_u", "_key", "_range"]
    places = (last.withColumn("_range", F.shiftright("_text", 54))
                  .groupBy(*of, "_text", "before", "rest")
                  .agg(F.sum("_tokens").alias("n"), F.min("_tokens").alias("least")))
    order = Window.partitionBy("_source").orderBy("_u", "_key", "_range").rowsBetween(
        Window.unboundedPreceding, 0)
    ranges = (places.groupBy(*of, "before", "rest").agg(F.sum("n").alias("n"))
              .withColumn("start", F.col("before") + F.sum("n").over(order) - F.col("n"))
              .filter("start <= rest").select(*of, "start"))
    within = Window.partitionBy(*of).orderBy("_text").rowsBetween(Window.unboundedPreceding, 0)
    return (places.join(ranges, of)
            .withColumn("first", F.col("start") + F.sum("n").over(within) - F.col("n") + F.col("least"))
            .filter("first <= rest")
            .groupBy("_source").agg(F.max(F.struct("_u", "_key", "_text")).alias("cut_row")))


def with_place(rows: DataFrame, seed: int) -> DataFrame:
    """Add the place of a row in its source's permuted order and its block.  The
    permutation's key holds the number of whole reads before the partial one."""
    u = hash01("_key", "_source", "full", seed=seed)
    return rows.withColumn("_u", u).withColumn(
        "_block", F.floor(F.col("_u") / F.lit(_SPAN) * F.col("blocks")).cast("long"))


def _joined(rows: DataFrame, sources: DataFrame, *cols: str) -> DataFrame:
    small = sources.select("_source", *cols)
    if sources.count() <= BROADCAST_ROWS:      # one row per source; size checked
        small = F.broadcast(small)
    return rows.join(small, "_source")


def copies() -> Column:
    """How often a row (with its source's plan) is read."""
    place = F.struct("_u", "_key", "_text")
    before_cut = F.col("cut_block").isNull() | (F.col("_block") < F.col("cut_block"))
    partial = (F.col("rest") > 0) & (before_cut | (
        (F.col("_block") == F.col("cut_block")) & F.coalesce(place <= F.col("cut_row"), F.lit(False))))
    return (F.col("full") + partial.cast("long")).cast("long")


def _planned(docs: DataFrame, source="source", text="text", key="doc_id", seed: int = 0, **how) -> DataFrame:
    """Every row (``_row``) with its place, its source's plan and ``_copies``."""
    spec = plan(docs, source, text, key, seed=seed, **how)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *_identity(source, text, key))
    rows = with_place(_joined(rows, spec, "blocks", "full", "rest", "cut_block", "cut_row"), seed)
    return rows.withColumn("_copies", copies())


def _without(docs: DataFrame, *names: str) -> list[Column]:
    return [F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in names]


def mix_copies(docs: DataFrame, **how) -> DataFrame:
    """``docs`` plus ``copies``, the number of times each document is in the mixture."""
    return _planned(docs, **how).select(*_without(docs, "copies"), F.col("_copies").alias("copies"))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mixture itself: each document as often as it is read, ``epoch`` from 0, with the
    ``block`` and the ``place`` of the read in its source's permuted order.

    A source is read in the order (epoch, block, place); blocks are ranges of places, so a
    reader may take blocks one by one and sort each on its own.  Every epoch but the partial
    one, the last, is whole.  Rows of a source with one id share a place and follow each other."""
    rows = _planned(docs, **how).filter("_copies > 0")
    epochs = F.explode(F.sequence(F.lit(0), F.col("_copies").cast("int") - 1)).alias("epoch")
    return rows.select(*_without(docs, "copies", "epoch", "block", "place"), epochs,
                       F.col("_block").alias("block"), F.col("_u").alias("place"))
