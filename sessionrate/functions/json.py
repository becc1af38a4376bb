"""Parse-once helper for VARIANT based checks.

Catalyst pushes filters below projections by substituting aliases, so a filter on a
column derived from ``try_parse_json(text)`` would re-parse the text once per
reference (dozens of times for a schema check).  Producing the variant through a
one-element ``explode`` makes it a generator output: it is computed once per row,
inside whole-stage codegen, and no filter can be pushed below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: path of the text itself in the variant of :func:`with_variant`
EVENT_ROOT = "$.e"


def wrapped(text: Column) -> Column:
    """``{"e": <text>, "end": 1}``: valid JSON with both members exactly if ``text`` is one JSON
    value.  (Spark's JSON readers stop after the first value and ignore what follows.)"""
    return F.concat(F.lit('{"e":'), text, F.lit('\n,"end":1}'))


def with_variant(df: DataFrame, text_col: str, out_col: str = "__v") -> DataFrame:
    """``df`` plus ``out_col``: the variant of the wrapped text (NULL when malformed or
    followed by more text), with the text's value at ``EVENT_ROOT``."""
    v = F.try_parse_json(wrapped(F.col(text_col)))
    parsed = df.select("*", F.explode(F.array(v)).alias(out_col))
    one = F.try_variant_get(F.col(out_col), "$.end", "int") == 1
    return parsed.withColumn(out_col, F.when(one, F.col(out_col)))


def is_object(v: Column, path: str = EVENT_ROOT) -> Column:
    """The variant member at ``path`` is a JSON object (not absent, null, array, scalar).

    Casting to a one-field struct succeeds only for objects; far cheaper than
    ``schema_of_variant``, which renders the whole nested type as a string.
    """
    return F.try_variant_get(v, path, "struct<__probe: variant>").isNotNull()
