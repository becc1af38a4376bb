"""Column predicates used by the filters and the rate operators.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen and are pushed below the window expansion by the optimizer.
A NULL input never matches (the reference would fail on it; we treat it as "no").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def type_is(col, value: str, case_sensitive: bool = False,
            missing_as_empty: bool = False) -> Column:
    """``col`` equals ``value``; case-insensitive by default.

    ``missing_as_empty`` reads a NULL/absent member as "" first (the Python job's
    ``row.get("type", "")``), so a NULL compares false instead of NULL.
    """
    c = _col(col)
    if missing_as_empty:
        c = F.coalesce(c, F.lit(""))
    if case_sensitive:
        return c == F.lit(value)
    return F.lower(c) == F.lower(F.lit(value))


def is_blank_text(text: str | None) -> bool:
    """A setting that is missing, empty or only white space."""
    return not (text or "").strip()


def match_flag(col, value: str, case_sensitive: bool = False) -> Column:
    """``type_is`` folded to a non-null boolean (NULL -> false), for ``count_if``."""
    return F.coalesce(type_is(col, value, case_sensitive), F.lit(False))
