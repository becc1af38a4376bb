"""Number formatting with the rounding of a C/Go ``%.3f``.

``printf``-style ``%.3f`` rounds the *exact* binary value of the double, half to even.
Spark's ``format_string('%.3f')`` rounds the shortest decimal representation half-up
instead (1.0005 -> "1.001", while the exact binary value 1.000499999... gives
"1.000").  ``format_number(x, '0.000')`` formats through ``java.text.DecimalFormat``,
which rounds the exact binary value half-even, but keeps the sign of a value that
rounds to zero only for the two ties +-0.0005; those are fixed explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt3(col) -> Column:
    """Render a double like Go's ``fmt.Sprintf("%0.3f", x)``."""
    x = F.col(col) if isinstance(col, str) else col
    plain = F.call_function("format_number", x, F.lit("0.000"))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("NaN"))
            .when(x == F.lit(float("inf")), F.lit("+Inf"))
            .when(x == F.lit(float("-inf")), F.lit("-Inf"))
            .when(x == F.lit(0.0005), F.lit("0.001"))
            .when(x == F.lit(-0.0005), F.lit("-0.001"))
            .otherwise(plain))
