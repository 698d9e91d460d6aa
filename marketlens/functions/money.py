"""Money as whole cents.

Prices arrive as doubles with two decimals. Adding doubles gives a result that depends on how
Spark happens to split the rows, so amounts are added as BIGINT cents: exact, the same on every
run, and a primitive hash-aggregation buffer. Results go back to DOUBLE once, at the end.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(col: Column) -> Column:
    """NaN counts as missing; plain comparisons would rank it above every number."""
    return F.when(~F.isnan(col), col)


def cents(name: str) -> Column:
    """Whole cents; NULL for amounts that are no number or beyond all whole numbers."""
    return F.rint(nan_to_null(F.col(name).cast("double")) * 100).try_cast("bigint")


def from_cents(col: Column) -> Column:
    return col.cast("double") / F.lit(100.0)


def per(total: Column, count: Column) -> Column:
    """Average from an exact total and a row count; NULL when there are no rows."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``part * 100.0 / whole``; NULL when the whole is zero."""
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))
