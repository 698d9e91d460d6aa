"""Rounding rules.

``half_even_2`` follows numeric array libraries: scale by 100, round ties to even, scale back.
Spark's own ``round`` rounds ties away from zero and is used where the rule is SQL's ROUND.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed-point scale for averaging values that are themselves averages.
AVERAGE_SCALE = 1_000_000_000


def half_even_2(col: Column) -> Column:
    return F.rint(col * F.lit(100.0)) / F.lit(100.0)


def fixed_point(col: Column, scale: int = AVERAGE_SCALE) -> Column:
    """A double as a BIGINT count of 1/scale units, so that sums do not depend on row order."""
    return F.rint(col * F.lit(float(scale))).cast("bigint")


def mean_of_fixed(col: Column, scale: int = AVERAGE_SCALE) -> Column:
    """Aggregate: mean of a ``fixed_point`` column, NULLs skipped."""
    total = F.sum(col).cast("double") / F.lit(float(scale))
    return total / F.nullif(F.count(col), F.lit(0))
