"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_lower(col: Column) -> Column:
    """Lower case without any leading or trailing white space (``trim`` removes blanks only)."""
    return F.lower(F.regexp_replace(col, r"^\s+|\s+$", ""))
