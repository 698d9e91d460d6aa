"""Hot keys: keys that hold so many rows that no single task should see all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/1000 of the rows, so there are never 1000 of them and the
# list can be broadcast whatever the size of the data.
HOT_SHARE = 1000


def same_key(keys: list[str], prefix: str) -> Column:
    """Equality of ``keys`` with their prefixed copies; NULL equals NULL."""
    condition = F.col(keys[0]).eqNullSafe(F.col(prefix + keys[0]))
    for key in keys[1:]:
        condition = condition & F.col(key).eqNullSafe(F.col(prefix + key))
    return condition


def hot_keys(counts: DataFrame, n: str) -> DataFrame:
    """The hot ones among keys with their row counts ``n``; fewer than HOT_SHARE rows."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) * HOT_SHARE > total)


def members_of_repeated_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key (NULLs compare equal) occurs more than once.

    Groups are counted with map-side combine. Rows of hot keys are picked by a broadcast of the hot
    list and never shuffled; the others meet the repeated keys in a shuffle join, where no key holds
    more than 1/HOT_SHARE of the rows. A window count would bring each group into one task instead.
    """
    prefix = "_key_"
    counts = df.groupBy(*[F.col(key).alias(prefix + key) for key in keys]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    more_than_one = F.col("_n") > 1
    on = same_key(keys, prefix)
    hot = F.broadcast(hot_keys(counts, "_n").filter(more_than_one))
    hot_rows = df.join(hot, on, "left_semi")
    other_rows = df.join(hot, on, "left_anti").join(counts.filter(more_than_one), on, "left_semi")
    return hot_rows.unionByName(other_rows)
