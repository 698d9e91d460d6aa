"""Links between documents: pivots of groups, pairs that remain to be compared, and components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import staged

# Deltas are of one class if their sizes are between two neighbouring powers of this.
DELTA_STEP = 1.25


def with_pivots(rows: DataFrame) -> DataFrame:
    """segment, id, pivot: of rows id, segment those whose segment others have too, and its pivot.

    A segment's pivot is, of those that have it, the one that shares most segments with others.
    """
    shared = rows.groupBy("segment").agg(F.count("*").alias("holders")).filter("holders > 1")
    met = staged(rows.join(shared, "segment"), "shared-segments")
    central = met.groupBy("id").agg(F.sum("holders").alias("weight"))
    order = F.struct("weight", F.xxhash64("id"))
    pivots = met.join(central, "id").groupBy("segment").agg(F.max_by("id", order).alias("pivot"))
    return staged(met.drop("holders").join(pivots, "segment"), "pivots")


def delta_pairs(deltas: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs a < b of different roots that may be similar, of rows pivot, id, root, n, delta (its size), item.

    Around a pivot, a set of n shingles is given by the items of its delta: those that either it or the pivot has alone. A
    pivot without shingles makes whole sets of the deltas. Similar sets have items of their deltas in common.

    Each set's items are in one order: those of no other set around the pivot, then the others, rare ones first. If the
    first item that two deltas share is the ``left``-last of each, they share ``left`` at most, and have to share half
    of what their sizes exceed the allowed difference by. That bounds the deltas' sizes that an item can serve for.
    """
    counts = deltas.groupBy("pivot", "item").agg(F.count("*").alias("holders"), (F.min("root") != F.max("root")).alias("mixed"))
    counts = counts.filter("mixed").drop("mixed")
    who = ["pivot", "id", "root", "n", "delta"]
    ranked = deltas.join(counts, ["pivot", "item"]).groupBy(*who).agg(F.sort_array(F.collect_list(F.struct("holders", "item"))).alias("ranked"))
    rows = ranked.select(*who, F.size("ranked").alias("of"), F.posexplode("ranked").alias("at", "e"))
    rows = rows.select(*who, F.col("e.item").alias("item"), (F.col("of") - F.col("at")).alias("left"))
    allowed = F.floor(F.col("n") * (q - p) / p)
    least, most = F.greatest(F.col("delta") - allowed, F.lit(1)), 2 * F.col("left") - F.col("delta") + allowed
    rows = rows.withColumns({"least": least, "most": most}).filter("most >= least")

    def size_class(size: Column) -> Column:
        return F.floor(F.log(size) / float(np.log(DELTA_STEP)))

    rows = rows.withColumns({"own": size_class(F.col("delta")), "other": F.explode(F.sequence(size_class(F.col("least")), size_class(F.col("most"))))})
    key = ["pivot", "item", "small", "large"]
    rows = rows.withColumns({"small": F.least("own", "other"), "large": F.greatest("own", "other")})
    rows = staged(rows.select(*key, "own", F.struct("id", "root", "n", "delta", "left").alias("set")), "delta-prefixes")
    x = rows.filter("own = small").select(*key, F.col("set").alias("x"))
    y = rows.filter("own = large").select(*key, F.col("set").alias("y"))
    apart = F.floor((F.col("x.n") + F.col("y.n")) * (q - p) / (q + p))
    enough = 2 * F.least("x.left", "y.left") >= F.col("x.delta") + F.col("y.delta") - apart
    sizes = q * F.least("x.n", "y.n") >= p * F.greatest("x.n", "y.n")
    met = x.join(y, key).filter((F.col("x.root") != F.col("y.root")) & sizes & enough)
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """doc, root: the smallest document that it is connected with. Links a, b; documents without links are left out.

    Alternates two steps until every document is linked with its root only: every document hands the smallest of its
    neighbours and itself to its larger neighbours, then to its smaller ones. Each is a minimum per document, joined
    back to the links.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        large = staged(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(down).alias("e")).select("e.u", "e.v").filter("u != v").distinct()
        edges = staged(small, "links")
        ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 AND up > 0").isEmpty():
            roots = edges.select(F.col("v").alias("doc"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("doc"), F.col("v").alias("root")).unionByName(roots)
