"""Connected components of an edge list by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import cut


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`node`, `root` for every node of the edges (`a`, `b` long): root is the smallest node reachable.

    Each round links every neighbour of a node to the smallest one, first the larger neighbours, then the smaller.
    Neighbourhoods are never gathered: a minimum per node (combined before the shuffle) is joined back to the
    edges. Rounds grow with the logarithm of the longest path. Edges with a null end and self-loops are ignored;
    no edges give no rows.
    """
    now = cut(edges.filter(F.col("a") != F.col("b"))
              .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = _signature(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = now.union(now.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .distinct())
        small_least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(small_least, "hi")
                 .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.hi", "e.lo").filter("hi <> lo").distinct())
        now = cut(small)
        last, seen = seen, _signature(now)
        if seen == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select("lo").distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select("lo", "lo"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.max("hi"), F.min("lo")).first())
