"""Rankings that never sort a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.functions.exact import ratio


def top_k(df: DataFrame, order: Sequence[Column], k: int, name: str) -> DataFrame:
    """The first ``k`` rows of a total order, numbered. Each task keeps k rows; the numbering sees k rows."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def top_k_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each group, numbered. Spark cuts to k rows per group before its shuffle."""
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return numbered.filter(F.col(name) <= k)


def ranks(df: DataFrame, value: str, name: str, descending: bool = False, percent: bool = False,
          ranges: int = 256, by: Sequence[str] = ()) -> DataFrame:
    """The rank of each value (``_v``), ties alike (1, 1, 3), or with ``percent`` as (rank - 1) / (rows - 1).

    With ``by``, ranks are among the rows of a group; groups are few, of any size. A plain rank sorts a group in one
    task. Here rows are counted per value, the values fall into ranges at approximate quantiles of their group, the counts
    of the few ranges are accumulated, and only values of one range are sorted together. The result is exact whatever
    the quantiles are. NULL ranks last.
    """
    counts = df.groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    shares = F.expr(f"array({', '.join(f'{i / ranges!r}D' for i in range(1, ranges))})")
    quantiles = F.percentile_approx("_v", shares, F.lit(100 * ranges))
    if by:
        edged = counts.join(F.broadcast(counts.groupBy(*by).agg(quantiles.alias("_e"))), list(by))
    else:
        edged = counts.withColumn("_e", counts.agg(quantiles.alias("e")).scalar())
    below = F.size(F.filter(F.coalesce("_e", F.array().cast("array<double>")), lambda e: e <= F.col("_v")))
    placed = edged.withColumn(
        "_range", F.when(F.col("_v").isNull(), -1 if descending else ranges).otherwise(below)).drop("_e")
    direction = F.col("_range").desc() if descending else F.col("_range").asc()
    group = Window.partitionBy(*by)
    whole = group.orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "_range").agg(F.sum("_n").alias("_m")).select(
        *by, "_range", F.coalesce(F.sum("_m").over(whole), F.lit(0)).alias("_base"), F.sum("_m").over(group).alias("_all"))
    order = F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_last()
    inner = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_base") + F.coalesce(F.sum("_n").over(inner), F.lit(0))
    rank = F.coalesce(ratio(before.cast("double"), F.col("_all") - 1), F.lit(0.0)) if percent else before + 1
    return placed.join(F.broadcast(totals), [*by, "_range"]).select(*by, "_v", rank.alias(name))


def with_ranks(df: DataFrame, ranked: DataFrame, value: str) -> DataFrame:
    """Rows with the rank of their value."""
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_v")), "left").drop("_v")
