"""Dimension keys: folding copies, numbering, lookups and orphans."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.session import stored


def fold_copies(df: DataFrame, key: str | Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One row per key, each attribute the largest of its copies. Copies fold on the map side."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.max(a).alias(a) for a in attributes])


def number_rows(dim: DataFrame, order_by: str, name: str) -> DataFrame:
    """Surrogate ids 1..n in the order of a column, NULL last; rows of equal values are numbered in any order.

    No task sorts all rows: they are laid out by ranges, counted per range, and numbered within it after the counts of
    the ranges before. The ranges are stored in the shared folder, which is a job; a row of the driver per range.
    """
    order = F.col(order_by).asc_nulls_last()
    ranged = dim.repartitionByRange(order).sortWithinPartitions(order)
    # The id is the range's number and, in the lower 33 bits, the row's place in it.
    laid = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before = dict(zip(sorted(sizes), accumulate([0, *(sizes[p] for p in sorted(sizes))])))
    starts = F.coalesce(F.create_map(*[F.lit(x) for p, n in before.items() for x in (int(p), n)])[part], F.lit(0)) if before else F.lit(0)
    return laid.withColumn(name, (starts + place + 1).cast("int")).drop("_at")


def number_small(dim: DataFrame, order_by: str, name: str) -> DataFrame:
    """``number_rows`` for a dimension of few rows: one task numbers them, and nothing is stored. The column must be unique."""
    return dim.withColumn(name, F.row_number().over(Window.orderBy(F.col(order_by).asc_nulls_last())))


def is_small(dim: DataFrame, max_rows: int = 100_000) -> bool:
    """Whether a count proves the dimension small. Reads at most ``max_rows + 1`` of its rows."""
    return dim.limit(max_rows + 1).count() <= max_rows


def counted_small(dim: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark a dimension for broadcast if a count proves it small, else leave the choice to Spark.

    A derived dimension has a poor size estimate: without this, a handful of regions would make Spark shuffle the
    whole fact on a handful of values.
    """
    return F.broadcast(dim) if is_small(dim, max_rows) else dim


def lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], take: Sequence[str]) -> DataFrame:
    """LEFT lookup of dimension columns; keeps every fact row. The dimension must be unique on ``on``."""
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(dim.select(*keys, *take), keys, "left")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row; a NULL key has none."""
    return fact.join(dim.select(key), key, "left_anti")


def orphans_by_key(fact: DataFrame, dim: DataFrame, key: str, count: str = "orphan_rows") -> DataFrame:
    """Orphan keys with their row counts. Rows are counted per key before the join, so no key is hot in it."""
    return orphans(fact.groupBy(key).agg(F.count("*").alias(count)), dim, key)
