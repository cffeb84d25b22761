"""Shares of a total, pivots and concentration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.functions.exact import exact_sum, ratio


def share_of_total(df: DataFrame, value: str, by: Sequence[str], name: str, small_groups: bool = False) -> DataFrame:
    """Add each row's value as a fraction of its group's total; NULL where the total is 0.

    ``small_groups`` says that the grain bounds a group (three providers per agency and year): one
    window does it. Otherwise a group may be of any size, so the totals are summed with a map-side
    combine and joined back, which Spark can split where a group is hot.
    """
    if small_groups:
        total = exact_sum(value, over=Window.partitionBy(*by))
        return df.withColumn(name, ratio(F.col(value), total))
    totals = df.groupBy(*by).agg(exact_sum(value).alias("_total"))
    right = totals.select(*[F.col(c).alias(f"_{c}") for c in by], "_total")
    match = None
    for c in by:
        test = F.col(c).eqNullSafe(F.col(f"_{c}"))
        match = test if match is None else match & test
    return df.join(right, match, "left").select(*df.columns, ratio(F.col(value), F.col("_total")).alias(name))


def share_of_all(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add columns as fractions of their whole columns: value column -> share column.

    The totals are one one-row subquery, so the rows need no common task.
    """
    totals = df.agg(F.struct(*[exact_sum(v).alias(v) for v in names]).alias("t")).scalar()
    shared = df.withColumn("_t", totals)
    return shared.select(*df.columns, *[ratio(F.col(v), F.col(f"_t.{v}")).alias(n) for v, n in names.items()])


def pivot_sum(df: DataFrame, by: Sequence[str], key: str, value: str, names: dict[str, str]) -> DataFrame:
    """One column per listed key value, holding its exact sum (0 without rows)."""
    return df.groupBy(*by).agg(*[sum_where(value, F.col(key) == k).alias(n) for k, n in names.items()])


def sum_where(value: str, condition: Column) -> Column:
    return exact_sum(F.when(condition, F.col(value)).otherwise(F.lit(0.0)))
