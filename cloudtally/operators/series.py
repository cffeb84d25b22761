"""Monthly series per entity.

Every window here runs over rows that were first summed to one row per entity and month
(``to_grain``). That makes the order unique, and bounds a window partition by the number of months
however many rows an entity has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cloudtally.functions.exact import exact_avg, exact_sum, ratio, round_money


def to_grain(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """Exact sum of one value per key."""
    return df.groupBy(*keys).agg(exact_sum(value).alias(alias or value))


def by_month(entity: Sequence[str], date: str = "date_key") -> WindowSpec:
    """Rows of one entity in month order, rows without a month last."""
    return Window.partitionBy(*entity).orderBy(F.col(date).asc_nulls_last())


def dated(df: DataFrame, date: str = "date_key") -> DataFrame:
    """The rows that have a month. Rows whose month did not parse have no place in a series.

    Best applied after a window that looks back: ``by_month`` puts such rows last, so no other row sees them, and the
    filter stays above the sums, where it would otherwise be moved to every raw row with the parsing of its month.
    """
    return df.filter(F.col(date).isNotNull())


def rolling_avg(value: str, order: WindowSpec, rows: int) -> Column:
    """Mean over the current row and the ``rows - 1`` before it."""
    return exact_avg(value, over=order.rowsBetween(1 - rows, Window.currentRow))


def rolling_sum(value: str, order: WindowSpec, rows: int) -> Column:
    return exact_sum(value, over=order.rowsBetween(1 - rows, Window.currentRow))


def running_sum(value: str, order: WindowSpec) -> Column:
    return exact_sum(value, over=order.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def growth(value: Column, previous: Column) -> Column:
    """Change as a fraction of the previous value; NULL on a first row or after a zero."""
    return ratio(value - previous, previous)


def fill_months(df: DataFrame, entity: Sequence[str], value: str, date: str = "date_key") -> DataFrame:
    """Add the missing months between an entity's first and last one, with the value 0, after the month before them.

    Input is one row per entity and month. Rows without a month are kept as they are.
    """
    month = F.expr("interval 1 month")
    following = df.select(*entity, date, F.col(value).cast("double").alias(value),
                          F.lead(date).over(by_month(entity, date)).alias("_next"))
    first = F.add_months(date, 1)
    gap = F.when(first < F.col("_next"), F.sequence(first, F.add_months("_next", -1), month))
    none = F.array().cast("array<date>")
    rows = F.concat(F.array(F.struct(F.col(date).alias("d"), F.col(value).alias("v"))), F.transform(
        F.coalesce(gap, none), lambda d: F.struct(d.alias("d"), F.lit(0.0).alias("v"))))
    # In the window's own partitions, so that a window over the months that follows needs no shuffle.
    return following.select(*entity, F.inline(rows).alias(date, value))


def month_index(df: DataFrame, entity: Sequence[str], date: str = "date_key", name: str = "month_index") -> DataFrame:
    """Number an entity's months 1..n."""
    return df.withColumn(name, F.row_number().over(by_month(entity, date)))


def year_end(date: str, first_month: int) -> Column:
    """A month moved so that its calendar year is that in which its fiscal year ends."""
    return F.add_months(date, (13 - first_month) % 12)


def run_rate(df: DataFrame, entity: Sequence[str], value: str, date: str = "date_key",
             count_months: bool = False, first_month: int = 1) -> DataFrame:
    """Year-to-date total, its monthly mean and its projection to twelve months, per entity and year.

    Years begin in ``first_month`` and are named by the calendar year they end in. ``months_elapsed`` is the
    largest month number of the year; with ``count_months`` it is the number of months that have rows, which
    differs for a start in mid-year. Input: one row per entity and month.
    """
    months = F.count(date) if count_months else F.max(F.month(F.add_months(date, 1 - first_month)))
    ytd, elapsed = F.col("ytd_spend"), F.col("months_elapsed")
    return (
        df.groupBy(*entity, F.date_format(year_end(date, first_month), "yyyy").alias("fiscal_year"))
        .agg(months.cast("int").alias("months_elapsed"), exact_sum(value).alias("ytd_spend"))
        .select(
            *entity, "fiscal_year", "months_elapsed", "ytd_spend",
            round_money(ratio(ytd, elapsed) * 12).alias("projected_annual_spend"),
            round_money(ratio(ytd, elapsed)).alias("avg_monthly_burn"),
        )
    )


def longest_run(df: DataFrame, entity: Sequence[str], hit: str, date: str = "date_key",
                name: str = "longest_run") -> DataFrame:
    """Per entity, the number of rows with ``hit`` = 1 and the longest unbroken run of them."""
    order = by_month(entity, date)
    misses = F.sum(F.when(F.col(hit) == 1, 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = df.withColumn("_run", misses).groupBy(*entity, "_run").agg(F.count_if(F.col(hit) == 1).alias("_n"))
    return runs.groupBy(*entity).agg(F.sum("_n").alias("hits"), F.max("_n").alias(name))
