"""Which periods of a table changed, by digests that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame) -> Column:
    """64 bits over all columns; which of them are NULL counts too."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(F.concat(*[c.isNull().cast("int").cast("string") for c in columns]), *columns)


def period_digest(df: DataFrame, period: Column, year: Column) -> DataFrame:
    """``period, year, rows, sum, xor``: count, sum and exclusive or of the rows' hashes, combined on the map side.

    Sum and exclusive or together tell repeated rows, which one of them alone would not.
    """
    hashed = df.select(period.alias("period"), year.alias("year"), row_hash(df).alias("h"))
    return hashed.groupBy("period", "year").agg(
        F.count("*").alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("sum"), F.bit_xor("h").alias("xor"))


def changed_periods(old: DataFrame, new: DataFrame) -> DataFrame:
    """``period, year`` of periods that were added, removed or whose rows differ."""
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("period", "year")]
    both = old.alias("o").join(new.alias("n"), same[0] & same[1], "full")
    differs = F.lit(False)
    for c in ("rows", "sum", "xor"):
        differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    there = F.col("n.rows").isNotNull()
    return both.filter(differs).select(*[F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
                                         for c in ("period", "year")])
