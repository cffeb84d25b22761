"""Conformed dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.functions.dates import month_number_key, month_start, peak_flag, quarter_label
from cloudtally.limits import Limits
from cloudtally.operators.keys import fold_copies, is_small, number_rows, number_small

AGENCY_ATTRIBUTES = (
    "agency_name", "country", "country_code", "org_size", "sector_type", "aws_pref_region", "currency",
    "region_group",
)


@dataclass(frozen=True)
class Dimensions:
    agency: DataFrame
    service: DataFrame
    region: DataFrame
    date: DataFrame


def dim_agency_clean(agencies: DataFrame) -> DataFrame:
    """One row per agency; each attribute is the largest value among the agency's copies."""
    return fold_copies(agencies, "agency_id", AGENCY_ATTRIBUTES)


def dim_service(spark: SparkSession) -> DataFrame:
    """The three service types. Fixed values, in the plan itself."""
    return spark.sql("""
        SELECT * FROM VALUES
            (1, 'IaaS', 'Compute Infrastructure', 'High'),
            (2, 'PaaS', 'Platform Services', 'Medium'),
            (3, 'SaaS', 'Application Services', 'High')
            AS service(service_id, service_type, service_name, criticality_level)
    """)


def regions(agencies: DataFrame) -> DataFrame:
    """One row per preferred region, without a number."""
    return fold_copies(agencies, "aws_pref_region", ["region_group"])


def dim_region(agencies: DataFrame, few: bool | None = None) -> DataFrame:
    """One row per preferred region, numbered by name.

    Whether they are ``few``, so that one task may number them, is counted unless it is known. Copies are folded before: numbering agency rows would give a region one row per
    agency, and every lookup on it would multiply fact rows.
    """
    found = regions(agencies)
    few = is_small(found) if few is None else few
    number = number_small if few else number_rows
    return number(found, "aws_pref_region", "region_id").select(
        "region_id", F.col("aws_pref_region").alias("aws_region"), "region_group", F.lit("Primary").alias("tier"))


def dim_date(months: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per month found in the ``month`` column of the usage table.

    Text that is not a month gives no row, so the key is never NULL, and the years 0001 to 9999 bound
    the table at 120,000 rows: it can always be broadcast.
    """
    day = F.col("date_key")
    return (
        months.select("month").distinct()
        .select(month_start(F.col("month")).alias("date_key"))
        .filter(day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")))
        .distinct()
        .select(
            day,
            F.date_format(day, "yyyy").alias("year"),
            F.date_format(day, "MM").alias("month"),
            quarter_label(day).alias("quarter"),
            peak_flag(day, limits.peak_months).alias("peak_period_flag"),
            month_number_key(day).alias("month_key"),
            F.date_format(day, "MMMM").alias("month_name"),
        )
    )
