"""Fact tables.

``date`` is the month dimension. A usage fact may leave it out: the dimension is made from the usage
months themselves, so each parsed month is its own lookup result and a second scan of the usage is saved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.functions.dates import month_start, parse_day, peak_flag
from cloudtally.functions.exact import flag, ratio
from cloudtally.functions.scoring import above, up_to
from cloudtally.limits import BEFORE_MIGRATION, Limits
from cloudtally.operators.keys import lookup
from cloudtally.operators.series import month_index, to_grain
from cloudtally.operators.shares import share_of_total


def with_date_key(raw: DataFrame, date: DataFrame | None = None) -> DataFrame:
    """Add the month's key: NULL for text that is not a month, or for a month the dimension lacks."""
    keyed = raw.withColumn("date_key", month_start(F.col("month")))
    if date is None:
        return keyed
    known = F.broadcast(date.select(F.col("date_key").alias("known_key")))
    joined = keyed.join(known, F.col("date_key") == F.col("known_key"), "left")
    return joined.withColumn("date_key", F.col("known_key")).drop("known_key")


def with_ids(usage: DataFrame, service: DataFrame | None = None, region: DataFrame | None = None,
             date: DataFrame | None = None) -> DataFrame:
    """The star lookup of a usage row; every row is kept. Without a dimension its id is left out."""
    found = usage
    if service is not None:
        found = lookup(found, service, "service_type", ["service_id"])
    if region is not None:
        found = lookup(found, region, "aws_region", ["region_id"])
    return with_date_key(found, date)


def _ids(df: DataFrame) -> list[str]:
    return [c for c in ("service_id", "region_id") if c in df.columns]


def fact_usage_monthly(usage: DataFrame, service: DataFrame | None = None, region: DataFrame | None = None,
                       date: DataFrame | None = None) -> DataFrame:
    rows = with_ids(usage, service, region, date)
    return rows.select(
        "agency_id", "date_key", *_ids(rows), "service_type", "compute_hours", "storage_gb", "data_egress_gb",
        "utilisation_pct", "cost_usd", "resource_count", "migration_status", "aws_region")


def fact_cost_monthly(usage: DataFrame, service: DataFrame | None = None, region: DataFrame | None = None,
                      date: DataFrame | None = None, limits: Limits = Limits()) -> DataFrame:
    return cost_of_usage(fact_usage_monthly(usage, service, region, date), limits)


def cost_of_usage(usage_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The usage fact with its cost per workload unit, NULL for rows without any workload."""
    compute, storage, egress = F.col("compute_hours"), F.col("storage_gb"), F.col("data_egress_gb")
    units = compute + storage * limits.storage_weight + egress * limits.egress_weight
    return usage_fact.select(
        "agency_id", "date_key", *_ids(usage_fact), "service_type", "cost_usd", "compute_hours", "storage_gb",
        "data_egress_gb", "utilisation_pct", "resource_count", "migration_status",
        F.when(compute + storage + egress > 0, ratio(F.col("cost_usd"), units)).alias("cost_per_unit"),
    )


def latency_ms(utilisation: Column, status: Column, limits: Limits) -> Column:
    base = utilisation * limits.latency_ms_per_point + limits.latency_base_ms
    return base + F.when(status == BEFORE_MIGRATION, limits.latency_before_migration_ms).otherwise(
        limits.latency_after_migration_ms)


def error_rate_pct(utilisation: Column, status: Column, limits: Limits) -> Column:
    extra = F.when(status == BEFORE_MIGRATION, limits.error_before_migration).otherwise(0.0)
    return above(utilisation, limits.error_tiers, limits.error_floor) + extra


def fact_performance(usage_fact: DataFrame, date: DataFrame | None = None, limits: Limits = Limits(),
                     keep: Sequence[str] = ()) -> DataFrame:
    """Modelled latency, error rate, breach flag, response score and efficiency per usage row.

    ``keep`` names further usage columns to pass through.
    """
    util, cost, status = F.col("utilisation_pct"), F.col("cost_usd"), F.col("migration_status")
    if date is None:
        rows = usage_fact.withColumn("peak_period_flag", peak_flag(F.col("date_key"), limits.peak_months))
    else:
        rows = lookup(usage_fact, F.broadcast(date), "date_key", ["peak_period_flag"])
    modelled = rows.withColumns({
        "latency_ms": latency_ms(util, status, limits),
        "error_rate_pct": error_rate_pct(util, status, limits),
    })
    breach = (
        (F.col("latency_ms") > limits.breach_latency_ms)
        | (F.col("error_rate_pct") > limits.breach_error_pct)
        | (util > limits.breach_utilisation)
    )
    return modelled.select(
        "agency_id", "date_key", *_ids(usage_fact), *keep, "service_type", "migration_status", "compute_hours",
        "storage_gb", "data_egress_gb", "utilisation_pct", "cost_usd", "resource_count", "peak_period_flag",
        "latency_ms", "error_rate_pct",
        flag(breach).alias("sla_breach_flag"),
        up_to(F.col("latency_ms"), limits.latency_bands, limits.band_points).cast("int").alias("response_time_score"),
        F.when(cost > 0, util / F.nullif(cost, F.lit(0.0))).alias("efficiency_ratio"),
    )


def fact_migration_summary(migration: DataFrame, agency: DataFrame, date_format: str = "d/M/yyyy") -> DataFrame:
    """Migration outcome per agency. Dates are read day first; pass ``M/d/yyyy`` for files written month first."""
    own = migration.drop("country", "country_code", "org_size")
    return lookup(own, agency, "agency_id", ["country", "country_code", "org_size"]).select(
        "agency_id", "country", "country_code", "org_size",
        flag(F.col("migrated") == "Yes").alias("migration_flag"),
        parse_day(F.col("migration_date"), date_format).alias("migration_date"),
        "pre_migration_cost_usd", "post_migration_cost_usd", "expected_savings_pct", "realized_savings_pct",
        "sla_breaches_pre", "sla_breaches_post",
        (F.col("post_migration_cost_usd") - F.col("pre_migration_cost_usd")).alias("cost_delta_usd"),
    )


def fact_tagging_compliance(tagging: DataFrame, date: DataFrame) -> DataFrame:
    return with_date_key(tagging, date).select("agency_id", "date_key", "tagged_pct", "untagged_cost_usd")


def fact_finance_governance(tagging: DataFrame, date: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Tagging with its gap to 100 % and a flag below the required share."""
    return governance_of(fact_tagging_compliance(tagging, date), limits)


def governance_of(tagging_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The same from the tagging fact, so that the raw text need not be read again."""
    return tagging_fact.select("agency_id", "date_key", "tagged_pct", "untagged_cost_usd").withColumns({
        "tagging_gap": 100 - F.col("tagged_pct"),
        "governance_risk_flag": flag(F.col("tagged_pct") < limits.min_tagged_pct),
    })


def fact_provider_spend(spend: DataFrame, at_grain: bool = False) -> DataFrame:
    """Spend with its share of the agency's year, a fraction despite the name ``provider_share_pct``.

    ``at_grain`` promises one row per agency, year and provider, which bounds the groups.
    """
    shared = share_of_total(spend, "spend_usd", ["agency_id", "year"], "provider_share_pct", small_groups=at_grain)
    return shared.select(
        "agency_id", "country", "country_code", "year", "cloud_provider", "spend_usd", "provider_share_pct")


# Both names are in use for the same table.
fact_provider_finance = fact_provider_spend


def monthly_spend(cost_fact: DataFrame) -> DataFrame:
    """Cost per agency and month."""
    return to_grain(cost_fact.select("agency_id", "date_key", "cost_usd"), ["agency_id", "date_key"], "cost_usd",
                    "monthly_cost")


def fact_forecast_input(cost_fact: DataFrame) -> DataFrame:
    """The monthly series of each agency, its months numbered from 1; a row without a month comes last."""
    return month_index(monthly_spend(cost_fact), ["agency_id"]).select(
        "agency_id", "date_key", "monthly_cost", "month_index")

