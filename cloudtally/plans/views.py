"""Analytical views: lazy frames over the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.functions.exact import flag, ratio
from cloudtally.functions.scoring import inside, up_to, weighted
from cloudtally.limits import Limits
from cloudtally.operators.series import by_month, dated, fill_months, growth, rolling_avg, run_rate, to_grain
from cloudtally.plans.facts import monthly_spend


def v_cost_trends(cost_fact: DataFrame, limits: Limits = Limits(), dense_calendar: bool = False) -> DataFrame:
    """Rolling mean, month-over-month growth in percent and an acceleration flag per agency and service.

    "Previous month" is the previous row; ``dense_calendar`` first adds missing months at zero cost.
    """
    entity = ["agency_id", "service_type"]
    monthly = to_grain(cost_fact, [*entity, "date_key"], "cost_usd")
    if dense_calendar:
        monthly = fill_months(monthly, entity, "cost_usd")
    order = by_month(entity)
    change = growth(F.col("cost_usd"), F.col("_previous")) * 100
    looked_back = monthly.withColumns({
        "_previous": F.lag("cost_usd").over(order),
        "rolling_3m_avg_cost": rolling_avg("cost_usd", order, limits.trend_months),
    })
    return (
        dated(looked_back)
        .withColumn("_change", change)
        .select(
            "agency_id", "date_key", "service_type", "cost_usd", "rolling_3m_avg_cost",
            F.round("_change", 2).alias("mom_growth_pct"),
            flag(F.col("_change") > limits.acceleration_pct).alias("spend_acceleration_flag"),
        )
    )


def v_cost_spikes(cost_fact: DataFrame, entity: Sequence[str] = ("agency_id",), limits: Limits = Limits()) -> DataFrame:
    """Growth as a fraction of the previous month, flagged as a spike beyond the limit.

    Costs are summed per entity and month first, so a month is never compared with another service of
    the same month. Pass ``("agency_id", "service_type")`` for service-level spikes.
    """
    monthly = to_grain(cost_fact, [*entity, "date_key"], "cost_usd")
    previous = F.lag("cost_usd").over(by_month(entity))
    return dated(monthly.withColumn("spend_growth_pct", growth(F.col("cost_usd"), previous))).select(
        *entity, "date_key", "cost_usd", "spend_growth_pct",
        flag(F.col("spend_growth_pct") > limits.spike_growth).alias("spike_flag"))


def v_cloud_waste(cost_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Cost of rows whose utilisation is below the idle limit."""
    idle = F.col("utilisation_pct") < limits.idle_utilisation
    return cost_fact.select(
        "agency_id", "date_key", "cost_usd", "utilisation_pct",
        F.when(idle, F.col("cost_usd")).otherwise(F.lit(0.0)).alias("idle_cost"),
        flag(idle).alias("idle_flag"))


def v_budget_runrate(cost_fact: DataFrame, count_months: bool = False, first_month: int = 1) -> DataFrame:
    """Year-end projection from the year's spend so far, per agency and year beginning in ``first_month``."""
    return run_rate(monthly_spend(cost_fact), ["agency_id"], "monthly_cost", count_months=count_months,
                    first_month=first_month)


def v_seasonality_index(cost_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """A month's spend relative to the agency's trailing mean; above the limit it is a high-pressure month."""
    order = by_month(["agency_id"])
    index = ratio(F.col("monthly_spend"), F.col("rolling_6m_avg"))
    return (
        monthly_spend(cost_fact).withColumnRenamed("monthly_cost", "monthly_spend")
        .withColumn("rolling_6m_avg", rolling_avg("monthly_spend", order, limits.seasonal_months))
        .withColumn("_index", index)
        .select(
            "agency_id", "date_key", "monthly_spend", "rolling_6m_avg",
            F.round("_index", 3).alias("seasonality_index"),
            flag(F.col("_index") > limits.high_pressure_index).alias("high_pressure_flag"))
    )


def v_sla_bands(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Traffic-light bands for latency, errors and utilisation, and the weighted health score 0..100."""
    latency, error, util = F.col("latency_ms"), F.col("error_rate_pct"), F.col("utilisation_pct")
    colours = ("Green", "Amber", "Red")
    low, high = limits.healthy_utilisation
    points = [
        up_to(latency, limits.latency_bands, limits.band_points),
        up_to(error, limits.error_bands, limits.band_points),
        inside(util, low, high, limits.utilisation_points),
    ]
    return performance.select(
        "agency_id", "date_key", "service_id", "region_id", "migration_status", "peak_period_flag", "latency_ms",
        "error_rate_pct", "utilisation_pct", "sla_breach_flag",
        up_to(latency, limits.latency_bands, colours).alias("latency_band"),
        up_to(error, limits.error_bands, colours).alias("error_band"),
        inside(util, low, high, ("Healthy", "Under-utilised", "High Risk")).alias("utilisation_band"),
        F.round(weighted(points, limits.health_weights), 1).alias("composite_health_score"),
    )
