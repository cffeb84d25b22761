"""The analytical views as SQL text in the catalogue, over catalogue tables: they outlive the session that made them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from cloudtally.limits import Limits
from cloudtally.plans.refresh import BY_YEAR
from cloudtally.sources.catalogue import create_database, create_table, create_view, quoted
from cloudtally.sources.published import open_published, published


def _exact(value: str) -> str:
    """The value as a decimal, so that sums do not depend on order; NULL where it is not finite."""
    return f"TRY_CAST({value} AS DECIMAL(28,12))"


def _sum(value: str) -> str:
    return f"CAST(SUM({_exact(value)}) AS DOUBLE)"


def _rolling(value: str) -> str:
    """The mean over the window named ``recent``."""
    return f"CAST(SUM({_exact(value)}) OVER recent AS DOUBLE) / NULLIF(COUNT({_exact(value)}) OVER recent, 0)"


def _recent(order: str, rows: int) -> str:
    return f"WINDOW w AS ({order}), recent AS ({order} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _cents(value: str) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _up_to(value: str, edges: tuple, labels: tuple) -> str:
    arms = " ".join(f"WHEN {value} <= {e}D THEN {label}" for e, label in zip(edges, labels))
    return f"CASE {arms} ELSE {labels[-1]} END"


def statements(database: str, limits: Limits = Limits()) -> dict[str, str]:
    """View name -> its query, over the tables of ``database``."""
    cost = f"{quoted(database)}.`fact_cost_monthly`"
    low, high = limits.healthy_utilisation
    colours = ("'Green'", "'Amber'", "'Red'")
    points = tuple(f"{p}D" for p in limits.band_points)
    weights = limits.health_weights
    within, below, beyond = limits.utilisation_points
    return {
        "v_cost_trends": f"""
            SELECT agency_id, date_key, service_type, cost_usd, rolling_3m_avg_cost, ROUND(change, 2) AS mom_growth_pct,
                   CASE WHEN change > {limits.acceleration_pct}D THEN 1 ELSE 0 END AS spend_acceleration_flag
            FROM (SELECT *, (cost_usd - previous) / NULLIF(previous, 0D) * 100 AS change
                  FROM (SELECT *, LAG(cost_usd) OVER w AS previous, {_rolling('cost_usd')} AS rolling_3m_avg_cost
                        FROM (SELECT agency_id, service_type, date_key, {_sum('cost_usd')} AS cost_usd FROM {cost}
                              GROUP BY agency_id, service_type, date_key)
                        {_recent('PARTITION BY agency_id, service_type ORDER BY date_key NULLS LAST', limits.trend_months)}))
            WHERE date_key IS NOT NULL""",
        "v_cost_spikes": f"""
            SELECT agency_id, date_key, cost_usd, spend_growth_pct,
                   CASE WHEN spend_growth_pct > {limits.spike_growth}D THEN 1 ELSE 0 END AS spike_flag
            FROM (SELECT *, (cost_usd - previous) / NULLIF(previous, 0D) AS spend_growth_pct
                  FROM (SELECT *, LAG(cost_usd) OVER (PARTITION BY agency_id ORDER BY date_key NULLS LAST) AS previous
                        FROM (SELECT agency_id, date_key, {_sum('cost_usd')} AS cost_usd FROM {cost}
                              GROUP BY agency_id, date_key)))
            WHERE date_key IS NOT NULL""",
        "v_cloud_waste": f"""
            SELECT agency_id, date_key, cost_usd, utilisation_pct,
                   CASE WHEN utilisation_pct < {limits.idle_utilisation}D THEN cost_usd ELSE 0D END AS idle_cost,
                   CASE WHEN utilisation_pct < {limits.idle_utilisation}D THEN 1 ELSE 0 END AS idle_flag
            FROM {cost}""",
        "v_budget_runrate": f"""
            SELECT agency_id, fiscal_year, months_elapsed, ytd_spend,
                   {_cents('ytd_spend / NULLIF(months_elapsed, 0) * 12')} AS projected_annual_spend,
                   {_cents('ytd_spend / NULLIF(months_elapsed, 0)')} AS avg_monthly_burn
            FROM (SELECT agency_id, date_format(date_key, 'yyyy') AS fiscal_year, MAX(month(date_key)) AS months_elapsed,
                         {_sum('cost_usd')} AS ytd_spend
                  FROM {cost} GROUP BY agency_id, date_format(date_key, 'yyyy'))""",
        "v_seasonality_index": f"""
            SELECT agency_id, date_key, monthly_spend, rolling_6m_avg, ROUND(part, 3) AS seasonality_index,
                   CASE WHEN part > {limits.high_pressure_index}D THEN 1 ELSE 0 END AS high_pressure_flag
            FROM (SELECT *, monthly_spend / NULLIF(rolling_6m_avg, 0D) AS part
                  FROM (SELECT *, {_rolling('monthly_spend')} AS rolling_6m_avg
                        FROM (SELECT agency_id, date_key, {_sum('cost_usd')} AS monthly_spend FROM {cost}
                              GROUP BY agency_id, date_key)
                        {_recent('PARTITION BY agency_id ORDER BY date_key NULLS LAST', limits.seasonal_months)}))""",
        "v_sla_bands": f"""
            SELECT agency_id, date_key, service_id, region_id, migration_status, peak_period_flag, latency_ms,
                   error_rate_pct, utilisation_pct, sla_breach_flag,
                   {_up_to('latency_ms', limits.latency_bands, colours)} AS latency_band,
                   {_up_to('error_rate_pct', limits.error_bands, colours)} AS error_band,
                   CASE WHEN utilisation_pct BETWEEN {low}D AND {high}D THEN 'Healthy'
                        WHEN utilisation_pct < {low}D THEN 'Under-utilised' ELSE 'High Risk' END AS utilisation_band,
                   ROUND({_up_to('latency_ms', limits.latency_bands, points)} * {weights[0]}D
                         + {_up_to('error_rate_pct', limits.error_bands, points)} * {weights[1]}D
                         + CASE WHEN utilisation_pct BETWEEN {low}D AND {high}D THEN {within}D
                                WHEN utilisation_pct < {low}D THEN {below}D ELSE {beyond}D END * {weights[2]}D, 1)
                       AS composite_health_score
            FROM {quoted(database)}.`fact_performance`""",
    }


def register(spark: SparkSession, root: str, database: str, limits: Limits = Limits()) -> None:
    """Name the last published set below ``root`` in the catalogue: a table for each, and the six views.

    Tables are external: their files belong to the published set. Any session of the same catalogue can read them. A
    table is missing for the moment in which it is pointed to a new set.
    """
    frames = open_published(spark, root)
    places = published(spark, root)
    name_tables(spark, database, f"{root.rstrip('/')}/catalogue", {
        n: (frames[n].schema, places[n], ("year",) if n in BY_YEAR else ()) for n in places})
    for name, query in statements(database, limits).items():
        create_view(spark, database, name, query)


def name_tables(spark: SparkSession, database: str, location: str,
                tables: dict[str, tuple[StructType, str, Sequence[str]]]) -> None:
    """A database, below ``location`` if it is new, with an external table for each name: (schema, path, partition columns)."""
    create_database(spark, database, location)
    for name, (schema, path, partition_by) in tables.items():
        create_table(spark, database, name, schema, path, partition_by)
