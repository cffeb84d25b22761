"""Reliability measures over ``fact_performance`` and ``fact_migration_summary``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.functions.exact import exact_avg, exact_sum, moments, ratio
from cloudtally.functions.scoring import inside, weighted
from cloudtally.limits import BEFORE_MIGRATION, Limits
from cloudtally.operators.keys import lookup
from cloudtally.operators.ranking import top_k_within
from cloudtally.operators.shares import share_of_all
from cloudtally.plans.facts import fact_performance

_AGENCY_SERVICE = ("agency_id", "service_type")


def breach_rate_pct() -> Column:
    return 100 * F.sum("sla_breach_flag") / F.count("sla_breach_flag")


def avg_where(value: str, condition: Column) -> Column:
    return exact_avg(F.when(condition, F.col(value)))


def with_stability(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Add the utilisation score and the stability score, both 0..100."""
    low, high = limits.healthy_utilisation
    score = inside(F.col("utilisation_pct"), low, high, limits.utilisation_points)
    parts = [F.col("response_time_score"), 100 - F.col("error_rate_pct"), F.col("utilisation_score")]
    return performance.withColumn("utilisation_score", score).withColumn(
        "stability_score", weighted(parts, limits.stability_weights))


def stability_score(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return with_stability(performance, limits).select(
        "agency_id", "service_type", "date_key", "response_time_score", "error_rate_pct", "utilisation_score",
        "stability_score")


def sla_breach_rate(performance: DataFrame) -> DataFrame:
    return performance.groupBy(*_AGENCY_SERVICE).agg(
        F.count("*").alias("months"), F.sum("sla_breach_flag").alias("breaches"),
        breach_rate_pct().alias("breach_rate_pct"))


def avg_latency_error(performance: DataFrame) -> DataFrame:
    return performance.groupBy(*_AGENCY_SERVICE).agg(
        exact_avg("latency_ms").alias("avg_latency_ms"), exact_avg("error_rate_pct").alias("avg_error_pct"))


def stability_trend(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return with_stability(performance, limits).groupBy("date_key").agg(
        exact_avg("stability_score").alias("avg_stability"))


def top_risk_services(performance: DataFrame, limits: Limits = Limits(), k: int = 10) -> DataFrame:
    """The k riskiest services, agencies and regions: highest breach rate first, then lowest stability."""
    cols = ("service_type", "agency_id", "region_id")
    sets = [[F.col(c)] for c in cols]
    names = dict(zip(cols, ("service", "agency", "region")))
    kind = entity = None
    for c, label in names.items():
        used = F.grouping(c) == 0
        kind = F.when(used, label) if kind is None else kind.when(used, label)
        text = F.col(c).cast("string")
        entity = F.when(used, text) if entity is None else entity.when(used, text)
    grouped = with_stability(performance, limits).groupingSets(sets, *cols).agg(
        kind.alias("entity_type"), entity.alias("entity"),
        breach_rate_pct().alias("breach_rate_pct"), exact_avg("stability_score").alias("avg_stability"))
    order = [F.col("breach_rate_pct").desc(), F.col("avg_stability").asc(), F.col("entity").asc_nulls_last()]
    return top_k_within(grouped, ["entity_type"], order, k, "risk_rank").select(
        "entity_type", "entity", "breach_rate_pct", "avg_stability", "risk_rank")


def breach_breakdown(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return performance.groupBy(*_AGENCY_SERVICE).agg(
        F.count_if(F.col("latency_ms") > limits.breach_latency_ms).alias("latency_breaches"),
        F.count_if(F.col("error_rate_pct") > limits.breach_error_pct).alias("error_breaches"),
        F.count_if(F.col("utilisation_pct") > limits.breach_utilisation).alias("utilisation_breaches"),
        F.sum("sla_breach_flag").alias("breaches"))


def engineering_risk_score(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Half the breach rate, half the missing stability, 0..100."""
    return with_stability(performance, limits).groupBy(*_AGENCY_SERVICE).agg(
        breach_rate_pct().alias("breach_rate_pct"), exact_avg("stability_score").alias("avg_stability"),
    ).withColumn("risk_score", F.col("breach_rate_pct") * 0.5 + (100 - F.col("avg_stability")) * 0.5)


def sla_breach_trend(performance: DataFrame) -> DataFrame:
    """Breach rate by month; the peak column is NULL in other months."""
    return performance.groupBy("date_key", "peak_period_flag").agg(
        breach_rate_pct().alias("breach_rate_pct"),
    ).withColumn("peak_breach_rate_pct", F.when(F.col("peak_period_flag") == 1, F.col("breach_rate_pct")))


def latency_vs_utilisation(performance: DataFrame) -> DataFrame:
    """One scatter point per agency and service, with the correlation of its months."""
    return performance.groupBy(*_AGENCY_SERVICE).agg(
        exact_avg("utilisation_pct").alias("avg_utilisation"), exact_avg("latency_ms").alias("avg_latency_ms"),
        correlation("utilisation_pct", "latency_ms").alias("correlation"))


def correlation(x: str, y: str) -> Column:
    """Pearson's r to six digits, from sums that do not depend on row order; NULL where one side does not vary."""
    return F.round(moments(x, y).corr(), 6)


def risk_correlation(performance: DataFrame) -> DataFrame:
    return performance.groupBy("agency_id").agg(
        correlation("utilisation_pct", "sla_breach_flag").alias("utilisation_breach_corr"),
        correlation("cost_usd", "sla_breach_flag").alias("cost_breach_corr"),
        correlation("utilisation_pct", "cost_usd").alias("utilisation_cost_corr"))


def peak_vs_offpeak(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return with_stability(performance, limits).groupBy("peak_period_flag").agg(
        F.count("*").alias("months"), exact_avg("stability_score").alias("avg_stability"),
        exact_avg("latency_ms").alias("avg_latency_ms"), exact_avg("error_rate_pct").alias("avg_error_pct"),
        breach_rate_pct().alias("breach_rate_pct"))


def peak_collapse(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Agency services whose mean stability in peak months is lower by more than the limit."""
    peak = F.col("peak_period_flag")
    return with_stability(performance, limits).groupBy(*_AGENCY_SERVICE).agg(
        avg_where("stability_score", peak == 1).alias("peak_stability"),
        avg_where("stability_score", peak == 0).alias("offpeak_stability"),
    ).withColumn("stability_drop", F.col("offpeak_stability") - F.col("peak_stability")).filter(
        F.col("stability_drop") > limits.peak_drop_points)


def breach_concentration(performance: DataFrame) -> DataFrame:
    """Each agency service's share of all breaches, of peak breaches and of off-peak breaches."""
    hit, peak = F.col("sla_breach_flag"), F.col("peak_period_flag")
    counts = performance.groupBy(*_AGENCY_SERVICE).agg(
        F.sum(hit).alias("breaches"),
        F.count_if((hit == 1) & (peak == 1)).alias("peak_breaches"),
        F.count_if((hit == 1) & (peak == 0)).alias("offpeak_breaches"))
    return share_of_all(counts, {c: f"share_of_{c}" for c in ("breaches", "peak_breaches", "offpeak_breaches")})


def region_performance(performance: DataFrame, region: DataFrame) -> DataFrame:
    by_region = performance.groupBy("region_id").agg(
        F.count("*").alias("months"), exact_avg("latency_ms").alias("avg_latency_ms"),
        exact_avg("error_rate_pct").alias("avg_error_pct"), breach_rate_pct().alias("breach_rate_pct"))
    return lookup(by_region, region, "region_id", ["aws_region", "region_group"]).select(
        "region_id", "aws_region", "region_group", "months", "avg_latency_ms", "avg_error_pct", "breach_rate_pct")


def region_mismatch(usage_fact: DataFrame, agency: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Spend and breaches per agency outside its preferred region. Rows are summed before the agency lookup."""
    sums = fact_performance(usage_fact, limits=limits, keep=["aws_region"]).groupBy("agency_id", "aws_region").agg(
        exact_sum("cost_usd").alias("spend"), F.sum("sla_breach_flag").alias("hits"))
    away = F.col("aws_region") != F.col("aws_pref_region")
    return lookup(sums, agency, "agency_id", ["aws_pref_region"]).groupBy("agency_id", "aws_pref_region").agg(
        exact_sum("spend").alias("total_spend_usd"),
        exact_sum(F.when(away, F.col("spend")).otherwise(F.lit(0.0))).alias("mismatch_spend_usd"),
        F.sum(F.when(away, F.col("hits")).otherwise(0)).alias("mismatch_breaches"))


def sla_by_criticality(performance: DataFrame, service: DataFrame) -> DataFrame:
    """Breach rate by criticality; rows are counted per service before the lookup."""
    counts = performance.groupBy("service_type").agg(
        F.count("*").alias("n"), F.sum("sla_breach_flag").alias("hits"))
    return lookup(counts, service, "service_type", ["criticality_level"]).groupBy("criticality_level").agg(
        F.sum("n").alias("months"), F.sum("hits").alias("breaches"),
        (100 * F.sum("hits") / F.sum("n")).alias("breach_rate_pct"))


def seasonal_load(performance: DataFrame) -> DataFrame:
    """Mean load by calendar month."""
    return performance.groupBy(F.month("date_key").alias("calendar_month")).agg(
        exact_avg("utilisation_pct").alias("avg_utilisation"), exact_avg("compute_hours").alias("avg_compute_hours"),
        exact_avg("data_egress_gb").alias("avg_egress_gb"))


def pre_post_migration(performance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return with_stability(performance, limits).groupBy("migration_status").agg(
        F.count("*").alias("months"), exact_avg("latency_ms").alias("avg_latency_ms"),
        exact_avg("error_rate_pct").alias("avg_error_pct"), F.sum("sla_breach_flag").alias("breaches"),
        breach_rate_pct().alias("breach_rate_pct"), exact_avg("stability_score").alias("avg_stability"))


def migration_roi(performance: DataFrame, migration_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Cost change against stability change per agency; the latter is NULL without months on both sides."""
    before = F.col("migration_status") == BEFORE_MIGRATION
    stability = with_stability(performance, limits).groupBy("agency_id").agg(
        avg_where("stability_score", before).alias("stability_before"),
        avg_where("stability_score", ~before).alias("stability_after"))
    return migration_fact.join(stability, "agency_id", "left").select(
        "agency_id", "migration_flag", "cost_delta_usd", "realized_savings_pct", "stability_before", "stability_after",
        (F.col("stability_after") - F.col("stability_before")).alias("stability_delta"))


def migration_improved_share(migration_fact: DataFrame) -> DataFrame:
    """Among migrated agencies: how many have fewer breaches, and the fall in breaches over all of them."""
    moved = migration_fact.filter(F.col("migration_flag") == 1)
    pre, post = F.sum("sla_breaches_pre"), F.sum("sla_breaches_post")
    better = F.count_if(F.col("sla_breaches_post") < F.col("sla_breaches_pre"))
    return moved.agg(
        F.count("*").alias("migrated_agencies"), better.alias("improved_agencies"),
        ratio(better.cast("double"), F.count("*")).alias("improved_share"),
        pre.alias("breaches_before"), post.alias("breaches_after"),
        (ratio((pre - post).cast("double"), pre) * 100).alias("breach_reduction_pct"))


def measured_reliability(events: DataFrame, resolution_ms: float = 1) -> DataFrame:
    """Error rate, mean and 95th percentile latency per day, from an event log.

    The percentile is exact on a histogram of steps of ``resolution_ms``, latencies rounded up to a step: the
    window sees one row per step, never the events of a day. Choose a finer one for sub-millisecond latencies.
    """
    step = F.ceil("latency_ms") if resolution_ms == 1 else F.ceil(F.col("latency_ms") / resolution_ms) * resolution_ms
    histogram = events.groupBy(F.to_date("ts").alias("day"), step.alias("ms")).agg(
        F.count("*").alias("n"), F.count("latency_ms").alias("timed"), F.count_if("is_error").alias("errors"),
        F.sum(F.col("latency_ms").cast("decimal(18,6)")).alias("total_ms"))
    day = Window.partitionBy("day")
    up_to_here = day.orderBy(F.col("ms").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.sum("timed").over(up_to_here) * 100 >= F.sum("timed").over(day) * 95
    return histogram.withColumn("reached", reached).groupBy("day").agg(
        F.sum("n").alias("events"), F.sum("errors").alias("errors"),
        (100 * F.sum("errors") / F.sum("n")).alias("error_rate_pct"),
        ratio(F.sum("total_ms").cast("double"), F.sum("timed")).alias("avg_latency_ms"),
        F.min(F.when(F.col("reached"), F.col("ms"))).alias("p95_latency_ms"))
