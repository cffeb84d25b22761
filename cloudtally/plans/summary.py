"""The executive page: headline numbers of both areas in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.functions.exact import MONEY_DIGITS, exact_avg, exact_sum, ratio
from cloudtally.limits import Limits
from cloudtally.operators.shares import sum_where
from cloudtally.plans.reliability import breach_rate_pct, with_stability


def executive_summary(performance: DataFrame, governance: DataFrame, provider_fact: DataFrame,
                      migration_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One aggregate per fact; the others join the first as one-row subqueries."""
    idle = F.col("utilisation_pct") < limits.idle_utilisation
    service = with_stability(performance, limits).agg(
        F.count("*").alias("service_months"),
        exact_avg("stability_score").alias("avg_stability"),
        breach_rate_pct().alias("breach_rate_pct"),
        exact_avg("latency_ms").alias("avg_latency_ms"),
        exact_avg("error_rate_pct").alias("avg_error_pct"),
        exact_sum("cost_usd").alias("actual_spend_usd"),
        sum_where("cost_usd", idle).alias("idle_cost_usd"),
        sum_where("cost_usd", F.col("sla_breach_flag") == 1).alias("high_risk_usd"))
    tagging = governance.agg(F.struct(
        exact_avg("tagged_pct").alias("avg_tagged_pct"),
        F.sum("governance_risk_flag").alias("governance_risk_records"),
        exact_sum("untagged_cost_usd").alias("untagged_cost_usd")).alias("t")).scalar()
    providers = provider_fact.agg(F.struct(
        ratio(sum_where("spend_usd", F.col("cloud_provider") == "AWS"), exact_sum("spend_usd")).alias("aws_share"),
    ).alias("p")).scalar()
    migration = migration_fact.agg(F.struct(
        F.sum("migration_flag").alias("migrated_agencies"),
        exact_sum("cost_delta_usd", MONEY_DIGITS).alias("migration_cost_delta_usd"),
        F.sum("sla_breaches_pre").alias("breaches_before"),
        F.sum("sla_breaches_post").alias("breaches_after")).alias("m")).scalar()
    return service.withColumn("waste_pct", ratio(F.col("idle_cost_usd"), F.col("actual_spend_usd")) * 100) \
        .select("*", tagging.alias("t"), providers.alias("p"), migration.alias("m")) \
        .select(*[c for c in service.columns], "waste_pct", "t.*", "p.*", "m.*") \
        .withColumn("untagged_share", ratio(F.col("untagged_cost_usd"), F.col("actual_spend_usd")))
