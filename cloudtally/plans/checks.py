"""The quality gate: five groups of rules on facts, and three on what comes in (amounts, grain, bad lines)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.operators.quality import Rule, check_grain, check_orphans, check_rules, reconcile, union_all

# Fixed value: the month format of the tagging file.
MONTH_PATTERN = r"^\d{4}-\d{2}$"


def _null(table: str, column: str) -> Rule:
    return Rule(table, f"Null {column}", F.col(column).isNull())


def null_key_rules() -> list[Rule]:
    usage = [_null("fact_usage_monthly", c) for c in ("agency_id", "date_key", "service_id", "region_id")]
    return usage + [_null("fact_tagging_compliance", "date_key"), _null("fact_cost_monthly", "date_key")]


def _outside(column: str, low: float, high: float):
    return (F.col(column) < low) | (F.col(column) > high)


def bounds_rules() -> list[Rule]:
    return [
        Rule("fact_usage_monthly", "Utilisation out of bounds", _outside("utilisation_pct", 0, 100)),
        Rule("fact_usage_monthly", "Negative cost_usd", F.col("cost_usd") < 0),
        Rule("fact_usage_monthly", "Negative compute_hours", F.col("compute_hours") < 0),
        Rule("fact_tagging_compliance", "tagged_pct out of bounds", _outside("tagged_pct", 0, 100)),
        Rule("fact_tagging_compliance", "Negative untagged_cost_usd", F.col("untagged_cost_usd") < 0),
        Rule("fact_provider_spend", "provider_share_pct out of bounds", _outside("provider_share_pct", 0, 1)),
    ]


def month_rule() -> Rule:
    return Rule("raw_tagging_compliance", "Invalid month format", ~F.col("month").rlike(MONTH_PATTERN))


# Amounts of the raw tables, and the columns that name a row of each where the grain is documented.
AMOUNTS = {
    "usage_monthly": ("compute_hours", "storage_gb", "data_egress_gb", "utilisation_pct", "cost_usd"),
    "tagging_compliance": ("tagged_pct", "untagged_cost_usd"),
    "provider_spend": ("spend_usd",),
    "migration_summary": ("pre_migration_cost_usd", "post_migration_cost_usd", "expected_savings_pct",
                          "realized_savings_pct"),
}
GRAINS = {
    "tagging_compliance": ("agency_id", "month"),
    "provider_spend": ("agency_id", "year", "cloud_provider"),
    "migration_summary": ("agency_id",),
}


def finite_rules() -> list[Rule]:
    """Rows with an amount that no sum can hold: sums leave it out, so the facts would be too small in silence."""
    def odd(column: str) -> Column:
        return F.isnan(column) | (F.abs(column) == float("inf"))
    return [Rule(f"raw_{t}", "Amount not finite", reduce(Column.__or__, [F.coalesce(odd(c), F.lit(False)) for c in columns]))
            for t, columns in AMOUNTS.items()]


def dq_finite(raw: dict[str, DataFrame]) -> DataFrame:
    return check_rules({f"raw_{t}": raw[t] for t in AMOUNTS}, finite_rules())


def dq_grain(raw: dict[str, DataFrame]) -> DataFrame:
    return union_all([check_grain(raw[t], f"raw_{t}", keys, "Repeated key") for t, keys in GRAINS.items()])


def dq_null_keys(facts: dict[str, DataFrame]) -> DataFrame:
    return check_rules(facts, null_key_rules())


def dq_bounds(facts: dict[str, DataFrame]) -> DataFrame:
    return check_rules(facts, bounds_rules())


def dq_orphans(facts: dict[str, DataFrame], agency: DataFrame) -> DataFrame:
    checked = {n: facts[n] for n in ("fact_usage_monthly", "fact_tagging_compliance", "fact_migration_summary")}
    return check_orphans(checked, agency, "agency_id", "Orphaned agency_id")


def dq_month_format(tagging_raw: DataFrame) -> DataFrame:
    return check_rules({"raw_tagging_compliance": tagging_raw}, [month_rule()])


SOURCES = {
    "fact_usage_monthly": "usage_monthly",
    "fact_migration_summary": "migration_summary",
    "fact_tagging_compliance": "tagging_compliance",
    "fact_provider_spend": "provider_spend",
    "fact_cost_monthly": "usage_monthly",
}


def dq_row_counts(facts: dict[str, DataFrame], raw: dict[str, DataFrame]) -> DataFrame:
    return reconcile({f: (facts[f], raw[r]) for f, r in SOURCES.items()}, "Row count reconciliation")


def run_all(facts: dict[str, DataFrame], raw: dict[str, DataFrame], agency: DataFrame) -> DataFrame:
    """All 28 checks as ``table_name, check_type, failing_rows``; a row-count variance of either sign fails."""
    counts = dq_row_counts(facts, raw).select("table_name", "check_type", F.abs("variance").alias("failing_rows"))
    rules = check_rules({**facts, **{f"raw_{n}": df for n, df in raw.items()}},
                        null_key_rules() + bounds_rules() + finite_rules() + [month_rule()])
    return counts.unionByName(rules).unionByName(dq_orphans(facts, agency)).unionByName(dq_grain(raw))
