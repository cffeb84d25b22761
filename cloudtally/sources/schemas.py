"""Declared schemas of the raw inputs; nothing is inferred. Fixed values."""

from __future__ import annotations

RAW_SCHEMAS = {
    "usage_monthly": (
        "agency_id int, country string, country_code string, month string, service_type string, "
        "compute_hours double, storage_gb double, data_egress_gb double, utilisation_pct double, "
        "cost_usd double, aws_region string, migration_status string, resource_count int"
    ),
    "provider_spend": (
        "agency_id int, country string, country_code string, year int, cloud_provider string, spend_usd double"
    ),
    "migration_summary": (
        "agency_id int, country string, country_code string, org_size string, migrated string, "
        "migration_date string, pre_migration_cost_usd double, post_migration_cost_usd double, "
        "expected_savings_pct double, realized_savings_pct double, sla_breaches_pre int, sla_breaches_post int"
    ),
    "tagging_compliance": (
        "agency_id int, country string, country_code string, month string, tagged_pct double, "
        "untagged_cost_usd double"
    ),
    "baseline_adoption": (
        "country string, country_code string, year int, org_size string, adoption_pct double"
    ),
    "agencies": (
        "agency_id int, agency_name string, country string, country_code string, org_size string, "
        "sector_type string, aws_pref_region string, currency string, region_group string"
    ),
    "budget": "agency_id int, month string, monthly_budget_usd double",
}

# Tables whose invalid values become NULL; the others stop the read.
NULL_FOR_INVALID = ("provider_spend", "migration_summary")
