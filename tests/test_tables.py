import datetime

import pytest
from pyspark.sql import functions as F

from cloudtally.plans import dimensions, facts, views
from tests.conftest import rows

JAN = datetime.date(2025, 1, 1)
FEB = datetime.date(2025, 2, 1)
MAR = datetime.date(2025, 3, 1)

USAGE = ("agency_id int, date_key date, service_id int, region_id int, service_type string, compute_hours double, "
         "storage_gb double, data_egress_gb double, utilisation_pct double, cost_usd double, resource_count int, "
         "migration_status string, aws_region string")


def usage_row(util=50.0, status="Pre", cost=100.0, hours=10.0, storage=20.0, egress=2.0, agency=1, day=JAN,
              service="IaaS"):
    return (agency, day, 1, 1, service, hours, storage, egress, util, cost, 1, status, "r1")


@pytest.mark.parametrize("status", ["Pre", "Post", None])
@pytest.mark.parametrize("util", [20.0, 70.0, 70.01, 80.0, 80.01, 85.0, 85.01, 100.0, None])
def test_performance_rules(spark, util, status):
    df = spark.createDataFrame([usage_row(util, status)], USAGE)
    row = facts.fact_performance(df).first()
    extra = 80 if status == "Pre" else 40
    error = (3.5 if util and util > 80 else 2.0 if util and util > 70 else 0.8) + (0.7 if status == "Pre" else 0)
    latency = None if util is None else 150 + 3 * util + extra
    assert row.latency_ms == (None if latency is None else pytest.approx(latency))
    assert row.error_rate_pct == pytest.approx(error)
    assert row.sla_breach_flag == int(util is not None and util > 80)
    expected = 40 if latency is None or latency > 500 else 70 if latency > 250 else 100
    assert row.response_time_score == expected
    assert row.peak_period_flag == 1


@pytest.mark.parametrize("cost, ratio", [(0.0, None), (None, None), (200.0, 0.25), (-5.0, None)])
def test_efficiency(spark, cost, ratio):
    assert facts.fact_performance(spark.createDataFrame([usage_row(cost=cost)], USAGE)).first().efficiency_ratio == ratio


@pytest.mark.parametrize("hours, storage, egress, expected", [
    (0.0, 0.0, 0.0, None), (None, 1.0, 1.0, None), (10.0, 20.0, 2.0, 100 / 12.0), (0.0, 20.0, 0.0, 100.0)])
def test_cost_per_unit(spark, hours, storage, egress, expected):
    df = spark.createDataFrame([usage_row(hours=hours, storage=storage, egress=egress)], USAGE)
    found = facts.cost_of_usage(df).first().cost_per_unit
    assert found == (None if expected is None else pytest.approx(expected))


def test_region_lookup_does_not_multiply_rows(spark):
    agencies = spark.createDataFrame(
        [(i, f"a{i}", "c", "cc", "Small", "Health", f"r{i % 2}", "USD", "g") for i in range(4)],
        "agency_id int, agency_name string, country string, country_code string, org_size string, "
        "sector_type string, aws_pref_region string, currency string, region_group string")
    region = dimensions.dim_region(agencies)
    assert rows(region) == [(1, "r0", "g", "Primary"), (2, "r1", "g", "Primary")]
    usage = spark.createDataFrame([("r1", "IaaS", "2025-01"), ("r9", "XaaS", "bad")],
                                  "aws_region string, service_type string, month string")
    found = rows(facts.with_ids(usage, dimensions.dim_service(spark), region).select(
        "aws_region", "region_id", "service_id", "date_key"))
    assert found == [("r1", 2, 1, JAN), ("r9", None, None, None)]


def test_dim_date_leaves_out_what_is_no_month(spark):
    months = spark.createDataFrame([("2025-01",), ("2025-01",), ("2025-13",), ("x",), (None,)], "month string")
    assert rows(dimensions.dim_date(months)) == [(JAN, "2025", "01", "2025-Q1", 1, 202501, "January")]


def test_month_outside_the_calendar_has_no_key(spark):
    calendar = dimensions.dim_date(spark.createDataFrame([("2025-01",)], "month string"))
    tagging = spark.createDataFrame([(1, "2025-01", 79.9, 1.0), (1, "2025-02", 80.0, 2.0)],
                                    "agency_id int, month string, tagged_pct double, untagged_cost_usd double")
    found = rows(facts.fact_finance_governance(tagging, calendar), "tagged_pct")
    assert [(r[1], r[5]) for r in found] == [(JAN, 1), (None, 0)]


def test_migration_dates_by_format(spark):
    schema = ("agency_id int, country string, country_code string, org_size string, migrated string, "
              "migration_date string, pre_migration_cost_usd double, post_migration_cost_usd double, "
              "expected_savings_pct double, realized_savings_pct double, sla_breaches_pre int, sla_breaches_post int")
    raw = spark.createDataFrame([(1, "x", "x", "x", "Yes", "7/1/2025", 10.0, 8.0, 0.0, 20.0, 3, 1),
                                 (2, "x", "x", "x", "No", "", 10.0, 11.0, 0.0, -10.0, 3, 3)], schema)
    agency = spark.createDataFrame([(1, "C", "CC", "Large")],
                                   "agency_id int, country string, country_code string, org_size string")
    found = rows(facts.fact_migration_summary(raw, agency), "agency_id")
    assert found[0] == (1, "C", "CC", "Large", 1, datetime.date(2025, 1, 7), 10.0, 8.0, 0.0, 20.0, 3, 1, -2.0)
    assert found[1][1:6] == (None, None, None, 0, None)
    month_first = facts.fact_migration_summary(raw, agency, "M/d/yyyy")
    assert rows(month_first, "agency_id")[0][5] == datetime.date(2025, 7, 1)


def cost(spark, *values):
    return spark.createDataFrame(
        [(a, d, s, float(v) if v is not None else None) for a, d, s, v in values],
        "agency_id int, date_key date, service_type string, cost_usd double")


def test_trend_growth_edges(spark):
    found = rows(views.v_cost_trends(cost(
        spark, (1, JAN, "IaaS", 0), (1, FEB, "IaaS", 100), (1, MAR, "IaaS", 115), (2, JAN, "IaaS", 100),
        (2, FEB, "IaaS", 116))))
    assert [(r[5], r[6]) for r in found] == [(None, 0), (None, 0), (15.0, 0), (None, 0), (16.0, 1)]


def test_trend_gap_is_skipped_or_filled(spark):
    df = cost(spark, (1, JAN, "IaaS", 100), (1, MAR, "IaaS", 150))
    assert [(r[1], r[5]) for r in rows(views.v_cost_trends(df))] == [(JAN, None), (MAR, 50.0)]
    dense = rows(views.v_cost_trends(df, dense_calendar=True))
    assert [(r[1], r[3], r[5]) for r in dense] == [(JAN, 100.0, None), (FEB, 0.0, -100.0), (MAR, 150.0, None)]


def test_trend_sums_rows_of_one_month(spark):
    df = cost(spark, (1, JAN, "IaaS", 60), (1, JAN, "IaaS", 40), (1, FEB, "IaaS", 110))
    assert [(r[3], r[5]) for r in rows(views.v_cost_trends(df))] == [(100.0, None), (110.0, 10.0)]


def test_spikes_never_compare_services_of_one_month(spark):
    df = cost(spark, (1, JAN, "IaaS", 10), (1, JAN, "SaaS", 90), (1, FEB, "IaaS", 100), (1, FEB, "SaaS", 25))
    assert rows(views.v_cost_spikes(df)) == [(1, JAN, 100.0, None, 0), (1, FEB, 125.0, 0.25, 0)]
    by_service = rows(views.v_cost_spikes(df, ("agency_id", "service_type")))
    assert [(r[1], r[5]) for r in by_service] == [("IaaS", 0), ("IaaS", 1), ("SaaS", 0), ("SaaS", 0)]


def test_waste_flag_at_the_limit(spark):
    df = spark.createDataFrame([(1, JAN, 5.0, 19.99), (1, JAN, 5.0, 20.0), (1, JAN, 5.0, None)],
                               "agency_id int, date_key date, cost_usd double, utilisation_pct double")
    found = {r[3]: r[4:] for r in rows(views.v_cloud_waste(df))}
    assert found == {19.99: (5.0, 1), 20.0: (0.0, 0), None: (0.0, 0)}


# --- properties on the sample tables ---

def test_facts_keep_the_row_count(warehouse):
    usage = warehouse.usage_monthly.count()
    assert warehouse.fact_usage_monthly.count() == usage
    assert warehouse.fact_performance.count() == usage
    assert warehouse.usage_monthly.select("agency_id", "month", "service_type").distinct().count() == usage


def test_breach_means_utilisation_above_80(warehouse):
    wrong = warehouse.performance_rows.filter((F.col("utilisation_pct") > 80).cast("int") != F.col("sla_breach_flag"))
    assert wrong.count() == 0


def test_shares_of_an_agency_year_add_up(warehouse):
    total = warehouse.fact_provider_spend.groupBy("agency_id", "year").agg(F.sum("provider_share_pct").alias("s"))
    assert total.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_rolling_mean_lies_within_its_values(warehouse):
    trends = views.v_cost_trends(warehouse.cost_rows).groupBy("agency_id", "service_type").agg(
        F.min("cost_usd").alias("lo"), F.max("cost_usd").alias("hi"),
        F.min("rolling_3m_avg_cost").alias("a"), F.max("rolling_3m_avg_cost").alias("b"))
    assert trends.filter("a < lo - 1e-6 OR b > hi + 1e-6").count() == 0


def test_month_index_has_no_holes(warehouse):
    spans = warehouse.fact_forecast_input.groupBy("agency_id").agg(
        F.count("*").alias("n"), F.max("month_index").alias("m"), F.countDistinct("month_index").alias("d"))
    assert spans.filter("n <> m OR n <> d").count() == 0


def test_realised_savings_match_the_costs(warehouse):
    wrong = warehouse.fact_migration_summary.filter(
        F.abs(F.col("realized_savings_pct")
              + 100 * F.col("cost_delta_usd") / F.col("pre_migration_cost_usd")) > 0.011)
    assert wrong.count() == 0


def test_results_do_not_depend_on_the_partitioning(warehouse):
    base = warehouse.cost_rows
    results = {tuple(rows(views.v_seasonality_index(base.repartition(n)))) for n in (1, 13)}
    assert len(results) == 1
