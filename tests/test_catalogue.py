import datetime

import pytest

from cloudtally.limits import Limits
from cloudtally.plans import sql_views
from cloudtally.plans.refresh import lazy_views, refresh
from cloudtally.sources.published import open_published
from cloudtally.sources.sample_inputs import SampleInputs
from tests.conftest import plan, rows

VIEWS = list(sql_views.statements("d"))


@pytest.fixture(scope="module")
def root(spark, sample_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out"))
    refresh(spark, SampleInputs(spark, sample_dir), root)
    sql_views.register(spark, root, "cloud_views")
    yield root
    spark.sql("DROP DATABASE `cloud_views` CASCADE")


@pytest.mark.parametrize("name", VIEWS)
def test_views_of_another_session_equal_the_lazy_ones(spark, root, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    assert not [t for t in other.catalog.listTables() if t.isTemporary]
    found = other.sql(f"SELECT * FROM `cloud_views`.{name}")
    lazy = lazy_views(open_published(spark, root))[name]
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in lazy.schema]
    assert rows(found) == rows(lazy)


def test_views_take_limits_and_are_replaced(spark, root):
    sql_views.register(spark, root, "cloud_views", Limits(idle_utilisation=101.0))
    assert spark.sql("SELECT min(idle_flag) FROM `cloud_views`.v_cloud_waste").first()[0] == 1
    sql_views.register(spark, root, "cloud_views")
    assert spark.sql("SELECT min(idle_flag) FROM `cloud_views`.v_cloud_waste").first()[0] == 0


def test_a_year_filter_prunes_a_catalogue_table(spark, root):
    text = plan(spark.sql("SELECT cost_usd FROM `cloud_views`.fact_performance WHERE year = 1997"))
    assert "PartitionFilters: [isnotnull(year" in text
    assert spark.table("`cloud_views`.fact_cost_monthly").count() == open_published(spark, root)["fact_cost_monthly"].count()


def test_views_keep_rows_without_month_and_amount(spark, tmp_path):
    schema = ("agency_id int, date_key date, service_id int, region_id int, service_type string, cost_usd double, "
              "utilisation_pct double, latency_ms double, error_rate_pct double, migration_status string, "
              "peak_period_flag int, sla_breach_flag int")
    jan, mar = datetime.date(2024, 1, 1), datetime.date(2024, 3, 1)
    nan, inf = float("nan"), float("inf")
    data = [(1, jan, 1, 1, "IaaS", 10.0, 5.0, 250.0, 1.0, "Pre", 1, 0), (1, mar, 1, 1, "IaaS", nan, None, None, None, "Pre", 1, 0),
            (1, mar, 1, 1, "PaaS", 30.005, 20.0, 500.1, 3.1, "Pre", 1, 1), (1, None, 1, 1, "IaaS", 7.0, 86.0, 1.0, 0.5, "Pre", 0, 1),
            (2, jan, 1, 1, "IaaS", 0.0, 85.0, 1.0, 0.5, "Pre", 0, 1), (2, mar, 1, 1, "IaaS", inf, 85.0, 1.0, 0.5, "Pre", 0, 1)]
    facts = spark.createDataFrame(data, schema)
    spark.sql(f"CREATE DATABASE odd LOCATION '{tmp_path}'")
    try:
        for t in ("fact_cost_monthly", "fact_performance"):
            facts.write.saveAsTable(f"odd.{t}")
        lazy = lazy_views({"fact_cost_monthly": facts, "fact_performance": facts})
        for name, query in sql_views.statements("odd").items():
            assert sorted(map(str, spark.sql(query).collect())) == sorted(map(str, lazy[name].collect())), name
    finally:
        spark.sql("DROP DATABASE odd CASCADE")
