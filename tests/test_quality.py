"""Every check must fire on one bad row, and stay silent on clean tables."""

import datetime

import pytest

from cloudtally.operators.quality import QualityError, assert_clean
from cloudtally.plans import checks
from cloudtally.plans.facts import fact_provider_spend
from cloudtally.sources.schemas import RAW_SCHEMAS
from tests.conftest import plan, rows

JAN = datetime.date(2025, 1, 1)
GOOD = {
    "fact_usage_monthly": dict(agency_id=1, date_key=JAN, service_id=1, region_id=1, utilisation_pct=50.0,
                               cost_usd=1.0, compute_hours=1.0),
    "fact_cost_monthly": dict(agency_id=1, date_key=JAN),
    "fact_tagging_compliance": dict(agency_id=1, date_key=JAN, tagged_pct=90.0, untagged_cost_usd=0.0),
    "fact_provider_spend": dict(agency_id=1, provider_share_pct=1.0),
    "fact_migration_summary": dict(agency_id=1),
}
KINDS = dict(agency_id="int", date_key="date", service_id="int", region_id="int", utilisation_pct="double",
             cost_usd="double", compute_hours="double", tagged_pct="double", untagged_cost_usd="double",
             provider_share_pct="double")


def tables(spark, changed=None, extra=None):
    built = {}
    for name, good in GOOD.items():
        found = [good]
        if changed and changed[0] == name:
            found.append({**good, changed[1]: changed[2]})
        if extra == name:
            found.append(good)
        schema = ", ".join(f"{c} {KINDS[c]}" for c in good)
        built[name] = spark.createDataFrame([tuple(r.values()) for r in found], schema)
    return built


def raw(spark, facts, months=("2025-01",), changed=None):
    """Raw tables of as many rows as the facts; ``changed`` is (table, column, value) of a row more."""
    kinds = {t: ", ".join(f"{c} {k}" for c, k in (x.rsplit(" ", 1) for x in RAW_SCHEMAS[t].split(", "))) for t in checks.AMOUNTS}

    def made(table, n):
        names = [c.split()[0] for c in kinds[table].split(", ")]
        good = {"month": months[0], "year": 2025, "cloud_provider": "AWS", "agency_id": 1}
        rows_ = [{c: good.get(c) if c != "agency_id" else 1 + i for c in names} for i in range(n)]
        if changed and changed[0] == table:
            rows_.append({**rows_[0], "agency_id": 7, changed[1]: changed[2]})
        return spark.createDataFrame([tuple(r.values()) for r in rows_], kinds[table])
    found = {t: made(t, facts[f].count()) for t, f in (
        ("usage_monthly", "fact_usage_monthly"), ("migration_summary", "fact_migration_summary"),
        ("provider_spend", "fact_provider_spend"), ("tagging_compliance", "fact_tagging_compliance"))}
    if len(months) > 1:
        found["tagging_compliance"] = spark.createDataFrame([(m,) for m in months], "month string")
    return found


@pytest.mark.parametrize("table, column", [(t, c) for t, columns in checks.AMOUNTS.items() for c in columns])
@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf")])
def test_amount_that_is_not_finite_fires(spark, table, column, value):
    found = checks.dq_finite(raw(spark, tables(spark), changed=(table, column, value)))
    assert found.count() == 4
    assert failing(found) == {(f"raw_{table}", "Amount not finite"): 1}


@pytest.mark.parametrize("table", list(checks.GRAINS))
def test_repeated_key_fires(spark, table):
    good = raw(spark, tables(spark))
    assert failing(checks.dq_grain(good)) == {}
    twice = {**good, table: good[table].union(good[table]).union(good[table])}
    assert failing(checks.dq_grain(twice)) == {(f"raw_{table}", "Repeated key"): 2}


def test_one_hot_key_is_counted_without_a_window(spark):
    spend = spark.range(30_000).selectExpr("1 AS agency_id", "2024 AS year", "if(id % 3 = 0, 'AWS', NULL) AS cloud_provider")
    found = checks.check_grain(spend, "t", ("agency_id", "year", "cloud_provider"), "Repeated key")
    assert rows(found) == [("t", "Repeated key", 29_998)]
    assert "Window" not in plan(found) and "partial_count" in plan(found)


def agency(spark):
    return spark.createDataFrame([(1,)], "agency_id int")


def failing(df):
    return {(r[0], r[1]): r[2] for r in rows(df) if r[2]}


@pytest.mark.parametrize("table, column", [
    ("fact_usage_monthly", "agency_id"), ("fact_usage_monthly", "date_key"), ("fact_usage_monthly", "service_id"),
    ("fact_usage_monthly", "region_id"), ("fact_tagging_compliance", "date_key"), ("fact_cost_monthly", "date_key")])
def test_null_key_fires(spark, table, column):
    found = checks.dq_null_keys(tables(spark, (table, column, None)))
    assert found.count() == 6
    assert failing(found) == {(table, f"Null {column}"): 1}


@pytest.mark.parametrize("table, column, value, name", [
    ("fact_usage_monthly", "utilisation_pct", 100.1, "Utilisation out of bounds"),
    ("fact_usage_monthly", "utilisation_pct", -0.1, "Utilisation out of bounds"),
    ("fact_usage_monthly", "cost_usd", -1.0, "Negative cost_usd"),
    ("fact_usage_monthly", "compute_hours", -1.0, "Negative compute_hours"),
    ("fact_tagging_compliance", "tagged_pct", 101.0, "tagged_pct out of bounds"),
    ("fact_tagging_compliance", "untagged_cost_usd", -0.5, "Negative untagged_cost_usd"),
    ("fact_provider_spend", "provider_share_pct", 1.5, "provider_share_pct out of bounds")])
def test_bound_fires(spark, table, column, value, name):
    found = checks.dq_bounds(tables(spark, (table, column, value)))
    assert found.count() == 6
    assert failing(found) == {(table, name): 1}


def test_null_is_not_out_of_bounds(spark):
    assert failing(checks.dq_bounds(tables(spark, ("fact_usage_monthly", "cost_usd", None)))) == {}


@pytest.mark.parametrize("table", ["fact_usage_monthly", "fact_tagging_compliance", "fact_migration_summary"])
@pytest.mark.parametrize("key", [99, None])
def test_orphan_fires(spark, table, key):
    found = checks.dq_orphans(tables(spark, (table, "agency_id", key)), agency(spark))
    assert failing(found) == {(table, "Orphaned agency_id"): 1}


def test_month_format_fires(spark):
    months = ("2025-01", "2025-1", "", None, "2025-13")
    found = checks.dq_month_format(spark.createDataFrame([(m,) for m in months], "month string"))
    assert failing(found) == {("raw_tagging_compliance", "Invalid month format"): 2}


@pytest.mark.parametrize("table", ["fact_usage_monthly", "fact_migration_summary", "fact_tagging_compliance",
                                   "fact_provider_spend", "fact_cost_monthly"])
def test_row_count_fires(spark, table):
    found = checks.dq_row_counts(tables(spark, extra=table), raw(spark, tables(spark)))
    assert found.count() == 5
    assert {r[0]: r[4] for r in rows(found) if r[4]} == {table: 1}


def test_clean_run(spark):
    good = tables(spark)
    found = checks.run_all(good, raw(spark, good), agency(spark))
    assert found.count() == 28
    assert failing(found) == {}
    assert_clean(found)


def test_gate_names_what_broke(spark):
    bad = tables(spark, ("fact_usage_monthly", "cost_usd", -1.0))
    with pytest.raises(QualityError, match="fact_usage_monthly: Negative cost_usd: 1"):
        assert_clean(checks.dq_bounds(bad))


def test_tables_that_say_so_have_unique_keys(warehouse):
    assert set(warehouse.inputs.unique) == set(checks.GRAINS)
    found = checks.dq_grain({t: getattr(warehouse.inputs, t)() for t in checks.GRAINS})
    assert found.count() == 3 and failing(found) == {}


def test_share_is_windowed_only_over_keys_known_to_be_unique(spark, warehouse):
    assert "Window [" in plan(warehouse.fact_provider_spend)

    class Unknown(type(warehouse.inputs)):
        unique = ()
    lazy = type(warehouse)(spark, Unknown(spark, warehouse.inputs.folder)).fact_provider_spend
    assert "Window [" not in plan(lazy)
    assert rows(lazy) == rows(warehouse.fact_provider_spend)


def test_share_of_a_hot_agency_year_needs_no_window(spark):
    spend = spark.range(20_000).selectExpr("1 AS agency_id", "'c' AS country", "'cc' AS country_code", "2024 AS year",
                                           "concat('p', id % 3) AS cloud_provider", "1.0D AS spend_usd")
    shared = fact_provider_spend(spend)
    assert "Window" not in plan(shared)
    assert shared.agg({"provider_share_pct": "sum"}).first()[0] == pytest.approx(1)
