"""The plans the queries should have."""

import re

import pytest

import __spark_entry__ as entry_point
from cloudtally.operators.keys import orphans
from cloudtally.plans import facts, views
from tests.conftest import plan

# The training-data operators have tests of their own.
QUERIES = {n: q for n, q in entry_point.queries().items() if not re.match(r"op\d+_|pipeline$", n)}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("scan_", "intake_", "catalogue_", "published_"))])
def test_no_python_and_no_cross_join(spark, sample_dir, name):
    text = plan(QUERIES[name](spark, sample_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_trend_windows_share_one_sort(warehouse):
    text = plan(views.v_cost_trends(warehouse.cost_rows))
    assert len(re.findall(r"Window \[", text)) == 1
    assert len(re.findall(r"- Sort \[", text)) == 1


def test_scan_reads_only_what_it_needs(warehouse):
    text = plan(facts.monthly_spend(warehouse.cost_rows))
    schema = re.search(r"ReadSchema: struct<(l_[^>]*)", text).group(1)
    assert "l_tax" not in schema and "l_orderkey" not in schema


def test_lines_are_combined_before_the_shuffle(warehouse):
    text = plan(warehouse.usage_monthly)
    assert text.index("Exchange hashpartitioning") < text.index("partial_sum")
    assert "BuildRight" in text and "BuildLeft" not in text


def test_orders_are_joined_to_summed_lines(warehouse):
    for name in ("tagging_compliance", "provider_spend"):
        text = plan(getattr(warehouse.inputs, name)())
        below = text[text.index("o_orderkey"):]
        assert "partial_sum" in below and "l_orderkey" in below[below.index("partial_sum"):]


def test_months_need_no_join(warehouse):
    assert "Join" not in plan(warehouse.inputs.usage_months())


def test_orphans_are_an_anti_join(warehouse):
    assert "LeftAnti" in plan(orphans(warehouse.usage_monthly, warehouse.dim_agency_clean, "agency_id"))


def test_lookups_are_broadcast(warehouse):
    text = plan(warehouse.fact_usage_monthly)
    assert "SortMergeJoin" not in text


def test_top_k_is_cut_before_the_shuffle(warehouse):
    from cloudtally.plans.reliability import top_risk_services

    text = plan(top_risk_services(warehouse.performance_rows.withColumn("region_id", entry_point.F.lit(1))))
    assert "WindowGroupLimit" in text


def test_top_k_preview_never_sorts_everything(spark, sample_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk_preview"](spark, sample_dir))


def test_a_filter_on_the_entity_passes_below_the_window(warehouse):
    text = plan(views.v_cost_trends(warehouse.cost_rows).filter("agency_id = 3"))
    assert text.rindex("= 3)") > text.index("Window [")
    assert re.search(r"DataFilters: \[[^\]]*l_suppkey[^\]]*= 3", text)
