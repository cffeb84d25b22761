import datetime
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from cloudtally.operators import keys, series, shares
from cloudtally.operators.forecast import linear_forecast
from cloudtally.operators.ranking import ranks, top_k, top_k_within, with_ranks
from cloudtally.plans import dimensions, finops
from tests.conftest import plan, rows


def month(n):
    return datetime.date(2024 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def monthly(spark, data):
    """data: entity -> {month number: value}"""
    found = [(e, month(m), v) for e, values in data.items() for m, v in values.items()]
    return spark.createDataFrame(found, "agency_id int, date_key date, cost_usd double")


# --- keys ---

def test_fold_copies_takes_each_columns_maximum(spark):
    df = spark.createDataFrame([(1, "a", "Z"), (1, "b", "Y"), (2, None, "X")], "id int, p string, q string")
    assert rows(keys.fold_copies(df, "id", ["p", "q"])) == [(1, "b", "Z"), (2, None, "X")]


def test_lookup_keeps_rows_and_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows(keys.lookup(fact, dim, "k", ["name"])) == [(1, "one"), (1, "one"), (2, None), (None, None)]
    assert rows(keys.orphans(fact, dim, "k")) == [(2,), (None,)]
    assert rows(keys.orphans_by_key(fact, dim, "k")) == [(2, 1), (None, 1)]


def test_counted_small_hints_only_below_the_limit(spark):
    left = spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = left.join(keys.counted_small(spark.range(5), 5), "id", "left")
        large = left.join(keys.counted_small(spark.range(6), 5), "id", "left")
        assert "BroadcastHashJoin" in plan(small)
        assert "BroadcastHashJoin" not in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_number_rows(spark):
    dim = spark.createDataFrame([("b",), ("a",), (None,)], "name string")
    assert rows(keys.number_rows(dim, "name", "id"), "id") == [("a", 1), ("b", 2), (None, 3)]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_number_rows_by_ranges(spark, parts):
    values = [None if i % 50 == 0 else f"n{i * 7919 % 3001:05d}" for i in range(3000)] + ["n00007"] * 40
    dim = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "name string, i int").repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        numbered = keys.number_rows(dim, "name", "id")
        found = numbered.orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [r.id for r in found] == list(range(1, len(values) + 1))
    assert [r.name for r in found] == sorted(values, key=lambda v: (v is None, v or ""))
    assert sorted(r.i for r in found) == list(range(len(values)))
    assert "Window" not in plan(numbered) and "SinglePartition" not in plan(numbered)
    assert keys.number_rows(dim.limit(0), "name", "id").count() == 0


def test_both_numberings_agree(spark):
    agencies = spark.createDataFrame([(f"r{i % 23}", "g") for i in range(200)], "aws_pref_region string, region_group string")
    assert rows(dimensions.dim_region(agencies, few=True)) == rows(dimensions.dim_region(agencies, few=False))


# --- series ---

@pytest.mark.parametrize("n", [1, 2, 3, 6, 7])
def test_rolling_avg_windows(spark, n):
    df = monthly(spark, {1: {m: float(m) for m in range(1, n + 1)}})
    order = series.by_month(["agency_id"])
    found = rows(df.select("date_key", series.rolling_avg("cost_usd", order, 3),
                           series.rolling_avg("cost_usd", order, 6)), "date_key")
    for i, (_, three, six) in enumerate(found, 1):
        assert three == pytest.approx(sum(range(max(1, i - 2), i + 1)) / min(3, i))
        assert six == pytest.approx(sum(range(max(1, i - 5), i + 1)) / min(6, i))


def test_rolling_avg_skips_null(spark):
    df = monthly(spark, {1: {1: 10.0, 2: None, 3: 20.0}})
    found = rows(df.select("date_key", series.rolling_avg("cost_usd", series.by_month(["agency_id"]), 3)), "date_key")
    assert [r[1] for r in found] == [10.0, 10.0, 15.0]


def test_fill_months_adds_zeros_and_keeps_nulls(spark):
    df = monthly(spark, {1: {1: 5.0, 4: None}, 2: {2: 7.0}})
    assert rows(series.fill_months(df, ["agency_id"], "cost_usd")) == [
        (1, month(1), 5.0), (1, month(2), 0.0), (1, month(3), 0.0), (1, month(4), None), (2, month(2), 7.0)]


def test_fill_months_reads_its_input_once(spark):
    """Against plain dictionaries, with null entities and months; one shuffle, which a window that follows shares."""
    rng = random.Random(7)
    data = {(e, m): float(rng.randint(1, 9)) for e in (None, 1, 2, 3) for m in (None, *rng.sample(range(1, 13), 5))}
    frame = spark.createDataFrame([(e, m and month(m), v) for (e, m), v in data.items()], "agency_id int, date_key date, cost_usd double")
    filled = series.fill_months(frame, ["agency_id"], "cost_usd")
    expected = dict(data)
    for e in (None, 1, 2, 3):
        own = [m for x, m in data if x == e and m]
        expected |= {(e, m): 0.0 for m in range(min(own), max(own)) if m not in own}
    assert {(r[0], r[1] and r[1].month): r[2] for r in filled.collect()} == expected
    assert filled.count() == len(expected)
    followed = plan(filled.withColumn("before", F.lag("cost_usd").over(series.by_month(["agency_id"]))))
    assert followed.count("Exchange") == 1 and "Union" not in followed and "SortAggregate" not in followed


def test_run_rate_late_start(spark):
    df = monthly(spark, {1: {4: 100.0, 5: 200.0}, 2: {1: 50.0}})
    assert rows(series.run_rate(df, ["agency_id"], "cost_usd")) == [
        (1, "2024", 5, 300.0, 720.0, 60.0), (2, "2024", 1, 50.0, 600.0, 50.0)]
    assert rows(series.run_rate(df, ["agency_id"], "cost_usd", count_months=True))[0] == (
        1, "2024", 2, 300.0, 1800.0, 150.0)


def test_longest_run_against_brute_force(spark):
    rng = random.Random(4)
    data = {e: {m: float(rng.random() < 0.6) for m in range(1, 25)} for e in range(1, 9)}
    df = monthly(spark, data).withColumnRenamed("cost_usd", "hit")
    found = {r[0]: r[1:] for r in rows(series.longest_run(df, ["agency_id"], "hit"))}
    for e, values in data.items():
        runs = [len(list(g)) for hit, g in groupby(values.values()) if hit]
        assert found[e] == (sum(runs), max(runs, default=0))


# --- shares ---

def test_share_of_total_both_ways_agree_on_a_hot_group(spark):
    rng = random.Random(1)
    data = [(1, 2024, float(i % 7)) for i in range(500)]
    data += [(rng.choice([2, 3, None]), 2024, round(rng.random(), 2)) for _ in range(200)] + [(4, 2024, 0.0)]
    df = spark.createDataFrame(data, "a int, y int, v double").withColumn("i", F.monotonically_increasing_id())
    window = rows(shares.share_of_total(df, "v", ["a", "y"], "s", small_groups=True).select("i", "s"), "i")
    joined = rows(shares.share_of_total(df, "v", ["a", "y"], "s").select("i", "s"), "i")
    assert window == joined
    assert joined[-1][1] is None
    sums = rows(shares.share_of_total(df, "v", ["a", "y"], "s").groupBy("a").agg(F.sum("s")))
    assert all(s is None or s == pytest.approx(1.0) for _, s in sums)


def test_share_of_all(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "k int, v double")
    assert rows(shares.share_of_all(df, {"v": "s"})) == [(1, 1.0, 0.25), (2, 3.0, 0.75)]


# --- ranking ---

@pytest.mark.parametrize("ranges", [1, 2, 16, 256])
def test_ranks_with_a_third_of_rows_tied_and_an_outlier(spark, ranges):
    rng = random.Random(2)
    points = [0.0] * 100 + [rng.random() * 10 for _ in range(100)] + [1e12] * 3 + [-5.0]
    df = spark.createDataFrame(list(enumerate(points)), "id int, p double")
    found = with_ranks(df, ranks(df, "p", "r", descending=True, ranges=ranges), "p")
    found = with_ranks(found, ranks(df, "p", "share", percent=True, ranges=ranges), "p").select("id", "r", "share")
    assert rows(found, "id") == [
        (i, 1 + sum(q > p for q in points), sum(q < p for q in points) / (len(points) - 1)) for i, p in enumerate(points)]


def test_ranks_of_nothing_of_one_row_and_of_null(spark):
    for data, expected in (([], []), ([(1, 2.0)], [(1, 0.0)]), ([(1, None), (2, 1.0)], [(1, 1.0), (2, 0.0)])):
        df = spark.createDataFrame(data, "id int, p double")
        assert rows(with_ranks(df, ranks(df, "p", "r", percent=True), "p").select("id", "r")) == expected


def test_concentration_over_all_providers(spark):
    from cloudtally.plans.finops import provider_concentration

    spend = [(1, 2024, "Oracle", 900.0), (1, 2024, "AWS", 50.0), (1, 2024, "GCP", 50.0), (2, 2024, None, 3.0),
             (2, 2024, "AWS", 1.0), (3, 2024, "AWS", 0.0)]
    df = spark.createDataFrame(spend, "agency_id int, year int, cloud_provider string, spend_usd double")
    found = {r.agency_id: r for r in provider_concentration(df).collect()}
    one = found[1]
    assert (one.dominant_provider, one.dominant_share, one.high_dependence_flag, one.fragmented_flag) == ("Oracle", 0.9, 1, 0)
    assert (one.aws_share, one.azure_share, one.gcp_share) == (0.05, 0.0, 0.05)
    assert one.concentration_index == pytest.approx(0.815)
    assert (found[2].dominant_provider, found[2].dominant_share) == ("Unknown", 0.75)
    assert found[3].dominant_share is None and found[3].aws_share is None


def test_risk_ranks_agencies_with_only_a_budget_and_beside_an_outlier(spark):
    from cloudtally.plans.finops import financial_risk_rank

    waste = spark.createDataFrame(
        [(1, 100.0, 0.0, 0.0, 1e12), (2, 100.0, 10.0, 5.0, 7.0), (3, 100.0, 20.0, 6.0, 8.0)],
        "agency_id int, actual_spend_usd double, untagged_usd double, idle_usd double, high_risk_usd double")
    over = spark.createDataFrame([(2, 1.0), (3, 2.0), (4, -5.0)], "agency_id int, variance_usd double")
    found = {r.agency_id: r.risk_rank for r in financial_risk_rank(waste, over).collect()}
    assert found == {3: 1, 2: 2, 1: 3, 4: 4}


def test_rows_without_a_month_are_in_no_series(spark):
    from cloudtally.plans import facts, finops, views

    day = [f"2024-{m:02d}-01" for m in range(1, 6)]
    cost = spark.createDataFrame([(1, d, "IaaS", 100.0, 50.0, 1.0) for d in day] + [(1, None, "IaaS", 9000.0, 50.0, 1.0)],
                                 "agency_id int, day string, service_type string, cost_usd double, utilisation_pct double, "
                                 "compute_hours double").withColumn("date_key", F.to_date("day"))
    steps = finops.spend_forecast(facts.fact_forecast_input(cost)).orderBy("step").collect()
    assert steps[0].forecast == 100.0 and str(steps[0].forecast_month) == "2024-06-01"
    for frame in (views.v_cost_trends(cost), views.v_cost_spikes(cost)):
        assert frame.count() == 5 and frame.filter("date_key IS NULL").count() == 0
    assert finops.spike_drivers(cost).count() == 0
    assert finops.unmatched_spend(cost).first().unmatched_spend_usd == 0.0
    assert finops.acceleration_concentration(cost).first().increase_usd == 0.0


def test_fiscal_years_that_begin_in_october(spark):
    from cloudtally.operators.series import run_rate

    months = [("2023-10-01", 1.0), ("2024-01-01", 2.0), ("2024-09-01", 3.0), ("2024-10-01", 5.0)]
    df = spark.createDataFrame([(1, m, v) for m, v in months], "e int, m string, v double").withColumn(
        "date_key", F.to_date("m"))
    found = rows(run_rate(df, ["e"], "v", first_month=10).select("fiscal_year", "months_elapsed", "ytd_spend"))
    assert found == [("2024", 12, 6.0), ("2025", 1, 5.0)]
    assert rows(run_rate(df, ["e"], "v").select("fiscal_year", "months_elapsed")) == [("2023", 10), ("2024", 10)]


def test_top_k(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, g int")
    assert rows(top_k(df, [F.col("id").desc()], 2, "r")) == [(28, 1, 2), (29, 2, 1)]
    found = rows(top_k_within(df, ["g"], [F.col("id").asc()], 2, "r"), "g", "r")
    assert found == [(0, 0, 1), (3, 0, 2), (1, 1, 1), (4, 1, 2), (2, 2, 1), (5, 2, 2)]


# --- forecast ---

def test_forecast_of_an_exact_line_has_no_width(spark):
    df = spark.createDataFrame([(1, x, 10.0 + 2 * x) for x in range(1, 9)], "e int, x int, y double")
    found = rows(linear_forecast(df, "e", "x", "y", 3, 1.2816, 1.96))
    for step, row in enumerate(found, 1):
        assert row[2] == pytest.approx(10 + 2 * (8 + step))
        assert row[3:] == pytest.approx((row[2],) * 4, abs=1e-5)


def test_forecast_of_two_points_has_no_bands(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 7.0)], "e int, x int, y double")
    assert rows(linear_forecast(df, "e", "x", "y", 1, 1.0, 2.0)) == [(1, 1, 9.0, None, None, None, None)]


def test_forecast_of_a_constant(spark):
    df = spark.createDataFrame([(1, x, 4.0) for x in range(1, 6)], "e int, x int, y double")
    assert rows(linear_forecast(df, "e", "x", "y", 1, 1.0, 2.0)) == [(1, 1, 4.0, 4.0, 4.0, 4.0, 4.0)]


def test_forecast_bands_against_the_textbook(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.arange(1, 21)
    y = 100 + 3 * x + rng.normal(0, 5, 20)
    df = spark.createDataFrame([(1, int(a), float(b)) for a, b in zip(x, y)], "e int, x int, y double")
    row = rows(linear_forecast(df, "e", "x", "y", 2, 1.2816, 1.96))[1]
    slope, intercept = np.polyfit(x, y, 1)
    s = np.sqrt(((y - intercept - slope * x) ** 2).sum() / 18)
    error = s * np.sqrt(1 + 1 / 20 + (22 - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
    assert row[2] == pytest.approx(intercept + slope * 22)
    assert row[3] == pytest.approx(row[2] - 1.2816 * error)
    assert row[6] == pytest.approx(row[2] + 1.96 * error)


# --- measures with branches the sample tables lack ---

def test_spike_driver_counts_a_service_that_starts(spark):
    cost = spark.createDataFrame([
        (1, month(1), "IaaS", 100.0), (1, month(2), "IaaS", 110.0), (1, month(2), "SaaS", 40.0),
        (1, month(3), "IaaS", 50.0), (1, month(4), "Edge", 90.0), (1, month(4), None, 10.0),
    ], "agency_id int, date_key date, service_type string, cost_usd double")
    assert rows(finops.spike_drivers(cost)) == [
        (1, month(2), 50.0, "SaaS", 40.0, 0.8), (1, month(4), 50.0, "Other", 100.0, 2.0)]


def test_budget_sides_without_a_partner(spark):
    cost = monthly(spark, {1: {1: 100.0}, 2: {1: 50.0}})
    budget = spark.createDataFrame([(1, "2024-01", 80.0), (1, "2024-02", 80.0)],
                                   "agency_id int, month string, monthly_budget_usd double")
    assert rows(finops.budget_variance(cost, budget)) == [
        (1, month(1), 100.0, 80.0, 20.0, 0.25), (1, month(2), 0.0, 80.0, -80.0, -1.0),
        (2, month(1), 50.0, 0.0, 50.0, None)]
    status = rows(finops.budget_variance_ytd(finops.budget_variance(cost, budget)).select(
        "agency_id", "date_key", "ytd_variance_usd", "status"))
    assert status == [(1, month(1), 20.0, "Red"), (1, month(2), -60.0, "Green"), (2, month(1), 50.0, "Red")]


def test_provider_outside_the_list_counts_in_the_total(spark):
    spend = spark.createDataFrame([(1, 2024, "AWS", 60.0), (1, 2024, "Other cloud", 40.0)],
                                  "agency_id int, year int, cloud_provider string, spend_usd double")
    row = finops.provider_pivot(spend).first()
    assert (row.other_spend_usd, row.total_spend_usd, row.aws_share) == (40.0, 100.0, 0.6)


def test_forecast_counts_months_without_rows(spark):
    line = spark.createDataFrame([(1, month(m), 10.0 * m, i) for i, m in enumerate([1, 2, 3, 9, 10])],
                                 "agency_id int, date_key date, monthly_cost double, month_index int")
    found = finops.spend_forecast(line).orderBy("step").collect()
    assert [(str(r.forecast_month), r.forecast) for r in found[:2]] == [("2024-11-01", 110.0), ("2024-12-01", 120.0)]


@pytest.mark.parametrize("ranges", [1, 3, 256])
def test_ranks_within_groups(spark, ranges):
    pick = random.Random(7)
    data = [(g, None if pick.random() < 0.05 else float(pick.randrange(40 * (g + 1)))) for g in range(3) for _ in range(200)]
    frame = spark.createDataFrame(data, "g int, x double")
    found = {(r.g, r._v): r.rank for r in ranks(frame, "x", "rank", ranges=ranges, by=["g"]).collect()}
    for g, v in set(data):
        own = [x for h, x in data if h == g]
        assert found[g, v] == 1 + sum(x is not None and (v is None or x < v) for x in own)
