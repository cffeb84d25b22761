import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudtally.functions import dates
from cloudtally.functions.exact import exact_avg, exact_sum, moments, ratio, round_money
from cloudtally.functions.scoring import above, inside, up_to, weighted
from cloudtally.limits import Limits
from tests.conftest import rows

L = Limits()
COLOURS = ("Green", "Amber", "Red")


def one(spark, value, kind, build):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(build(F.col("v"))).first()[0]


@pytest.mark.parametrize("value, band", [
    (250.0, "Green"), (250.01, "Amber"), (500.0, "Amber"), (500.01, "Red"), (None, "Red")])
def test_latency_band(spark, value, band):
    assert one(spark, value, "double", lambda v: up_to(v, L.latency_bands, COLOURS)) == band


@pytest.mark.parametrize("value, band", [
    (1.0, "Green"), (1.01, "Amber"), (3.0, "Amber"), (3.5, "Red"), (None, "Red")])
def test_error_band(spark, value, band):
    assert one(spark, value, "double", lambda v: up_to(v, L.error_bands, COLOURS)) == band


@pytest.mark.parametrize("value, points", [
    (19.99, 60.0), (20.0, 100.0), (85.0, 100.0), (85.01, 40.0), (None, 40.0)])
def test_utilisation_points(spark, value, points):
    assert one(spark, value, "double", lambda v: inside(v, 20.0, 85.0, L.utilisation_points)) == points


@pytest.mark.parametrize("value, level", [(70.0, 0.8), (70.01, 2.0), (80.0, 2.0), (80.01, 3.5), (None, 0.8)])
def test_error_tiers(spark, value, level):
    assert one(spark, value, "double", lambda v: above(v, L.error_tiers, L.error_floor)) == level


def test_up_to_needs_one_more_label():
    with pytest.raises(ValueError):
        up_to(F.lit(1.0), (1.0,), ("a",))


def test_weighted(spark):
    value = spark.range(1).select(weighted([F.lit(100.0), F.lit(70.0), F.lit(60.0)], L.health_weights)).first()[0]
    assert value == pytest.approx(80.0)


@pytest.mark.parametrize("text, day", [
    ("2025-01", datetime.date(2025, 1, 1)), ("2025-12", datetime.date(2025, 12, 1)), ("2025-1", None),
    ("2025-13", None), ("", None), (None, None), ("junk", None), ("+2025-1", None), (" 2025-1", None),
    ("2025-1-", None), ("2025- 1", None), ("2025-01 ", None), ("2025/01", None), ("202-501", None)])
def test_month_start(spark, text, day):
    assert one(spark, text, "string", dates.month_start) == day


@pytest.mark.parametrize("text, pattern, day", [
    ("7/1/2025", "d/M/yyyy", datetime.date(2025, 1, 7)), ("7/1/2025", "M/d/yyyy", datetime.date(2025, 7, 1)),
    ("", "d/M/yyyy", None), (None, "d/M/yyyy", None), ("31/02/2025", "d/M/yyyy", None), ("xx", "d/M/yyyy", None)])
def test_parse_day(spark, text, pattern, day):
    assert one(spark, text, "string", lambda v: dates.parse_day(v, pattern)) == day


def test_calendar_attributes(spark):
    df = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-12-01', interval 1 month)) AS d")
    found = rows(df.select("d", dates.quarter_label(F.col("d")), dates.peak_flag(F.col("d"), L.peak_months),
                           dates.month_number_key(F.col("d"))))
    assert [r[1] for r in found] == [f"2025-Q{(m - 1) // 3 + 1}" for m in range(1, 13)]
    assert [r[2] for r in found] == [1, 1, 1, 0, 0, 0, 1, 1, 1, 0, 0, 0]
    assert found[11][3] == 202512


def test_exact_sum_ignores_order_and_partitions(spark):
    values = [0.1, 0.2, 0.3, 1e12, -1e12, 0.0001, None] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    totals = {df.repartition(n).agg(exact_sum("v")).first()[0] for n in (1, 3, 17)}
    assert totals == {30.005}


@pytest.mark.parametrize("values, total", [
    ([4e-7, 4e-7], 8e-7), ([1e-12] * 3, 3e-12), ([2.123457589], 2.123457589), ([1e6, 4e-7, -1e6], 4e-7),
    ([139267.9365, 0.1, 0.2], 139268.2365), ([float("nan"), 1.5], 1.5), ([float("inf"), 2.0, float("-inf")], 2.0),
    ([None, float("nan")], None)])
def test_exact_sum_keeps_small_amounts_and_skips_what_is_no_number(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(exact_sum("v")).first()[0] == total


@pytest.mark.parametrize("digits, total", [(2, 0.14), (6, 0.143457), (9, 0.143456789), (12, 0.143456789123)])
def test_exact_sum_keeps_the_digits_asked_for(spark, digits, total):
    df = spark.createDataFrame([(0.143456789123,), (0.0,)], "v double")
    assert df.agg(exact_sum("v", digits)).first()[0] == total


def test_exact_sum_of_large_numbers(spark):
    df = spark.createDataFrame([(4e15,), (5e15,), (0.25,), (-1.5,)], "v double")
    assert df.agg(exact_sum("v")).first()[0] == 8999999999999998.75


def test_exact_sum_stops_rather_than_wraps(spark):
    df = spark.createDataFrame([(9e18,), (9e18,)], "v double")
    with pytest.raises(Exception, match="(?i)overflow"):
        df.agg(exact_sum("v")).first()


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.agg(exact_avg("v")).first()[0] == 1.5
    assert df.filter("v IS NULL").agg(exact_avg("v")).first()[0] is None


def test_ratio_of_zero(spark):
    assert spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_round_money_halves(spark):
    found = spark.range(1).select(round_money(F.lit(1.005)), round_money(F.lit(-1.005))).first()
    assert tuple(found) == (1.01, -1.01)


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_moments_do_not_depend_on_order(spark, offset):
    pick = random.Random(3)
    data = [(i % 3, offset + pick.gauss(0, 1), 5 + pick.gauss(0, 40) * (i % 3)) for i in range(3000)]
    frame = spark.createDataFrame([*data, (0, None, 1.0), (0, 1.0, float("nan")), (1, float("inf"), 2.0), (9, 1.0, 2.0)],
                                  "g int, x double, y double")
    m = moments("x", "y")

    def found(parts):
        spread = frame.repartition(parts).groupBy("g").agg(m.n.alias("n"), m.corr().alias("r"), m.slope().alias("slope"),
                                                           m.intercept().alias("intercept"), m.syy.alias("syy"))
        return sorted(tuple(r) for r in spread.collect())
    first = found(1)
    assert first == found(7) == found(200)
    for g, n, r, slope, intercept, syy in first[:3]:
        x, y = (np.round([row[k] for row in data if row[0] == g], 6) for k in (1, 2))
        assert n == 1000 and syy == pytest.approx(((y - y.mean()) ** 2).sum(), rel=1e-9)
        if g:
            assert r == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-9)
            line = np.polyfit(x - x.mean(), y, 1)
            assert slope == pytest.approx(line[0], rel=1e-8)
            assert intercept == pytest.approx(line[1] - line[0] * x.mean(), rel=1e-8)
        else:
            assert r is None and slope == pytest.approx(0, abs=1e-12)
    assert first[3] == (9, 1, None, None, None, 0.0)
