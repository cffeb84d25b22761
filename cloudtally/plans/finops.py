"""Cost, budget, governance and provider measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.functions.exact import MONEY_DIGITS, exact_avg, exact_sum, flag, ratio
from cloudtally.limits import PROVIDERS, SERVICES, Limits
from cloudtally.operators.forecast import linear_forecast
from cloudtally.operators.keys import lookup
from cloudtally.operators.ranking import ranks, top_k, with_ranks
from cloudtally.operators.series import (
    by_month,
    dated,
    growth,
    longest_run,
    rolling_sum,
    running_sum,
    to_grain,
    year_end,
)
from cloudtally.operators.shares import pivot_sum, share_of_all, share_of_total
from cloudtally.plans.facts import monthly_spend, with_date_key
from cloudtally.session import stored


def actual_spend(cost_fact: DataFrame, agency: DataFrame) -> DataFrame:
    """Spend per agency with the labels a chargeback needs."""
    spend = to_grain(cost_fact, ["agency_id"], "cost_usd", "actual_spend_usd")
    return lookup(spend, agency, "agency_id", ["agency_name", "country", "sector_type"]).select(
        "agency_id", "agency_name", "country", "sector_type", "actual_spend_usd")


# --- budget ---

def budget_variance(cost_fact: DataFrame, budget: DataFrame) -> DataFrame:
    """Actual against budget per agency and month, in dollars and as a fraction of the budget.

    Months with only one of the two are kept, the other counting as 0.
    """
    planned = to_grain(with_date_key(budget), ["agency_id", "date_key"], "monthly_budget_usd", "budget_usd")
    actual = monthly_spend(cost_fact).withColumnRenamed("monthly_cost", "actual_usd")
    both = actual.join(planned, ["agency_id", "date_key"], "full").select(
        "agency_id", "date_key",
        F.coalesce("actual_usd", F.lit(0.0)).alias("actual_usd"),
        F.coalesce("budget_usd", F.lit(0.0)).alias("budget_usd"))
    return _with_variance(both, "actual_usd", "budget_usd", "variance_usd", "variance_pct")


def _with_variance(df: DataFrame, actual: str, budget: str, name: str, share: str) -> DataFrame:
    return df.withColumn(name, F.col(actual) - F.col(budget)).withColumn(share, ratio(F.col(name), F.col(budget)))


def budget_over_time(variance: DataFrame) -> DataFrame:
    """The portfolio's actual and budgeted spend by month."""
    monthly = dated(variance).groupBy("date_key").agg(
        exact_sum("actual_usd").alias("actual_usd"), exact_sum("budget_usd").alias("budget_usd"))
    return _with_variance(monthly, "actual_usd", "budget_usd", "variance_usd", "variance_pct")


def budget_variance_ytd(variance: DataFrame, limits: Limits = Limits(), first_month: int = 1) -> DataFrame:
    """Running totals within each agency's year, coloured by the overrun. Years begin in ``first_month``."""
    order = Window.partitionBy("agency_id", "fiscal_year").orderBy(F.col("date_key").asc_nulls_last())
    running = variance.withColumn("fiscal_year", F.year(year_end("date_key", first_month))).select(
        "agency_id", "fiscal_year", "date_key",
        running_sum("actual_usd", order).alias("ytd_actual_usd"),
        running_sum("budget_usd", order).alias("ytd_budget_usd"))
    over = F.col("ytd_variance_usd")
    colour = F.when(over <= 0, "Green").when(
        over <= F.col("ytd_budget_usd") * limits.budget_yellow_share, "Yellow").otherwise("Red")
    return _with_variance(running, "ytd_actual_usd", "ytd_budget_usd", "ytd_variance_usd", "ytd_variance_pct") \
        .withColumn("status", colour)


def recurring_overruns(variance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Months over budget per agency, and the longest run of them."""
    marked = variance.select("agency_id", "date_key", flag(F.col("variance_usd") > 0).alias("over"))
    return longest_run(marked, ["agency_id"], "over").select(
        "agency_id", F.col("hits").alias("months_over"), "longest_run",
        flag(F.col("longest_run") >= limits.overrun_months).alias("recurring_flag"))


# --- trend and forecast ---

def spike_drivers(cost_fact: DataFrame) -> DataFrame:
    """For each month in which an agency's cost rose: the service that rose most, and its share of the rise.

    Services become columns first, so that one that starts or stops in a month counts with 0.
    """
    names = [*SERVICES, "Other"]
    service = F.coalesce(F.when(F.col("service_type").isin(*SERVICES), F.col("service_type")), F.lit("Other"))
    wide = pivot_sum(cost_fact.withColumn("_service", service), ["agency_id", "date_key"], "_service", "cost_usd",
                     {n: n for n in names})
    order = by_month(["agency_id"])
    rises = wide.select("agency_id", "date_key", *[(F.col(n) - F.lag(n).over(order)).alias(n) for n in names])
    total = F.col(names[0])
    for n in names[1:]:
        total = total + F.col(n)
    largest = F.greatest(*[F.struct(F.col(n).alias("rise"), F.lit(n).alias("service")) for n in names])
    return (
        dated(rises).withColumns({"total_increase_usd": total, "_top": largest})
        .filter(F.col("total_increase_usd") > 0)
        .select(
            "agency_id", "date_key", "total_increase_usd", F.col("_top.service").alias("driver_service"),
            F.col("_top.rise").alias("driver_increase_usd"),
            ratio(F.col("_top.rise"), F.col("total_increase_usd")).alias("driver_share"))
    )


def spend_forecast(forecast_input: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Linear trend per agency with 80 % and 95 % bands, to whole cents.

    The line is over calendar months, so that a month without rows counts as time that passed.
    """
    months = dated(forecast_input).withColumn("_month", F.year("date_key") * 12 + F.month("date_key"))
    ahead = linear_forecast(months, "agency_id", "_month", "monthly_cost", limits.forecast_horizon,
                            limits.band_z_80, limits.band_z_95, date="date_key")
    values = ("forecast", "low_80", "high_80", "low_95", "high_95")
    return ahead.select("agency_id", "step", "forecast_month", *[F.round(v, 2).alias(v) for v in values])


def spend_trend(cost_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Portfolio spend by month. The window runs over months, which the calendar bounds, not over rows."""
    monthly = to_grain(cost_fact, ["date_key"], "cost_usd", "total_spend_usd")
    order = Window.orderBy(F.col("date_key").asc_nulls_last())
    change = growth(F.col("total_spend_usd"), F.lag("total_spend_usd").over(order)) * 100
    return monthly.select(
        "date_key", "total_spend_usd", F.round(change, 2).alias("mom_growth_pct"),
        rolling_sum("total_spend_usd", order, limits.trend_months).alias("rolling_3m_spend_usd"))


def service_mix(cost_fact: DataFrame) -> DataFrame:
    """Each service's share of a month's spend."""
    spend = to_grain(cost_fact, ["date_key", "service_type"], "cost_usd", "spend_usd")
    return share_of_total(spend, "spend_usd", ["date_key"], "spend_share", small_groups=True)


def latest_growth(cost_fact: DataFrame) -> DataFrame:
    """Each agency's growth in its latest month."""
    order = by_month(["agency_id"])
    return (
        monthly_spend(dated(cost_fact))
        .withColumns({
            "previous_cost": F.lag("monthly_cost").over(order),
            "_next": F.lead("date_key").over(order),
        })
        .filter(F.col("_next").isNull())
        .select("agency_id", "date_key", "monthly_cost", "previous_cost",
                (growth(F.col("monthly_cost"), F.col("previous_cost")) * 100).alias("growth_pct"))
    )


def top_growth_agencies(cost_fact: DataFrame, k: int = 10) -> DataFrame:
    grown = latest_growth(cost_fact).filter(F.col("growth_pct").isNotNull())
    return top_k(grown, [F.col("growth_pct").desc(), F.col("agency_id").asc()], k, "growth_rank")


def acceleration_concentration(cost_fact: DataFrame, k: int = 2) -> DataFrame:
    """The k agencies with the largest sum of month-on-month increases, and their share of all increases."""
    rise = F.col("monthly_cost") - F.lag("monthly_cost").over(by_month(["agency_id"]))
    risen = dated(monthly_spend(cost_fact).withColumn("_rise", F.greatest(rise, F.lit(0.0))))
    increases = risen.groupBy("agency_id").agg(
        exact_sum("_rise", MONEY_DIGITS).alias("increase_usd"))
    known = increases.filter(F.col("increase_usd").isNotNull())
    order = [F.col("increase_usd").desc(), F.col("agency_id").asc()]
    top = top_k(share_of_all(known, {"increase_usd": "share_of_increase"}), order, k, "increase_rank")
    so_far = Window.orderBy("increase_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return top.withColumn("cumulative_share", F.sum("share_of_increase").over(so_far))


# --- tagging and waste ---

def _tagging_columns() -> list[Column]:
    return [
        F.count("*").alias("records"), exact_avg("tagged_pct").alias("avg_tagged_pct"),
        exact_avg("tagging_gap").alias("avg_tagging_gap"), F.sum("governance_risk_flag").alias("risk_records"),
        exact_sum("untagged_cost_usd").alias("untagged_cost_usd"),
    ]


def tagging_summary(governance: DataFrame) -> DataFrame:
    return governance.groupBy("agency_id").agg(*_tagging_columns())


def tagging_trend(governance: DataFrame) -> DataFrame:
    return governance.groupBy("date_key").agg(*_tagging_columns())


def untagged_share(governance: DataFrame, cost_fact: DataFrame) -> DataFrame:
    """Untagged cost as a fraction of actual spend per agency."""
    untagged = to_grain(governance, ["agency_id"], "untagged_cost_usd")
    spend = to_grain(cost_fact, ["agency_id"], "cost_usd", "actual_spend_usd")
    return spend.join(untagged, "agency_id", "full").select(
        "agency_id", "actual_spend_usd", "untagged_cost_usd",
        ratio(F.col("untagged_cost_usd"), F.col("actual_spend_usd")).alias("untagged_share"))


def governance_heat(governance: DataFrame) -> DataFrame:
    """Risk flag by agency, year and calendar month; NULL where nothing was reported."""
    months = [F.max(F.when(F.month("date_key") == m, F.col("governance_risk_flag"))).alias(f"m{m:02d}")
              for m in range(1, 13)]
    return governance.groupBy("agency_id", F.year("date_key").alias("year")).agg(*months)


def waste_by_service(cost_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    idle = F.when(F.col("utilisation_pct") < limits.idle_utilisation, F.col("cost_usd")).otherwise(F.lit(0.0))
    return cost_fact.groupBy("agency_id", "service_type").agg(
        exact_sum("cost_usd").alias("actual_spend_usd"), exact_sum(idle).alias("idle_cost_usd"),
    ).withColumn("waste_pct", ratio(F.col("idle_cost_usd"), F.col("actual_spend_usd")) * 100)


def unmatched_spend(cost_fact: DataFrame) -> DataFrame:
    """Spend of months in which a service cost more without more utilisation or compute, per agency."""
    monthly = cost_fact.groupBy("agency_id", "service_type", "date_key").agg(
        exact_sum("cost_usd").alias("cost_usd"), exact_avg("utilisation_pct").alias("utilisation_pct"),
        exact_sum("compute_hours").alias("compute_hours"))
    order = by_month(["agency_id", "service_type"])
    before = {c: F.lag(c).over(order) for c in ("cost_usd", "utilisation_pct", "compute_hours")}
    idle_rise = (
        (F.col("cost_usd") > before["cost_usd"])
        & (F.col("utilisation_pct") <= before["utilisation_pct"])
        & (F.col("compute_hours") <= before["compute_hours"])
    )
    return dated(monthly.withColumn("_hit", idle_rise)).groupBy("agency_id").agg(
        exact_sum("cost_usd").alias("total_spend_usd"),
        exact_sum(F.when(F.col("_hit"), F.col("cost_usd")).otherwise(F.lit(0.0))).alias("unmatched_spend_usd"),
    ).withColumn("unmatched_share", ratio(F.col("unmatched_spend_usd"), F.col("total_spend_usd")))


def optimisation_total(performance: DataFrame, governance: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Untagged, idle and high-risk spend per agency; high-risk is the cost of rows in breach."""
    cost = F.col("cost_usd")
    spend = performance.groupBy("agency_id").agg(
        exact_sum(cost).alias("actual_spend_usd"),
        exact_sum(F.when(F.col("utilisation_pct") < limits.idle_utilisation, cost).otherwise(F.lit(0.0)))
        .alias("idle_usd"),
        exact_sum(F.when(F.col("sla_breach_flag") == 1, cost).otherwise(F.lit(0.0))).alias("high_risk_usd"))
    untagged = to_grain(governance, ["agency_id"], "untagged_cost_usd", "untagged_usd")
    parts = ("actual_spend_usd", "untagged_usd", "idle_usd", "high_risk_usd")
    return spend.join(untagged, "agency_id", "full").select(
        "agency_id", *[F.coalesce(p, F.lit(0.0)).alias(p) for p in parts],
    ).withColumn("optimisation_usd", F.col("untagged_usd") + F.col("idle_usd") + F.col("high_risk_usd"))


# --- providers ---

_PROVIDER_COLUMNS = {p: f"{p.lower()}_spend_usd" for p in PROVIDERS}


def _provider_columns(provider_fact: DataFrame, by: list[str]) -> DataFrame:
    known = F.col("cloud_provider").isin(*PROVIDERS)
    named = provider_fact.withColumn(
        "_provider", F.coalesce(F.when(known, F.col("cloud_provider")), F.lit("Other")))
    wide = pivot_sum(named, by, "_provider", "spend_usd", {**_PROVIDER_COLUMNS, "Other": "other_spend_usd"})
    total = F.col("other_spend_usd")
    for column in _PROVIDER_COLUMNS.values():
        total = total + F.col(column)
    wide = wide.withColumn("total_spend_usd", total)
    return wide.withColumns({
        f"{p.lower()}_share": ratio(F.col(_PROVIDER_COLUMNS[p]), F.col("total_spend_usd")) for p in PROVIDERS})


def provider_pivot(provider_fact: DataFrame) -> DataFrame:
    """Spend by provider and year, with shares."""
    return _provider_columns(provider_fact, ["year"])


def provider_concentration(provider_fact: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Dependence on one provider, or spread over many, per agency and year, over all providers there are.

    Spend without a provider is one of its own, ``Unknown``. Of providers with equal spend the last by name
    dominates. The shares of the known three are shown besides.
    """
    own = F.coalesce("cloud_provider", F.lit("Unknown")).alias("_provider")
    spend = provider_fact.groupBy("agency_id", "year", own).agg(exact_sum("spend_usd").alias("_spend"))
    shared = share_of_total(spend, "_spend", ["agency_id", "year"], "_share")

    def named(provider: str) -> Column:
        found = F.max(F.when(F.col("_provider") == provider, F.col("_share")))
        return F.when(F.max("_share").isNotNull(), F.coalesce(found, F.lit(0.0))).alias(f"{provider.lower()}_share")
    top, index = F.col("_top"), F.col("concentration_index")
    return (
        shared.groupBy("agency_id", "year").agg(
            *map(named, PROVIDERS), F.max(F.struct("_share", "_provider")).alias("_top"),
            exact_sum(F.col("_share") * F.col("_share")).alias("concentration_index"))
        .select(
            "agency_id", "year", *[f"{p.lower()}_share" for p in PROVIDERS],
            top["_provider"].alias("dominant_provider"), top["_share"].alias("dominant_share"), "concentration_index",
            flag(top["_share"] > limits.high_dependence_share).alias("high_dependence_flag"),
            flag(index <= limits.fragmented_index).alias("fragmented_flag"))
    )


# --- combined ---

def financial_risk_rank(optimisation: DataFrame, variance: DataFrame) -> DataFrame:
    """All agencies ranked on overrun, waste, untagged and high-risk spend together, the riskiest first.

    The score is the mean of the four parts' percent ranks; agencies with equal scores share a rank. Agencies
    with only a budget, or only spend, count as 0 in the parts they lack.
    """
    overrun = variance.groupBy("agency_id").agg(exact_sum("variance_usd", MONEY_DIGITS).alias("_variance"))
    parts = optimisation.join(overrun, "agency_id", "full").select(
        "agency_id",
        F.greatest(F.coalesce("_variance", F.lit(0.0)), F.lit(0.0)).alias("overrun_usd"),
        F.coalesce(ratio(F.col("idle_usd"), F.col("actual_spend_usd")), F.lit(0.0)).alias("waste_share"),
        *[F.coalesce(n, F.lit(0.0)).alias(n) for n in ("untagged_usd", "high_risk_usd")])
    names = ("overrun_usd", "waste_share", "untagged_usd", "high_risk_usd")
    # One row per agency; the facts behind it are computed once for all that reads it.
    parts = stored(parts.withColumn("_row", F.monotonically_increasing_id()), "risk-parts")
    cells = parts.select("_row", "agency_id", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col(n).alias("value")) for i, n in enumerate(names)])).alias("cell")).select("_row", "agency_id", "cell.*")
    shares = ranks(cells, "value", "share", percent=True, by=["part"])
    ranked = cells.join(shares.withColumnRenamed("part", "_part"), (F.col("part") == F.col("_part")) & F.col("value").eqNullSafe(F.col("_v")))
    # One percent rank for each part, added in their order.
    by_part = ranked.groupBy("_row", "agency_id").agg(*[F.max(F.when(F.col("part") == i, F.col("value"))).alias(n) for i, n in enumerate(names)],
                                              *[F.max(F.when(F.col("part") == i, F.col("share"))).alias(f"_{n}") for i, n in enumerate(names)])
    total = F.col(f"_{names[0]}")
    for n in names[1:]:
        total = total + F.col(f"_{n}")
    scored = by_part.withColumn("risk_score", total / len(names)).select("agency_id", *names, "risk_score")
    return with_ranks(scored, ranks(scored, "risk_score", "risk_rank", descending=True), "risk_score")
