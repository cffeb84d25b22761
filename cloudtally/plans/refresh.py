"""One refresh: raw inputs to written dimensions and facts, the quality gate, then the switch to the new set.

Every raw table is computed once, into Parquet; all that follows reads that. Row counts and rules are counted while
tables are written, so the gate itself scans only keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.functions.dates import month_start
from cloudtally.limits import Limits
from cloudtally.operators.digests import changed_periods, period_digest
from cloudtally.operators.keys import counted_small
from cloudtally.operators.quality import QualityError, assert_clean
from cloudtally.plans import checks, dimensions, facts, views
from cloudtally.plans.warehouse import RawInputs
from cloudtally.sources import published
from cloudtally.sources.intake import Landed, land, land_frame
from cloudtally.sources.layers import load, publish_views, rebuild, replace_partitions, together, written
from cloudtally.sources.raw import CsvInputs

RAW = ("usage_monthly", "migration_summary", "tagging_compliance", "provider_spend", "agencies")
#: Tables partitioned by year, and the raw table whose periods they follow.
BY_YEAR = {
    "fact_usage_monthly": "usage_monthly", "fact_cost_monthly": "usage_monthly", "fact_performance": "usage_monthly",
    "fact_tagging_compliance": "tagging_compliance", "fact_finance_governance": "tagging_compliance",
    "fact_provider_spend": "provider_spend",
}
_YEAR = ("year",)


def _period(raw: str) -> Column:
    """The text that digests are kept by: a month, or a year of provider spend."""
    return F.col("year").cast("string") if raw == "provider_spend" else F.col("month")


def _year(raw: str) -> Column:
    return F.col("year") if raw == "provider_spend" else F.year(month_start(F.col("month")))


@dataclass
class _Run:
    """The tables of one run, and what was counted while they were written."""

    spark: SparkSession
    folder: str
    limits: Limits
    raw: dict[str, Landed] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    repeated: dict[str, int] = field(default_factory=dict)

    def land(self, inputs: RawInputs) -> None:
        rules = {r: {} for r in RAW}
        for rule in [*checks.finite_rules(), checks.month_rule()]:
            rules[rule.table.removeprefix("raw_")][rule.name] = rule.fails

        def landed(name: str) -> Landed:
            out = f"{self.folder}/raw_{name}"
            # A subclass may make a table in a way of its own; then that frame is landed, not its files.
            files = getattr(type(inputs), name) is getattr(CsvInputs, name)
            return land(self.spark, name, inputs.path(name), out, rules[name]) if files else land_frame(
                getattr(inputs, name)(), out, rules[name])
        self.raw = dict(zip(RAW, together([partial(landed, n) for n in RAW]), strict=True))
        grain = checks.dq_grain({n: r.rows for n, r in self.raw.items()})
        self.repeated = {r["table_name"].removeprefix("raw_"): r["failing_rows"] for r in grain.collect()}

    def keep(self, name: str, df: DataFrame, by_year: bool = False) -> DataFrame:
        if by_year and "year" not in df.columns:
            df = df.withColumn("year", F.year("date_key"))
        rules: Mapping[str, Column] = {r.name: r.fails for r in [*checks.null_key_rules(), *checks.bounds_rules()]
                                       if r.table == name}
        self.tables[name], self.counts[name] = written(df, f"{self.folder}/{name}", _YEAR if by_year else (), rules)
        return self.tables[name]

    def dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        agencies, usage = self.raw["agencies"].rows, self.raw["usage_monthly"].rows
        return (self.keep("dim_agency_clean", dimensions.dim_agency_clean(agencies)),
                self.keep("dim_service", dimensions.dim_service(self.spark)),
                counted_small(self.keep("dim_region", dimensions.dim_region(agencies))),
                self.keep("dim_date", dimensions.dim_date(usage, self.limits)))

    def monthly(self, rows: Mapping[str, DataFrame], service: DataFrame, region: DataFrame, date: DataFrame) -> None:
        """The tables by year, made from (some years of) the raw rows."""
        def used() -> None:
            usage = self.keep("fact_usage_monthly", facts.fact_usage_monthly(rows["usage_monthly"], service, region, date), True)
            together([lambda: self.keep("fact_cost_monthly", facts.cost_of_usage(usage, self.limits), True),
                      lambda: self.keep("fact_performance", facts.fact_performance(usage, date, self.limits), True)])

        def tagged() -> None:
            tagging = self.keep("fact_tagging_compliance", facts.fact_tagging_compliance(rows["tagging_compliance"], date), True)
            self.keep("fact_finance_governance", facts.governance_of(tagging, self.limits), True)

        def spent() -> None:
            # Only a key that was shown to be unique bounds the groups of a window.
            unique = self.repeated["provider_spend"] == 0
            self.keep("fact_provider_spend", facts.fact_provider_spend(rows["provider_spend"], unique), True)
        together([used, tagged, spent])

    def gate(self, agency: DataFrame, raw_rows: Mapping[str, int], allow_quarantine: bool,
             left: Mapping[str, DataFrame]) -> list[tuple[str, str, int]]:
        """Every check as (table, check, failing rows); raises ``QualityError`` if one fails.

        ``left`` are the rows of published tables that stay: their agencies must be there still.
        """
        found = [(t, "Row count reconciliation", abs(self.counts[t]["rows"] - raw_rows[r]))
                 for t, r in checks.SOURCES.items()]
        found += [(t, name, n) for t, counted in self.counts.items() for name, n in counted.items() if name != "rows"]
        for name, landed in self.raw.items():
            found += [(f"raw_{name}", rule, n) for rule, n in landed.counts.items() if rule not in ("kept", "nulled", "quarantined")]
            found.append((f"raw_{name}", "Quarantined lines", landed.counts["quarantined"]))
        found += [(f"raw_{t}", "Repeated key", n) for t, n in self.repeated.items()]
        whole = {n: df.unionByName(left[n].select(*df.columns)) if n in left else df for n, df in self.tables.items()}
        found += [tuple(r) for r in checks.dq_orphans(whole, agency).collect()]
        fails = [c for c in found if not (allow_quarantine and c[1] == "Quarantined lines")]
        assert_clean(self.spark.createDataFrame(fails, "table_name string, check_type string, failing_rows long"))
        return found

    def digests(self) -> None:
        def kept(name: str) -> DataFrame:
            return self.keep(f"digest_{name}", period_digest(self.raw[name].rows, _period(name), _year(name)))
        together([partial(kept, n) for n in sorted(set(BY_YEAR.values()))])


def refresh(spark: SparkSession, inputs: RawInputs, root: str, limits: Limits = Limits(),
            allow_quarantine: bool = False) -> dict[str, DataFrame]:
    """Build every table in a new folder below ``root`` and, if all checks are clean, point readers to it.

    A failed check raises ``QualityError``; readers of ``published.open_published(spark, root)`` then still get the last
    good set. Quarantined lines of CSV inputs fail the gate unless ``allow_quarantine``. Monthly facts are partitioned by
    year, cost and performance are made from the written usage fact. Returns the tables and the views over them.
    """
    run = _Run(spark, published.new_run(root), limits)
    run.land(inputs)
    agency, service, region, date = run.dimensions()
    run.monthly({n: r.rows for n, r in run.raw.items()}, service, region, date)
    return _finish(run, root, agency, {}, {n: r.counts["kept"] for n, r in run.raw.items()}, allow_quarantine)


def refresh_changed(spark: SparkSession, inputs: RawInputs, root: str, limits: Limits = Limits(),
                    allow_quarantine: bool = False) -> dict[str, DataFrame]:
    """``refresh``, rewriting only the years whose raw rows changed since the last published set.

    Raw rows are compared by digests per month that do not depend on their order. The partitions of changed years are
    built and checked apart, then replaced in the published folders, and the pointer, which also names the new digests,
    is switched last: a run that breaks off between is repeated by the next one. While partitions are replaced, readers
    may see some of them new and some old. Without a published set, or if regions were added or taken away, which numbers
    them anew in all facts, every year is rewritten.
    """
    last = published.published(spark, root)
    if not last:
        return refresh(spark, inputs, root, limits, allow_quarantine)
    run = _Run(spark, published.new_run(root), limits)
    run.land(inputs)
    agency, service, region, date = run.dimensions()
    if _differ(published.open_published(spark, root)["dim_region"], run.tables["dim_region"]):
        run.monthly({n: r.rows for n, r in run.raw.items()}, service, region, date)
        return _finish(run, root, agency, {}, {n: r.counts["kept"] for n, r in run.raw.items()}, allow_quarantine)
    rows, years = {}, {}
    for name in set(BY_YEAR.values()):
        new = period_digest(run.raw[name].rows, _period(name), _year(name))
        # Years are bounded by the calendar.
        years[name] = [r[0] for r in changed_periods(load(spark, last[f"digest_{name}"]), new).select("year").distinct().collect()]
        rows[name] = run.raw[name].rows.filter(_among(_year(name), years[name]))
    run.monthly(rows, service, region, date)
    expected = {n: r.counts["kept"] for n, r in run.raw.items()} | {n: df.count() for n, df in rows.items()}
    return _finish(run, root, agency, {t: (last[t], years[r]) for t, r in BY_YEAR.items()}, expected, allow_quarantine)


def _differ(old: DataFrame, new: DataFrame) -> bool:
    new = new.select(*old.columns)
    return bool(old.exceptAll(new).unionAll(new.exceptAll(old)).limit(1).count())


def _among(year: Column, years: Iterable[int | None]) -> Column:
    known = [y for y in years if y is not None]
    return F.coalesce(year.isin(known), F.lit(False)) | (year.isNull() & F.lit(None in years))


def _finish(run: _Run, root: str, agency: DataFrame, replaced: dict[str, tuple[str, list[int | None]]],
            raw_rows: Mapping[str, int], allow_quarantine: bool) -> dict[str, DataFrame]:
    """The tables without years, the gate, the replaced partitions, and the switch."""
    run.keep("fact_migration_summary", facts.fact_migration_summary(run.raw["migration_summary"].rows, agency))
    before = published.open_published(run.spark, root) if replaced else {}
    left = {n: before[n].filter(~_among(F.col("year"), years)) for n, (_, years) in replaced.items()}
    run.gate(agency, raw_rows, allow_quarantine, left)
    run.digests()
    places = {n: f"{run.folder}/{n}" for n in run.tables}
    for name, (path, years) in replaced.items():
        if years:
            replace_partitions(run.tables[name], path, _YEAR)
        left = {r[0] for r in run.tables[name].select("year").distinct().collect()} if years else set()
        for year in set(years) - left:
            folder = "__HIVE_DEFAULT_PARTITION__" if year is None else year
            published.drop_partition(run.spark, f"{path}/year={folder}")
        places[name] = path
    cost = run.spark.read.schema(run.tables["fact_cost_monthly"].schema).parquet(places["fact_cost_monthly"])
    places["fact_forecast_input"] = f"{run.folder}/fact_forecast_input"
    run.tables["fact_forecast_input"] = rebuild(facts.fact_forecast_input(cost), places["fact_forecast_input"])
    places["fact_provider_finance"], run.tables["fact_provider_finance"] = places["fact_provider_spend"], run.tables["fact_provider_spend"]
    published.publish(run.spark, root, {n: (p, run.tables[n].schema) for n, p in places.items()})
    tables = published.open_published(run.spark, root)
    named = lazy_views(tables, run.limits)
    publish_views(named)
    return {**tables, **named}


def lazy_views(tables: Mapping[str, DataFrame], limits: Limits = Limits()) -> dict[str, DataFrame]:
    cost, performance = tables["fact_cost_monthly"], tables["fact_performance"]
    return {
        "v_cost_trends": views.v_cost_trends(cost, limits),
        "v_cost_spikes": views.v_cost_spikes(cost, limits=limits),
        "v_cloud_waste": views.v_cloud_waste(cost, limits),
        "v_budget_runrate": views.v_budget_runrate(cost),
        "v_seasonality_index": views.v_seasonality_index(cost, limits),
        "v_sla_bands": views.v_sla_bands(performance, limits),
    }


__all__ = ["BY_YEAR", "QualityError", "lazy_views", "refresh", "refresh_changed"]
