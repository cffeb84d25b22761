"""The star schema over any set of raw inputs, every table lazy."""

from __future__ import annotations

from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.limits import Limits
from cloudtally.operators.keys import is_small
from cloudtally.plans import dimensions, facts


class RawInputs(Protocol):
    def usage_monthly(self) -> DataFrame: ...
    def usage_months(self) -> DataFrame: ...
    def provider_spend(self) -> DataFrame: ...
    def migration_summary(self) -> DataFrame: ...
    def tagging_compliance(self) -> DataFrame: ...
    def agencies(self) -> DataFrame: ...
    def budget(self) -> DataFrame: ...


class Warehouse:
    """Dimensions and facts by name.

    Tables are plans, not data: asking for one starts no job, but for the row count that lets the region
    dimension be broadcast. The ``*_rows`` are the same facts without dimension ids, for plans that use none.
    """

    def __init__(self, spark: SparkSession, inputs: RawInputs, limits: Limits = Limits()):
        self.spark = spark
        self.inputs = inputs
        self.limits = limits

    @cached_property
    def usage_monthly(self) -> DataFrame:
        return self.inputs.usage_monthly()

    @cached_property
    def tagging_compliance(self) -> DataFrame:
        return self.inputs.tagging_compliance()

    @cached_property
    def agencies(self) -> DataFrame:
        return self.inputs.agencies()

    @cached_property
    def dim_agency_clean(self) -> DataFrame:
        return dimensions.dim_agency_clean(self.agencies)

    @cached_property
    def dim_service(self) -> DataFrame:
        return dimensions.dim_service(self.spark)

    @cached_property
    def _few_regions(self) -> bool:
        return is_small(dimensions.regions(self.agencies))

    @cached_property
    def dim_region(self) -> DataFrame:
        return dimensions.dim_region(self.agencies, self._few_regions)

    @cached_property
    def dim_region_small(self) -> DataFrame:
        return F.broadcast(self.dim_region) if self._few_regions else self.dim_region

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.inputs.usage_months(), self.limits)

    @cached_property
    def fact_usage_monthly(self) -> DataFrame:
        return facts.fact_usage_monthly(self.usage_monthly, self.dim_service, self.dim_region_small)

    @cached_property
    def usage_rows(self) -> DataFrame:
        return facts.fact_usage_monthly(self.usage_monthly)

    @cached_property
    def fact_cost_monthly(self) -> DataFrame:
        return facts.fact_cost_monthly(
            self.usage_monthly, self.dim_service, self.dim_region_small, limits=self.limits)

    @cached_property
    def cost_rows(self) -> DataFrame:
        return facts.fact_cost_monthly(self.usage_monthly, limits=self.limits)

    @cached_property
    def fact_performance(self) -> DataFrame:
        return facts.fact_performance(self.fact_usage_monthly, limits=self.limits)

    @cached_property
    def performance_rows(self) -> DataFrame:
        return facts.fact_performance(self.usage_rows, limits=self.limits)

    @cached_property
    def fact_migration_summary(self) -> DataFrame:
        return facts.fact_migration_summary(self.inputs.migration_summary(), self.dim_agency_clean)

    @cached_property
    def fact_tagging_compliance(self) -> DataFrame:
        return facts.fact_tagging_compliance(self.tagging_compliance, self.dim_date)

    @cached_property
    def fact_finance_governance(self) -> DataFrame:
        return facts.fact_finance_governance(self.tagging_compliance, self.dim_date, self.limits)

    @cached_property
    def fact_provider_spend(self) -> DataFrame:
        # Only inputs that group a raw table by its grain can say, without a job, that its keys are unique.
        return facts.fact_provider_spend(self.inputs.provider_spend(), "provider_spend" in getattr(self.inputs, "unique", ()))

    @cached_property
    def fact_provider_finance(self) -> DataFrame:
        return self.fact_provider_spend

    @cached_property
    def fact_forecast_input(self) -> DataFrame:
        return facts.fact_forecast_input(self.cost_rows)
