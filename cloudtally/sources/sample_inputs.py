"""The raw inputs, derived from the sample order tables.

The warehouse's own raw files are not published, so suppliers stand for agencies, shipped lines for
metered usage and orders for tagging and provider attributes. Each function returns a lazy frame with
the schema of ``RAW_SCHEMAS``.

Lines are summed before anything is joined to them, per agency, month and service, and before their orders
also per order: a supplier or an order that holds a third of all lines leaves every map task as few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.functions.dates import month_text
from cloudtally.functions.exact import exact_avg
from cloudtally.session import stored
from cloudtally.sources.raw import write_raw

# Fixed values of the mapping.
CUTOVER = "1998-07-01"
UNTAGGED = "4-NOT SPECIFIED"
SECTORS = ("Finance", "Health", "Justice", "Education")


class SampleInputs:
    """Raw inputs over one folder of ``<table>.parquet`` files."""

    #: Raw tables that end in a grouping by their documented grain, so that no key can repeat.
    unique = ("tagging_compliance", "provider_spend", "migration_summary")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each file's footer is read once per instance, however many inputs use the table."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def _supplier_places(self, rows: DataFrame | None = None) -> DataFrame:
        """Suppliers with their country and region; with ``rows``, those rows joined to their supplier.

        One table is joined at a time, to the rows: the size of each is then known from its file, so
        Spark broadcasts what is small. A prejoined supplier table would be guessed as far too large.
        """
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").cast("int").alias("agency_id"), "s_name", "s_nationkey", "s_acctbal")
        found = suppliers if rows is None else rows.join(suppliers, "agency_id", "left")
        return (
            found.join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .withColumns({
                "country": F.col("n_name"),
                "country_code": F.concat(F.lit("C"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")),
            })
        )

    def agencies(self) -> DataFrame:
        """One row per supplier, two for every tenth, so that the dimension build has copies to fold."""
        region = F.col("r_name")
        return self._supplier_places().select(
            "agency_id",
            F.col("s_name").alias("agency_name"),
            "country",
            "country_code",
            _size(F.col("s_acctbal")).alias("org_size"),
            F.element_at(F.array(*[F.lit(s) for s in SECTORS]), F.col("agency_id") % 4 + 1).alias("sector_type"),
            region.alias("aws_pref_region"),
            F.when(region == "AMERICA", "USD").when(region == "EUROPE", "EUR").otherwise("XCD").alias("currency"),
            F.when(region == "AMERICA", "Americas").when(region.isin("EUROPE", "MIDDLE EAST"), "EMEA")
            .otherwise("APAC").alias("region_group"),
            F.when(F.col("agency_id") % 10 == 0, 2).otherwise(1).alias("copies"),
        ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")

    def usage_monthly(self) -> DataFrame:
        net = _cents("l_extendedprice") * (100 - _cents("l_discount"))
        flag = F.col("l_returnflag")
        cells = (
            self.table("lineitem")
            .groupBy(
                F.col("l_suppkey").cast("int").alias("agency_id"),
                F.trunc("l_shipdate", "month").alias("first_day"),
                F.when(flag == "A", "IaaS").when(flag == "N", "PaaS").otherwise("SaaS").alias("service_type"),
            )
            .agg(
                F.sum("l_quantity").alias("quantity"),
                _units(_cents("l_extendedprice"), 100).alias("gross"),
                _units(net, 10000).alias("net"),
                F.count("*").alias("lines"),
            )
        )
        after = (F.col("agency_id") % 2 == 0) & (F.col("first_day") >= F.lit(CUTOVER).cast("date"))
        return self._supplier_places(cells).select(
            "agency_id", "country", "country_code",
            month_text(F.col("first_day")).alias("month"),
            "service_type",
            (F.col("quantity") * 10).alias("compute_hours"),
            (F.col("gross") / 100).alias("storage_gb"),
            F.col("quantity").alias("data_egress_gb"),
            (F.col("quantity") * 2 / F.col("lines")).alias("utilisation_pct"),
            F.col("net").alias("cost_usd"),
            F.when(F.col("agency_id") % 7 == 0, "ASIA").otherwise(F.col("r_name")).alias("aws_region"),
            F.when(after, "Post").otherwise("Pre").alias("migration_status"),
            F.col("lines").cast("int").alias("resource_count"),
        )

    def usage_months(self) -> DataFrame:
        """The months of ``usage_monthly``, each once, straight from the lines."""
        months = self.table("lineitem").select(F.trunc("l_shipdate", "month").alias("first_day")).distinct()
        return months.select(month_text(F.col("first_day")).alias("month"))

    def _ordered_lines(self, *by: Column) -> DataFrame:
        """Lines per order, agency and ``by``, summed before their order is joined: a hot order joins as few rows."""
        lines = self.table("lineitem").groupBy(
            "l_orderkey", F.col("l_suppkey").cast("int").alias("agency_id"), *by).agg(
            F.count("*").alias("lines"), F.sum(_cents("l_extendedprice")).alias("cents"))
        return lines.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def tagging_compliance(self) -> DataFrame:
        untagged = F.col("o_orderpriority") == UNTAGGED
        cells = (
            self._ordered_lines(F.trunc("l_shipdate", "month").alias("first_day"))
            .groupBy("agency_id", "first_day")
            .agg(
                F.sum("lines").alias("lines"),
                F.sum(F.when(untagged, 0).otherwise(F.col("lines"))).alias("tagged"),
                _units(F.when(untagged, F.col("cents")).otherwise(0), 100).alias("untagged_cost_usd"),
            )
        )
        return self._supplier_places(cells).select(
            "agency_id", "country", "country_code",
            month_text(F.col("first_day")).alias("month"),
            (F.lit(100.0) * F.col("tagged") / F.col("lines")).alias("tagged_pct"),
            "untagged_cost_usd",
        )

    def provider_spend(self) -> DataFrame:
        status = F.col("o_orderstatus")
        cells = (
            self._ordered_lines()
            .groupBy(
                "agency_id",
                F.year("o_orderdate").alias("year"),
                F.when(status == "F", "AWS").when(status == "O", "Azure").otherwise("GCP").alias("cloud_provider"),
            )
            .agg(_units(F.col("cents"), 100).alias("spend_usd"))
        )
        return self._supplier_places(cells).select(
            "agency_id", "country", "country_code", "year", "cloud_provider", "spend_usd")

    def migration_summary(self) -> DataFrame:
        cents, early = _cents("l_extendedprice"), F.to_date("l_shipdate") < F.lit(CUTOVER).cast("date")
        heavy = F.col("l_quantity") > 40
        pre, post = F.col("pre_migration_cost_usd"), F.col("post_migration_cost_usd")
        moved = F.col("agency_id") % 2 == 0
        cells = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").cast("int").alias("agency_id"))
            .agg(
                _units(F.when(early, cents).otherwise(0), 100).alias("pre_migration_cost_usd"),
                _units(F.when(early, 0).otherwise(cents), 100).alias("post_migration_cost_usd"),
                F.count_if(early & heavy).cast("int").alias("sla_breaches_pre"),
                F.count_if(~early & heavy).cast("int").alias("sla_breaches_post"),
            )
        )
        day = F.concat((1 + F.col("agency_id") % 9).cast("string"), F.lit("/7/1998"))
        return self._supplier_places(cells).select(
            "agency_id", "country", "country_code",
            _size(F.col("s_acctbal")).alias("org_size"),
            F.when(moved, "Yes").otherwise("No").alias("migrated"),
            F.when(moved, day).otherwise("").alias("migration_date"),
            pre, post,
            F.when(moved, 20.0).otherwise(0.0).alias("expected_savings_pct"),
            (F.lit(100.0) * (pre - post) / F.nullif(pre, F.lit(0.0))).alias("realized_savings_pct"),
            "sla_breaches_pre", "sla_breaches_post",
        )

    def baseline_adoption(self) -> DataFrame:
        # Orders are counted per customer and year first, so a customer with very many orders joins as few rows.
        orders = (
            self.table("orders")
            .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
            .agg(F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("adopted"))
        )
        return (
            orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(
                F.col("n_name").alias("country"),
                F.concat(F.lit("C"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"),
                "year",
                _size(F.col("c_acctbal")).alias("org_size"),
            )
            .agg((F.lit(100.0) * F.sum("adopted") / F.sum("orders")).alias("adoption_pct"))
        )

    def budget(self) -> DataFrame:
        """An agency's mean monthly cost in whole dollars, for each month from its first to its last.

        Months without usage have a budget, so that the budget join has rows without a partner.
        """
        net = _cents("l_extendedprice") * (100 - _cents("l_discount"))
        totals = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").cast("int").alias("agency_id"),
                     F.trunc("l_shipdate", "month").alias("first_day"))
            .agg(_units(net, 10000).alias("net"))
            .groupBy("agency_id")
            .agg(
                F.min("first_day").alias("first_day"), F.max("first_day").alias("last_day"),
                F.floor(exact_avg("net")).cast("double")
                .alias("monthly_budget_usd"),
            )
        )
        every_month = F.sequence("first_day", "last_day", F.expr("interval 1 month"))
        return self._supplier_places(totals).select(
            "agency_id", F.explode(every_month).alias("day"), "monthly_budget_usd",
        ).select("agency_id", month_text(F.col("day")).alias("month"), "monthly_budget_usd")

    def event_log(self) -> DataFrame:
        return self.table("events").select(
            "ts", "user_id", (F.col("event_type") == "error").alias("is_error"),
            F.col("value").alias("latency_ms"))


def write_with_faults(df: DataFrame, path: str, key: str) -> None:
    """The rows as CSV, countries with a comma in them, and a broken line beside each: by the key's remainder by three it
    has too few fields, text in the key's place, or a field too many."""
    rows = stored(df.withColumn("country", F.concat("country", F.lit(", "), "country_code")), "faults")
    write_raw(rows, path)
    kind = F.pmod(F.col(key), F.lit(3))
    write_raw(rows.filter(kind == 0).select(*df.columns[:2]), path, "append")
    write_raw(rows.filter(kind == 1).withColumn(key, F.lit("n/a")), path, "append")
    write_raw(rows.filter(kind == 2).withColumn("more", F.lit("1")), path, "append")


def _cents(name: str) -> Column:
    """A two-digit amount as whole hundredths: integer sums are exact and stay in generated code."""
    return F.rint(F.col(name) * 100).cast("long")


def _units(amount: Column, per_unit: int) -> Column:
    """Exact total of integer amounts, scaled to units.

    High and low bits are summed apart: neither integer overflows below 8e12 rows in one group.
    """
    high, low = F.sum(F.shiftright(amount, 20)), F.sum(amount.bitwiseAND(F.lit((1 << 20) - 1)))
    return ((high.cast("decimal(28,0)") * (1 << 20) + low) / per_unit).cast("double")


def _size(balance: Column) -> Column:
    return F.when(balance < 2500, "Small").when(balance < 6500, "Medium").otherwise("Large")
