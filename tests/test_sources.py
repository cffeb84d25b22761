import pytest

from cloudtally.plans import facts, views
from cloudtally.plans.refresh import refresh
from cloudtally.operators.quality import QualityError
from cloudtally.sources.layers import rebuild
from cloudtally.sources.raw import CsvInputs, read_raw, write_raw
from cloudtally.sources.sample_inputs import SampleInputs
from cloudtally.sources.schemas import RAW_SCHEMAS
from tests.conftest import plan, rows

SPEND = "agency_id,country,country_code,year,cloud_provider,spend_usd\n"


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_quotes_commas_and_escapes(spark, tmp_path):
    path = write(tmp_path, "spend.csv", SPEND + '1,"Isle, North","N\\"N",2024,AWS,1.5\n2,,X,2024,GCP,\n')
    assert rows(read_raw(spark, "provider_spend", path)) == [
        (1, "Isle, North", 'N"N', 2024, "AWS", 1.5), (2, None, "X", 2024, "GCP", None)]


def test_invalid_value_becomes_null_or_stops(spark, tmp_path):
    path = write(tmp_path, "spend.csv", SPEND + "1,C,CC,2024,AWS,oops\n")
    found = read_raw(spark, "provider_spend", path, keep_corrupt=True).collect()
    assert found[0].spend_usd is None and "oops" in found[0]._corrupt_record
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        read_raw(spark, "provider_spend", path, mode="FAILFAST").collect()


def test_usage_stops_on_invalid_values(spark, tmp_path):
    columns = [c.split()[0] for c in RAW_SCHEMAS["usage_monthly"].split(", ")]
    path = write(tmp_path, "usage.csv", ",".join(columns) + "\n1,C,CC,2024-01,IaaS,x,1,1,1,1,r,Pre,1\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        read_raw(spark, "usage_monthly", path).collect()


def test_column_pruning_reaches_the_csv_scan(spark, tmp_path):
    path = write(tmp_path, "spend.csv", SPEND + "1,C,CC,2024,AWS,1.0\n")
    text = plan(read_raw(spark, "provider_spend", path).select("year"))
    assert "ReadSchema: struct<year:int>" in text


def test_rebuild_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    rebuild(spark.range(5), path)
    assert rebuild(spark.range(3), path).count() == 3


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [rebuild(spark.range(50).withColumnRenamed("id", "agency_id"), str(tmp_path / n), bucketed_table=n,
                          bucket_by=["agency_id"], buckets=4) for n in ("bucketed_a", "bucketed_b")]
        joined = frames[0].join(frames[1], "agency_id")
        assert joined.count() == 50
        assert "Exchange hashpartitioning" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {n}")


@pytest.fixture(scope="module")
def csv_folder(spark, sample_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    sample = SampleInputs(spark, sample_dir)
    for name in RAW_SCHEMAS:
        write_raw(getattr(sample, name)(), f"{folder}/{name}")
    return str(folder)


def test_refresh_from_csv_equals_the_lazy_tables(spark, csv_folder, warehouse, tmp_path):
    built = refresh(spark, CsvInputs(spark, csv_folder), str(tmp_path / "run1"))
    for name in ("fact_usage_monthly", "fact_cost_monthly", "fact_performance", "fact_finance_governance",
                 "fact_provider_spend", "fact_forecast_input", "fact_migration_summary", "dim_agency_clean",
                 "dim_region", "dim_date"):
        lazy = getattr(warehouse, name)
        assert rows(built[name].select(*lazy.columns)) == rows(lazy), name
    assert rows(built["v_cost_trends"]) == rows(views.v_cost_trends(warehouse.cost_rows))
    assert spark.sql("SELECT COUNT(*) FROM v_sla_bands").first()[0] == built["fact_performance"].count()


def test_a_year_filter_prunes_partitions(spark, csv_folder, tmp_path):
    built = refresh(spark, CsvInputs(spark, csv_folder), str(tmp_path / "run2"))
    text = plan(built["fact_performance"].filter("year = 1997").select("cost_usd"))
    assert "PartitionFilters: [isnotnull(year" in text


def test_a_bad_row_holds_the_refresh(spark, csv_folder, tmp_path):
    class Broken(CsvInputs):
        def usage_monthly(self):
            good = super().usage_monthly()
            return good.unionByName(good.limit(1).selectExpr(
                *[c if c != "agency_id" else "-1 AS agency_id" for c in good.columns]))

    with pytest.raises(QualityError, match="fact_usage_monthly: Orphaned agency_id: 1"):
        refresh(spark, Broken(spark, csv_folder), str(tmp_path / "run3"))


def test_sample_inputs_have_the_declared_schemas(spark, sample_dir):
    from pyspark.sql.types import StructType

    sample = SampleInputs(spark, sample_dir)
    for name, ddl in RAW_SCHEMAS.items():
        found = getattr(sample, name)()
        assert [(f.name, f.dataType) for f in found.schema] == [
            (f.name, f.dataType) for f in StructType.fromDDL(ddl)], name


def test_provider_share_of_an_all_zero_year(spark):
    spend = spark.createDataFrame([(1, "c", "cc", 2024, "AWS", 0.0), (2, "c", "cc", 2024, "AWS", 5.0)],
                                  RAW_SCHEMAS["provider_spend"])
    assert [r[6] for r in rows(facts.fact_provider_spend(spend))] == [None, 1.0]
