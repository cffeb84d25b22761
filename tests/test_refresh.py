"""Landing, the gate, the switch to a new set, and the rewriting of changed years only."""

import os
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from cloudtally.operators.digests import changed_periods, period_digest
from cloudtally.operators.quality import QualityError
from cloudtally.plans import refresh as refreshed
from cloudtally.plans.refresh import refresh, refresh_changed
from cloudtally.sources import intake
from cloudtally.sources.intake import land, land_frame
from cloudtally.sources.published import new_run, open_published, publish, published
from cloudtally.sources.raw import CsvInputs, write_raw
from cloudtally.sources.sample_inputs import SampleInputs
from cloudtally.sources.schemas import RAW_SCHEMAS
from tests.conftest import rows

SPEND = "agency_id,country,country_code,year,cloud_provider,spend_usd\n"
BAD = SPEND + '1,"Isle, North",CC,2024,AWS,1.5\n2,C,CC,2024,AWS,oops\n3,C\n4,C,CC,2024,AWS,1.0,9\n5,C,CC,2024,GCP,NaN\n\n'


@pytest.fixture(scope="module")
def raw_folder(spark, sample_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name in RAW_SCHEMAS:
        write_raw(getattr(SampleInputs(spark, sample_dir), name)(), f"{folder}/{name}")
    return str(folder)


def copied(raw_folder, tmp_path):
    shutil.copytree(raw_folder, tmp_path / "raw")
    return str(tmp_path / "raw")


def add(spark, folder, name, frame):
    frame.coalesce(1).write.mode("append").options(header="true", escape="\\").csv(f"{folder}/{name}")


# --- landing ---

def test_bad_lines_are_set_aside_and_counted(spark, tmp_path):
    (tmp_path / "spend.csv").write_text(BAD)
    got = land(spark, "provider_spend", str(tmp_path / "spend.csv"), str(tmp_path / "out"), {"dear": F.col("spend_usd") > 1})
    assert got.counts == {"kept": 3, "nulled": 1, "quarantined": 2, "dear": 2}  # NaN is above every number
    assert [r[:2] + r[5:] for r in rows(got.rows.fillna(-1.0, ["spend_usd"]))][:2] == [(1, "Isle, North", 1.5), (2, "C", -1.0)]
    assert rows(got.quarantine) == [("3,C", "fields"), ("4,C,CC,2024,AWS,1.0,9", "fields")]
    assert got.rows.columns == [c.split()[0] for c in RAW_SCHEMAS["provider_spend"].split(", ")]


def test_a_table_without_null_for_invalid_sets_bad_values_aside(spark, tmp_path):
    (tmp_path / "t.csv").write_text("agency_id,country,country_code,month,tagged_pct,untagged_cost_usd\n"
                                    "1,C,CC,2024-01,x,1\n1,C,CC,2024-02,90,\n")
    got = land(spark, "tagging_compliance", str(tmp_path / "t.csv"), str(tmp_path / "out"))
    assert got.counts == {"kept": 1, "nulled": 0, "quarantined": 1}
    assert rows(got.quarantine) == [("1,C,CC,2024-01,x,1", "value: tagged_pct")]
    assert rows(got.rows) == [(1, "C", "CC", "2024-02", 90.0, None)]


def test_empty_files_land_as_empty_tables(spark, tmp_path):
    (tmp_path / "t.csv").write_text(SPEND)
    got = land(spark, "provider_spend", str(tmp_path / "t.csv"), str(tmp_path / "out"))
    assert got.counts["kept"] == 0 and got.rows.count() == 0 and got.quarantine.count() == 0
    none = land_frame(spark.createDataFrame([], RAW_SCHEMAS["budget"]), str(tmp_path / "frame"))
    assert none.counts["kept"] == 0 and none.rows.count() == 0


def test_every_raw_file_is_parsed_once(spark, raw_folder, tmp_path, monkeypatch):
    """The files are gone as soon as they have landed: nothing later can read them."""
    folder = copied(raw_folder, tmp_path)
    plain = intake.land

    def once(spark, name, path, *more):
        landed = plain(spark, name, path, *more)
        shutil.rmtree(path)
        return landed
    monkeypatch.setattr(refreshed, "land", once)
    built = refresh(spark, CsvInputs(spark, folder), str(tmp_path / "out"))
    assert built["fact_usage_monthly"].count() > 0
    assert not {*refreshed.RAW} & {*os.listdir(folder)}


# --- the gate and the switch ---

def broken(spark, folder):
    """A NaN amount, a repeated key, a line of two fields."""
    one = spark.read.csv(f"{folder}/provider_spend", header=True).limit(1)
    add(spark, folder, "provider_spend", one.withColumn("spend_usd", F.lit("NaN")))
    add(spark, folder, "tagging_compliance", spark.read.csv(f"{folder}/tagging_compliance", header=True).limit(1))
    add(spark, folder, "agencies", spark.createDataFrame([("7", "short")], "agency_id string, agency_name string"))


def test_a_failed_gate_leaves_the_last_good_set(spark, raw_folder, tmp_path):
    folder, root = copied(raw_folder, tmp_path), str(tmp_path / "out")
    refresh(spark, CsvInputs(spark, folder), root)
    before = published(spark, root)
    good = rows(open_published(spark, root)["fact_provider_spend"])
    broken(spark, folder)
    for run in (refresh, refresh_changed):
        with pytest.raises(QualityError) as failure:
            run(spark, CsvInputs(spark, folder), root)
        for line in ("raw_provider_spend: Amount not finite: 1", "raw_provider_spend: Repeated key: 1",
                     "raw_tagging_compliance: Repeated key: 1", "raw_agencies: Quarantined lines: 1"):
            assert line in str(failure.value)
        assert published(spark, root) == before
        assert rows(open_published(spark, root)["fact_provider_spend"]) == good


def test_quarantine_may_be_allowed(spark, raw_folder, tmp_path):
    folder = copied(raw_folder, tmp_path)
    add(spark, folder, "agencies", spark.createDataFrame([("7", "short")], "agency_id string, agency_name string"))
    refresh(spark, CsvInputs(spark, folder), str(tmp_path / "out"), allow_quarantine=True)


def test_the_pointer_is_replaced_whole(spark, tmp_path):
    root = str(tmp_path)
    assert published(spark, root) == {} and open_published(spark, root) == {}
    publish(spark, root, {"a": ("x", spark.range(1).schema)})
    publish(spark, root, {"b": ("y", spark.range(1).schema)})
    assert published(spark, root) == {"b": "y"}
    assert not [f for f in os.listdir(root) if f.startswith("_current")]
    assert new_run(root) != new_run(root)


# --- changed periods ---

def test_digests_do_not_depend_on_order_but_on_rows(spark):
    schema = "month string, a int, b string"
    base = [("2024-01", 1, "x"), ("2024-01", 1, "x"), ("2024-02", None, "y"), (None, 3, None)]

    def digest(data, parts=1):
        frame = spark.createDataFrame(data, schema).repartition(parts)
        return period_digest(frame, F.col("month"), F.substring("month", 1, 4).cast("int"))
    old = digest(base)
    assert rows(digest(base[::-1], 4)) == rows(old)
    assert changed_periods(old, digest(base[::-1], 3)).count() == 0

    def changed(data):
        return rows(changed_periods(old, digest(data)))
    assert changed([*base, ("2025-01", 1, "x")]) == [("2025-01", 2025)]
    assert changed(base[1:]) == [("2024-01", 2024)]
    assert changed(base[:2] + base[3:]) == [("2024-02", 2024)]
    assert changed([*base[:2], ("2024-02", 7, None), base[3]]) == [("2024-02", 2024)]
    assert changed([*base, (None, 3, None), (None, 3, None)]) == [(None, None)]
    assert changed([("2024-01", 1, "z"), ("2024-01", 1, "z"), *base[2:]]) == [("2024-01", 2024)]
    # A NULL and its neighbour trade places.
    assert changed([*base[:2], ("2024-02", None, "y"), (None, None, None)]) == [(None, None)]


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs
            if f.endswith(".parquet")}


def test_one_changed_month_rewrites_one_year(spark, raw_folder, tmp_path):
    folder, root = copied(raw_folder, tmp_path), str(tmp_path / "out")
    refresh(spark, CsvInputs(spark, folder), root)
    place = published(spark, root)["fact_cost_monthly"]
    before = files(place)
    usage = spark.read.csv(f"{folder}/usage_monthly", header=True)
    extra = usage.filter("month = '1995-03'").limit(1).withColumn("cost_usd", F.lit("12.5"))
    add(spark, folder, "usage_monthly", extra)
    changed = refresh_changed(spark, CsvInputs(spark, folder), root)
    after = files(place)
    touched = {f.split("year=")[1][:4] for f in {*before.items()} ^ {*after.items()} for f in [f[0]]}
    assert touched == {"1995"}
    whole = refresh(spark, CsvInputs(spark, folder), str(tmp_path / "full"))
    for name in ("fact_usage_monthly", "fact_cost_monthly", "fact_performance", "fact_tagging_compliance",
                 "fact_provider_spend", "fact_forecast_input", "dim_date", "fact_finance_governance"):
        assert rows(changed[name].select(*whole[name].columns)) == rows(whole[name]), name
    again = files(place)
    refresh_changed(spark, CsvInputs(spark, folder), root)
    assert files(place) == again


def test_a_year_without_rows_left_is_removed(spark, raw_folder, tmp_path):
    folder, root = copied(raw_folder, tmp_path), str(tmp_path / "out")

    class Some(CsvInputs):
        years = ("1994", "1995")

        def usage_monthly(self):
            return super().usage_monthly().filter(F.substring("month", 1, 4).isin(*self.years))

        def tagging_compliance(self):
            return super().tagging_compliance().filter(F.substring("month", 1, 4).isin(*self.years))
    refresh(spark, Some(spark, folder), root)
    Some.years = ("1995",)
    left = refresh_changed(spark, Some(spark, folder), root)
    assert rows(left["fact_cost_monthly"].select("year").distinct()) == [(1995,)]
    assert rows(left["v_cost_trends"].select(F.year("date_key")).distinct()) == [(1995,)]


def test_a_new_region_renumbers_every_year(spark, raw_folder, tmp_path):
    folder, root = copied(raw_folder, tmp_path), str(tmp_path / "out")
    refresh(spark, CsvInputs(spark, folder), root)
    place = published(spark, root)["fact_usage_monthly"]
    before = files(place)
    agencies = spark.read.csv(f"{folder}/agencies", header=True)
    add(spark, folder, "agencies", agencies.limit(1).withColumn("agency_id", F.lit("999999")).withColumn(
        "aws_pref_region", F.lit("AAA")))
    changed = refresh_changed(spark, CsvInputs(spark, folder), root)
    whole = refresh(spark, CsvInputs(spark, folder), str(tmp_path / "full"))
    assert rows(changed["fact_usage_monthly"]) == rows(whole["fact_usage_monthly"])
    assert changed["fact_usage_monthly"].agg(F.min("region_id")).first()[0] == 2
    assert files(place) == before, "the set that was published stays as it was"


def test_an_agency_taken_away_is_missed_in_years_that_stay(spark, raw_folder, tmp_path):
    root = str(tmp_path / "out")

    class Fewer(CsvInputs):
        least = -1

        def agencies(self):
            return super().agencies().filter(F.col("agency_id") > self.least)
    refresh(spark, Fewer(spark, raw_folder), root)
    Fewer.least = 0
    with pytest.raises(QualityError, match="fact_usage_monthly: Orphaned agency_id"):
        refresh_changed(spark, Fewer(spark, raw_folder), root)


def test_raw_tables_are_landed_at_the_same_time(spark, sample_dir, tmp_path):
    """Two inputs that wait for each other; one after the other, the first would wait in vain."""
    meet = threading.Barrier(2, timeout=60)

    class Waiting(SampleInputs):
        def usage_monthly(self):
            meet.wait()
            return super().usage_monthly()

        def provider_spend(self):
            meet.wait()
            return super().provider_spend()
    tables = refresh(spark, Waiting(spark, sample_dir), str(tmp_path / "set"))
    assert tables["fact_performance"].count() == SampleInputs(spark, sample_dir).usage_monthly().count()
