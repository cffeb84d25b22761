"""CSV files of the raw layer: comma separated, double quoted, backslash escaped, one header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cloudtally.sources.schemas import NULL_FOR_INVALID, RAW_SCHEMAS

CSV = {"sep": ",", "quote": '"', "escape": "\\", "header": "true"}


def read_raw(spark: SparkSession, name: str, path: str | list[str], mode: str | None = None,
             keep_corrupt: bool = False) -> DataFrame:
    """Scan the CSV files of one raw table under its declared schema.

    ``mode`` defaults to the table's own rule: values that do not fit the type become NULL
    (PERMISSIVE), or stop the read (FAILFAST). ``keep_corrupt`` adds the text of bad lines as
    ``_corrupt_record``.
    """
    schema = StructType.fromDDL(RAW_SCHEMAS[name])
    mode = mode or ("PERMISSIVE" if name in NULL_FOR_INVALID else "FAILFAST")
    if keep_corrupt:
        schema = schema.add("_corrupt_record", "string")
    return spark.read.schema(schema).options(**CSV, mode=mode).csv(path)


def write_raw(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV).csv(path)


class CsvInputs:
    """Raw inputs read from ``<folder>/<table>`` CSV folders or files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return read_raw(self.spark, name, self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def usage_monthly(self) -> DataFrame:
        return self._read("usage_monthly")

    def usage_months(self) -> DataFrame:
        return self.usage_monthly().select("month")

    def provider_spend(self) -> DataFrame:
        return self._read("provider_spend")

    def migration_summary(self) -> DataFrame:
        return self._read("migration_summary")

    def tagging_compliance(self) -> DataFrame:
        return self._read("tagging_compliance")

    def baseline_adoption(self) -> DataFrame:
        return self._read("baseline_adoption")

    def agencies(self) -> DataFrame:
        return self._read("agencies")

    def budget(self) -> DataFrame:
        return self._read("budget")
