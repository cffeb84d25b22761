"""Names in the catalogue: external tables over written folders, and views as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {_text(location)}")


def create_table(spark: SparkSession, database: str, name: str, schema: StructType, path: str,
                 partition_by: Sequence[str] = ()) -> None:
    """An external Parquet table over ``path``, in place of one of that name; its partitions are found anew."""
    table = f"{quoted(database)}.{quoted(name)}"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    parts = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION {_text(path)}")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def create_view(spark: SparkSession, database: str, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)} AS {query}")
