"""Parquet layers: write a result, read it back, name it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


def together(jobs: Sequence[Callable[[], T]]) -> list[T]:
    """What independent jobs return, run at the same time: the few last tasks of one do not leave the cores to wait."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return list(pool.map(lambda job: job(), jobs))


def written(df: DataFrame, path: str, partition_by: Sequence[str] = (),
            count: Mapping[str, Column] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``rebuild``, with ``rows`` and the rows that meet each condition of ``count``, counted while they are written."""
    seen, names = Observation(), list(count or {})
    counts = [F.count_if(count[n]).alias(f"c{i}") for i, n in enumerate(names)]
    found = rebuild(df.observe(seen, F.count("*").alias("rows"), *counts), path, partition_by)
    got = observed(seen)
    return found, {"rows": got.get("rows", 0), **{n: got.get(f"c{i}", 0) for i, n in enumerate(names)}}


def observed(seen: Observation) -> dict[str, int]:
    """What was counted; nothing where Spark knew beforehand that there are no rows, and ran no observation."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = (), bucketed_table: str | None = None,
            bucket_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Drop and rebuild one Parquet table, and return it read back.

    With ``bucketed_table`` the table goes to the catalogue, bucketed, so that later joins and
    windows on the bucket columns need no shuffle.
    """
    spark = df.sparkSession
    if partition_by:
        # Sizes the files: small months share one, a month too large for one task is split.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucketed_table:
        if not bucket_by or buckets < 1:
            raise ValueError("a bucketed table needs bucket columns and a bucket count")
        writer.bucketBy(buckets, *bucket_by).option("path", path).saveAsTable(bucketed_table)
        return spark.table(bucketed_table)
    writer.save(path)
    # The schema is known, and a table without rows and with partitions has no file to tell it.
    return spark.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Name lazy results for SQL users; each is recomputed when read."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
