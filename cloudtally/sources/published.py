"""Sets of tables under one root: each run has a folder of its own, and a small pointer file names the good ones.

Readers follow the pointer, which is replaced in one rename. A run that fails leaves it, and all it points to, as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_POINTER = "current"


def new_run(root: str) -> str:
    return f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, tables: dict[str, tuple[str, StructType]]) -> None:
    """Point readers of ``root`` to these folders, table name -> (path, schema), all at once."""
    target, files = _path(spark, f"{root.rstrip('/')}/{_POINTER}")
    fresh, _ = _path(spark, f"{root.rstrip('/')}/_{_POINTER}-{uuid.uuid4().hex}")
    out = files.create(fresh, False)
    try:
        out.write(bytearray(json.dumps({n: [p, schema.jsonValue()] for n, (p, schema) in tables.items()}, indent=1).encode()))
    finally:
        out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, target, how)


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name -> path of the last good set; empty before the first one."""
    return {n: path for n, (path, _) in _pointer(spark, root).items()}


def _pointer(spark: SparkSession, root: str) -> dict[str, tuple[str, dict]]:
    target, files = _path(spark, f"{root.rstrip('/')}/{_POINTER}")
    if not files.exists(target):
        return {}
    stream = files.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def open_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last good set."""
    return {n: spark.read.schema(StructType.fromJson(schema)).parquet(path)
            for n, (path, schema) in _pointer(spark, root).items()}


def drop_partition(spark: SparkSession, path: str) -> None:
    """Remove one partition's folder, if it is there."""
    target, files = _path(spark, path)
    files.delete(target, True)


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
