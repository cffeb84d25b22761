"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(name: str = "cloudtally", cpus: int | str = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine. A cluster brings its own; only the time zone matters to results."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: for what later steps read several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_own_folder: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder the cluster names, so that every executor reaches it.

    Only a session on this machine alone that names none gets a temporary one, removed at exit; a cluster's
    executors would each write to a folder of their own there.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="cloudtally-"))
            atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
        base = _own_folder[0]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
