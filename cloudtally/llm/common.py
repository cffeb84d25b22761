"""What the operators share: the shared folder, cut lineage, batches of texts, the held-out fold."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_folder: list[str] = []
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that executors need not have it installed."""
    package, context = Path(__file__).resolve().parents[1], spark.sparkContext
    if context.applicationId in _shipped or not package.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="cloudtally-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for data that every executor must reach.

    Only a session on this machine that names none gets a temporary one, removed at exit.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="cloudtally-llm-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return _own_folder[0]


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The frame computed once and stored in the shared folder, so that what follows rereads it."""
    spark = df.sparkSession
    if not spark.conf.get(_CHECKPOINT_DIR, None):
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with `start`, the sum of `n` over the rows of the same `g` before them, and `total`, that over all.

    Rows are laid out by ranges, summed within each range and group, and the sums of earlier ranges added.
    """
    names = rows.columns
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = cut(laid.select(*names, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    sums = laid.groupBy("part", "g").agg(F.sum("n").alias("s"))
    before = F.sum("s").over(Window.partitionBy("g").orderBy("part")) - F.col("s")
    base = sums.select("part", "g", before.alias("base"), F.sum("s").over(Window.partitionBy("g")).alias("total"))
    inner = F.sum("n").over(Window.partitionBy("part", "g").orderBy("at")) - F.col("n")
    return laid.withColumn("inner", inner).join(base, ["part", "g"]).select(
        *names, (F.col("base") + F.col("inner")).alias("start"), "total")


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is in the fold that no label is learnt from; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """`doc_id`, `label` of at most `most` documents outside the held-out fold, those of the lowest hashed id.

    Rows without a label or id are left out; of several labels of one document the largest counts.
    """
    own = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def bounded_rows(found: DataFrame, keys: list[str], data: str, most_bytes: int) -> list[Row]:
    """At most one row for each of the `keys` (`doc_id` first) with `most_bytes` of `data` in all, sorted, on the driver.

    An id whose rows differ has the least `data`, combined before it is shuffled, so that an id that repeats a million times
    is one row. Documents are taken in order of a hash of their id, whole or not at all: one that no longer fits is passed
    over. The number of different keys must be bounded by the caller.
    """
    one = cut(found.groupBy(*keys).agg(F.min(data).alias(data)))
    sizes = sorted(one.select(F.xxhash64("doc_id").alias("h"), *keys, F.length(data).alias("n")).collect())
    kept, left = [], most_bytes
    for r in sizes:
        if r.n <= left:
            left -= r.n
            kept.append(tuple(r[k] for k in keys))
    schema = ", ".join(f"{k} {kind}" for k, kind in one.select(*keys).dtypes)
    wanted = F.broadcast(found.sparkSession.createDataFrame(kept, schema))
    return sorted(one.join(wanted, keys).collect(), key=lambda r: (*(r[k] for k in keys), bytes(r[data])))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
                schema: str | StructType, rows: int | None = None) -> DataFrame:
    """`make()` is called once per task and returns what turns one Arrow batch into another.

    Batches follow Spark's limit on their bytes, so a task holds a few texts at a time; `rows` cuts them further. At the end
    of a task `close` of that function is called, if it has one, so that a worker that lives on need not keep what it holds.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for first in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                out = work(batch.slice(first, rows))
                if out is not None and out.num_rows:
                    yield out
        getattr(work, "close", lambda: None)()
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
