"""Landing raw tables: every file is parsed once, bad lines are set aside, and counts are taken in the same pass."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cloudtally.sources.layers import observed
from cloudtally.sources.raw import CSV
from cloudtally.sources.schemas import NULL_FOR_INVALID, RAW_SCHEMAS

#: What is wrong with a line: too few or too many fields, or values that do not fit their types.
FIELDS, VALUE = "fields", "value"


@dataclass(frozen=True)
class Landed:
    """A raw table in Parquet. ``counts`` has ``kept``, ``nulled`` (kept with a value made NULL), ``quarantined``
    and what the caller asked to count over the kept rows."""

    rows: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


def judged(spark: SparkSession, name: str, path: str | list[str]) -> DataFrame:
    """Every line of a raw table under its declared schema, with ``_line`` and ``_problem``, NULL for a sound one.

    ``_line`` is the text of a bad line. Only bad lines are looked at again, as plain text, to tell a wrong number of
    fields from values that do not fit: those are named, as in ``value: year, spend_usd``.
    """
    schema = StructType.fromDDL(RAW_SCHEMAS[name])
    plain = ", ".join(f"`{f.name}` string" for f in schema)
    options = {**CSV, "mode": "PERMISSIVE"}
    lines = spark.read.schema(StructType([*schema, StructField("_line", StringType())])).options(
        **options, columnNameOfCorruptRecord="_line").csv(path)
    again = F.from_csv("_line", f"{plain}, _bad string", {**options, "header": "false", "columnNameOfCorruptRecord": "_bad"})
    # All columns are looked at: values of a column that nobody asks for are not parsed, and their faults not seen.
    misfits = F.array_compact(F.array(*[F.when(F.col("_again")[f.name].isNotNull() & F.col(f.name).isNull(), f.name)
                                        for f in schema]))
    problem = F.when(F.col("_again")["_bad"].isNotNull(), FIELDS).when(
        F.size(misfits) > 0, F.concat(F.lit(f"{VALUE}: "), F.array_join(misfits, ", "))).otherwise("line")
    return lines.withColumn("_again", again).withColumn(
        "_problem", F.when(F.col("_line").isNotNull(), problem)).drop("_again")


def kept(name: str) -> Column:
    """Whether a judged line stays: sound ones, and where the table says so those whose bad values became NULL."""
    sound = F.col("_problem").isNull()
    return sound | F.col("_problem").startswith(VALUE) if name in NULL_FOR_INVALID else sound


def land(spark: SparkSession, name: str, path: str | list[str], out: str,
         count: Mapping[str, Column] | None = None) -> Landed:
    """Parse the files of one raw table once into Parquet below ``out``: kept rows and quarantined lines.

    ``count`` are conditions on the kept rows, counted in the same pass. A line that is quarantined stays with its text
    and its problem; nothing is lost in silence. An empty folder gives an empty table.
    """
    rows = judged(spark, name, path).withColumn("_kept", kept(name))
    stays = F.col("_kept")
    return _landed(rows, out, {
        "kept": stays, "nulled": stays & F.col("_problem").isNotNull(), "quarantined": ~stays,
        **{k: stays & c for k, c in (count or {}).items()}})


def land_frame(df: DataFrame, out: str, count: Mapping[str, Column] | None = None) -> Landed:
    """The same for a raw table that is no file: all its rows are kept."""
    rows = df.withColumns({"_line": F.lit(None).cast("string"), "_problem": F.lit(None).cast("string"), "_kept": F.lit(True)})
    return _landed(rows, out, {"kept": F.lit(True), "nulled": F.lit(False), "quarantined": F.lit(False), **(count or {})})


def _landed(rows: DataFrame, out: str, count: Mapping[str, Column]) -> Landed:
    seen, names = Observation(), list(count)
    rows.observe(seen, *[F.count_if(count[n]).alias(f"c{i}") for i, n in enumerate(names)]).write.partitionBy(
        "_kept").parquet(out)
    got = observed(seen)
    found = rows.sparkSession.read.schema(rows.schema).parquet(out)
    return Landed(found.filter("_kept").drop("_line", "_problem", "_kept"),
                  found.filter("not _kept").select("_line", "_problem"),
                  {n: got.get(f"c{i}", 0) for i, n in enumerate(names)})
