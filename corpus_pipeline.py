"""The training-data pipeline: documents filtered by quality, de-duplicated, redacted, mixed, encoded and decoded.

Every stage takes (spark, docs, sf_dir), works on all rows of `docs` and returns a frame; all but the last return the
columns of documents. Models are fitted within their stage: that of `redact` on all its rows, that of `quality` on a bounded
sample (parameters of its `fit`). Null or empty texts pass through each stage as the operator's docstring says; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cloudtally.llm import bpe, mil, mixing, pii, simhash
from cloudtally.llm.common import scratch, table
from cloudtally.llm.queries import VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return mil.keep_good(docs, mil.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group that chains of fingerprints at most 2 bits apart join.

    Fingerprints are the SimHash operator's own, over shingles of three words.
    """
    return simhash.keep_one(docs, distance=2, shingle=3)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redacted(docs, pii.fit(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix of sources takes them.

    Null and empty texts have no words to take, so their rows end here; a null source is one of the sources. Rows equal in id,
    source and text each give the rows of the first of them. An empty table gives no rows.
    """
    return mixing.mixed(docs, mixing.mix(docs, block_words=512))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `ids` (little-endian unsigned 32-bit) and `decoded` (the text that the ids give back) of every row of the mix.

    Null and empty texts give no ids and an empty text; ids may be null or repeat, a row each. An empty table gives no rows.
    """
    return bpe.encode_decode(docs, VOCABULARY)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("redact", redact), ("mix", mix), ("encode", encode)]

# A trained classifier and pseudorandom draws have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
