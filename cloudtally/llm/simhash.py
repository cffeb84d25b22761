"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import cut, map_batches
from cloudtally.llm.components import connected

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; no words give zero.

    A-Z are lower-cased; words are runs without ASCII white space; a text with fewer words than a shingle is one.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if n > 1 or len(
        words) == shingle else iter([b" ".join(words)])
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    while (some := np.fromiter(islice(hashes, _CHUNK), np.uint64)).size:
        octets = some.byteswap().view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """`doc_id`, `fp` (the 64 bits as a long). Null texts count as empty."""
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])
        return work
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, fp long")


def links(fps: DataFrame, distance: int = 2, blocks: int = 4, bucket: int = 256) -> DataFrame:
    """Pairs `a` < `b` whose closure joins all distinct `fp` at most `distance` bits apart.

    The 64 bits are cut into `blocks` blocks. Two fingerprints that differ in at most `distance` bits agree on
    `blocks - distance` whole blocks, so each choice of that many blocks is one join key; pairs are then verified.
    Keys that more than `bucket` fingerprints share are not joined, as their pairs grow with the square. There each
    fingerprint goes to itself and to all values within half the distance, and is linked to the smallest one that
    goes to the same value: if two differ in two bits, both are one bit from a value between them. That path is
    exact for even distances, which is what `distance` must be.
    """
    if distance % 2 or blocks <= distance:
        raise ValueError("distance must be even and below the number of blocks")
    width = 64 // blocks
    masks = [sum(((1 << width) - 1) << (width * k) for k in kept) for kept in combinations(range(blocks),
                                                                                          blocks - distance)]
    keyed = fps.select("fp").distinct().select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(_signed(m)).alias("value"))
                                  for i, m in enumerate(masks)])).alias("key")).select("fp", "key.part", "key.value")
    large = keyed.groupBy("part", "value").count().filter(F.col("count") > bucket).select("part", "value")
    few = keyed.join(large, ["part", "value"], "left_anti")
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = left.join(right, ["part", "value"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")
    flips = [_signed(0)]
    for _ in range(distance // 2):
        flips = list({f ^ _signed(1 << k) for f in flips for k in range(64)} | set(flips))
    dense = keyed.join(large, ["part", "value"], "left_semi").select("fp").distinct()
    around = dense.select(F.col("fp").alias("b"), F.explode(F.transform(
        F.array(*[F.lit(f) for f in sorted(flips)]), lambda f: f.bitwiseXOR(F.col("fp")))).alias("at"))
    least = around.groupBy("at").agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1")
    stars = around.join(least, "at").filter("a < b").select("a", "b")
    return pairs.union(stars).distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _rooted(fps: DataFrame, distance: int) -> DataFrame:
    """`fp`, `rep` (its smallest id), `root` (names its component) for every fingerprint of `doc_id`, `fp`."""
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = connected(links(reps, distance))
    return reps.join(found.toDF("fp", "root"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """`doc_id`, `fp`, `component_id`: the smallest id reachable over fingerprints at most `distance` bits apart.

    Every input row gives one row. Texts without words have fingerprint zero and link like any other. Null ids are
    kept and never name a component that has another id; an empty table gives no rows. Extra columns are ignored.
    """
    fps = cut(fingerprints(docs, shingle, seed))
    rooted = _rooted(fps, distance)
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    groups = rooted.join(named, "root").select("fp", "component_id")
    return fps.join(groups, "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row of each component, with all columns of `docs`: that of the smallest id.

    Rows, not ids, are grouped: an id that repeats with other texts is in several components. Rows without an id come
    after those with one; among rows of the same id, and of equal rows, one stays, chosen by a 128-bit hash of all its
    columns that can be hashed. An empty table gives no rows.
    """
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, shingle, seed) for t in batch.column(3).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found.view(np.int64))],
                                              ["mark", "check", "doc_id", "fp"])
        return work
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = [F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    packed = docs.select(F.struct(*columns).alias("row")).select(
        "row", F.xxhash64(*plain).alias("mark"), F.xxhash64(F.lit(1), *plain).alias("check"))
    fps = cut(map_batches(packed.select("mark", "check", F.col("row.doc_id").cast("long").alias("doc_id"),
                                        F.col("row.text").alias("text")),
                          make, "mark long, check long, doc_id long, fp long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "check")).alias("first")
    least = fps.groupBy("fp").agg(first).join(_rooted(fps, distance), "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = least.select("first.mark", "first.check")
    return (packed.join(kept, ["mark", "check"], "left_semi").dropDuplicates(["mark", "check"])
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
