"""Document fingerprints by winnowing.

All k-grams of a text are hashed with a rolling polynomial; of every window of w neighbouring hashes the smallest is
kept, the rightmost of equals, with its position. Texts that share a passage of at least w + k - 1 characters thus
share a kept hash, and matches shorter than k are never seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import cut, map_batches, ship

_BASE = 0x9E3779B97F4A7C15
_POSITION = (1 << 24) - 1
_CHUNK = 1 << 20


def _grams(x: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all k-grams, by doubling."""
    whole, done, part, size = None, 0, x * np.uint64(_BASE) + np.uint64(1), 1
    while True:
        if k & size:
            if whole is None:
                whole, done = part, size
            else:
                n = len(x) - done - size + 1
                whole = whole[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + part[done:done + n]
                done += size
        if done == k:
            break
        part = part[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:]
        size *= 2
    h = (whole ^ (whole >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _lowest(keys: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every window of w keys."""
    size = 1
    while 2 * size <= w:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[:len(keys) - (w - size)], keys[w - size:]) if w > size else keys


def winnowed(text: str | None, k: int = 16, w: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (40 bits) and their positions in code points, by position.

    A text shorter than k is one gram, and grams fewer than w are one window; an empty or null text keeps nothing.
    """
    x = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
    if not len(x):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, len(x))
    hashes, places = [], []
    grams = len(x) - k + 1
    for first in range(0, grams, _CHUNK):
        # A chunk has whole windows; a window that two chunks see gives the same position twice.
        part = _grams(x[first:first + _CHUNK + w + k].astype(np.uint64), k)
        if first and len(part) < w:
            break
        keys = (part & np.uint64(~_POSITION & (1 << 64) - 1)) | (
            np.uint64(_POSITION) - np.arange(len(part), dtype=np.uint64))
        low = _lowest(keys, min(w, len(keys)))
        kept = low[np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))]
        hashes.append(kept >> np.uint64(24))
        places.append(first + _POSITION - (kept & np.uint64(_POSITION)).astype(np.int64))
    place, at = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[at], place


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes by all hashes of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    all_ = len(a) + len(b) - both
    return both / all_ if all_ else 1.0


def name(hashes: np.ndarray, places: np.ndarray) -> str:
    """A short name for a fingerprint: how many hashes it keeps, and a digest of them with their positions."""
    data = hashes.astype("<u8").tobytes() + places.astype("<i8").tobytes()
    return f"{len(hashes)}:{hashlib.blake2b(data, digest_size=16).hexdigest()}"


def fingerprints(docs: DataFrame, k: int = 16, w: int = 32) -> DataFrame:
    """`doc_id`, `hashes`, `positions` of each text, null texts as empty ones."""
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [winnowed(t, k, w) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                 pa.array([p for _, p in found], pa.list_(pa.int64()))], ["doc_id", "hashes", "positions"])
        return work
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make,
                       "doc_id long, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, bucket_docs: int = 1024, most_buckets: int = 100_000) -> DataFrame:
    """Texts in buckets of ascending doc_id, sorted; each bucket ends with the first text of the next one.

    Quantiles of the ids bound the buckets (about `most_buckets` at most, held on the driver; beyond that they grow, and a
    task still holds two texts at a time). Null ids come last; rows of one id are in order of a hash of their text. An id
    that repeats very often, null too, is a bucket of its own and cut further by that hash. The first rows of buckets are
    broadcast by id and hash only.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text"))
    keys = cut(rows.select("doc_id", "mark"))
    wanted = min(most_buckets, -(-keys.count() // bucket_docs))
    found = []
    if wanted > 1:
        found = sorted(int(e) for e in keys.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 0.2 / wanted))
    # An id at several quantiles is a bucket of its own: it ends where the next id begins.
    edges = sorted({*found, *(a + 1 for a, b in pairwise(found) if a == b)})
    rough = F.when(F.col("doc_id").isNull(), F.lit(len(edges) + 1)).otherwise(below(F.col("doc_id"), edges))
    sizes = keys.groupBy(rough.alias("bucket")).agg(
        F.count("*").alias("n"), (F.min("doc_id").eqNullSafe(F.max("doc_id"))).alias("single")).collect()
    parts = [1] * (len(edges) + 2)
    for r in sizes:
        if r.single:
            parts[r.bucket] = max(1, -(-r.n // bucket_docs))
    base = [0, *accumulate(parts)][:-1]
    spot = (F.shiftright("mark", 11).cast("double") + 2.0 ** 52) / 2.0 ** 53

    def placed(frame: DataFrame) -> DataFrame:
        bucket = F.get(_longs(base), F.col("rough")) + F.floor(spot * F.get(_longs(parts), F.col("rough"))).cast("long")
        return frame.withColumn("rough", rough.cast("int")).withColumn("bucket", bucket).drop("rough")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("head")
    heads = sorted((r.bucket, r.head.doc_id, r.head.mark) for r in placed(keys).groupBy("bucket").agg(least).collect())
    before = [(heads[i][1], heads[i][2], heads[i - 1][0]) for i in range(len(heads))]
    first = rows.sparkSession.createDataFrame(before, "head long, head_mark long, before long")
    rows = placed(rows)
    marked = rows.join(F.broadcast(first), rows["doc_id"].eqNullSafe(first["head"]) & (rows["mark"] == first["head_mark"]), "left")
    at = F.explode(F.filter(F.array(F.struct("bucket", F.lit(False).alias("last")),
                                    F.struct(F.col("before").alias("bucket"), F.lit(True).alias("last"))),
                            lambda s: s["bucket"].isNotNull())).alias("at")
    dealt = marked.select("doc_id", "text", "mark", at).select("doc_id", "text", "mark", "at.bucket", "at.last")
    return dealt.repartition("bucket").sortWithinPartitions(
        "bucket", "last", F.col("doc_id").isNull(), "doc_id", "mark").drop("mark")


def _longs(values: list[int]) -> Column:
    """An array literal; one string to the parser, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def below(column: Column, edges: list[int]) -> Column:
    """How many of the sorted edges are at most the column's value, by halving over one array literal."""
    if not edges:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(edges).bit_length()))]
    # Beyond the last edge `get` is null, and the step is not taken.
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, step: low + F.when(
        F.get(_longs(edges), low + step - 1) <= column, step).otherwise(0))


def edited_likeness(docs: DataFrame, k: int = 16, w: int = 32, bucket_docs: int = 1024) -> DataFrame:
    """Each text against an edited copy and against the next document.

    The last quarter of the code points (rounded down) is replaced by as many first ones of the next document in
    ascending doc_id (all of it, if shorter; after the last comes the first, and a single document is its own next).
    `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next`.
    """
    ordered = with_next(docs, bucket_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for doc_id, text, bucket, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                now = (doc_id, text, bucket, *winnowed(text, k, w)) if held or not last else None
                if held:
                    out.append(_compared(held, now, k, w))
                held = None if last else now
            if out:
                yield pa.RecordBatch.from_pylist(out, _RESULT)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    ship(docs.sparkSession)
    return ordered.mapInArrow(run, schema)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64())])


def _compared(held: tuple, following: tuple, k: int, w: int) -> dict:
    doc_id, text, _, hashes, places = held
    quarter = len(text) // 4
    edited = text[:len(text) - quarter] + following[1][:quarter]
    edited_hashes, edited_places = winnowed(edited, k, w) if edited != text else (hashes, places)
    own = np.unique(hashes)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": name(hashes, places), "edited_fingerprint": name(edited_hashes, edited_places),
            "near_edited": likeness(own, np.unique(edited_hashes)),
            "near_next": likeness(own, np.unique(following[3]))}
