"""Nearest vectors by a block matrix join.

Queries and candidates are dealt to blocks of bounded bytes, and every pair of a query block and a candidate block is one
tile, a task of its own. In a tile vectors are int8 codes, each with its own step and the norm of what the codes leave
out. One matrix product of codes, in whole numbers, gives all distances between decoded vectors; by the triangle
inequality a true distance lies within both norms of it. Pairs whose least possible distance is beyond the k-th
smallest largest possible one, or beyond the worst of the query's heap, are passed over; the others are computed anew
in double precision from the original values and go through the heap. Only heaps leave a tile, so the result is exact
whatever the codes lose.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.llm.common import cut, ship
from cloudtally.llm.vectors import _array, _keyed

#: Products of codes of so many axes add up exactly in single precision: 1024 * 127 * 127 < 2^24.
_EXACT_AXES = 1024
#: Room for rounding, relative to squared norms and to bounds.
_ROUND, _WIDE = 1e-13, 1e-9
_STRIP, _PAIRS = 2048, 1 << 18
#: Stands for a missing id where ids are compared.
_LAST = (1 << 63) - 1


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of -127 to 127, the step of each vector, and an upper bound of the norm of the rest."""
    step = np.abs(vectors).max(axis=1) / 127
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        code = np.nan_to_num(np.clip(np.rint(vectors / step[:, None]), -127, 127)).astype(np.int8)
    rest = np.sqrt(((vectors - step[:, None] * code) ** 2).sum(axis=1))
    return code, step, rest * (1 + _WIDE)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products of the codes of a and b, exact."""
    out = np.zeros((len(a), len(b)))
    for first in range(0, a.shape[1], _EXACT_AXES):
        some = slice(first, first + _EXACT_AXES)
        out += a[:, some].astype(np.float32) @ b[:, some].astype(np.float32).T
    return out


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of x and of y, squares added axis by axis.

    Where the squares leave the range of doubles, differences are divided by the largest first.
    """
    total = np.zeros(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(x.shape[1]):
            gap = x[:, k] - y[:, k]
            total += gap * gap
        odd = np.flatnonzero(~((total > 1e-280) & (total < np.inf)) & (x != y).any(axis=1))
        out = np.sqrt(total)
        if len(odd):
            half = x[odd] / 2 - y[odd] / 2
            most = np.abs(half).max(axis=1)
            most = np.where(most > 0, most, 1)
            out[odd] = np.sqrt(((half / most[:, None]) ** 2).sum(axis=1)) * most * 2
    return out


def search(queries: np.ndarray, candidates: np.ndarray, first: np.ndarray, keep: int) -> list[list[tuple]]:
    """For each query a heap of its `keep` nearest candidates as (-distance, -first, row); equal distances by `first`."""
    high = max(np.abs(queries).max(), np.abs(candidates).max())
    shift = -np.frexp(high)[1]
    qc, qs, qr = codes(np.ldexp(queries, shift))
    vc, vs, vr = codes(np.ldexp(candidates, shift))
    q2, v2 = ((s * s * (c.astype(np.int64) ** 2).sum(axis=1)) for c, s in ((qc, qs), (vc, vs)))
    heaps: list[list[tuple]] = [[] for _ in queries]
    worst = np.full(len(queries), np.inf)
    back = 2.0 ** shift
    for v0 in range(0, len(candidates), _STRIP):
        v = slice(v0, v0 + _STRIP)
        for q0 in range(0, len(queries), _STRIP // 2):
            q = slice(q0, q0 + _STRIP // 2)
            norms = q2[q, None] + v2[v]
            near = norms - 2 * qs[q, None] * vs[v] * products(qc[q], vc[v])
            room = _ROUND * norms + 1e-300
            rests = qr[q, None] + vr[v]
            most = (np.sqrt(np.maximum(near, 0) + room) + rests) * (1 + _WIDE)
            limit = np.minimum(worst[q] * back * (1 + _WIDE),
                               np.partition(most, keep - 1, axis=1)[:, keep - 1] if most.shape[1] >= keep else np.inf)
            least = (np.sqrt(np.maximum(near - room, 0)) - rests) * (1 - _WIDE)
            i, j = np.nonzero(least <= limit[:, None])
            i, j = i + q0, j + v0
            for p in range(0, len(i), _PAIRS):
                s, t = i[p:p + _PAIRS], j[p:p + _PAIRS]
                far = distance(queries[s], candidates[t])
                fits = far <= worst[s]
                for a, b, d, f in zip(s[fits].tolist(), t[fits].tolist(), far[fits].tolist(), first[t[fits]].tolist(),
                                      strict=True):
                    heap = heaps[a]
                    if len(heap) < keep:
                        heapq.heappush(heap, (-d, -f, b))
                    elif (-d, -f, b) > heap[0]:
                        heapq.heapreplace(heap, (-d, -f, b))
                    if len(heap) == keep:
                        worst[a] = -heap[0][0]
    return heaps


def nearest(vectors: DataFrame, asked: Column, k: int = 10, block_bytes: int = 32 << 20, blocks: int = 64) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the `k` nearest other rows of each row of `vec_id`, `embedding` with `asked`.

    Nearness is the Euclidean distance, ties go to the smaller id, a row without an id after all others. Equal vectors
    are searched once, whatever their number; a row is not its own neighbour, but one with the same id and values is.
    Null, empty or zero vectors, those with null or non-finite components take no part, and vectors of other lengths
    are not compared. Fewer candidates than `k` are all returned; an empty table gives no rows, further columns are
    ignored.

    Up to `blocks` candidate blocks are cut from the vectors of a length, more where a block would pass
    `block_bytes` as doubles; each vector goes to one tile per block of the other side. The table of lengths is
    broadcast: a row per different vector length.
    """
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    names = ["vec_id", "embedding"]
    rows = vectors.select(*names, F.coalesce(asked, F.lit(False)).alias("asked"))
    keyed = cut(_keyed(rows, kind, ["asked"])).filter("key is not null")
    # A group of copies is its few smallest ids: no more can be among a query's nearest.
    small = keyed.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.col("vec_id").asc_nulls_last())))
    small = small.filter(F.col("n") <= k + 1).groupBy("key").agg(
        F.first("raw").alias("raw"), F.first("dims").alias("dims"),
        F.sort_array(F.collect_list(F.struct("n", "vec_id"))).alias("ids"))
    wanted = keyed.filter("asked").select("key").distinct().withColumn("asked", F.lit(True))
    reps = cut(small.join(wanted, "key", "left").select(
        F.monotonically_increasing_id().alias("v"), "key", "raw", "dims", F.col("ids.vec_id").alias("ids"),
        F.coalesce("asked", F.lit(False)).alias("asked"),
        F.coalesce(F.col("ids")[0]["vec_id"], F.lit(_LAST)).alias("first")))
    dealt = []
    for r in reps.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asked").alias("m")).collect():
        most = max(1, block_bytes // (8 * r.dims))
        dealt.append((r.dims, -(-r.n // min(most, -(-r.n // blocks))), max(1, -(-r.m // most))))
    sizes = F.broadcast(spark.createDataFrame(dealt, "dims int, columns long, lines long"))
    placed = reps.join(sizes, "dims")

    def block(number: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("v", F.lit(salt)), F.col(number))
    right = placed.select("dims", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lines") - 1)).alias("line"),
                          block("columns", 1).alias("column"), "v", "first", "raw")
    # Named anew, as both sides come from one frame.
    left = placed.filter("asked").select(
        F.col("dims").alias("length"), block("lines", 2).alias("row"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)).alias("block"), F.col("v").alias("q"),
        F.col("raw").alias("values"))
    schema = pa.schema([("q", pa.int64()), ("v", pa.int64()), ("first", pa.int64()), ("score", pa.float64())])

    def tile(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        dims = candidates.column("dims")[0].as_py()
        q, v = (_array(c.to_pylist(), dims, kind).astype(np.float64) for c in (queries.column("values"), candidates.column("raw")))
        first, ids = (candidates.column(c).to_numpy() for c in ("first", "v"))
        out = [(n, ids[b], first[b], -d) for n, heap in zip(queries.column("q").to_pylist(), search(q, v, first, k + 1),
                                                          strict=True) for d, _, b in heap]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)],
                                    schema=schema)
    ship(spark)
    tiles = left.groupBy("length", "row", "block").cogroup(right.groupBy("dims", "line", "column"))
    found = tiles.applyInArrow(tile, "q long, v long, first long, score double")
    near = F.row_number().over(Window.partitionBy("q").orderBy("score", "first"))
    top = found.withColumn("n", near).filter(F.col("n") <= k + 1).select("q", "v", "score")
    named = top.join(reps.select("v", "ids"), "v").select("q", "score", F.explode("ids").alias("vec_id"))
    order = F.row_number().over(Window.partitionBy("q").orderBy("score", F.col("vec_id").asc_nulls_last()))
    named = named.withColumn("n", order).filter(F.col("n") <= k + 1)
    lists = named.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    lists = lists.join(reps.select(F.col("v").alias("q"), "key"), "q").select("key", "near")
    answers = keyed.filter("asked").select(F.col("vec_id").alias("query_id"), "key").join(lists, "key")
    own = F.array_position(F.transform("near", lambda x: x["vec_id"].eqNullSafe(F.col("query_id")) & (x["score"] == 0)),
                           F.lit(True))
    answers = answers.withColumn("own", own)
    others = F.slice(F.filter("near", lambda x: x["n"] != F.col("own")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
