"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors a cosine of at least c means a squared distance of at most 2 - 2c. After a random rotation each vector is
cut into blocks of few dimensions; if a pair is near, some block holds at most its proportional share of that
distance, or the shares would add up to more. Each block is joined on its own: the block's leading axes are cut at
quantiles into cells, and a vector goes to its own cell and to every lower-numbered cell whose box lies within the
block's radius, so that each pair meets in one cell. A cell is a task; within it the vectors that live there are cut
again, into small cells, and the others pass by in batches. Candidates are verified on the original vectors in double
precision, and each pair counts in the first block that finds it. Pairs never leave the task that found them: tasks
return links counted per vector and a spanning forest.

A vector has the more copies in cells the more vectors there are, so cells are dealt in rounds, each of at most a few
copies per vector, and a round's shuffle files are dropped before the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.llm.common import map_batches, scratch, ship
from cloudtally.llm.components import connected

#: Room in each block's share for the rounding of rotated vectors.
_SLACK = 1e-4
#: What cells and the dot products take beyond the share, so that they pass whatever `_apart` finds within it.
_WIDER = 1e-5
#: Steps of a grid of unit vectors and rotation on which double precision multiplies and adds without rounding.
_GRID = float(1 << 24)
#: Rows that a search returns, and their kinds.
_FOUND, _LINK, _EDGE = "kind long, a long, b long", 0, 1
#: Copies that a round deals: so many per vector, or so many rows if that is more.
_ROUND_COPIES, _ROUND_ROWS = 2, 1 << 19
#: Cells are larger, up to so many times, where there are many vectors; rows of the small cells within one.
_GROWN, _SMALL = 8, 256
#: Rows compared, and candidates verified, at once.
_STEP, _CHECKED = 1 << 13, 1 << 18
#: Spark drops a query's shuffle files when it ends; otherwise they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Plan:
    """Rotation (in steps of the grid), blocks and cell cuts for vectors of one length."""

    rotation: np.ndarray
    width: int
    blocks: int
    cuts: list[list[np.ndarray]]
    far: float

    def budget(self, block: int) -> float:
        dims = self.rotation.shape[0]
        return self.far * (min(dims, (block + 1) * self.width) - block * self.width) / dims + _SLACK

    def span(self, block: int) -> slice:
        return slice(block * self.width, (block + 1) * self.width)

    def turn(self, vectors: np.ndarray, axes: slice = slice(None)) -> np.ndarray:
        """Some axes of unit vectors rotated; the same bits in every task, whatever rows and axes are turned together."""
        return (np.rint(vectors * _GRID) @ self.rotation[:, axes] / _GRID ** 2).astype(np.float32)


def _cuts(x: np.ndarray, rows: int, cell_rows: int) -> list[np.ndarray]:
    """Quantiles of leading axes, halving axis after axis until cells of `rows` vectors like these are small enough."""
    halvings, axes = max(0, int(np.ceil(np.log2(max(1, rows / cell_rows))))), x.shape[1]
    parts = [1 << (halvings // axes + (k < halvings % axes)) for k in range(axes)]
    return [np.quantile(x[:, k], np.arange(1, n) / n).astype(np.float32) for k, n in enumerate(parts) if n > 1]


def plan(sample: np.ndarray, rows: int, cosine: float, width: int, cell_rows: int, seed: int) -> Plan:
    """Cuts each block's leading axes at sample quantiles, halving axis after axis until cells are small enough."""
    dims = sample.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))[0]
    rotation = np.rint(rotation * _GRID)
    p = Plan(rotation, width, -(-dims // width), [], 2 - 2 * cosine)
    turned = p.turn(sample)
    p.cuts.extend(_cuts(turned[:, p.span(block)], rows, cell_rows) for block in range(p.blocks))
    return p


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; divided by a power of two first, so that squares stay within the range of doubles."""
    vectors = vectors.astype(np.float64)
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _reached(x: np.ndarray, cuts: list[np.ndarray], within: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether it is the row's own, for every cell whose box is that near; and each row's own cell."""
    n = len(x)
    row, cell, own, gap = np.arange(n), np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n)
    home = np.zeros(n, np.int64)
    for axis, edges in enumerate(cuts):
        at = x[:, axis]
        mine = np.searchsorted(edges, at, side="right")
        home = home * (len(edges) + 1) + mine
        low = np.concatenate([[-np.inf], edges])
        high = np.concatenate([edges, [np.inf]])
        # One step per interval of the axis, each for all rows that are near enough to it.
        parts = []
        for k in range(len(edges) + 1):
            away = np.maximum(np.maximum(low[k] - at[row], at[row] - high[k]), 0) ** 2 + gap
            near = np.flatnonzero(away <= within)
            parts.append((row[near], cell[near] * (len(edges) + 1) + k, own[near] & (mine[row[near]] == k), away[near]))
        row, cell, own, gap = (np.concatenate(c) for c in zip(*parts, strict=True))
    return row, cell, own, home


def cells(p: Plan, x: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether it is the row's own, for every cell that a row goes to; x has the block's axes."""
    row, cell, own, home = _reached(x, p.cuts[block], p.budget(block) + _WIDER)
    keep = own | (cell < home[row])
    return row[keep], cell[keep], own[keep]


def _keyed(vectors: DataFrame, kind: str, more: Sequence[str] = ()) -> DataFrame:
    """vec_id, key, raw, dims, and columns `more`; key is a digest of the values, raw their bytes as numpy's `kind`.

    Both are null where a vector is: empty, zero, or with a component that is missing or not finite.
    """
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, raws, dims = [], [], []
            for v in batch.column(1).to_pylist():
                x = np.array([np.nan if c is None else c for c in v or []], np.float64) + 0.0
                usable = len(x) and np.isfinite(x).all() and x.any()
                raw = x.astype(kind).tobytes() if usable else None
                raws.append(raw)
                keys.append(hashlib.blake2b(raw, digest_size=16).digest() if usable else None)
                dims.append(len(x) if usable else 0)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(raws, pa.binary()), pa.array(dims, pa.int32()),
                 *batch.columns[2:]], ["vec_id", "key", "raw", "dims", *more])
        return work
    kinds = dict(vectors.dtypes)
    return map_batches(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), *more), make,
                       "vec_id long, key binary, raw binary, dims int" + "".join(f", {c} {kinds[c]}" for c in more))


def _array(raws, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raws), kind).reshape(-1, dims)


def _values(raws: pa.Array, dims: int, kind: str) -> np.ndarray:
    """`_array` of an Arrow column, without an object for each row."""
    if not len(raws):
        return np.zeros((0, dims), kind)
    wide = "<i4" if pa.types.is_binary(raws.type) else "<i8"
    first = int(np.frombuffer(raws.buffers()[1], wide)[raws.offset])
    return np.frombuffer(raws.buffers()[2], kind, len(raws) * dims, first).reshape(-1, dims)


def _apart(x: np.ndarray, y: np.ndarray, s: np.ndarray, t: np.ndarray, axes: range) -> np.ndarray:
    """Squared distances over some axes (rows of x and y), added axis by axis: the same bits for a pair in every task."""
    out = np.zeros(len(s), np.float32)
    for k in axes:
        gap = x[k][s] - y[k][t]
        out += gap * gap
    return out


class _Home:
    """Unit vectors that live in a cell of a block, cut again into small cells, which others are compared with."""

    def __init__(self, p: Plan, block: int, vectors: np.ndarray, cosine: float):
        self.p, self.block, self.vectors, self.cosine = p, block, vectors, cosine
        turned = p.turn(vectors)
        self.x, self.axes = turned[:, p.span(block)], np.ascontiguousarray(turned.T)
        self.cuts = _cuts(self.x, len(vectors), _SMALL) if len(vectors) else []
        _, _, _, self.cell = _reached(self.x, self.cuts, -1)
        self.order = np.argsort(self.cell, kind="stable")
        self.first = np.searchsorted(self.cell[self.order], np.arange(int(np.prod([len(c) + 1 for c in self.cuts])) + 1))
        self.part = self._form(self.x, -2, 1)[self.order]

    @staticmethod
    def _form(x: np.ndarray, factor: float, square_last: int) -> np.ndarray:
        """Rows whose products with those of the other form are squared distances."""
        both = [np.ones(len(x), np.float32), (x * x).sum(1)]
        return np.column_stack([x * np.float32(factor), both[1 - square_last], both[square_last]])

    def pairs(self, vectors: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs (rows here, rows of the vectors, or both here) that this block is the first to find, bit by bit."""
        turned = None if vectors is None else self.p.turn(vectors)
        y = self.x if vectors is None else turned[:, self.p.span(self.block)]
        axes = self.axes if vectors is None else np.ascontiguousarray(turned.T)
        form = self._form(y, 1, 0)
        other, left, right, held = self.vectors if vectors is None else vectors, [], [], 0
        for first in range(0, len(y), _STEP):
            row, cell, own, _ = _reached(y[first:first + _STEP], self.cuts, self.p.budget(self.block) + _WIDER)
            row += first
            if vectors is None:
                keep = own | (cell < self.cell[row])
                row, cell = row[keep], cell[keep]
            by = np.argsort(cell, kind="stable")
            row, cell = row[by], cell[by]
            starts = np.flatnonzero(np.diff(cell, prepend=-1))
            for begin, end in zip(starts, [*starts[1:], len(cell)], strict=True):
                for s, t in self._close(int(cell[begin]), form, row[begin:end], vectors is None):
                    left.append(s)
                    right.append(t)
                    held += len(s)
                    if held >= _CHECKED:
                        yield self._linked(other, axes, np.concatenate(left), np.concatenate(right))
                        left, right, held = [], [], 0
        if held:
            yield self._linked(other, axes, np.concatenate(left), np.concatenate(right))

    def _close(self, cell: int, form: np.ndarray, row: np.ndarray, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a row in the small cell and one of the rows that lie within the block's share."""
        here = slice(self.first[cell], self.first[cell + 1])
        part, order = self.part[here], self.order[here]
        step = max(1, (1 << 20) // max(1, len(part)))
        for first in range(0, len(row) if len(part) else 0, step):
            some = row[first:first + step]
            near = part @ form[some].T <= self.p.budget(self.block) + _WIDER
            i, j = np.divmod(np.flatnonzero(near), len(some))
            i, j = order[i], some[j]
            if itself:
                once = (self.cell[i] != self.cell[j]) | (i < j)
                i, j = i[once], j[once]
            yield i, j

    def _linked(self, other: np.ndarray, axes: np.ndarray, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, all_shares, total = self.p, sum(map(self.p.budget, range(self.p.blocks))), np.zeros(len(s), np.float32)
        # Other blocks first: most candidates are near in this block only.
        for k in sorted(range(p.blocks), key=lambda k: k == self.block):
            gap = _apart(self.axes, axes, s, t, range(*p.span(k).indices(len(axes))))
            total += gap
            new = total <= all_shares + _WIDER
            if k <= self.block:
                new &= (gap <= p.budget(k)) == (k == self.block)
            s, t, total = s[new], t[new], total[new]
        ok = np.zeros(len(s), bool)
        for first in range(0, len(s), _STEP):
            some = slice(first, first + _STEP)
            ok[some] = np.einsum("ij,ij->i", self.vectors[s[some]], other[t[some]]) >= self.cosine
        return s[ok], t[ok]


def _found(p: Plan, block: int, a: np.ndarray, b: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (rows of a, rows of b, or of a itself) that this block is the first to find."""
    none = np.zeros(0, np.int64)
    left, right = zip((none, none), *_Home(p, block, a, cosine).pairs(b), strict=True)
    left, right = np.concatenate(left), np.concatenate(right)
    return (left, right) if b is not None else (np.minimum(left, right), np.maximum(left, right))


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """`root`, each row's smallest row of its component, after rows a and b are linked."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root[:] = up


class _Task:
    """One part of a cell: first come the rows that live there, then those that are compared with them."""

    def __init__(self, p: Plan, block: int, dims: int, kind: str, cosine: float):
        self.of, self.dims, self.kind = (p, block), dims, kind
        self.cosine, self.home, self.live = cosine, None, []

    def take(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """`stream`, `rep`, `copies`, `raw` of the next rows, those that live here first."""
        stream = rows.column(0).to_numpy(zero_copy_only=False)
        n = int(np.argmax(stream)) if stream.any() else len(stream)
        if n:
            self.live.append(rows.slice(0, n))
        if n < len(stream):
            self._settle()
            yield from self._pass(rows.slice(n))

    def end(self) -> Iterator[pa.RecordBatch]:
        self._settle()
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        yield from _rows(self.ids, self.links, self.ids[self.root[moved]], self.ids[moved])

    def _read(self, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return rows.column(1).to_numpy(), rows.column(2).to_numpy(), unit(_values(rows.column(3), self.dims, self.kind))

    def _settle(self) -> None:
        if self.home is not None:
            return
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, self.dims))
        self.ids, self.copies, vectors = (np.concatenate(c) for c in zip(none, *map(self._read, self.live), strict=True))
        self.live, self.home = [], _Home(*self.of, vectors, self.cosine)
        self.links, self.root = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))
        for s, t in self.home.pairs():
            np.add.at(self.links, s, self.copies[t])
            np.add.at(self.links, t, self.copies[s])
            _join(self.root, s, t)

    def _pass(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, copies, vectors = self._read(rows)
        n = len(self.ids)
        links, root = np.zeros(len(ids), np.int64), np.concatenate([self.root, n + np.arange(len(ids))])
        for s, t in self.home.pairs(vectors):
            np.add.at(self.links, s, copies[t])
            np.add.at(links, t, self.copies[s])
            _join(root, s, n + t)
        self.root = root[:n]
        linked = np.flatnonzero(links)
        yield from _rows(ids, links, self.ids[root[n + linked]], ids[linked])


def _rows(ids: np.ndarray, links: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    linked = np.flatnonzero(links)
    if len(linked) + len(a):
        kinds = np.repeat([_LINK, _EDGE], [len(linked), len(a)])
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.concatenate([ids[linked], a])),
                                          pa.array(np.concatenate([links[linked], b]))], ["kind", "a", "b"])


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Queries that run within leave no shuffle files."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """The frame in the shared folder, read again; without the shuffle files that made it."""
    path = scratch(df.sparkSession, label)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rounds(dealt: dict[int, int], largest: dict[int, int], most: int) -> list[tuple[list[int], int, int, int, int]]:
    """Blocks, which of how many shares of their cells, and which of how many shares of a cell's parts, for every round.

    `dealt` and `largest` are the rows that a block and its largest cell deal; a round deals about `most`.
    """
    out, blocks, held = [], [], 0
    for block, rows in sorted(dealt.items()):
        if blocks and held + rows > most:
            out.append((blocks, 0, 1, 0, 1))
            blocks, held = [], 0
        if rows <= most:
            blocks, held = [*blocks, block], held + rows
        else:
            shares, parts = -(-rows // most), -(-largest[block] // most)
            out += [([block], share, shares, part, parts) for share in range(shares) for part in range(parts)]
    return out + [(blocks, 0, 1, 0, 1)] * bool(blocks)


def _near(reps: DataFrame, dims: int, rows: int, cosine: float, width: int, cell_rows: int, sample_rows: int,
          seed: int, kind: str, path: str) -> None:
    """Adds rows to `path`: `kind`, `a`, `b`: for links counted, a vector and how many others it links with; for edges, both ends."""
    spark = reps.sparkSession
    reps = reps.filter(F.col("dims") == dims).select("rep", "copies", "raw")
    some = reps.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("raw").collect()
    cell_rows = max(cell_rows, min(_GROWN * cell_rows, rows // 4))
    sample = unit(_array([bytes(r.raw) for r in some], dims, kind))
    p = plan(sample, rows, cosine, width, cell_rows, seed)
    salts = 1 << 20

    def count():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            turned = p.turn(unit(_values(batch.column(2), dims, kind)))
            found = [(block << 40 | cell, own) for block in range(p.blocks)
                     for _, cell, own in [cells(p, turned[:, p.span(block)], block)]]
            key, own = (np.concatenate(c) for c in zip(*found, strict=True))
            key, at = np.unique(key, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(at)), pa.array(
                np.bincount(at, own).astype(np.int64))], ["key", "n", "own"])
        return work
    # A cell whose own rows are too many for a task is dealt in parts: an own row goes to its part and those before it, others to all.
    parts = F.greatest(F.lit(1), F.ceil(F.col("own") / (2 * cell_rows))).cast("long")
    sized = _stored(map_batches(reps, count, "key long, n long, own long").groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("own").alias("own")).withColumn("parts", parts).withColumn(
        "dealt", F.ceil((F.col("n") - F.col("own")) * F.col("parts") + F.col("own") * (F.col("parts") + 1) / 2)), "cells")
    by_block = sized.groupBy(F.expr("key >> 40").alias("block")).agg(
        F.sum("dealt").alias("dealt"), F.max("dealt").alias("largest"), F.sum("parts").alias("tasks"),
        F.max("parts").alias("parts")).collect()
    large = _stored(sized.filter("parts > 1").select("key", "parts"), "cells") if any(r.parts > 1 for r in by_block) else None

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now = None, None
        for batch in batches:
            key, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.diff(key, prepend=-1) | np.diff(part, prepend=-1))
            for first, end in zip([0, *starts[starts > 0]], [*starts[starts > 0], len(key)], strict=True):
                if now != (key[first], part[first]):
                    if task:
                        yield from task.end()
                    now, task = (key[first], part[first]), _Task(p, int(key[first]) >> 40, dims, kind, cosine)
                yield from task.take(pa.RecordBatch.from_arrays(
                    [c.slice(first, end - first) for c in batch.columns[2:]], ["stream", "rep", "copies", "raw"]))
        if task:
            yield from task.end()

    def search(blocks: list[int], share: int, shares: int, turn: int, turns: int) -> DataFrame:
        def deal():
            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                ids, vectors = batch.column(0).to_numpy(), unit(_values(batch.column(2), dims, kind))
                salt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
                out = []
                for block in blocks:
                    row, cell, own = cells(p, p.turn(vectors, p.span(block)), block)
                    here = np.flatnonzero(cell % shares == share)
                    out.append((row[here], block << 40 | cell[here], own[here]))
                row, key, own = (np.concatenate(c) for c in zip(*out, strict=True))
                rows = pa.array(row)
                return pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(salt[row]), pa.array(own), batch.column(0).take(rows),
                     batch.column(1).take(rows), batch.column(2).take(rows)], ["key", "salt", "own", "rep", "copies", "raw"])
            return work
        dealt = map_batches(reps, deal, "key long, salt long, own boolean, rep long, copies long, raw binary")
        if large is None:
            dealt = dealt.select("key", F.lit(0).cast("long").alias("part"), (~F.col("own")).alias("stream"), "rep", "copies", "raw")
        else:
            dealt = dealt.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
            mine = dealt.withColumn("mine", F.expr(f"salt * parts div {salts}")).withColumn(
                "part", F.explode(F.expr("sequence(0L, if(own, mine, parts - 1))")))
            dealt = mine.filter(F.col("part") % turns == turn).select(
                "key", "part", (~F.col("own") | (F.col("part") != F.col("mine"))).alias("stream"), "rep", "copies", "raw")
        tasks = -(-sum(r.tasks for r in by_block if r.block in blocks) // (shares * turns))
        dealt = dealt.repartition(max(1, min(4 * tasks, 20_000)), "key", "part").sortWithinPartitions("key", "part", "stream")
        return dealt.mapInArrow(searched, _FOUND)

    ship(spark)
    most = max(_ROUND_COPIES * rows, _ROUND_ROWS)
    with _shuffles_dropped(spark):
        for one in _rounds({r.block: r.dealt for r in by_block}, {r.block: r.largest for r in by_block}, most):
            search(*one).write.mode("append").parquet(path)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, width: int = 8, cell_rows: int = 8192,
                    sample_rows: int = 4096, seed: int = 11) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` for every row of `vec_id`, `embedding`.

    Equal vectors are searched once and counted as often as they occur, so a group of copies costs one search.
    `sample_rows` vectors place the cuts between cells; all are searched. Cells have about `cell_rows` vectors, up to eight
    times as many where there are more than 32 times as many vectors; of a cell in which more than twice as many live, each
    task takes a part of them. Null, empty or zero vectors, and those with null or non-finite
    components, link with nothing; so do vectors of different lengths. Rows without an id, and all rows of an id that
    repeats with other values, are vectors of their own for counting; a component is named by its smallest id.
    """
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    keyed = _stored(_keyed(vectors, kind), "keyed")
    spark, path = keyed.sparkSession, scratch(keyed.sparkSession, "links")
    # `rep` numbers the distinct vectors apart from the ids, which may be null or repeat.
    reps = _stored(keyed.filter("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("name"), F.count("*").alias("copies"), F.first("raw").alias("raw"), F.first("dims").alias("dims"))
        .withColumn("rep", F.monotonically_increasing_id()), "distinct")
    spark.createDataFrame([], _FOUND).write.parquet(path)
    for dims, rows in sorted((r.dims, r["count"]) for r in reps.groupBy("dims").count().collect()):
        _near(reps, dims, rows, cosine, width, cell_rows, sample_rows, seed, kind, path)
    found = spark.read.schema(_FOUND).parquet(path)
    counts = found.filter(F.col("kind") == _LINK).groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    roots = connected(found.filter(F.col("kind") == _EDGE).select("a", "b")).toDF("rep", "root")
    rooted = reps.select("key", "rep", "name", "copies").join(roots, "rep", "left").withColumn(
        "root", F.coalesce("root", "rep"))
    names = rooted.groupBy("root").agg(F.min("name").alias("component_id"))
    facts = rooted.join(names, "root").join(counts, "rep", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    return (keyed.select("vec_id", "key").join(facts, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
