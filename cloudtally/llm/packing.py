"""Token ids packed into rows of fixed length by best-fit decreasing.

Each task tokenizes its documents and packs them in groups of a bounded number of tokens, so ids are never shuffled.
Documents longer than a row are split into whole rows and a rest, losing nothing. In a group the pieces are placed from
the longest to the shortest, each into the row with the least room that still holds it, which a segment tree over
room left finds in a logarithm of the row length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import map_batches, ship

SCHEMA = ("pack long, n_tokens int, doc_ids array<long>, doc_offsets array<long>, cu_seqlens array<int>, ids binary, "
          "position_ids binary")


class Rooms:
    """Rows by the room they have left; finds the least room of at least a given size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room that is at least `need`, with that room; it is removed."""
        tree, at = self.tree, need + self.leaves
        while not tree[at]:
            # Up to the first subtree to the right that has rows.
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf of this level
                return None
        while at < self.leaves:
            at *= 2
            if not tree[at]:
                at += 1
        room = at - self.leaves
        while at:
            tree[at] -= 1
            at >>= 1
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows as lists of pieces; ties go to the earlier piece. No length may exceed `size`."""
    rooms, rows = Rooms(size), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[piece])
        if found is None:
            rows.append([])
            found = len(rows) - 1, size
        row, room = found
        rows[row].append(piece)
        if room > lengths[piece]:
            rooms.put(room - lengths[piece], row)
    return rows


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The ranks of a file of base64 tokens; one per Python worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _packed(group: list[tuple[int | None, np.ndarray]], size: int, pad: int, first: int) -> list[dict]:
    pieces = [(doc, at, ids[at:at + size]) for doc, ids in group for at in range(0, len(ids), size)]
    out = []
    for number, row in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], size)):
        own = [pieces[i] for i in row]
        lengths = [len(p[2]) for p in own]
        ids = np.full(size, pad, "<u2")
        ids[:sum(lengths)] = np.concatenate([p[2] for p in own])
        positions = np.zeros(size, "<u2")
        positions[:sum(lengths)] = np.concatenate([np.arange(n) for n in lengths])
        out.append({"pack": first + number, "n_tokens": sum(lengths), "doc_ids": [p[0] for p in own],
                    "doc_offsets": [p[1] for p in own], "cu_seqlens": [0, *np.cumsum(lengths).tolist()],
                    "ids": ids.tobytes(), "position_ids": positions.tobytes()})
    return out


_ARROW = pa.schema([("pack", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_offsets", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())), ("ids", pa.binary()),
                    ("position_ids", pa.binary())])


def pack(docs: DataFrame, path: str, pattern: str, end: int = 50256, size: int = 2048, group_tokens: int = 1 << 20) -> DataFrame:
    """One row per packed row of `size` ids, under SCHEMA.

    `ids` are little-endian unsigned 16-bit, `end` closes every document and fills a row's rest; `cu_seqlens` are the
    bounds of its segments, `position_ids` count from 0 again in each; `doc_ids` and `doc_offsets` (in tokens) say
    whose part a segment is. Null and empty texts are a single `end`; null ids stay null; rows that repeat are packed
    as often. `pack` tells rows apart and depends, like the grouping, on how the input is split into partitions.
    """
    if size > 1 << 16 or end >= 1 << 16:
        raise ValueError("ids and positions are 16-bit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, group, held, made = encoding(path, pattern), [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(tokens.encode_to_numpy(text or "", allowed_special=set(), disallowed_special=()), end)
                group.append((doc, ids.astype("<u2")))
                held += len(ids)
                if held >= group_tokens:
                    rows = _packed(group, size, end, made)
                    group, held, made = [], 0, made + len(rows)
                    for at in range(0, len(rows), 1024):
                        yield pa.RecordBatch.from_pylist(rows[at:at + 1024], _ARROW)
        if group:
            yield pa.RecordBatch.from_pylist(_packed(group, size, end, made), _ARROW)
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def write_packs(packs: DataFrame, path: str) -> None:
    """Parquet whose binary columns are the rows of the matrices, ready to be read into arrays without parsing."""
    packs.write.option("compression", "zstd").parquet(path)


def digests(packs: DataFrame) -> DataFrame:
    """The packs with SHA-256 digests in place of the matrices."""
    return packs.select("pack", "n_tokens", F.size("doc_ids").alias("n_segments"), "doc_ids", "doc_offsets", "cu_seqlens",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("position_ids", 256).alias("positions_sha256"))


def unpacked(packs: DataFrame) -> DataFrame:
    """`doc_id`, `doc_offset`, `ids` of every segment: what `pack` was given, in parts."""
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for r in batch.to_pylist():
                ids, bounds = r["ids"], r["cu_seqlens"]
                for doc, at, a, b in zip(r["doc_ids"], r["doc_offsets"], bounds, bounds[1:], strict=False):
                    out.append({"doc_id": doc, "doc_offset": at, "ids": ids[2 * a:2 * b]})
            return pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("doc_offset", pa.int64()),
                                                              ("ids", pa.binary())]))
        return work
    return map_batches(packs.select("doc_ids", "doc_offsets", "cu_seqlens", "ids"), make,
                       "doc_id long, doc_offset long, ids binary")
