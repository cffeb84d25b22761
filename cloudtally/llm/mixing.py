"""Mixing sources to target weights by blocks drawn through index permutations.

The words of each source, document after document, are packed into blocks of a fixed number of words. Output shards
have a fixed number of slots; each draws how many slots go to each source from a multinomial distribution. The slots of
one source are numbered through all shards, and its n-th slot takes the block that a pseudorandom permutation of the
block numbers names, another permutation for each pass over the source. Nothing depends on the number of partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.llm.common import cut, map_batches

_GROUP = 1024
_SHARDS_PER_TASK, _MOST_TASKS = 4, 20_000


@dataclass(frozen=True)
class Source:
    """One source: its place in code-point order, words, weight, target in words and quota in slots."""

    number: int
    name: str | None
    size: int
    target: float
    blocks: int
    quota: int


@dataclass(frozen=True)
class Mix:
    """`docs`: doc_id, mark, number, size, start; `slots`: shard, slot, number, block, epoch; `sources` by number."""

    docs: DataFrame
    slots: DataFrame
    sources: list[Source]
    block_words: int


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """All words shared out by weight, none above `most` times its size; what is left over is shared again."""
    left, total = set(range(len(sizes))), float(sum(sizes))
    out = [0.0] * len(sizes)
    while left:
        weight = sum(weights[i] for i in left)
        full = {i for i in left if total * weights[i] / weight > most * sizes[i]}
        if not full:
            for i in left:
                out[i] = total * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
        total -= sum(out[i] for i in full)
        left -= full
    return out


def permuted(index: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """Where the permutation of 0..n-1 that each key names sends each index: a Feistel network, walked into range."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    at, keys = index.astype(np.uint64), keys.astype(np.uint64)
    todo = np.arange(len(at))
    while todo.size:
        a, b, k = at[todo] >> half, at[todo] & low, keys[todo]
        for turn in range(4):
            h = (b + k + np.uint64(turn << 40)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((h ^ (h >> np.uint64(29))) & low)
        at[todo] = (a << half) | b
        todo = todo[at[todo] >= n]
    return at.astype(np.int64)


def _sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and a mark that tells documents with one id apart."""
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes = [len((t or "").encode().split()) for t in batch.column(3).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64())],
                                              ["doc_id", "source", "mark", "size"])
        return work
    kinds = dict(docs.dtypes)
    return map_batches(docs.select("doc_id", "source", mark(), "text"), make,
                       f"doc_id {kinds['doc_id']}, source {kinds['source']}, mark string, size long")


def mark():
    """128 bits that name a row by its id, source and text; which of them are null counts too."""
    columns = ("doc_id", "source", "text")
    missing = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    return F.concat(F.hex(F.xxhash64(missing, *columns)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), missing, *columns))).alias("mark")


def _running(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The frame with `before`: the sum of `value` over the key's rows of lower order, in two steps.

    Joined in the window's partitions: Spark takes what a few shards make for as small as they are, and would broadcast it.
    """
    some = df.withColumn("part", F.expr(f"{order} div {_GROUP}"))
    sums = some.groupBy(key, "part").agg(F.sum(value).alias("s"))
    base = sums.select(key, "part", (F.sum("s").over(Window.partitionBy(key).orderBy("part")) - F.col("s")).alias("base"))
    inner = F.sum(value).over(Window.partitionBy(key, "part").orderBy(order)) - F.col(value)
    return some.withColumn("inner", inner).join(base.hint("merge"), [key, "part"]).withColumn(
        "before", F.col("base") + F.col("inner")).drop("part", "base", "inner")


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, block_words: int = 64,
        shard_slots: int = 16384, bucket_docs: int = 256, seed: int = 7, max_sources: int = 1_000_000) -> Mix:
    """Draws a mix as large as all documents together.

    Sources in code-point order, null last, get the weights in turn. Documents of a source are ordered by a hash,
    about `bucket_docs` to a bucket, so that a source with a third of all rows is numbered by many tasks. Each source
    is one row on the driver (more than `max_sources` raise). Where draws leave a source above its quota, its last
    slots go to the sources below theirs, so that each source's words differ from its target by at most one and a half
    blocks (rounding, and a short last block) and no block is taken more than `most` times. Null and empty texts have size 0 and take part in no block.
    """
    spark = docs.sparkSession
    sized = cut(_sized(docs))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    rows = per_source.limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in rows]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], most)
    sources = []
    for i, (r, target) in enumerate(zip(rows, goal, strict=True)):
        blocks = -(-r["size"] // block_words)
        passes = int(target // r["size"]) if r["size"] else 0
        rest = round((target - passes * r["size"]) / block_words)
        sources.append(Source(i, r.source, r["size"], target, blocks, min(passes * blocks + rest, int(most) * blocks)))
    names = spark.createDataFrame([(s.name, s.number) for s in sources], "source string, number int")
    buckets = max(1, -(-sum(r["rows"] for r in rows) // bucket_docs))
    placed = sized.join(names, sized["source"].eqNullSafe(names["source"])).select(
        "doc_id", "mark", "number", "size", F.pmod(F.xxhash64("mark"), F.lit(buckets)).alias("bucket"))
    groups = placed.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    base = _running(groups, "number", "bucket", "words").select("number", "bucket", "before")
    inner = F.sum("size").over(Window.partitionBy("number", "bucket").orderBy("mark", "doc_id", "size")
                               .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    started = cut(placed.withColumn("inner", inner).join(base, ["number", "bucket"]).select(
        "doc_id", "mark", "number", "size", (F.col("before") + F.col("inner")).alias("start")))
    return Mix(started, _slots(spark, sources, shard_slots, seed), sources, block_words)


def _slots(spark, sources: list[Source], shard_slots: int, seed: int) -> DataFrame:
    schema = "shard long, slot long, number int, block long, epoch long"
    quota = np.array([s.quota for s in sources], np.int64)
    blocks = np.array([max(1, s.blocks) for s in sources], np.int64)
    total = int(quota.sum())
    if not total:
        return spark.createDataFrame([], schema)
    shards = -(-total // shard_slots)

    def draw():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for shard in batch.column(0).to_pylist():
                slots = min(shard_slots, total - shard * shard_slots)
                n = np.random.default_rng([seed, shard]).multinomial(slots, quota / total)
                out.append((np.full(len(n), shard), np.arange(len(n)), n, np.cumsum(n) - n))
            shard, number, n, first = (np.concatenate(x) for x in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(number, pa.int32()), pa.array(n, pa.int64()),
                 pa.array(first, pa.int64())], ["shard", "number", "n", "first"])
        return work
    tasks = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))
    drawn = map_batches(spark.range(0, shards, 1, tasks), draw, "shard long, number int, n long, first long")
    drawn = cut(drawn.filter("n > 0"))
    got = np.zeros(len(sources), np.int64)
    for r in drawn.groupBy("number").agg(F.sum("n").alias("n")).collect():
        got[r.number] = r.n
    over, under = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    over_base, under_base = np.cumsum(over) - over, np.cumsum(under) - under

    def place():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            shard, number, n, first, before = (batch.column(k).to_numpy() for k in range(5))
            each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            shard, slot, source = np.repeat(shard, n), each + np.repeat(first, n), np.repeat(number, n)
            turn = each + np.repeat(before, n)
            spare = np.flatnonzero(turn >= quota[source])
            rank = over_base[source[spare]] + turn[spare] - quota[source[spare]]
            # Sources with nothing to fill share their base with the next one and are passed over.
            source[spare] = np.searchsorted(under_base, rank, side="right") - 1
            turn[spare] = got[source[spare]] + rank - under_base[source[spare]]
            size = blocks[source]
            epoch, block = turn // size, turn % size
            for s in np.unique(source):
                of = np.flatnonzero(source == s)
                keys = np.uint64(seed) * np.uint64(1_000_003) + np.uint64(s) * np.uint64(8191) + epoch[of].astype(np.uint64)
                block[of] = permuted(block[of], int(blocks[s]), keys)
            return pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(slot), pa.array(source, pa.int32()), pa.array(block), pa.array(epoch)],
                ["shard", "slot", "number", "block", "epoch"])
        return work
    numbered = _running(drawn, "number", "shard", "n").select("shard", "number", "n", "first", "before")
    # Few rows make many slots: a stated number of tasks, and few rows at a time (at most 64 * shard_slots slots).
    spread = numbered.repartition(max(1, min(shards // _SHARDS_PER_TASK, _MOST_TASKS)), "shard")
    return map_batches(spread, place, schema, rows=64)


def pieces(m: Mix) -> DataFrame:
    """The parts of documents in blocks: doc_id, mark, number, start, block, and words `lo` to `hi` of the document."""
    n = m.block_words
    at = F.explode(F.expr(f"sequence(start div {n}, (start + size - 1) div {n})")).alias("block")
    cutoff = m.docs.filter("size > 0").select("doc_id", "mark", "number", "start", "size", at)
    return cutoff.select(
        "doc_id", "mark", "number", "start", "size", "block",
        F.greatest(F.lit(0), F.col("block") * n - F.col("start")).alias("lo"),
        F.least("size", (F.col("block") + 1) * n - F.col("start")).alias("hi"))


def taken(m: Mix) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target`, `taken` for every row of the documents, repeated rows included.

    Slots are never broadcast: Spark's estimate of them is that of the shards, thousands of times fewer.
    """
    times = m.slots.groupBy("number", "block").agg(F.count("*").alias("times"))
    used = (pieces(m).join(times.hint("merge"), ["number", "block"]).groupBy("number", "start")
            .agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken")))
    spark = m.docs.sparkSession
    facts = spark.createDataFrame([(s.number, s.size, s.target) for s in m.sources],
                                  "number int, source_size long, target double")
    some = m.docs.filter("size > 0").join(used, ["number", "start"], "left")
    none = m.docs.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    both = some.select("doc_id", "number", "size", "taken").union(none.select("doc_id", "number", "size", "taken"))
    return both.join(facts, "number").select("doc_id", "size", "source_size", "target",
                                             F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed(docs: DataFrame, m: Mix) -> DataFrame:
    """The mix as rows of `docs`' columns: one per document and pass over its source in which it is taken.

    A pass that takes all of a document repeats its text; otherwise the words of the blocks taken follow each other,
    space between two. `n_chars`, where there is one, is counted anew. Rows equal in id, source and text each give
    the rows of the first of them.
    """
    span = F.struct("lo", "hi")
    of = (pieces(m).join(m.slots.select("number", "block", "epoch").hint("merge"), ["number", "block"])
          .groupBy("mark", "number", "start", "epoch", "size").agg(F.sort_array(F.collect_list(span)).alias("spans")))
    one = (of.groupBy("mark").agg(F.min(F.struct("number", "start")).alias("first")))
    of = (of.join(one, "mark").filter(F.struct("number", "start") == F.col("first"))
          .groupBy("mark").agg(F.collect_list(F.struct("epoch", "spans", "size")).alias("passes")))
    names = [c for c in docs.columns if c != "text"]
    rows = docs.select(mark(), "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("rest"))
    rows = rows.join(of, "mark").select("text", "passes", "rest")
    kept = rows.select("text", F.explode("passes").alias("p"), "rest")
    whole = (F.size("p.spans") == 1) & (F.col("p.spans")[0]["lo"] == 0) & (F.col("p.spans")[0]["hi"] == F.col("p.size"))
    covered = F.aggregate("p.spans", F.lit(0).cast("long"), lambda s, x: s + x["hi"] - x["lo"]) == F.col("p.size")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if spans is None:
                    out.append(text)
                    continue
                words = text.encode().split()
                out.append(b" ".join(w for s in spans for w in words[s["lo"]:s["hi"]]).decode())
            return pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(2)], ["text", "rest"])
        return work
    done = map_batches(kept.select("text", F.when(~(whole | covered), F.col("p.spans")).alias("spans"), "rest"), make,
                       rows.select("text", "rest").schema)
    count = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    return done.select(*["text" if c == "text" else count.alias(c) if c == "n_chars" else F.col(f"rest.`{c}`").alias(c)
                         for c in docs.columns])
