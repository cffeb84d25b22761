"""A Merkle manifest of documents: one tree per source, one tree over the sources, and inclusion proofs.

Only every second level is stored. A proof is extracted from the top down: the nodes of one stored level are read in
aligned subtrees of 256, the level between is hashed anew from them, each node's siblings are emitted and the
regenerated nodes thrown away. A source with a third of all rows is many subtrees, each a group of its own.
"""

from __future__ import annotations

import hashlib
import string
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.llm.common import map_batches, numbered

_FAN, _STORED = 16, 2
_SUBTREE = _FAN ** _STORED
#: The one tree over all sources.
_ALL = ""
_PATH = "array<struct<place:int,others:string>>"


@dataclass(frozen=True)
class Tree:
    """A forest: `levels` has the stored nodes of every second level; `roots` has `g`, `height`, `root`."""

    levels: list[DataFrame]
    roots: DataFrame


def hashed(*values: Column) -> Column:
    """Lower-case hex SHA-256 of values, each as its length in bytes, a colon and itself; a null one as a hyphen."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (x.cast("string") for x in values)]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """`source`, `doc_id`, `leaf` and `shown`: the leaf as presented for proof, of a lower-cased text (A-Z) where `tampered`."""
    text = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)

    def leaf(of: Column) -> Column:
        return hashed(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), of)
    shown = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(text))
    found = docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf(F.col("text")).alias("leaf"),
                        shown.alias("shown"))
    return found.withColumn("shown", F.coalesce("shown", "leaf"))


def _subtrees(nodes: DataFrame, *more: str) -> DataFrame:
    """`g`, `block`, `height`, `items`: the nodes of each aligned subtree in order, equal leaves as one item of `n`."""
    block = F.explode(F.expr(f"sequence(start div {_SUBTREE}, (start + n - 1) div {_SUBTREE})")).alias("block")
    item = F.struct(F.greatest("start", F.col("block") * _SUBTREE).alias("start"),
                    F.least(F.col("start") + F.col("n"), (F.col("block") + 1) * _SUBTREE).alias("end"), "digest", *more)
    return (nodes.select("*", block).select("g", "block", "height", item.alias("item"))
            .groupBy("g", "block").agg(F.first("height").alias("height"), F.sort_array(F.collect_list("item")).alias("items")))


def _climbed(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes two levels up, or the root of a tree that ends before."""
    whole = F.flatten(F.transform("items", lambda x: F.array_repeat(x["digest"], (x["end"] - x["start"]).cast("int"))))
    runs = F.transform(F.expr(f"sequence(0, (size(whole) - 1) div {_FAN})"), lambda k: F.sha2(
        F.array_join(F.slice("whole", k.cast("int") * _FAN + 1, _FAN), ""), 256))
    up = F.col("height") - level
    digest = F.when(up >= 2, F.sha2(F.array_join("runs", ""), 256)).when(up == 1, F.col("runs")[0]).otherwise(F.col("whole")[0])
    return (_subtrees(nodes).withColumn("whole", whole).withColumn("runs", runs)
            .select("g", F.col("block").alias("start"), F.lit(1).cast("long").alias("n"), digest.alias("digest"), "height"))


def grow(rows: DataFrame, path: str) -> Tree:
    """Stores a tree for each `g` of `g`, `start`, `n`, `total`, `digest` (and other columns) below `path`."""
    spark = rows.sparkSession
    # Levels above n leaves are the hexadecimal digits of n - 1.
    height = F.when(F.col("total") <= 1, 0).otherwise(F.length(F.hex(F.col("total") - 1)))

    def stored(frame: DataFrame, level: int) -> DataFrame:
        frame.write.parquet(f"{path}/level-{level}")
        return spark.read.schema(frame.schema).parquet(f"{path}/level-{level}")
    levels = [stored(rows.withColumn("height", height.cast("int")).drop("total"), 0)]
    highest = levels[0].agg(F.max("height")).first()[0] or 0
    roots = None
    for level in range(0, max(1, highest), _STORED):
        open_ = levels[-1] if not level else levels[-1].filter(F.col("height") > level)
        levels.append(stored(_climbed(open_, level), level + _STORED))
        done = levels[-1].filter(F.col("height") <= level + _STORED).select("g", "height", F.col("digest").alias("root"))
        roots = done if roots is None else roots.union(done)
    return Tree(levels, roots)


def _joined(tree: Tree, crown: DataFrame, *more: str) -> DataFrame:
    """`g`, `block`, `height`, `items`, `root`, `above` of the lowest subtrees.

    `crown` has `g`, `height`, `root`, `above` of every tree: what lies above its root. `above` has a step for every
    level: the place of the node in its run, and the run's others.
    """
    above = None
    for k in reversed(range(len(tree.levels) - 1)):
        level = k * _STORED
        ends = F.col("height") <= level + _STORED
        tops = crown.filter(ends & (F.col("height") > level) if level else ends).select(
            "g", F.lit(0).cast("long").alias("block"), "root", "above")
        parents = tops if above is None else tops.union(above)
        nodes = tree.levels[k]
        if not level:
            return _subtrees(nodes, *more).join(parents, ["g", "block"])
        blocks = _subtrees(nodes.filter(F.col("height") > level)).join(parents, ["g", "block"])
        above = _descend(blocks, level)
    raise ValueError("a tree has two stored levels at least")


def steps(digests: list[str], levels: int) -> list[list[tuple[int, str]]]:
    """For each node of a subtree its place and the others of its run, on so many levels; those between are hashed anew."""
    out: list[list[tuple[int, str]]] = [[] for _ in digests]
    spots = range(len(digests))
    for _ in range(levels):
        runs = [digests[k:k + _FAN] for k in range(0, len(digests), _FAN)]
        for path, spot in zip(out, spots, strict=True):
            run, place = runs[spot // _FAN], spot % _FAN
            path.append((place, "".join(run[:place] + run[place + 1:])))
        digests = [_sha("".join(r)) for r in runs]
        spots = [s // _FAN for s in spots]
    return out


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, others in path:
        at = 64 * place
        leaf = _sha(others[:at] + leaf + others[at:])
    return leaf


def _whole(items: list[dict], key: str) -> list:
    return [x[key] for x in items for _ in range(x["end"] - x["start"])]


def _descend(blocks: DataFrame, level: int) -> DataFrame:
    """`g`, `start`, `root`, `above` of every node of the blocks."""
    schema = f"g string, block long, root string, above {_PATH}"

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for g, height, items, root, above in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rest = [(a["place"], a["others"]) for a in above]
                found = steps(_whole(items, "digest"), min(_STORED, height - level))
                out += [(g, items[0]["start"] + i, root, [{"place": p, "others": o} for p, o in path + rest])
                        for i, path in enumerate(found)]
            kinds = [pa.string(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                              ["g", "block", "root", "above"])
        return work
    return map_batches(blocks.select("g", "height", "items", "root", "above"), make, schema, rows=16)


def _proved(blocks: DataFrame, name: str, kind: pa.DataType, root: str) -> DataFrame:
    """`name`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified` of every leaf of the blocks."""
    columns = {name: kind, "leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "proof_sha256": pa.string(),
               "folded_root": pa.string(), "verified": pa.bool_()}

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for height, items, subroot, above in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rest = [(a["place"], a["others"]) for a in above]
                names, digests, shown = (_whole(items, k) for k in (name, "digest", "shown"))
                for n, leaf, given, path in zip(names, digests, shown, steps(digests, min(_STORED, height)), strict=True):
                    path += rest
                    end = folded(given, path)
                    out.append((n, leaf, subroot, root, _sha("".join(o for _, o in path)), end, end == root))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), columns.values(), strict=True)], list(columns))
        return work
    schema = (f"{name} long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    return map_batches(blocks.select("height", "items", "root", "above"), make, schema, rows=16)


@dataclass(frozen=True)
class Manifest:
    """The trees of all sources, the tree over their roots, and its root (None without documents)."""

    sources: Tree
    top: Tree
    root: str | None


def build(rows: DataFrame, path: str) -> Manifest:
    """Builds and stores the manifest of `source`, `doc_id`, `leaf`, `shown` (see `leaves`) below `path`.

    Within a source leaves are ordered by id, a null one first, and by digest where an id repeats; equal rows are leaves
    of their own. Sources are ordered by their UTF-8 bytes, the null one first.
    """
    # Sources as keys that are never null and keep their order.
    keyed = rows.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("g"), "doc_id", "leaf", "shown")
    each = keyed.groupBy("g", "doc_id", "leaf", "shown").agg(F.count("*").alias("n"))
    laid = numbered(each, "doc_id", "leaf")
    sources = grow(laid.withColumnRenamed("leaf", "digest"), f"{path}/sources")
    names = sources.roots.select(F.lit(_ALL).alias("g"), F.col("g").alias("name"), F.col("root").alias("digest"),
                                 F.lit(1).cast("long").alias("n"))
    top = grow(numbered(names, "name"), f"{path}/top")
    last = top.roots.first()
    return Manifest(sources, top, last and last["root"])


def load(spark: SparkSession, path: str) -> Manifest:
    """The manifest stored below `path`."""
    def tree(name: str) -> Tree:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
        numbers = sorted(int(f.getPath().getName().removeprefix("level-")) for f in files)
        levels = [spark.read.parquet(f"{path}/{name}/level-{n}") for n in numbers]
        roots = None
        for n, nodes in zip(numbers[1:], levels[1:], strict=True):
            done = nodes.filter(F.col("height") <= n).select("g", "height", F.col("digest").alias("root"))
            roots = done if roots is None else roots.union(done)
        return Tree(levels, roots)
    sources, top = tree("sources"), tree("top")
    last = top.roots.first()
    return Manifest(sources, top, last and last["root"])


def prove(m: Manifest) -> DataFrame:
    """`doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified` for every leaf.

    The proof is the hash of the siblings, level by level from the leaf to the root of its source and of the whole; the
    folded root is what the leaf as shown and those siblings give. No documents give no rows.
    """
    none = F.array().cast(_PATH)
    crown = m.top.roots.select("g", "height", "root", none.alias("above"))
    over = _joined(m.top, crown, "name")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for height, items, above in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rest = [(a["place"], a["others"]) for a in above]
                for x, path in zip(items, steps(_whole(items, "digest"), min(_STORED, height)), strict=True):
                    out.append((x["name"], [{"place": p, "others": o} for p, o in path + rest]))
            kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))
            return pa.RecordBatch.from_arrays([pa.array([n for n, _ in out]), pa.array([a for _, a in out], kind)],
                                              ["g", "above"])
        return work
    over = map_batches(over.select("height", "items", "above"), make, f"g string, above {_PATH}", rows=16)
    crown = m.sources.roots.join(over, "g")
    return _proved(_joined(m.sources, crown, "doc_id", "shown"), "doc_id", pa.int64(), m.root or "")
