import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cloudtally.llm import merkle
from cloudtally.llm.common import scratch

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def leaf(i, source, lang, n, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def path(tree, at):
    for nodes in tree[:-1]:
        run = nodes[at // 16 * 16:at // 16 * 16 + 16]
        yield run[:at % 16], run[at % 16 + 1:]
        at //= 16


def plain(rows):
    """Every contract column, all levels held at once."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for at, (_, _, own, r) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            steps = [*path(trees[s], at), *path(top, n)]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            end = leaf(*r[:4], lower(r[4])) if bad else own
            for before, after in steps:
                end = sha("".join([*before, end, *after]))
            proof = sha("".join(h for before, after in steps for h in before + after))
            out.append((r[0], own, trees[s][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return sorted(out, key=str)


def proved(spark, rows, partitions=3):
    frame = spark.createDataFrame(
        [(i, text, lang, source, n, 1, "x", 2) for i, source, lang, n, text in rows],
        "doc_id long, text string, lang string, source string, n_chars long, n int, leaf string, start int")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    at = scratch(spark, "test-merkle")
    m = merkle.build(merkle.leaves(frame.repartition(partitions), tampered), at)
    got = merkle.prove(m)
    assert got.columns == COLUMNS
    again = merkle.prove(merkle.load(spark, at))
    first = sorted((tuple(r) for r in got.collect()), key=str)
    assert first == sorted((tuple(r) for r in again.collect()), key=str)
    return first


def test_query_against_sql(query, oracle):
    got, want = query("op13_merkle_manifest"), oracle("op13_merkle_manifest")
    rows = sorted(map(tuple, got[COLUMNS].astype(object).to_numpy()))
    assert rows == sorted(map(tuple, want[COLUMNS].astype(object).to_numpy()))
    assert 0 < sum(not r[-1] for r in rows) < len(rows) / 4


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1], [16], [17, 1], [256, 257], [300, 16, 1], [4097, 3]])
def test_against_trees_held_whole(spark, sizes):
    rows = [(k * 10_000 + i, f"s{k}", "en", 3, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert proved(spark, rows) == plain(rows)


def test_many_sources(spark):
    rows = [(i, f"host{i % 300}", None, i, "A") for i in range(700)]
    assert proved(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "", 0, ""), (1, None, "en", 2, "É A"), (1, None, "en", 2, "other"),
            (-5, "ß", "de", 1, "x" * 200_000), (7, "b", None, None, "Z"), (7, "B", None, None, "Z"), (3, "\U0001f600", "a", 1, None)]
    rows += [(9, "b", "en", 1, "Same row")] * 600
    assert proved(spark, rows) == plain(rows)
    assert proved(spark, []) == []
