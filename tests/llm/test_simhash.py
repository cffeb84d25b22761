import itertools
import random

import pytest
import xxhash

from cloudtally.llm import simhash
from cloudtally.llm.components import connected


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    found = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in found) > len(found))


def smallest(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


TEXTS = [None, "", " \t\r\n\x0b", "One", "one two", "ONE two", "a b c", "Ünï \x1c x\xa0y z", "w " * 9000, "é" * 5000,
         "the cat sat on the mat and the dog ran", "the cat sat on the mat and the dog RAN"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_query_against_all_pairs(query, sample):
    found = query("op4_simhash_near_dedup")
    texts = {r.doc_id: r.text for r in sample("documents").collect()}
    prints = {i: plain(t) for i, t in texts.items()}
    linked = [(a, b) for a, b in itertools.combinations(texts, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = smallest(texts, linked)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.itertuples()} == {
        i: (f"{prints[i]:016x}", expected[i]) for i in texts}


@pytest.mark.parametrize("bucket", [0, 3, 1000])
def test_links_joined_or_by_values_between(spark, bucket):
    pick = random.Random(5)
    prints = set()
    for _ in range(12):
        base = pick.getrandbits(64)
        prints |= {base} | {base ^ sum(1 << k for k in pick.sample(range(64), pick.randint(1, 4))) for _ in range(9)}
    signed = {simhash._signed(p): p for p in prints}
    linked = [(a, b) for a, b in itertools.combinations(signed, 2) if (signed[a] ^ signed[b]).bit_count() <= 2]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = [tuple(r) for r in simhash.links(frame, 2, bucket=bucket).collect()]
    assert smallest(signed, got) == smallest(signed, linked)
    assert bucket < 1000 or set(got) == {tuple(sorted(p)) for p in linked}


def test_odd_rows(docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "lonely words here"), (3, "One"), (4, "one two")]
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect()]
    assert len(got) == len(rows)
    assert (0, 0) in got and (1, 0) in got and (2, 0) in got and (None, None) in got and (5, 4) in got
    kept = sorted((r.doc_id is None, r.doc_id, r.text or "") for r in simhash.keep_one(docs(rows)).collect())
    texts = {plain(t): (i is None, i) for i, t in reversed(rows)}
    assert len(kept) == len(texts) and (False, 3, "One") in kept and (True, None, "lonely words here") in kept
    assert simhash.near_duplicates(docs([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {i for i, r in got.items() if r == 100} == set(range(100, 161))
    assert {i for i, r in got.items() if r == 7} == {7, *range(200, 260)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_takes_rows_not_ids(docs, spark):
    x, y = (" ".join(f"{c}{k}" for k in range(60)) for c in "xy")
    rows = [(3, x), (5, x.upper()), (5, y), (3, x), (None, "alone here"), (None, "alone here"), (None, y), (7, None), (8, " ")]
    frame = docs(rows).withColumnsRenamed({"score": "a.b", "component_id": "mark"})
    got = simhash.keep_one(frame)
    assert got.columns == frame.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in got.collect()) == sorted(
        [(3, x), (5, y), (0, "alone here"), (7, "")])
    assert simhash.keep_one(frame.limit(0)).count() == 0
