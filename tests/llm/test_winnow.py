import bisect
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudtally.llm import winnow


def plain(text, k, w):
    """Positions kept, from the hashes of the grams themselves."""
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(x):
        return []
    k = min(k, len(x))
    h = [int(v) >> 24 for i in range(len(x) - k + 1) for v in winnow._grams(x[i:i + k], k)]
    w = min(w, len(h))
    kept = set()
    for i in range(len(h) - w + 1):
        low = min(h[i:i + w])
        kept.add(max(j for j in range(i, i + w) if h[j] == low))
    return sorted((p, h[p]) for p in kept)


@pytest.mark.parametrize("text", ["", "a", "abcd", "abcde" * 3, "a" * 100, "é日本😀" * 30, "the cat sat on the mat " * 9])
@pytest.mark.parametrize(("k", "w"), [(1, 1), (5, 4), (7, 9), (16, 32)])
def test_against_every_window(text, k, w):
    hashes, places = winnow.winnowed(text, k, w)
    assert list(zip(places.tolist(), hashes.tolist(), strict=True)) == plain(text, k, w)


def test_chunks_do_not_change_the_result(monkeypatch):
    pick = random.Random(4)
    text = "".join(pick.choice("ab c") for _ in range(3000))
    whole = winnow.winnowed(text, 5, 8)
    for size in (50, 64, 999, 2991, 2996):
        monkeypatch.setattr(winnow, "_CHUNK", size)
        part = winnow.winnowed(text, 5, 8)
        assert all((a == b).all() for a, b in zip(whole, part, strict=True)) and len(whole[0]) == len(part[0])


def test_shared_passage_shares_a_hash():
    pick = random.Random(8)
    for _ in range(50):
        passage, left, right = ("".join(pick.choice("abcdefgh ") for _ in range(n)) for n in (47, 200, 90))
        a, b = winnow.winnowed(left + passage + right), winnow.winnowed(right + passage + left)
        assert set(a[0].tolist()) & set(b[0].tolist())


def expected(texts):
    ids = sorted(texts)
    for n, i in enumerate(ids):
        own, after = texts[i] or "", texts[ids[(n + 1) % len(ids)]] or ""
        q = len(own) // 4
        edited = own[:len(own) - q] + after[:q]
        a, b, c = (set(winnow.winnowed(t)[0].tolist()) for t in (own, edited, after))

        def like(x, y):
            return len(x & y) / len(x | y) if x | y else 1.0
        yield (i, len(own), hashlib.sha256(edited.encode()).hexdigest(), winnow.name(*winnow.winnowed(own)),
               winnow.name(*winnow.winnowed(edited)), like(a, b), like(a, c))


def test_query(query, sample):
    texts = {r.doc_id: r.text for r in sample("documents").collect()}
    got = sorted(query("op7_winnowing").itertuples(index=False, name=None))
    assert got == list(expected(texts))


@pytest.mark.parametrize("bucket_docs", [1, 2, 3, 1000])
def test_next_across_buckets(docs, bucket_docs):
    rows = [(i * 7 - 20, f"text {i} " * (i % 5) if i % 6 else None) for i in range(23)]
    got = winnow.edited_likeness(docs(rows), bucket_docs=bucket_docs).collect()
    assert sorted(tuple(r) for r in got) == list(expected(dict(rows)))


def test_odd_rows(docs):
    rows = [(None, "last one " * 9), (3, "same id " * 7), (3, "same id " * 7), (3, "other"), (1, "")]
    got = winnow.edited_likeness(docs(rows), bucket_docs=1).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got if r.doc_id) == [(1, 0), (3, 5), (3, 56), (3, 56)]
    assert len({r.fingerprint for r in got if r.n_chars == 56}) == 1
    assert [r.n_chars for r in got if r.doc_id is None] == [81]
    one = winnow.edited_likeness(docs([(5, "alone in here, all of it")])).collect()[0]
    assert one.near_next == 1.0
    assert winnow.edited_likeness(docs([])).count() == 0
    kept = {r.doc_id: (r.hashes, r.positions) for r in winnow.fingerprints(docs([(1, None), (2, "abc")])).collect()}
    assert kept[1] == ([], []) and kept[2][1] == [0]


def test_one_hundred_thousand_buckets_are_planned_quickly(spark):
    edges = sorted(random.Random(2).sample(range(-10 ** 15, 10 ** 15), 100_000))
    asked = [edges[0] - 1, edges[0], edges[0] + 1, *edges[70_000:70_010], edges[-1] - 1, edges[-1], 10 ** 16, 0]
    frame = spark.createDataFrame([(a,) for a in asked], "a long")
    start = time.perf_counter()
    found = frame.select("a", winnow.below(F.col("a"), edges).alias("n"))
    found._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 5
    assert [tuple(r) for r in found.collect()] == [(a, bisect.bisect_right(edges, a)) for a in asked]


def test_hot_ids_are_cut_into_buckets(docs):
    rows = [(None, f"null {i} " * 3) for i in range(300)] + [(5, f"five {i} " * 3) for i in range(300)]
    rows += [(i, f"own {i}") for i in range(40)] + [(5, "twice")] * 30
    laid = winnow.with_next(docs(rows), bucket_docs=16).filter("not last")
    sizes = {r.bucket: r["count"] for r in laid.groupBy("bucket").count().collect()}
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) < 90
    got = winnow.edited_likeness(docs(rows), bucket_docs=16).collect()
    whole = winnow.edited_likeness(docs(rows), bucket_docs=10_000).collect()
    assert sorted(map(str, got)) == sorted(map(str, whole)) and len(got) == len(rows)
