import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cloudtally.llm import nearest


def plain(rows, k, every=1):
    """Every query's k nearest other rows, each pair compared."""
    good = [(n, i, v) for n, (i, v) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, i, v in good:
        if i is None or i % every:
            continue
        found = sorted((math.dist(v, w), j is None, j or 0) for m, j, w in good if m != n and len(w) == len(v))[:k]
        out += [(i, r + 1, None if none else j, d) for r, (d, none, j) in enumerate(found)]
    return sorted(out, key=str)


def search(spark, rows, k, kind="double", every=1, **more):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, score int, key string")
    got = nearest.nearest(frame, F.col("vec_id") % every == 0, k, **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


def test_query_against_sql(query, oracle):
    got, want = query("op12_block_matrix_neighbours"), oracle("op12_block_matrix_neighbours")
    order = ["query_id", "rank"]
    got, want = (d[["query_id", "rank", "vec_id", "score"]].sort_values(order, ignore_index=True) for d in (got, want))
    assert len(got) and (got["score"] == want["score"]).all()
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


@pytest.mark.parametrize("block_bytes", [400, 4000, 1 << 20])
def test_against_all_pairs(spark, block_bytes):
    pick = random.Random(1)
    rows = [(i, [pick.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [x + pick.gauss(0, 1e-4) for x in rows[3][1]]) for i in range(60)]
    rows += [(300 + i, rows[5][1]) for i in range(40)] + [(400, [1.0, 2.0]), (401, [1.0, 2.5]), (402, [7.0])]
    same(search(spark, rows, 5, every=3, block_bytes=block_bytes, blocks=4), plain(rows, 5, 3))


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [1.0, 3.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]),
            (None, [1.0, 2.0]), (6, [float("inf"), 1.0]), (7, [1.0, 1.0]), (8, [-0.0, 1.0]), (9, [0.0, 1.0])]
    same(search(spark, rows, 3), plain(rows, 3))
    assert search(spark, [(0, [1.0]), (1, None)], 3) == []
    assert search(spark, [], 3) == []


def test_values_whose_squares_leave_doubles(spark):
    rows = [(i, [s * 10.0 ** e, 10.0 ** e * i / 3]) for i, (s, e) in enumerate(
        [(1, 200), (-1, 200), (2, 200), (1, -200), (2, -200), (3, -200), (1, 0), (2, 0), (1, 307)])]
    same(search(spark, rows, 4), plain(rows, 4))


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(0, 1), (1, 0), (0, -1), (-1, 0), (1, 1), (5, 5), (1, 0)])]
    same(search(spark, rows, 2), plain(rows, 2))


def test_floats(spark):
    pick = random.Random(2)
    rows = [(i, np.float32([pick.gauss(0, 1) for _ in range(64)]).tolist()) for i in range(80)]
    same(search(spark, rows, 10, kind="float", every=10), plain(rows, 10, 10))


def test_codes_bound_distances():
    pick = np.random.default_rng(3)
    a, b = pick.standard_normal((30, 1500)), pick.standard_normal((40, 1500)) * pick.uniform(0, 9, (40, 1))
    (ac, s, ar), (bc, t, br) = nearest.codes(a), nearest.codes(b)
    assert (nearest.products(ac, bc) == ac.astype(int) @ bc.astype(int).T).all()
    decoded = np.linalg.norm((ac * s[:, None])[:, None] - (bc * t[:, None])[None], axis=2)
    true = np.linalg.norm(a[:, None] - b[None], axis=2)
    assert (abs(decoded - true) <= ar[:, None] + br[None]).all()
