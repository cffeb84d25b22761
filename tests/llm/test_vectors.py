import numpy as np
import pytest

from cloudtally.llm import vectors
from tests.llm.test_simhash import smallest


def brute(rows, cosine=0.95):
    ok = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    at = [k for k, (i, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = {k: 0 for k in range(len(rows))}
    pairs = []
    for x, (_, v) in zip(at, ok, strict=True):
        for y, (_, w) in zip(at, ok, strict=True):
            if x < y and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= cosine:
                pairs.append((x, y))
                links[x] += 1
                links[y] += 1
    root = smallest(range(len(rows)), pairs)
    names = {}
    for k, (i, _) in enumerate(rows):
        names[root[k]] = min(names.get(root[k], i), i)
    return sorted((i, links[k], names[root[k]], i == names[root[k]]) for k, (i, _) in enumerate(rows))


def clusters(n, dims, seed=2):
    pick = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = pick.standard_normal(dims)
        for spread in [0.0, *pick.uniform(0.02, 0.5, pick.integers(0, 12))]:
            out.append(base + spread * pick.standard_normal(dims))
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(out[:n])]


@pytest.mark.parametrize(("dims", "cell_rows"), [(64, 50), (64, 8192), (10, 30), (3, 20), (1, 5)])
def test_against_all_pairs(spark, dims, cell_rows):
    rows = clusters(260, dims)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vectors.near_duplicates(frame, cell_rows=cell_rows).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_query(query, sample):
    rows = [(r.vec_id, r.embedding) for r in sample("embeddings").collect()]
    assert sorted(query("op2_subspace_pigeonhole_join").itertuples(index=False, name=None)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0]), (11, [1.0]),
            (12, [1.0, 0.0, 0.0]), (13, [3.0]), (14, [-1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, True) for r in rows],
                                  "vec_id long, embedding array<float>, n_links int, kept boolean")
    assert sorted(map(tuple, vectors.near_duplicates(frame).collect())) == brute(rows)
    none = spark.createDataFrame([(None, [1.0, 2.0]), (5, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in vectors.near_duplicates(none).collect()} == {(None, 1, 5, False), (5, 1, 5, True)}
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_each_pair_of_a_dense_group_is_found_once(seed):
    pick = np.random.default_rng(seed)
    group = vectors.unit((pick.standard_normal(64) + 0.14 * pick.standard_normal((2000, 64))).astype(np.float32))
    p = vectors.plan(group[:500], len(group), 0.95, 8, 8192, 11)
    halves = np.flatnonzero(np.arange(2000) % 3 == 0), np.flatnonzero(np.arange(2000) % 3 > 0)
    times = np.zeros((2000, 2000), np.int8)
    for block in range(p.blocks):
        # The rows of a block are dealt to tasks in another way than those of the next.
        if block % 2:
            s, t = vectors._found(p, block, group, None, 0.95)
            times[s, t] += 1
        else:
            for rows in halves:
                s, t = vectors._found(p, block, group[rows], None, 0.95)
                times[rows[s], rows[t]] += 1
            s, t = vectors._found(p, block, group[halves[0]], group[halves[1]], 0.95)
            s, t = halves[0][s], halves[1][t]
            times[np.minimum(s, t), np.maximum(s, t)] += 1
    cosines = np.triu(group @ group.T, 1)
    sure = np.abs(cosines - 0.95) > 1e-12
    assert (times[sure] == (cosines[sure] > 0.95)).all()


def test_rotated_bits_do_not_depend_on_the_batch():
    rows = vectors.unit(np.random.default_rng(1).standard_normal((300, 64)))
    p = vectors.plan(rows, 300, 0.95, 8, 8192, 11)
    assert all((p.turn(rows[k:k + n]) == p.turn(rows)[k:k + n]).all() for k in (0, 7) for n in (1, 2, 3, 17, 100))


def test_query_against_sql(query, oracle):
    got, want = query("op2_subspace_pigeonhole_join"), oracle("op2_subspace_pigeonhole_join")
    assert sorted(map(tuple, got[want.columns].to_numpy())) == sorted(map(tuple, want.to_numpy()))


def test_vectors_whose_squares_leave_doubles(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [2e-200, 2e-200]), (4, [1.0, 0.0]), (5, [5e-324, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4)}


def test_rounds_deal_every_cell_and_part_once():
    rounds = vectors._rounds({0: 10, 1: 20, 2: 90, 3: 400, 4: 30}, {0: 1, 1: 1, 2: 9, 3: 150, 4: 1}, 50)
    seen = [(b, cell, part) for blocks, share, shares, turn, turns in rounds for b in blocks
            for cell in range(840) if cell % shares == share for part in range(8) if part % turns == turn]
    assert sorted(seen) == [(b, c, k) for b in range(5) for c in range(840) for k in range(8)]
    assert [r[0] for r in rounds if len(r[0]) > 1] == [[0, 1]] and {r[4] for r in rounds if r[0] == [3]} == {3}


@pytest.mark.parametrize(("most", "cell_rows", "spread"), [(1, 30, 0.0), (300, 4, 0.0), (300, 10, 0.01)])
def test_many_rounds_and_parts_against_all_pairs(spark, monkeypatch, most, cell_rows, spread):
    rows = clusters(150, 16)
    # A group within a hair's breadth, which no cuts part: its cell is dealt in parts.
    pick = np.random.default_rng(1)
    rows += [(1000 + i, (np.arange(16) + spread * i / 90 + 0.01 * pick.standard_normal(16)).tolist()) for i in range(90)]
    monkeypatch.setattr(vectors, "_ROUND_ROWS", most)
    monkeypatch.setattr(vectors, "_ROUND_COPIES", 1)
    monkeypatch.setattr(vectors, "_SMALL", 8)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_duplicates(frame, cell_rows=cell_rows, sample_rows=40).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_no_copies_of_vectors_stay_in_shuffle_files(spark):
    import gc
    import time
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = disk.getAllFiles()
        return sum(files.apply(k).length() for k in range(files.size()))
    rows = clusters(4000, 64)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2).cache()
    frame.count()
    gc.collect()
    before = held()
    assert len(vectors.near_duplicates(frame, cell_rows=100).columns) == 4
    until = time.time() + 20
    while held() - before > 4 * 256 * len(rows) and time.time() < until:
        time.sleep(0.5)
    assert held() - before <= 4 * 256 * len(rows)
    frame.unpersist()
