import numpy as np
import pytest

from cloudtally.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([0, 1000, 10], [1, 2, 3]) == [0, 980, 30]
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    seen = [mixing.permuted(np.arange(n), n, np.full(n, key)).tolist() for key in (1, 2)]
    assert sorted(seen[0]) == sorted(seen[1]) == list(range(n))
    assert n < 64 or seen[0] != seen[1]


def plain_targets(texts):
    """By source: size and target, with exact fractions."""
    from fractions import Fraction
    size = {}
    for _, source, text in texts:
        size[source] = size.get(source, 0) + len((text or "").encode().split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    goal, open_, total = {}, set(order), Fraction(sum(size.values()))
    while open_:
        w = sum(weight[s] for s in open_)
        full = [s for s in open_ if total * weight[s] / w > 3 * size[s]]
        if not full:
            goal |= {s: total * weight[s] / w for s in open_}
            break
        goal |= {s: Fraction(3 * size[s]) for s in full}
        total -= sum(goal[s] for s in full)
        open_ -= set(full)
    return size, goal


def check(found, texts, slack=96):
    size, goal = plain_targets(texts)
    by_id = {}
    for i, source, text in texts:
        by_id.setdefault(i, []).append((source, len((text or "").encode().split())))
    assert len(found) == len(texts)
    got = dict.fromkeys(size, 0)
    for r in found:
        source = by_id[r.doc_id][0][0]
        assert r.size in [s for _, s in by_id[r.doc_id]]
        assert r.source_size == size[source] and r.target == pytest.approx(float(goal[source]))
        assert 0 <= r.taken <= 3 * r.size
        got[source] += r.taken
    for s in size:
        assert abs(got[s] - goal[s]) <= slack


def test_query(spark, sample, sample_dir):
    from cloudtally.llm.queries import queries
    texts = [(r.doc_id, r.source, r.text) for r in sample("documents").collect()]
    first = queries()["op9_mixing"](spark, sample_dir).collect()
    check(first, texts)
    again = queries()["op9_mixing"](spark, sample_dir).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_slots_fill_shards_and_quotas(docs):
    rows = [(i, "w " * (i % 40), f"s{i % 4}") for i in range(300)]
    m = mixing.mix(docs(rows), block_words=8, shard_slots=50, bucket_docs=7)
    slots = m.slots.toPandas()
    assert len(slots) == sum(s.quota for s in m.sources)
    assert not slots.duplicated(["shard", "slot"]).any()
    assert (slots.groupby("shard").size()[:-1] == 50).all()
    for s in m.sources:
        own = slots[slots.number == s.number]
        assert len(own) == s.quota and own.block.between(0, s.blocks - 1).all()
        assert not own.duplicated(["epoch", "block"]).any()


def test_odd_rows(docs):
    rows = [(1, None, "a"), (2, "", None), (None, "x y", "a"), (3, "w " * 5000, "b"), (4, "q r s", None), (4, "q r s", None),
            (5, "é\x1cz z", "")]
    m = mixing.mix(docs(rows))
    got = mixing.taken(m).collect()
    check(got, [(i, s, t) for i, t, s in rows])
    assert mixing.taken(mixing.mix(docs([]))).count() == 0
    assert mixing.mixed(docs([]), mixing.mix(docs([]))).count() == 0
    assert mixing.taken(mixing.mix(docs([(1, None, None)]))).collect()[0].taken == 0


def test_mixed_rows_hold_the_words_taken(docs):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i % 90)) + "\n", f"s{i % 3}") for i in range(120)]
    frame = docs(rows)
    m = mixing.mix(frame, block_words=16)
    out = mixing.mixed(frame, m)
    assert out.columns == frame.columns
    words = {}
    for r in out.collect():
        assert r.n_chars == len(r.text) and r.score == 7
        own = dict(enumerate(rows[r.doc_id][1].split()))
        assert set(r.text.split()) <= set(own.values())
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {r.doc_id: r.taken for r in mixing.taken(m).collect() if r.taken}


def test_columns_named_as_the_operator_names_its_own(docs):
    frame = docs([(i, "one two three " * 50, "ab"[i % 2]) for i in range(8)])
    more = frame.selectExpr("*", "doc_id * 10 AS mark", "doc_id * 100 AS passes", "'r' AS rest", "doc_id AS number")
    got = mixing.mixed(more, mixing.mix(more, block_words=16)).collect()
    assert got and all((r.mark, r.passes, r.rest, r.number) == (10 * r.doc_id, 100 * r.doc_id, "r", r.doc_id) for r in got)


def test_slots_are_not_broadcast_however_few_their_shards(docs):
    frame = docs([(i, "w " * (i % 40), f"s{i % 4}") for i in range(300)])
    m = mixing.mix(frame, block_words=8, shard_slots=50)
    for out in (m.slots, mixing.taken(m), mixing.mixed(frame, m)):
        joins = [line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
        assert any("SortMergeJoin [number#" in j for j in joins)
        assert not any("BroadcastHashJoin [number#" in j and ("block#" in j or "part#" in j) for j in joins)
