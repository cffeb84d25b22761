import numpy as np
import pytest

import corpus_pipeline
from cloudtally.llm import bpe, mil, mixing, pii, simhash
from cloudtally.llm.common import scratch
from cloudtally.llm.queries import VOCABULARY
from tests.llm.test_simhash import plain, smallest


@pytest.fixture(scope="module")
def stages(spark, sample_dir):
    """What each stage was given and returned, as lists of rows."""
    docs, seen = spark.read.parquet(f"{sample_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, "test")
        stage(spark, docs, sample_dir).write.parquet(path)
        out = spark.read.parquet(path)
        seen.append((name, docs, out))
        docs = out
    return {name: (before, after) for name, before, after in seen}


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(after.columns == COLUMNS for name, (_, after) in stages.items() if name != "encode")


def test_quality_keeps_what_scores_well(spark, sample_dir, stages):
    before, after = stages["quality"]
    model = mil.fit(before, spark.read.parquet(f"{sample_dir}/labels.parquet"))
    good = [tuple(r) for r in before.collect() if model.score([mil.passages(r.text)])[0] >= 0.3]
    assert sorted(tuple(r) for r in after.collect()) == sorted(good)
    assert 0 < len(good) < before.count()


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    texts = {r.doc_id: r.text for r in before.collect()}
    prints = {i: plain(t) for i, t in texts.items()}
    linked = [(a, b) for a in texts for b in texts if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(smallest(texts, linked).values()))


def test_redaction_leaves_no_base_match(stages):
    before, after = stages["redact"]
    model = pii.fit(before)
    found = {r.doc_id: r.spans for r in pii.spans(before, model).collect()}
    old = {r.doc_id: r.text for r in before.collect()}
    new = {r.doc_id: r for r in after.collect()}
    assert set(new) == set(old)
    for i, text in old.items():
        at, parts = 0, []
        for s in found[i]:
            if s.start >= at:
                parts += [text[at:s.start], f"[{pii.KINDS[s.kind]}]"]
            at = max(at, s.end)
        assert new[i].text == "".join(parts) + text[at:] and new[i].n_chars == len(new[i].text)


def test_mix_takes_the_words_of_its_targets(stages):
    before, after = stages["mix"]
    m = mixing.mix(before, block_words=512)
    taken = {r.doc_id: r.taken for r in mixing.taken(m).collect() if r.taken}
    words = {}
    for r in after.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == taken


def test_encoding_of_the_mix(stages):
    before, after = stages["encode"]
    t = bpe.tokenizer(VOCABULARY)
    want = sorted((r.doc_id, t.encode(r.text)) for r in before.collect())
    assert sorted((r.doc_id, bytes(r.ids)) for r in after.collect()) == want
    assert sum(len(i) for _, i in want) == 4 * sum(len(np.frombuffer(i, "<u4")) for _, i in want)


def test_stages_take_odd_and_empty_tables(spark, docs, sample_dir):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "x@y.zz " * 50), (3, "x@y.zz " * 50), (4, "w " * 20_000)]
    frame = docs(rows)
    assert mil.keep_good(frame, mil.train([], np.zeros(0))).count() == len(rows)
    assert simhash.keep_one(frame).columns == frame.columns
    assert corpus_pipeline.redact(spark, frame, sample_dir).count() == len(rows)
    assert corpus_pipeline.mix(spark, frame, sample_dir).columns == frame.columns
    assert corpus_pipeline.encode(spark, frame, sample_dir).count() == len(rows)
    none = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sample_dir).count() == 0


def test_stages_keep_columns_with_odd_names(spark, docs, sample_dir):
    frame = docs([(1, "some words here, and more of them"), (2, "x@y.zz")]).withColumnsRenamed(
        {"score": "a.b", "component_id": "mark"}).selectExpr("*", "1 AS passes", "2 AS row", "3 AS rest")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, sample_dir).columns == frame.columns, name
