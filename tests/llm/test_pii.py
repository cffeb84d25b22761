import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cloudtally.llm import pii
from cloudtally.llm.queries import queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    found = []
    for number, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), sample_docs=600)


def test_query(spark, sample, sample_dir):
    texts = {r.doc_id: r.text for r in sample("documents").collect()}
    got = queries()["op6_pii_boosted_candidates"](spark, sample_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert set(filter(None, listed(base).split(","))) <= set(r.spans.split(","))


def test_base_spans_of_random_texts(docs, model):
    pick = random.Random(6)
    parts = ["1", "23", "4539578763621486", "192.168", ".", ".", "@", "a", "bc", "+", "+1", "(", ")", " ", "-", "x@y.zz",
             "4111 1111 1111 1111", "255", "256", "é", "😀", "\n", "%", "_", "007"]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randint(0, 25)))) for i in range(1500)]
    for r in pii.spans(docs(rows), model).collect():
        text = rows[r.doc_id][1]
        assert [tuple(s) for s in r.base] == plain(text), text
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}
        assert r.spans == sorted(r.spans)


LONG = ["1" * 60_000, "1 " * 30_000, "a" * 60_000, "1." * 30_000, "+1" + "(" * 60_000, "a@" * 30_000, "é" * 60_000 + " x@y.zz",
        "+1 " * 30_000, "1.2.3.4 " * 300, "(at)" * 15_000]


def test_long_and_odd_texts(docs, model):
    rows = list(enumerate([*LONG, None, "", "x@y.zz"])) + [(None, "x@y.zz"), (12, "x@y.zz")]
    got = pii.spans(docs(rows), model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert [tuple(s) for s in r.base] == plain(rows[r.doc_id][1])
    assert pii.spans(docs([]), model).count() == 0
    assert pii.redacted(docs([]), model).count() == 0


def test_adds_spans_that_run_into_each_other(docs, model):
    text = "call +1 (269) 555-3296 4524132264652876 now"
    assert plain(text) == []
    got = pii.spans(docs([(1, text)]), model).collect()[0]
    assert {text[s["start"]:s["end"]] for s in got.spans} == {"+1 (269) 555-3296", "4524132264652876"}


def test_redaction(docs, model):
    rows = [(1, "mail x@y.zz or é 1.2.3.4!"), (2, None), (3, "none"), (4, "+49 30 1234 5678.")]
    frame = docs(rows)
    out = {r.doc_id: r for r in pii.redacted(frame, model).collect()}
    assert [out[i].text for i in (1, 2, 3, 4)] == ["mail [email] or é [ip]!", "", "none", "[phone]."]
    assert out[1].n_chars == len(out[1].text) and pii.redacted(frame, model).columns == frame.columns


def test_one_class_adds_nothing(docs):
    frame = docs([(1, "call 555-123-4567"), (2, "nothing")])
    model = pii.fit(frame)
    assert model.trees == [] and pii.spans(frame, model).agg(F.sum(F.size("spans"))).first()[0] == 0
    assert pii.fit(docs([])).trees == []


def test_a_rare_kind_has_its_threshold(docs):
    """Two documents of several hundred have a phone number; one that runs into another number is found all the same."""
    pick = random.Random(9)

    def card():
        body = f"4{pick.randrange(10 ** 14):014d}"
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    rows = [(i, f"card {card()} and bad 4539578763621487 of {pick.randrange(10 ** 6)}") for i in range(400)]
    rows += [(1000, "call +1 (269) 555-3296 now"), (1001, "phone +1 (412) 555-1188, please"), (1002, "version +1 2.0 of 3")]
    model = pii.fit(docs(rows), sample_docs=40)
    phone = pii.KINDS.index("phone")
    assert model.thresholds[phone] <= 1
    text = "call +1 (269) 555-3296 4524132264652876 now"
    got = pii.spans(docs([(1, text)]), model).collect()[0]
    assert plain(text) == [] and any(s.kind == phone and text[s["start"]:s["end"]].startswith("+1 (269) 555-3296") for s in got.spans)


def test_every_document_is_learnt_from(spark, docs, monkeypatch):
    """Documents beyond any sample are among what the trees fit; alike candidates weigh as many as they are."""
    pick = random.Random(3)

    def card(n):
        body = f"4{pick.randrange(10 ** (n - 2)):0{n - 2}d}"
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    rows = [(i, f"card {card(16 if i % 3 else 13)}") for i in range(1300)]
    seen, fit = [], pii.GBTClassifier.fit

    def spy(self, frame):
        weight = F.col("n") if "n" in frame.columns else F.lit(1)
        seen.append(frame.agg(F.sum(F.col("label") * weight)).first()[0])
        return fit(self, frame)
    monkeypatch.setattr(pii.GBTClassifier, "fit", spy)
    pii.fit(docs(rows))
    assert seen == [spark.range(1300).filter(F.pmod(F.xxhash64("id"), F.lit(5)) != 0).count()]


def test_examples_are_counted(docs):
    rows = [(1, "card 4539578763621486 x")] * 3 + [(2, "card 4539578763621486 y"), (None, "mail x@y.zz, 1.2.3.4"), (None, "1.2.3.400"),
                                                  (3, None), (4, "+49 30 1234 5678 or 4539578763621487")]
    got = {(r.kind, r.label): r.n for r in pii._examples(docs(rows).select("doc_id", "text")).groupBy("kind", "label").agg(
        F.sum("n").alias("n")).collect()}
    sound = [s for _, t in rows for s in plain(t)]
    assert all(got.get((k, 1.0), 0) == sum(s[1] == k for s in sound) for k in range(4))
    # A failed match each, and damaged copies.
    assert got[(2, 0.0)] >= 9 and got[(1, 0.0)] >= 2
