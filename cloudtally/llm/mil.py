"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words. Each passage is encoded by its share of character classes
and by how its words repeat; a small network turns the encoding into a hidden vector, gated attention weighs the
passages of a document, and the weighted vector is scored. Only documents have labels: the weights are learnt from
them, on the driver, from a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_rows, held_out, labelled_sample, map_batches

#: ASCII punctuation has a class each; lower- and upper-case letters, digits, control and other bytes share one.
_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASSES = 6 + len(_PUNCTUATION)
_OTHER = 8
FEATURES = _CLASSES + _OTHER


def _classes() -> np.ndarray:
    out = np.full(256, 5, np.int64)
    out[[*range(ord("a"), ord("z") + 1)]] = 0
    out[[*range(ord("A"), ord("Z") + 1)]] = 1
    out[[*range(ord("0"), ord("9") + 1)]] = 2
    out[ord(" ")] = 3
    out[[*range(32), 127]] = 4
    out[_PUNCTUATION] = 6 + np.arange(len(_PUNCTUATION))
    return out


_CLASS = _classes()


def passages(text: str | None, words: int = 64) -> np.ndarray:
    """One row of features per passage of `words` words, and one row for a text without words."""
    parts = (text or "").encode().split()
    if not parts:
        empty = np.zeros((1, FEATURES), np.float32)
        empty[0, -1] = 1
        return empty
    n = -(-len(parts) // words)
    out = np.zeros((n, FEATURES), np.float32)
    lengths, counts = [], np.zeros((n, _CLASSES))
    joined = []
    for i in range(n):
        own = parts[i * words:(i + 1) * words]
        m = len(own)
        text_ = b" ".join(own)
        joined.append(text_)
        lengths.append(len(text_))
        distinct = len(set(own))
        out[i, _CLASSES:] = (distinct / m, sum(map(bytes.__eq__, own, own[1:])) / m, min(m / words, 1.0),
                             min(len(text_) / m, 40) / 20, sum(map(bytes.istitle, own)) / m,
                             sum(map(bytes.isupper, own)) / m, sum(map(bytes.isalpha, own)) / m, 0)
    data = np.frombuffer(b"".join(joined), np.uint8)
    at = np.repeat(np.arange(n) * _CLASSES, lengths)
    counts = np.bincount(at + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    out[:, :_CLASSES] = np.sqrt(counts / np.array(lengths)[:, None])
    return out


@dataclass
class Model:
    """Encoder (w, b), gated attention (v, u, a), and the scoring layer (c, d) of standardized features."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ p["w"] + p["b"])
        tv, su = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-np.clip(h @ p["u"], -30, 30)))
        e = (tv * su) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), n))
        alpha = e / np.repeat(np.add.reduceat(e, starts), n)
        z = np.add.reduceat(alpha[:, None] * h, starts)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"h": h, "tv": tv, "su": su, "alpha": alpha, "z": z, "s": s, "n": n}

    def gradients(self, f: dict[str, np.ndarray], x: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of documents, from what `forward` gave for the passages `x`."""
        p, starts = self.p, np.cumsum(f["n"]) - f["n"]
        ds = (f["s"] - labels) / len(labels)
        g = {"c": f["z"].T @ ds, "d": np.array([ds.sum()])}
        dz = np.repeat(np.outer(ds, p["c"]), f["n"], axis=0)
        dalpha = (dz * f["h"]).sum(1)
        mean = np.repeat(np.add.reduceat(f["alpha"] * dalpha, starts), f["n"])
        de = f["alpha"] * (dalpha - mean)
        gate = f["tv"] * f["su"]
        g["a"] = gate.T @ de
        dgate = np.outer(de, p["a"])
        dv, du = dgate * f["su"] * (1 - f["tv"] ** 2), dgate * f["tv"] * f["su"] * (1 - f["su"])
        g["v"], g["u"] = f["h"].T @ dv, f["h"].T @ du
        dh = (f["alpha"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - f["h"] ** 2)
        g["w"], g["b"] = x.T @ dh, dh.sum(0)
        return g

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        x = (np.concatenate(bags) - self.mean) / self.scale
        return self.forward(x, starts)["s"]

    def attention(self, bag: np.ndarray) -> np.ndarray:
        return self.forward((bag - self.mean) / self.scale, np.zeros(1, np.int64))["alpha"]


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 16, attention: int = 8, epochs: int = 30,
          batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model:
    """Fits by Adam on the mean log loss of documents. Without both labels, the score is their smoothed share."""
    pick = np.random.default_rng(seed)
    stacked = np.concatenate(bags) if bags else np.zeros((1, FEATURES))
    model = Model(stacked.mean(0).astype(np.float32), (stacked.std(0) + 0.02).astype(np.float32), {
        "w": pick.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, hidden)), "b": np.zeros(hidden),
        "v": pick.normal(0, 0.3, (hidden, attention)), "u": pick.normal(0, 0.3, (hidden, attention)),
        "a": pick.normal(0, 0.3, attention), "c": np.zeros(hidden), "d": np.zeros(1)})
    share = (labels.sum() + 1) / (len(labels) + 2)
    p = model.p
    p["d"][:] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return model
    scaled = [(b - model.mean) / model.scale for b in bags]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = pick.permutation(len(bags))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            x = np.concatenate([scaled[i] for i in some])
            starts = np.cumsum([0, *[len(scaled[i]) for i in some]])[:-1]
            f = model.forward(x, starts)
            g = model.gradients(f, x, labels[some])
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k in p:
                grad = g[k] + decay * p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                p[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", words: int = 64, sample_docs: int = 3000,
        most_bytes: int = 256 << 20) -> Model:
    """Learns from at most `sample_docs` labelled documents outside the held-out fold, chosen by a hash of their id.

    Of an id that repeats one text counts. Features of the documents are gathered on the driver up to `most_bytes` (184 a
    passage of `words` words); documents that no longer fit are left out whole.
    """
    some = labelled_sample(labels, label, sample_docs)
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(some), "doc_id")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            bags = [passages(t, words).astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bags, pa.binary())],
                                              ["doc_id", "label", "bag"])
        return work
    found = map_batches(texts.select("doc_id", "text", "label"), make, "doc_id long, label int, bag binary")
    rows = bounded_rows(found, ["doc_id", "label"], "bag", most_bytes)
    bags = [np.frombuffer(bytes(r.bag), np.float32).reshape(-1, FEATURES) for r in rows]
    return train(bags, np.array([r.label for r in rows], np.float64))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, words: int = 64) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row; whole texts, a null one as empty.

    Rows without an id, and all rows of an id that repeats, are scored by their texts and are not held out without an id; an
    empty table gives no rows.
    """
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([model.score([passages(t, words)])[0] for t in batch.column(1).to_pylist()], np.float64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
        return work
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", held_out().alias("held_out")), make,
                       "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, words: int = 64) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            good = [model.score([passages(t, words)])[0] >= threshold for t in batch.column(0).to_pylist()]
            return batch.filter(pa.array(good, pa.bool_()))
        return work
    kept = map_batches(packed, make, packed.schema)
    return kept.select(*["text" if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
