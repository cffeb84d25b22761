"""Toxicity by non-negative positive-unlabelled learning.

Known are documents confirmed toxic and documents nobody judged. With the share of toxic documents as class prior, the
risk over clean ones follows from the unlabelled ones less what the toxic ones account for; where flexible models
push that difference below zero, the step goes the other way instead. Several linear classifiers over hashed words and
word starts are trained on the driver, each against its own part of the unlabelled sample, and averaged.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.llm.common import bounded_rows, held_out, labelled_sample, map_batches

_STRENGTH = 5
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def hashed(chunk: str, starts: tuple[int, ...] = (4, 6)) -> tuple[int, ...]:
    """The features of one lower-cased word: itself, and its first letters where it is as long."""
    word = chunk.strip(_EDGES)
    if not word:
        return ()
    return (zlib.crc32(word.encode()), *(zlib.crc32(word[:n].encode(), n) for n in starts if len(word) >= n))


class _Words(dict):
    """Of a word between white space: its features, looked up once; cleared when full, long words not kept."""

    def __init__(self, of, most: int = 200_000, longest: int = 64):
        super().__init__()
        self.of, self.most, self.longest = of, most, longest

    def __missing__(self, chunk: str):
        found = self.of(chunk)
        if len(chunk) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = found
        return found


def features(text: str | None, words: dict | None = None) -> set[int]:
    """The distinct features of a whole text."""
    look = hashed if words is None else words.__getitem__
    return set().union(*map(look, set((text or "").lower().split())))


@dataclass
class Model:
    """Feature hashes in order, their weights and bias; a score of one half divides the classes."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> dict[int, float]:
        return dict(zip(self.hashes.tolist(), self.weights.tolist(), strict=True))

    def scorer(self):
        table, bias = self.table(), self.bias

        def own(chunk: str) -> tuple[tuple[int, float], ...]:
            return tuple((h, table[h]) for h in hashed(chunk) if h in table)
        words = _Words(own)

        def score(text: str | None) -> float:
            # Sorted, so that the sum does not depend on the order of a set.
            found = sorted(set().union(*map(words.__getitem__, set((text or "").lower().split()))))
            return float(1 / (1 + np.exp(-np.clip(bias + sum(w for _, w in found), -30, 30))))
        return score


def _chosen(positive: list[np.ndarray], unlabelled: list[np.ndarray], most: int, least: int) -> np.ndarray:
    """The features that toxic documents have most above their share of the unlabelled, by `_STRENGTH` standard errors.

    Features of clean text are left out: a long text has so many that they would drown what little is toxic in it.
    """
    p, pn = np.unique(np.concatenate([np.zeros(0, np.int64), *positive]), return_counts=True)
    u, un = np.unique(np.concatenate([np.zeros(0, np.int64), *unlabelled]), return_counts=True)
    every = np.union1d(p[pn >= least], u[un >= least])
    count = np.zeros((2, len(every)))
    for row, (keys, n) in enumerate(((p, pn), (u, un))):
        at = np.searchsorted(every, keys)
        ok = (at < len(every)) & (every[np.minimum(at, len(every) - 1)] == keys) if len(every) else np.zeros(0, bool)
        count[row, at[ok]] = n[ok]
    a, b = count[0] / max(1, len(positive)), count[1] / max(1, len(unlabelled))
    pooled = (count.sum(0) + 1) / (len(positive) + len(unlabelled) + 2)
    z = (a - b) / np.sqrt(pooled * (1 - pooled) * (1 / max(1, len(positive)) + 1 / max(1, len(unlabelled))) + 1e-12)
    order = np.lexsort((every, -z))[:most]
    return np.sort(every[order[z[order] >= _STRENGTH]])


def _indexed(docs: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of all documents one after another, and where each begins."""
    parts = []
    for d in docs:
        at = np.searchsorted(chosen, d)
        parts.append(at[(at < len(chosen)) & (chosen[np.minimum(at, len(chosen) - 1)] == d)] if len(chosen) else at[:0])
    return np.concatenate([np.zeros(0, np.int64), *parts]), np.cumsum([0, *map(len, parts)])


def _outputs(columns: np.ndarray, starts: np.ndarray, w: np.ndarray, bias: float) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(w[columns])])
    return sums[starts[1:]] - sums[starts[:-1]] + bias


def _gradients(positive: tuple, unlabelled: tuple, w: np.ndarray, bias: float, prior: float) -> tuple:
    """The risk over clean documents, the direction that raises it, and the gradient of the whole risk (weights, then bias).

    Both sets are (columns, where each document begins). The sigmoid loss of a wrong sign: l(+) = 1 - s, l(-) = s.
    """
    def own(columns, starts):
        s = 1 / (1 + np.exp(-np.clip(_outputs(columns, starts, w, bias), -30, 30)))
        each = s * (1 - s) / len(s)
        return s.mean(), np.append(np.bincount(columns, np.repeat(each, np.diff(starts)), len(w)), each.sum())
    (sp, gp), (su, gu) = own(*positive), own(*unlabelled)
    minus = gu - prior * gp
    return su - prior * sp, -minus, minus - prior * gp


def nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int, epochs: int = 300,
         rate: float = 0.03, decay: float = 1e-4, beta: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias that minimize the non-negative risk under the sigmoid loss, by Adam over whole sets.

    Documents are arrays of columns below `size`. The risk is prior * E+[l(+)] + max(0, Eu[l(-)] - prior * E+[l(-)]);
    while the second part is below -beta, its ascent replaces the descent.
    """
    p, ps = np.concatenate([np.zeros(0, np.int64), *positive]), np.cumsum([0, *map(len, positive)])
    u, us = np.concatenate([np.zeros(0, np.int64), *unlabelled]), np.cumsum([0, *map(len, unlabelled)])
    w, bias = np.zeros(size + 1), np.zeros(1)
    first, second = np.zeros(size + 1), np.zeros(size + 1)

    bias[0] = np.log(prior / (1 - prior))
    for step in range(1, epochs + 1):
        clean, ascent, grad = _gradients((p, ps), (u, us), w[:size], bias[0], prior)
        grad = ascent if clean < -beta else grad
        grad[:size] += decay * w[:size]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        w[:size] -= move[:size]
        bias[0] -= move[size]
    return w[:size], float(bias[0])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most: int = 4096, least: int = 5,
          classifiers: int = 3, seed: int = 3, **options) -> Model:
    """The mean of classifiers that share the positives; documents are arrays of distinct feature hashes.

    Without positives or unlabelled documents the score is the prior.
    """
    prior = min(max(prior, 1e-3), 0.5)
    flat = float(np.log(prior / (1 - prior)))
    if not positive or len(unlabelled) < classifiers:
        return Model(np.zeros(0, np.int64), np.zeros(0), flat)
    chosen = _chosen(positive, unlabelled, most, least)

    def cut_up(docs):
        columns, starts = _indexed(docs, chosen)
        return [columns[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
    p, u = cut_up(positive), cut_up(unlabelled)
    order = np.random.default_rng(seed).permutation(len(u))
    fits = [nnpu(p, [u[i] for i in order[k::classifiers]], prior, len(chosen), **options) for k in range(classifiers)]
    w, bias = np.mean([w for w, _ in fits], 0), float(np.mean([b for _, b in fits]))

    def outputs(docs):
        return _outputs(np.concatenate([np.zeros(0, np.int64), *docs]), np.cumsum([0, *map(len, docs)]), w, bias)
    return Model(chosen, w, bias - _boundary(outputs(p), outputs(u), prior))


def _boundary(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The output that divides the classes best: the non-negative risk again, under the loss of one per error.

    Of outputs in between which the risk does not change by a tenth of the prior, the middle of the widest gap.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    values = np.unique(np.concatenate([p, u]))
    if len(values) < 2:
        return 0.0
    middles = (values[1:] + values[:-1]) / 2
    found = 1 - np.searchsorted(p, middles) / len(p)
    share = 1 - np.searchsorted(u, middles) / len(u)
    risk = prior * (1 - found) + np.maximum(0, share - prior * found)
    good = np.flatnonzero(risk <= risk.min() + 0.1 * prior)
    return float(middles[good[np.argmax((values[1:] - values[:-1])[good])]])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = 3000, unlabelled: int = 6000,
        prior: float | None = None, most_bytes: int = 256 << 20) -> Model:
    """Learns from at most `positives` confirmed documents and `unlabelled` others, both outside the held-out fold.

    The unlabelled are drawn from all documents by a hash of their id, whatever their labels. The class prior is the
    share of confirmed ones among all labelled documents outside that fold, unless it is given. Of an id that repeats one
    text counts. Features are gathered on the driver up to `most_bytes` (4 each); documents that no longer fit are left
    out whole.
    """
    known = labels.filter(F.col(label).isNotNull() & ~held_out())
    if prior is None:
        prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    toxic = labelled_sample(labels.filter(F.col(label) == 1), label, positives).select("doc_id", F.lit(1).alias("toxic"))
    drawn = (docs.select(F.col("doc_id").cast("long").alias("doc_id"))
             .filter(F.col("doc_id").isNotNull() & ~held_out())
             .orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(unlabelled).distinct().select("doc_id", F.lit(0).alias("toxic")))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(toxic.union(drawn)), "doc_id")

    def make():
        words = _Words(hashed)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.array(sorted(features(t, words)), "<u4").tobytes() for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())],
                                              ["doc_id", "toxic", "found"])
        return work
    found = map_batches(texts.select("doc_id", "text", "toxic"), make, "doc_id long, toxic int, found binary")
    rows = bounded_rows(found, ["doc_id", "toxic"], "found", most_bytes)
    sets = {kind: [np.frombuffer(bytes(r.found), "<u4").astype(np.int64) for r in rows if r.toxic == kind] for kind in (0, 1)}
    return train(sets[1], sets[0], prior)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row; whole texts, a null one as empty.

    Rows without an id, and all rows of an id that repeats, are scored by their texts and are not held out without an id; an
    empty table gives no rows.
    """
    def make():
        one = model.scorer()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array(list(map(one, batch.column(1).to_pylist())), np.float64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
        return work
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", held_out().alias("held_out")), make,
                       "doc_id long, held_out boolean, score double, predicted int")
