import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from cloudtally.llm import packing
from cloudtally.llm.queries import RANKS

PATTERN = public_tokenizers.PATTERN


def brute(lengths, size):
    """Best fit by looking at every row."""
    rows, room = [], []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in range(len(rows)) if room[r] >= lengths[piece]]
        if not fits:
            rows.append([])
            room.append(size)
            fits = [len(rows) - 1]
        best = min(fits, key=lambda r: room[r])
        rows[best].append(piece)
        room[best] -= lengths[piece]
    return rows, room


@pytest.mark.parametrize("size", [1, 2, 7, 64, 100, 2048])
def test_best_fit_decreasing(size):
    pick = random.Random(size)
    for _ in range(20):
        lengths = [pick.randint(1, size) for _ in range(pick.randint(0, 200))]
        rows = packing.best_fit_decreasing(lengths, size)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        left = [size - sum(lengths[i] for i in r) for r in rows]
        assert min(left, default=0) >= 0
        assert sorted(left) == sorted(brute(lengths, size)[1])


def joined(packs):
    parts = {}
    for r in packing.unpacked(packs).collect():
        parts.setdefault(r.doc_id, []).append((r.doc_offset, bytes(r.ids)))
    return {d: b"".join(p for _, p in sorted(x)) for d, x in parts.items()}


def test_round_trip_of_the_sample(spark, sample, query):
    frame = sample("documents")
    packs = packing.pack(frame, RANKS, PATTERN, group_tokens=20_000)
    tokens = packing.encoding(RANKS, PATTERN)
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert joined(packs) == {i: np.array([*tokens.encode_ordinary(t), 50256], "<u2").tobytes() for i, t in texts.items()}
    rows = packs.collect()
    assert sum(r.n_tokens for r in rows) / (2048 * len(rows)) > 0.9
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == 2048 and (ids[r.n_tokens:] == 50256).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == len(r.doc_ids) + 1
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert (positions[a:b] == np.arange(b - a)).all()
    got = query("op5_token_packing")
    whole = packing.pack(frame, RANKS, PATTERN).collect()
    assert sorted(got.ids_sha256) == sorted(hashlib.sha256(bytes(r.ids)).hexdigest() for r in whole)
    assert got["pack"].is_unique and got.n_tokens.sum() == sum(r.n_tokens for r in rows)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (None, "null id"), (3, "twice"), (3, "twice"), (4, "<|endoftext|>"), (5, "é日本" * 3000),
            (6, "a" * 20_000)]
    packs = packing.pack(docs(rows), RANKS, PATTERN, size=256)
    got = joined(packs)
    tokens = packing.encoding(RANKS, PATTERN)
    assert set(got) == {1, 2, None, 3, 4, 5, 6} and got[1] == got[2] == np.array([50256], "<u2").tobytes()
    for i, text in ((4, "<|endoftext|>"), (5, "é日本" * 3000), (6, "a" * 20_000)):
        assert got[i] == np.array([*tokens.encode_ordinary(text), 50256], "<u2").tobytes()
    assert packing.pack(docs([]), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError, match="16-bit"):
        packing.pack(docs(rows), RANKS, PATTERN, size=1 << 17)
