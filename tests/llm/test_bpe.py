import hashlib
import itertools
import json
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

import corpus_pipeline
from cloudtally.llm import bpe
from cloudtally.llm.queries import VOCABULARY

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Library.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = bpe.tokenizer(PATH).encode(text)
    return np.frombuffer(got, "<u4").tolist() == ids and bpe.tokenizer(PATH).decode(got).decode() == library.decode(
        ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " \n", "Hello, WORLD's 123!!", "lollollol" * 300, "aab" * 500, "é" * 999, "ΑΣ ΑΣΑ Σ", "İstanbul ß ﬁ", "é",
    "a\x1cb\x85c d", "<|endoftext|>", "x<|startoftext|><|endoftext|> y<|end", "日本語テキスト", "😀😀", "'s''S'll",
    "a" * 5000])
def test_as_the_library(library, text):
    assert same(library, text)


def test_random_texts(library):
    pick = random.Random(3)
    letters = [*"abcdehilnorst'ABS.,!  \n\t<|>", *"éßİΣσςÀ́日", "<|endoftext|>", "ing", "the", "\x1c", "\x85", "😀"]
    for _ in range(4000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 30)))
        assert same(library, text), text


def test_full_chunk_table_is_cleared(library):
    small = bpe.Tokenizer(PATH, cache_bytes=512 * 400)
    text = "one two three four five one two " * 3 + " ".join(f"w{i}" for i in range(1999)) + " " + "long" * 99
    assert np.frombuffer(small.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert 0 < small._chunks.held <= 256 * 400 and small._chunks.older and "long" * 99 not in small._chunks


def merged(word, merges):
    """Tokens of a word by the rule itself: each merge in order, from left to right."""
    parts = list(word)
    for a, b in merges:
        out = []
        for p in parts:
            if out and out[-1] == a and p == b:
                out[-1] = a + b
            else:
                out.append(p)
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(8))
def test_transitions_accept_what_the_merges_make(seed):
    pick = random.Random(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 12:
        a, b = pick.choice(tokens), pick.choice(tokens)
        # Only merges that can happen: nothing earlier takes their parts apart.
        if a + b not in tokens and len(a + b) < 7 and merged(a + b, merges) == [a, b]:
            tokens.append(a + b)
            merges.append((a, b))
    vocab = {t: 3 * i for i, t in enumerate(tokens)}
    state, arcs, n = bpe.transitions(vocab, merges, "")
    row, bit, table = bpe.minimal(state, arcs, n)

    def arc(u, t):
        whole = arcs[vocab[t], state[vocab[u]] >> 3] >> (state[vocab[u]] & 7) & 1
        assert whole == table[row[vocab[u]], bit[vocab[t]] >> 3] >> (bit[vocab[t]] & 7) & 1
        return bool(whole)
    assert n == len(tokens)
    for u, t in itertools.product(tokens, tokens):
        assert arc(u, t) == (merged(u + t, merges) == [u, t]), (merges, u, t)
    for length in range(1, 8):
        for word in map("".join, itertools.product("abc", repeat=length)):
            parts = merged(word, merges)
            assert all(map(arc, parts, parts[1:]))


def test_the_compiled_table(library):
    c = bpe.compiled(PATH)
    assert c.states > 10_000 and c.arcs > 10 ** 8 and len(c.arcs_of) < c.unmerged / 4
    a = bpe.tokenizer(PATH).automaton
    pick = random.Random(2)
    # The library puts texts into lower case first.
    plain = [(t, i) for t, i in json.loads(c.tokens).items() if re.fullmatch("[a-z]+(</w>)?", t)]
    for _ in range(3000):
        (u, i), (t, k) = pick.choice(plain), pick.choice(plain)
        if not u.endswith("</w>") and t.endswith("</w>"):
            ids = library.encode(u + t[:-4], add_special_tokens=False).ids
            assert a.arc(i, k) == (ids == [i, k]), (u, t)


def test_query(query, sample, library):
    texts = {r.doc_id: r.text for r in sample("documents").collect()}
    found = query("op8_bpe_encode_decode").set_index("doc_id")
    assert len(found) == len(texts)
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        row = found.loc[i]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (None, "the cat"), (3, "the cat"), (3, "the cat")]
    encoded = bpe.encode(docs(rows), PATH)
    got = [(r.doc_id, len(r.ids) // 4) for r in encoded.collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (None, 2), (3, 2), (3, 2)], key=str)
    assert {r.text for r in bpe.decode(encoded, PATH).collect()} == {"", "the</w> cat</w>"}
    assert bpe.round_trip(docs([]), PATH).count() == 0


def test_pipeline_stage_decodes_what_it_encodes(spark, docs, sample_dir):
    texts = [None, "", "Hello  World", "two words, and more", "é ß x@y.zz"]
    got = corpus_pipeline.encode(spark, docs(list(enumerate(texts))), sample_dir).collect()
    t = bpe.tokenizer(VOCABULARY)
    assert {r.doc_id: (bytes(r.ids), r.decoded) for r in got} == {
        i: (t.encode(x), t.decode(t.encode(x)).decode()) for i, x in enumerate(texts)}
    assert got and {r.doc_id: r.decoded for r in got}[0] == ""
