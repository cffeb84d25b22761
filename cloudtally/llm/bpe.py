"""Byte-pair encoding by a compiled tokenization automaton, for vocabularies whose tokens mark word ends.

The automaton reads tokens, not characters, and accepts exactly the token sequences that applying the merges in order
produces. It starts as one state with a loop for each base symbol. The merge (a, b) -> ab adds one gadget: where an
arc a leads to a state p that has an arc b, every a-arc is led to a copy of p without its b-arc, and an ab-arc is
added beside each a-arc, to where b led. All arcs of one token thus lead to one state, so states are numbered by the
token last read; a state that follows the end of a word has no arcs and is not stored. The transition table is a bit
per state and token, set where the arc is; a gadget is one column copied (the state after ab from that after b), one bit
cleared (a, then b) and one row copied (the arcs ab from the arcs a). When all merges are in, states with the same arcs
are merged, and tokens that leave the same states. The driver compiles the table and broadcasts it: its size is that of
the vocabulary, whatever the data.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from cloudtally.llm.common import map_batches

#: Stands for the end of a word inside the automaton; no byte has this number.
_END = chr(256)
#: White space to str.split() that the pattern's \s leaves in words.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[str, str]:
    """The letter by which byte-level vocabularies write each byte -> that byte as a character."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + k): chr(b) for k, b in enumerate(rest)}


class Compiled(NamedTuple):
    """A vocabulary and its automaton, as it is shipped to tasks: few large values, as workers keep them."""

    #: Token -> id, as JSON.
    tokens: str
    special: dict[str, int]
    pattern: str
    suffix: str
    #: Token -> row of the table, -1 after the end of a word; token -> bit of a row; the rows, and bytes of one.
    state: np.ndarray
    bit: np.ndarray
    arcs_of: bytes
    width: int
    #: States, arcs and bytes before equal ones were merged.
    states: int
    arcs: int
    unmerged: int


def transitions(vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> tuple[np.ndarray, np.ndarray, int]:
    """State of each token (-1: none), and for each token id a row of bits, one per state that has the token as an arc."""
    made = {a + b for a, b in merges}
    if len(made) < len(merges):
        raise ValueError("a token is made by two merges")
    top = max(vocab.values(), default=-1) + 1
    state, n = np.full(top, -1), 0
    for token, i in vocab.items():
        if not (suffix and token.endswith(suffix)):
            state[i], n = n, n + 1
    # Rows in order of birth, so that the tokens there are so far are the first rows.
    born = [i for t, i in vocab.items() if t not in made] + [vocab[a + b] for a, b in merges]
    row = np.full(top, -1)
    row[born] = np.arange(len(born))
    arcs = np.zeros((len(born), (n + 7) // 8), np.uint8)
    k = len(born) - len(merges)
    some = [state[i] for i in born[:k] if state[i] >= 0]
    loops = np.zeros(arcs.shape[1] * 8, np.uint8)
    loops[some] = 1
    arcs[:k] = np.packbits(loops, bitorder="little")
    for a, b in merges:
        left, right, new = vocab[a], vocab[b], vocab[a + b]
        if state[left] < 0:
            raise ValueError(f"{a!r} ends a word and is merged with what follows")
        if state[new] >= 0:
            source, target = state[right], state[new]
            copied = (arcs[:k, source >> 3] >> np.uint8(source & 7)) & np.uint8(1)
            arcs[:k, target >> 3] |= copied << np.uint8(target & 7)
        arcs[row[right], state[left] >> 3] &= np.uint8(255 ^ (1 << (state[left] & 7)))
        arcs[k] = arcs[row[left]]
        k += 1
    out = np.zeros((top, arcs.shape[1]), np.uint8)
    out[born] = arcs
    return state, out, n


def minimal(state: np.ndarray, arcs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each token's state, bit of each token, and the table, with equal states and equal columns merged."""
    if not n:
        return state, np.zeros(len(arcs), np.int64), np.zeros((0, 1), np.uint8)
    _, first, bit = np.unique(arcs.view(f"V{arcs.shape[1]}").ravel(), return_index=True, return_inverse=True)
    table = np.zeros((n, (len(first) + 7) // 8), np.uint8)
    for low in range(0, len(first), 1024):
        part = np.unpackbits(arcs[first[low:low + 1024]], axis=1, bitorder="little")[:, :n]
        packed = np.packbits(part.T, axis=1, bitorder="little")
        table[:, low // 8:low // 8 + packed.shape[1]] = packed
    _, first, merged = np.unique(table.view(f"V{table.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return np.where(state >= 0, merged[np.maximum(state, 0)], -1), bit, table[first]


@lru_cache(maxsize=2)
def compiled(path: str) -> Compiled:
    """The automaton of a tokenizer file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    plain = {t: i for t, i in vocab.items() if t not in special}
    state, arcs, n = transitions(plain, merges, suffix)
    count = sum(int(np.bitwise_count(arcs[k:k + 4096]).sum()) for k in range(0, len(arcs), 4096))
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    row, bit, table = minimal(state, arcs, n)
    return Compiled(json.dumps(plain), special, split["pattern"]["Regex"], suffix, row, bit, table.tobytes(), table.shape[1], n,
                    count, arcs.nbytes)


class Automaton:
    """Reads words by the transition table."""

    def __init__(self, c: Compiled, vocab: dict[str, int]):
        letters = _byte_letters()

        def own(token: str) -> str:
            end = bool(c.suffix) and token.endswith(c.suffix)
            return "".join(letters[x] for x in (token[:-len(c.suffix)] if end else token)) + _END * end
        ids = {own(t): i for t, i in vocab.items()}
        self.length = {i: len(t) for t, i in ids.items()}
        #: Finds all tokens that end at each place of a word.
        self.tokens = ahocorasick.Automaton()
        for t, i in ids.items():
            self.tokens.add_word(t, i)
        self.tokens.make_automaton()
        self.table = c.arcs_of
        #: Token -> where the arcs of the state after it begin in the table, -1 after the end of a word.
        self.begin = [s * c.width if s >= 0 else -1 for s in c.state.tolist()]
        self.octet, self.shift = (c.bit >> 3).tolist(), (c.bit & 7).tolist()

    def arc(self, u: int, t: int) -> bool:
        """Whether token t leaves the state after token u."""
        return self.begin[u] >= 0 and bool(self.table[self.begin[u] + self.octet[t]] >> self.shift[t] & 1)

    def read(self, word: str) -> list[int]:
        """The accepted path whose labels spell the word (bytes as characters, the end mark last).

        Each prefix of a word is spelt by one accepted path, so one pass is enough: of the tokens that end at a place, the one
        whose arc leaves the state reached where it begins.
        """
        length, table, begin, octet, shift = self.length, self.table, self.begin, self.octet, self.shift
        last = [-1] * (len(word) + 1)
        for end, token in self.tokens.iter(word):
            if last[end + 1] < 0:
                start = end + 1 - length[token]
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    state = begin[before]
                    if state < 0 or not table[state + octet[token]] >> shift[token] & 1:
                        continue
                last[end + 1] = token
        path, at = [], len(word)
        while at:
            token = last[at]
            if token < 0:
                raise ValueError(f"no path spells {word!r}")
            path.append(token)
            at -= length[token]
        path.reverse()
        return path


class _Chunks(dict):
    """Ids of chunks between white space, as bytes, in at most `most` bytes.

    When half of them are full, they become the older half, of which chunks that are asked for again come back; what was in the
    older half before is dropped. Long chunks are not kept.
    """

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.held, self.older = encode, most // 2, 0, {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = self.encode(chunk)
        # Characters, ids, and the objects around them.
        size = (len(chunk) if chunk.isascii() else 4 * len(chunk)) + len(found) + 200
        if size <= self.most >> 8:
            if self.held + size > self.most:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self.held += size
            self[chunk] = found
        return found


    def close(self) -> None:
        self.clear()
        self.held, self.older = 0, {}


class Tokenizer:
    """Encodes and decodes as the tokenizers library does with such a file, without truncation or padding."""

    def __init__(self, of: str | Compiled, cache_bytes: int = 32 << 20):
        c = compiled(of) if isinstance(of, str) else of
        vocab = json.loads(c.tokens)
        self.automaton = Automaton(c, vocab)
        self._special = c.special
        self._specials = re.compile("|".join(map(re.escape, sorted(c.special, key=len, reverse=True)))) if c.special else None
        self._words = regex.compile(c.pattern)
        self.labels = {i: t.encode() for t, i in (*vocab.items(), *c.special.items())}
        self._chunks = _Chunks(self._chunk, cache_bytes)

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for word in [chunk] if chunk.isalpha() else self._words.findall(chunk):
            ids += self.automaton.read(word.encode().decode("latin-1") + _END)
        return _packed(ids)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if _SEPARATORS.search(text):
            return self._chunk(text)
        return b"".join(map(self._chunks.__getitem__, text.split()))

    def close(self) -> None:
        """Drops the chunks kept so far."""
        self._chunks.close()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text is empty."""
        text = text or ""
        if self._specials is None or "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self._specials.finditer(text):
            out += [self._plain(text[at:m.start()]), _packed([self._special[m.group()]])]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> bytes:
        """The labels of the arcs that the ids name, in UTF-8 with a space between two."""
        return b" ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


_shipped: dict[tuple[str, str], Broadcast] = {}
_own: dict[int, Tokenizer] = {}


def _shared(spark: SparkSession, path: str) -> Broadcast:
    """The compiled vocabulary, sent once per application; only the driver needs the file."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _shipped:
        _shipped[key] = spark.sparkContext.broadcast(compiled(path))
    return _shipped[key]


def _of(shared: Broadcast) -> Tokenizer:
    """One per Python worker; tasks that share the worker share its tables."""
    number = shared._jbroadcast.id() if shared._jbroadcast is not None else id(shared.value)
    if number not in _own:
        _own.clear()
        _own[number] = Tokenizer(shared.value)
    return _own[number]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The rows with `ids` (binary, little-endian unsigned 32-bit). Null and empty texts have no ids.

    Only `doc_id` and `text` are read; rows that repeat give the same ids. `path` is read on the driver alone.
    """
    shared = _shared(docs.sparkSession, path)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = list(map(_of(shared).encode, batch.column(1).to_pylist()))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        work.close = lambda: _of(shared).close()
        return work
    return map_batches(docs.select("doc_id", "text"), make, f"doc_id {_kind(docs)}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `text`: what the ids of each row say."""
    shared = _shared(encoded.sparkSession, path)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [_of(shared).decode(i or b"").decode() for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
        work.close = lambda: _of(shared).close()
        return work
    return map_batches(encoded.select("doc_id", "ids"), make, f"doc_id {_kind(encoded)}, text string")


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` as `encode` gives them, and `decoded`: what those ids say, as `decode` gives it."""
    shared = _shared(docs.sparkSession, path)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            t = _of(shared)
            ids = list(map(t.encode, batch.column(1).to_pylist()))
            texts = [t.decode(i).decode() for i in ids]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                                              ["doc_id", "ids", "decoded"])
        work.close = lambda: _of(shared).close()
        return work
    return map_batches(docs.select("doc_id", "text"), make, f"doc_id {_kind(docs)}, ids binary, decoded string", rows=256)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `n_tokens`, and SHA-256 of the ids and of the decoded text, without moving either to the JVM.

    Null and empty texts have no tokens and the hashes of nothing; every row gives one row, whatever its id; an empty
    table gives none.
    """
    shared = _shared(docs.sparkSession, path)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            t, texts = _of(shared), batch.column(1).to_pylist()
            counts, id_hash, text_hash = [], [], []
            for text in texts:
                ids = t.encode(text)
                counts.append(len(ids) // 4)
                id_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(t.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()),
                 pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        work.close = lambda: _of(shared).close()
        return work
    return map_batches(docs.select("doc_id", "text"), make,
                       f"doc_id {_kind(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _kind(df: DataFrame) -> str:
    return dict(df.dtypes)["doc_id"]
