"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task reads its share of the corpus block by block. A block's texts are split by
the tokenizer's pattern and become rows of word numbers, so a word that occurs a
million times is encoded once. The distinct words lie in one byte array; an
inverted index from the rank of a token pair to the positions where it stands is
replayed in rank order. Merging a position touches its two neighbours only: their
pairs get new ranks and join the index. Words never interact, and the lowest rank
present anywhere is the lowest of every word that holds it, so the replay gives
each word the merges it would get alone. All places of a rank are merged at once, of
places that overlap every other one from the left. Where that would bring up a pair of
lower rank between two of them, the word is taken out and merged alone, from a heap of
(rank, place). Either way a word of n bytes takes about n log n steps.

The index covers the distinct words of a block (bounded by ``BLOCK_CHARS``), not of
the whole input, so memory is bounded, nothing is shuffled or broadcast, and a lost
task is simply read again. Words of earlier blocks of a task are kept in a bounded
cache. The vocabulary file is named by a path and read by each Python worker.

Defined results: a null text is read as empty and gives no ids; equal rows give
equal rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import shipped, some_rows

BLOCK_CHARS = 8_000_000
CACHE_WORDS = 200_000
NONE = np.int64(1 << 40)
# A character that stands for its class where the two pattern engines know other Unicode versions.
STAND_INS = ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", "\u2003"))
OTHER = "\ue000"


def class_differences() -> dict[int, str]:
    """Code points that the tokenizer library's pattern engine puts in another class, with a stand-in of that class."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    ours, theirs = {}, {}
    for pattern, stand_in in STAND_INS:
        engine = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        theirs.update(dict.fromkeys(bytes(engine.encode_ordinary(every)).decode(), stand_in))
        ours.update(dict.fromkeys(regex.findall(pattern, every), stand_in))
    return {ord(c): theirs.get(c, OTHER) for c in ours.keys() | theirs.keys() if ours.get(c) != theirs.get(c)}


class Vocabulary:
    """Ranks of byte strings, and the rank that each pair of tokens merges to."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        size = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.single = np.full(256, -1, np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.swap = class_differences()
        # a bit set for the basic plane; every text with a code point beyond it is looked at
        basic = "".join(re.escape(chr(c)) for c in self.swap if c < 0x10000)
        self.odd = re.compile(f"[{basic}]" if basic else r"(?!)")
        self.beyond = re.compile("[\U00010000-\U0010ffff]")
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def split(self, text: str) -> list[str]:
        if text.isascii() or not (self.odd.search(text) or self.beyond.search(text)):
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.swap))]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.values[at], NONE)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def replay(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after another, and where each word's ids start."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    n = int(ends[-1]) if len(words) else 0
    token = vocab.single[np.frombuffer(b"".join(words), np.uint8)]
    after = np.arange(1, n + 1, dtype=np.int64)
    before = np.arange(-1, n - 1, dtype=np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    after[ends[lengths > 0] - 1] = -1
    before[starts[lengths > 0]] = -1
    alive = np.ones(n, bool)

    # a word that is a token as a whole isn't merged
    whole = np.fromiter((vocab.ranks.get(w, -1) for w in words), np.int64, len(words))
    is_token = (whole >= 0) & (lengths > 0)
    alive[np.repeat(is_token, lengths)] = False
    alive[starts[is_token]] = True
    token[starts[is_token]] = whole[is_token]
    after[starts[is_token]] = -1

    rank = np.full(n, NONE)
    open_at = np.flatnonzero(alive & (after >= 0))
    rank[open_at] = vocab.pair_ranks(token[open_at], token[after[open_at]])
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def enter(positions: np.ndarray) -> None:
        ranks = rank[positions]
        known = ranks < NONE
        positions, ranks = positions[known], ranks[known]
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for r, part in zip(ranks[np.r_[0, cuts]].tolist() if len(ranks) else [], np.split(positions, cuts), strict=False):
            if r not in index:
                heapq.heappush(heap, r)
            index[r].append(part)

    enter(open_at)
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        at = np.concatenate(parts) if len(parts) > 1 else parts[0]
        at = at[alive[at] & (rank[at] == r)]
        if not len(at):
            continue
        at = np.unique(at)
        # of places that overlap, every other one from the left
        begins = np.r_[True, after[at[:-1]] != at[1:]]
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
        # what the merges bring up when they are made from left to right
        left, right = before[at], after[after[at]]
        merged = np.zeros(len(at), bool)
        merged[1:] = after[after[at[:-1]]] == at[1:]
        lower = np.zeros(len(at), bool)
        some = left >= 0
        lower[some] = vocab.pair_ranks(np.where(merged, r, token[left])[some], np.full(int(some.sum()), r)) < r
        some = right >= 0
        lower[some] |= vocab.pair_ranks(np.full(int(some.sum()), r), token[right[some]]) < r
        if lower.any():
            odd = np.unique(word[at[lower]])
            for w in odd.tolist():
                _merge_alone(starts[w], ends[w], vocab, token, alive, after)
                rank[starts[w]:ends[w]] = NONE
            at = at[~np.isin(word[at], odd)]
            if not len(at):
                continue
        gone = after[at]
        token[at] = r
        alive[gone] = False
        rank[gone] = NONE
        after[at] = after[gone]
        tail = after[at] >= 0
        before[after[at[tail]]] = at[tail]
        rank[at] = NONE
        rank[at[tail]] = vocab.pair_ranks(token[at[tail]], token[after[at[tail]]])
        left = before[at]
        left = left[left >= 0]
        rank[left] = vocab.pair_ranks(token[left], token[after[left]])
        enter(np.unique(np.concatenate([at[tail], left])))
    kept = np.flatnonzero(alive)
    bounds = np.searchsorted(kept, np.r_[starts, n])
    return token[kept], bounds


def _merge_alone(start: int, end: int, vocab: Vocabulary, token: np.ndarray, alive: np.ndarray, after: np.ndarray) -> None:
    """All merges that are left in one word, the lowest rank first and then the leftmost."""
    places = (start + np.flatnonzero(alive[start:end])).tolist()
    tokens = token[places].tolist()
    n = len(places)
    nxt, prev, live = [*range(1, n), -1], list(range(-1, n - 1)), [True] * n
    heap, held, seen = [], [-1] * n, {}

    def rank_of(pair: tuple[int, int]) -> int:
        if pair not in seen:
            r = int(vocab.pair_ranks(np.array(pair[:1]), np.array(pair[1:]))[0])
            seen[pair] = r if r < NONE else -1
        return seen[pair]

    def look(i: int) -> None:
        found = rank_of((tokens[i], tokens[nxt[i]])) if nxt[i] >= 0 else -1
        held[i] = found
        if found >= 0:
            heapq.heappush(heap, (found, i))

    for i in range(n):
        look(i)
    while heap:
        r, i = heapq.heappop(heap)
        if not live[i] or held[i] != r:
            continue
        gone = nxt[i]
        tokens[i], live[gone], nxt[i] = r, False, nxt[gone]
        if nxt[i] >= 0:
            prev[nxt[i]] = i
        look(i)
        if prev[i] >= 0:
            look(prev[i])
    at = np.array([p for p, on in zip(places, live, strict=True) if on])
    alive[start:end] = False
    alive[at] = True
    token[at] = [t for t, on in zip(tokens, live, strict=True) if on]
    after[at] = np.r_[at[1:], -1]


class Encoder:
    """Encodes blocks of texts; keeps the ids of words seen before, up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.reset()

    def reset(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids, self.bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def rows(self, text: str) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, self.vocab.split(text)), np.int64)

    def encode(self, rows: list[np.ndarray]) -> Iterator[np.ndarray]:
        known = len(self.bounds) - 1
        words = [w.encode() for w in list(self.numbers)[known:]]
        ids, bounds = replay(words, self.vocab)
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        sizes = np.diff(self.bounds)
        for row in rows:
            n = sizes[row]
            ends = np.cumsum(n)
            yield self.ids[np.arange(ends[-1] if len(n) else 0) + np.repeat(self.bounds[row] - ends + n, n)]
        if len(self.numbers) > CACHE_WORDS:
            self.reset()


def _blocks(batches: Iterator[pa.RecordBatch], encoder: Encoder, block_chars: int) -> Iterator[tuple]:
    """(key, ids) of every row, a block at a time."""
    keys, rows, chars = [], [], 0
    for part in some_rows(batches):
        for key, text in zip(part["key"], part["text"], strict=True):
            keys.append(key)
            rows.append(encoder.rows(text))
            chars += len(text)
            if chars >= block_chars:
                yield from zip(keys, encoder.encode(rows), strict=True)
                keys, rows, chars = [], [], 0
    if rows:
        yield from zip(keys, encoder.encode(rows), strict=True)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", digest: bool = False,
           block_chars: int = BLOCK_CHARS, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids of every text; with ``digest`` the hashes of the ids and of what they decode to.

    With ``decoded`` the text that the ids decode to comes with them, from the worker that holds the vocabulary.
    """
    last = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>" + ", text string" * decoded
    schema = f"doc_id long, n_tokens long, {last}"
    kinds = [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digest else (
        [("ids", pa.list_(pa.int32()))] + [("text", pa.string())] * decoded)
    fields = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        out, size = [], 0
        for doc, ids in _blocks(batches, Encoder(vocab), block_chars):
            if digest:
                out.append((doc, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                            hashlib.sha256(decode(ids, vocab)).hexdigest()))
            else:
                out.append((doc, len(ids), ids.astype(np.int32), *[decode(ids, vocab).decode("utf-8", "replace")] * decoded))
                size += len(ids)
            if size >= 500_000 or len(out) >= 20_000:
                yield _batch(out, fields)
                out, size = [], 0
        if out:
            yield _batch(out, fields)

    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return shipped(rows).mapInArrow(run, schema)


def decode_table(rows: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with the text that their ids stand for; null ids give a null text, bytes that aren't UTF-8 the replacement character."""
    names = [c for c in rows.columns if c.lower() != text.lower()]

    @F.pandas_udf("string")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path, pattern)
        for part in parts:
            yield pd.Series([None if x is None else decode(np.asarray(x), vocab).decode("utf-8", "replace") for x in part], dtype=object)

    return shipped(rows).select(*names, read(F.col(ids)).alias(text))


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(fields.names, zip(*rows, strict=True), strict=True)), fields)


def decode(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.bytes_of.__getitem__, ids.tolist()))
