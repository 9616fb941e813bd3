"""Quality classifier by nearest-neighbour voting over latent-semantic vectors.

A text's terms are hashed: its words, the shapes of its words (runs of lower case,
upper case, digits and marks), pairs of shapes, and how its words repeat (the shares
of words that equal the one before, of words that also stand among the ``NEAR`` words
before them, and of the commonest word, each measured alike at every length). A run of
more than ``LONG`` characters without white space (Chinese, Japanese or Thai text,
base64, minified code, long URLs) counts as all its overlapping pieces of ``PIECE``
characters, each of them a word. A bounded,
seeded sample of labelled documents (``SAMPLE`` rows at most of each class) gives
term weights and, by a truncated singular value decomposition, ``DIMS`` latent
directions. The sample's unit vectors are broadcast (``2 * SAMPLE * DIMS`` floats,
whatever the input); every document's vector is multiplied with all of them in
blocks, exactly, and its ``NEIGHBOURS`` nearest vote with their labels, weighted by
a power of their cosine. The score is the share of votes for label 1.

A score is a function of the text and the model only: equal texts have equal scores
whatever their ids, and a text of the sample may be its own nearest neighbour. Labelled
rows are used for learning only where ``learn`` holds.

Defined results: a null text is read as empty; a text without terms gets the
sample's weighted mean label; null labels are left out, of several labels of one
doc_id the mean counts (1 from 0.5); with no labels at all every score is 1; equal
rows give equal rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import fresh_name, shipped, staged, text_or_empty

SAMPLE = 2048  # labelled rows of each class, at most
DIMS = 48
NEIGHBOURS = 32
POWER = 8  # of the cosine, as a vote's weight
KEEP_FROM = 0.3
WORD_DIMS, SHAPE_DIMS, PAIR_DIMS, REPEAT_DIMS = 1024, 512, 1024, 64
TERM_DIMS = WORD_DIMS + SHAPE_DIMS + PAIR_DIMS + REPEAT_DIMS
BLOCK = 512
CACHE_WORDS = 100_000
LONG, PIECE = 32, 3
NEAR = 50
_RUNS = re.compile(r"(.)\1+", re.S)


class _Kinds(dict):
    """Character to its kind: a, A, 0, or the character itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        return kind


_KINDS = str.maketrans({i: _Kinds()[i] for i in range(0x250)})


class _Shapes(dict):
    """Hash of a string of kinds, with runs of one kind drawn together."""

    def __missing__(self, kinds: str) -> int:
        h = _hash(_RUNS.sub(r"\1", kinds))
        if len(self) < CACHE_WORDS:
            self[kinds] = h
        return h


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) >> 1


def _cut(words: list[str]) -> Iterator[str]:
    """The words, with overlapping pieces in place of long runs; never held as a list."""
    for word in words:
        if len(word) <= LONG:
            yield word
        else:
            for i in range(len(word) - PIECE + 1):
                yield word[i:i + PIECE]


class Terms(dict):
    """Term counts of texts; what is known of a word is kept by its number, up to a bound."""

    def __init__(self) -> None:
        super().__init__()
        self.shapes = _Shapes()
        self.word_dim = np.zeros(1 << 12, np.int64)
        self.shape = np.zeros(1 << 12, np.int64)

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        if n == len(self.shape):
            self.word_dim, self.shape = (np.r_[x, np.zeros(n, np.int64)] for x in (self.word_dim, self.shape))
        self.word_dim[n] = _hash(word) % WORD_DIMS
        self.shape[n] = self.shapes[word.translate(_KINDS)]
        return n

    def vector(self, text: str) -> np.ndarray:
        """Weights of the terms, each of the four kinds of length 1 (all zero for a text without words)."""
        out = np.zeros(TERM_DIMS, np.float32)
        words = text.split()
        if not words:
            return out
        if len(self) > CACHE_WORDS:
            self.clear()
        every = words if max(map(len, words)) <= LONG else _cut(words)
        at = np.fromiter(map(self.__getitem__, every), np.int64)
        shapes = self.shape[at]
        pairs = (shapes[:-1] * 31 + shapes[1:]) % PAIR_DIMS if len(at) > 1 else np.zeros(0, np.int64)
        begin = 0
        for dims, found in ((WORD_DIMS, self.word_dim[at]), (SHAPE_DIMS, shapes % SHAPE_DIMS), (PAIR_DIMS, pairs)):
            counts = np.sqrt(np.bincount(found, minlength=dims).astype(np.float32))
            out[begin:begin + dims] = counts / max(1e-9, float(np.sqrt((counts * counts).sum())))
            begin += dims
        same = float((at[1:] == at[:-1]).mean()) if len(at) > 1 else 0.0
        order = np.argsort(at, kind="stable")
        again = at[order[1:]] == at[order[:-1]]
        near = float((again & (np.diff(order) <= NEAR)).sum()) / len(at)
        runs = np.diff(np.r_[np.flatnonzero(np.r_[True, ~again]), len(at)])
        common = (float(runs.max()) - 1) / (len(at) + NEAR)
        grid = np.arange(20) / 19
        for i, value in enumerate((same, near, common)):
            out[begin + 20 * i:begin + 20 * i + 20] = np.exp(-((grid - value) / 0.08) ** 2)
        part = out[begin:]
        part /= np.sqrt((part * part).sum())
        return out


class Model:
    """Labelled unit vectors and the projection that makes them; a few MB at most."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray):
        seen = (vectors > 0).sum(axis=0) / max(1, len(vectors))
        self.weight = np.log(1 + 1 / np.maximum(seen, 1 / max(1, len(vectors)))).astype(np.float32)
        self.labels = labels.astype(np.float64)
        self.prior = float(labels.mean()) if len(labels) else 1.0
        x = vectors * self.weight
        rng = np.random.default_rng(5)
        dims = min(DIMS, *x.shape) if len(x) else 0
        if dims:
            basis = x.T @ rng.standard_normal((len(x), min(len(x), dims + 16))).astype(np.float32)
            for _ in range(4):
                basis, _ = np.linalg.qr(x.T @ (x @ basis))
            _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
            self.project = (basis @ right[:dims].T).astype(np.float32) * self.weight[:, None]
        else:
            self.project = np.zeros((TERM_DIMS, 1), np.float32)
        self.known = self.unit(vectors)

    def unit(self, vectors: np.ndarray) -> np.ndarray:
        low = vectors @ self.project
        return low / np.maximum(np.sqrt((low * low).sum(axis=1, keepdims=True)), 1e-12)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors, for a block of documents."""
        out = np.full(len(vectors), self.prior)
        if not len(self.known):
            return out
        cos = self.unit(vectors) @ self.known.T
        k = min(NEIGHBOURS, cos.shape[1])
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cos, near, axis=1), 0.0).astype(np.float64) ** POWER
        total = votes.sum(axis=1)
        some = (total > 1e-12) & (vectors.any(axis=1))
        out[some] = (votes * self.labels[near]).sum(axis=1)[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", sample: int = SAMPLE, seed: int = 3) -> Model:
    """Learns from at most ``sample`` labelled documents of each class, chosen by a hash of doc_id.

    Only the sample's ids reach the documents, as a broadcast of bounded size, and only
    its term counts the driver.
    """
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learn)
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    best = [known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(sample) for q in (0, 1)]
    chosen = staged(best[0].union(best[1]), "quality_sample")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text).alias("text"),
                        F.md5(text_or_empty(text).cast("binary")).alias("digest"))
            .join(F.broadcast(chosen), "doc_id"))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for pdf in batches:
            vectors = [terms.vector(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "digest": pdf["digest"],
                                "at": [np.flatnonzero(v).astype(np.int32) for v in vectors],
                                "weight": [v[v != 0] for v in vectors]})

    found = shipped(rows).mapInPandas(counts, "doc_id long, quality int, digest string, at array<int>, weight array<float>")
    # of several texts of one doc_id the least, whatever the partitioning
    found = found.groupBy("doc_id").agg(F.min(F.struct("digest", "quality", "at", "weight")).alias("m")).select("doc_id", "m.*")
    found = found.orderBy("doc_id").toPandas()
    vectors = np.zeros((len(found), TERM_DIMS), np.float32)
    for i, (at, weight) in enumerate(zip(found["at"], found["weight"], strict=True)):
        vectors[i, at] = weight
    return Model(vectors, found["quality"].to_numpy(np.int64))


def score(docs: DataFrame, model: Model, text: str = "text", keep_from: float = KEEP_FROM,
          score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """All columns of ``docs`` plus score and predicted (which replace columns of those names); the model is broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c.lower() not in (score_col.lower(), predicted_col.lower())]

    @F.pandas_udf("double")
    def vote(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms, m = Terms(), held.value
        for texts in parts:
            out = np.empty(len(texts))
            for at in range(0, len(texts), BLOCK):
                block = np.stack([terms.vector(t) for t in texts.iloc[at:at + BLOCK]])
                out[at:at + BLOCK] = m.scores(block)
            yield pd.Series(out)

    scored = shipped(docs).select(*names, vote(text_or_empty(text)).alias(score_col))
    return scored.withColumn(predicted_col, (F.col(score_col) >= keep_from).cast("int"))


def accepted(docs: DataFrame, model: Model, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents with label 1 predicted, with their own columns only."""
    names = fresh_name(docs, "quality_score"), fresh_name(docs, "quality_predicted")
    return score(docs, model, text, keep_from, *names).filter(F.col(names[1]) == 1).select(*docs.columns)


def learnable() -> Column:
    """Rows that labels may be learnt from: crc32 of the id as text isn't divisible by 5."""
    return ~held_out()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
