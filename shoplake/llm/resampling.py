"""Importance resampling towards a target distribution over hashed n-grams.

A text is taken as UTF-8 bytes. One 256-byte table lower-cases A-Z and blanks every
other ASCII byte that isn't a letter or digit; ``bytes.split`` gives the words. A word's
``zlib.crc32`` is the seed of the next word's, so that the checksums of all runs of two
and three words come from those of the shorter runs. Checksums modulo ``BUCKETS`` are
counted in one array per task, and the tasks' arrays are summed. The logarithm of a
bucket's smoothed share in the target against its share in the documents is its gain, a
document's weight the sum of its features' gains, and a Gumbel number drawn from its id
turns the weights' order into a sample without replacement: the highest scores are drawn.

The only things the driver sees are ``BUCKETS`` counts and one number for each range of
scores. Ranks come from a range partitioning by score, a position within each range and
the sum of the ranges before it; no task sees more than its range.

Defined results: a null text has no words; a null doc_id is hashed as the empty text and
comes after all others in a tie; rows that are equal in score and doc_id are ranked in
any order; an empty table gives an empty table; with no target texts the gains compare
with a flat distribution; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import shipped, staged, text_or_empty

BUCKETS = 10_000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIECE = 1 << 20  # bytes of a text whose words are held at once
#: Bytes of words stay, A-Z as lower case; all other ASCII bytes become blanks.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, of about ``PIECE`` bytes at a time."""
    data, begin = data.translate(TABLE), 0
    while len(data) - begin > PIECE:
        cut = data.find(b" ", begin + PIECE)
        if cut < 0:
            break
        yield data[begin:cut].split()
        begin = cut
    yield data[begin:].split()


def checksums(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, checksums of the runs of 1 to ``RUN`` words that end in them), for a piece of a text at a time."""
    seeds: list[int] = []  # checksums of the runs that end in the last word, the longest left out
    for words in _pieces(data):
        if not words:
            continue
        blanked = [b" " + w for w in words]
        found = [list(map(zlib.crc32, words))]
        for n in range(1, RUN):
            before = seeds[n - 1:n] + found[-1][:-1]  # of the runs of n words that end before each word
            found.append(list(map(zlib.crc32, blanked[len(blanked) - len(before):], before)))
        seeds = [f[-1] for f in found[:-1] if f]
        yield len(words), np.fromiter(chain.from_iterable(found), np.int64)


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n) of all features of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            for data in pdf["data"]:
                for _, sums in checksums(data):
                    total += np.bincount(sums % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = shipped(texts.select(text_or_empty(text).cast("binary").alias("data")))
    return rows.mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counted(texts: DataFrame, text: str) -> list[int]:
    out = [0] * BUCKETS
    for row in bucket_counts(texts, text).collect():  # BUCKETS rows at most
        out[row.bucket] = row.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln(target share / source share)) of every bucket, shares smoothed by one."""
    s_all, t_all = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return [math.floor(1000 * math.log((float(t + 1) * s_all) / (float(s + 1) * t_all)))
            for s, t in zip(source, target, strict=True)]


def noise(key: str, seed: int = SEED) -> int:
    """Gumbel number of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(
        np.array(gains(_counted(docs, text), _counted(target, target_text)), np.int64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gain = held.value
        for pdf in batches:
            out = []
            for key, data in zip(pdf["key"], pdf["data"], strict=True):
                words = features = weight = 0
                for n, sums in checksums(data):
                    words, features, weight = words + n, features + len(sums), weight + int(gain[sums % BUCKETS].sum())
                out.append((key, words, features, weight, weight + noise(key or "", seed)))
            yield pd.DataFrame(out, columns=["key", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("key"), text_or_empty(text).cast("binary").alias("data"))
    out = shipped(rows).mapInPandas(run, "key string, n_words long, n_features long, weight long, score long")
    return out.withColumn("doc_id", F.col("key").cast("long")).drop("key")


def ranked(rows: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """The rows with their rank (from 1) in ``order``; no window over all rows.

    Rows are dealt to ranges and sorted in them; a row's id within the written table
    holds its range and its place, and the sizes of the ranges before it make the rank.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    sizes = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())  # a row a range
    before = [0, *accumulate(n for _, n in sizes)]
    starts = rows.sparkSession.createDataFrame(
        [(part, at) for (part, _), at in zip(sizes, before, strict=False)], "_range long, _before long")
    out = dealt.join(F.broadcast(starts), "_range")
    return out.withColumn(rank, F.col("_before") + (F.col("_at") - F.shiftleft("_range", 33)) + 1).drop("_range", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; undrawn ones have no rank.

    ``percent`` of the documents of ``least_words`` words or more are drawn.
    """
    scored = staged(weigh(docs, target, text, target_text, seed), "resampling_scores")
    able = scored.filter(F.col("n_words") >= least_words)
    draw = able.count() * percent // 100
    placed = ranked(able.withColumn("_row", F.monotonically_increasing_id()),
                    [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")])
    drawn = F.when(F.col("rank") <= draw, F.col("rank"))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return placed.withColumn("rank", drawn).select(*columns).union(rest.select(*columns))
