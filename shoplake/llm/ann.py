"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``TABLES`` tables turns a unit vector by three rounds of random signs and a
fast Hadamard transform and assigns it to the nearest signed axis, its bucket. A
query looks into its ``PROBES`` nearest axes of every table. The rows of a bucket and
the queries that probe it meet in one group, where the cosine of the original vectors
is computed in double precision and the best k are kept; the tables' finds are
merged per query. Buckets larger than ``BLOCK`` rows are cut into parts that every
probing query visits, so a bucket has no cap.

Nothing is fitted: the signs come from a seed, and every row is indexed. With the
probes given, recall of the 5 nearest is over 0.9 even for vectors without clusters,
whose nearest cosine is 0.4 (see the README for the figures).

Defined results: vectors that are null, zero or hold null or non-finite components
take no part; vectors meet only others of their length; a row is no candidate of
itself, but an equal row is; ties go to the smaller vec_id; a null vec_id takes no
part; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import shipped, staged
from shoplake.llm.topk import best_of, vectors

K = 5
TABLES = 8
PROBES = 12
BLOCK = 8192
SEED = 11
FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(units: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    n = 1 << max(0, int(units.shape[1] - 1).bit_length())
    x = np.zeros((len(units), n))
    x[:, :units.shape[1]] = units
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, n))
    for s in signs:
        x = hadamard(x * s)
    return x


def unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def axes(units: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The nearest signed axes of every row, nearest first: 2 j for +j, 2 j + 1 for -j."""
    x = rotate(units, table)
    both = np.stack([x, -x], axis=2).reshape(len(x), -1)
    probes = min(probes, both.shape[1])
    near = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    order = np.argsort(-np.take_along_axis(both, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def _hashed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """Adds ``buckets``: an array of (table, bucket)."""
    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.empty(len(pdf), object)
            for _, part in pdf.reset_index(drop=True).groupby("dims"):
                u = unit(np.stack(part["vector"].to_numpy()).astype(np.float64))
                keys = np.concatenate([axes(u, t, probes) + (t << 32) for t in range(tables)], axis=1)
                for at, k in zip(part.index, keys, strict=True):
                    out[at] = k
            yield pdf.assign(buckets=out)[[*names, "buckets"]]

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", buckets array<long>"
    return shipped(rows).mapInPandas(run, schema)


def _rerank(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    out, k = [], K
    if len(data) and len(queries):
        a, ids, rows = np.stack(data["vector"].to_numpy()), data["vec_id"].to_numpy(), data["row"].to_numpy()
        b = np.stack(queries["vector"].to_numpy())
        ua, ub = unit(a), unit(b)
        for at in range(0, len(b), 256):
            cos = ub[at:at + 256] @ ua.T
            for i, c in enumerate(cos):
                row, query = queries["row"].iat[at + i], queries["vec_id"].iat[at + i]
                good = np.flatnonzero(rows != row)
                if len(good) > k:
                    edge = np.partition(c[good], len(good) - k)[len(good) - k]
                    good = good[c[good] >= edge - 1e-9]
                # the same arithmetic for every pair, so that ties are ties
                scores = cosines(b[at + i], a[good])
                for j in np.lexsort((ids[good], -scores))[:k]:
                    out.append((row, query, rows[good[j]], ids[good[j]], scores[j]))
    frame = pd.DataFrame(out, columns=["query_row", "query_id", "row", "vec_id", "score"])
    return frame.astype({"query_row": "int64", "query_id": "int64", "row": "int64", "vec_id": "int64", "score": "float64"})


def cosines(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of a vector with each of some others; lengths that leave the range of a double are scaled first."""
    s, t = np.abs(q).max(), np.abs(rows).max(axis=1, keepdims=True)
    ordinary = 1e-100 < s < 1e100 and len(rows) and t.min() > 1e-100 and t.max() < 1e100
    q, rows = (q, rows) if ordinary else (q / s, rows / t)
    return (rows * q).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((q * q).sum()))


def search(embeddings: DataFrame, is_query: Column, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 nearest found for every query row."""
    rows = vectors(embeddings).filter(F.exists("vector", lambda x: x != 0)).select("row", "vec_id", "vector", "dims")
    data = staged(_hashed(rows, tables, 1), "ann_index")
    keyed = data.withColumn("bucket", F.explode("buckets")).drop("buckets")
    keys = ["dims", "bucket"]
    sizes = staged(keyed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")), "ann_sizes")
    keyed = keyed.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")
    probing = _hashed(rows.filter(is_query), tables, probes).withColumn("bucket", F.explode("buckets")).drop("buckets")
    probing = probing.join(sizes, keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    keys = [*keys, "part"]
    found = keyed.groupBy(*keys).cogroup(probing.groupBy(*keys)).applyInPandas(_rerank, FOUND)
    # a pair of rows found in several tables is one pair
    return best_of(found.dropDuplicates(["query_row", "row"]))
