"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are made integers, ``floor(256 x)``. Data and queries are cut into blocks
of bounded size and every pair of blocks is one task group (a stated query set
against all rows, in blocks). In a group both sides get a cover tree: a node's
children are centres more than ``radius / BASE`` apart that cover its points within
that radius, the node's own centre first. Query and data nodes are then descended
together: for centres q, p and covering radii r, s no pair below can score more than
``<q, p> + r|p| + s|q| + r s``, and a pair of nodes is dropped when that is less than
the worst kth score of the query group. What is left meets in blocked products. The
best k of every data block are merged per query.

Defined results: vectors that are null or hold null or non-finite components take
no part; vectors meet only others of their length; a row is no candidate of itself,
but an equal row is; ties go to the smaller vec_id; scores beyond a 64-bit integer
stop at its ends and are ties there; a null vec_id is no query and takes no part; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import shipped, staged

SCALE = 256
K = 5
BLOCK = 4096
LEAF = 64
QUERY_LEAF = 8
BASE = 1.3
EXACT = 2.0**53
LARGEST = (1 << 63) - 1
FOUND = "query_row long, query_id long, vec_id long, score long"


def valid(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


class CoverTree:
    """Nodes in arrays: centre (a point), covering radius, children, and the points of a leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.centre, self.radius, self.children, self.members = [], [], [], []
        if len(points):
            far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
            self._grow(np.arange(len(points)), 0, far, leaf)
        self.centre, self.radius = np.array(self.centre, dtype=np.int64), np.array(self.radius)
        self.norm = np.sqrt((points[self.centre] ** 2).sum(axis=1)) if len(points) else np.zeros(0)

    def _grow(self, members: np.ndarray, centre: int, dist: np.ndarray, leaf: int) -> int:
        todo, root = [(members, centre, dist, -1)], len(self.centre)
        while todo:
            members, centre, dist, parent = todo.pop()
            node = len(self.centre)
            if parent >= 0:
                self.children[parent].append(node)
            radius = float(dist.max())
            self.centre.append(centre)
            self.radius.append(radius)
            self.children.append([])
            parts = self._split(members, centre, dist, radius / BASE) if len(members) > leaf and radius > 0 else None
            self.members.append(members if parts is None else None)
            for part in parts or ():
                todo.append((*part, node))
        return root

    def _split(self, members, centre, dist, cover):
        """Farthest points become centres until all lie within ``cover``; None if the points are too spread to gain."""
        at, best, centres = np.zeros(len(members), np.int64), dist.copy(), [centre]
        points = self.points[members]
        while best.max() > cover:
            if len(centres) > len(members) // 4:
                return None
            nxt = int(best.argmax())
            d = np.sqrt(((points - points[nxt]) ** 2).sum(axis=1))
            closer = d < best
            at[closer], best[closer] = len(centres), d[closer]
            centres.append(int(members[nxt]))
        return [(members[at == i], c, best[at == i]) for i, c in enumerate(centres) if (at == i).any()]


class Best:
    """The k best of every query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.kth = k, np.full(n, -np.inf)
        self.found: list[list[tuple]] = [[] for _ in range(n)]

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """``own``: for each query, a mask of candidates that are its own row."""
        for i, q in enumerate(queries):
            good = np.flatnonzero((scores[i] >= self.kth[q]) & ~own[i])
            if len(good) > 4 * self.k:  # all that reach the kth of these, ties included
                edge = np.partition(scores[i][good], len(good) - self.k)[len(good) - self.k]
                good = good[scores[i][good] >= edge]
                good = good[np.lexsort((ids[good], -scores[i][good]))][:self.k]
            if len(good):
                both = self.found[q] + [(-scores[i][g], ids[g]) for g in good]
                both.sort()
                self.found[q] = both[:self.k]
                if len(self.found[q]) == self.k:
                    worst = -float(self.found[q][-1][0])  # a little lower where a double can't hold it
                    self.kth[q] = worst if abs(worst) < EXACT else worst - abs(worst) * 1e-15


def dual_search(data: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray,
                k: int = K) -> tuple[list[list[tuple]], int]:
    """For each query its k best (-score, id); and how many products were formed."""
    top, products = Best(len(queries), k), 0
    if not len(data) or not len(queries):
        return top.found, 0
    tree, qtree = CoverTree(data), CoverTree(queries, QUERY_LEAF)
    centres, qcentres = data[tree.centre], queries[qtree.centre]
    largest = max(1.0, float(np.abs(data).max()), float(np.abs(queries).max()))
    exact = largest * largest * data.shape[1] < EXACT
    big = None if exact else [np.array([[int(x) for x in v] for v in m], dtype=object).reshape(m.shape) for m in (data, queries)]

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        r, n = qtree.radius[q], qtree.norm[q]
        s = tree.radius[nodes]
        up = centres[nodes] @ qcentres[q] + r * tree.norm[nodes] + s * n + r * s
        return up + 1e-9 * (1.0 + np.abs(up) + n * tree.norm[nodes])

    def worst(q: int) -> float:
        return float(top.kth[below[q]].min())

    below: dict[int, np.ndarray] = {}
    for q in reversed(range(len(qtree.centre))):
        below[q] = qtree.members[q] if qtree.members[q] is not None else np.concatenate([below[c] for c in qtree.children[q]])
    todo = [(0, np.array([0]))]
    while todo:
        q, nodes = todo.pop()
        nodes = nodes[bounds(q, nodes) >= worst(q)]
        if qtree.members[q] is None:
            # the side with the larger radius goes down first
            wide = np.array([tree.members[n] is None and tree.radius[n] >= qtree.radius[q] for n in nodes], bool)
            if wide.any():
                nodes = np.concatenate([nodes[~wide], *[np.array(tree.children[n]) for n in nodes[wide]]])
                nodes = nodes[bounds(q, nodes) >= worst(q)]
            todo.extend((c, nodes) for c in qtree.children[q])
            continue
        group = qtree.members[q]
        while len(nodes):
            up = bounds(q, nodes)
            order = np.argsort(-up)
            nodes, up = nodes[order], up[order]
            nodes = nodes[up >= worst(q)]
            head, nodes = nodes[:4], nodes[4:]
            leaves = [tree.members[n] for n in head if tree.members[n] is not None]
            inner = [np.array(tree.children[n]) for n in head if tree.members[n] is None]
            nodes = np.concatenate([nodes, *inner]) if inner else nodes
            if leaves:
                at = np.concatenate(leaves)
                scores = (queries[group] @ data[at].T if exact else
                          np.clip(big[1][group] @ big[0][at].T, -LARGEST, LARGEST).astype(np.int64))
                products += scores.size
                top.offer(group, scores, ids[at], query_rows[group][:, None] == rows[at][None, :])
    return top.found, products


def _group(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(data) and len(queries):
        ints = [np.floor(SCALE * np.stack(p["vector"].to_numpy()).astype(np.float64)) for p in (data, queries)]
        found, _ = dual_search(ints[0], data["vec_id"].to_numpy(), data["row"].to_numpy(), ints[1], queries["row"].to_numpy())
        out = [(r, q, i, int(-s)) for r, q, best in zip(queries["row"], queries["vec_id"], found, strict=True)
               for s, i in best]
    return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"]).astype("int64")


def vectors(embeddings: DataFrame) -> DataFrame:
    """row, vec_id, vector, dims of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                             vector.alias("vector"))
    return staged(rows.filter(valid(F.col("vector")) & F.col("vec_id").isNotNull())
                  .withColumn("dims", F.size("vector")), "vectors")


def best_of(found: DataFrame, k: int = K) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search(embeddings: DataFrame, is_query: Column, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 best candidates of every query row."""
    rows = vectors(embeddings)
    queries = rows.filter(is_query)
    n, m = rows.count(), queries.count()
    blocks, query_blocks = max(1, math.ceil(n / block)), max(1, math.ceil(m / block))
    own = lambda count, seed: F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.withColumn("block", own(blocks, 1)).withColumn("query_block", every(query_blocks))
    right = queries.withColumn("query_block", own(query_blocks, 2)).withColumn("block", every(blocks))
    keys = ["dims", "block", "query_block"]
    found = shipped(left).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_group, FOUND)
    return best_of(found)
