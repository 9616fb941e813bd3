"""Near-duplicate classes by DartMinHash signatures and banded joining.

A text is lower-cased and split at white space; its set of five-word shingles (the
whole text where it has fewer words) is weighed, by default 1 for each shingle.
DartMinHash throws darts at the plane of every element's weight and rank: a strip
of weights ``[2^v - 1, 2^(v+1) - 1)`` gets darts at exponential gaps of rate 2^v,
drawn from hashes of the element alone, and the element keeps those below its
weight. Darts are thrown up to a rank that gives about k ln k + 2k of them; each
falls on one of k coordinates, which keeps its earliest. Two signatures agree in a
coordinate with the probability of their weighted Jaccard similarity. A document
with a coordinate left empty is thrown again with twice the rank.

Bands of coordinates are joined; pairs are verified by the exact Jaccard similarity
of their shingle sets. With 25 bands of 5, a pair at 0.8 is missed with probability
5e-5, at 0.85 with 1e-6.

Work on groups stays linear: texts that are equal word for word are collapsed first.
In every bucket one leader is compared with the other members, the text that shares
buckets with the most others: it lies in the middle of its group, so a large group of
near copies is joined up at once. Texts that are left in a bucket with another class
meet by prefix filtering, as similar sets share one of their rarest shingles, and are
compared exactly within tasks of bounded size, which give each text's number of links
and the links that join classes: no pair of a group becomes a row.
Shingles that no other text has can't be in an overlap; where too many are,
a pair is ruled out before it is formed. So there is no cap on buckets or partners,
and no link between texts of different classes that share a band is lost.

Defined results: a null text is read as empty; texts without words are copies of
each other; a null doc_id is ordered last; rows that are equal in all are copies;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import among, fresh_name, packed, shipped, some_rows, staged, text_or_empty

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
LAST_ID = (1 << 63) - 1  # stands for a null doc_id: ordered last
BATCH_SHINGLES = 200_000
BATCH_TEXTS = 5_000
THROWS = 200_000
CACHE_WORDS = 100_000
LEAF = 500_000  # shingles and
CROWD = 1500  # texts that one task compares across classes

_RNG = np.random.default_rng(20240607)
_ORDER = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit mixing hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _step(i: int) -> np.uint64:
    return np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def _unit(x: np.ndarray) -> np.ndarray:
    """Hash to (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


class _WordHashes(dict):
    """Hashes of words seen before; forgotten beyond a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode()) >> 1
        return h


_HASHES = _WordHashes()


def normal_words(text: str) -> list[str]:
    return text.lower().split()


def shingles(words: list[str], counts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) of a text's words, and their weights."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words)).view(np.uint64)
    n = max(1, len(words) - WORDS + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(words))):
        h += hashes[i:i + n] * _ORDER[i]
    if not counts:
        h = np.sort(_mix(h))
        found = h[np.r_[True, h[1:] != h[:-1]]]
        return found, np.ones(len(found))
    found, times = np.unique(_mix(h), return_counts=True)
    return found, times.astype(np.float64)


def dart_signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """DartMinHash signatures of several weighted sets that lie one after another; sets may not be empty."""
    docs = len(sizes)
    owner = np.repeat(np.arange(docs), sizes)
    total = np.add.reduceat(weights, np.r_[0, np.cumsum(sizes)[:-1]])
    reach = (k * np.log(k) + 2 * k) / total
    sig = np.zeros((docs, k), np.uint64)
    todo = np.ones(docs, bool)
    while todo.any():
        best = np.full(docs * k, np.inf)
        own = np.zeros(docs * k, np.uint64)
        use = todo[owner]
        cells, w, who = elements[use], weights[use], owner[use]
        v = 0
        while len(cells):
            _throw(cells, w, who, v, reach, k, seed, best, own)
            v += 1
            more = w > 2.0**v - 1
            cells, w, who = cells[more], w[more], who[more]
        full = np.isfinite(best.reshape(docs, k)).all(axis=1) & todo
        sig[full] = own.reshape(docs, k)[full]
        todo &= ~full
        reach = np.where(todo, reach * 2, reach)
    return sig


def _throw(cells, w, who, v, reach, k, seed, best, own) -> None:
    """The darts of weight strip ``v``, one arrival of every cell at a time."""
    base = _mix(cells + _step(seed * 1_000_003 + v * 7919))
    rank = np.zeros(len(cells))
    low, wide, j = 2.0**v - 1, 2.0**v, 0
    whole = wide == 1 and not (w < 1).any()
    while len(base):
        n = max(1, min(64, THROWS // len(base)))  # arrivals at once
        steps = np.array([_step(j + i) for i in range(1, n + 1)])
        j += n
        u = _mix(base[:, None] + steps)
        ranks = rank[:, None] + np.cumsum(-np.log(_unit(u)) / wide, axis=1)
        near = ranks < reach[who][:, None]
        cell, _ = np.nonzero(near)
        dart, r = _mix(u[near] + np.uint64(0xA0761D6478BD642F)), ranks[near]
        if not whole:
            hit = low + wide * _unit(_mix(dart ^ np.uint64(0xE7037ED1A0B428DB))) <= w[cell]
            cell, dart, r = cell[hit], dart[hit], r[hit]
        slot = who[cell] * k + (dart >> np.uint64(33)).astype(np.int64) % k
        np.minimum.at(best, slot, r)
        first = best[slot] == r
        own[slot[first]] = dart[first]
        on = near[:, -1]
        base, rank, who, w = base[on], ranks[on, -1], who[on], w[on]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig.reshape(len(sig), bands, rows)
    key = np.zeros((len(sig), bands), np.uint64)
    for i in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    key = _mix(key + np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return key.view(np.int64)


SIGNATURES = "doc_id long, row long, raw string, digest binary, n int, bands array<long>"
_SIGNATURES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("raw", pa.string()), ("digest", pa.binary()), ("n", pa.int32()),
                         ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("set", pa.list_(pa.int64()))])


def signatures(docs: DataFrame, text: str = "text", bands: int = BANDS, rows: int = ROWS, counts: bool = False) -> DataFrame:
    """doc_id, row, the text's digest, the number of its shingles and its band keys (none for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in some_rows(batches):
            for doc, row, raw, body in zip(part["doc_id"], part["row"], part["raw"], part["text"], strict=True):
                words = normal_words(body)
                elements, weights = shingles(words, counts)
                digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
                held.append((doc, row, raw, digest, elements, weights))
                size += len(elements)
                if size >= BATCH_SHINGLES or len(held) >= BATCH_TEXTS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
        _HASHES.clear()  # a worker goes on to other tasks

    def flush(held: list) -> pa.RecordBatch:
        full = [h for h in held if len(h[4])]
        keys = iter(())
        if full:
            sig = dart_signatures(np.concatenate([h[4] for h in full]), np.concatenate([h[5] for h in full]),
                                  np.array([len(h[4]) for h in full]), bands * rows)
            keys = iter(band_keys(sig, bands, rows))
        return pa.RecordBatch.from_pydict({
            "doc_id": [h[0] for h in held], "row": [h[1] for h in held], "raw": [h[2] for h in held],
            "digest": [h[3] for h in held], "n": [len(h[4]) for h in held],
            "bands": [next(keys) if len(h[4]) else [] for h in held]}, _SIGNATURES)

    body = text_or_empty(text)
    rows_in = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"),
                          F.monotonically_increasing_id().alias("row"), F.md5(body.cast("binary")).alias("raw"), body.alias("text"))
    return shipped(rows_in).mapInArrow(run, SIGNATURES)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, text) to (node, set): the distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in some_rows(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "row": part["row"], "set": [
                shingles(normal_words(t))[0].view(np.int64) for t in part["text"]]}, _SETS)
        _HASHES.clear()

    out = shipped(texts.select("node.doc_id", "node.row", "text")).mapInArrow(run, "doc_id long, row long, set array<long>")
    return out.select(F.struct("doc_id", "row").alias("node"), "set")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    right = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    both = pairs.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.filter(common >= similarity * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def _prefix_regions(live: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Regions (region, node, n, label, regions) in which all texts of different classes meet that can be similar enough.

    Two sets of similarity t share one of the ``n - ceil(t n) + 1`` shingles of each that
    come first in any common order; with the rarest first, few others have them. Such shingles
    with one hub, the text that has most of them, are one region; ``regions`` are all of a text's.
    """
    rows = live.join(sets, "node").select("node", "n", "label", F.explode("set").alias("shingle"))
    texts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    order = Window.partitionBy("node").orderBy("texts", "shingle")
    first = (rows.join(texts, "shingle").withColumn("at", F.row_number().over(order))
             .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).filter("texts > 1"))
    first = staged(first.select("shingle", "node", "n", "label"), "dart_prefixes")
    mixed = first.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("shingle")
    known = staged(first.join(mixed, "shingle"), "dart_mixed")
    reach = known.groupBy("node").agg(F.count(F.lit(1)).alias("reach"))
    hubs = known.join(reach, "node").groupBy("shingle").agg(F.max(F.struct("reach", "node"))["node"]["row"].alias("region"))
    regions = staged(known.join(hubs, "shingle").select("region", "node", "n", "label").distinct(), "dart_regions")
    return regions.join(regions.groupBy("node").agg(F.array_sort(F.collect_list("region")).alias("regions")), "node")


ACROSS = "doc_id long, row long, doc_b long, row_b long, links long"


def _block_links(pdf: pd.DataFrame, similarity: float) -> list[tuple]:
    """Links of one task's texts across classes: how many each text has (row_b: -1), and those that join classes.

    A pair that meets in several regions is counted in the first.
    """
    from shoplake.llm.ngram_join import _flat, _Joined, overlaps  # that module imports this one

    pdf = pdf.assign(n=pdf["set"].map(len)).sort_values("n", kind="stable")
    region, sided = int(pdf["region"].iloc[0]), bool(pdf["sided"].iloc[0])
    n, label, side, doc, row = (pdf[c].to_numpy() for c in ("n", "label", "side", "doc_id", "row"))
    regions = [set(r) for r in pdf["regions"]]
    flat, ends, count = _flat([np.asarray(s, np.int64) for s in pdf["set"]])
    joined, mark, found = _Joined(label), np.zeros(count, np.int64), np.zeros(len(pdf), np.int64)
    upto = np.searchsorted(similarity * n - 1e-6, n, side="right")  # the larger ones that fit
    for i in range(len(pdf)):
        later = np.arange(i + 1, upto[i])
        later = later[label[later] != label[i]]
        if sided:
            later = later[side[later] != side[i]]
        if not len(later):
            continue
        own = flat[ends[i]:ends[i + 1]]
        mark[own] = 1
        common = overlaps(mark, flat, ends, later)
        mark[own] = 0
        near = later[common >= similarity * (n[later] + n[i] - common)]
        if len(regions[i]) > 1:
            near = np.array([j for j in near.tolist() if min(regions[i] & regions[j]) == region], np.int64)
        found[i] += len(near)
        found[near] += 1
        joined.add(i, near)
    return [(doc[i], row[i], -1, -1, found[i]) for i in np.flatnonzero(found).tolist()] + [
        (doc[i], row[i], doc[j], row[j], 0) for i, j in joined.links]


def _across(regions: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """What ``_block_links`` finds in the regions, two blocks a task; blocks of one and the same class don't meet.

    No pair of a region becomes a row: a task compares its texts in place.
    """
    parts = F.greatest(F.ceil(2 * F.col("total") / LEAF), F.ceil(2 * F.col("held") / CROWD)).cast("int")
    sizes = [F.count(F.lit(1)).alias("held"), F.sum("n").alias("total")]
    large = staged(regions.groupBy("region", "label").agg(*sizes).filter(parts > 1)
                   .select("region", "label", F.col("label.row").alias("class"), parts.alias("parts")), "dart_large")
    dealt = regions.join(large, ["region", "label"], "left")
    small = dealt.filter("class is null").groupBy("region").agg(*sizes).select("region", parts.alias("others"))
    dealt = dealt.join(small, "region", "left").withColumn("block", F.struct(
        F.coalesce("class", F.lit(-1).cast("long")).alias("class"),
        F.pmod(F.xxhash64("node.row"), F.coalesce("parts", "others")).cast("int").alias("part")))
    dealt = staged(dealt.select("region", "node", "n", "label", "regions", "block"), "dart_dealt")
    blocks = dealt.groupBy("region", "block").agg(*sizes)
    one, two = (blocks.select("region", F.col("block").alias(c), F.col("total").alias(f"total_{c}")) for c in ("one", "two"))
    tasks = one.join(two, "region").filter(
        (F.col("one") < F.col("two")) & ((F.col("one.class") == -1) | (F.col("one.class") != F.col("two.class")))
        | (F.col("one") == F.col("two")) & (F.col("one.class") == -1))
    tasks = staged(tasks.withColumn("task", F.monotonically_increasing_id()), "dart_tasks")
    lots = (tasks.agg(F.sum(F.col("total_one") + F.col("total_two"))).first()[0] or 0) // LEAF + 1
    sides = F.explode(F.array_distinct(F.array("one", "two"))).alias("block")
    members = dealt.join(tasks.select("region", "task", (F.col("one") != F.col("two")).alias("sided"), "two", sides), ["region", "block"])
    rows = members.join(sets, "node").select(
        F.pmod(F.xxhash64("task"), F.lit(lots)).alias("lot"), "task", "region", "sided", "node.doc_id", "node.row",
        F.col("label.row").alias("label"), (F.col("block") == F.col("two")).cast("int").alias("side"), "regions", "set")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, part in pdf.groupby("task", sort=False) for x in _block_links(part, similarity)]
        return pd.DataFrame(found, columns=[c.split()[0] for c in ACROSS.split(", ")]).astype("int64")

    return shipped(rows).groupBy("lot").applyInPandas(run, ACROSS)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component, by label spreading and pointer jumping.

    Each round writes its labels, in tasks and files by the number of links.
    """
    most = 4 * links.count()
    # every node is its own neighbour too: one grouping gives its old label and the least near it
    ends = F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x in "ab" for y in "ab"])).alias("end")
    both = staged(packed(links.select(ends).select("end.*").distinct(), most), "links")
    labels = staged(packed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), most), "labels")
    while True:
        spread = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
                  .agg(F.min(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old"), F.min("label").alias("label")))
        # by the labels of before: those of this round would have the join made twice
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = spread.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("top", "label")).alias("label"))
        labels = staged(packed(jumped, most), "labels")
        if labels.filter("label != old").isEmpty():
            return labels.select("node", "label")


def classes(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, raw (md5 of the text), class_id (least doc_id of the class), keep, copies and links per document."""
    sig = staged(signatures(docs, text, bands, rows), "dart_signatures")
    node = F.struct("doc_id", "row")
    texts = staged(sig.groupBy("digest").agg(F.min(F.struct("doc_id", "row", "n", "bands")).alias("m"),
                                             F.count(F.lit(1)).alias("copies"))
                   .select("digest", F.struct("m.doc_id", "m.row").alias("node"), "copies", "m.n", "m.bands"), "dart_texts")
    keyed = texts.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    members = staged(keyed.join(shared, "key"), "dart_members")
    involved = members.select("node.doc_id", "node.row").distinct()
    own = sig.select("doc_id", "row", "raw").join(involved, ["doc_id", "row"])
    body = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"),
                       F.md5(text_or_empty(text).cast("binary")).alias("raw"), text_or_empty(text).alias("text"))
    # rows with the same doc_id and text are one text here
    chosen = staged(own.groupBy("doc_id", "raw").agg(F.min("row").alias("row")), "dart_chosen")
    sets = staged(shingle_sets(among(body, chosen, "raw").join(chosen, ["doc_id", "raw"]).select(node.alias("node"), "text"))
                  .dropDuplicates(["node"]), "dart_sets")
    # a shingle that no other text has is in no overlap: what a text can share bounds its links exactly
    alone = (sets.select(F.col("node.row").alias("row"), F.explode("set").alias("shingle")).groupBy("shingle")
             .agg(F.count(F.lit(1)).alias("texts"), F.min("row").alias("row")).filter("texts = 1")
             .groupBy("row").agg(F.count(F.lit(1)).alias("alone")))
    members = members.join(alone.withColumnRenamed("row", "lone"), F.col("node.row") == F.col("lone"), "left")
    members = members.select("key", "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("may"))
    members = members.filter(F.col("may") >= similarity * F.col("n"))
    # a text that many share a bucket with is likely the middle of its group: such texts lead first
    members = staged(members, "dart_members")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    reach = members.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("reach"))
    members = staged(members.join(reach, "node"), "dart_members")
    # each bucket's most central text against its other members
    lead = members.groupBy("key").agg(F.max(F.struct("reach", "node", "n", "may")).alias("first"))
    ranked = staged(members.join(lead, "key"), "dart_buckets")
    pairs = ranked.filter(F.col("node") != F.col("first.node")).filter(
        F.least("may", "first.may") >= similarity / (1 + similarity) * (F.col("n") + F.col("first.n")) - 1e-6)
    pairs = pairs.select(F.least("node", "first.node").alias("a"), F.greatest("node", "first.node").alias("b")).distinct()
    links = staged(_verified(pairs, sets, similarity), "dart_links")
    labels = components(links)
    # the rest: texts in buckets whose other members aren't of one class yet
    rest = ranked.filter(F.col("node") != F.col("first.node")).join(labels, "node", "left").select(
        "key", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("key")
    live = staged(rest.join(mixed, "key").select("node", "n", "label").distinct(), "dart_live")
    more = staged(_across(_prefix_regions(live, sets, similarity), sets, similarity), "dart_across")
    joins = more.filter("row_b >= 0").select(node.alias("a"), F.struct(F.col("doc_b").alias("doc_id"), F.col("row_b").alias("row")).alias("b"))
    if not joins.isEmpty():
        labels = components(links.union(joins))
    out = sig.select("doc_id", "row", "raw", "digest").join(texts.select("digest", "node", "copies"), "digest")
    ends = links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("links"))
    degree = ends.union(more.filter("row_b < 0").select(node.alias("node"), "links")).groupBy("node").agg(F.sum("links").alias("links"))
    out = out.join(labels, "node", "left").join(degree, "node", "left")
    out = out.withColumn("label", F.coalesce("label", "node")).withColumn(
        "links", F.coalesce("links", F.lit(0).cast("long")))
    real = lambda c: F.when(c != LAST_ID, c)
    return out.select(real(F.col("doc_id")).alias("doc_id"), "raw", real(F.col("label.doc_id")).alias("class_id"),
                      (node == F.col("label")).alias("keep"), "copies", "links")


def deduplicated(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """One document of each class, with all its columns."""
    own = fresh_name(docs, "dart_key")
    kept = classes(docs, text, **how).filter("keep").select(F.struct("doc_id", "raw").alias(own))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text_or_empty(text).cast("binary")).alias("raw"))
    return docs.withColumn(own, key).join(kept, own).dropDuplicates([own]).select(*docs.columns)
