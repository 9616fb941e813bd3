"""Exact n-gram Jaccard join of texts as a recursive join in a metric space.

A text is lower-cased (A-Z only) and split at white space; its set are its distinct
three-word shingles as 64-bit hashes. One minus the Jaccard similarity is a metric, and
two texts link where it is ``1 - PERCENT / 100`` or less (the radius). Texts of equal
sets are one point.

Regions are made by pivots. On the first level the pivots are sets of one shingle: a
point is equally near to all of its own shingles and at distance 1 from any other, so a
point is on the boundary of all its shingles' regions, and the window is a count: two
points within the radius share one of the ``n - ceil(0.9 n) + 1`` shingles of each that
come first in one order, wherefore a point is replicated to the regions of these only. One
of the two, the smaller, even has it among its first ``n - ceil(2 * 0.9 / 1.9 n) + 1``:
regions in which no point has its shingle that early are empty of links.
The order takes a fixed sixth of all shingles first, the rarest of them before others;
a point whose window holds a shingle that no other point has links with nothing there,
so most texts leave here. (Texts that share nothing are all at distance 1 from each
other: no triangle of points tells them apart, so text pivots can't be the first level.)

Within a region the pivots are points. First one of each region, the point that shares
most, is compared with the others; regions whose points are then all of one component
are done. Of what is left, regions that have one hub (the point that is in most regions)
are gathered, so that a point's set is sent to few regions and not for each shingle. They
are then joined recursively: one of more than ``LEAF`` shingles or ``CROWD``
points gets pivots, each point goes to its nearest one (its Voronoi cell) and, by the triangle
inequality, to each cell whose pivot is at most two radii farther, so any linked pair
meets in a cell; and within a cell, again by the triangle inequality, to rings of one
radius around the pivot, its own and the next inner one, so the pair meets in a ring. A
pivot has been compared with its whole region and leaves it. Components are drawn up anew
with the pivots' links, rings whose points are all of one component are done, and the
others are regions again. Where more than ``SPREAD`` times a region's points are left in
rings or the recursion gets deeper than ``DEPTH``, the blocks of what is left of it are
joined with one another instead, exactly, two blocks a task. Smaller regions are joined in one task each, by size windows, triangle windows against the points compared so far and exact
overlaps; a point isn't compared with points of its own component.

No step forms the pairs of a group: what is written are pivots' pairs, and the links
that join components. So the result is components, not all links of a dense group.

Defined results: a null text is read as empty; a text without words has an empty set
and is a component of its own; a component's id is its least doc_id, null ids left out
(null where all are); rows of equal doc_id are joined like any others; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm.common import among, packed, shipped, some_rows, staged, text_or_empty
from shoplake.llm.neardup import components

WORDS = 3
PERCENT = 90
LEAF = 500_000  # shingles and
CROWD = 1500  # points of a region that one task joins
FEW = 4  # points of a region that one task joins whatever their size
PIVOTS = 48
SPREAD = 4
DEPTH = 2
FIRST = 6  # one in so many shingles comes first in the order
COUNTED = 40  # bits of a shingle's hash by which it is counted
BATCH_SHINGLES = 500_000
BATCH_TEXTS = 5_000
CACHE_WORDS = 100_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ORDER = np.random.default_rng(20250311).integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    """Hashes of words seen before; forgotten beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingle_set(data: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; of a text of fewer words the hash of all of them."""
    words = data.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(words))):
        h += hashes[i:i + n] * _ORDER[i]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = np.sort((h ^ (h >> np.uint64(29))).view(np.int64))
    return h[np.r_[True, h[1:] != h[:-1]]]


def window(n: int, percent: int) -> int:
    """How many of its first shingles a point of ``n`` is replicated to."""
    return n + (-percent * n) // 100 + 1  # n - ceil(percent n / 100) + 1


POINTS = "key string, row long, raw string, digest binary, n int, first array<long>, further array<long>"
_POINTS = pa.schema([("key", pa.string()), ("row", pa.int64()), ("raw", pa.string()), ("digest", pa.binary()), ("n", pa.int32()),
                     ("first", pa.list_(pa.int64())), ("further", pa.list_(pa.int64()))])
_SETS = pa.schema([("row", pa.int64()), ("set", pa.list_(pa.int64()))])


def points(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """A row per document: id, row, md5 of the text, the set's digest and size, its shingles that come first in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in some_rows(batches):
            for key, row, raw, data in zip(part["key"], part["row"], part["raw"], part["data"], strict=True):
                found = shingle_set(data)
                early = found % FIRST == 0
                first, late = found[early], found[~early]
                if 100 * len(found) < percent * (len(found) + 1):  # too few to link with any other set
                    first = late = found[:0]
                lack = max(0, window(len(found), percent) - len(first))
                held.append((key, row, raw, hashlib.blake2b(found.tobytes(), digest_size=16).digest(), len(found),
                             first, late[:lack].copy()))  # a view would keep all of the text's shingles
                size += len(first) + lack
                if size >= BATCH_SHINGLES or len(held) >= BATCH_TEXTS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
        _HASHES.clear()  # a worker goes on to other tasks

    def flush(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(_POINTS.names, zip(*held, strict=True), strict=True)), _POINTS)

    body = text_or_empty(text)
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("key"), F.monotonically_increasing_id().alias("row"),
                       F.md5(body.cast("binary")).alias("raw"), body.cast("binary").alias("data"))
    return shipped(rows).mapInArrow(run, POINTS)


def first_regions(rows: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(region, row, n): the regions of single shingles that two points or more are replicated to.

    Shingles are counted over all documents, copies too: any count makes an order, also
    one by the upper ``COUNTED`` bits of a hash, which is all that is shuffled to count
    them. A shingle counted once is held by one document alone; one that shares these
    bits with another's is merely not left out here. Only ids and hashes are shuffled
    with the counts; ``reps`` has the row of each point.
    """
    need = F.expr(f"n - cast(ceil({percent} * n / 100.0) as int) + 1")
    held = rows.select("row", F.explode("first").alias("region"))
    upper = F.shiftrightunsigned("region", 64 - COUNTED)
    shared = held.groupBy(upper.alias("upper")).agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    own = held.join(shared, upper == F.col("upper")).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("held", "region"))).alias("own"))
    meta = rows.select("row", "n", F.size("first").alias("early")).join(reps, "row")
    own = own.join(meta, "row")
    # shingles that no other document has come before the shared ones
    left = (need - (F.col("early") - F.size("own"))).cast("int")
    near = own.filter(left > 0).select("row", "n", (F.col("early") - F.size("own")).alias("before"), F.posexplode(
        F.slice("own", F.lit(1), left)).alias("at", "own")).select(F.col("own.region").alias("region"), "row", "n", "before", "at")
    far = rows.filter(F.size("further") > 0).join(reps, "row").select(
        "row", "n", F.size("first").alias("before"), F.posexplode("further").alias("at", "region")).select(
        "region", "row", "n", "before", "at")
    core = F.expr(f"n - cast(ceil({2 * percent} * n / {100 + percent}.0) as int) + 1")
    every = staged(near.union(far).select("region", "row", "n", (F.col("before") + F.col("at") < core).alias("core")), "ngram_windows")
    live = every.groupBy("region").agg(F.count(F.lit(1)).alias("held"), F.max("core").alias("core")).filter("held > 1 and core")
    return packed(every.drop("core").join(live.select("region"), "region"), every.count())


def similar(a: Column, b: Column, common: Column, percent: int) -> Column:
    return 100 * common >= percent * (a + b - common)


def _fits(a: Column, b: Column, percent: int) -> Column:
    """Sizes that a linked pair can have."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def star_links(regions: DataFrame, sets: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of each region's pivot, the point that shares most; and the regions with their pivot."""
    most = regions.count()
    sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("held"))
    reach = regions.join(sizes, "region").groupBy("row").agg(F.sum("held").alias("reach"))
    known = staged(packed(regions.join(reach, "row"), most), "ngram_reach")
    lead = known.groupBy("region").agg(F.max(F.struct("reach", "row", "n")).alias("pivot"))
    known = known.join(lead, "region").select("region", "row", "n", F.col("pivot.row").alias("pivot"), F.col("pivot.n").alias("pivot_n"))
    known = staged(packed(known, most), "ngram_stars")
    pairs = known.filter((F.col("row") != F.col("pivot")) & _fits(F.col("n"), F.col("pivot_n"), percent)).select(
        F.col("pivot").alias("a"), F.col("row").alias("b")).distinct()
    left = sets.select(F.col("row").alias("b"), F.col("set").alias("set_b"))
    right = sets.select(F.col("row").alias("a"), F.col("set").alias("set_a"))
    both = pairs.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.filter(similar(F.size("set_a"), F.size("set_b"), common, percent)).select("a", "b"), known


def mixed(regions: DataFrame, labels: DataFrame) -> DataFrame:
    """The regions (region, row, n) whose points aren't all of one component, with the points' labels."""
    known = regions.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "region", "row", "n", F.coalesce("label", "row").alias("label"))
    open_ = known.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("region")
    return known.join(open_, "region")


def gathered(regions: DataFrame, most: int) -> DataFrame:
    """The regions (region, row, n, label; ``most`` rows), all that have one hub as one: the hub of a region is its point with most regions.

    Near copies share many shingles and mostly one hub, so a point's set is sent to few
    regions; the points of a gathered region all share a shingle with its hub.
    """
    known = staged(packed(regions, most), "ngram_mixed")
    reach = known.groupBy("row").agg(F.count(F.lit(1)).alias("reach"))
    hubs = known.join(reach, "row").groupBy("region").agg(F.max(F.struct("reach", "row"))["row"].alias("hub"))
    return packed(known.join(hubs, "region").select(F.col("hub").alias("region"), "row", "n", "label").distinct(), known.count())


class _Joined:
    """Union-find over the labels of a block; remembers the links that joined two components."""

    def __init__(self, labels: np.ndarray):
        _, self.of = np.unique(labels, return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def add(self, i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            if self.of[i] != self.of[j]:
                self.of[self.of == self.of[j]] = self.of[i]
                self.links.append((i, j))


def overlaps(mark: np.ndarray, flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> np.ndarray:
    """How many marked shingles each of some points has."""
    sizes = ends[which + 1] - ends[which]
    begins = np.cumsum(sizes) - sizes
    if not len(which):
        return begins
    at = np.arange(int(sizes.sum())) + np.repeat(ends[which] - begins, sizes)
    return np.add.reduceat(mark[flat[at]], begins)


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of all shingles one set after another, the sets' bounds, and how many numbers there are."""
    seen, flat = np.unique(np.concatenate(sets), return_inverse=True)
    return flat, np.r_[0, np.cumsum([len(s) for s in sets])], len(seen)


def join_block(sets: list[np.ndarray], labels: np.ndarray, percent: int = PERCENT, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the components of a block's points; with ``side`` only pairs across the two sides count.

    Points are taken by size. A point is compared with the larger ones that its size,
    its component and the triangle windows of the points compared before leave over.
    """
    n = np.array([len(s) for s in sets])
    by_size = np.argsort(n, kind="stable")
    sets, n, labels = [sets[i] for i in by_size], n[by_size], labels[by_size]
    side = None if side is None else side[by_size]
    flat, ends, count = _flat(sets)
    joined, radius = _Joined(labels), 1 - percent / 100 + 1e-9
    upto = np.searchsorted(percent * n, 100 * n, side="right")  # the larger points that fit
    known: list[np.ndarray] = []  # distances of all points to some compared with all
    mark = np.zeros(count, np.int64)
    for i in range(len(sets)):
        later = np.arange(i + 1, upto[i])
        later = later[joined.of[later] != joined.of[i]]
        if side is not None:
            later = later[side[later] != side[i]]
        for distance in known:
            later = later[np.abs(distance[later] - distance[i]) <= radius]
        if not len(later):
            continue
        mark[flat[ends[i]:ends[i + 1]]] = 1
        pivot = len(known) < 3 and len(later) > 64
        others = np.arange(len(sets)) if pivot else later
        common = overlaps(mark, flat, ends, others)
        mark[flat[ends[i]:ends[i + 1]]] = 0
        if pivot:
            known.append(1 - common / (n + n[i] - common))
            common = common[later]
        joined.add(i, later[100 * common >= percent * (n[later] + n[i] - common)])
    return [(int(by_size[i]), int(by_size[j])) for i, j in joined.links]


LINKS = "a long, b long"


def _block_links(pdf: pd.DataFrame, percent: int, sided: bool) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("row")
    rows = pdf["row"].to_numpy()
    links = join_block([np.asarray(s, np.int64) for s in pdf["set"]], pdf["label"].to_numpy(), percent,
                       pdf["side"].to_numpy() if sided and pdf["side"].nunique() > 1 else None)
    return pd.DataFrame([(rows[i], rows[j]) for i, j in links], columns=["a", "b"]).astype("int64")


def leaf_links(regions: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of small regions; a task joins several, one after another. Regions of the same points are joined once."""
    key = regions.groupBy("region").agg(F.array_sort(F.collect_list("row")).alias("rows"), F.sum("n").alias("total"))
    once = key.groupBy("rows").agg(F.min("region").alias("region"), F.first("total").alias("total")).select("region", "total")
    once = staged(packed(once, regions.count()), "ngram_leaves")
    batches = (once.agg(F.sum("total")).first()[0] or 0) // LEAF + 1
    members = regions.join(once, "region").join(sets, "row").select(
        F.pmod(F.xxhash64("region"), F.lit(batches)).alias("batch"), "region", "row", "label", "set")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_block_links(part, percent, False) for _, part in pdf.groupby("region", sort=False)])

    return members.groupBy("batch").applyInPandas(run, LINKS)


def _blocks(share: int) -> Column:
    """Into how many parts of a ``share``-th of a leaf a region is dealt."""
    return F.greatest(F.ceil(share * F.col("total") / LEAF), F.ceil(share * F.col("held") / CROWD)).cast("int")


def block_links(regions: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of large regions whose points no pivot parts: every two blocks of a region in one task."""
    dealt = regions.join(sizes.select("region", _blocks(2).alias("blocks")), "region").withColumn(
        "side", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("region", "row", "label", "side", other)
    pairs = pairs.withColumn("one", F.least("side", "other")).withColumn("two", F.greatest("side", "other"))
    rows = pairs.join(sets, "row").select("region", "one", "two", "row", "label", "side", "set")
    return rows.groupBy("region", "one", "two").applyInPandas(lambda pdf: _block_links(pdf, percent, True), LINKS)


CELLS = "region long, row long, n int, cell long, ring int, link boolean"


def cells(regions: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, depth: int) -> DataFrame:
    """Voronoi cells of large regions, with their windows, and the pivots' links (``link``: of row and cell)."""
    dealt = regions.join(sizes.select("region", F.least(_blocks(2), F.lit(PIVOTS)).alias("pivots"),
                                      _blocks(2).alias("blocks")), "region")
    lot = F.xxhash64(F.lit(depth), "row")
    lead = dealt.groupBy("region", F.pmod(lot, F.col("pivots")).alias("slot")).agg(
        F.min(F.struct(lot.alias("lot"), F.col("row"))).alias("lead"), F.first("blocks").alias("blocks"))
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    leads = lead.select("region", F.col("lead.row").alias("row"), block, F.lit(True).alias("pivot")).join(
        dealt.select("region", "row", "n", "label"), ["region", "row"])
    # the lot of the pivots can't deal the blocks too
    members = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(-1), "row"), F.col("blocks")).cast("int")).withColumn("pivot", F.lit(False))
    columns = ["region", "row", "block", "pivot", "n", "label"]
    rows = members.select(*columns).union(leads.select(*columns)).join(sets, "row")
    radius = 1 - percent / 100

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        is_pivot = pdf["pivot"].to_numpy()
        leads, own = pdf[is_pivot], pdf[~is_pivot]
        own = own[~own["row"].isin(leads["row"])]
        every = pd.concat([leads, own])
        held, n, names = [np.asarray(s, np.int64) for s in every["set"]], every["n"].to_numpy(), every["row"].to_numpy()
        flat, ends, count = _flat(held)
        k, joined = len(leads), _Joined(every["label"].to_numpy())
        far = np.ones((len(every), k))
        for p in range(k):
            mark = np.zeros(count, np.int64)
            mark[flat[ends[p]:ends[p + 1]]] = 1
            common = overlaps(mark, flat, ends, np.arange(len(every)))
            far[:, p] = 1 - common / (n + n[p] - common)
            joined.add(p, np.flatnonzero(100 * common >= percent * (n + n[p] - common)))
        region, out = int(every["region"].iloc[0]), []
        for i in range(k, len(every)):
            home = int(far[i].argmin())
            for p in np.flatnonzero(far[i] <= far[i, home] + 2 * radius + 1e-9).tolist():
                out.append((region, names[i], n[i], names[p], int(far[i, p] / (radius + 1e-9)), False))
        out += [(region, names[i], 0, names[j], 0, True) for i, j in joined.links]
        return pd.DataFrame(out, columns=[c.split()[0] for c in CELLS.split(", ")])

    return rows.groupBy("region", "block").applyInPandas(split, CELLS)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with their component; a point without links is one of its own."""
    return rows.drop("label").join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))


def region_links(regions: DataFrame, sets: DataFrame, links: DataFrame, percent: int = PERCENT) -> list[DataFrame]:
    """Links within regions (region, row, n, label) besides those known, joined recursively; staged tables (a, b)."""
    found, columns = [], ["region", "row", "n", "label"]
    for depth in range(DEPTH + 1):
        regions = staged(regions.select(*columns), "ngram_regions")
        sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("total"))
        sizes = staged(packed(sizes, regions.count()), "ngram_sizes")
        small = ((F.col("total") <= LEAF) & (F.col("held") <= CROWD)) | (F.col("held") <= FEW)
        found.append(staged(leaf_links(regions.join(sizes.filter(small).select("region"), "region"), sets, percent), "ngram_links"))
        large = sizes.filter(~small)
        if large.isEmpty():
            break
        rest = regions.join(large.select("region"), "region")
        if depth == DEPTH:
            found.append(staged(block_links(rest, large, sets, percent), "ngram_links"))
            break
        split = staged(cells(rest, large, sets, percent, depth), "ngram_cells")
        found.append(split.filter("link").select(F.col("row").alias("a"), F.col("cell").alias("b")))
        labels = components(_union(regions.sparkSession, [links, *found]))
        parted = _labelled(split.filter("not link"), labels).withColumn(
            "ring", F.explode(F.array("ring", F.col("ring") - 1))).withColumn("part", F.xxhash64("region", "cell", "ring"))
        # a ring of one component is done
        mixed_ = parted.groupBy("part").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("part")
        most = 2 * split.count()  # a cell's own ring and the next
        parted = staged(packed(parted.join(mixed_, "part").select("region", "part", "row", "n", "label"), most), "ngram_rings")
        left = staged(packed(parted.select(*columns).distinct(), most), "ngram_left")
        points_left = left.groupBy("region").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("total"))
        made = parted.groupBy("region").agg(F.count(F.lit(1)).alias("made"))
        stuck = points_left.join(made, "region").filter(F.col("made") > SPREAD * F.col("held"))
        stuck = staged(packed(stuck, most), "ngram_stuck")
        found.append(staged(block_links(left.join(stuck.select("region"), "region"), stuck, sets, percent), "ngram_links"))
        regions = parted.join(stuck.select("region"), "region", "left_anti").drop("region").withColumnRenamed("part", "region")
    return found


def _union(spark: SparkSession, tables: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], LINKS)
    for t in tables:
        out = out.union(t.select("a", "b"))
    return out


def join(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = docs.sparkSession
    rows = staged(points(docs, text, percent), "ngram_points")
    same = rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("row"), F.min(F.col("key").cast("long")).alias("least"))
    same = staged(packed(same, rows.count()), "ngram_same")
    regions = staged(first_regions(rows, same.select("row"), percent), "ngram_regions")
    live = rows.select("row", "key", "raw").join(regions.select("row").distinct(), "row").select(
        "row", "raw", F.coalesce("key", F.lit("")).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in some_rows(batches):
            yield pa.RecordBatch.from_pydict({"row": part["row"], "set": [shingle_set(t) for t in part["data"]]}, _SETS)
        _HASHES.clear()

    body = text_or_empty(text)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("key"),
                        F.md5(body.cast("binary")).alias("raw"), body.cast("binary").alias("data"))
    wanted = live.groupBy("key", "raw").agg(F.min("row").alias("row"))
    wanted = staged(packed(wanted, regions.count()), "ngram_wanted")
    texts = among(texts, wanted, "raw").join(wanted, ["key", "raw"])
    found = shipped(texts.select("row", "data")).mapInArrow(run, "row long, set array<long>")
    sets = staged(found.dropDuplicates(["row"]), "ngram_sets")
    links, stars = star_links(regions, sets, percent)
    links = staged(links, "ngram_links")
    labels = components(links)
    left = mixed(stars.filter(F.col("row") != F.col("pivot")).select("region", "row", "n"), labels)
    more = region_links(gathered(left, stars.count()), sets, links, percent)
    every = _union(spark, [links, *more])
    if any(not t.isEmpty() for t in more):
        labels = components(every)
    known = same.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "digest", F.coalesce("label", "row").alias("label"), "least")
    known = staged(known, "ngram_labels")
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = known.join(least, "label").select("digest", "component_id")
    doc = F.col("key").cast("long")
    some = rows.filter("n > 0").select("key", "n", "digest").join(ids, "digest").select(
        doc.alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id")
    none = rows.filter("n = 0").select(doc.alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), doc.alias("component_id"))
    return some.union(none)
