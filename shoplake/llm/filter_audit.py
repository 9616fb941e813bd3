"""Filter interaction audit by count-weighted decision diagrams.

Every document gives a failure mask, one bit for each filter. A part's masks are
counted (all documents, those of label quality 1, those of label toxic 1) and become
a decision diagram: a level for each filter, a node for each different rest of the
masks, a weight on every node that says how many documents come through it. Subtrees
without documents are one empty node, equal subtrees are shared. All orders of the
filters are visited by swaps of two adjacent levels, each of which rebuilds one level
and leaves all others as they are. In every order the path on which each filter passes
gives the steps: the weight that branches off at a level is what its filter removes,
the weight that goes on is what it keeps. Orders in which a filter comes first and
last give its failures and those that no other filter catches.

Texts are read once, in a narrow step; only ids, hashes and masks are shuffled. Masks
are counted in the map tasks first, so a part that holds a third of all rows sends a
few rows a task. A part's diagram has at most ``2 ** filters`` masks.

Defined results: a null text is read as empty; parts are the values of the part
column, null and the empty text are one part; a null doc_id is larger than every
other, so of copies that all lack an id none fails E; rows of equal doc_id and text
fail E alike; several labels of one doc_id count as one, 1 where any of them is 1;
labels of a null doc_id are left out; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import shipped, staged, text_or_empty

NAMES = "ABCDE"
LEAST_WORDS = 50
DISTINCT_SHARE = 65  # percent of the words
CAPITAL_SHARE = 5  # percent of the characters
SIGNS = r"[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"


def text_failures(text: str = "text") -> list[Column]:
    """Conditions A to D on the columns ``body`` and ``words`` that ``masked`` makes."""
    words, chars = F.size("words"), F.length("body")
    return [words < LEAST_WORDS,
            100 * F.size(F.array_distinct("words")) < DISTINCT_SHARE * words,
            100 * F.length(F.regexp_replace("body", "[^A-Z]+", "")) > CAPITAL_SHARE * chars,
            F.regexp_like("body", F.lit(SIGNS))]


def _bits(conditions: list[Column], first: int = 0) -> Column:
    total = F.lit(0)
    for i, failed in enumerate(conditions):
        total = total + F.when(failed, 1 << (first + i)).otherwise(0)
    return total


def masked(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """part, mask (bit i: filter i fails), good and toxic of every document; a staged table of short rows."""
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       text_or_empty(text).alias("body"))
    split = body.select("doc_id", "part", "body", F.array_remove(F.split("body", SPACE), "").alias("words"))
    rows = staged(split.select("doc_id", "part", F.unhex(F.sha2("body", 256)).alias("hash"),
                               _bits(text_failures()).alias("mask")), "audit_masks")
    first = rows.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                     F.count_if(F.col("doc_id").isNull()).alias("unnamed"))
    first = first.filter((F.col("first") < F.col("last")) | (F.col("first").isNotNull() & (F.col("unnamed") > 0)))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    # written, so that the copies of one text can be split in the join
    first = staged(first.select("hash", "first"), "audit_first")
    rows = rows.join(first, "hash", "left").select(
        "doc_id", "part", (F.col("mask") + _bits([copy], first=4)).alias("mask"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    return rows.join(marks, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def mask_counts(masks: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: the documents of every mask."""
    return masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
                                             F.count_if("toxic").alias("toxic"))


class Diagram:
    """Ordered decision diagram of failure masks; a node is a pair (passes, fails) of nodes of the next level.

    ``levels[i]`` holds the nodes of the filter ``order[i]`` and ``weights[i]`` their
    counts; the level below the last one has the counts themselves. Node 0 of every
    level is the empty one.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int):
        self.order = list(range(filters))
        self.zero = (0,) * len(next(iter(counts.values()), (0, 0, 0)))
        self.levels: list[list[tuple[int, int]]] = [[(0, 0)] for _ in range(filters)]
        self.weights: list[list[tuple[int, ...]]] = [[self.zero] for _ in range(filters + 1)]
        self.tables: list[dict] = [{} for _ in range(filters + 1)]
        self.root = self._build(0, counts)

    def _build(self, level: int, counts: dict[int, tuple[int, ...]]) -> int:
        """Node of the masks that are left, whose lower bits are decided."""
        if not counts:
            return 0
        if level == len(self.order):
            return self._leaf(tuple(map(sum, zip(*counts.values(), strict=True))))
        bit = 1 << level
        parts = [{m: c for m, c in counts.items() if bool(m & bit) == fails} for fails in (False, True)]
        return self._node(level, self._build(level + 1, parts[0]), self._build(level + 1, parts[1]))

    def _leaf(self, count: tuple[int, ...]) -> int:
        if count == self.zero:
            return 0
        table, weights = self.tables[-1], self.weights[-1]
        if count not in table:
            table[count] = len(weights)
            weights.append(count)
        return table[count]

    def _node(self, level: int, passes: int, fails: int) -> int:
        if not (passes or fails):
            return 0
        table = self.tables[level]
        if (passes, fails) not in table:
            table[passes, fails] = len(self.levels[level])
            self.levels[level].append((passes, fails))
            below = self.weights[level + 1]
            self.weights[level].append(tuple(a + b for a, b in zip(below[passes], below[fails], strict=True)))
        return table[passes, fails]

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one; a node keeps its number, so nothing above changes."""
        upper, lower = self.levels[level], self.levels[level + 1]
        grand = [(*lower[p], *lower[f]) for p, f in upper]  # passes both, fails lower, fails upper, fails both
        self.levels[level + 1], self.weights[level + 1], self.tables[level + 1] = [(0, 0)], [self.zero], {}
        self.levels[level] = [(self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)) for pp, pf, fp, ff in grand]
        self.tables[level] = {node: i for i, node in enumerate(self.levels[level]) if i}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, removed, kept) along the path on which every filter passes."""
        node = self.root
        for level, name in enumerate(self.order):
            passes, fails = self.levels[level][node]
            yield name, self.weights[level + 1][fails], self.weights[level + 1][passes]
            node = passes


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels whose swaps, one after another, lead through all orders of ``n`` filters."""
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + 1 if down else at  # the filter that wanders lies before or behind the others
        down = not down


def walk(counts: dict[int, tuple[int, ...]], names: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    diagram = Diagram(counts, len(names))
    orders, total = [], [0] * len(names)
    fails, alone = [0] * len(names), [0] * len(names)

    def visit() -> None:
        steps = list(diagram.steps())
        orders.append(("".join(names[f] for f, _, _ in steps), steps))
        for f, removed, _ in steps:
            total[f] += removed[0]
        fails[steps[0][0]], alone[steps[-1][0]] = steps[0][1][0], steps[-1][1][0]

    visit()
    for level in adjacent_swaps(len(names)):
        diagram.swap(level)
        visit()
    return [(order, i + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], total[f])
            for order, steps in orders for i, (f, removed, kept) in enumerate(steps)]


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
STEPS = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS)


def interactions(counts: DataFrame, names: str = NAMES) -> DataFrame:
    """Steps of all orders of the filters, of every part's mask counts (part, mask, n, good, toxic)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in STEPS.split(", ")]
        for pdf in batches:
            for part, masks in zip(pdf["part"], pdf["masks"], strict=True):
                found = {int(m): (int(n), int(good), int(toxic)) for m, n, good, toxic in masks}
                yield pd.DataFrame([(part, *row) for row in walk(found, names)], columns=columns)

    each = F.array(*[F.col(c).cast("long") for c in ("mask", "n", "good", "toxic")])
    return shipped(counts.groupBy("part").agg(F.collect_list(each).alias("masks"))).mapInPandas(run, STEPS)


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """The five filters' steps in all 120 orders, for every part of the documents."""
    return interactions(mask_counts(masked(docs, labels, text, part)))
