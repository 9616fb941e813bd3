"""URL filters by a Bloom filter cascade.

Rules are strings ``host/path``. The keys looked up for a url are the suffixes of
its host joined with prefixes of its path, of the lengths that occur among the
rules, so a rule of any shape is found. The distinct keys of the whole corpus are
the universe. Level 1 encodes the listed keys; level 2 the universe's other keys
that level 1 lets through; level 3 the listed keys that level 2 lets through, and
so on until a level lets nothing wrong through. For every key of the universe the
walk down the levels is then exact, with no join against the list.

Each level is cut by key hash into bit arrays of ``PART_BITS`` at most, a row a part,
made and read by Spark alone: the driver holds the number of keys of a level and of its
parts, at any length of the list. A url's keys meet their part of each level by its
number, never the list; Spark broadcasts a level that is small and shuffles by part
otherwise, and a part that hot keys fill is split by adaptive execution.

Defined results: a null url, or one without ``://``, has an empty host and path and
matches no rule; pages and rules may be empty; equal rows are kept; other columns
are ignored. A rule listed under both actions blocks. Only DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_KEY = 10
HASHES = 3
PART_BITS = 1 << 20  # 128 KB


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(url, PARTS, 2)


def rule_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The (host labels, path length) pairs among the rules: as many as their labels and path lengths allow."""
    slash = F.locate("/", "rule")
    host = F.when(slash > 0, F.substring("rule", F.lit(1), slash - 1)).otherwise(F.col("rule"))
    shapes = rules.select(F.size(F.split(host, r"\.")).alias("labels"), (F.length("rule") - F.length(host)).alias("path"))
    return sorted(map(tuple, shapes.distinct().collect()))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a url that could be rules: its last labels, the first characters of its path."""
    labels = F.split(host, r"\.")
    keys = [F.when((F.size(labels) >= n) & (F.length(path) >= m),
                   F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m))) for n, m in shapes]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def _places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + i)), F.lit(bits)) for i in range(HASHES)]


def _part(key: Column, level: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level * 64 + HASHES)), F.lit(parts))


@dataclass
class Level:
    """``table`` has a row a part: its number and the words of its bit array."""

    table: DataFrame
    number: int
    parts: int
    bits: int

    @classmethod
    def build(cls, keys: DataFrame, number: int, n: int, part_bits: int) -> "Level":
        parts = max(1, math.ceil(n * BITS_PER_KEY / part_bits))
        bits = max(64, 64 * math.ceil(n * BITS_PER_KEY / parts / 64))
        key, words = F.col("key"), bits // 64
        places = keys.select(_part(key, number, parts).alias("part"), F.explode(F.array(*_places(key, number, bits))).alias("p"))
        word = F.expr("shiftleft(1L, cast(p % 64 as int))")
        held = places.select("part", F.expr("p div 64").alias("w"), word.alias("v"))
        every = keys.sparkSession.range(parts * words).select(
            F.expr(f"id div {words}").alias("part"), (F.col("id") % words).alias("w"), F.lit(0).cast("long").alias("v"))
        rows = held.unionByName(every).groupBy("part", "w").agg(F.bit_or("v").alias("v"))
        # a part's words, at most PART_BITS / 64 of them
        table = rows.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("words"))
        return cls(staged(table, "url_level"), number, parts, bits)

    def mark(self, rows: DataFrame, name: str, key: str = "key", spread: str = "key") -> DataFrame:
        """Adds whether the level lets the key through; a null key, which goes to a part by ``spread``, isn't."""
        part = F.when(F.col(key).isNotNull(), _part(F.col(key), self.number, self.parts)).otherwise(
            F.pmod(F.xxhash64(spread), F.lit(self.parts)))
        both = rows.withColumn("_part", part).join(self.table.toDF("_part", "_words"), "_part", "left")
        hit = F.col(key).isNotNull()
        for p in _places(F.col(key), self.number, self.bits):
            word = F.get("_words", F.floor(p / 64).cast("int"))
            hit = hit & (F.getbit(word, (p % 64).cast("int")) == 1)
        return both.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(name))


class Cascade:
    """Exact membership of a list in a universe of keys, by levels of Bloom filters."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def fit(cls, universe: DataFrame, listed: DataFrame, part_bits: int = PART_BITS) -> "Cascade":
        """``universe`` and ``listed`` hold distinct ``key``s."""
        made: list[Level] = []
        yes, no = staged(listed.join(universe, "key", "left_semi"), "url_listed"), universe.join(listed, "key", "left_anti")
        while (n := yes.count()) or not made:
            made.append(Level.build(yes, len(made), n, part_bits))
            # what this level lets through wrongly is what the next one encodes
            yes, no = staged(made[-1].mark(no, "passes").filter("passes").select("key"), "url_wrong"), yes
        return cls(made)

    def mark(self, rows: DataFrame, name: str, key: str = "key", spread: str = "key") -> DataFrame:
        """Adds whether the key is listed: the first level that doesn't let it through decides by its parity."""
        passes = [f"_{name}_{level.number}" for level in self.levels]
        out = rows
        for level, column in zip(self.levels, passes, strict=True):
            out = level.mark(out, column, key, spread)
        result = F.lit(len(self.levels) % 2 == 1)
        for level, column in reversed(list(enumerate(passes))):
            result = F.when(F.col(column), result).otherwise(F.lit(level % 2 == 1))
        return out.select(*rows.columns, (F.col(key).isNotNull() & result).alias(name))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", part_bits: int = PART_BITS) -> DataFrame:
    """page_id, host, path, rule, verdict for every page; ``rules`` holds (rule, action).

    The longest fitting rule wins (of equal ones the first by code point); a url
    that no listed key covers is outside the list and gets ``default``.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = rules.filter("rule is not null").groupBy("rule").agg(F.min(F.col("action") != "block").alias("allowed"))
    keys = candidate_keys(F.col("host"), F.col("path"), rule_shapes(rules))
    # row numbers are fixed by writing them: equal pages stay apart
    rows = staged(parts.select("*", F.monotonically_increasing_id().alias("row"), keys.alias("keys")), "url_rows")
    universe = staged(rows.select(F.explode("keys").alias("key")).distinct(), "url_universe")
    asked = rows.select("row", "page_id", "host", "path", F.explode_outer("keys").alias("key"))
    for name, cond in (("blocked", "not allowed"), ("listed", "allowed")):
        found = Cascade.fit(universe, rules.filter(cond).select(F.col("rule").alias("key")), part_bits)
        asked = found.mark(asked, name, spread="row")
    # the best is the longest, then the first by code point; a page's keys meet in the task that made them
    offer = F.when(F.col("blocked") | F.col("listed"),
                   F.struct((-F.length("key")).alias("n"), F.col("key").alias("rule"), "blocked"))
    best = asked.groupBy("row", "page_id", "host", "path").agg(F.min(offer).alias("best"))
    verdict = (F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocked"), F.lit("block"))
               .otherwise(F.lit("allow")))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
