"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target share of all words. Sources (and, within them,
shards of documents) are cut into blocks of equal words; Sainte-Laguë hands out
the blocks by highest quotients ``weight / (2 * seats + 1)``, first to sources,
then to each source's shards. Within a shard the documents lie in seeded order,
and the shard's blocks are taken as a seeded run of consecutive blocks, round
and round: a quota above the number of blocks takes whole passes first.

Only DataFrame functions. No table but the per-source one (a row for each
source) is sorted as a whole; documents are ordered only within a shard. A source has
as many shards as ``shard_words`` of its words or ``SHARD_ROWS`` of its rows ask for,
and a row's shard and place follow a digest of its id, source and text, so a hot
source or a hot id is spread over tasks; texts without words stay out of the shards.

Defined results: a null text has size 0 and takes nothing; a null source is a
source of its own and comes last; equal rows are kept as equal rows (they share a
shard) and of rows with one doc_id each is judged by its own text, alike on every run;
an empty table gives an empty table. Columns besides the three named ones are ignored by
``plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import fresh_name, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)  # by code point order of the sources, repeating
MAX_REPEAT = 3  # a source's target stops at this many times its size
MAX_BLOCK_WORDS = 1024
MIN_BLOCKS = 100  # blocks of the smallest positive target, at least
SHARD_WORDS = 1_000_000
SHARD_ROWS = 100_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def row_digest(text: str) -> Column:
    """A hex digest of a row's id, source and text; rows that agree in it are interchangeable."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("n")),
                             F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")),
                             F.coalesce(F.concat(F.lit("t"), F.col(text).cast("string")), F.lit("n"))).cast("binary"))


def seeded(seed: int, key: Column) -> Column:
    """A hex digest that orders keys at random, the same on every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds ``weight`` and ``target`` to a table of (source, source_size).

    Water-filling in one pass: by ascending ``cap / weight``, a source is held at
    its cap if the words left over, shared by the weights left over, reach it.
    """
    whole = Window.partitionBy(F.lit(0))
    by_name = whole.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("pos", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("pos") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * MAX_REPEAT)
    before = whole.orderBy(F.col("cap") / F.col("weight"), "pos").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    ranked = (ranked.withColumn("total", F.sum(F.col("source_size").cast("double")).over(whole))
              .withColumn("all_w", F.sum("weight").over(whole))
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero))
              .withColumn("w_before", F.coalesce(F.sum("weight").over(before), zero)))
    capped = (F.col("cap") * (F.col("all_w") - F.col("w_before")) + F.col("cap_before") * F.col("weight")
              <= F.col("total") * F.col("weight"))
    ranked = ranked.withColumn("capped", capped)
    held = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), zero)
    held_w = F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(whole), zero)
    share = F.try_divide((F.col("total") - held) * F.col("weight"), F.col("all_w") - held_w)
    return ranked.select(*sources.columns, "pos", "weight",
                         F.when(F.col("capped"), F.col("cap")).otherwise(share).alias("target"))


def sainte_lague(units: DataFrame, group: list[str], unit: str, weight: str, seats: str, out: str) -> DataFrame:
    """Hands ``seats`` (a column, equal within a group) to the units of each group.

    Starts from the rounding by a divisor that gives at most ``seats`` (every such
    rounding is a Sainte-Laguë result for its own sum), then ranks the quotients of
    the seats still open. A unit is offered ``weight * (open + n) / sum + 1`` further
    seats, which it can't exceed, so the offers grow with the number of units only.
    Ties go to the smaller ``unit``.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w, s = F.col(weight).cast("double"), F.col(seats).cast("double")
    df = (units.withColumn("sl_w", F.sum(w).over(whole))
          .withColumn("sl_n", F.count(F.lit(1)).over(whole)))
    share = F.coalesce(F.try_divide(w * F.greatest(F.lit(0.0), s - F.col("sl_n") / 2), F.col("sl_w")), F.lit(0.0))
    # rounding half down: a half is still an open seat
    df = df.withColumn("sl_first", F.greatest(F.lit(0), F.ceil(share - 0.5)).cast("long"))
    df = df.withColumn("sl_open", F.col(seats) - F.sum("sl_first").over(whole))
    more = F.when(w > 0, F.ceil(w * (F.col("sl_open") + F.col("sl_n")) / F.col("sl_w")) + 1).otherwise(0).cast("int")
    offers = df.withColumn("sl_more", more).filter("sl_more > 0 and sl_open > 0").withColumn(
        "sl_j", F.explode(F.sequence(F.lit(0), F.col("sl_more") - 1)))
    offers = offers.withColumn("sl_q", w / (2 * (F.col("sl_first") + F.col("sl_j")) + 1))
    ranks = whole.orderBy(F.col("sl_q").desc(), F.col(unit))
    won = (offers.withColumn("sl_rank", F.row_number().over(ranks)).filter("sl_rank <= sl_open")
           .groupBy(*group, unit).agg(F.count(F.lit(1)).alias("sl_won")))
    keys = [*group, unit]
    return (df.join(won, keys, "left").withColumn(out, F.col("sl_first") + F.coalesce("sl_won", F.lit(0)))
            .drop("sl_w", "sl_n", "sl_first", "sl_open", "sl_won"))


def plan(docs: DataFrame, seed: int = 17, text: str = "text", shard_words: int = SHARD_WORDS,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken and the run taken.

    ``from_word``/``to_word`` bound the run of blocks within the shard (``to_word``
    may run past the shard's end and on from its start), ``at_word`` is where the
    document starts there, ``passes`` the whole passes before the run (null for a
    document without words); ``row_key`` is the row's digest.
    """
    base = staged(docs.select("doc_id", "source", word_count(text).alias("size"), row_digest(text).alias("row_key")), "mix_sizes")
    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("source_rows"))
    src = source_targets(sources)
    whole = Window.partitionBy(F.lit(0))
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(whole)
    src = src.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCK_WORDS), F.floor(least / MIN_BLOCKS))))
    src = src.withColumn("block", F.coalesce("block", F.lit(1)).cast("long"))
    src = src.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words),
                                         F.ceil(F.col("source_rows") / shard_rows)).cast("long"))
    src = src.withColumn("house", F.round(F.sum("target").over(whole) / F.col("block")).cast("long"))
    src = staged(sainte_lague(src, [], "pos", "target", "house", "quota")
                 .select("source", "pos", "source_size", "target", "block", "shards", "quota"), "mix_sources")

    digest = seeded(seed, F.col("row_key"))
    rows = (base.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
            .join(src.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source"),
                  "source_key")
            .withColumn("digest", digest)
            .withColumn("shard", F.pmod(F.conv(F.substring("digest", 25, 8), 16, 10).cast("long"), F.col("shards"))))
    rows = staged(rows.drop("source_key"), "mix_rows")
    empty, rows = rows.filter("size = 0"), rows.filter("size > 0")
    shards = rows.groupBy("pos", "shard").agg(F.sum("size").alias("shard_size"), F.first("block").alias("block"),
                                             F.first("quota").alias("quota"))
    shards = shards.filter("shard_size > 0").withColumn(
        "blocks", F.greatest(F.lit(1), F.round(F.col("shard_size") / F.col("block"))).cast("long"))
    most = F.sum("blocks").over(Window.partitionBy("pos")) * MAX_REPEAT
    shards = shards.withColumn("quota", F.least(F.col("quota"), most))
    shards = sainte_lague(shards, ["pos"], "shard", "blocks", "quota", "seats")
    start = F.pmod(F.conv(F.substring(seeded(seed + 1, F.concat_ws("/", "pos", "shard")), 1, 8), 16, 10).cast("long"),
                   F.col("blocks"))
    at = lambda k: F.floor(k * F.col("shard_size") / F.col("blocks")).cast("long")
    rest = F.col("seats") % F.col("blocks")
    end = start + rest
    to_word = F.when(end <= F.col("blocks"), at(end)).otherwise(F.col("shard_size") + at(end - F.col("blocks")))
    shards = staged(shards.select("pos", "shard", "shard_size", F.floor(F.col("seats") / F.col("blocks")).alias("passes"),
                                  at(start).alias("from_word"), to_word.alias("to_word")), "mix_shards")

    order = Window.partitionBy("pos", "shard").orderBy("digest")
    rows = rows.withColumn("at_word", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.join(shards, ["pos", "shard"], "left").unionByName(empty, allowMissingColumns=True)
    return rows.withColumn("taken", F.coalesce(
        F.col("passes") * F.col("size") + _overlap(F.lit(0)) + _overlap(F.col("shard_size")), F.lit(0)).cast("long"))


def _overlap(shift: Column) -> Column:
    """Words of the document inside the run, with the document moved on by ``shift``."""
    a = F.col("at_word") + shift
    return F.greatest(F.lit(0), F.least(a + F.col("size"), F.col("to_word")) - F.greatest(a, F.col("from_word")))


def mix(docs: DataFrame, seed: int = 17, text: str = "text") -> DataFrame:
    """The mixed documents: whole copies, and at the ends of a run the words inside it.

    A part keeps its words and the white space between them. All columns are kept;
    ``n_chars``, where there is one, follows the text. Rows that agree in doc_id,
    source and text are interchangeable, so they are numbered on both sides.
    """
    key, n, piece_col = (fresh_name(docs, x) for x in ("mix_key", "mix_n", "mix_piece"))
    chosen = plan(docs, seed, text).filter("taken > 0")

    def run(shift: Column) -> Column:
        a = F.col("at_word") + shift
        return F.struct(F.greatest(F.lit(0), F.col("from_word") - a).cast("long").alias("first"),
                        _overlap(shift).cast("long").alias("n"))

    whole = F.struct(F.lit(0).cast("long").alias("first"), F.col("size").cast("long").alias("n"))
    pieces = F.concat(F.array_repeat(whole, F.col("passes").cast("int")), F.array(run(F.lit(0)), run(F.col("shard_size"))))
    chosen = chosen.select(F.col("row_key").alias(key), F.filter(pieces, lambda p: p["n"] > 0).alias(piece_col), "size",
                           F.row_number().over(Window.partitionBy("row_key").orderBy("at_word")).alias(n))
    own = docs.filter(word_count(text) > 0).withColumn(key, row_digest(text))
    own = own.withColumn(n, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    out = own.join(chosen.withColumnRenamed("size", piece_col + "_size"), [key, n])
    out = out.withColumn(piece_col, F.explode(piece_col))
    words = F.regexp_extract_all(F.col(text), F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    first, k = F.col(piece_col)["first"].cast("int"), F.col(piece_col)["n"].cast("int")
    part = F.regexp_replace(F.array_join(F.slice(words, first + 1, k), ""), r"[\x20\x09-\x0D]+$", "")
    out = out.withColumn(text, F.when(k == F.col(piece_col + "_size"), F.col(text)).otherwise(part))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
