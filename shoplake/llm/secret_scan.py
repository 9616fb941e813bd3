"""Secret scans with corpus-wide ownership frequency.

Three base kinds are found in every whole text: ``assign`` (a keyword, a sign and
a value), ``access`` and ``hex``. Two more kinds of candidate are read besides:
``jwt`` (three base64url parts) and ``mixed`` (long runs that mix cases and
digits). The secret of every hit is hashed and counted over the corpus by distinct
repositories and owners: one that ``COMMON_OWNERS`` owners or ``COMMON_REPOS``
repositories or more share, be they of one owner, is a widely copied example, any
other is live-looking. The extra kinds are reported only where they are
live-looking; base hits are always reported and carry the class. Every reported
hit comes with its secret's two counts.

Only DataFrame functions. Texts are never shuffled by ``scan``: each document gives
its hits in a narrow step, and only the hits move. Distinct owners and repositories
of a secret are combined in the map tasks first, so a secret that a third of all
rows hold is no hot group.

Defined results: a null text is read as empty; equal rows give equal rows; null
owners or repositories count as one more owner or repository; an empty table gives
an empty table; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import fresh_name, staged, text_or_empty

# The base patterns and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]+"
HEX_LEAST = 24
KINDS = ("assign", "access", "hex")
# The method's own candidates.
JWT = r"\bey[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
# looks ahead within the run only, so that a text without white space is read in one pass
MIXED = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
         r"[A-Za-z0-9+/_-]{32,}")
COMMON_OWNERS = 3
COMMON_REPOS = 4
HIT = "struct<start:long,order:int,kind:string,end:long,secret:string>"


def _hits(text: Column, kind: str, order: int, pattern: str, secret_group: int, least: int, gate: str) -> Column:
    """All leftmost non-overlapping matches as (start, order, kind, end, secret), in code points.

    The pieces between the matches and the matches themselves give the offsets.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    secrets = F.regexp_extract_all(text, F.lit(pattern), F.lit(secret_group)) if secret_group else found
    rows = F.zip_with(F.slice(pieces, 1, F.size(found)), F.arrays_zip(found.alias("m"), secrets.alias("s")),
                      lambda p, m: F.struct(F.length(p).alias("gap"), m["m"].alias("m"), m["s"].alias("s")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{HIT}>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        first = acc["at"] + row["gap"]
        end = first + F.length(row["m"])
        hit = F.struct(first.alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), end.alias("end"),
                       row["s"].alias("secret"))
        return F.struct(end.cast("long").alias("at"),
                        F.when(F.length(row["s"]) >= least, F.concat(acc["out"], F.array(hit.cast(HIT))))
                        .otherwise(acc["out"]).alias("out"))

    none = F.array().cast(f"array<{HIT}>")
    return F.when(F.regexp_like(text, F.lit(gate)), F.aggregate(rows, start, step, lambda acc: acc["out"])).otherwise(none)


def find(text: Column) -> tuple[Column, Column]:
    """Base hits and the method's further candidates of a text.

    For access and hex a dropped short match leaves nothing behind that a pattern
    with the least length would find, so that pattern is used; for assign the short
    matches are found and dropped.
    """
    hexes, keys = HEX.replace("+", f"{{{HEX_LEAST},}}"), ACCESS.replace("+", f"{{{ACCESS_LEAST - 4},}}")
    base = F.concat(_hits(text, "assign", 0, ASSIGN, 2, ASSIGN_LEAST, ASSIGN),
                    _hits(text, "access", 1, keys, 0, ACCESS_LEAST, keys), _hits(text, "hex", 2, hexes, 0, HEX_LEAST, hexes))
    more = F.concat(_hits(text, "jwt", 3, JWT, 0, 1, JWT), _hits(text, "mixed", 4, MIXED, 0, 32, MIXED))
    return base, more


def _spans(hits: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(hits), lambda h: F.concat_ws(
        ":", h["kind"], h["start"].cast("string"), h["end"].cast("string"))), ",")


def hits_by_document(docs: DataFrame, text: str = "text", repo: Column | None = None, owner: Column | None = None,
                     common_owners: int = COMMON_OWNERS, common_repos: int = COMMON_REPOS,
                     extra: list[Column] | None = None) -> DataFrame:
    """One row per document with ``base`` and ``added`` hits, ``common`` and ``shared``.

    ``common`` has the starts and kinds of copied examples, ``shared`` the owners and
    repositories of each hit whose secret has more than one of either.
    """
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    base, more = find(text_or_empty(text))
    rows = staged(docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("row"),
                              F.coalesce(repo.cast("string"), F.lit("\u0000")).alias("repo"),
                              F.coalesce(owner.cast("string"), F.lit("\u0000")).alias("owner"),
                              base.alias("base"), more.alias("more"), *(extra or [])), "secret_hits")
    every = (rows.filter(F.size("base") + F.size("more") > 0)
             .select("row", "repo", "owner", F.explode(F.concat("base", "more")).alias("hit"))
             .withColumn("hash", F.sha2("hit.secret", 256)))
    freq = every.groupBy("hash").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repo").alias("repos"))
    freq = freq.filter((F.col("owners") > 1) | (F.col("repos") > 1)
                       | (F.col("owners") >= common_owners) | (F.col("repos") >= common_repos))
    judged = every.drop("owner", "repo").join(freq, "hash").groupBy("row").agg(
        F.collect_list(F.struct("hit.start", "hit.kind", "owners", "repos")).alias("shared"))
    out = rows.join(judged, "row", "left").drop("repo", "owner")
    none = F.array().cast("array<struct<start:long,kind:string,owners:long,repos:long>>")
    out = out.withColumn("shared", F.coalesce("shared", none))
    copied = F.filter("shared", lambda h: (h["owners"] >= common_owners) | (h["repos"] >= common_repos))
    out = out.withColumn("common", F.transform(copied, lambda h: F.struct(h["start"].alias("start"), h["kind"].alias("kind"))))
    fresh = F.filter("more", lambda h: ~F.array_contains(F.col("common"), F.struct(h["start"], h["kind"])))
    return out.withColumn("added", fresh)


def _spread(hits: Column) -> Column:
    """Owners/repositories of every hit's secret, in the order of the spans."""
    def counts(h: Column) -> Column:
        held = F.get(F.filter("shared", lambda s: (s["start"] == h["start"]) & (s["kind"] == h["kind"])), F.lit(0))
        return F.concat_ws("/", F.coalesce(held["owners"], F.lit(1)).cast("string"),
                           F.coalesce(held["repos"], F.lit(1)).cast("string"))

    return F.array_join(F.transform(F.array_sort(hits), counts), ",")


def scan(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, spread, n_live, n_example of every document."""
    rows = hits_by_document(docs, text, **how)
    of = lambda k: F.size(F.filter("base", lambda h: h["kind"] == k)).cast("long")
    every = F.concat("base", "added")
    return rows.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS],
                       F.sha2(_spans(F.col("base")), 256).alias("base_sha256"), _spans(every).alias("spans"),
                       _spread(every).alias("spread"),
                       (F.size(every) - _copied(every)).cast("long").alias("n_live"),
                       _copied(every).cast("long").alias("n_example"))


def _copied(hits: Column) -> Column:
    return F.size(F.filter(hits, lambda h: F.array_contains(F.col("common"), F.struct(h["start"], h["kind"]))))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **how) -> DataFrame:
    """The documents with every live-looking hit replaced by ``mark``; copied examples stay.

    Overlapping hits become one mark. Only documents that hold a hit are matched with
    their spans; all others pass through unmoved. Equal texts of one doc_id share
    their spans.
    """
    key, spans = fresh_name(docs, "secret_key"), fresh_name(docs, "secret_spans")
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("n")), text_or_empty(text))
                   .cast("binary"))
    rows = hits_by_document(docs, text, extra=[digest.alias("row_key")], **how)
    live = F.filter(F.concat("base", "added"),
                    lambda h: ~F.array_contains(F.col("common"), F.struct(h["start"], h["kind"])))
    live = F.transform(F.array_sort(live), lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end")))
    cut = (rows.withColumn("live", live).filter(F.size("live") > 0).groupBy("row_key")
           .agg(F.first("live").alias(spans)).withColumnRenamed("row_key", key))
    out = docs.withColumn(key, digest).join(cut, key, "left")
    body = text_or_empty(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(body, (acc["at"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["end"] <= acc["at"], acc["out"])
                        .when(s["start"] < acc["at"], acc["out"])
                        .otherwise(F.concat(acc["out"], gap, F.lit(mark))).alias("out"))

    clean = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(
        acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), F.length(body))))
    out = out.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(
            F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
