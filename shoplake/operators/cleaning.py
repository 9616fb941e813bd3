"""Bronze -> Silver: typing, cleaning rules, keep-latest dedup, partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions.timeparse import date_partitions, parse_event_time, utc_wall
from ..schemas import CORRUPT_COL, PARTITION_COLS, SILVER_TYPES, TX_FIELDS

# --- fixed values -----------------------------------------------------------
# Columns whose absence makes a row unusable in Silver.
CRITICAL = ["transaction_id", "timestamp", "store_id", "product_id", "total_amount"]
# Columns of the preview.
PREVIEW_COLS = ["transaction_id", "timestamp", "store_id", "category", "total_amount", "year", "month", "day"]
# ----------------------------------------------------------------------------

# Keep-latest order: newest event time first, then these columns descending,
# then the rest of the row, so the winner is the same on every run.
LATEST_ORDER = ["timestamp", "product_id", "store_id", "total_amount"]


def type_transactions(df: DataFrame) -> DataFrame:
    """Enforce the 14 Silver types in one projection.

    Text that does not parse becomes NULL instead of failing the job (ANSI
    casts would abort on one bad value). Columns outside the 14 pass through.
    """
    typed = []
    for f in TX_FIELDS:
        if f not in df.columns:
            typed.append(F.lit(None).cast(SILVER_TYPES[f]).alias(f))
        elif f == "timestamp":
            dtype = df.schema[f].dataType.typeName()
            col = (parse_event_time(f) if dtype == "string" else utc_wall(F.col(f)) if dtype == "timestamp"
                   else F.col(f).cast("timestamp_ntz"))
            typed.append(col.alias(f))
        elif SILVER_TYPES[f].typeName() in ("integer", "long") and df.schema[f].dataType.typeName() == "string":
            # '2.0' is the integer 2; a fraction is no integer
            number = F.col(f).try_cast("decimal(38,6)")
            typed.append(F.when(number == F.floor(number), number.try_cast(SILVER_TYPES[f])).alias(f))
        else:
            typed.append(F.col(f).try_cast(SILVER_TYPES[f]).alias(f))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in TX_FIELDS and c != CORRUPT_COL]
    return df.select(*typed, *extra)


def add_date_partitions(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """year / 2-digit month / 2-digit day as text."""
    return df.withColumns(date_partitions(ts_col))


def drop_critical_nulls(df: DataFrame, critical: list[str] = CRITICAL) -> DataFrame:
    """Drop rows where any critical column is NULL."""
    return df.na.drop(how="any", subset=critical)


def valid_amounts(df: DataFrame, col: str = "total_amount") -> DataFrame:
    """total_amount positive and within money's range; NaN and infinity rejected."""
    return df.filter(valid_amount(F.col(col)))


def valid_amount(amount: F.Column) -> F.Column:
    """Above zero and below what DECIMAL(18,2) holds (NaN > 0 is true in Spark)."""
    return (amount > 0) & ~F.isnan(amount) & (amount < F.lit(1e16))


def sales_only(df: DataFrame) -> DataFrame:
    """Drop returns; a NULL flag is not a sale (P5)."""
    return df.filter(F.col("is_return") == F.lit(False))


def clean_rule(df: DataFrame) -> F.Column:
    """The cleaning rules as one predicate (used for single-pass counters)."""
    ok = F.lit(True)
    for c in CRITICAL:
        ok = ok & F.col(c).isNotNull()
    return ok & valid_amount(F.col("total_amount"))


def dedup_latest(df: DataFrame, key: str = "transaction_id", order: list[str] = LATEST_ORDER,
                 within: str | None = None) -> DataFrame:
    """One row per key: the latest by event time, ties broken by ``order``.

    Written as an aggregate of max(struct(order..., rest...)), not a
    row_number window: the (sort) aggregate combines map-side, so a key
    holding a third of all rows is reduced in every task before the shuffle
    instead of being sorted in one task. Order columns that ``df`` lacks
    are left out. ``within`` names a column that equal keys share: rows that a
    join on it has brought together aren't shuffled again. It leaves the result.
    """
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in (key, within) and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in order + rest]).alias("_w")
    win = df.groupBy(*[within] if within else [], key).agg(F.max(packed).alias("_w"))
    return win.select(key, *[F.col(f"_w.`{c}`").alias(c) for c in order + rest]).select(
        *[f"`{c}`" for c in df.columns if c != within])


def to_silver(typed: DataFrame, within: str | None = None) -> DataFrame:
    """Typed rows -> Silver rows (rules, dedup, partition columns)."""
    clean = valid_amounts(drop_critical_nulls(typed))
    return add_date_partitions(dedup_latest(clean, within=within))


def observed_silver(typed: DataFrame, within: str | None = None) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``to_silver``, and a function that gives the stage counters once its first action has run.

    The counters ride on the job that writes Silver: nothing is read twice.
    """
    read, kept = Observation(), Observation()
    watched = typed.observe(read, F.count(F.lit(1)).alias("raw_rows"), F.count_if(clean_rule(typed)).alias("clean_rows"))
    silver = to_silver(watched, within).observe(kept, F.count(F.lit(1)).alias("silver_rows"))

    def counters() -> dict[str, int]:
        raw, clean, rows = read.get["raw_rows"], read.get["clean_rows"], kept.get["silver_rows"]
        return {"raw_rows": raw, "clean_rows": clean, "dropped_quality": raw - clean,
                "silver_rows": rows, "dropped_duplicates": clean - rows}

    return silver, counters


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Raw text rows -> Silver. Typing first, so rules see real values."""
    return to_silver(type_transactions(bronze).select(*TX_FIELDS))


def cleaning_report(typed: DataFrame) -> DataFrame:
    """Stage counters in a single pass over the input.

    raw_rows, clean_rows (after null and amount rules) and silver_rows
    (distinct ids among clean rows = rows after keep-latest dedup).
    """
    ok = clean_rule(typed)
    agg = typed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(ok).alias("clean_rows"),
        F.count_distinct(F.when(ok, F.col("transaction_id"))).alias("silver_rows"),
    )
    return agg.select(
        "raw_rows", "clean_rows", (F.col("raw_rows") - F.col("clean_rows")).alias("dropped_quality"),
        "silver_rows", (F.col("clean_rows") - F.col("silver_rows")).alias("dropped_duplicates"),
    )


def silver_preview(silver: DataFrame, n: int = 5) -> DataFrame:
    """First n Silver rows by id, 8 columns (P10). A global top-n: each task
    keeps n rows, the driver merges n x tasks."""
    return silver.select(*PREVIEW_COLS).orderBy("transaction_id").limit(n)


def line_totals(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """unit = list price x (1 - discount) at scale 4; total = unit x qty in cents."""
    j = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount").join(
        part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    unit = M.discounted("p_retailprice", "l_discount")
    qty = F.col("l_quantity").cast("int")
    return j.select(
        "l_orderkey", "l_linenumber", qty.alias("quantity"),
        M.out(unit).alias("unit_price"),
        M.out((unit * qty).cast(M.MONEY)).alias("total_amount"),
    )


def pricing_errors(tx: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Rows whose total is not round(unit x qty, 2) within ``tolerance``."""
    expected = F.round(M.money("unit_price") * F.col("quantity"), 2)
    gap = F.abs(M.money("total_amount") - expected)
    return (tx.filter(gap >= F.lit(tolerance).cast("decimal(10,2)"))
              .select("transaction_id", "quantity", "unit_price", "total_amount",
                      M.out(expected).alias("expected_total"), M.out(gap).alias("price_gap")))


__all__ = [
    "CRITICAL", "PARTITION_COLS", "type_transactions", "add_date_partitions", "drop_critical_nulls",
    "valid_amounts", "sales_only", "dedup_latest", "to_silver", "bronze_to_silver", "cleaning_report",
    "silver_preview", "line_totals", "pricing_errors", "clean_rule",
]


def reject_reasons(bronze: DataFrame) -> DataFrame:
    """Rows that cleaning rejects, with the first failing rule (dead letter, K5).

    Works on raw text so the reason can tell an absent time from an
    unparseable one. ``error_type`` is one of missing_field, bad_timestamp,
    invalid_amount.
    """
    typed = type_transactions(bronze.withColumnRenamed("timestamp", "_raw_time").withColumn(
        "timestamp", F.col("_raw_time")))
    return typed.withColumn("error_type", _reason(F.col("_raw_time"))).filter(F.col("error_type").isNotNull())


def _reason(raw_time: F.Column) -> F.Column:
    """The first failing rule of a typed row (null: it passes); exactly the rows that ``to_silver`` drops have one."""
    missing = raw_time.isNull()
    for c in CRITICAL:
        if c != "timestamp":
            missing = missing | F.col(c).isNull()
    return (F.when(missing, F.lit("missing_field"))
            .when(F.col("timestamp").isNull(), F.lit("bad_timestamp"))
            .when(~valid_amount(F.col("total_amount")), F.lit("invalid_amount")))


def dead_letters(bronze: DataFrame) -> DataFrame:
    """Rejected Bronze rows as they arrived (all text), with ``error_type``.

    Besides the reasons of ``reject_reasons`` a line that isn't JSON is a
    ``corrupt_record``: its text is in the corrupt column.
    """
    raw = F.struct(*[F.col(f"`{c}`") for c in bronze.columns]).alias("_raw")
    typed = type_transactions(bronze.select("*", raw))
    reason = F.when(F.col(f"_raw.{CORRUPT_COL}").isNotNull(), F.lit("corrupt_record")).otherwise(
        _reason(F.col("_raw.timestamp")))
    return typed.select("_raw", reason.alias("error_type")).filter(F.col("error_type").isNotNull()).select("_raw.*", "error_type")
