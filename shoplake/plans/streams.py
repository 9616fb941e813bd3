"""Streaming runs over the test tables (each run in fresh folders).

Every function starts from the driver's tables, drives the stream to
completion with an ``availableNow`` trigger, and returns the resulting
table as a batch DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import money as M
from ..operators import cleaning, kpis, ledger, quality
from ..schemas import BRONZE, CORRUPT_COL, GOLD, PARTITION_COLS, SILVER
from ..session import apply_lake_conf, scratch_path
from ..sinks.writers import write_landing
from ..sources import tables
from ..sources.bronze import discover_schema
from ..sources.zones import read_bronze
from ..streaming import incremental, landing, replay, windows
from .lake import Lake
from .landing import landing_path
from .pipeline import run_pipeline


def _events_schema(spark: SparkSession, sf_dir: str):
    return tables.table(spark, sf_dir, "events").schema


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events file(s) -> landing JSON.gz through the streaming file sink."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "landing", unique=True)
    ev = landing.events_stream(spark, sf_dir, "events.parquet", _events_schema(spark, sf_dir), max_files=1)
    q = landing.start_landing(spark, ev, tables.store_regions(spark, sf_dir), f"{run}/transactions", f"{run}/_checkpoint")
    q.awaitTermination()
    return read_bronze(spark, f"{run}/transactions").drop(CORRUPT_COL)


def silver_incremental(spark: SparkSession, sf_dir: str, files_per_batch: int = 8) -> DataFrame:
    """Landing files -> Silver in several micro-batches (exactly once)."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "incremental", unique=True)
    lake = Lake(spark, f"{run}/lake")
    incremental.run_incremental(spark, landing_path(spark, sf_dir), lake, f"{run}/_checkpoint",
                                max_files_per_trigger=files_per_batch, with_gold=False)
    return lake.silver()


def late_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Day 1 arrives late, together with re-sent versions of day 5.

    First batch: every event not on day 01. Second batch: day 01 plus each
    day-05 event again, one second later and one unit dearer (the later
    version must win; one that crosses midnight moves its id to day 06).
    """
    tx = tables.events_tx(spark, sf_dir)
    day = F.date_format("timestamp", "dd")
    first = tx.filter(day != "01")
    resent = (tx.filter(day == "05")
                .withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
                .withColumn("total_amount", F.col("total_amount") + F.lit(1.0)))
    second = tx.filter(day == "01").unionByName(resent)
    return first, second


def late_data_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "late", unique=True)
    lake = Lake(spark, f"{run}/lake")
    first, second = late_batches(spark, sf_dir)
    incremental.apply_batch(spark, lake, first)
    incremental.apply_batch(spark, lake, second)
    return lake.gold("revenue_by_product")


def dead_letter_written(spark: SparkSession, sf_dir: str, files_per_batch: int = 8) -> DataFrame:
    """Landing files through the stream; what it wrote under errors/ is read back."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "errors", unique=True)
    lake = Lake(spark, f"{run}/lake")
    incremental.run_incremental(spark, landing_path(spark, sf_dir), lake, f"{run}/_checkpoint",
                                max_files_per_trigger=files_per_batch, with_gold=False)
    return lake.errors().select("transaction_id", F.col("timestamp").alias("raw_timestamp"), "error_type")


def late_data_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``late_data_rebuild``, but the second batch breaks off between Silver and Gold and is run again."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "retry", unique=True)
    lake = Lake(spark, f"{run}/lake")
    first, second = late_batches(spark, sf_dir)
    incremental.apply_batch(spark, lake, first)
    incremental.upsert_silver(spark, lake, second, f"{run}/days")
    incremental.apply_batch(spark, lake, second, f"{run}/days")
    return lake.gold("revenue_by_product")


def rebuild_moved_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake built 40 days late, then rebuilt in full: days that no longer have rows must be gone."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "moved", unique=True)
    lake = Lake(spark, f"{run}/lake")
    first, second = late_batches(spark, sf_dir)
    rows = first.unionByName(second)
    for typed in (rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 40 DAYS")), rows):
        lake.build_silver(typed)
        lake.build_gold()
    return lake.gold("revenue_by_product")


WATERMARK = "2 hours"


def _window_run(spark: SparkSession, sf_dir: str, name: str, build, event_time: str = "timestamp",
                watermark: str = WATERMARK, folder: str | None = None) -> tuple[DataFrame, list[dict]]:
    """A window metric over the files of the given folder, a file a batch, with bounded state.

    Files are taken in order of arrival; events more than ``watermark`` older than
    the newest one of an earlier file are late and left out.
    """
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", name, unique=True)
    ev = landing.events_stream(spark, folder or sf_dir, "*.parquet" if folder else "events.parquet",
                               _events_schema(spark, sf_dir), max_files=1)
    agg = build(windows.with_watermark(_tx_events(ev) if event_time == "timestamp" else
                                       tables.dirty_landing_rows(ev, tables.store_regions(spark, sf_dir)), event_time, watermark))
    progress = windows.run_to_table(agg, f"{run}/result", f"{run}/_checkpoint", mode="update")
    return spark.read.parquet(f"{run}/result").drop("window_day"), progress


def _tx_events(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("ts").cast("timestamp_ntz").alias("timestamp"), F.col("value").alias("total_amount"))


def win_incoming_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_run(spark, sf_dir, "win5m", windows.incoming_records)[0]


def win_hourly_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_run(spark, sf_dir, "win1h", windows.hourly_sum)[0]


def win_daily_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_run(spark, sf_dir, "win1d", windows.daily_avg)[0]


def win_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_run(spark, sf_dir, "winq", lambda rows: windows.quality_score(quality.validate(rows)), "arrival")[0]


def gold_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Gold job whose third table breaks off: rows and revenue of all four, which must be the ones published before."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "publish", unique=True)
    lake = Lake(spark, f"{run}/lake")
    first, second = late_batches(spark, sf_dir)
    incremental.apply_batch(spark, lake, first)
    days = incremental.upsert_silver(spark, lake, second)
    new = kpis.gold_tables(lake.silver_days(days))
    broken = list(GOLD)[2]
    key = new[broken].columns[0]
    new[broken] = new[broken].withColumn(key, F.raise_error(F.lit("the write breaks off")).cast("string"))
    try:
        lake.gold_tables.publish(new, days)
    except Exception:  # the job's failure; what matters is what readers see now
        pass
    else:
        raise AssertionError("the broken table was published")
    return _gold_totals(lake)


def _gold_totals(lake: Lake) -> DataFrame:
    each = [lake.gold(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                                M.money_sum("total_revenue").alias("revenue")) for name in GOLD]
    return reduce(DataFrame.unionByName, each)


def gold_after_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``gold_after_failure``, then the job runs again: all four tables have the late day."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "republish", unique=True)
    lake = Lake(spark, f"{run}/lake")
    first, second = late_batches(spark, sf_dir)
    incremental.apply_batch(spark, lake, first)
    incremental.apply_batch(spark, lake, second)
    lake.gold_tables.expire(keep=1)
    return _gold_totals(lake)


def metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of every landing day entered in the ledger, twice; mean score a day, read from the written table."""
    apply_lake_conf(spark)
    book = ledger.Ledger(spark, scratch_path(spark, "streams", "ledger", unique=True))
    schema = StructType([*BRONZE.fields, *SILVER.fields[len(BRONZE.fields):]])
    rows = quality.validate(spark.read.schema(schema).json(landing_path(spark, sf_dir)))
    day = F.concat_ws("-", "year", "month", "day")
    scored = ledger.scores(rows.withColumns({"run_id": F.concat(F.lit("daily-"), day), "checked_at": day.cast("timestamp_ntz")}))
    for _ in range(2):  # a run that is entered again stays one run
        book.record(scored)
    return book.history()


def cleaning_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage counters that the job observes while it writes Silver."""
    apply_lake_conf(spark)
    lake = Lake(spark, scratch_path(spark, "streams", "counters", unique=True))
    counters = lake.build_silver(cleaning.type_transactions(read_bronze(spark, landing_path(spark, sf_dir))))
    return spark.createDataFrame([tuple(counters.values())], ", ".join(f"{c} long" for c in counters))


def silver_with_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files that bring two new columns half-way through the month: text, and numbers that become fractions."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "evolving", unique=True)
    lake, landed = Lake(spark, f"{run}/lake"), f"{run}/landing"
    rows = tables.clean_landing_rows(spark, sf_dir)
    day, n = F.dayofmonth("arrival"), F.col("transaction_id").cast("long")
    promo = F.when(n % 3 == 0, F.concat(F.lit("p"), (n % 7).cast("string")))
    for part in (rows.filter(day <= 10), rows.filter((day > 10) & (day <= 20)).withColumns({"promo": promo, "points": n % 5}),
                 rows.filter(day > 20).withColumns({"promo": promo, "points": (n % 5) + F.lit(0.5)})):
        write_landing(part, landed, mode="append")
        lake.learn(discover_schema(spark, landed))
        incremental.run_incremental(spark, landed, lake, f"{run}/_checkpoint", with_gold=False)
    return lake.silver()


def lake_after_expiry(spark: SparkSession, sf_dir: str, as_of: str, keep_days: int) -> DataFrame:
    """A lake after its expired days were deleted: Silver rows a day, beside the day's Gold revenue."""
    apply_lake_conf(spark)
    lake = Lake(spark, scratch_path(spark, "streams", "expiry", unique=True))
    incremental.apply_batch(spark, lake, tables.events_tx(spark, sf_dir))
    lake.expire(as_of, keep_days)
    silver = lake.silver().groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("transactions"))
    gold = lake.gold("revenue_by_region").groupBy(*PARTITION_COLS).agg(M.money_sum("total_revenue").alias("revenue"))
    return silver.join(gold, PARTITION_COLS, "full")


FIRST_RUN = "2000-01-01T00:00:00"


def _two_runs(spark: SparkSession, sf_dir: str, year: str, month: str):
    """A gated run over clean files up to the 15th, then one over defective files of the later days; each with the lake."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "gated", unique=True)
    lake, landed, day = Lake(spark, f"{run}/lake"), f"{run}/landing", F.dayofmonth("arrival")
    for step, rows in (("clean", tables.clean_landing_rows(spark, sf_dir).filter(day <= 15)),
                       ("defective", tables.bronze_dirty(spark, sf_dir).filter(day > 15))):
        write_landing(rows, landed, mode="append")
        yield step, lake, run_pipeline(spark, landed, lake, FIRST_RUN, (year, month), run_id=step)


def gated_runs(spark: SparkSession, sf_dir: str, year: str, month: str) -> DataFrame:
    """Verdict and zones after each run: the second one is quarantined whole and leaves Silver and Gold as they were."""
    out = []
    for step, lake, result in _two_runs(spark, sf_dir, year, month):
        held = {r.outcome: r.records for r in replay.accounts(lake).collect()}
        revenue = lake.gold("revenue_by_region").agg(M.money_sum("total_revenue")).first()[0]
        out.append((step, result.status, result.quality_score, result.records, held["silver"], revenue, held["quarantine"]))
    return spark.createDataFrame(out, "step string, status string, quality_score double, records long, silver_rows long, "
                                      "gold_revenue double, quarantined long")


def report_persisted(spark: SparkSession, sf_dir: str, year: str, month: str) -> DataFrame:
    """The report that the gated run wrote, read from its folder."""
    _, _, result = next(_two_runs(spark, sf_dir, year, month))
    return spark.read.parquet(result.results["monthly_category_revenue"])


def mended(rows: DataFrame) -> DataFrame:
    """The landing rows with amounts' signs dropped, no quantity as one and impossible discounts as none."""
    return rows.withColumns({
        "total_amount": F.ltrim(F.col("total_amount"), F.lit("-")),
        "quantity": F.when(F.col("quantity") == "0", F.lit("1")).otherwise(F.col("quantity")),
        "discount_pct": F.when(F.col("discount_pct") == "1.5", F.lit("0.0")).otherwise(F.col("discount_pct"))})


def with_store(rows: DataFrame) -> DataFrame:
    """The landing rows with an absent store taken from the customer."""
    return rows.withColumn("store_id", F.coalesce("store_id", F.regexp_replace("customer_id", "^cust-", "store-")))


def _replayed(spark: SparkSession, sf_dir: str) -> Lake:
    """The defective landing files fail the gate, are mended in quarantine and pass; then their dead letters get their stores."""
    apply_lake_conf(spark)
    run = scratch_path(spark, "streams", "replay", unique=True)
    lake = Lake(spark, f"{run}/lake")
    incremental.run_incremental(spark, landing_path(spark, sf_dir), lake, f"{run}/_checkpoint", threshold=quality.QUALITY_THRESHOLD)
    replay.replay_quarantine(lake, mended, "2024-02-01T00:00:00", with_gold=False)
    replay.replay_errors(lake, with_store)
    return lake


def quarantine_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir).silver()


def replay_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.accounts(_replayed(spark, sf_dir))


__all__ = ["landing_stream", "silver_incremental", "late_data_rebuild", "win_incoming_records", "win_hourly_sum",
           "win_daily_avg", "win_quality_score", "late_batches", "dead_letter_written", "late_data_retry",
           "rebuild_moved_day", "gold_after_failure", "gold_after_retry",
           "metrics_history", "cleaning_counters", "lake_after_expiry", "silver_with_new_column",
           "gated_runs", "report_persisted", "quarantine_replayed", "replay_accounts"]
