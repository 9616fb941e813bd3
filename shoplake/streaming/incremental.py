"""Incremental, exactly-once Bronze -> Silver -> Gold.

A micro-batch is merged into Silver by rewriting only the partitions it
touches: the partitions of its own rows plus those of existing rows with the
same ids (a re-sent transaction may carry another date). The rewrite keeps
the latest version per id, goes through a staging folder (never overwriting
what the plan reads) and deletes partitions that end up empty. Re-running a
batch therefore changes nothing, and the checkpointed stream never replays a
committed file. Gold is then rebuilt for the touched days only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import utc_wall
from ..operators import cleaning, ledger, quality
from ..plans.lake import Lake
from ..schemas import CORRUPT_COL, PARTITION_COLS, SILVER, TX_FIELDS
from ..session import delete_path, path_exists, path_tag, scratch_path
from ..sinks.versions import Day
from ..sinks.writers import replace_partitions, write_partitioned
from ..sources import evolution
from ..sources.zones import partition_days, read_silver

ARRIVED = "_arrived"  # the landing file's modification time


def _days_frame(spark: SparkSession, days: list[Day]) -> DataFrame:
    return spark.createDataFrame(days, ", ".join(f"{c} string" for c in PARTITION_COLS))


def _in_days(df: DataFrame, days: list[Day]) -> DataFrame:
    """The rows of a list of days.

    A join on the partition columns: the plan stays small for any number of
    days, and dynamic partition pruning keeps the scan to their folders.
    """
    return df.join(_days_frame(df.sparkSession, days), PARTITION_COLS, "left_semi").select(*[f"`{c}`" for c in df.columns])


def upsert_silver(spark: SparkSession, lake: Lake, typed: DataFrame, journal: str | None = None) -> list[Day]:
    """Merge typed rows into Silver; returns the days that changed.

    Only days that hold an earlier version of one of the batch's ids are
    rewritten (R). Every other winning row is appended to its day: in the
    usual case (fresh ids) a micro-batch is a pure append and never rewrites
    existing data. Earlier versions are found in the id index, which is joined
    without a shuffle of its own; of Silver only the days in R are read.

    Failure safety: the batch's ids enter the index before Silver changes; both
    outputs are staged first; the rewrite of R happens before the append. A
    batch retried after a partial run finds its own appended rows as earlier
    versions and rewrites them to the same result. With ``journal`` (a folder
    of this batch) the days are noted before Silver changes, and a retry
    returns those of every attempt: a day that an id left in the first attempt
    no longer shows in the second one.
    """
    more = [c for c in lake.columns() if c in typed.columns]
    batch = cleaning.add_date_partitions(cleaning.dedup_latest(
        cleaning.valid_amounts(cleaning.drop_critical_nulls(typed.select(*TX_FIELDS, *[f"`{c}`" for c in more])))))
    batch = batch.persist()
    try:
        rewrite: list[Day] = []
        if path_exists(spark, lake.silver_path):
            if not lake.ids.exists():  # a lake that was built in one load
                lake.ids.rebuild(lake.silver())
            rewrite = _collected(lake.ids.days_of(batch))
        elif not lake.ids.exists():
            lake.ids.rebuild(batch.limit(0))
        own_days = _collected(batch)
        if journal and (rewrite or own_days):
            _days_frame(spark, sorted({*rewrite, *own_days})).coalesce(1).write.mode("append").parquet(journal)
        lake.ids.add(batch)
        staging = None
        if rewrite:
            # The winners read the days being replaced: stage them before any
            # file of Silver changes (never overwrite what the plan reads).
            both = lake.silver_days(rewrite, as_stored=True).unionByName(batch, allowMissingColumns=True)
            winners = cleaning.add_date_partitions(cleaning.dedup_latest(both.drop(*PARTITION_COLS)))
            staging = scratch_path(spark, "staging", unique=True)
            write_partitioned(winners, staging, mode="overwrite")
            winners = read_silver(spark, staging, schema=evolution.silver_schema(lake.columns()))
        else:
            winners = batch
        fresh_days = [d for d in (partition_days(spark, staging) if staging else own_days) if d not in set(rewrite)]
        days = rewrite + fresh_days
        if rewrite:
            replace_partitions(spark, _in_days(winners, rewrite), lake.silver_path, _days_frame(spark, rewrite),
                               schema=SILVER, staged=True)
        if fresh_days:
            write_partitioned(_in_days(winners, fresh_days) if rewrite else winners, lake.silver_path, mode="append")
        if staging:
            delete_path(spark, staging)
        if journal and days:
            days = _collected(spark.read.schema(_days_frame(spark, []).schema).parquet(journal))
        return days
    finally:
        batch.unpersist()


def _collected(rows: DataFrame) -> list[Day]:
    """The days of some rows: calendar-sized."""
    return sorted(tuple(r) for r in rows.select(*PARTITION_COLS).distinct().collect())


def rebuild_gold(spark: SparkSession, lake: Lake, days: list[Day]) -> None:
    """Recompute the Gold days in ``days`` from Silver and publish them together (late data, T7)."""
    if days:
        lake.build_gold(days)


def apply_batch(spark: SparkSession, lake: Lake, typed: DataFrame, journal: str | None = None) -> list[Day]:
    days = upsert_silver(spark, lake, typed, journal)
    rebuild_gold(spark, lake, days)
    return days


def _cutoff(spark: SparkSession, path: str, modified_after: str) -> str:
    """The batch's cut-off, noted at its first attempt so that a retry splits the batch alike."""
    spark.createDataFrame([(modified_after,)], "cut string").write.mode("ignore").parquet(path)
    noted = spark.read.schema("cut string").parquet(path).first()
    return noted.cut if noted else modified_after


def judge(lake: Lake, rows: DataFrame, run_id: str, at: Column, threshold: float, empty: bool = False) -> DataFrame:
    """The gate over some landing rows, entered in the ledger: one verdict row with its first errors."""
    spark = lake.spark
    run = {"run_id": F.lit(run_id), "checked_at": at}
    runs = spark.range(1).select(*[c.alias(k) for k, c in run.items()])
    scored = ledger.scores(quality.validate(rows).withColumns(run), runs if empty else None)
    totals = spark.createDataFrame([scored.first()], scored.schema)  # one row and its first errors
    lake.ledger.record(totals, threshold)
    return quality.gate(totals, threshold, "errors")


def ingest(lake: Lake, batch: DataFrame, name: str, journal: str, with_gold: bool = True) -> list[Day]:
    """Landing rows into errors/``name``, Silver and, of the touched days, Gold; the days that changed."""
    lake.write_errors(batch, name)
    typed = cleaning.type_transactions(batch.filter(F.col(CORRUPT_COL).isNull()))
    return (apply_batch if with_gold else upsert_silver)(lake.spark, lake, typed, journal)


def run_incremental(spark: SparkSession, bronze_path: str, lake: Lake, checkpoint: str,
                    max_files_per_trigger: int | None = None, with_gold: bool = True,
                    threshold: float | None = None, modified_after: str | None = None) -> list[Row]:
    """Process every landing file not yet committed, then stop (availableNow).

    Every landing record ends in one place. Rows that cleaning rejects and
    lines that aren't JSON go to ``errors/``. With ``threshold`` each
    micro-batch passes the quality gate first, over exactly the rows that
    would be ingested; a batch that fails goes to ``quarantine/`` whole and
    Silver stays as it is. With ``modified_after`` the rows of older files
    that no run has taken yet pass a gate of their own (``batch=N_older``):
    either part is ingested or quarantined on its own verdict.
    All are written per batch, so a retried batch replaces its own; the ledger
    has a run for every gated part. Returns the parts' verdict rows, with their
    first errors and ``older``.
    """
    reader = (spark.readStream.schema(evolution.bronze_schema(lake.columns())).option("multiLine", "false").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(bronze_path)
    stream = stream.select(*[f"`{c}`" for c in stream.columns if c not in PARTITION_COLS],
                           F.col("_metadata.file_modification_time").alias(ARRIVED))
    source = f"source={path_tag(checkpoint)}"
    verdicts: list[Row] = []

    def gated(part: DataFrame, name: str, run_id: str, older: bool) -> bool:
        # when the newest file arrived: the same at every attempt
        latest = part.agg(F.max(ARRIVED).cast("string")).first()[0]
        at = utc_wall(F.coalesce(F.lit(latest).cast("timestamp"), F.current_timestamp()))
        row = judge(lake, part.drop(ARRIVED), run_id, at, threshold, latest is None).withColumn("older", F.lit(older)).first()
        verdicts.append(row)
        if row.status == quality.STATUS_OK:
            return True
        if row.records:
            part.drop(ARRIVED).write.mode("overwrite").parquet(f"{lake.root}/quarantine/{name}/reason=quality")
        return False

    def each(rows: DataFrame, epoch_id: int) -> None:
        batch = rows.persist()  # its lines are parsed once
        try:
            take(batch, epoch_id)
        finally:
            batch.unpersist()

    def take(batch: DataFrame, epoch_id: int) -> None:
        name = f"{source}/batch={epoch_id}"
        notes = f"{lake.root}/ops/batches/{name}"
        if threshold is not None:
            run_id = f"{path_tag(checkpoint)}-{epoch_id}"
            parts = [(False, name, run_id, F.lit(True))]
            if modified_after:
                cut = F.lit(_cutoff(spark, f"{notes}/cut", modified_after) + "Z").cast("timestamp")
                parts = [(False, name, run_id, F.col(ARRIVED) > cut)]
                if not batch.filter(F.col(ARRIVED) <= cut).isEmpty():
                    parts.append((True, f"{name}_older", f"{run_id}-older", F.col(ARRIVED) <= cut))
            passed = [rows for older, part, run, rows in parts if gated(batch.filter(rows), part, run, older)]
            if not passed:
                return
            batch = batch.filter(reduce(Column.__or__, passed))
        ingest(lake, batch.drop(ARRIVED), name, f"{notes}/days", with_gold)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return verdicts
