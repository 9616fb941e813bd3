"""The ledger of quality checks: metric points, verdicts and alerts by run and time.

A run writes its own folder of each table, ``run_day=/run_id=``; writing it again
replaces it, so a retried run leaves one entry. ``checked_at`` is given by the run
(for a batch, when its newest file arrived), not read from a clock, so a retry
writes the same time. Verdicts and alerts carry the first errors of their records.
Many runs may be written at once: the checks of a backfill are one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import quality

ERRORS = 5
ERROR_TYPE = "array<struct<record_id:string,errors:string>>"
TABLES = {
    "metrics": "metric_name string, metric_value double, unit string, zone string, checked_at timestamp_ntz",
    "verdicts": ("status string, quality_score double, records long, invalid_records long, threshold double, "
                 f"errors {ERROR_TYPE}, checked_at timestamp_ntz"),
    "alerts": ("status string, subject string, quality_score double, records long, invalid_records long, threshold double, "
               f"errors {ERROR_TYPE}, checked_at timestamp_ntz"),
}
RUN = ["run_id", "checked_at"]


def scores(validated: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """run_id, checked_at, records, valid_records, quality_score and the first errors of every run.

    ``validated`` has ``run_id`` and ``checked_at`` with each record; ``runs`` names
    runs that may have none. Counts are combined in the map tasks; of a run's
    invalid records each task keeps the first few.
    """
    counted = validated.groupBy(*RUN).agg(F.count(F.lit(1)).alias("records"), F.count_if("is_valid").alias("valid_records"))
    if runs is not None:
        none = F.lit(0).cast("long")
        counted = runs.select(*RUN).join(counted, RUN, "left").select(
            *RUN, F.coalesce("records", none).alias("records"), F.coalesce("valid_records", none).alias("valid_records"))
    scored = counted.withColumn("quality_score", F.when(
        F.col("records") > 0, F.col("valid_records").cast("double") / F.col("records")).otherwise(F.lit(0.0)))
    wrong = validated.filter(~F.col("is_valid")).select(
        *RUN, F.coalesce("transaction_id", F.lit("unknown")).alias("record_id"), F.array_join("errors", "; ").alias("errors"))
    order = Window.partitionBy(*RUN).orderBy("record_id", "errors")
    first = wrong.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= ERRORS)  # a limit in every task
    first = first.groupBy(*RUN).agg(F.array_sort(F.collect_list(F.struct("record_id", "errors"))).alias("errors"))
    return scored.join(first, RUN, "left").withColumn("errors", F.coalesce("errors", F.array().cast(ERROR_TYPE)))


@dataclass
class Ledger:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def record(self, scored: DataFrame, threshold: float = quality.QUALITY_THRESHOLD) -> None:
        """Enter the checks of ``scores``: a verdict and two metric points of each run, an alert where it didn't pass."""
        scored = scored.persist()
        try:
            verdicts = scored.withColumn("status", quality.status(threshold)).withColumn("threshold", F.lit(threshold)).withColumn(
                "invalid_records", F.col("records") - F.col("valid_records"))
            points = scored.select(*RUN, F.explode(quality.points()).alias("m")).select(
                *RUN, "m.*", F.lit(quality.METRIC_ZONE).alias("zone"))
            self._write("metrics", points)
            self._write("verdicts", verdicts)
            self._write("alerts", verdicts.filter(F.col("status") != quality.STATUS_OK).withColumn("subject", quality.subject()))
        finally:
            scored.unpersist()

    def _write(self, table: str, rows: DataFrame) -> None:
        fields = [c.split(" ")[0] for c in TABLES[table].split(", ")]
        rows = rows.select(*fields, F.date_format("checked_at", "yyyy-MM-dd").alias("run_day"), "run_id")
        (rows.repartition("run_day").write.partitionBy("run_day", "run_id").mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(self.path(table)))

    def read(self, table: str) -> DataFrame:
        """All entries; filters on run_day and run_id leave the other runs' files unread."""
        return self.spark.read.schema(f"{TABLES[table]}, run_day string, run_id string").parquet(self.path(table))

    def history(self, metric: str = quality.METRIC_SCORE) -> DataFrame:
        """Mean of a metric for every day that has checks, and how many there were (T4)."""
        found = self.read("metrics").filter(F.col("metric_name") == metric)
        return found.groupBy("run_day").agg(F.avg("metric_value").alias("mean_value"), F.count(F.lit(1)).alias("checks"))


__all__ = ["Ledger", "scores", "ERRORS"]
