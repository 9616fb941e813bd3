"""The gated daily pipeline (C3): gate -> discovery -> Silver -> Gold -> reports.

The gate runs inside the ingesting stream, over the batch that is ingested: a
batch that fails is quarantined whole and no zone is touched. One verdict row
per batch is what the driver collects.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import ledger, quality, reports
from ..schemas import BRONZE
from ..session import path_tag
from ..sinks.writers import write_results
from ..sources.bronze import discover_schema, new_files
from ..streaming import incremental
from .lake import Lake


@dataclass
class RunResult:
    status: str
    quality_score: float | None
    records: int
    schema: list[tuple[str, str, int]] = field(default_factory=list)
    results: dict[str, str] = field(default_factory=dict)
    older: list[tuple[str, float | None, int]] = field(default_factory=list)


def run_pipeline(spark: SparkSession, landing: str, lake: Lake, modified_after: str, report_month: tuple[str, str],
                 threshold: float = quality.QUALITY_THRESHOLD, run_id: str = "run") -> RunResult:
    """Gate and ingest every file that no run has taken; reports only when the files since ``modified_after`` passed.

    Older files, as of a missed day, pass a gate of their own: its verdicts are
    in ``older`` and decide the run's status only where nothing newer came.
    Files that a run has taken (or quarantined) are not read again: a run
    without a file since ``modified_after`` is NO_DATA and takes nothing. A
    batch that broke off is retried by the next run that finds a new file.
    """
    checkpoint = f"{lake.root}/_checkpoints/silver"
    verdicts = []
    if not new_files(spark, landing, modified_after).isEmpty():
        lake.learn(discover_schema(spark, landing, modified_after))  # a column that turns up is one of Silver from now on
        verdicts = incremental.run_incremental(spark, landing, lake, checkpoint, threshold=threshold,
                                               modified_after=modified_after)
    older = [(v.status, v.quality_score, v.records) for v in verdicts if v.older]
    newer = [v for v in verdicts if not v.older]
    verdicts = newer if any(v.records for v in newer) else [v for v in verdicts if v.older]
    records = sum(v.records for v in verdicts)
    if not records:
        run = spark.range(1).select(F.lit(f"{path_tag(checkpoint)}-none-{run_id}").alias("run_id"),
                                    F.lit(modified_after).cast("timestamp_ntz").alias("checked_at"))
        none = quality.validate(spark.createDataFrame([], BRONZE)).withColumns(
            {"run_id": F.lit(""), "checked_at": F.lit(None).cast("timestamp_ntz")})
        lake.ledger.record(ledger.scores(none, run), threshold)
        return RunResult(quality.STATUS_NO_DATA, 0.0, 0)
    score = 1 - sum(v.invalid_records for v in verdicts) / records
    # a batch left over from a run that broke off has its own verdict
    if any(v.status == quality.STATUS_FAIL for v in verdicts):
        return RunResult(quality.STATUS_FAIL, score, records, older=older)

    schema = [tuple(r) for r in discover_schema(spark, landing, modified_after).collect()]  # one row per column
    year, month = report_month
    out = {}
    for name, df in {
        "monthly_category_revenue": reports.monthly_category_revenue(lake.gold("revenue_by_product"), year, month),
        "monthly_region_performance": reports.monthly_region_performance(lake.gold("revenue_by_region"), year, month),
        "transaction_trend": reports.transaction_trend(lake.silver()),
    }.items():
        out[name] = write_results(df, f"{lake.root}/results", name, run_id)
    return RunResult(quality.STATUS_OK, score, records, schema, out, older)


__all__ = ["run_pipeline", "RunResult"]
