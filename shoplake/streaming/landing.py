"""Buffered landing stream (T1, K4): events -> GZIP JSON landing folders.

The stream reads source files as they appear (``max_files`` or ``max_bytes``
bound a micro-batch like the 60 s / 128 MB buffer),
renders each record as landing text and appends it under
year=/month=/day= of arrival time. The file sink's commit log makes the
landing exactly-once: readers only see files of committed batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PARTITION_COLS
from ..sources.tables import dirty_landing_rows


def events_stream(spark: SparkSession, folder: str, file_glob: str, schema, max_files: int | None = None,
                  max_bytes: int | None = None) -> DataFrame:
    """The files of a folder; a batch takes ``max_files`` files or about ``max_bytes`` bytes (and one file at least)."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.parquet(folder)


def start_landing(spark: SparkSession, events: DataFrame, lookup: DataFrame, landing_path: str, checkpoint: str,
                  processing_time: str | None = None, max_records: int = 500_000):
    """Start the landing query; ``processing_time`` None means availableNow. ``lookup``: store_id, region.

    With ``max_bytes`` on the source and a time trigger a batch is what arrived in
    that time, up to that size; a file holds ``max_records`` lines at most.
    """
    rows = dirty_landing_rows(events, lookup)
    parts = {"year": F.date_format("arrival", "yyyy"), "month": F.date_format("arrival", "MM"),
             "day": F.date_format("arrival", "dd")}
    out = rows.withColumns(parts).drop("arrival")
    w = (out.writeStream.format("json").option("compression", "gzip").partitionBy(*PARTITION_COLS)
         .option("checkpointLocation", checkpoint).option("maxRecordsPerFile", str(max_records)).outputMode("append"))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start(landing_path)
