"""Tumbling-window metrics over streams.

Each metric is a ``groupBy(window(...))`` aggregation. With a watermark the
state of closed windows is dropped, so state is as large as the windows that are
still open, and ``update`` output carries only the windows that a batch changed:
the sink merges them into the days of its table that they touch. The table then
always holds every window (append mode would hold back the still-open last ones).
Without a watermark ``complete`` output rewrites the whole table; it is for
streams with a bounded number of windows only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions.timeparse import utc_instant, utc_wall


# Set by ``with_watermark``: the event-time column is then a TIMESTAMP
# instant (watermarks need one), converted back to UTC wall-clock on output.
_EVENT = "_event_time"


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a TIMESTAMP instant with a watermark (bounded state).

    Silver time is UTC wall-clock TIMESTAMP_NTZ; watermarks need TIMESTAMP, so
    the value is read as UTC explicitly (independent of the session zone).
    """
    return df.withColumn(_EVENT, utc_instant(F.col(ts))).withWatermark(_EVENT, delay)


def _windowed(df: DataFrame, ts: str, width: str, *aggs: Column) -> DataFrame:
    col = F.col(_EVENT) if _EVENT in df.columns else F.col(ts)
    return df.groupBy(F.window(col, width).alias("w")).agg(*aggs)


def _flat(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "w"]
    start, end = F.col("w.start"), F.col("w.end")
    if dict(df.select("w.start").dtypes)["start"] == "timestamp":
        start, end = utc_wall(start), utc_wall(end)
    return df.select(start.alias("window_start"), end.alias("window_end"), *cols)


def incoming_records(df: DataFrame, ts: str = "timestamp", width: str = "5 minutes") -> DataFrame:
    """Records per 5-minute window."""
    return _windowed(df, ts, width, F.count(F.lit(1)).alias("records"))


def hourly_sum(df: DataFrame, ts: str = "timestamp", value: str = "total_amount", width: str = "1 hour") -> DataFrame:
    """Exact money sum per hour (T5)."""
    return _windowed(df, ts, width, F.sum(M.money(value)).alias("_s")).select(
        "w", M.out("_s").alias("total_value"))


def daily_avg(df: DataFrame, ts: str = "timestamp", value: str = "total_amount", width: str = "1 day") -> DataFrame:
    """Mean value per day, exact half-up to cents."""
    g = _windowed(df, ts, width, F.sum(M.money(value)).alias("_s"), F.count(F.col(value)).alias("_n"))
    return g.select("w", M.exact_mean2(F.col("_s"), F.col("_n")).alias("avg_value"), F.col("_n").alias("records"))


def quality_score(validated: DataFrame, ts: str = "arrival", width: str = "1 day") -> DataFrame:
    """Share of valid records per day (T4)."""
    g = _windowed(validated, ts, width, F.count(F.lit(1)).alias("records"), F.count_if("is_valid").alias("_v"))
    return g.select("w", (F.col("_v").cast("double") / F.col("records")).alias("quality_score"), "records")


def run_to_table(agg: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> list[dict]:
    """Drive a windowed aggregate to completion, keeping the result at ``path``; the batches' progress reports.

    ``complete``: every batch carries the whole result and replaces the table.
    ``update`` (needs a watermark): a batch carries only the windows that
    changed; they replace their old versions in the table, which is
    partitioned by window day so a batch rewrites only the days it touches.
    """
    spark = agg.sparkSession

    def each(batch: DataFrame, epoch_id: int) -> None:
        if mode == "complete":
            _flat(batch).write.mode("overwrite").parquet(path)
            return
        from ..session import path_exists
        from ..sinks.writers import replace_partitions

        changed = _flat(batch).withColumn("window_day", F.date_format("window_start", "yyyy-MM-dd")).persist()
        try:
            if changed.isEmpty():
                return
            days = changed.select("window_day").distinct()
            if path_exists(spark, path):
                old = spark.read.schema(changed.schema).parquet(path).join(days, "window_day", "left_semi")
                kept = old.join(changed.select("window_start"), "window_start", "left_anti")
                merged = kept.unionByName(changed)
            else:
                merged = changed
            replace_partitions(spark, merged, path, days, partition_cols=["window_day"])
        finally:
            changed.unpersist()

    q = (agg.writeStream.outputMode(mode).foreachBatch(each)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in q.recentProgress]


def state_rows(progress: list[dict]) -> list[tuple[int, int]]:
    """(rows held, rows dropped) of the window state after each batch."""
    return [(s["numRowsTotal"], s.get("numRowsRemoved", 0)) for p in progress for s in p["stateOperators"]]
