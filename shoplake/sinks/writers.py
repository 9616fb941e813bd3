"""Writers for partitioned zones (K1, K3, K8) with the safety rules.

* Rebalance before every partitioned write: AQE sizes the output files and
  splits a hot day into several tasks instead of one (no skewed writer).
* Overwrite is always *dynamic* (only the partitions present in the data are
  replaced); a static overwrite of a whole zone would drop its history.
* Never overwrite a path that the same plan reads: the rows are first written
  to a staging folder, then the target partitions are replaced from it.
* Partitions that a rewrite leaves empty are deleted explicitly (dynamic
  overwrite alone never clears a partition that has no rows left).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PARTITION_COLS
from ..session import delete_path, scratch_path


def _writer(df: DataFrame, partition_cols: list[str]):
    return df.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str] = PARTITION_COLS,
                      mode: str = "append", compression: str = "snappy") -> None:
    """Partitioned Parquet write (K1)."""
    _writer(df, partition_cols).mode(mode).option("compression", compression).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str] = PARTITION_COLS) -> None:
    """Replace exactly the partitions present in ``df`` (K3)."""
    (_writer(df, partition_cols).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .parquet(path))


def partition_path(root: str, values: dict[str, str]) -> str:
    return root.rstrip("/") + "/" + "/".join(f"{k}={v}" for k, v in values.items())


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, affected: DataFrame,
                       partition_cols: list[str] = PARTITION_COLS, schema=None, staged: bool = False) -> None:
    """Safely rewrite the ``affected`` partitions of ``path`` with ``df``.

    ``df`` may read ``path`` itself. Steps: write df to staging; dynamic
    overwrite from staging; delete affected partitions with no rows left.
    ``affected`` holds one row per partition (it is small: a batch touches a
    bounded number of days), so listing it on the driver is fine.
    ``staged=True``: ``df`` is already a read of a staging copy (it does not
    read ``path``), so it is written directly.
    """
    staging = None
    if not staged:
        staging = scratch_path(spark, "staging", unique=True)
        schema = schema if schema is not None else df.schema
        write_partitioned(df, staging, partition_cols, mode="overwrite")
        df = spark.read.schema(schema).parquet(staging)
    # Emptied partitions are found before the overwrite (df may be lazy).
    kept = [tuple(r) for r in df.select(*partition_cols).distinct().collect()]
    overwrite_partitions(df, path, partition_cols)
    for row in affected.select(*partition_cols).distinct().toLocalIterator():
        if tuple(row) not in set(kept):
            delete_path(spark, partition_path(path, row.asDict()))
    if staging:
        delete_path(spark, staging)


def write_results(df: DataFrame, root: str, name: str, run_id: str) -> str:
    """Persist a report result as result/<name>/run_id=<id> (K8)."""
    target = f"{root.rstrip('/')}/{name}/run_id={run_id}"
    # Some reports (customer_patterns) grow with the data: let AQE size the files.
    df.hint("rebalance").write.mode("overwrite").parquet(target)
    return target


def write_landing(df: DataFrame, path: str, time_col: str = "arrival", mode: str = "append") -> None:
    """GZIP newline-delimited JSON under year=/month=/day= of arrival time (K4)."""
    parts = {"year": F.date_format(time_col, "yyyy"), "month": F.date_format(time_col, "MM"),
             "day": F.date_format(time_col, "dd")}
    (df.withColumns(parts).drop(time_col).hint("rebalance", *PARTITION_COLS).write
       .partitionBy(*PARTITION_COLS).mode(mode).option("compression", "gzip").json(path))
