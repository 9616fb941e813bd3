"""Readers for the lake zones (S1-S3) with fixed schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import glob_paths
from ..schemas import BRONZE, BRONZE_WITH_CORRUPT, CORRUPT_COL, PARTITION_COLS, SILVER


def read_bronze(spark: SparkSession, path: str, keep_corrupt: bool = True,
                modified_after: str | None = None) -> DataFrame:
    """Newline-delimited JSON (plain or .gz, by suffix) with an all-text schema.

    Landing folder names (year=/month=/day=) describe arrival, not event
    time, so they are dropped; Silver derives its partitions from the event.
    Lines that are not JSON are kept with their text in ``_corrupt_record``;
    without ``keep_corrupt`` the parser drops them (DROPMALFORMED).
    With an all-text schema only unparseable lines count as malformed.
    ``modified_after`` ('yyyy-MM-ddTHH:mm:ss', UTC) restricts the read to
    files that arrived since then (the listing filters them; older files
    are never opened).
    """
    if keep_corrupt:
        reader = (spark.read.schema(BRONZE_WITH_CORRUPT).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT_COL))
    else:
        reader = spark.read.schema(BRONZE).option("mode", "DROPMALFORMED")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    df = reader.option("multiLine", "false").json(path)
    return df.drop(*[c for c in PARTITION_COLS if c in df.columns])


_DAY = re.compile(r"year=([^/]+)/month=([^/]+)/day=([^/]+)/?$")


def partition_days(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """The (year, month, day) folders of a partitioned table, from a folder listing alone."""
    found = (_DAY.search(p) for p in glob_paths(spark, f"{path.rstrip('/')}/year=*/month=*/day=*"))
    return sorted(m.groups() for m in found if m)


def period_paths(table_path: str, periods: list[tuple[str, ...]]) -> list[str]:
    """Sub-folders for (year[, month[, day]]) tuples of a year/month/day table."""
    out = []
    for p in periods:
        out.append(table_path.rstrip("/") + "".join(f"/{k}={v}" for k, v in zip(PARTITION_COLS, p)))
    return out


def _read(spark: SparkSession, schema, table_path: str, periods: list[tuple[str, ...]] | None) -> DataFrame:
    """Read a partitioned table, optionally only some periods' folders.

    With ``periods`` only those folders are listed (``basePath`` keeps the
    partition columns): without a metastore, a whole-table read lists every
    day folder before pruning, which on an object store costs a request per
    folder. Callers still filter on the partition columns.
    """
    reader = spark.read.schema(schema)
    if not periods:
        return reader.parquet(table_path)
    return reader.option("basePath", table_path).parquet(*period_paths(table_path, periods))


def read_silver(spark: SparkSession, path: str, periods: list[tuple[str, ...]] | None = None,
                schema: StructType = SILVER) -> DataFrame:
    """Partitioned Silver Parquet; partition values stay zero-padded text (S3)."""
    return _read(spark, schema, path, periods)
