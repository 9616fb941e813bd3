"""Secured views and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import event_date
from ..schemas import PARTITION_COLS

KEEP_DAYS = 730


def analyst_view(silver: DataFrame, hidden: tuple[str, ...] = ("customer_id",)) -> DataFrame:
    """Column-level security: the hidden columns are not in the view at all."""
    return silver.drop(*hidden)


def regional_view(silver: DataFrame, grants: DataFrame) -> DataFrame:
    """Row-level security: rows whose region is granted to the caller.

    ``grants`` holds (region) rows for one principal: a name per region at
    most once they are distinct, so they are broadcast. A shuffle by region
    would put a whole region in one task.
    """
    return silver.join(F.broadcast(grants.select("region").distinct()), "region", "left_semi")


def _age_days(as_of: str) -> F.Column:
    return F.datediff(F.to_date(F.lit(as_of)), event_date())


def retention_expired(df: DataFrame, as_of: str, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Partitions older than ``keep_days`` before ``as_of`` (to be deleted).

    Only partition columns are used: give it ``Lake.days()``, which lists folders,
    or a zone read, which opens every file's footer.
    """
    parts = df.select(*PARTITION_COLS).distinct()
    return parts.filter(_age_days(as_of) > F.lit(keep_days)).withColumn("age_days", _age_days(as_of))


def retention_kept(df: DataFrame, as_of: str, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Rows inside the retention window: a partition filter, so it prunes."""
    return df.filter(event_date() >= F.date_sub(F.to_date(F.lit(as_of)), keep_days))
