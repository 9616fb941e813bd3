"""Replay of what a run set aside (K5): quarantined batches and dead letters.

Both are read back with a function that mends them (DataFrame to DataFrame) and go
the way of any batch: gate, ``errors/``, Silver, Gold. After a replay the landing rows
are still Silver + older versions + errors + quarantine, each row in one place.

The set-aside folder is deleted last. A replay that broke off is run again: the
errors folder of a part is overwritten, Silver keeps the latest version of an id, the
touched days are noted, so the second run gives what one whole run gives. Parts
are replayed one after another, in the order of their batches; the list of
parts is what the driver holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..operators import cleaning, quality
from ..plans.lake import Lake
from ..session import delete_path, glob_paths
from ..sinks.versions import Day
from ..sources import evolution
from . import incremental

Mend = Callable[[DataFrame], DataFrame]

_PART = re.compile(r"(source=[^/]+/batch=[^/]+)(?:/|$)")
_BATCH = re.compile(r"batch=(\d+)")
_ROUND = re.compile(r"~(\d+)$")


def _parts(paths: list[str]) -> list[str]:
    """The source=/batch= folders among some paths, by source and batch."""
    found = {m[1] for m in map(_PART.search, paths) if m}
    number = lambda p: int(m[1]) if (m := _BATCH.search(p)) else -1
    return sorted(found, key=lambda p: (p.split("/")[0], number(p), p))


def quarantined(lake: Lake) -> list[str]:
    """The parts in quarantine that were written whole."""
    return _parts(glob_paths(lake.spark, f"{lake.root}/quarantine/source=*/batch=*/reason=quality/_SUCCESS"))


def replay_quarantine(lake: Lake, mend: Mend, at: str, threshold: float = quality.QUALITY_THRESHOLD,
                      with_gold: bool = True) -> list[Row]:
    """Mend every quarantined part and let it pass the gate again; the verdicts.

    A part that passes is ingested and leaves the quarantine, one that fails stays
    as it is, unmended. ``at`` ('yyyy-MM-ddTHH:mm:ss', UTC) is the replay's time
    in the ledger: the same at a retry, so that it stays one run there.
    """
    spark, verdicts = lake.spark, []
    for name in quarantined(lake):
        folder = f"{lake.root}/quarantine/{name}"
        rows = mend(spark.read.schema(evolution.bronze_schema(lake.columns())).parquet(f"{folder}/reason=quality")).persist()
        try:
            run_id = re.sub(r"source=|batch=", "", name).replace("/", "-") + "-replay"
            row = incremental.judge(lake, rows, run_id, F.lit(at).cast("timestamp_ntz"), threshold).first()
            verdicts.append(row)
            if row.status != quality.STATUS_OK:
                continue
            incremental.ingest(lake, rows, f"{name}~0", f"{lake.root}/ops/replays/{name}/days", with_gold)
        finally:
            rows.unpersist()
        delete_path(spark, folder)
    return verdicts


def _next(name: str) -> str:
    """The folder of a part's letters after one more replay."""
    m = _ROUND.search(name)
    return f"{name[:m.start()]}~{int(m[1]) + 1}" if m else f"{name}~1"


def replay_errors(lake: Lake, mend: Mend, with_gold: bool = True) -> list[Day]:
    """Mend the dead letters and ingest those that cleaning now takes; the days that changed.

    Letters that are rejected still stay in ``errors/`` as mended, in the folder of
    the next round of their part. A part of which nothing is taken stays as it is.
    """
    spark, days = lake.spark, set()
    held = _parts(glob_paths(spark, f"{lake.root}/errors/source=*/batch=*/error_type=*"))
    broken_off = {_next(name) for name in held}  # written by a replay that didn't come to delete what it read
    schema = evolution.bronze_schema(lake.error_columns())
    for name in held:
        if name in broken_off:
            continue
        folder = f"{lake.root}/errors/{name}"
        rows = mend(spark.read.schema(schema).parquet(folder).select(*[f"`{c}`" for c in schema.fieldNames()])).persist()
        try:
            if rows.count() == cleaning.dead_letters(rows).count():
                continue
            days.update(incremental.ingest(lake, rows, _next(name), f"{lake.root}/ops/replays/{_next(name)}/days", with_gold))
        finally:
            rows.unpersist()
        delete_path(spark, folder)
    return sorted(days)


def accounts(lake: Lake) -> DataFrame:
    """outcome, records: where the landing rows are now, but for older versions, which Silver replaced."""
    spark = lake.spark
    parts = [lake.errors().groupBy(F.col("error_type").alias("outcome")).agg(F.count(F.lit(1)).alias("records"))]
    for outcome, rows in (("silver", lake.silver()), ("quarantine", _waiting(lake))):
        parts.append(rows.agg(F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("records")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _waiting(lake: Lake) -> DataFrame:
    schema = evolution.bronze_schema(lake.columns())
    paths = [f"{lake.root}/quarantine/{name}/reason=quality" for name in quarantined(lake)]
    return lake.spark.read.schema(schema).parquet(*paths) if paths else lake.spark.createDataFrame([], schema)


__all__ = ["quarantined", "replay_quarantine", "replay_errors", "accounts"]
