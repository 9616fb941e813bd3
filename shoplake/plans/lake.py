"""A lake instance: Silver and Gold folders, their builds and the catalog.

``Lake.build_*`` run the two batch jobs (Bronze/typed -> Silver, Silver ->
Gold); ``Lake.silver()`` / ``Lake.gold(name)`` read the zones back as
partitioned tables, so reports get partition pruning.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cleaning, governance, kpis
from ..operators.ledger import Ledger
from ..schemas import BRONZE_WITH_CORRUPT, GOLD, PARTITION_COLS, SILVER, TX_FIELDS
from ..session import (
    SHARE_BYTES, SHARE_ROWS, apply_lake_conf, build_conf, delete_path, folder_bytes, path_exists, path_tag, scratch_path, shares, touch,
)
from ..sinks.id_index import IdIndex
from ..sinks.versions import Day, VersionedTables
from ..sinks.writers import partition_path, replace_partitions, write_partitioned
from ..sources import evolution
from ..sources.zones import partition_days, read_silver


@dataclass
class Lake:
    spark: SparkSession
    root: str

    @property
    def silver_path(self) -> str:
        return f"{self.root}/silver/transactions"

    @property
    def gold_root(self) -> str:
        return f"{self.root}/gold"

    def silver(self, *periods: tuple[str, ...]) -> DataFrame:
        """Silver, or only the given (year[, month[, day]]) periods' folders; registered columns after the 14."""
        columns = self.columns()
        rows = read_silver(self.spark, self.silver_path, list(periods) or None, evolution.silver_schema(columns))
        return evolution.typed_columns(rows, columns)

    def columns(self) -> dict[str, str]:
        """The registered columns beside the 14, and their types."""
        return evolution.registered(self.spark, self.root)

    def learn(self, discovered: DataFrame) -> dict[str, str]:
        """Register the columns of a schema discovery; they are ingested and read from now on."""
        return evolution.learn(self.spark, self.root, discovered)

    @property
    def gold_tables(self) -> VersionedTables:
        return VersionedTables(self.spark, self.gold_root, GOLD)

    @property
    def ids(self) -> IdIndex:
        return IdIndex(self.spark, f"{self.root}/ops/id_index")

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ops")

    def gold(self, name: str, *periods: tuple[str, ...]) -> DataFrame:
        """A Gold table as published last, or only the given periods' folders."""
        return self.gold_tables.read(name, list(periods) or None)

    def silver_days(self, days: list[Day], as_stored: bool = False) -> DataFrame:
        """Silver of a list of days: only their folders are listed and read. ``as_stored``: registered columns as text."""
        there = [d for d in days if path_exists(self.spark, partition_path(self.silver_path, dict(zip(PARTITION_COLS, d))))]
        stored = evolution.silver_schema(self.columns())
        if not there:
            return self.spark.createDataFrame([], stored)
        return read_silver(self.spark, self.silver_path, there, stored) if as_stored else self.silver(*there)

    # --- jobs -----------------------------------------------------------------

    def build_silver(self, typed: DataFrame, mode: str = "overwrite", within: str | None = None, parts: int = 1) -> dict[str, int]:
        """Typed transactions -> Silver (one pass: rules, dedup, partitions); the stage counters observed in that pass.

        ``within``: a column of ``typed`` that equal ids share (``cleaning.dedup_latest``).
        ``parts``: so many shares of ``within``'s values are built and appended one after the
        other, which shuffle a share's rows at a time. A build that breaks off leaves the
        shares it has written; the next one with ``overwrite`` replaces them.
        """
        more = [f"`{c}`" for c in [*self.columns(), within] if c in typed.columns]
        rows = typed.select(*TX_FIELDS, *more)
        share = F.pmod(F.xxhash64(F.col(f"`{within}`")), F.lit(parts)) if parts > 1 else None
        counts: Counter[str] = Counter()
        self.ids.drop()  # it is built anew when the next batch needs it
        there = mode == "overwrite" and path_exists(self.spark, self.silver_path)
        path = scratch_path(self.spark, "staging", unique=True) if there else self.silver_path
        with build_conf(self.spark):
            for k in range(parts):
                silver, counters = cleaning.observed_silver(rows if share is None else rows.filter(share == k), within)
                write_partitioned(silver, path, mode="append" if k else mode)
                counts.update(counters())
            if there:
                # a full rebuild also clears the days that no longer have rows
                staged = self.spark.read.schema(evolution.silver_schema(self.columns())).parquet(path)
                replace_partitions(self.spark, staged, self.silver_path, self._days(self.silver_path), staged=True)
                delete_path(self.spark, path)
        return dict(counts)

    def days(self) -> DataFrame:
        """year, month, day of every Silver folder."""
        return self._days(self.silver_path)

    def expire(self, as_of: str, keep_days: int = governance.KEEP_DAYS) -> list[Day]:
        """Delete the days older than ``keep_days`` before ``as_of``, Gold first (P15); the days that went.

        The days come from folder names, and whole folders are deleted: no data
        file is opened. Gold is published without them, so a reader of Gold sees
        all tables with or all without. Entries of the id index that point at
        deleted days cost nothing.
        """
        old = [tuple(r[c] for c in PARTITION_COLS) for r in governance.retention_expired(self.days(), as_of, keep_days).collect()]
        if not old:
            return []
        if self.gold_tables.current():
            self.gold_tables.publish({name: self.spark.createDataFrame([], schema) for name, schema in GOLD.items()}, old)
        for day in old:
            delete_path(self.spark, partition_path(self.silver_path, dict(zip(PARTITION_COLS, day))))
        return sorted(old)

    def _days(self, path: str) -> DataFrame:
        """The days of a written zone, from its folders: calendar-sized."""
        return self.spark.createDataFrame(partition_days(self.spark, path), ", ".join(f"{c} string" for c in PARTITION_COLS))

    def partitions(self) -> DataFrame:
        """The partitions of Silver as folder names, from a listing: no data file is opened."""
        return self._days(self.silver_path).select(_partition_name().alias("partition")).orderBy("partition")

    def error_columns(self) -> dict[str, str]:
        """The registered columns that dead letters keep: all but those named like a column of their own."""
        return {c: kind for c, kind in self.columns().items() if c.lower() not in ("error_type", "_raw")}

    def write_errors(self, bronze: DataFrame, batch: str) -> None:
        """Dead-letter sink: the rejected rows of one load under errors/<batch>/error_type=; a repeated load replaces its own."""
        held = {c.lower() for c in self.columns()} - {c.lower() for c in self.error_columns()}
        letters = cleaning.dead_letters(bronze.drop(*[c for c in bronze.columns if c.lower() in held]))
        write_partitioned(letters, f"{self.root}/errors/{batch}", ["error_type"], mode="overwrite")

    def errors(self) -> DataFrame:
        """Every dead letter: the text columns, the corrupt line, error_type."""
        schema = T.StructType([*BRONZE_WITH_CORRUPT.fields, T.StructField("error_type", T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/errors")

    def build_gold(self, days: list[Day] | None = None) -> None:
        """Silver -> the four Gold tables, published together.

        ``days`` limits the rebuild to touched days (late data), which are read
        from their folders alone; by default every Silver day is rebuilt, a large
        Silver in groups of days. Days that Silver no longer has leave Gold.
        """
        with build_conf(self.spark):
            if days is None:
                self.gold_tables.publish(kpis.gold_tables(self.silver(*group)) for group in self._day_groups())
            else:
                self.gold_tables.publish(kpis.gold_tables(self.silver_days(days)), days)

    def _day_groups(self) -> list[list[Day]]:
        """Silver's days in the groups that a build of Gold takes one after the other; an empty group is all of Silver."""
        n = shares(self.spark, folder_bytes(self.spark, self.silver_path), SHARE_BYTES)
        days = partition_days(self.spark, self.silver_path) if n > 1 else []
        return [days[k::n] for k in range(min(n, len(days)))] or [[]]

    def register(self, prefix: str = "") -> None:
        """Temp views silver_transactions, gold_<name>."""
        self.silver().createOrReplaceTempView(f"{prefix}silver_transactions")
        for name in GOLD:
            self.gold(name).createOrReplaceTempView(f"{prefix}gold_{name}")


def _partition_name() -> Column:
    return F.concat(F.lit("year="), "year", F.lit("/month="), "month", F.lit("/day="), "day")


_LAKES: dict[tuple[str, str, str], Lake] = {}


def fixture_lake(spark: SparkSession, sf_dir: str, kind: str) -> Lake:
    """The lake built from the test tables (``kind`` = 'tx' or 'events').

    Built once per application and input folder, under the shared checkpoint
    root; later calls read the written zones.
    """
    from ..sources import tables

    apply_lake_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    lake = _LAKES.get(key)
    if lake is not None and path_exists(spark, f"{lake.root}/_BUILT"):
        return lake
    name = "tx" if kind == "tx" else "events"
    root = scratch_path(spark, "lake", name + "-" + path_tag(sf_dir))
    lake = Lake(spark, root)
    if not path_exists(spark, f"{root}/_BUILT"):
        if kind == "tx":
            lines = tables.table(spark, sf_dir, "lineitem").count()
            lake.build_silver(tables.tx_raw(spark, sf_dir, order_key="_order"), within="_order",
                              parts=shares(spark, lines, SHARE_ROWS))
        else:
            lake.build_silver(tables.events_tx(spark, sf_dir))
        lake.build_gold()
        touch(spark, f"{root}/_BUILT")
    _LAKES[key] = lake
    return lake
