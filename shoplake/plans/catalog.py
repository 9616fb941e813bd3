"""The zones as databases and external partitioned tables of the session's catalog.

``bronze.transactions`` is the landing JSON, ``silver.transactions`` and the four
``gold`` tables are Parquet; every table is partitioned by year, month and day, and
its partitions are kept in the catalog with their folders, so that a query by table
name opens only the folders its filters leave over, and ``SHOW PARTITIONS`` opens
none. Gold partitions point at the folders of the last publication: ``refresh``
moves them after a new one, as it adds the days of Silver and of the landing zone.
Dropping a table leaves its files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import BRONZE, CORRUPT_COL, GOLD, PARTITION_COLS, SILVER
from ..session import path_tag
from ..sinks.versions import Day
from ..sources.zones import partition_days
from .lake import Lake

ADD_AT_ONCE = 200  # partitions of one statement


def day_path(day: Day) -> str:
    return "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, day))


def _spec(day: Day) -> str:
    return "PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(PARTITION_COLS, day)) + ")"


@dataclass
class Catalog:
    """Databases ``<prefix>_bronze``, ``<prefix>_silver`` and ``<prefix>_gold`` of one lake."""

    spark: SparkSession
    lake: Lake
    landing: str | None = None
    prefix: str = "shoplake"
    _held: dict[str, dict[Day, str]] = field(default_factory=dict)

    def name(self, zone: str, table: str = "transactions") -> str:
        return f"{self.prefix}_{zone}.{table}"

    def _zones(self) -> dict[str, tuple[str, StructType, str, str]]:
        """name -> (root folder, columns, format, options)"""
        zones = {self.name("silver"): (self.lake.silver_path, SILVER, "parquet", "")}
        for table, schema in GOLD.items():
            zones[self.name("gold", table)] = (f"{self.lake.gold_root}/{table}", schema, "parquet", "")
        if self.landing:
            columns = StructType([*BRONZE.fields, *SILVER.fields[len(BRONZE.fields):]]).add(CORRUPT_COL, "string")
            zones[self.name("bronze")] = (
                self.landing, columns, "json", f"OPTIONS (mode 'PERMISSIVE', columnNameOfCorruptRecord '{CORRUPT_COL}')")
        return zones

    def _folders(self, name: str, root: str) -> dict[Day, str]:
        """The days a table has now, and their folders; folder names and a manifest, no data file."""
        if name.startswith(f"{self.prefix}_gold."):
            table, now = name.split(".")[1], self.lake.gold_tables.current()
            held = now["tables"].get(table, {}) if now else {}
            return {d: f"{self.lake.gold_tables.folder(table, v)}/{day_path(d)}" for d, v in held.items()}
        return {d: f"{root}/{day_path(d)}" for d in partition_days(self.spark, root)}

    def register(self) -> None:
        """Create the databases and tables (in place of tables of these names) and add their partitions."""
        for name, (root, schema, fmt, options) in self._zones().items():
            database = name.split(".")[0]
            # a database folder of its own: nothing is written there, the tables lie in the lake
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.lake.root}/catalog/{database}'")
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {options} "
                           f"PARTITIONED BY ({', '.join(PARTITION_COLS)}) LOCATION '{root}'")
            self._held[name] = {}
        self.refresh()

    def refresh(self) -> dict[str, int]:
        """Bring the partitions up to date; the number of changes of each table."""
        changes = {}
        for name, (root, *_) in self._zones().items():
            held, now = self._held[name], self._folders(name, root)
            gone = sorted(d for d in held if held[d] != now.get(d))
            new = sorted(d for d in now if now[d] != held.get(d))
            for at in range(0, len(gone), ADD_AT_ONCE):
                parts = ", ".join(_spec(d) for d in gone[at:at + ADD_AT_ONCE])
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
            for at in range(0, len(new), ADD_AT_ONCE):
                parts = " ".join(f"{_spec(d)} LOCATION '{now[d]}'" for d in new[at:at + ADD_AT_ONCE])
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
            if gone or new:
                self.spark.catalog.refreshTable(name)
            self._held[name] = now
            changes[name] = len(gone) + len(new)
        return changes

    def table(self, zone: str, table: str = "transactions") -> DataFrame:
        return self.spark.table(self.name(zone, table))

    def partitions(self, zone: str, table: str = "transactions") -> DataFrame:
        """SHOW PARTITIONS: from the catalog alone."""
        return self.spark.sql(f"SHOW PARTITIONS {self.name(zone, table)}")

    def query(self, text: str, **values: str) -> DataFrame:
        """A statement with named parameters; ``{bronze}``, ``{silver}`` and ``{gold}`` stand for the databases."""
        for zone in ("bronze", "silver", "gold"):
            text = text.replace("{" + zone + "}", f"{self.prefix}_{zone}")
        return self.spark.sql(text, args=values)


def lake_catalog(lake: Lake, landing: str | None = None) -> Catalog:
    """The catalog of a lake under a name of its own, registered."""
    catalog = Catalog(lake.spark, lake, landing, prefix=f"lake_{path_tag(lake.root)[-40:].lower()}")
    catalog.register()
    return catalog


# --- reports by table name ------------------------------------------------------

GROWTH = """
WITH months AS (
  SELECT category,
         SUM(CAST(total_revenue AS DECIMAL(18,2))) FILTER (WHERE month = :month) AS now,
         SUM(CAST(total_revenue AS DECIMAL(18,2))) FILTER (WHERE month = :before) AS earlier
  FROM {gold}.revenue_by_product
  WHERE year = :year AND month IN (:month, :before)
  GROUP BY category)
SELECT category, CAST(now AS DOUBLE) AS current_revenue, CAST(earlier AS DOUBLE) AS previous_revenue,
       ROUND(try_divide(CAST(now AS DOUBLE) - CAST(earlier AS DOUBLE), CAST(earlier AS DOUBLE)) * 100.0D, 2) + 0.0D AS growth_pct
FROM months WHERE now IS NOT NULL
"""

LEADERS = """
SELECT day, region, total_revenue
FROM (SELECT *, RANK() OVER (PARTITION BY day ORDER BY total_revenue DESC) AS place
      FROM {gold}.revenue_by_region WHERE year = :year AND month = :month)
WHERE place = 1
"""

MONTH_COUNT = "SELECT COUNT(*) AS total_transactions FROM {silver}.transactions WHERE year = :year AND month = :month"

LANDED = """
SELECT category, COUNT(*) AS records, COUNT(store_id) AS with_store
FROM {bronze}.transactions WHERE year = :year AND month = :month AND day = :day GROUP BY category
"""

__all__ = ["Catalog", "lake_catalog", "GROWTH", "LEADERS", "MONTH_COUNT", "LANDED"]
