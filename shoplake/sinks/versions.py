"""Partitioned tables that are published together (K3).

A publication writes its rows to folders of their own, ``<table>/version=<n>/``,
and then one manifest that names, for every table, the version of each day. The
manifest is written last and appears whole or not at all, so readers see all
tables of a publication or none: a write that breaks off leaves folders that no
manifest names, which the next publication of that number clears. Nothing that a
reader may hold is ever overwritten. A publication of some days writes these days
only; a day it covers and has no rows for leaves the tables.

The manifest has one entry per table and day (calendar-sized) and is the only
thing the driver reads. One writer at a time: a second one that publishes the
same number fails.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import PARTITION_COLS
from ..session import delete_path, glob_paths, read_text, write_text
from ..sources.zones import partition_days
from .writers import write_partitioned

Day = tuple[str, str, str]
VERSION = "version"


@dataclass
class VersionedTables:
    spark: SparkSession
    root: str
    schemas: dict[str, StructType]

    # --- manifests --------------------------------------------------------------

    def _manifests(self) -> list[str]:
        return sorted(glob_paths(self.spark, f"{self.root}/_manifests/*.json"))

    def _read(self, path: str) -> dict:
        held = json.loads(read_text(self.spark, path))
        return {"version": held["version"], "written": held["written"],
                "tables": {t: {tuple(d.split("/")): int(v) for v, days in of.items() for d in days}
                           for t, of in held["tables"].items()}}

    def current(self) -> dict | None:
        """{"version": n, "tables": {table: {day: version}}, "written": {table: {version: days}}} of the last publication."""
        found = self._manifests()
        return self._read(found[-1]) if found else None

    def _write_manifest(self, version: int, tables: dict[str, dict[Day, int]], written: dict[str, dict[str, int]]) -> None:
        packed = {}
        for t, of in tables.items():
            by = defaultdict(list)
            for day, v in sorted(of.items()):
                by[str(v)].append("/".join(day))
            packed[t] = by
        write_text(self.spark, f"{self.root}/_manifests/{version:010d}.json",
                   json.dumps({"version": version, "tables": packed, "written": written}))

    # --- writing ----------------------------------------------------------------

    def folder(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/{VERSION}={version}"

    def day_folder(self, table: str, day: Day) -> str | None:
        """The folder that holds a day now."""
        now = self.current()
        version = now["tables"].get(table, {}).get(day) if now else None
        parts = "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, day))
        return f"{self.folder(table, version)}/{parts}" if version else None

    def publish(self, tables: dict[str, DataFrame] | Iterable[dict[str, DataFrame]], days: list[Day] | None = None) -> int:
        """Replace all days, or just ``days``, of all the tables at once; the number of the publication.

        ``tables`` may come in parts that hold different days, which are written one after the other.
        """
        now = self.current()
        version = now["version"] + 1 if now else 1
        parts = iter([tables] if isinstance(tables, dict) else tables)
        part = next(parts)
        names = list(part)

        def write(name: str, df: DataFrame) -> None:
            write_partitioned(df.select(*self.schemas[name].fieldNames()), self.folder(name, version))

        for name in names:
            delete_path(self.spark, self.folder(name, version))  # of a publication that broke off
        # Independent plans: submitted together, their stages share the executors.
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            while part is not None:
                list(pool.map(write, names, [part[name] for name in names]))
                part = next(parts, None)
        written = {name: partition_days(self.spark, self.folder(name, version)) for name in names}
        held = {} if days is None or not now else now["tables"]
        gone = set(days or [])
        merged = {name: {d: v for d, v in held.get(name, {}).items() if d not in gone} | dict.fromkeys(written[name], version)
                  for name in names}
        # how many days each folder in use was written with: one that lost none is read as a whole
        counts = {}
        for name, of in merged.items():
            before = now["written"].get(name, {}) if now else {}
            known = before | {str(version): len(written[name])}
            counts[name] = {str(v): known[str(v)] for v in set(of.values())}
        self._write_manifest(version, merged, counts)
        return version

    def expire(self, keep: int = 2) -> list[str]:
        """Delete what the last ``keep`` publications don't use; a reader of an older one must have ended."""
        manifests = self._manifests()
        used = set()
        for path in manifests[-keep:]:
            used |= {(t, v) for t, of in self._read(path)["tables"].items() for v in of.values()}
        last = self._read(manifests[-1])["version"] if manifests else 0
        gone = []
        for name in self.schemas:
            for path in glob_paths(self.spark, f"{self.root}/{name}/{VERSION}=*"):
                version = int(path.rstrip("/").rsplit("=", 1)[1])
                if (name, version) not in used and version <= last:
                    gone.append(path)
        gone += manifests[:-keep]
        for path in gone:
            delete_path(self.spark, path)
        return gone

    # --- reading ----------------------------------------------------------------

    def read(self, table: str, periods: list[tuple[str, ...]] | None = None) -> DataFrame:
        """A table as published last, or only its (year[, month[, day]]) periods; only their folders are listed."""
        now = self.current()
        if now is None:
            raise FileNotFoundError(f"nothing published under {self.root}")
        of, schema = now["tables"].get(table, {}), self.schemas[table]
        days = [d for d in of if not periods or any(d[:len(p)] == tuple(p) for p in periods)]
        if not days:
            return self.spark.createDataFrame([], schema)
        versions = set(of.values())
        reader = self.spark.read.schema(schema)
        if not periods and [now["written"][table][str(v)] for v in versions] == [len(of)]:
            return reader.parquet(self.folder(table, versions.pop()))
        parts = [f"{self.folder(table, of[d])}/" + "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, d)) for d in sorted(days)]
        return reader.option("basePath", f"{self.root}/{table}").parquet(*parts).select(*schema.fieldNames())


__all__ = ["VersionedTables", "Day"]
