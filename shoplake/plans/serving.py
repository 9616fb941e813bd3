"""In-memory serving copy of Gold for dashboards (C4).

The tables are cached only where all of them together are small enough: their size
is taken from the file system before anything is read. Larger ones are served from
their files under the same names. ``refresh`` follows a new publication, ``stop``
releases the memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..schemas import GOLD
from ..session import folder_bytes
from .lake import Lake

MAX_BYTES = 256 * 1024 * 1024  # of Parquet; in memory a few times that


@dataclass
class Serving:
    spark: SparkSession
    lake: Lake
    max_bytes: int = MAX_BYTES
    prefix: str = ""
    version: int | None = None
    cached: bool = False

    def view(self, name: str) -> str:
        return f"{self.prefix}gold_{name}"

    def size(self) -> int:
        """Bytes of the folders that the current publication uses."""
        now = self.lake.gold_tables.current()
        folders = {(t, v) for t, of in now["tables"].items() for v in of.values()}
        return sum(folder_bytes(self.spark, self.lake.gold_tables.folder(t, v)) for t, v in folders)

    def start(self) -> Serving:
        self.lake.register(self.prefix)
        self.version = self.lake.gold_tables.current()["version"]
        self.cached = self.size() <= self.max_bytes
        if self.cached:
            for name in GOLD:
                self.spark.catalog.cacheTable(self.view(name))
        return self

    def refresh(self) -> bool:
        """Serve the last publication; whether there was a new one."""
        if self.lake.gold_tables.current()["version"] == self.version:
            return False
        self._release()
        self.start()
        return True

    def _release(self) -> None:
        if self.cached:
            for name in GOLD:
                self.spark.catalog.uncacheTable(self.view(name))
        self.cached = False

    def stop(self) -> None:
        self._release()
        for name in GOLD:
            self.spark.catalog.dropTempView(self.view(name))


def serve(spark: SparkSession, lake: Lake, max_bytes: int = MAX_BYTES, prefix: str = "") -> Serving:
    return Serving(spark, lake, max_bytes, prefix).start()


__all__ = ["Serving", "serve", "MAX_BYTES"]
