"""Landing-zone fixtures: the dirty events written as GZIP JSON, and the
lake built from them through the real Bronze -> Silver path."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import apply_lake_conf, path_exists, path_tag, scratch_path, touch
from ..sinks.writers import write_landing
from ..sources import tables
from ..sources.zones import read_bronze
from .lake import Lake

_BUILT: dict[tuple[str, str], str] = {}


def _tag(sf_dir: str) -> str:
    return path_tag(sf_dir)


def landing_path(spark: SparkSession, sf_dir: str) -> str:
    """bronze_dirty written once per application as landing JSON.gz (K4)."""
    apply_lake_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = scratch_path(spark, "landing", _tag(sf_dir))
    if key in _BUILT and path_exists(spark, f"{path}/_DONE"):
        return path + "/transactions"
    if not path_exists(spark, f"{path}/_DONE"):
        write_landing(tables.bronze_dirty(spark, sf_dir), path + "/transactions", mode="overwrite")
        touch(spark, f"{path}/_DONE")
    _BUILT[key] = path
    return path + "/transactions"


def bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver + Gold built from the landing files (typing, rules, dedup)."""
    from ..operators import cleaning

    src = landing_path(spark, sf_dir)
    root = scratch_path(spark, "lake", "bronze-" + _tag(sf_dir))
    lake = Lake(spark, root)
    if not path_exists(spark, f"{root}/_BUILT"):
        bronze = read_bronze(spark, src)
        lake.write_errors(bronze, "source=full/batch=0")
        lake.build_silver(cleaning.type_transactions(bronze))
        lake.build_gold()
        touch(spark, f"{root}/_BUILT")
    return lake
