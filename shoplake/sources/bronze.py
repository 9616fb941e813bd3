"""Bronze landing zone: file listing, per-file reads, schema discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PARTITION_COLS
from .zones import read_bronze


def new_files(spark: SparkSession, path: str, modified_after: str, glob: str = "*.json*") -> DataFrame:
    """Landing files modified after ``modified_after`` ('yyyy-MM-ddTHH:mm:ss', UTC).

    The binary-file source lists the folders; ``content`` is never selected,
    so no file body is read.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).option("modifiedAfter", modified_after).option("timeZone", "UTC").load(path)
            .select(F.col("path").alias("file_path"), F.col("modificationTime").alias("modified"), F.col("length")))


def read_bronze_with_file(spark: SparkSession, path: str) -> DataFrame:
    """Bronze rows plus the file each came from (for per-file sampling)."""
    return read_bronze(spark, path).withColumn("file_path", F.col("_metadata.file_path"))


def discover_schema(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """Schema discovery over a landing folder with drifting batches.

    The JSON schema is inferred over all files (Spark merges columns and
    widens types); whether a column occurs is reduced per landing partition
    first, map-side, and then summed (no distinct counts, so no copy of each
    row per column): a column that appears only in newer batches shows a
    smaller count. Output:
    (column_name, data_type, partitions), one row per column.
    """
    reader = spark.read.option("multiLine", "false")
    if modified_after:  # only the new batches (inference would read every file)
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    inferred = reader.json(path)
    cols = [f for f in inferred.schema.fields if f.name not in PARTITION_COLS and f.name != "_corrupt_record"]
    day = F.concat_ws("-", *[F.col(c).cast("string") for c in PARTITION_COLS])
    present = inferred.select(day.alias("_part"), *[F.col(f"`{f.name}`").isNotNull().alias(f.name) for f in cols])
    daily = present.groupBy("_part").agg(*[F.bool_or(F.col(f"`{f.name}`")).alias(f.name) for f in cols])
    counts = daily.agg(*[F.count_if(F.col(f"`{f.name}`")).alias(f.name) for f in cols])
    types = {f.name: f.dataType.simpleString() for f in cols}
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                                         F.col(f"`{c}`").alias("partitions")) for c in types]))
    return counts.select(stack.alias("s")).select("s.*")


__all__ = ["new_files", "read_bronze_with_file", "discover_schema"]
