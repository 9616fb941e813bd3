"""Helpers shared by the operators: staged tables in the shared folder."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import shoplake
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.session import scratch_path

BITS = 1 << 24
PACK = 100_000
_SHIPPED: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, with this package sent to the executors' Python workers once per application."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root, held = os.path.dirname(os.path.abspath(shoplake.__file__)), io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.join("shoplake", os.path.relpath(path, root)))
        path = scratch_path(spark, "llm", "code", "shoplake.zip")
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out = fs.create(target, True)
        out.write(bytearray(held.getvalue()))
        out.close()
        spark.sparkContext.addPyFile(fs.makeQualified(target).toString())
        _SHIPPED.add(app)
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again.

    Cuts the lineage, so later steps reread a table that every executor can
    see instead of repeating the work, and fixes values such as row ids.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` short rows at most, in as many partitions as these need (``PACK`` rows each), if it has more.

    A task and a file cost as much for ten rows as for many, and a session may have any
    number of shuffle partitions and not let Spark join them up.
    """
    return df.coalesce(rows // PACK + 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def some_rows(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[dict[str, list]]:
    """The columns of a task's rows, ``rows`` at a time: a batch's texts are never Python objects all at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()


def among(docs: DataFrame, chosen: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` has a value of ``chosen``, and few others: by ``BITS`` bits, broadcast as words of 64.

    Keeps most rows out of a shuffle; what comes through is joined exactly.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(BITS))
    words = chosen.select(bit.alias("_bit")).groupBy(F.expr("_bit div 64").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_mask"))
    known = docs.withColumn("_bit", bit).withColumn("_word", F.expr("_bit div 64")).join(F.broadcast(words), "_word")
    return known.filter("shiftright(_mask, cast(_bit % 64 as int)) & 1 = 1").select(*docs.columns)


def text_or_empty(name: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"{base}_"
    return base
