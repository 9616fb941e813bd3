"""Session settings and the shared scratch location.

The library never creates a session on import. ``build_session`` is for
tests, the bench and local runs; on a cluster the caller's session is used
as it is, and only settings that are unset are filled in.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE gives runtime broadcast conversion
# (size-checked by Spark), partition coalescing and skew-join splitting.
LAKE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Silver/Gold partition folders are zero-padded strings ('05'); never let
    # discovery turn them into ints (a rewrite would then produce month=5).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Partitioned writes go through a rebalance; on small outputs AQE would
    # coalesce them into one writer task that opens every day's file in turn.
    # A small floor keeps several writers; at scale partitions are far larger.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
}

# Zones would be written or read wrongly without these.
NEEDED = ("spark.sql.sources.partitionOverwriteMode", "spark.sql.sources.partitionColumnTypeInference.enabled")


def build_session(master: str = "local[8]", app: str = "shoplake", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**LAKE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings to pass to spark-submit for a run over ``input_bytes``.

    The initial shuffle partition count is sized so that no partition
    exceeds the target before AQE coalesces (AQE only merges, it never
    splits a non-skewed partition), and is at least 2 x the task slots.
    Broadcasts stay at 64 MB: only AQE's runtime-measured build sides or
    inputs with a proven bound are broadcast.
    """
    slots = executors * cores_per_executor
    partitions = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        **LAKE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def apply_lake_conf(spark: SparkSession) -> None:
    """The lake's SQL settings on an existing session: those its results need, and others that the session leaves open."""
    held = spark._jsparkSession.sessionState().conf()
    for k, v in LAKE_CONF.items():
        if k in NEEDED or not held.contains(k):
            spark.conf.set(k, v)


# For builds over whole zones. Shuffles start in many small parts, which AQE joins up
# to a size whose sorts stay in a task's memory, however few partitions the session
# has; a skewed join is split even where what follows needs a shuffle then. Shuffle files
# go when the write that made them has ended, not when the driver collects its garbage.
# A task reads more than a few of a zone's day files, which can be small.
INITIAL_PARTITIONS = 1024
BUILD_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.files.openCostInBytes": "512k",
}
# A join side that turns out smaller is broadcast, unless the session has a bound of its own.
BUILD_BROADCAST = "32m"
# What a build shuffles at once follows the cores, not the input: rows of Silver's input
# and bytes of Silver for each core. Larger inputs are built in shares, one after the other.
SHARE_ROWS = 5_000_000
SHARE_BYTES = 128 * 1024 * 1024


@contextmanager
def build_conf(spark: SparkSession) -> Iterator[None]:
    """Shuffle settings of a zone's build, where the session leaves them open; taken back afterwards."""
    held = spark._jsparkSession.sessionState().conf()
    parts = max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = {**BUILD_CONF, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)}
    if not held.contains("spark.sql.autoBroadcastJoinThreshold"):
        wanted["spark.sql.adaptive.autoBroadcastJoinThreshold"] = BUILD_BROADCAST
    added = {k: v for k, v in wanted.items() if not held.contains(k)}
    for k, v in added.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in added:
            spark.conf.unset(k)


def shares(spark: SparkSession, size: int, per_core: int) -> int:
    """The number of shares in which a build over ``size`` rows or bytes goes, at ``per_core`` for each core."""
    return max(1, -(-size // (per_core * max(1, spark.sparkContext.defaultParallelism))))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system; it is read from the
    session. Only in local mode, where driver and executors are one process,
    a temp folder takes its place when it is unset.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="shoplake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def path_tag(path: str) -> str:
    """A folder-name-safe tag for an input location (any URI)."""
    return re.sub(r"[^A-Za-z0-9]+", "_", path.rstrip("/")).strip("_")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the checkpoint root, scoped to this application."""
    app = spark.sparkContext.applicationId
    pieces = [checkpoint_root(spark), "shoplake", app, *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if fs.exists(p):
        fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).create(p, True).close()


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """A small file that appears whole or not at all; without ``replace`` it may not exist yet."""
    fs, p = _file(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if replace and fs.exists(p):
        fs.delete(p, False)
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None where there is none."""
    fs, p = _file(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, from the file system's own summary."""
    fs, p = _file(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, from one listing of the file system; no file is opened."""
    fs, p = _file(spark, pattern)
    found = fs.globStatus(p)
    if found is None:
        return []
    jvm, n = spark.sparkContext._jvm, len(found)
    every = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, n)
    jvm.java.lang.System.arraycopy(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found), 0, every, 0, n)
    text = jvm.java.util.Arrays.toString(every)[1:-1]  # one call for all of them
    return text.split(", ") if text else []


__all__ = [
    "LAKE_CONF", "build_session", "build_conf", "shares", "cluster_settings", "apply_lake_conf", "checkpoint_root", "scratch_path",
    "path_exists", "delete_path", "touch", "path_tag", "write_text", "read_text", "glob_paths",
    "folder_bytes",
]
