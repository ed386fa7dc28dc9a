"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # Event times are GMT by name and their text goes into row keys.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Skewed joins and skewed REBALANCE partitions are split at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of merged partitions, and so of written files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A speculative copy of a write task may leave duplicate rows in JDBC sinks.
    "spark.speculation": "false",
}

UTC_NAMES = {
    "UTC", "GMT", "UCT", "Z", "Zulu", "Universal", "Etc/UTC", "Etc/GMT", "Etc/UCT", "Etc/Zulu", "Etc/Universal",
    "+00:00", "UTC+00:00", "GMT+00:00",
}

# Input bytes per shuffle partition; adaptive execution merges partitions that turn out small.
SHUFFLE_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "emberlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; dots in option names are written as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Row keys contain timestamp text, so the session zone must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}: keys and day columns depend on it")


def fit_shuffles(spark: SparkSession, *folders: str) -> int:
    """Let shuffles start with as many partitions as the size of their input folders asks for.

    A dedup or an aggregate cannot be split after its shuffle, so too few
    partitions would spill. Too many cost little: they are merged at run time.
    """
    total = 0
    for folder in folders:
        handle = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = handle.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(handle):
            total += fs.getContentSummary(handle).getLength()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(least, -(-total // SHUFFLE_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


_local_root: str | None = None


def use_local_scratch(folder: str) -> None:
    """Where sessions in one process, without ``spark.checkpoint.dir``, put intermediate tables: for tests and benches."""
    global _local_root
    _local_root = folder


def has_scratch(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None) or _local_root)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, under ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    # Executors of a cluster could not share a folder of the driver's machine.
    if not root and re.match(r"local(\[|$)", spark.sparkContext.master):
        root = _local_root
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def materialised(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once to the scratch folder and read back; the copy is removed at the end.

    Used where a frame feeds several jobs: its plan does not run again for each
    of them, and a lost executor costs only the files it was reading.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        handle = spark._jvm.org.apache.hadoop.fs.Path(path)
        handle.getFileSystem(spark._jsc.hadoopConfiguration()).delete(handle, True)
