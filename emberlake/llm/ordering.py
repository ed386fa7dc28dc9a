"""Exact positions in a global order without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import stored

# Bits of monotonically_increasing_id that hold the row's place inside its partition.
_LOCAL_BITS = 33


def ranked(df: DataFrame, order: Sequence[Column | str], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with its 0-based position in ``order`` as ``name``; a stored table.

    Rows are range-partitioned and sorted; a partition's rows are counted and its offset added. The driver sees one
    row per partition. The order should be unique: rows that tie share a partition and get some order among them.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    placed = stored(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__place", place)
        .withColumns({"__part": F.shiftright("__place", _LOCAL_BITS), "__local": F.col("__place").bitwiseAND((1 << _LOCAL_BITS) - 1)})
        .drop("__place"),
        "ranked",
    )
    counts = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, count in counts:
        offsets.append((part, total))
        total += count
    table = spark.createDataFrame(offsets, "__part long, __offset long")
    return placed.join(F.broadcast(table), "__part").withColumn(name, F.col("__offset") + F.col("__local")).drop("__part", "__local", "__offset")
