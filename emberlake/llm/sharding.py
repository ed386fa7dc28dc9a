"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import rows_of_texts, stored
from emberlake.llm.ordering import ranked


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` rows drawn without replacement are good, for populations of any size.

    By inversion over 12 standard deviations around the mode (all of the support where it is smaller); the odds of
    neighbouring counts are simple fractions, so nothing overflows.
    """
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    total = good + bad
    mode = min(max((sample + 1) * (good + 1) // (total + 2), low), high)
    spread = int(12 * (sample * good / total * bad / total) ** 0.5) + 30
    low, high = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(low, high, dtype=float)
    odds = np.log((good - k) * (sample - k)) - np.log((k + 1) * (bad - sample + k + 1))
    weight = np.concatenate([[0.0], np.cumsum(odds)])
    weight = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def communication_matrix(counts: list[int], capacities: list[int], seed: int) -> list[list[int]]:
    """How many rows each partition sends to each shard, as a uniform shuffle would: rows and columns sum exactly."""
    rng, left, matrix = np.random.default_rng(seed), list(capacities), []
    for count in counts:
        row, rest = [], sum(left)
        for j, room in enumerate(left):
            taken = draw_hypergeometric(rng, room, rest - room, count)
            row.append(taken)
            rest -= room
            count -= taken
            left[j] -= taken
        matrix.append(row)
    return matrix


def shard_uniformly(docs: DataFrame, shards: int, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row in a uniformly drawn place; shard sizes differ by one at most.

    The rows of each input partition are counted, the matrix of partition-to-shard counts is drawn on the driver (one
    row of ``shards`` numbers a partition), each partition is permuted and cut by its row of the matrix, and each shard
    is permuted again; ``slot`` is the gapless position in the shard. Size is the text's UTF-8 bytes plus 1. Rows
    with equal ids or texts are rows like others and fall independently; null ids stay null, null texts count as no
    bytes. The draw depends on the seed and on how the input is split into partitions. Other columns are ignored.
    """
    spark = docs.sparkSession
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = rows_of_texts(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(binary) + 1).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Stored first: counts and places must come from one and the same partitioning.
    thin = stored(rows, "shard-rows")
    counts = sorted((r["part"], r["n"]) for r in thin.groupBy("part").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in counts)
    capacities = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = communication_matrix([n for _, n in counts], capacities, seed)
    starts = np.cumsum([0] + [n for _, n in counts]).tolist()
    cuts = [(part, start, np.cumsum(row).tolist()) for (part, _), start, row in zip(counts, starts, matrix)]
    plan = spark.createDataFrame(cuts, "part int, start long, cuts array<long>")
    local = ranked(thin, ["part", F.xxhash64(F.lit(seed), F.lit(1), "place"), "place"], "at")
    # The plan has one row for each input partition, which bounds the broadcast.
    sent = local.join(F.broadcast(plan), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        "place",
        F.size(F.filter("cuts", lambda c: c <= F.col("at") - F.col("start"))).alias("shard"),
    )
    placed = ranked(sent, ["shard", F.xxhash64(F.lit(seed), F.lit(2), "place"), "place"], "at")
    first = F.get(F.array(*[F.lit(int(x)) for x in np.cumsum([0, *capacities[:-1]])]), F.col("shard")).cast("long")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("at") - first).alias("slot"))


def op6_sharding(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    placed = shard_uniformly(table(spark, folder, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
