"""What several operators share: intermediate tables, row keys, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.session import scratch_folder

# Stands for a null id: larger than every other, so that a row without id never counts as the first.
NO_ID = 9223372036854775807

# ASCII white space, the set that separates words and that is stripped from lines.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text that are worked on at once in a task.
SLICE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs only the files it was reading. The shuffles of the finished job are
    unreachable afterwards; the collection lets Spark's cleaner drop their files before the next job writes its own.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each, or one longer row.

    Working memory is then a multiple of ``limit`` and of the longest text, however many rows a batch has.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def id_of(name: str) -> Column:
    """A row's id for comparisons; null ids come last."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def text_key(name: str) -> Column:
    """Tells apart rows that repeat an id with another text. Null and empty texts differ."""
    return F.xxhash64(F.lit(11), F.col(name))


def rows_of_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs as ``doc_id`` and ``text``, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), so that order and low bits look random."""
    with np.errstate(over="ignore"):
        v = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive items; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, size):
            out = out * _ODD + hashes[i : i + n]
    return mixed(out)
