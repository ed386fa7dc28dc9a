"""Raw CSV feeds and selection of files not loaded yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.text import leading_day
from emberlake.operators.shaping import conform

# Fixed value: what stands before the day in a feed's file name.
DAY_MARKER = "br_"


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    rename: Mapping[str, str] | None = None,
    newer_than: int | None = None,
    inclusive: bool = False,
    undated: bool = False,
) -> DataFrame:
    """Columns of headed CSV files as text, matched by header name.

    Only the header of the first file is read ahead, no inference pass over
    the data; a file with another header fails the scan instead of shifting
    columns. With ``newer_than`` (yyyyMMdd) files of older days are dropped
    from the scan by name before any is opened; those without a day are dropped
    too unless ``undated`` is set.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(paths)
    if newer_than is not None:
        name = F.col("_metadata.file_name")
        newer = is_newer(name, newer_than, inclusive)
        raw = raw.filter(newer | leading_day(name, DAY_MARKER).isNull() if undated else newer)
    return conform(raw, columns, rename)


def is_newer(name: Column, mark_day: int | Column, inclusive: bool = False) -> Column:
    """Whether the day in a file name or link is after ``mark_day`` (yyyyMMdd)."""
    day = leading_day(name, DAY_MARKER)
    return day >= mark_day if inclusive else day > mark_day


def select_new_files(
    names: DataFrame, name: str, mark_day: int | Column, inclusive: bool = False
) -> DataFrame:
    """Rows of a file listing whose name carries a day after the mark.

    Strict by default: once any row of a day is loaded its file is not taken again.
    """
    return names.filter(is_newer(F.col(name), mark_day, inclusive))


def require_dated(names: DataFrame, name: str) -> None:
    """Raise if a file name of a listing carries no day: such a file would never be selected."""
    undated = names.filter(leading_day(F.col(name), DAY_MARKER).isNull()).select(name).limit(10).collect()
    if undated:
        raise ValueError(f"files without a day after {DAY_MARKER!r}, among them: {', '.join(r[0] for r in undated)}")


def list_files(spark: SparkSession, folder: str | Sequence[str], suffix: str = ".csv") -> DataFrame:
    """Files of a folder as rows (path, name, length); contents are not read."""
    files = spark.read.format("binaryFile").load(folder if isinstance(folder, str) else list(folder)).select("path", "length")
    listed = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    return listed.filter(F.col("name").endswith(suffix))
