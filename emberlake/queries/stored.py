"""Writes to stored tables: orders as the table, a later feed of corrected and new orders as the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.merge import merge_rows
from emberlake.queries import Query, table
from emberlake.session import scratch_folder
from emberlake.sinks.tables import append_missing, overwrite_table, upsert_table
from emberlake.sources.tables import read_table

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "year", "month"]
_PARTITIONS = ["year", "month"]


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    parts = {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    return table(spark, folder, "orders").withColumns(parts).select(*_COLUMNS)


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """What the table holds: orders that are not pending."""
    return _orders(spark, folder).filter("o_orderstatus <> 'P'")


def _feed(spark: SparkSession, folder: str, shift: int = 0) -> DataFrame:
    """Finished orders at a new price and pending orders; ``shift`` moves them to another year."""
    rows = _orders(spark, folder).filter("o_orderstatus <> 'O'")
    return rows.withColumns({"o_totalprice": F.col("o_totalprice") + 1000, "year": F.col("year") + shift})


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    return merge_rows(_stored(spark, folder), _feed(spark, folder), ["o_orderkey"])


def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge on a partitioned table, written and read back."""
    path = scratch_folder(spark, "upsert-stored")
    upsert_table(_stored(spark, folder), path, ["o_orderkey"], _PARTITIONS)
    upsert_table(_feed(spark, folder), path, ["o_orderkey"], _PARTITIONS, keys_fix_partition=True)
    return read_table(spark, path).select(*_COLUMNS)


def upsert_moving(spark: SparkSession, folder: str) -> DataFrame:
    """A merge that moves matched rows to other partitions."""
    path = scratch_folder(spark, "upsert-moving")
    overwrite_table(_stored(spark, folder), path, _PARTITIONS)
    upsert_table(_feed(spark, folder, shift=10), path, ["o_orderkey"], _PARTITIONS)
    return read_table(spark, path).select(*_COLUMNS)


def append_new(spark: SparkSession, folder: str) -> DataFrame:
    """Only unknown keys are added; known ones keep their price."""
    path = scratch_folder(spark, "append-new")
    overwrite_table(_stored(spark, folder), path, _PARTITIONS)
    append_missing(_feed(spark, folder), path, ["o_orderkey"], _PARTITIONS)
    return read_table(spark, path).select(*_COLUMNS)


def overwrite_stored(spark: SparkSession, folder: str) -> DataFrame:
    """A table written twice without partitions; the second time from its own rows and new ones."""
    path = scratch_folder(spark, "overwrite-stored")
    overwrite_table(_stored(spark, folder), path)
    overwrite_table(merge_rows(read_table(spark, path), _feed(spark, folder), ["o_orderkey"]), path)
    return read_table(spark, path).select(*_COLUMNS)


def partitioned_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Every order written by year and month and counted from the written table."""
    path = scratch_folder(spark, "partitioned")
    overwrite_table(_orders(spark, folder), path, _PARTITIONS, sort_by=["o_orderstatus"])
    return read_table(spark, path).groupBy("year", "month", "o_orderstatus").agg(F.count("*").alias("n"))


_PARTS = "CAST(year(o_orderdate) AS INTEGER){shift} AS year, CAST(month(o_orderdate) AS INTEGER) AS month"
_PLAIN = _PARTS.format(shift="")


def _merged_sql(shift: str = "") -> str:
    return (
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_PLAIN} FROM orders WHERE o_orderstatus = 'O' "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 AS o_totalprice, "
        f"{_PARTS.format(shift=shift)} FROM orders WHERE o_orderstatus <> 'O'"
    )


QUERIES = {
    "upsert": Query(upsert, _merged_sql()),
    "upsert_stored": Query(upsert_stored, _merged_sql()),
    "upsert_moving": Query(upsert_moving, _merged_sql(" + 10")),
    "overwrite_stored": Query(overwrite_stored, _merged_sql()),
    "append_new": Query(
        append_new,
        "SELECT o_orderkey, o_custkey, o_orderstatus, "
        f"CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice, {_PLAIN} FROM orders",
    ),
    "partitioned_overwrite": Query(
        partitioned_overwrite,
        f"SELECT year, month, o_orderstatus, count(*) AS n FROM (SELECT *, {_PLAIN} FROM orders) GROUP BY ALL",
    ),
}
